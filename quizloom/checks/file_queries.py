"""Registered queries that go through files: the driver's tables written, loaded, read back."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.checks import inputs
from quizloom.checks.queries import (
    _long,
    _several_mcqs,
    _stub_judge,
    rag_questions,
    stub_answerer,
    stub_generator,
)
from quizloom.functions import mcq
from quizloom.functions.models import text_model
from quizloom.operators.numbering import row_positions
from quizloom.operators.ranges import cut_ranges
from quizloom.operators.storage import new_folder
from quizloom.operators.upsert import write_store
from quizloom.plans import rag, seeding
from quizloom.plans.benchmark import build_benchmark, stored_sets
from quizloom.plans.panel import Judge, evaluate_panel
from quizloom.sources import corpus, questions
from quizloom.sources.files import write_texts


def failing_answerer():
    """A model that fails for every third length of question."""
    answer = stub_answerer()

    def answer_or_fail(question, context):
        if len(question) % 3 == 0:
            raise TimeoutError(f"{len(question)} characters")
        return answer(question, context)

    return answer_or_fail


def rag_eval_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed answers have an error and no grades; the report is written and read back."""
    graded = rag.evaluate_rag(
        rag_questions(spark, sf_dir),
        inputs.index(spark, sf_dir),
        inputs.embed,
        text_model(failing_answerer),
    )
    path = new_folder(spark, "rag")
    rag.write_rag_report(graded, path)
    return spark.read.schema(graded.schema).json(path).withColumn("pos", _long("pos"))


def question_sets_without_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question of sets without an id has a key, and no two share one."""
    path = new_folder(spark, "sets")
    sets = _several_mcqs(spark, sf_dir).select(mcq.extract_blocks(F.col("raw")).alias("mcqs"))
    questions.write_json(sets, path)
    found = questions.explode_questions(questions.read_question_sets(spark, path))
    key = Window.partitionBy("file_path", "pos")
    return found.select(
        _long("pos").alias("pos"),
        "q_raw",
        F.count("*").over(key).alias("rows_of_key"),
        F.col("file_path").isNotNull().alias("has_key"),
    )


def _documents_as_files(rows: DataFrame, name, suffix: str) -> DataFrame:
    """``name, text`` of a JSON file per row; JSON is YAML too."""
    return rows.select(
        F.concat(name.cast("string"), F.lit(suffix)).alias("name"), F.to_json(F.struct("*")).alias("text")
    )


def prompt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as template files with odd patterns, versions and fields, in two loads."""
    suppliers = inputs.table(spark, sf_dir, "supplier")
    key, region = F.col("s_suppkey"), F.col("s_suppkey") % 4
    pattern = (
        F.when(region == 0, r"(?P<b>Q\d{,3})")
        .when(region == 1, r"(Q\d+)(.+?)Answer")
        .when(region == 2, r"Q(\d")
    )

    def documents(load: int, **fields) -> DataFrame:
        version = F.concat(F.lit(f"v{load}."), key.cast("string"))
        return suppliers.select(
            region.alias("region"),
            F.concat(F.lit("mcq_"), key.cast("string")).alias("prompt_id"),
            version.alias("version"),
            *[value.alias(name) for name, value in fields.items()],
        )

    store = new_folder(spark, "prompts")
    first = documents(
        1, template=F.concat(F.lit("for "), F.col("s_name")), parser_regex=pattern
    )
    second = documents(2, note=F.lit("again")).filter("region = 1")
    for rows, suffix in ((first, ".json"), (second, ".yaml")):
        folder = new_folder(spark, "prompt-files")
        write_texts(_documents_as_files(rows, F.col("prompt_id"), suffix), folder)
        seeding.seed_prompts(spark, folder, store)
    stored = seeding.read_prompt_store(spark, store)
    return stored.select(
        "prompt_id",
        "template",
        "version",
        "parser_regex",
        F.element_at("extra", "region").alias("region"),
        F.element_at("extra", "note").alias("note"),
    )


def prompt_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as template files of which three in five cannot be loaded, and why."""
    suppliers = inputs.table(spark, sf_dir, "supplier")
    kind, name = F.col("s_suppkey") % 5, F.col("s_name")
    text = (
        F.when(kind == 0, F.concat(F.lit("\n{broken "), name))
        .when(kind == 1, F.concat(F.lit("prompt_id: x\ntemplate: [1, '"), name, F.lit("'")))
        .when(kind == 2, F.to_json(F.struct(name.alias("template"))))
        .otherwise(F.to_json(F.struct(name.alias("prompt_id"), name.alias("template"))))
    )
    suffix = F.when(kind.isin(1, 4), ".yaml").otherwise(".json")
    files = suppliers.select(F.concat(F.col("s_suppkey").cast("string"), suffix).alias("name"), text.alias("text"))
    folder, rejects = new_folder(spark, "prompt-files"), new_folder(spark, "rejects")
    write_texts(files, folder)
    seeding.seed_prompts(spark, folder, new_folder(spark, "prompts"), rejects)
    found = spark.read.parquet(rejects)
    return found.select(F.substring_index("path", "/", -1).alias("name"), "place", "reason")


def prompt_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One template found by its id in a store of all parts."""
    p = inputs.table(spark, sf_dir, "part").select(
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("prompt_id"),
        F.col("p_name").alias("template"),
        F.col("p_type").alias("prompt_type"),
    )
    for name in schemas.PROMPT.names:
        if name not in p.columns:
            p = p.withColumn(name, F.lit(None).cast(schemas.PROMPT[name].dataType))
    store = new_folder(spark, "prompts")
    write_store(p.select(*schemas.PROMPT.names), store)
    return seeding.get_prompt(spark, store, "part-7").select("prompt_id", "template", "prompt_type")


# Part keys that one taxonomy file covers.
KEYS_PER_FILE = 1_000


def taxonomy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxonomy file per brand and range of part keys, loaded into a leaf store.

    Every other range is written as YAML.
    """
    parts = inputs.table(spark, sf_dir, "part")
    size = F.col("p_size")
    topic = F.concat_ws(".", "p_name", F.col("p_partkey").cast("string"))
    difficulty = F.when(size > 33, "H").when(size > 16, "M").otherwise("E")
    section = F.expr(f"p_partkey div {KEYS_PER_FILE}").alias("section")
    item = F.struct(topic.alias("topic"), difficulty.alias("difficulty"))
    documents = parts.groupBy("p_brand", section).agg(F.collect_list(item).alias("items"))
    lines = F.transform(
        "items",
        lambda i: F.concat(F.lit("    - topic: '"), i["topic"], F.lit("'\n      difficulty: "), i["difficulty"]),
    )
    as_yaml = F.concat(
        F.lit("domain: Parts\ncategories:\n  '"), "p_brand", F.lit("':\n"), F.array_join(lines, "\n"), F.lit("\n")
    )
    categories = F.create_map("p_brand", "items").alias("categories")
    as_json = F.to_json(F.struct(F.lit("Parts").alias("domain"), categories))
    odd = F.col("section") % 2 == 1
    suffix = F.when(odd, ".json").otherwise(".yaml")
    files = documents.select(
        F.concat("p_brand", F.lit("-"), F.col("section").cast("string"), suffix).alias("name"),
        F.when(odd, as_json).otherwise(as_yaml).alias("text"),
    )
    folder, store = new_folder(spark, "taxonomies"), new_folder(spark, "leaves")
    write_texts(files, folder)
    seeding.seed_taxonomies(spark, folder, store)
    return seeding.read_leaves(spark, store)


def chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk metadata as gzip JSON lines and vectors as a table, read and joined."""
    chunks, vectors = new_folder(spark, "chunks"), new_folder(spark, "vectors")
    documents = inputs.table(spark, sf_dir, "documents")
    rows = documents.select(F.col("doc_id").alias("chunk_id"), "doc_id", "text")
    rows.write.option("compression", "gzip").json(chunks)
    own = inputs.table(spark, sf_dir, "embeddings")
    own.select(F.col("vec_id").alias("chunk_id"), "embedding").write.parquet(vectors)
    found = corpus.read_chunks(spark, chunks).join(
        corpus.read_vectors(spark, vectors), "chunk_id", "left"
    )
    total = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return found.select("chunk_id", "doc_id", "text", F.round(total, 4).alias("total"))


def corpus_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus without ids in many files of different sizes; ids follow file name and row."""
    path = new_folder(spark, "corpus")
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    ranges = cut_ranges(documents.select("doc_id"), ["doc_id"], 128)
    ranges.gather(documents, "range").drop("range").write.parquet(path)
    found = corpus.read_corpus(spark, path, text_col="text")
    return found.select(F.col("doc_id").alias("position"), "text")


def panel_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel asked and graded; its question report and debug rows written and read back."""
    judges = [
        Judge(m, _stub_judge(i), enabled=m != inputs.PANEL[-1])
        for i, m in enumerate(inputs.PANEL)
    ]
    result = evaluate_panel(inputs.questions(spark, sf_dir), judges, inputs.INSTRUCTIONS)
    folder = new_folder(spark, "panel")
    result.write(folder, debug=True)
    report = spark.read.schema(result.per_question().schema).json(f"{folder}/questions")
    debug = spark.read.schema(result.debug().schema).json(f"{folder}/debug")
    rows = debug.select(
        F.col("file").alias("file_path"), "pos", F.explode("models").alias("model", "m")
    ).groupBy("file_path", "pos").agg(F.count("*").alias("debug_rows"))
    return report.join(rows, ["file_path", "pos"]).select(
        "file_path",
        _long("pos").alias("pos"),
        "correct_models",
        "incorrect_models",
        "unanswered_models",
        "debug_rows",
    )


def panel_files_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question report as its files, by name, have it: in the order of file and place."""
    judges = [Judge(m, _stub_judge(i)) for i, m in enumerate(inputs.PANEL[:2])]
    result = evaluate_panel(inputs.questions(spark, sf_dir), judges, inputs.INSTRUCTIONS)
    folder = new_folder(spark, "panel")
    result.write(folder)
    schema = result.per_question().schema
    lines = row_positions(spark.read.text(f"{folder}/questions"), "line")
    rows = lines.select("line", F.from_json("value", schema).alias("q"))
    return rows.select("line", "q.file_path", _long(F.col("q.pos")).alias("pos"))


def benchmark_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over the documents and the leaves of all parts, in two batches."""
    folder, leaves, prompts = (new_folder(spark, n) for n in ("run", "leaves", "prompts"))
    flat = seeding.flatten_leaves(inputs.taxonomies(spark, sf_dir))
    write_store(seeding.upsert_leaves(spark.createDataFrame([], schemas.STORED_LEAF), flat), leaves)
    templates = inputs.prompts(spark, sf_dir).withColumn("extra", F.lit(None).cast("map<string,string>"))
    write_store(templates.select(*schemas.PROMPT.names), prompts)
    build_benchmark(
        spark,
        inputs.corpus(spark, sf_dir),
        folder,
        leaves,
        prompts,
        "mcq_asia",
        inputs.embed,
        text_model(stub_generator),
        batches=2,
    )
    sets = stored_sets(spark, f"{folder}/questions")
    return sets.select("taxonomy_id", F.posexplode("mcqs").alias("pos", "q_raw")).select(
        "taxonomy_id", _long("pos").alias("pos"), "q_raw"
    )


FILE_QUERIES = {
    f.__name__: f
    for f in (
        rag_eval_failures,
        question_sets_without_id,
        prompt_files,
        prompt_rejects,
        prompt_lookup,
        taxonomy_files,
        chunk_files,
        corpus_positions,
        panel_files,
        panel_files_order,
        benchmark_run,
    )
}
