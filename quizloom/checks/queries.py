"""Registered queries: every operator over the whole of the driver's tables."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.checks import inputs
from quizloom.functions import mcq
from quizloom.functions.journal import ReplyJournal
from quizloom.functions.models import text_model
from quizloom.functions.taxonomy import leaf_label, query_terms
from quizloom.functions.text import has_min_words, strip, word_count
from quizloom.functions.vectors import inner_product
from quizloom.operators import bundles as bundle_ops
from quizloom.operators import panel
from quizloom.operators.columns import with_computed
from quizloom.operators.joins import salted_join
from quizloom.operators.numbering import row_positions, shuffled_positions
from quizloom.operators.similarity import skipped_groups, top_k
from quizloom.operators.storage import materialise, new_folder, shared_folder
from quizloom.operators.upsert import merge_fields, read_store, upsert_counts, write_store
from quizloom.plans import generate, index, rag, retrieval, review, seeding
from quizloom.plans.panel import Judge, ask_panel, grade_responses
from quizloom.sources import questions as files


def _long(column) -> Column:
    return F.col(column).cast("bigint") if isinstance(column, str) else column.cast("bigint")


# --- corpus and index -------------------------------------------------------------


def corpus_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.corpus(spark, sf_dir).filter(has_min_words(F.col("text"), index.MIN_WORDS))
    return docs.select("doc_id", word_count(F.col("text")).cast("bigint").alias("n_words"))


def dense_chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.chunk_ids(inputs.corpus(spark, sf_dir))


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = inputs.corpus(spark, sf_dir).select(
        "doc_id", inputs.embed(F.col("text")).alias("v")
    )
    return (
        vectors.select("doc_id", F.posexplode("v").alias("dim", "w"))
        .filter(F.col("w") != 0)
        .select("doc_id", _long("dim").alias("dim"), F.round(F.col("w").cast("double"), 6).alias("w"))
    )


# --- retrieval --------------------------------------------------------------------


def _own_queries(spark, sf_dir) -> DataFrame:
    vectors = inputs.table(spark, sf_dir, "embeddings")
    return vectors.select(F.col("vec_id").alias("query_id"), "embedding")


def _vectors(spark, sf_dir) -> DataFrame:
    vectors = inputs.table(spark, sf_dir, "embeddings")
    return vectors.select(F.col("vec_id").alias("chunk_id"), "embedding")


def _hits(rows: DataFrame) -> DataFrame:
    return rows.select(
        "query_id", _long("rank").alias("rank"), "chunk_id", F.round("score", 6).alias("score")
    )


def topk_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(top_k(_vectors(spark, sf_dir), _own_queries(spark, sf_dir), k=4))


def topk_retrieval_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with queries in many blocks."""
    found = top_k(
        _vectors(spark, sf_dir),
        _own_queries(spark, sf_dir),
        k=4,
        block_bytes=64 << 10,
    )
    return _hits(found)


def topk_few_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows wanted than there are vectors: all of them, ranked, for every query."""
    vectors = _vectors(spark, sf_dir)
    return _hits(top_k(vectors, _own_queries(spark, sf_dir), k=vectors.count() + 1))


def topk_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors drawn apart by their labels, so that whole groups of them are ruled out."""
    apart = F.transform("embedding", lambda x, i: x + F.when(i == F.col("label"), 20).otherwise(0))
    table = inputs.table(spark, sf_dir, "embeddings")
    vectors = table.select(F.col("vec_id").alias("chunk_id"), apart.cast("array<float>").alias("embedding"))
    queries = vectors.withColumnRenamed("chunk_id", "query_id")
    ruled_out = skipped_groups(vectors, queries, k=2).first()["skipped"] > 0
    return _hits(top_k(vectors, queries, k=2)).withColumn("groups_skipped", F.lit(ruled_out))


def topk_equal_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document searches with one of ten vectors, so most queries are equal."""
    vectors = _vectors(spark, sf_dir)
    few = vectors.filter("chunk_id < 10").withColumnRenamed("chunk_id", "v")
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 10).alias("v"))
    queries = documents.join(F.broadcast(few), "v").select(F.col("doc_id").alias("query_id"), "embedding")
    return _hits(top_k(vectors, queries, k=3))


def score_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the hits, computed again from both vectors as a column expression."""
    vectors, queries = _vectors(spark, sf_dir), _own_queries(spark, sf_dir)
    hits = top_k(vectors, queries, k=retrieval.QUERY_K)
    with_vectors = hits.join(vectors, "chunk_id").join(
        queries.withColumnRenamed("embedding", "q"), "query_id"
    )
    exact = inner_product(F.col("q"), F.col("embedding"))
    return with_vectors.select(
        "query_id", "chunk_id", F.round(exact, 6).alias("score"), (exact == F.col("score")).alias("same")
    )


def _text_hits(spark, sf_dir) -> DataFrame:
    """Hits of all vectors with the documents whose chunks they name."""
    hits = top_k(_vectors(spark, sf_dir), _own_queries(spark, sf_dir), k=4)
    return hits.join(index.chunk_ids(inputs.corpus(spark, sf_dir)), "chunk_id")


def _with_documents(found: DataFrame) -> DataFrame:
    return found.select(
        "query_id", _long("rank").alias("rank"), "chunk_id", "doc_id", "text"
    )


def retrieve_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = inputs.corpus(spark, sf_dir)
    return _with_documents(bundle_ops.with_text(_text_hits(spark, sf_dir), corpus, "doc_id"))


def retrieve_with_text_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with more winners than are broadcast: their ids go as bitmaps."""
    corpus = inputs.corpus(spark, sf_dir)
    hits = _text_hits(spark, sf_dir)
    return _with_documents(bundle_ops.with_text(hits, corpus, "doc_id", id_bytes=1 << 11))


def retrieve_with_text_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the join that splits documents many queries found."""
    hits = materialise(_text_hits(spark, sf_dir))
    found = salted_join(hits, inputs.corpus(spark, sf_dir), "doc_id", F.col("query_id"), hot_rows=5)
    return _with_documents(found)


def _bundles(spark, sf_dir) -> DataFrame:
    leaves = inputs.leaves(spark, sf_dir)
    return retrieval.build_bundles(leaves, inputs.index(spark, sf_dir), inputs.embed)


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _bundles(spark, sf_dir)
    ids = F.transform("passages", lambda p: p["chunk_id"].cast("string"))
    return built.select(
        "taxonomy_id",
        F.array_join("query_terms", "|").alias("query_terms"),
        F.array_join(ids, ",").alias("chunk_ids"),
        bundle_ops.context(F.col("passages")).alias("context"),
    )


# --- taxonomies and prompts -------------------------------------------------------


def _flat(spark, sf_dir, legacy=False) -> DataFrame:
    flat = seeding.flatten_leaves(inputs.taxonomies(spark, sf_dir), legacy)
    key = F.col("load_order.path").cast("bigint").alias("p_partkey")
    return flat.select(key, *schemas.STORED_LEAF.names)


def leaf_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir)


def leaf_flatten_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir, legacy=True)


def leaf_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smaller parts are the stored leaves, larger parts the load; sizes overlap."""
    docs = inputs.taxonomies(spark, sf_dir)
    old = seeding.flatten_leaves(docs.filter(F.col("p_size") <= 30))
    new = seeding.flatten_leaves(docs.filter(F.col("p_size") >= 20))
    empty = spark.createDataFrame([], schemas.STORED_LEAF)
    stored = seeding.upsert_leaves(empty, old)
    return seeding.upsert_leaves(stored, new)


def pipeline_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.leaves(spark, sf_dir)
    return found.select(
        "id",
        "label",
        "difficulty",
        leaf_label(F.col("id")).alias("last_part"),
        F.array_join(query_terms(F.col("label")), "|").alias("terms"),
    )


def _part_prompts(spark, sf_dir, low, high, version) -> DataFrame:
    """Parts as prompt documents whose fields are often missing."""
    p = inputs.table(spark, sf_dir, "part").filter(F.col("p_size").between(low, high))
    size = F.col("p_size")
    docs = p.select(
        F.when(size != 25, F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name"))).alias(
            "prompt_id"
        ),
        F.when(size % 2 == 0, F.lit("mcq")).alias("prompt_type"),
        F.when(size % 3 == 0, F.col("p_name")).alias("description"),
        F.when(size % 5 != 0, F.concat(F.col("p_type"), F.lit(" {n}"))).alias("template"),
        F.when(size % 7 != 0, F.lit(r"Q\d+")).alias("parser_regex"),
        F.lit(version).alias("version"),
        F.col("p_partkey").alias("load_order"),
    )
    return seeding.latest_prompts(seeding.valid_prompts(docs))


def prompt_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _part_prompts(spark, sf_dir, 1, 30, 1.0)
    return merge_fields(stored, _part_prompts(spark, sf_dir, 20, 50, 2.0), "prompt_id")


def prompt_upsert_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _part_prompts(spark, sf_dir, 1, 30, 1.0)
    incoming = _part_prompts(spark, sf_dir, 20, 50, 1.0)
    return upsert_counts(stored, incoming, "prompt_id")


# --- generation -------------------------------------------------------------------


def _several_mcqs(spark, sf_dir) -> DataFrame:
    """A model's reply per document: its question twice, with another in between."""
    q = inputs.questions(spark, sf_dir)
    between = F.concat(
        F.lit("\n\nQ2. In between?\n(1) "), F.col("taxonomy_id"), F.lit("\n(2) no\nAnswer: 3\n\n")
    )
    raw = F.concat(F.lit("Here they are.\n"), F.col("q_raw"), between, F.col("q_raw"))
    return q.select(F.col("pos").alias("doc_id"), "taxonomy_id", raw.alias("raw"))


def mcq_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = _several_mcqs(spark, sf_dir)
    found = with_computed(replies, "blocks", mcq.extract_blocks(F.col("raw")))
    blocks = found.select("doc_id", F.posexplode("blocks").alias("pos", "block"))
    return blocks.select(_long("doc_id").alias("doc_id"), _long("pos").alias("pos"), "block")


def mcq_extract_custom_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every template's pattern on replies assigned to it."""
    names = F.array(*[F.lit(f"mcq_{r}") for r in REGIONS])
    replies = _several_mcqs(spark, sf_dir).withColumn(
        "prompt_id", F.get(names, F.pmod("doc_id", F.lit(len(REGIONS))))
    )
    templated = generate.with_template(replies, inputs.prompts(spark, sf_dir))
    parsed = generate.parse_replies(
        templated.withColumn("taxonomy_id", F.col("doc_id").cast("string"))
    )
    return parsed.select(
        _long("taxonomy_id").alias("doc_id"), F.posexplode("mcqs").alias("pos", "block")
    ).select("doc_id", _long("pos").alias("pos"), "block")


REGIONS = ["africa", "america", "asia", "europe", "middle east"]


def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a one-passage bundle, rendered with one of the templates."""
    docs = inputs.table(spark, sf_dir, "documents")
    passage = F.struct(
        F.col("doc_id").alias("chunk_id"), "doc_id", "text", F.lit(1.0).alias("score")
    )
    rows = docs.select(
        F.concat(F.lit("Corpus."), F.col("source"), F.lit("."), F.col("doc_id").cast("string")).alias(
            "taxonomy_id"
        ),
        F.array(passage, passage).alias("passages"),
        F.when(F.col("lang") == "en", "M").alias("difficulty"),
        F.concat(
            F.lit("mcq_"),
            F.when(F.col("lang") == "fr", "europe").when(F.col("lang") == "en", "asia").otherwise(
                "unknown"
            ),
        ).alias("prompt_id"),
    )
    done = generate.render_prompts(rows, inputs.prompts(spark, sf_dir), n=5)
    return done.select("taxonomy_id", "prompt", "problem")


def stub_generator():
    """Stands for a model client: text, an error text or an exception by prompt length."""

    def generate_text(prompt):
        n = len(prompt)
        if n % 5 == 0:
            raise TimeoutError("no reply")
        if n % 5 == 1:
            return "Error: 503"
        return (
            f" Sure.\nQ1. About {n}?\n(1) yes\n(2) no\nAnswer: 2\n\n"
            f"Q2. Is {n} odd?\n(1) yes\n(2) no\nAnswer: {2 - n % 2}\n"
        )

    return generate_text


def _generated(spark, sf_dir, generator=None):
    bundles_ = _document_bundles(spark, sf_dir)
    done = inputs.table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("taxonomy_id")
    )
    return generate.generate_questions(
        bundles_,
        inputs.prompts(spark, sf_dir),
        generator or text_model(stub_generator),
        done,
        prompt_id="mcq_asia",
    )


def _document_bundles(spark, sf_dir) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    passage = F.struct(
        F.col("doc_id").alias("chunk_id"), "doc_id", "text", F.lit(1.0).alias("score")
    )
    return docs.select(
        F.col("doc_id").cast("string").alias("taxonomy_id"), F.array(passage).alias("passages")
    )


def skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = inputs.table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("taxonomy_id")
    )
    return generate.pending_bundles(_document_bundles(spark, sf_dir), done).select("taxonomy_id")


def generated_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, _ = _generated(spark, sf_dir)
    return sets.select("taxonomy_id", F.posexplode("mcqs").alias("pos", "q_raw")).select(
        "taxonomy_id", _long("pos").alias("pos"), "q_raw"
    )


def _failing_generator():
    def generate_text(prompt):
        raise TimeoutError("no reply")

    return generate_text


def generation_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose model fails every call, after one whose replies are in the journal."""
    journal = ReplyJournal(new_folder(spark, "journal"))
    for make in (stub_generator, _failing_generator):
        sets, _ = _generated(spark, sf_dir, text_model(make, name="stub", journal=journal))
    return sets.select("taxonomy_id", F.posexplode("mcqs").alias("pos", "q_raw")).select(
        "taxonomy_id", _long("pos").alias("pos"), "q_raw"
    )


def generation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, status = _generated(spark, sf_dir)
    return generate.status_lines(status)


def generation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, status = _generated(spark, sf_dir)
    return generate.status_counts(status)


def _stub_client():
    def reply(prompt):
        if len(prompt) % 3 == 0:
            raise ValueError(f"{len(prompt)} characters")
        return f"  {len(prompt)} characters, {len(prompt.split())} words\n"

    return reply


def batch_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.table(spark, sf_dir, "conversations")
    asked = turns.select("conv_id", "turn", text_model(_stub_client)(F.col("text")).alias("r"))
    return asked.select("conv_id", "turn", "r.raw", "r.error")


# --- questions and answers --------------------------------------------------------


def mcq_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = review.parsed_questions(inputs.questions(spark, sf_dir))
    return parsed.select(
        _long("pos").alias("pos"),
        "question",
        F.array_join("options", "|").alias("options"),
        "answer_text",
        "answer_number",
    )


def answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = panel.with_keys(inputs.questions(spark, sf_dir))
    return keyed.select(_long("pos").alias("pos"), _long("correct").alias("correct"))


def model_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = inputs.responses(spark, sf_dir)
    return replies.select(
        _long("pos").alias("pos"),
        "model",
        _long(mcq.model_choice(F.col("raw"))).alias("any_choice"),
        _long(mcq.panel_choice(F.col("raw"))).alias("choice"),
    )


def judge_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = inputs.questions(spark, sf_dir)
    return q.select(
        _long("pos").alias("pos"),
        mcq.judge_prompt(F.col("q_raw"), inputs.INSTRUCTIONS).alias("prompt"),
    )


def question_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    stems = rag.question_stems(inputs.questions(spark, sf_dir), limit=None)
    return stems.select(_long("pos").alias("pos"), "query")


def first_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling step: stems of the first fifteen questions by file and position."""
    stems = rag.question_stems(inputs.questions(spark, sf_dir), limit=15)
    return stems.select("file_path", _long("pos").alias("pos"), "query")


def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages")
    padded = F.concat(F.lit("\t\n  "), F.col("html"), F.lit(" \r\n "))
    return pages.select("page_id", strip(padded).alias("html"))


# --- panel ------------------------------------------------------------------------


def _panel(spark, sf_dir):
    return grade_responses(
        inputs.questions(spark, sf_dir),
        inputs.responses(spark, sf_dir),
        [*inputs.PANEL, inputs.SILENT_MODEL],
    )


def panel_model_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir).summary()


def panel_question_difficulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _panel(spark, sf_dir).per_question()
    return report.withColumn("pos", _long("pos")).withColumn("correct", _long("correct"))


def panel_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions without any panel model: nothing answered, hardest tag."""
    q = inputs.questions(spark, sf_dir)
    none = grade_responses(q, inputs.responses(spark, sf_dir), []).per_question()
    return none.select(
        "file_path", _long("pos").alias("pos"), "total_models", "correct_ratio", "difficulty_tag"
    )


def panel_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel.graded(inputs.questions(spark, sf_dir), inputs.responses(spark, sf_dir))
    return rows.select("file_path", _long("pos").alias("pos"), "model", "outcome")


def panel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report lines next to the number of all questions, gradable or not."""
    q = inputs.questions(spark, sf_dir)
    total = q.groupBy().agg(F.lit("total_questions").alias("model"), F.count("*").alias("n"))
    lines = _panel(spark, sf_dir).lines()
    counted = total.select("model", F.col("n").cast("string").alias("line"))
    return lines.unionByName(counted)


def panel_debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _panel(spark, sf_dir).debug()
    opened = rows.select(
        "file",
        _long("pos").alias("pos"),
        F.col("error").alias("question_error"),
        F.explode_outer("models").alias("model", "a"),
    )
    return opened.select(
        "file",
        "pos",
        "question_error",
        "model",
        _long("a.answer").alias("answer"),
        _long("a.correct").alias("correct"),
        "a.raw",
    )


def _stub_judge(i: int):
    """Stands for a judge that answers, gives up or fails by prompt length."""

    def make_client():
        def judge(prompt):
            n = len(prompt) + i
            if n % 7 == 0:
                raise ConnectionError("reset")
            return "no idea" if n % 7 == 1 else f" Answer: {n % 4 + 1}\n"

        return judge

    return make_client


def panel_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of a panel of clients, one of them switched off."""
    judges = [
        Judge(m, _stub_judge(i), enabled=m != inputs.PANEL[-1])
        for i, m in enumerate(inputs.PANEL)
    ]
    asked = ask_panel(inputs.questions(spark, sf_dir), judges, inputs.INSTRUCTIONS)
    return asked.select("file_path", _long("pos").alias("pos"), "model", "raw")


def _failing_judge():
    def judge(prompt):
        raise ConnectionError("reset")

    return judge


def panel_asked_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel that fails every call, after one whose replies are in the journal."""
    journal = ReplyJournal(new_folder(spark, "journal"))
    q = inputs.questions(spark, sf_dir)
    makers = [_stub_judge(i) for i in range(len(inputs.PANEL) - 1)]
    for clients in (makers, [lambda: _failing_judge()] * len(makers)):
        judges = [Judge(m, make) for m, make in zip(inputs.PANEL, clients)]
        asked = ask_panel(q, judges, inputs.INSTRUCTIONS, journal=journal)
    return asked.select("file_path", _long("pos").alias("pos"), "model", "raw")


def panel_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written as one JSON object and read back."""
    path = _new_folder(spark)
    files.write_document(_panel(spark, sf_dir).document(), path)
    counts = "correct LONG, incorrect LONG, unanswered LONG, total LONG, accuracy DOUBLE"
    document = spark.read.schema(f"total_questions LONG, models MAP<STRING, STRUCT<{counts}>>")
    opened = document.json(path).select("total_questions", F.explode("models").alias("model", "m"))
    return opened.select("total_questions", "model", "m.*")


# --- files ------------------------------------------------------------------------


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/quizloom-{uuid.uuid4().hex}"


def index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index built, left alone by a second build, and read back."""
    path = _new_folder(spark)
    index.build_index(inputs.corpus(spark, sf_dir), path, inputs.embed)
    built = index.build_index(inputs.corpus(spark, sf_dir).limit(0), path, inputs.embed)
    total = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return built.select("chunk_id", "doc_id", "text", F.round(total, 4).alias("total"))


def bundle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_folder(spark)
    files.write_json(_document_bundles(spark, sf_dir), path)
    read = files.read_bundles(spark, path)
    return read.select(
        "taxonomy_id", "difficulty", F.explode("passages").alias("p")
    ).select("taxonomy_id", "difficulty", "p.*")


def question_set_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question sets written, a second run's sets appended, all read and flattened."""
    path = _new_folder(spark)
    replies = _several_mcqs(spark, sf_dir).select(
        F.concat(F.lit("Set."), F.col("doc_id").cast("string")).alias("taxonomy_id"), "raw"
    )
    sets = replies.select("taxonomy_id", mcq.extract_blocks(F.col("raw")).alias("mcqs"))
    files.write_json(sets, path)
    empty = replies.select(F.concat("taxonomy_id", F.lit(".empty")).alias("taxonomy_id"))
    files.write_json(empty.withColumn("mcqs", F.array().cast("array<string>")), path, "append")
    questions = files.explode_questions(files.read_question_sets(spark, path))
    name = F.substring_index("file_path", "/", -1).alias("file_name")
    return questions.select(name, "taxonomy_id", _long("pos").alias("pos"), "q_raw")


def review_sheet_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review sheet written as CSV and read back, with the order of its lines."""
    path = _new_folder(spark)
    files.write_sheet(review.review_sheet(inputs.questions(spark, sf_dir), inputs.SEED), path)
    lines = row_positions(spark.read.option("lineSep", "\r\n").text(path), "place")
    header = lines.filter("place = 0").first()["value"].split(",")
    schema = ", ".join(f"`{name}` STRING" for name in header)
    row = F.from_csv("value", schema, {"quote": '"', "escape": '"'})
    sheet = lines.filter("place > 0").select((F.col("place") - 1).alias("position"), row.alias("row"))
    cells = [F.coalesce(F.col("row")[c], F.lit("")).alias(c) for c in header]
    return sheet.select("position", *cells)


def leaf_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into a versioned store, and the pipeline's view of the newest."""
    path = _new_folder(spark)
    docs = inputs.taxonomies(spark, sf_dir)
    for part in (docs.filter(F.col("p_size") <= 30), docs.filter(F.col("p_size") >= 20)):
        stored = read_store(spark, path, schemas.STORED_LEAF)
        write_store(seeding.upsert_leaves(stored, seeding.flatten_leaves(part)), path)
    return seeding.read_leaves(spark, path)


# --- review sheet and RAG evaluation ----------------------------------------------


def shuffle_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = inputs.questions(spark, sf_dir)
    placed = shuffled_positions(q, inputs.SEED, review.row_key())
    return placed.select("file_path", _long("pos").alias("pos"), "position")


def review_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = materialise(review.parsed_questions(inputs.questions(spark, sf_dir)))
    width = review.widest(parsed).first()["max_options"]
    placed = shuffled_positions(parsed, inputs.SEED, review.row_key())
    return review.widen(placed, width, "position")


def widest_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = review.widest(review.parsed_questions(inputs.questions(spark, sf_dir)))
    return found.select(_long("max_options").alias("max_options"))


def stub_answerer():
    """Stands for a model: the question's words the context knows, and one it may not."""

    def answer(question, context):
        known = set(context.lower().split())
        return " ".join([w for w in question.lower().split() if w in known] + ["hence"])

    return answer


def rag_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as questions, some of them without options."""
    items = inputs.table(spark, sf_dir, "benchmark")
    q_raw = F.concat(
        F.lit("Q"),
        F.col("item_id").cast("string"),
        F.lit(". "),
        F.col("text"),
        F.when(F.col("item_id") % 9 == 4, "\nno options").otherwise("\n -(1) yes\n(2) no\nAnswer: 1"),
    )
    return items.select(
        F.lit("items.json").alias("file_path"),
        F.lit("Items").alias("taxonomy_id"),
        F.col("item_id").cast("int").alias("pos"),
        q_raw.alias("q_raw"),
    )


def rag_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as questions over the documents."""
    q = rag_questions(spark, sf_dir)
    graded = rag.evaluate_rag(
        q, inputs.index(spark, sf_dir), inputs.embed, text_model(stub_answerer)
    )
    return graded.withColumn("pos", _long("pos"))


QUERIES = {
    f.__name__: f
    for f in (
        corpus_filter,
        dense_chunk_ids,
        hash_embed,
        topk_retrieval,
        topk_retrieval_grid,
        topk_few_vectors,
        topk_groups,
        topk_equal_queries,
        score_check,
        retrieve_with_text,
        retrieve_with_text_ranges,
        retrieve_with_text_salted,
        bundles,
        leaf_flatten,
        leaf_flatten_legacy,
        leaf_upsert,
        pipeline_leaves,
        prompt_upsert,
        prompt_upsert_report,
        mcq_extract,
        mcq_extract_custom_regex,
        prompt_render,
        skip_existing,
        generated_questions,
        generation_resumed,
        generation_status,
        generation_counts,
        batch_inference,
        mcq_parse,
        answer_key,
        model_answer,
        judge_prompt,
        question_stem,
        first_stems,
        strip_text,
        panel_model_accuracy,
        panel_question_difficulty,
        panel_empty,
        panel_outcomes,
        panel_summary,
        panel_debug,
        panel_asked,
        panel_asked_again,
        panel_document,
        index_files,
        bundle_files,
        question_set_files,
        review_sheet_csv,
        leaf_store,
        shuffle_order,
        review_sheet,
        widest_options,
        rag_eval,
    )
}
