"""Engine inputs derived from the driver's tables.

The tables hold no questions or model replies, so both are written from their columns:
whole document texts become question stems, part rows become taxonomy leaves, region
rows become prompt templates. :mod:`quizloom.checks.oracle` builds the same in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions.vectors import hash_embedder
from quizloom.operators.storage import new_folder
from quizloom.operators.upsert import last_rows
from quizloom.plans.index import embed_corpus
from quizloom.plans.seeding import flatten_leaves, pipeline_leaves
from quizloom.sources.corpus import read_index, write_index

PANEL = ["alder", "birch", "cedar", "elm", "fir", "hazel", "larch", "maple"]
SILENT_MODEL = "willow"
SEED = 7
INSTRUCTIONS = "Pick the one correct option.\nReply with 'Answer: X' only."
EMBED_DIM = 64
embed = hash_embedder(EMBED_DIM)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' index, stored as in real use."""
    path = new_folder(spark, "index")
    write_index(embed_corpus(corpus(spark, sf_dir), embed), path, in_order=True)
    return read_index(spark, path)


def options_text(lang: Column, source: Column, n_chars: Column) -> Column:
    """Two to six option lines."""
    extra = F.array(
        *[F.concat(F.lit(f"({i}) about {i}00 of "), n_chars.cast("string")) for i in range(3, 7)]
    )
    lines = F.concat(
        F.array(F.concat(F.lit("(1) "), lang), F.concat(F.lit("(2)  "), source)),
        F.slice(extra, F.lit(1), F.pmod(n_chars, F.lit(5)).cast("int")),
    )
    return F.array_join(lines, "\n")


def answer_text(n_chars: Column) -> Column:
    kind = F.pmod(n_chars, F.lit(11))
    return (
        F.when(kind == 0, "Answer: C")
        .when(kind == 1, "answer: because")
        .when(kind == 2, "Answer: 9")
        .when(kind == 3, "Answer: G")
        .when(kind == 4, "The key is missing")
        .when(kind == 5, "Answer: 12")
        .otherwise(F.concat(F.lit("Answer: "), (F.pmod(n_chars, F.lit(4)) + 1).cast("string")))
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per document, its whole text the stem; a source is one file."""
    d = table(spark, sf_dir, "documents")
    q_raw = F.concat(
        F.lit("Q"),
        F.col("doc_id").cast("string"),
        F.lit(". "),
        F.col("text"),
        F.lit("\n"),
        options_text(F.col("lang"), F.col("source"), F.col("n_chars")),
        F.lit("\n"),
        answer_text(F.col("n_chars")),
    )
    return d.select(
        F.concat(F.col("source"), F.lit(".json")).alias("file_path"),
        F.concat(F.lit("Corpus."), F.col("lang"), F.lit("."), F.col("source")).alias(
            "taxonomy_id"
        ),
        F.col("doc_id").cast("int").alias("pos"),
        q_raw.alias("q_raw"),
    )


def reply_text(kind: Column, pick: Column) -> Column:
    pick = pick.cast("string")

    def around(before, after=""):
        return F.concat(F.lit(before), pick, F.lit(after))

    return (
        F.when(kind == 0, "Error: timeout")
        .when(kind == 1, "")
        .when(kind == 2, around("5 it is not.\nanswer: "))
        .when(kind == 3, around("<final_answer> ", " </final_answer>"))
        .when(kind == 4, around("The correct option is (", ")"))
        .when(kind == 5, around("The final answer is ", "."))
        .when(kind == 6, around("After thought:\n  (", ") looks right"))
        .when(kind == 7, around("maybe ", " or 8"))
        .when(kind == 8, "12 monkeys, no choice")
        .otherwise(around("My choice is ((", "))"))
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight models' replies to every question, gradable or not."""
    models = F.array(
        *[F.struct(F.lit(m).alias("model"), F.lit(i).alias("i")) for i, m in enumerate(PANEL)]
    )
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "n_chars", F.explode(models).alias("m")
    )
    i = F.col("m.i")
    kind = F.pmod(F.col("doc_id") * 31 + F.col("n_chars") + i * 17, F.lit(13))
    pick = F.pmod(F.col("n_chars") + F.floor((F.col("doc_id") + i) / 2), F.lit(4)) + 1
    return d.select(
        F.concat(F.col("source"), F.lit(".json")).alias("file_path"),
        F.col("doc_id").cast("int").alias("pos"),
        F.col("m.model").alias("model"),
        reply_text(kind, pick).alias("raw"),
    )


def taxonomies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a one-leaf taxonomy document, loaded in key order."""
    p = table(spark, sf_dir, "part")
    topic = F.concat(
        F.lit("§ "), F.col("p_name"), F.lit(" – "), F.col("p_type"), F.lit(" – use")
    )
    size = F.col("p_size")
    difficulty = F.when(size > 33, "H").when(size > 16, "M").otherwise("E")
    item = F.struct(topic.alias("topic"), difficulty.alias("difficulty"))
    category = F.replace(F.col("p_brand"), F.lit("#"), F.lit(" # "))
    doc = F.struct(
        F.lit("Parts").alias("domain"),
        F.create_map(category, F.array(item)).alias("categories"),
    )
    return p.select(
        F.lpad(F.col("p_partkey").cast("string"), 15, "0").alias("path"),
        F.lit(0).alias("format_rank"),
        doc.alias("doc"),
        size.alias("p_size"),
    )


def leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline leaves: the last load of each leaf id."""
    flat = flatten_leaves(taxonomies(spark, sf_dir))
    return pipeline_leaves(last_rows(flat, "leaf_id", F.col("load_order")))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region as a prompt template; one pattern has the class ``[1-12]``.

    The fourth has a named group and an open repetition, the fifth two groups.
    """
    r = table(spark, sf_dir, "region")
    name = F.col("r_name")
    template = F.concat(
        F.lit("Write {n} {diff_tag} questions about *{leaf_label}* for "),
        name,
        F.lit(".\n{{keep}} ({options}-1) None\n---\n{context}\n---"),
    )
    key = F.col("r_regionkey")
    pattern = (
        # Fixed value: the class [1-12] means 1 or 2.
        F.when(key == 0, r"Q\d+\..+?Answer:\s*[1-12]")
        .when(key == 1, r"Q\d+\.(.+?)Answer:\s*[1-8]")
        .when(key == 2, F.lit(None).cast("string"))
        .when(key == 3, r"Q(?P<no>\d{1,2})\d{,9}\.[^?]+Answer:\s*\d+")
        .otherwise(r"(Q\d+)\..+?Answer:\s*([A-F0-8])")
    )
    return r.select(
        F.concat(F.lit("mcq_"), F.lower(name)).alias("prompt_id"),
        F.lit("mcq").alias("prompt_type"),
        F.concat(F.lit("for "), name).alias("description"),
        template.alias("template"),
        pattern.alias("parser_regex"),
        key.cast("string").alias("version"),
    )
