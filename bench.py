"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8)
the local cores. The tables are single small files, which one task would read; they are
first copied, untimed, into as many files as there are cores, as large tables have many.
Each query is built and fully computed once, then timed on a second run, so the figure
leaves out JVM and worker start-up.
"""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from quizloom.checks.registry import QUERIES

HEADLINE = [
    "corpus_filter",
    "dense_chunk_ids",
    "hash_embed",
    "topk_retrieval",
    "retrieve_with_text",
    "bundles",
    "leaf_upsert",
    "prompt_upsert",
    "mcq_extract",
    "prompt_render",
    "generated_questions",
    "batch_inference",
    "mcq_parse",
    "model_answer",
    "judge_prompt",
    "panel_model_accuracy",
    "panel_question_difficulty",
    "panel_debug",
    "review_sheet",
    "rag_eval",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def spread_tables(spark: SparkSession, sf_dir: str, folder: str, files: int) -> str:
    """A copy of the tables in several files each; its folder ends in the same name."""
    copy = f"{folder}/{os.path.basename(sf_dir.rstrip('/'))}"
    for name in sorted(os.listdir(sf_dir)):
        table = spark.read.parquet(f"{sf_dir}/{name}")
        table.repartition(files).write.parquet(f"{copy}/{name}")
    return copy


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="quizloom-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quizloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"file://{work}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = spread_tables(spark, sf_dir, f"{work}/tables", int(cpus))
    seconds = {}
    for name in HEADLINE:
        run(spark, name, tables)
        seconds[name] = round(run(spark, name, tables), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds_warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
