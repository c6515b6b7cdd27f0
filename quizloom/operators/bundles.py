"""Context bundles: a leaf with its best passages."""

import functools
from collections.abc import Callable
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.operators.storage import materialise, new_folder, open_path

# Bytes of ids that may be broadcast.
ID_BYTES = 64 << 20
_BYTES_PER_ID = 16
# Ids in a bitmap, as Spark's bitmap functions have it, and bitmaps in a file.
BITMAP_IDS = 1 << 15
BITMAPS_PER_FILE = 1 << 10


def with_text(
    hits: DataFrame, chunks: DataFrame, key: str = "chunk_id", id_bytes: int = ID_BYTES
) -> DataFrame:
    """Fetch the chunk of each ranked hit, after top-k has cut them down.

    ``key`` is a non-negative integer that both sides have. The chunks are scanned once
    however many winners there are, and texts that did not win never move. Few winners go
    to the scan as a list of ids. More than ``id_bytes`` of them become bitmaps, 32,768 ids
    each, in the shared folder; a task of the scan reads those of the ids it meets. The
    winning texts are then joined with the hits.
    """
    hits = materialise(hits)
    columns = [c for c in ("chunk_id", "doc_id", "text") if c == key or c not in hits.columns]
    chunks = chunks.select(*columns)
    ids = hits.select(F.col(key).cast("bigint").alias(key)).distinct()
    if ids.count() * _BYTES_PER_ID <= id_bytes:
        found = chunks.join(F.broadcast(ids), key, "left_semi")
    else:
        found = chunks.filter(is_member(write_bitmaps(ids, key))(F.col(key)))
    return hits.join(found, key)


def write_bitmaps(ids: DataFrame, key: str) -> str:
    """Store a set of non-negative ids as bitmaps; returns the folder.

    A file holds the bitmaps of ``BITMAPS_PER_FILE`` neighbouring buckets.
    """
    place = F.col(key) + 1
    bits = ids.select(
        F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")
    )
    maps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    part = F.expr(f"(bucket - 1) div {BITMAPS_PER_FILE}").alias("part")
    folder = new_folder(ids.sparkSession, "bitmaps")
    by_part = maps.select("*", part).repartition("part").sortWithinPartitions("part")
    by_part.write.partitionBy("part").parquet(folder)
    return folder


def is_member(folder: str) -> Callable:
    """Column function id -> whether the stored set has it. Only the id goes to Python."""

    @F.arrow_udf("boolean")
    def member(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        part_of = functools.lru_cache(maxsize=2)(lambda part: _bitmaps(folder, part))
        for batch in batches:
            ids = np.asarray(batch.cast(pa.int64()).fill_null(-1))
            found = np.zeros(len(ids), dtype=bool)
            buckets = ids // BITMAP_IDS
            for bucket in np.unique(buckets[ids >= 0]).tolist():
                bits = part_of(bucket // BITMAPS_PER_FILE).get(bucket)
                if bits is not None:
                    rows = np.flatnonzero(buckets == bucket)
                    place = ids[rows] % BITMAP_IDS
                    found[rows] = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            yield pa.array(found)

    return member


def _bitmaps(folder: str, part: int) -> dict[int, np.ndarray]:
    system, name = open_path(f"{folder}/part={part}")
    selector = FileSelector(name, allow_not_found=True)
    found = {}
    for info in system.get_file_info(selector):
        if info.base_name.startswith((".", "_")):
            continue
        table = pq.read_table(system.open_input_file(info.path))
        for bucket, bits in zip(table["bucket"].to_pylist(), table["bits"]):
            found[bucket - 1] = np.frombuffer(bits.as_buffer(), dtype=np.uint8)
    return found


def collect_passages(hits: DataFrame, key: str) -> DataFrame:
    """One row per key with its passages, best first; a key has at most k of them."""
    fields = ("chunk_id", "doc_id", "text", "score")
    ranked = F.sort_array(F.collect_list(F.struct("rank", F.struct(*fields).alias("p"))))
    return hits.groupBy(key).agg(F.transform(ranked, lambda r: r["p"]).alias("passages"))


def context(passages: Column) -> Column:
    """Passage texts in rank order, a blank line between them."""
    return F.array_join(F.transform(passages, lambda p: p["text"]), "\n\n")
