"""Ranges of keys whose bounds are found on narrow rows before wide rows move.

Sorting or range-partitioning a plan makes Spark run it twice, once to sample its keys.
Where a plan calls models, or moves texts, its keys are cut into ranges beforehand; a row
then finds its range by halving, and one exchange by that number brings every range
together without looking at a row again.
"""

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One range of keys is one row on the driver and one task.
MAX_RANGES = 100_000


@dataclass(frozen=True)
class KeyRanges:
    """Neighbouring ranges of a key, the lowest first."""

    columns: list[str]
    key_type: str
    # The first key of each range as JSON, and what the keys in it weigh together.
    firsts: list[str]
    weights: list[int]

    def __len__(self) -> int:
        return max(1, len(self.firsts))

    @property
    def starts(self) -> list[int]:
        """Weight of all lower ranges, for each range."""
        return [0, *accumulate(self.weights)][: len(self)]

    def number(self) -> Column:
        """The number of a row's range: the last whose first key is not above the row's."""
        if len(self) == 1:
            return F.lit(0)
        firsts = _array(self.firsts, self.key_type)
        key = F.struct(*self.columns).cast(self.key_type)
        steps = F.lit([1 << bit for bit in reversed(range(len(self).bit_length()))])

        def halve(low, step):
            return F.when(F.get(firsts, low + step) <= key, low + step).otherwise(low)

        return F.aggregate(steps, F.lit(0), halve)

    def start(self, number: Column) -> Column:
        """Weight of all ranges below range ``number``."""
        return F.get(_array(map(str, self.starts), "BIGINT"), number)

    def gather(self, rows: DataFrame, name: str, *ties: str) -> DataFrame:
        """``rows`` in as many partitions as ranges, each in order; ``name`` is the range.

        Rows move once and are computed once.
        """
        dealt = rows.withColumn(name, self.number()).repartitionById(len(self), name)
        return dealt.sortWithinPartitions(*self.columns, *ties)


def _array(values, kind: str) -> Column:
    """A constant array; one literal however long it is."""
    return F.from_json(F.lit(f"[{','.join(values)}]"), f"ARRAY<{kind}>")


def cut_ranges(
    keys: DataFrame, columns: list[str], rows_per_range: int, weight: Column | None = None
) -> KeyRanges:
    """About evenly filled ranges of ``columns``; equal keys are never parted.

    ``keys`` is read twice, so pass narrow, stored rows. Only one row per range comes to
    the driver, ``MAX_RANGES`` at most; beyond that ranges are longer.
    """
    weight = F.lit(1) if weight is None else weight
    named = keys.select(F.struct(*columns).alias("key"), weight.cast("bigint").alias("weight"))
    kind = named.schema["key"].dataType.simpleString()
    total = named.agg(F.count("*").alias("rows"), F.sum("weight").alias("weight")).first()
    count = min(MAX_RANGES, -(-total["rows"] // rows_per_range))
    if count <= 1:
        return KeyRanges(columns, kind, [], [total["weight"] or 0])
    ranged = named.repartitionByRange(count, "key").groupBy(F.spark_partition_id().alias("range"))
    found = ranged.agg(F.to_json(F.min("key")).alias("first"), F.sum("weight").alias("weight"))
    rows = sorted(found.collect(), key=lambda row: row["range"])
    return KeyRanges(columns, kind, [r["first"] for r in rows], [r["weight"] for r in rows])


def place_in_partition() -> Column:
    """A row's 0-based place in its partition, in the order in which rows come."""
    return F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
