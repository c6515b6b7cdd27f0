"""Mixing sources to target weights by hierarchical token budgets.

Documents are the leaves of a tree: domain, language, source. A total budget of tokens
is passed down by weights. A node never gets more than its documents hold in
``max_epochs`` passes; what it cannot take goes to its siblings by their weights, and
only when a whole family is full does its parent's family take the rest. Each leaf then
reads its documents in a seeded order, a new order per epoch, and keeps the longest
prefix of that reading that fits its budget: some whole epochs and the beginning of one.

Budgets are computed on one row per node. The prefix ends at one document per leaf,
found from token sums of small ranges of the order, so that a leaf with most of all rows
is no more work for one task than any other. Texts do not move: each row is compared to
the end of its leaf's prefix.

Tokens are words. All of it is DataFrame code.

Defined results: a NULL domain, language or source is a node of its own. NULL text has no
tokens. A row with no tokens goes with the row before it in the reading. Rows that repeat both doc_id and text are
read together, all or none. Nodes without a weight have the weight ``other``; weights are
positive. Other columns stay; ``domain`` and ``epoch`` are added.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.text import hide, word_count
from quizloom.operators.storage import materialise

SEED = 20_251
MAX_EPOCHS = 2
# Documents in one range of a leaf's order, and ranges in one group of ranges.
RANGE_ROWS = 4096
GROUP_RANGES = 1024

LEVELS = ("domain", "lang", "source")
# Target weights of the registered query, whole numbers. Sources weigh the same.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"domain0": 40, "domain1": 30, "domain2": 20, "domain3": 10},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
    "source": {},
}
OTHER = 1
DOMAINS = 4


def source_domain(source: Column) -> Column:
    """The domain of a source: its number modulo four; none without a number."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(
        number != "", F.concat(F.lit("domain"), (number.cast("int") % DOMAINS).cast("string"))
    )


def _weight(level: str, weights: Mapping[str, Mapping[str, int]], other: int) -> Column:
    value = F.lit(other)
    for name, weight in weights.get(level, {}).items():
        value = F.when(F.col(level).eqNullSafe(F.lit(name)), weight).otherwise(value)
    return value.cast("bigint")


def share_out(children: DataFrame, family: list[str], order: list[str]) -> DataFrame:
    """Budgets of all children from their families' budgets.

    ``children`` has ``w`` (weight), ``cap`` (most it can take) and ``family_budget``.
    In rising order of cap per weight, a child is full if its cap is at most its share
    of what the children before it left; the others share the rest by weight.
    """
    rows = children.withColumn("_ratio", F.col("cap") / F.col("w"))
    inside = Window.partitionBy(*family).orderBy("_ratio", *order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    onward = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn(
        "_left", F.col("family_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ).withColumn("_weights", F.sum("w").over(onward))
    # Products of two token counts need more than 64 bits.
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("cap", "w", "_left", "_weights")}
    full = (F.col("_left") > 0) & (wide["cap"] * wide["_weights"] <= wide["w"] * wide["_left"])
    # Once one child is not full, no later one is.
    rows = rows.withColumn("_full", full)
    everyone = Window.partitionBy(*family)
    taken = F.sum(F.when(F.col("_full"), F.col("cap"))).over(everyone)
    open_weight = F.sum(F.when(~F.col("_full"), F.col("w"))).over(everyone)
    rest = F.col("family_budget") - F.coalesce(taken, F.lit(0))
    return (
        rows.withColumn("_rest", rest)
        .withColumn("_open", open_weight)
        .withColumn(
            "budget",
            F.when(F.col("_full"), F.col("cap")).otherwise(
                F.expr("cast(w as decimal(19,0)) * cast(_rest as decimal(19,0)) div _open")
            ),
        )
        .drop("_ratio", "_left", "_weights", "_full", "_rest", "_open")
    )


def leaf_budgets(
    leaves: DataFrame,
    budget: int,
    weights: Mapping[str, Mapping[str, int]],
    levels: tuple[str, ...] = LEVELS,
    max_epochs: int = MAX_EPOCHS,
    other: int = OTHER,
) -> DataFrame:
    """``leaves`` (levels, tokens, docs) with the ``budget`` of each."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    above = None
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("w", _weight(level, weights, other))
        if above is None:
            nodes = nodes.withColumn("family_budget", F.least(F.lit(budget), F.sum("cap").over(Window.partitionBy(F.lit(0)))))
            family = []
        else:
            up = above.select(*[F.col(c).alias(f"_{c}") for c in path[:-1]], F.col("budget").alias("family_budget"))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in path[:-1]]
            nodes = nodes.join(up, same).drop(*[f"_{c}" for c in path[:-1]])
            family = path[:-1]
        above = share_out(nodes, family or [F.lit(0)], [level])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in levels]
    found = above.select(*[F.col(c).alias(f"_{c}") for c in levels], "budget")
    return leaves.join(found, same).drop(*[f"_{c}" for c in levels])


def _epoch_order(seed: int, epoch: Column, row: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), row))


def _row_digest() -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))


def _range_of(order: Column, ranges: Column) -> Column:
    """Even ranges of the order, by its leading 32 bits."""
    lead = F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint")
    return F.shiftright(lead * ranges, 32)


def prefix_ends(rows: DataFrame, leaves: DataFrame, seed: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``leaf, whole, last``: whole epochs of each leaf, and the order of the last row of
    the epoch after them that still fits. ``last`` is NULL if none does.

    ``rows`` are ``leaf, row, tokens``; ``leaves`` are ``leaf, tokens, docs, budget``.
    """
    plan = leaves.select(
        "leaf",
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(F.lit(0)).alias("part"),
        F.greatest(F.lit(1), F.expr(f"docs div {range_rows}")).alias("ranges"),
    )
    ordered = rows.join(plan, "leaf").filter("part > 0")
    ordered = ordered.withColumn("order", _epoch_order(seed, F.col("whole"), F.col("row")))
    ordered = ordered.withColumn("range", _range_of(F.col("order"), F.col("ranges")))
    sums = materialise(
        ordered.groupBy("leaf", "part", "range").agg(F.sum("tokens").alias("n"))
    ).withColumn("group", F.expr(f"range div {GROUP_RANGES}"))
    groups = sums.groupBy("leaf", "group").agg(F.sum("n").alias("n"))

    def lower(window):
        return F.coalesce(
            F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    bases = groups.select(
        "leaf", "group", lower(Window.partitionBy("leaf").orderBy("group")).alias("base")
    )
    inside = Window.partitionBy("leaf", "group").orderBy("range")
    starts = sums.withColumn("start", lower(inside)).join(bases, ["leaf", "group"])
    starts = starts.withColumn("start", F.col("start") + F.col("base"))
    # The range in which the budget ends. One that ends exactly at its last row counts.
    edge = starts.filter("start < part AND start + n >= part").select("leaf", "range", "start")
    inner = ordered.join(edge, ["leaf", "range"])
    reading = Window.partitionBy("leaf", "range").orderBy("order")
    inner = inner.withColumn("end", F.col("start") + F.sum("tokens").over(reading))
    last = inner.groupBy("leaf").agg(
        F.max(F.when(F.col("end") <= F.col("part"), F.col("order"))).alias("inside"),
        F.min("range").alias("range"),
    )
    # If no row of that range fits, the reading ends with the range before it.
    return plan.join(last, "leaf", "left").select(
        "leaf", "whole", "part", "ranges", F.col("inside").alias("last"), F.col("range").alias("edge")
    )


def mix(
    documents: DataFrame,
    budget_share: float | None = 0.8,
    budget: int | None = None,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    domain: Column | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Selected documents, one row per document and epoch, with ``domain`` and ``epoch``.

    The budget is given in tokens or as a share of all tokens.
    """
    if any(w <= 0 for level in weights.values() for w in level.values()):
        raise ValueError("weights must be positive")
    where = source_domain(F.col("source")) if domain is None else domain
    base, show = hide(documents.withColumn("domain", where), "doc_id", "text", *LEVELS)
    leaf = F.to_json(F.struct(*LEVELS), {"ignoreNullFields": "false"})
    rows = materialise(
        base.select(
            *LEVELS, leaf.alias("leaf"), _row_digest().alias("row"), word_count(F.col("text")).alias("tokens")
        )
    )
    leaves = materialise(
        rows.groupBy(*LEVELS, "leaf").agg(
            F.sum("tokens").alias("tokens"), F.count("*").alias("docs")
        )
    )
    if budget is None:
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
        budget = int(total * budget_share)
    budgets = materialise(leaf_budgets(leaves, budget, weights, max_epochs=max_epochs))
    ends = materialise(prefix_ends(rows.select("leaf", "row", "tokens"), budgets, seed, range_rows))
    own = ends.select(F.col("leaf").alias("_leaf"), "whole", "ranges", "last", "edge")
    marked = base.withColumn("_leaf", leaf).join(own, "_leaf")
    marked = marked.withColumn("_order", _epoch_order(seed, F.col("whole"), _row_digest()))
    read = F.coalesce(
        (_range_of(F.col("_order"), F.col("ranges")) < F.col("edge"))
        | (F.col("_order") <= F.col("last")),
        F.lit(False),
    )
    epochs = F.concat(
        F.when(F.col("whole") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).otherwise(
            F.array().cast("array<bigint>")
        ),
        F.when(read, F.array("whole")).otherwise(F.array().cast("array<bigint>")),
    )
    return show(marked.select(*base.columns, F.explode(epochs).alias("epoch")), "domain", "epoch")
