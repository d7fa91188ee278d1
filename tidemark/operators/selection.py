"""Values at given ranks of several columns at once, from one table of value counts.

The table has one row per feature and distinct value, so equal values never meet in one task. A
search for a rank starts on a whole feature; while its range holds more values than a task should
sort, the range is cut at its own quantiles and the part with the rank goes on. All searches share
the passes. What reaches the driver is a few numbers per search and cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.prefix import (
    ROWS_PER_BUCKET,
    quantile_points,
    separated,
    split_points,
    with_bucket,
)


def value_counts(
    frame: DataFrame, features: Sequence[str], categorical: Sequence[str], *, weight: str | None = None
) -> DataFrame:
    """``position, category, number, rows``: how often each feature has each value.

    A feature's value is in ``category`` or in ``number``, by its kind; null counts as a value. A
    line counts as often as its column ``weight`` says, or once.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum("_weight")
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            (F.col(name) if name in categorical else F.lit(None)).cast("string").alias("category"),
            (F.lit(None) if name in categorical else F.col(name)).cast("double").alias("number"),
        )
        for i, name in enumerate(features)
    ]
    return (
        frame.select(*([F.col(weight).alias("_weight")] if weight else []), F.inline(F.array(*cells)))
        .groupBy("position", "category", "number")
        .agg(rows.alias("rows"))
    )


@dataclass(frozen=True)
class _Search:
    """Where a rank (from 1) lies: in the values from ``low`` to ``high`` of one feature."""

    position: int
    rank: int
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        own = F.col("position") == self.position
        return own if self.low is None else own & F.col("number").between(self.low, self.high)


def _searched(counts: DataFrame, searches: Sequence[_Search]) -> DataFrame:
    """``search, number, rows``: the values that each search still has to look at."""
    found = [F.when(s.holds(), F.lit(i)) for i, s in enumerate(searches)]
    return counts.where("number IS NOT NULL").select(
        F.explode(F.array_compact(F.array(*found))).alias("search"), "number", "rows"
    )


def _narrowed(inside: DataFrame, searches: list[_Search], wide: dict[int, int], limit: int) -> list[_Search]:
    """The searches in ``wide`` (search: number of values) go on in the part with their rank."""
    rows = inside.where(F.col("search").isin(list(wide)))
    heads = rows.groupBy("search").agg(quantile_points("number").alias("q")).collect()
    points = {r["search"]: separated(split_points(r["q"], wide[r["search"]], limit)) for r in heads}
    for i, cuts in points.items():
        own = rows.withColumn("_own", F.when(F.col("search") == i, F.col("number")))
        rows = with_bucket(own, "_own", cuts, f"_part{i}").drop("_own")
    # A row has a part of its own search only; those of the others are 0.
    part = F.greatest(F.lit(0), *[F.col(f"_part{i}") for i in points])
    parts = rows.groupBy("search", part.alias("part")).agg(
        F.sum("rows").alias("rows"), F.min("number").alias("low"), F.max("number").alias("high")
    )
    out, before, lost = list(searches), dict.fromkeys(wide, 0), set(wide)
    for r in sorted(parts.collect(), key=lambda r: (r["search"], r["part"])):
        i, rank = r["search"], searches[r["search"]].rank
        if before[i] < rank <= before[i] + r["rows"]:
            out[i] = replace(searches[i], rank=rank - before[i], low=r["low"], high=r["high"])
            lost.discard(i)
        before[i] += r["rows"]
    if lost:
        raise ContractError(f"ranks beyond the rows of a feature; count={len(lost)}")
    return out


def ranked_values(
    counts: DataFrame, targets: Sequence[tuple[int, int]], *, values_per_task: int = ROWS_PER_BUCKET
) -> list[float]:
    """The number at each target (position, rank from 1) of ``counts``, nulls left out.

    Ranks count rows, not distinct values. A rank that a feature does not have raises.
    """
    if not targets:
        return []
    searches = [_Search(*t) for t in targets]
    while True:
        inside = _searched(counts, searches)
        sizes = inside.groupBy("search").count().where(F.col("count") > values_per_task)
        wide = {r["search"]: r["count"] for r in sizes.collect()}
        if not wide:
            break
        searches = _narrowed(inside, searches, wide, values_per_task)
    # At most ``values_per_task`` values per search are left.
    upto = Window.partitionBy("search").orderBy("number").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rank = F.element_at(F.array(*[F.lit(s.rank) for s in searches]), F.col("search") + 1)
    last = inside.withColumn("_upto", F.sum("rows").over(upto)).where(
        (F.col("_upto") >= rank) & (F.col("_upto") - F.col("rows") < rank)
    )
    values = {r["search"]: r["number"] for r in last.select("search", "number").collect()}
    if len(values) < len(searches):
        raise ContractError(f"ranks beyond the rows of a feature; count={len(searches) - len(values)}")
    return [values[i] for i in range(len(searches))]
