"""Exact selection of the first k rows of an order, without sorting the table.

Only the boundary is searched for: which bucket holds rank k, which value inside that bucket. The
selection itself is then a comparison on each row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.prefix import (
    ROWS_PER_BUCKET,
    quantile_points,
    separated,
    split_points,
    with_bucket,
)


@dataclass(frozen=True)
class Boundary:
    """The value at rank k: how many rows come before it and how many share it."""

    value: object
    before: int
    ties: int


def boundary_value(
    frame: DataFrame, column: str, k: int, *, descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Boundary | None:
    """Value of the numeric ``column`` at rank ``k`` (from 1); None when there are fewer rows.

    A descent: the bucket that holds rank k is cut again at its own quantiles, which have buckets
    of their own, until it holds one value or few enough rows to be ordered in a task. What
    reaches the driver in each round: quantiles and one count per bucket.
    """
    inside, before = frame.select(column).where(F.col(column).isNotNull()), 0
    order = F.col(column).desc() if descending else F.col(column).asc()
    while True:
        head = inside.agg(
            F.count(column).alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"),
            quantile_points(column).alias("quantiles"),
        ).first()
        if head["rows"] < k - before:
            return None
        if head["low"] == head["high"]:
            return Boundary(head["low"], before, head["rows"])
        if head["rows"] <= rows_per_bucket:
            break
        points = separated(split_points(head["quantiles"], head["rows"], rows_per_bucket))
        counts = {
            row["_bucket"]: row["count"]
            for row in with_bucket(inside, column, points, "_bucket").groupBy("_bucket").count().collect()
        }
        for bucket in sorted(counts, reverse=descending):
            if before + counts[bucket] >= k:
                break
            before += counts[bucket]
        if bucket > 0:
            inside = inside.where(F.col(column).cast("double") >= F.lit(points[bucket - 1]))
        if bucket < len(points):
            inside = inside.where(F.col(column).cast("double") < F.lit(points[bucket]))
    # At most ``rows_per_bucket`` rows are left.
    last = F.min(column) if descending else F.max(column)
    value = inside.orderBy(order).limit(k - before).agg(last).first()[0]
    beyond = F.col(column) > F.lit(value) if descending else F.col(column) < F.lit(value)
    around = inside.agg(F.count_if(beyond).alias("n"), F.count_if(F.col(column) == F.lit(value)).alias("ties")).first()
    return Boundary(value, before + around["n"], around["ties"])


def stratum_cuts(
    frame: DataFrame,
    strata: Sequence[str],
    shares: dict[str, object],
    *,
    digits: int = 3,
) -> DataFrame:
    """Where, in the order of (``draw``, ``key``), the running weight passes given shares.

    Strata must be few (labels, seeds, size classes): the cuts are broadcast.
    ``frame`` has the strata columns, ``draw`` (a uniform hex text), ``key`` and ``weight``.
    ``shares`` maps a name to a function of the stratum total weight that gives the weight left
    of the cut; a row is left of it while its mid-point weight is. The result has one row per
    stratum: the strata, and for each name the columns ``<name>_draw`` and ``<name>_key`` of the
    last row to the left (null when there is none).

    Draws are uniform, so the buckets by their first ``digits`` hex digits are even. The bucket
    weights tell which bucket each cut lies in; only the rows of those buckets are sorted.
    """
    strata = list(strata)
    placed = frame.withColumn("_bucket", F.substring("draw", 1, digits))
    sums = placed.groupBy(*strata, "_bucket").agg(F.sum("weight").alias("w"))
    per = Window.partitionBy(*strata)
    before = per.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *strata, "_bucket", "w",
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("before"),
        F.sum("w").over(per).alias("total"),
    )
    targets = F.array(
        *[
            F.struct(F.lit(name).alias("cut"), share(F.col("total")).cast("double").alias("goal"))
            for name, share in shares.items()
        ]
    )
    lines = sums.select("*", F.inline(targets))
    # A cut lies in the bucket where the weight passes its goal, or in the one before it.
    wanted = lines.where(
        (F.col("before") <= F.col("goal")) & (F.col("goal") < F.col("before") + F.col("w"))
    ).select(*strata, "_bucket", "cut", "goal", "before")
    inside = Window.partitionBy(*strata, "_bucket", "cut").orderBy("draw", "key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # At most one bucket per stratum and cut, and strata are few: a bounded broadcast.
    near = (
        placed.join(F.broadcast(wanted), [*strata, "_bucket"])
        .withColumn("upto", F.col("before") + F.sum("weight").over(inside))
        .where(F.col("upto") - F.col("weight") / 2 <= F.col("goal"))
        .groupBy(*strata, "cut")
        .agg(F.max(F.struct("draw", "key")).alias("last"))
    )
    # Without a row to the left inside the bucket, the whole earlier buckets are left of the cut.
    edges = wanted.groupBy(*strata, "cut").agg(
        F.max("_bucket").alias("edge")
    )
    per_cut = edges.join(near, [*strata, "cut"], "left").select(
        *strata,
        "cut",
        F.coalesce(F.col("last.draw"), F.col("edge")).alias("draw"),
        F.coalesce(F.col("last.key"), F.lit("")).alias("key"),
    )
    return per_cut.groupBy(*strata).agg(
        *[
            F.max(F.when(F.col("cut") == name, F.col(part))).alias(f"{name}_{part}")
            for name in shares
            for part in ("draw", "key")
        ]
    )


def left_of(name: str) -> Column:
    """Row is at or before the cut ``name``; a stratum without that cut lies wholly left."""
    at = F.struct(F.col("draw"), F.col("key")) <= F.struct(
        F.col(f"{name}_draw"), F.col(f"{name}_key")
    )
    return F.when(F.col(f"{name}_draw").isNull(), F.lit(True)).otherwise(at)
