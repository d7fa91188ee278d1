"""Exact running totals along a sorted column, without sorting the table in one task.

The column is cut into buckets at literal split points. Bucket totals are small and are summed
up first; inside a bucket a window does the rest. Split points come from approximate quantiles:
they balance the buckets and have no effect on the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUANTILES = 1024
ROWS_PER_BUCKET = 250_000
LEAST_BUCKETS = 32


def quantile_points(column: str) -> Column:
    """Aggregate: evenly spaced approximate quantiles of a numeric column."""
    steps = ", ".join(f"{i / QUANTILES}D" for i in range(1, QUANTILES))
    return F.expr(
        f"percentile_approx(cast(`{column}` as double), array({steps}), {10 * QUANTILES})"
    )


def split_points(
    quantiles: Sequence[float] | None, rows: int, rows_per_bucket: int = ROWS_PER_BUCKET,
    least: int = LEAST_BUCKETS,
) -> list[float]:
    """Increasing split points for buckets of about ``rows_per_bucket`` rows, from quantiles.

    Every so-manieth quantile, or all of them where they are too few.
    """
    if not quantiles:
        return []
    wanted = min(len(quantiles), max(least, math.ceil(rows / rows_per_bucket)))
    step = len(quantiles) / wanted
    first = 1 if wanted < len(quantiles) else 0
    return sorted({float(quantiles[int(i * step)]) for i in range(first, wanted)})


def separated(points: Sequence[float]) -> list[float]:
    """Each point and the next number above it: a value that is a point has its own bucket."""
    return sorted({float(x) for p in points for x in (p, math.nextafter(p, math.inf))})


def balanced_points(
    frame: DataFrame, column: str, quantiles: Sequence[float] | None, rows: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> list[float]:
    """Split points whose buckets hold about ``rows_per_bucket`` rows or one value.

    Where the quantiles of the table are too few for that, its buckets are counted, and those too
    full are split at their own quantiles, again and again: each round leaves about a thousandth
    of a bucket, so the rounds are few even if most rows lie in one gap. One number per bucket
    reaches the driver.
    """
    points = split_points(quantiles, rows, rows_per_bucket)
    if rows <= QUANTILES * rows_per_bucket:
        return points
    points = separated(points)
    values = frame.select(F.col(column).cast("double").alias("_v")).where("_v IS NOT NULL")
    while True:
        placed = with_bucket(values, "_v", points, "_b")
        full = {
            r["_b"]: r["rows"]
            for r in placed.groupBy("_b").agg(
                F.count(F.lit(1)).alias("rows"), F.min("_v").alias("low"), F.max("_v").alias("high")
            ).where((F.col("rows") > 2 * rows_per_bucket) & (F.col("low") < F.col("high"))).collect()
        }
        if not full:
            return points
        # As many rows as buckets that are too full: a bounded broadcast of their numbers.
        wanted = frame.sparkSession.createDataFrame([(b,) for b in full], "_b int")
        found = placed.join(F.broadcast(wanted), "_b", "left_semi").groupBy("_b").agg(
            quantile_points("_v").alias("q")
        )
        more = [x for r in found.collect() for x in split_points(r["q"], full[r["_b"]], rows_per_bucket, 2)]
        points = sorted({*points, *separated(more)})


def with_bucket(frame: DataFrame, by: str, points: Sequence[float], name: str) -> DataFrame:
    """Add the bucket number of ``by``; bucket i holds points[i-1] <= value < points[i]."""
    if not points:
        return frame.withColumn(name, F.lit(0))
    splits = [-math.inf, *points, math.inf]
    placed = frame.withColumn("_by", F.col(by).cast("double"))
    tool = Bucketizer(splits=splits, inputCol="_by", outputCol=name)
    # Never null: otherwise the join below would push a null test under the aggregation of one
    # branch only, and the two branches could not share their shuffle.
    number = F.coalesce(F.col(name).cast("int"), F.lit(0))
    return tool.transform(placed).drop("_by").withColumn(name, number)


def running_totals(
    frame: DataFrame,
    keys: Sequence[str],
    by: str,
    measures: Sequence[str],
    points: Sequence[float],
    *,
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<m>`` (inclusive running sum) and ``all_<m>`` (total) per key group.

    Rows of a key group must differ in ``by``. Both the window and the join use (keys, bucket),
    so the rows are shuffled once. The offsets are the hashed side, one row per key group and
    bucket; a broadcast is not asked for, since key groups may be many.
    """
    # As one struct, a key group with nulls equals itself in the join below.
    keys_of = ["_run"] if keys else []
    bucket = [*keys_of, "_bucket"]
    placed = with_bucket(frame, by, points, "_bucket")
    if keys:
        placed = placed.withColumn("_run", F.struct(*keys))
    whole = Window.partitionBy(*keys_of)
    across = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    earlier = whole.orderBy(across).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*bucket).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    offsets = totals.select(
        *bucket,
        *[F.coalesce(F.sum(f"_{m}").over(earlier), F.lit(0)).alias(f"_before_{m}")
          for m in measures],
        *[F.sum(f"_{m}").over(whole).alias(f"all_{m}") for m in measures],
    )
    inside = F.col(by).desc() if descending else F.col(by).asc()
    upto = Window.partitionBy(*bucket).orderBy(inside).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return placed.join(offsets.hint("shuffle_hash"), bucket).select(
        *frame.columns,
        *[(F.col(f"_before_{m}") + F.sum(m).over(upto)).alias(f"cum_{m}") for m in measures],
        *[f"all_{m}" for m in measures],
    )
