"""Cut points inside very large sessions, so that no task sorts a whole one."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLES_PER_SLICE = 100
ROWS_PER_SLICE = 2_000_000

_POINT = T.StructType([T.StructField("at", T.LongType()), T.StructField("side", T.LongType())])
SLICE_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("heads", T.ArrayType(_POINT)),
        T.StructField("cuts", T.ArrayType(T.ArrayType(_POINT))),
    ]
)


def session_slices(moments: DataFrame, *, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Cut points of the sessions with more than ``rows_per_slice`` moments.

    ``moments`` has session_id, at and side. Sessions are counted exactly, with combining on the
    map side; n rows have at most n / rows_per_slice large ones. Only their moments are sampled, a
    hundred per slice, so a slice is within a third of its size at every scale. The cuts are
    literals: they decide how the work is split, never what the result is. There are about
    n / rows_per_slice of them, so the table may be broadcast.
    """
    spark = moments.sparkSession
    counts = moments.groupBy("session_id").agg(F.count(F.lit(1)).alias("rows"))
    hot = counts.where(F.col("rows") > rows_per_slice).withColumn(
        "pieces", F.ceil(F.col("rows") / F.lit(rows_per_slice)).cast("int")
    )
    known = hot.collect()
    if not known:
        return spark.createDataFrame([], SLICE_SCHEMA)
    sizes = spark.createDataFrame(
        [(r["session_id"], r["pieces"]) for r in known], "session_id string, pieces int"
    )
    share = min(1.0, SAMPLES_PER_SLICE / rows_per_slice)
    drawn = F.pmod(F.xxhash64("at", "side"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    large = (
        moments.where(drawn)
        .join(F.broadcast(sizes), "session_id")
        .groupBy("session_id", "pieces")
        .agg(F.sort_array(F.collect_list(F.struct("at", "side"))).alias("points"))
        .select(
            "session_id",
            F.expr(
                "array_distinct(transform(sequence(1, pieces - 1),"
                " i -> points[cast(cast(i as bigint) * size(points) / pieces as int)]))"
            ).alias("cuts"),
        )
        .collect()
    )
    # Two levels of about sqrt(n) cuts each: a row looks at the heads, then at one group.
    literal = []
    for row in large:
        cuts = [tuple(c) for c in row["cuts"]]
        width = max(1, math.isqrt(len(cuts)))
        groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
        literal.append((row["session_id"], width, [g[0] for g in groups], groups))
    return spark.createDataFrame(literal, SLICE_SCHEMA)


def with_slice(moments: DataFrame, slices: DataFrame) -> DataFrame:
    """Add ``slice``, and ``is_sliced`` for the sessions that were cut."""
    head = "size(filter(heads, h -> h <= struct(at, side)))"
    inner = "size(filter(cuts[_head - 1], c -> c <= struct(at, side)))"
    placed = moments.join(F.broadcast(slices), "session_id", "left").withColumn(
        "_head", F.when(F.col("heads").isNull(), 0).otherwise(F.expr(head))
    )
    return placed.select(
        *moments.columns,
        F.col("heads").isNotNull().alias("is_sliced"),
        F.when(F.col("_head") == 0, 0)
        .otherwise(F.expr(f"(_head - 1) * width + {inner}"))
        .alias("slice"),
    )
