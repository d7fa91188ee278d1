"""Small per-run results next to each other, and two tables against each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def side_by_side(parts: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Columns of all parts in one row per key group; each part has one row per group.

    The parts are stacked and folded, which needs no join and so also works without keys.
    """
    keys = list(keys)
    names = [n for part in parts for n in part.columns if n not in keys]
    tall = parts[0]
    for part in parts[1:]:
        tall = tall.unionByName(part, allowMissingColumns=True)
    return tall.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])


def multiset_delta(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows of ``columns`` only one of the two tables has."""
    signed = left.select(*columns, F.lit(1).alias("_side")).unionAll(
        right.select(*columns, F.lit(-1).alias("_side"))
    )

    def surplus(sign: int) -> Column:
        side = F.greatest(F.lit(sign) * F.col("d"), F.lit(0))
        return F.coalesce(F.sum(side), F.lit(0)).cast("bigint")

    # Equal rows cancel. This is a multiset comparison from a single shuffle.
    return signed.groupBy(*columns).agg(F.sum("_side").alias("d")).agg(
        surplus(1).alias("only_left"), surplus(-1).alias("only_right")
    )
