"""Train / validation / test splits, and profile diagnostics.

A split is a function of a hashed draw and of a few cut points, so it does not depend on the
partitioning. Rows are never shuffled for it: the cuts are found on bucket weights.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.errors import ContractError
from tidemark.functions.draws import rank_draw, uniform
from tidemark.functions.text import tuple_text
from tidemark.operators.ranking import left_of, stratum_cuts

#: Rows, about, that one task sorts to find a cut.
ROWS_PER_CUT = 2_500_000
#: Share of the rows from which a profile is broadcast with its split; at most the inverse are.
HOT_SHARE = 0.001
TRAIN, VALIDATION, TEST = "train", "validation", "test"


def _seeds(seeds: int | Sequence[int]) -> list[int]:
    out = [seeds] if isinstance(seeds, int) else list(seeds)
    if not out:
        raise ContractError("at least one split seed is required")
    return out


def _per_seed(frame: DataFrame, seeds: Sequence[int]) -> DataFrame:
    return frame.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seeds])))


def _name_split() -> Column:
    return (
        F.when(left_of("test"), TEST).when(left_of("validation"), VALIDATION).otherwise(TRAIN)
    )


def _digits(rows: int) -> int:
    """Hex digits of the draw whose buckets hold about ``ROWS_PER_CUT`` rows."""
    return max(1, math.ceil(math.log(max(rows, 1) / ROWS_PER_CUT, 16)))


def stratified_split(
    frame: DataFrame, seeds: int | Sequence[int], *, key: str = "row_id", label: str = "converted"
) -> DataFrame:
    """Rows per seed with ``split``: exact 60/20/20 with the same share of positives in each.

    Test takes ceil(n / 5) rows, validation ceil(a quarter of the rest); positives take the
    rounded share of both.
    """
    seeds = _seeds(seeds)
    counts = {
        int(row["label"]): row["n"]
        for row in frame.groupBy(F.col(label).cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if set(counts) != {0, 1} or min(counts.values()) < 3:
        raise ContractError("a stratified split needs at least three rows of both labels")
    n, positives = sum(counts.values()), counts[1]
    n_test = -(-n // 5)
    n_validation = -(-(n - n_test) // 4)
    test_pos = _rounded_share(n_test, positives, n)
    validation_pos = _rounded_share(n_validation, positives - test_pos, n - n_test)
    quota = {
        1: (test_pos, test_pos + validation_pos),
        0: (n_test - test_pos, n_test - test_pos + n_validation - validation_pos),
    }
    work = _per_seed(frame, seeds).withColumns(
        {
            "draw": rank_draw(F.col(key), "stratified", F.col("seed")),
            "key": F.col(key).cast("string"),
            "weight": F.lit(1).cast("bigint"),
            "_label": F.col(label).cast("int"),
        }
    )
    cuts = stratum_cuts(
        work.select("seed", "_label", "draw", "key", "weight"),
        ["seed", "_label"],
        {
            "test": lambda _: _by_label(quota, 0),
            "validation": lambda _: _by_label(quota, 1),
        },
        digits=_digits(n),
    )
    # Two labels per seed.
    joined = work.join(F.broadcast(cuts), ["seed", "_label"])
    return joined.withColumn("split", _name_split()).select("seed", *frame.columns, "split")


def _by_label(quota: dict[int, tuple[int, int]], part: int) -> Column:
    return F.when(F.col("_label") == 1, quota[1][part]).otherwise(quota[0][part])


def _rounded_share(rows: int, part: int, whole: int) -> int:
    """rows * part / whole, rounded half up."""
    return (2 * rows * part + whole) // (2 * whole)


def profile_text(features: Sequence[str]) -> Column:
    return tuple_text([F.col(name) for name in features])


def profile_split(
    frame: DataFrame, seeds: int | Sequence[int], *, features: Sequence[str]
) -> DataFrame:
    """Rows per seed with ``split``: 60/20/20 of the feature profiles, none in two splits.

    The draw is a function of the profile, so rows find their split without a join on profiles.
    """
    seeds = _seeds(seeds)
    key = profile_text(features)

    def placed(rows: DataFrame) -> DataFrame:
        return _per_seed(rows.withColumn("key", key), seeds).withColumns(
            {
                "draw": rank_draw(F.col("key"), "profile", F.col("seed")),
                "weight": F.lit(1).cast("bigint"),
            }
        )

    distinct = written(frame.select(*features).distinct())
    profiles = placed(distinct)
    cuts = stratum_cuts(
        profiles.select("seed", "draw", "key", "weight"),
        ["seed"],
        {
            "test": lambda total: _ceil_div(total, 5),
            "validation": lambda total: _ceil_div(total, 5)
            + _ceil_div(total - _ceil_div(total, 5), 4),
        },
        digits=_digits(distinct.count()),
    )
    joined = placed(frame).join(F.broadcast(cuts), "seed")
    return joined.withColumn("split", _name_split()).select("seed", *frame.columns, "split")


def _ceil_div(value: Column, by: int) -> Column:
    return F.ceil(value / F.lit(by))


def grouped_split(
    frame: DataFrame,
    seeds: int | Sequence[int],
    *,
    features: Sequence[str],
    label: str = "converted",
) -> DataFrame:
    """Rows per seed with ``split``: no profile in two splits, nominal 60/20/20 of the rows.

    Profiles are put into strata of like size and like rate of positives. Inside a stratum they
    lie on a circle of their rows in the order of a hashed draw; from a hashed start, a fifth of
    the circle is test and the next fifth validation. So splits have like prevalence, and every
    profile, also one alone in its stratum, is test for a fifth of the seeds.

    Rows find the split of their profile by a join on profiles. Those with more than
    ``HOT_SHARE`` of the rows are broadcast, so no key of the other join holds more.
    """
    seeds = _seeds(seeds)
    features = list(features)
    profiles = written(
        frame.groupBy(*features).agg(
            F.count(F.lit(1)).alias("_weight"), F.avg(F.col(label).cast("double")).alias("_rate")
        )
    )
    total, many = profiles.agg(F.sum("_weight"), F.count(F.lit(1))).first()
    # Sizes by powers of four, rates by quarters of [0, 1].
    size = F.floor(F.log2(F.col("_weight")) / 2).cast("int")
    rate = F.ceil(F.col("_rate") * 4).cast("int")
    work = _per_seed(
        profiles.withColumns({"_size": size, "_part": rate, "key": profile_text(features)}), seeds
    ).withColumns(
        {"draw": rank_draw(F.col("key"), "grouped", F.col("seed")), "weight": F.col("_weight")}
    )
    strata = ["seed", "_size", "_part"]
    start = uniform(F.concat_ws(":", "_size", "_part"), "start", F.col("seed"))
    turn = {name: _fraction(F.lit(gap) - start) for name, gap in _CIRCLE.items()}
    cuts = stratum_cuts(
        work.select(*strata, "draw", "key", "weight"),
        strata,
        {name: (lambda total, at=at: total * at) for name, at in turn.items()},
        digits=_digits(many),
    )

    def between(low: str, high: str) -> Column:
        """From one cut up to the next around the circle."""
        after, upto = ~left_of(low), left_of(high)
        return F.when(turn[low] < turn[high], after & upto).otherwise(after | upto)

    split = F.when(between("start", "test"), TEST).when(
        between("test", "validation"), VALIDATION
    ).otherwise(TRAIN)
    # At most 32 sizes and 5 rates per seed.
    named = written(
        work.join(F.broadcast(cuts), strata).select(
            "seed", *[F.col(f).alias(f"_{f}") for f in features], "_weight", split.alias("split")
        )
    )
    hot = F.col("_weight") > (total or 0) * HOT_SHARE
    same = [frame[f].eqNullSafe(F.col(f"_{f}")) for f in features]
    first = named["seed"] == seeds[0]
    rare = frame.join(F.broadcast(named.where(hot & first)), same, "left_anti")
    parts = [
        frame.join(F.broadcast(named.where(hot)), same),
        rare.join(named.where(~hot), [rare[f].eqNullSafe(F.col(f"_{f}")) for f in features]),
    ]
    chosen = ["seed", *frame.columns, "split"]
    return parts[0].select(*chosen).unionByName(parts[1].select(*chosen))


#: Where on the circle the test rows begin and end, and the validation rows end.
_CIRCLE = {"start": 0.0, "test": 0.2, "validation": 0.4}


def _fraction(value: Column) -> Column:
    return value - F.floor(value)


def split_summary(split: DataFrame, *, label: str = "converted") -> DataFrame:
    """Rows, positives and prevalence per seed and split."""
    value = F.col(label).cast("bigint")
    return split.groupBy("seed", "split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(value).alias("positives"),
        F.avg(value).alias("prevalence"),
    )


def profile_overlap(split: DataFrame, features: Sequence[str]) -> DataFrame:
    """Profiles per seed that occur in more than one split; zero when none crosses."""
    return (
        split.groupBy("seed", *features)
        .agg((F.min("split") != F.max("split")).cast("bigint").alias("crosses"))
        .groupBy("seed")
        .agg(F.count(F.lit(1)).alias("profiles"), F.sum("crosses").alias("crossing_profiles"))
    )


def profile_diagnostics(
    frame: DataFrame, features: Sequence[str], *, label: str = "converted"
) -> DataFrame:
    """How often feature profiles repeat and how often they carry both labels."""
    value = F.col(label).cast("int")
    both = F.col("low") != F.col("high")
    rows = F.col("rows")

    def total(condition: Column, amount: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("bigint")

    return (
        frame.groupBy(*features)
        .agg(
            F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high")
        )
        .agg(
            F.count(F.lit(1)).alias("unique_profiles"),
            total(rows > 1, rows).alias("rows_in_repeated_profiles"),
            (total(rows > 1, rows) / F.sum(rows)).alias("repeated_profile_fraction"),
            total(both, F.lit(1)).alias("profiles_with_both_labels"),
            total(both, rows).alias("rows_in_profiles_with_both_labels"),
        )
    )
