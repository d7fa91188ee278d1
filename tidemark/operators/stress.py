"""Stress inputs: corrupted features, permuted labels, baseline scores.

All draws are hashed from the row key, so a variant is the same table however it is partitioned.
"""

from __future__ import annotations


import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.draws import normal, uniform

# The share of cells hit, the marker of an unseen level, the noise levels.
SHARE = 0.05
UNSEEN = "__UNSEEN__"
AGE_NOISE = 3.0
PAGE_NOISE = 2.0
RANKING_NOISE = 1e-4
ROWS_PER_BLOCK = 100_000
MISSING = "five_percent_cells_missing"
UNSEEN_CATEGORIES = "five_percent_unseen_categories"
NOISY_AGE = "age_measurement_noise_sd_3"
NOISY_PAGES = "page_count_measurement_noise_sd_2"


def corrupted_inputs(
    frame: DataFrame, scenario: str, *, seed: int, key: str = "row_id"
) -> DataFrame:
    """All corrupted variants of the feature rows, told apart by ``variant``.

    Each row becomes one row per variant within one scan.
    """
    features = schemas.features_of(scenario)
    others = [c for c in frame.columns if c not in features]
    low, high = schemas.AGE_RANGE

    def hit(column: str, salt: str) -> Column:
        return uniform(F.col(key), f"{salt}/{column}", seed) < SHARE

    def plain(column: str) -> Column:
        return F.col(column) if column in schemas.CATEGORICAL else F.col(column).cast("double")

    def variant(name: str, changed: dict[str, Column]) -> Column:
        return F.struct(
            F.lit(name).alias("variant"),
            *[changed.get(c, plain(c)).alias(c) for c in features],
        )

    age = F.rint(F.col("age") + F.lit(AGE_NOISE) * normal(F.col(key), "age", seed))
    pages = F.rint(
        F.col("total_pages_visited") + F.lit(PAGE_NOISE) * normal(F.col(key), "pages", seed)
    )
    variants = [
        variant(
            MISSING, {c: F.when(~hit(c, "missing"), plain(c)) for c in features}
        ),
        variant(
            UNSEEN_CATEGORIES,
            {
                c: F.when(hit(c, "unseen"), F.lit(UNSEEN)).otherwise(F.col(c))
                for c in schemas.CATEGORICAL
            },
        ),
        variant(
            NOISY_AGE,
            {"age": F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), age))},
        ),
    ]
    if "total_pages_visited" in features:
        variants.append(
            variant(NOISY_PAGES, {"total_pages_visited": F.greatest(F.lit(1.0), pages)})
        )
    return frame.select(*others, F.inline(F.array(*variants)))


def permuted_labels(
    frame: DataFrame, *, seed: int, key: str = "row_id", label: str = "converted",
    blocks: int | None = None,
) -> DataFrame:
    """``frame`` with ``permuted_label``: the labels shuffled among the rows.

    Rows and labels are dealt into the same hash blocks; inside a block the row at place i of one
    hashed order takes the label at place i of another. Every label is used once, so their counts
    do not change. Blocks are even whatever the data is; by default there is one per
    ``ROWS_PER_BLOCK`` rows.
    """
    if blocks is None:
        blocks = max(8, math.ceil(frame.count() / ROWS_PER_BLOCK))
    block = F.floor(uniform(F.col(key), "permute/block", seed) * blocks).cast("int")
    work = frame.withColumns(
        {
            "_block": block,
            "_to": uniform(F.col(key), "permute/to", seed),
            "_from": uniform(F.col(key), "permute/from", seed),
        }
    )
    per = Window.partitionBy("_block")
    numbered = work.withColumns(
        {
            "_place": F.row_number().over(per.orderBy("_to", key)),
            "_source": F.row_number().over(per.orderBy("_from", key)),
        }
    )
    labels = numbered.select(
        "_block", F.col("_source").alias("_place"), F.col(label).alias("permuted_label")
    )
    return (
        numbered.join(labels, ["_block", "_place"])
        .select(*frame.columns, "permuted_label")
    )


def constant_scores(frame: DataFrame, prevalence: float) -> DataFrame:
    """Every row scored with the training prevalence."""
    return frame.withColumn("score", F.lit(float(prevalence)))


def random_scores(
    frame: DataFrame, prevalence: float, *, seed: int, key: str = "row_id"
) -> DataFrame:
    """A random ranking around the training prevalence, clipped to [0, 1]."""
    noise = F.lit(float(prevalence)) + F.lit(RANKING_NOISE) * normal(F.col(key), "rank", seed)
    return frame.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), noise)))
