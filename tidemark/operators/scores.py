"""Scored rows: contract, score histogram and the descending threshold sweep.

Columns: ``label`` (0/1), ``score`` in [0, 1], and where the order of input matters ``row_id``.
``runs`` names columns that hold several score sets apart (seed, variant, ...); all are handled
in one plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.checks import Rule, broken_unless, raise_first, violation_rows
from tidemark.operators.prefix import (
    ROWS_PER_BUCKET,
    balanced_points,
    quantile_points,
    running_totals,
)


def score_rules() -> list[Rule]:
    label, score = F.col("label").try_cast("double"), F.col("score").try_cast("double")
    return [
        Rule(0, "scores", "label is not binary", broken_unless(label.isin(0.0, 1.0))),
        Rule(
            1, "scores", "score is not a number in [0, 1]",
            broken_unless(score.between(0.0, 1.0) & ~F.isnan(score)),
        ),
    ]


def score_violations(frame: DataFrame) -> DataFrame:
    return violation_rows(frame, score_rules())


@dataclass(frozen=True)
class ScoreProfile:
    """What one pass over the scored rows tells: size and balanced split points."""

    rows: int
    score_points: list[float]
    order_points: list[float]


def profile_scores(
    frame: DataFrame, *, order: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> ScoreProfile:
    """Check the score contract and find split points, in the same pass."""
    rules = score_rules()
    # Invalid text becomes null here and is counted by the rules.
    work = frame.select(
        "label", "score", F.col("score").try_cast("double").alias("_score"),
        *([order] if order else []),
    )
    row = work.agg(
        F.count(F.lit(1)).alias("rows"),
        quantile_points("_score").alias("scores"),
        (quantile_points(order) if order else F.lit(None)).alias("orders"),
        *[rule.count.alias(f"_{i}") for i, rule in enumerate(rules)],
    ).first()
    if row["rows"] == 0:
        raise ContractError("scores: no rows; count=0")
    for i, rule in enumerate(rules):
        if row[f"_{i}"]:
            raise ContractError(f"{rule.table}: {rule.name}; count={row[f'_{i}']}")
    return ScoreProfile(
        row["rows"],
        balanced_points(work, "_score", row["scores"], row["rows"], rows_per_bucket),
        balanced_points(work, order, row["orders"], row["rows"], rows_per_bucket) if order else [],
    )


def score_histogram(frame: DataFrame, runs: Sequence[str] = ()) -> DataFrame:
    """(runs, score, pos, n): rows and positives per distinct score.

    Adding 0.0 turns -0.0 into 0.0, which compare equal but would print apart.
    """
    return frame.groupBy(
        *runs, (F.col("score").cast("double") + F.lit(0.0)).alias("score")
    ).agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )


def threshold_sweep(
    frame: DataFrame, runs: Sequence[str] = (), *, profile: ScoreProfile | None = None
) -> DataFrame:
    """One row per distinct score, as a threshold that selects every row at or above it.

    Columns: runs, score, pos, n (the tied block), cum_pos, cum_n (selected), all_pos, all_n.
    """
    profile = profile or profile_scores(frame)
    return running_totals(
        score_histogram(frame, runs), runs, "score", ["pos", "n"], profile.score_points,
        descending=True,
    )


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    """top / bottom as doubles, ``empty`` where bottom is zero."""
    return F.when(bottom == 0, F.lit(empty).cast("double")).otherwise(
        top.cast("double") / bottom.cast("double")
    )


def require_sound_scores(frame: DataFrame) -> None:
    """Fail on an empty table and on the first broken score rule, in one pass."""
    size = Rule(
        -1, "scores", "no rows", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint")
    )
    raise_first(violation_rows(frame, [size, *score_rules()]))
