"""Training run: both models per scenario, thresholds on validation, champion by cost."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.durable import written
from tidemark.operators.combine import side_by_side
from tidemark.operators.conversion import clean_conversions
from tidemark.operators.metrics import (
    METRIC_COLUMNS,
    confusion_at,
    curve_points,
    require_costs,
    threshold_free_metrics,
)
from tidemark.operators.model import (
    MODEL_NAMES,
    TREES,
    build_model_pipeline,
    champion,
    fit_all,
    score_rows,
)
from tidemark.operators.scores import profile_scores
from tidemark.operators.splits import split_summary, stratified_split
from tidemark.operators.thresholds import Policy, choose_thresholds

RUNS = ("scenario", "model")


@dataclass(frozen=True)
class TrainingReport:
    splits: DataFrame
    scored: DataFrame
    choices: DataFrame
    metrics: DataFrame
    champions: DataFrame
    curves: DataFrame


def training_rows(conversions: DataFrame, *, seed: int = 42) -> DataFrame:
    """The clean rows with their split, written in one partition per split."""
    rows = clean_conversions(conversions, keep=("row_id",))
    return written(stratified_split(rows, seed), partition_by=("split",))


def run_training(
    conversions: DataFrame,
    *,
    model_names: Sequence[str] = MODEL_NAMES,
    scenarios: Sequence[str] = tuple(schemas.FEATURES),
    false_positive_cost: float = 1.0,
    false_negative_cost: float = 10.0,
    seed: int = 42,
    trees: int = TREES,
    parallelism: int = 2,
) -> TrainingReport:
    """Report tables over a conversion table with ``row_id``; ``metrics`` has one row per
    scenario, model and split (validation, test)."""
    require_costs(false_positive_cost, false_negative_cost)
    splits = training_rows(conversions, seed=seed)
    train, rest = splits.where("split = 'train'"), splits.where("split <> 'train'")
    runs = [(scenario, model) for scenario in scenarios for model in model_names]
    models = fit_all(
        [
            (build_model_pipeline(schemas.features_of(s), m, trees=trees), train)
            for s, m in runs
        ],
        parallelism=parallelism,
    )
    parts = [
        score_rows(fitted, rest, keep=["split", "row_id", "converted"]).select(
            F.lit(s).alias("scenario"), F.lit(m).alias("model"), "split", "row_id",
            F.col("converted").alias("label"), "score",
        )
        for fitted, (s, m) in zip(models, runs)
    ]
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    scored = written(scored, partition_by=(*RUNS, "split"))
    policy = Policy(false_positive_cost, false_negative_cost)
    profile = profile_scores(scored, order="row_id")
    choices = written(
        choose_thresholds(scored.where("split = 'validation'"), [policy], runs=RUNS)
    )
    keys = [*RUNS, "split"]
    judged = confusion_at(
        scored, choices, runs=keys, by=RUNS, false_positive_cost=false_positive_cost,
        false_negative_cost=false_negative_cost,
    )
    free = threshold_free_metrics(scored, runs=keys, profile=profile)
    metrics = written(
        side_by_side([free, judged], keys).select(*keys, *METRIC_COLUMNS)
    )
    return TrainingReport(
        splits=split_summary(splits),
        scored=scored,
        choices=choices.drop("policy_id"),
        metrics=metrics,
        champions=champion(metrics.where("split = 'validation'")),
        curves=curve_points(scored.where("split = 'test'"), RUNS),
    )
