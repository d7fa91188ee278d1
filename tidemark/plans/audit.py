"""Realism audit: several seeds, profile holdout, bootstrap, corrupted inputs, baselines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.durable import written
from tidemark.errors import ContractError
from tidemark.operators.bootstrap import bootstrap_interval
from tidemark.operators.combine import side_by_side
from tidemark.operators.conversion import clean_conversions, conversion_quality
from tidemark.operators.metrics import (
    METRIC_COLUMNS,
    confusion,
    confusion_at,
    threshold_free_metrics,
)
from tidemark.operators.model import build_model_pipeline, fit_all, score_rows
from tidemark.operators.scores import profile_scores
from tidemark.operators.splits import (
    profile_diagnostics,
    profile_split,
    split_summary,
    stratified_split,
)
from tidemark.operators.stress import (
    constant_scores,
    corrupted_inputs,
    permuted_labels,
    random_scores,
)
from tidemark.operators.thresholds import Policy, choose_thresholds

# The metrics summarized over seeds, and the base seed.
AUDIT_METRICS = (
    "average_precision",
    "brier_score",
    "roc_auc",
    "precision_at_budget",
    "recall_at_budget",
    "lift_at_budget",
)
BASE_SEED = 42
DEFAULT_SEEDS = (7, 21, 42, 84, 2026)
PAGES_ONLY = ("total_pages_visited",)
RUNS = ("experiment", "scenario", "seed")
# The names of the experiments.
ROW_RANDOM, PROFILE_HOLDOUT = "row_random_split", "exact_profile_group_holdout"
CONSTANT, RANDOM = "training_prevalence_constant", "calibrated_random_ranking"
PAGES, PERMUTED = "pages_only_logistic_regression", "permuted_training_labels_acquisition"


@dataclass(frozen=True)
class AuditReport:
    quality: DataFrame
    profiles: DataFrame
    splits: DataFrame
    metrics: DataFrame
    summary: DataFrame
    bootstrap: DataFrame
    corruption: DataFrame


def frozen_metrics(scored: DataFrame, runs: Sequence[str] = RUNS) -> DataFrame:
    """Threshold chosen on validation rows, every metric on test rows, per run."""
    runs = list(runs)
    policy = Policy()
    choices = choose_thresholds(scored.where("split = 'validation'"), [policy], runs=runs)
    test = scored.where("split = 'test'")
    judged = confusion_at(
        test, choices, runs=runs, by=runs,
        false_positive_cost=policy.false_positive_cost,
        false_negative_cost=policy.false_negative_cost,
    )
    free = threshold_free_metrics(
        test, runs=runs, profile=profile_scores(scored, order="row_id")
    )
    return side_by_side([free, judged], runs).select(*runs, *METRIC_COLUMNS)


def seed_summary(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, metric, mean, minimum, maximum) of the six audit metrics over the seeds."""
    keys = list(keys)
    return (
        metrics.select(*keys, *AUDIT_METRICS)
        .unpivot(keys, list(AUDIT_METRICS), "metric", "value")
        .groupBy(*keys, "metric")
        .agg(
            F.avg("value").alias("mean"),
            F.min("value").alias("minimum"),
            F.max("value").alias("maximum"),
        )
    )


def corruption_metrics(
    model, test: DataFrame, scenario: str, *, seed: int
) -> DataFrame:
    """Metrics at threshold 0.5 of each corrupted variant of the test rows."""
    features = schemas.features_of(scenario)
    variants = corrupted_inputs(
        test.select("row_id", F.col("converted").alias("label"), *features), scenario, seed=seed
    )
    # Read by several passes, so draws and scores are made once.
    scored = written(score_rows(model, variants, keep=["variant", "row_id", "label"]))
    runs = ["variant"]
    free = threshold_free_metrics(scored, runs=runs)
    judged = confusion(scored, 0.5, runs=runs, validate=False)
    return side_by_side([free, judged], runs).select(*runs, *METRIC_COLUMNS)


def baseline_scores(splits: DataFrame, *, seed: int, prevalence: float) -> DataFrame:
    """Validation and test rows scored by the constant and by the random baseline."""
    rows = splits.where("split <> 'train'").select(
        "seed", "split", "row_id", F.col("converted").alias("label")
    )
    return (
        constant_scores(rows, prevalence).withColumn("experiment", F.lit(CONSTANT))
        .unionByName(
            random_scores(rows, prevalence, seed=seed).withColumn("experiment", F.lit(RANDOM))
        )
    )


def _base(seeds: Sequence[int]) -> int:
    if not seeds:
        raise ContractError("at least one split seed is required")
    return BASE_SEED if BASE_SEED in seeds else int(seeds[0])


def audit_rows(
    rows: DataFrame, seeds: Sequence[int] = DEFAULT_SEEDS
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Clean ``rows`` with their split by seed, and those of the profile holdout by scenario."""
    row_splits = written(stratified_split(rows, seeds), partition_by=("seed", "split"))
    holdouts = {
        name: written(profile_split(rows, _base(seeds), features=features), partition_by=("split",))
        for name, features in schemas.FEATURES.items()
    }
    return row_splits, holdouts


def strategy_summary(row_splits: DataFrame, holdouts: dict[str, DataFrame]) -> DataFrame:
    """``split_summary`` of each strategy."""
    return _stack(
        [split_summary(row_splits).withColumn("strategy", F.lit(ROW_RANDOM))] + [
            split_summary(held).withColumn("strategy", F.lit(f"{PROFILE_HOLDOUT}:{name}"))
            for name, held in holdouts.items()
        ]
    )


def scenario_diagnostics(rows: DataFrame) -> DataFrame:
    """``profile_diagnostics`` of each scenario."""
    return _stack([
        profile_diagnostics(rows, features).withColumn("scenario", F.lit(name))
        for name, features in schemas.FEATURES.items()
    ])


def run_realism_audit(
    conversions: DataFrame,
    *,
    seeds: Sequence[int] = DEFAULT_SEEDS,
    bootstrap_samples: int = 200,
    parallelism: int = 4,
) -> AuditReport:
    """The audit tables over a conversion table with ``row_id``."""
    base = _base(seeds)
    rows = written(clean_conversions(conversions, keep=("row_id",)))  # read by every split and table
    row_splits, holdouts = audit_rows(rows, seeds)
    base_rows = row_splits.where(F.col("seed") == base)
    train = base_rows.where("split = 'train'")
    permuted = permuted_labels(train, seed=base).drop("converted").withColumnRenamed(
        "permuted_label", "converted"
    )
    jobs: list[tuple[tuple[str, str, int], tuple[str, ...], DataFrame, DataFrame]] = []
    for name, features in schemas.FEATURES.items():
        for seed in seeds:
            mine = row_splits.where(F.col("seed") == int(seed))
            jobs.append(((ROW_RANDOM, name, int(seed)), features,
                         mine.where("split = 'train'"), mine))
        held = holdouts[name]
        jobs.append(((PROFILE_HOLDOUT, name, base), features,
                     held.where("split = 'train'"), held))
    jobs.append(((PAGES, "in_session", base), PAGES_ONLY, train, base_rows))
    acquisition = schemas.FEATURES["acquisition"]
    jobs.append(((PERMUTED, "acquisition", base), acquisition, permuted, base_rows))
    models = fit_all(
        [(build_model_pipeline(features), fit_rows) for _, features, fit_rows, _ in jobs],
        parallelism=parallelism,
    )
    parts = [
        score_rows(model, target.where("split <> 'train'"), keep=["split", "row_id", "converted"])
        .select(
            F.lit(run[0]).alias("experiment"), F.lit(run[1]).alias("scenario"),
            F.lit(run[2]).alias("seed"), "split", "row_id", F.col("converted").alias("label"),
            "score",
        )
        for model, (run, _, _, target) in zip(models, jobs)
    ]
    prevalence = train.agg(F.avg("converted")).first()[0]
    parts.append(
        baseline_scores(base_rows, seed=base, prevalence=prevalence).select(
            "experiment", F.lit("none").alias("scenario"), "seed", "split", "row_id", "label",
            "score",
        )
    )
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    scored = written(scored, partition_by=(*RUNS, "split"))
    metrics = written(frozen_metrics(scored))
    boots, stressed = [], []
    for name in schemas.FEATURES:
        test = scored.where(
            (F.col("experiment") == ROW_RANDOM) & (F.col("scenario") == name)
            & (F.col("seed") == base) & (F.col("split") == "test")
        )
        # One set of resamples serves all three metrics.
        boots.append(
            bootstrap_interval(
                test, ["average_precision", "roc_auc", "brier_score"], samples=bootstrap_samples, seed=base
            ).withColumn("scenario", F.lit(name))
        )
        at = next(i for i, job in enumerate(jobs) if job[0] == (ROW_RANDOM, name, base))
        stressed.append(
            corruption_metrics(
                models[at], base_rows.where("split = 'test'"), name, seed=base
            ).withColumn("scenario", F.lit(name))
        )
    return AuditReport(
        quality=conversion_quality(conversions),
        profiles=scenario_diagnostics(rows),
        splits=strategy_summary(row_splits, holdouts),
        metrics=metrics,
        summary=seed_summary(
            metrics.where(F.col("experiment") == ROW_RANDOM), ["experiment", "scenario"]
        ),
        bootstrap=_stack(boots),
        corruption=_stack(stressed),
    )


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
