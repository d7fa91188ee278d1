"""Decision optimization: scenarios, split strategies and seeds, then one policy grid over all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.durable import written
from tidemark.errors import ContractError
from tidemark.operators.conversion import clean_conversions, conversion_quality
from tidemark.operators.model import build_model_pipeline, fit_all, score_rows
from tidemark.operators.splits import grouped_split, split_summary, stratified_split
from tidemark.operators.thresholds import Policy
from tidemark.plans import policies as grid

GROUPED, ROW_RANDOM = "acquisition_profile_grouped", "row_random"
STRATEGIES = (GROUPED, ROW_RANDOM)
RUNS = ("scenario", "split_strategy", "seed")


@dataclass(frozen=True)
class DecisionReport:
    """Tidy tables; nested JSON is only an export of them."""

    quality: DataFrame
    splits: DataFrame
    scored: DataFrame
    runs: DataFrame
    comparison: DataFrame
    summary: DataFrame
    diagnostics: DataFrame
    policies: list[Policy]
    primary_cost: float

    def benchmark(
        self, *, scenario: str = "in_session", strategy: str = GROUPED, ceiling: float = 0.05
    ) -> DataFrame:
        """The reviewed extract of one scenario and strategy."""
        chosen = self.comparison.where(
            (F.col("scenario") == scenario) & (F.col("split_strategy") == strategy)
        )
        return grid.policy_benchmark(
            chosen, self.policies, ceiling=ceiling, false_negative_cost=self.primary_cost
        )


def split_table(rows: DataFrame, seeds: Sequence[int], strategies: Sequence[str]) -> DataFrame:
    """Rows per strategy and seed with ``split``; the same split serves every scenario."""
    profile = schemas.FEATURES["acquisition"]
    makers = {
        GROUPED: lambda: grouped_split(rows, seeds, features=profile),
        ROW_RANDOM: lambda: stratified_split(rows, seeds),
    }
    parts = [
        makers[name]().withColumn("split_strategy", F.lit(name)) for name in strategies
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def decision_rows(
    conversions: DataFrame, seeds: Sequence[int] = grid.DEFAULT_SEEDS,
    strategies: Sequence[str] = STRATEGIES,
) -> DataFrame:
    """The clean rows with their split by strategy and seed, written in one partition for each."""
    rows = clean_conversions(conversions, keep=("row_id",))
    return written(
        split_table(rows, seeds, strategies), partition_by=("split_strategy", "seed", "split")
    )


def strategy_summary(splits: DataFrame, strategies: Sequence[str] = STRATEGIES) -> DataFrame:
    """``split_summary`` of each strategy."""
    shares = [
        split_summary(splits.where(F.col("split_strategy") == name)).withColumn(
            "split_strategy", F.lit(name)
        )
        for name in strategies
    ]
    summary = shares[0]
    for share in shares[1:]:
        summary = summary.unionByName(share)
    return summary


def scored_table(
    splits: DataFrame, seeds: Sequence[int], scenarios: Sequence[str], strategies: Sequence[str],
    *, parallelism: int = 4,
) -> DataFrame:
    """Validation and test rows of every run, each scored by a model of its own training rows."""
    runs = [(c, t, s) for c in scenarios for t in strategies for s in seeds]

    def rows_of(strategy: str, seed: int) -> DataFrame:
        return splits.where((F.col("split_strategy") == strategy) & (F.col("seed") == int(seed)))

    models = fit_all(
        [
            (
                build_model_pipeline(schemas.features_of(scenario)),
                rows_of(strategy, seed).where(F.col("split") == "train"),
            )
            for scenario, strategy, seed in runs
        ],
        parallelism=parallelism,
    )
    keep = ["split_strategy", "seed", "split", "row_id", "converted"]
    parts = [
        score_rows(model, rows_of(strategy, seed).where(F.col("split") != "train"), keep=keep)
        .withColumn("scenario", F.lit(scenario))
        for model, (scenario, strategy, seed) in zip(models, runs)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        *RUNS, "split", "row_id", F.col("converted").alias("label"), "score"
    )


def run_decision_optimization(
    conversions: DataFrame,
    *,
    seeds: Sequence[int] = grid.DEFAULT_SEEDS,
    false_negative_costs: Sequence[float] = grid.DEFAULT_FALSE_NEGATIVE_COSTS,
    ceilings: Sequence[float] = grid.DEFAULT_CEILINGS,
    scenarios: Sequence[str] = tuple(schemas.FEATURES),
    strategies: Sequence[str] = STRATEGIES,
    parallelism: int = 4,
) -> DecisionReport:
    """The full decision report over a conversion table with ``row_id``.

    The split table and the long scored table are written once to the shared folder, in one
    partition per run and split, so a fit reads its own rows only; everything after them is one
    plan per report table.
    """
    if not seeds:
        raise ContractError("at least one split seed is required")
    policies = grid.policy_grid(false_negative_costs, ceilings)
    splits = decision_rows(conversions, seeds, strategies)
    scored = written(
        scored_table(splits, seeds, scenarios, strategies, parallelism=parallelism),
        partition_by=(*RUNS, "split"),
    )
    judged = written(grid.policy_runs(scored, policies, runs=RUNS))
    comparison = grid.policy_comparison(judged, runs=RUNS)
    groups = ("scenario", "split_strategy")
    return DecisionReport(
        quality=conversion_quality(conversions),
        splits=strategy_summary(splits, strategies),
        scored=scored,
        runs=judged,
        comparison=comparison,
        summary=grid.policy_summary(comparison, groups=groups),
        diagnostics=grid.ceiling_diagnostics(comparison, groups=groups),
        policies=policies,
        primary_cost=grid.primary_cost(false_negative_costs),
    )
