"""Metrics of scored rows. All but the budget ranking are sums over the threshold sweep."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.combine import side_by_side
from tidemark.operators.prefix import running_totals
from tidemark.operators.scores import (
    ScoreProfile,
    profile_scores,
    ratio,
    require_sound_scores,
    score_histogram,
    threshold_sweep,
)

BUDGET_TIE_POLICY = "stable_input_order"


def require_costs(false_positive_cost: float, false_negative_cost: float) -> None:
    costs = (false_positive_cost, false_negative_cost)
    if not all(math.isfinite(c) for c in costs):
        raise ContractError("misclassification costs must be finite")
    if min(costs) < 0:
        raise ContractError("misclassification costs must not be negative")
    if max(costs) == 0:
        raise ContractError("one misclassification cost must be positive")


def require_threshold(threshold: float) -> None:
    if not math.isfinite(threshold):
        raise ContractError("threshold must be finite")


def require_budget(fraction: float) -> None:
    if not 0 < fraction <= 1:
        raise ContractError("budget fraction must be in (0, 1]")


def cost_per_1000(fp: str, fn: str, n: str, fp_cost: str, fn_cost: str) -> str:
    """Expected cost of a thousand rows as SQL text; costs are SQL text of doubles."""
    return (
        f"(cast({fp} as double) * {fp_cost} + cast({fn} as double) * {fn_cost})"
        f" / cast({n} as double) * 1000D"
    )


def with_confusion(frame: DataFrame, fp_cost: str, fn_cost: str) -> DataFrame:
    """Add the counts and rates that follow from tp, selected, all_pos and all_n."""
    expressions = {
        "precision": ratio_text("tp", "selected"),
        "recall": ratio_text("tp", "all_pos"),
        "f1": ratio_text("2 * tp", "selected + all_pos"),
        "expected_cost_per_1000": cost_per_1000(
            "selected - tp", "all_pos - tp", "all_n", fp_cost, fn_cost
        ),
        "true_negatives": "all_n - selected - all_pos + tp",
        "false_positives": "selected - tp",
        "false_negatives": "all_pos - tp",
        "true_positives": "tp",
        "selected_rows": "selected",
        "selection_rate": ratio_text("selected", "all_n"),
    }
    return frame.withColumns({name: F.expr(text) for name, text in expressions.items()})


def double_text(value: float) -> str:
    """A double literal as SQL text, digit for digit."""
    return f"cast('{float(value)!r}' as double)"


def ratio_text(top: str, bottom: str) -> str:
    return (
        f"case when {bottom} = 0 then 0D"
        f" else cast({top} as double) / cast({bottom} as double) end"
    )


CONFUSION_COLUMNS = (
    "precision",
    "recall",
    "f1",
    "expected_cost_per_1000",
    "true_negatives",
    "false_positives",
    "false_negatives",
    "true_positives",
    "selected_rows",
    "selection_rate",
)


def confusion(
    frame: DataFrame,
    threshold: float,
    *,
    false_positive_cost: float = 1.0,
    false_negative_cost: float = 10.0,
    runs: Sequence[str] = (),
    validate: bool = True,
) -> DataFrame:
    """Confusion counts, rates and cost at ``score >= threshold``."""
    require_costs(false_positive_cost, false_negative_cost)
    require_threshold(threshold)
    if validate:
        require_sound_scores(frame)
    label = F.col("label").cast("bigint")
    above = F.col("score") >= F.lit(float(threshold))
    counts = frame.groupBy(*runs).agg(
        F.coalesce(F.sum(F.when(above, label)), F.lit(0)).alias("tp"),
        F.count_if(above).alias("selected"),
        F.sum(label).alias("all_pos"),
        F.count(F.lit(1)).alias("all_n"),
    )
    return with_confusion(
        counts, double_text(false_positive_cost), double_text(false_negative_cost)
    ).select(*runs, F.lit(float(threshold)).alias("threshold"), *CONFUSION_COLUMNS)


SQUARED_ERROR = "pos * (score - 1D) * (score - 1D) + (n - pos) * score * score"
BRIER = f"sum({SQUARED_ERROR}) / sum(n)"
BIAS = "sum(score * n) / sum(n) - sum(pos) / sum(n)"


def brier_and_bias(
    frame: DataFrame, runs: Sequence[str] = (), *, validate: bool = True
) -> DataFrame:
    """Brier score, and mean score minus mean label."""
    if validate:
        require_sound_scores(frame)
    return score_histogram(frame, runs).groupBy(*runs).agg(
        F.expr(BRIER).alias("brier_score"), F.expr(BIAS).alias("calibration_bias")
    )


def score_bin(bins: int) -> str:
    return f"cast(least(floor(score * {bins}), {bins - 1}) as int)"


def calibration_error(
    frame: DataFrame, *, bins: int = 10, runs: Sequence[str] = (), validate: bool = True
) -> DataFrame:
    """Expected calibration error over equal-width bins, the last one closed."""
    if bins < 2:
        raise ContractError("at least two bins are needed")
    if validate:
        require_sound_scores(frame)
    return (
        score_histogram(frame, runs)
        .groupBy(*runs, F.expr(score_bin(bins)).alias("bin"))
        .agg(
            F.sum("n").alias("n"),
            F.sum("pos").alias("pos"),
            F.sum(F.col("score") * F.col("n")).alias("mass"),
        )
        .groupBy(*runs)
        .agg(
            (F.sum(F.abs(F.col("pos") - F.col("mass"))) / F.sum("n")).alias(
                "expected_calibration_error"
            )
        )
    )


def roc_auc_sum() -> Column:
    """Aggregate over the sweep: area under the ROC curve, ties counting half."""
    pairs = "cast(max(all_pos) as double) * cast(max(all_n - all_pos) as double)"
    wins = (
        "cast(pos as double)"
        " * (cast(all_n - all_pos - cum_n + cum_pos as double) + (n - pos) / 2D)"
    )
    return F.expr(f"sum({wins}) / nullif({pairs}, 0D)")


def average_precision_sum() -> Column:
    """Aggregate over the sweep: step sum of precision over the gain in recall."""
    return F.expr(
        "coalesce(sum(cast(pos as double) * cum_pos / cum_n)"
        " / nullif(cast(max(all_pos) as double), 0D), 0D)"
    )


def roc_auc(frame: DataFrame, runs: Sequence[str] = ()) -> DataFrame:
    """Null when only one label occurs."""
    return threshold_sweep(frame, runs).groupBy(*runs).agg(roc_auc_sum().alias("roc_auc"))


def average_precision(frame: DataFrame, runs: Sequence[str] = ()) -> DataFrame:
    return threshold_sweep(frame, runs).groupBy(*runs).agg(
        average_precision_sum().alias("average_precision")
    )


def curve_points(frame: DataFrame, runs: Sequence[str] = ()) -> DataFrame:
    """ROC and precision-recall points, one row per distinct score."""
    negatives = F.col("all_n") - F.col("all_pos")
    return threshold_sweep(frame, runs).select(
        *runs,
        F.col("score").alias("threshold"),
        ratio(F.col("cum_n") - F.col("cum_pos"), negatives, None).alias("false_positive_rate"),
        ratio(F.col("cum_pos"), F.col("all_pos"), None).alias("true_positive_rate"),
        ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
    )


BUDGET_COLUMNS = (
    "budget_selected_rows",
    "budget_selected_positives",
    "budget_fraction",
    "budget_tie_break_policy",
    "budget_boundary_score",
    "budget_boundary_tie_rows",
    "budget_selected_from_boundary_tie",
    "precision_at_budget",
    "recall_at_budget",
    "lift_at_budget",
)


def _boundary_struct(fraction: float) -> Column:
    """Aggregate over the sweep: the block in which the budget ends."""
    k = f"cast(greatest(1, ceil(all_n * {double_text(fraction)})) as bigint)"
    return F.expr(
        f"min(case when cum_n >= {k} then named_struct('cum_n', cum_n, 'score', score, 'n', n,"
        f" 'pos', pos, 'cum_pos', cum_pos, 'all_pos', all_pos, 'all_n', all_n, 'k', {k}) end)"
    )


def _budget_columns(
    blocks: DataFrame, frame: DataFrame, runs: Sequence[str], fraction: float,
    order_points: Sequence[float],
) -> DataFrame:
    """Complete ``blocks`` (runs, ``edge``) with the ranking columns.

    Only rows of a block that the budget cuts through are read, and their order by ``row_id`` is
    a bucketed running total, so a block may hold any share of the table.
    """
    runs = list(runs)
    blocks = blocks.withColumn("_take", F.col("edge.k") - F.col("edge.cum_n") + F.col("edge.n"))
    cut = blocks.where(F.col("_take") < F.col("edge.n")).select(
        *runs, F.col("edge.score").alias("_edge"), "_take"
    )
    scores = frame.select(
        *runs, "row_id", F.col("label").cast("bigint").alias("label"),
        (F.col("score").cast("double") + F.lit(0.0)).alias("_edge"), F.lit(1).alias("one"),
    )
    # One row per run: a bounded broadcast. Null runs are runs.
    same = F.col("_edge") == F.col("_cut__edge")
    for k in runs:
        same = same & F.col(k).eqNullSafe(F.col(f"_cut_{k}"))
    cuts = cut.select(*[F.col(c).alias(f"_cut_{c}") for c in (*runs, "_edge")], "_take")
    tied = scores.join(F.broadcast(cuts), same).select(*scores.columns, "_take")
    taken = (
        running_totals(tied, runs, "row_id", ["label", "one"], order_points)
        .where(F.col("cum_one") == F.col("_take"))
        .groupBy(*runs)
        .agg(F.max("cum_label").alias("_taken_pos"))
    )
    full = side_by_side([blocks, taken], runs)
    # A block that is cut must have been counted.
    lost = "cast(raise_error('rows of a cut block are missing') as bigint)"
    taken_pos = f"case when _take < edge.n then coalesce(_taken_pos, {lost}) else edge.pos end"
    positives = f"{taken_pos} + edge.cum_pos - edge.pos"
    precision = f"cast({positives} as double) / edge.k"
    expressions = {
        "budget_selected_rows": "edge.k",
        "budget_selected_positives": positives,
        "budget_fraction": double_text(fraction),
        "budget_tie_break_policy": f"'{BUDGET_TIE_POLICY}'",
        "budget_boundary_score": "edge.score",
        "budget_boundary_tie_rows": "edge.n",
        "budget_selected_from_boundary_tie": "_take",
        "precision_at_budget": precision,
        "recall_at_budget": ratio_text(positives, "edge.all_pos"),
        "lift_at_budget": f"coalesce({precision}"
        " / nullif(cast(edge.all_pos as double) / edge.all_n, 0D), 0D)",
    }
    return full.withColumns({name: F.expr(text) for name, text in expressions.items()}).drop(
        "edge", "_take", "_taken_pos"
    )


def _require_order(frame: DataFrame) -> None:
    if "row_id" not in frame.columns:
        raise ContractError("budget ranking needs the order column row_id")


def ranking_at_budget(
    frame: DataFrame, *, budget_fraction: float = 0.05, runs: Sequence[str] = (),
    profile: ScoreProfile | None = None,
) -> DataFrame:
    """Precision, recall and lift of the best ``ceil(n * budget_fraction)`` rows.

    Ties at the boundary are taken in the order of ``row_id``.
    """
    require_budget(budget_fraction)
    _require_order(frame)
    profile = profile or profile_scores(frame, order="row_id")
    blocks = threshold_sweep(frame, runs, profile=profile).groupBy(*runs).agg(
        _boundary_struct(budget_fraction).alias("edge")
    )
    return _budget_columns(
        blocks, frame, runs, budget_fraction, profile.order_points
    ).select(*runs, *BUDGET_COLUMNS)


def with_frozen(
    rows: DataFrame, frozen: DataFrame, by: Sequence[str], value: str
) -> DataFrame:
    """Add the frozen ``value`` of each run; a run that has none, or rows of no run, raise.

    ``frozen`` has one row per run: a bounded broadcast. Null runs are runs.
    """
    known = frozen.select(*[F.col(k).alias(f"_of_{k}") for k in by], value, F.lit(1).alias("_known"))
    same = F.lit(True)
    for k in by:
        same = same & rows[k].eqNullSafe(F.col(f"_of_{k}"))
    missing = F.raise_error(F.lit("a run has no validation rows to choose a threshold on"))
    kind = frozen.schema[value].dataType
    checked = F.when(F.col("_known").isNull(), missing.cast(kind)).otherwise(F.col(value))
    return rows.join(F.broadcast(known), same, "left").select(*rows.columns, checked.alias(value))


def confusion_at(
    frame: DataFrame, thresholds: DataFrame, *, runs: Sequence[str], by: Sequence[str],
    false_positive_cost: float = 1.0, false_negative_cost: float = 10.0,
) -> DataFrame:
    """Confusion columns per ``runs`` at the threshold that ``thresholds`` has per ``by``."""
    above = F.col("score") >= F.col("threshold")
    # One row per run: a bounded broadcast.
    counts = (
        with_frozen(score_histogram(frame, runs), thresholds, by, "threshold")
        .groupBy(*runs)
        .agg(
            F.max("threshold").alias("threshold"),
            F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)).alias("tp"),
            F.coalesce(F.sum(F.when(above, F.col("n"))), F.lit(0)).alias("selected"),
            F.sum("pos").alias("all_pos"),
            F.sum("n").alias("all_n"),
        )
    )
    return with_confusion(
        counts, double_text(false_positive_cost), double_text(false_negative_cost)
    ).select(*runs, "threshold", *CONFUSION_COLUMNS)


RANKING_COLUMNS = (
    "roc_auc",
    "average_precision",
    "brier_score",
    "calibration_bias",
    "expected_calibration_error",
)


def threshold_free_metrics(
    frame: DataFrame,
    *,
    runs: Sequence[str] = (),
    budget_fraction: float = 0.05,
    bins: int = 10,
    profile: ScoreProfile | None = None,
) -> DataFrame:
    """Every metric that needs no threshold, per run: one pass over the sweep."""
    require_budget(budget_fraction)
    _require_order(frame)
    profile = profile or profile_scores(frame, order="row_id")
    # The bins are few, so their sums are columns of the same aggregate.
    gap = " + ".join(
        f"abs(sum(case when {score_bin(bins)} = {b} then pos - score * n else 0D end))"
        for b in range(bins)
    )
    blocks = threshold_sweep(frame, runs, profile=profile).groupBy(*runs).agg(
        roc_auc_sum().alias("roc_auc"),
        average_precision_sum().alias("average_precision"),
        F.expr(BRIER).alias("brier_score"),
        F.expr(BIAS).alias("calibration_bias"),
        F.expr(f"({gap}) / sum(n)").alias("expected_calibration_error"),
        _boundary_struct(budget_fraction).alias("edge"),
    )
    return _budget_columns(blocks, frame, runs, budget_fraction, profile.order_points)


METRIC_COLUMNS = (*RANKING_COLUMNS, "threshold", *CONFUSION_COLUMNS, *BUDGET_COLUMNS)


def evaluate(
    frame: DataFrame,
    threshold: float,
    *,
    false_positive_cost: float = 1.0,
    false_negative_cost: float = 10.0,
    budget_fraction: float = 0.05,
    runs: Sequence[str] = (),
) -> DataFrame:
    """The full metric row of SURVEY section 1.3, per run, at one threshold."""
    runs = list(runs)
    require_costs(false_positive_cost, false_negative_cost)
    require_threshold(threshold)
    free = threshold_free_metrics(frame, runs=runs, budget_fraction=budget_fraction)
    at = confusion(
        frame, threshold, false_positive_cost=false_positive_cost,
        false_negative_cost=false_negative_cost, runs=runs, validate=False,
    )
    return side_by_side([free, at], runs).select(*runs, *METRIC_COLUMNS)


def descriptive_rates(frame: DataFrame) -> DataFrame:
    """Conversion rate by country, by age band and by pages, as (panel, level, rows, rate)."""
    age = F.col("age")
    # Right-closed age bands.
    edges = (12, 20, 30, 40, 50, 60, 100)
    band = F.lit(None).cast("string")
    for low, high in zip(reversed(edges[:-1]), reversed(edges[1:])):
        band = F.when((age > low) & (age <= high), F.lit(f"({low}, {high}]")).otherwise(band)
    panels = F.array(
        F.struct(F.lit("country").alias("panel"), F.col("country").alias("level")),
        F.struct(F.lit("age_band").alias("panel"), band.alias("level")),
        F.struct(
            F.lit("pages").alias("panel"),
            F.col("total_pages_visited").cast("bigint").cast("string").alias("level"),
        ),
    )
    return (
        frame.select(F.col("converted").cast("bigint").alias("converted"), F.inline(panels))
        .where("level is not null")
        .groupBy("panel", "level")
        .agg(F.count(F.lit(1)).alias("rows"), F.avg("converted").alias("conversion_rate"))
    )
