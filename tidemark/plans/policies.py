"""A grid of decision policies: thresholds frozen on validation rows, judged on test rows.

The whole grid is one plan. Thresholds of all policies are aggregates over one validation sweep,
and their test counts are aggregates over one test histogram.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.errors import ContractError
from tidemark.operators.metrics import (
    CONFUSION_COLUMNS,
    RANKING_COLUMNS,
    double_text,
    threshold_free_metrics,
    with_confusion,
    with_frozen,
)
from tidemark.operators.scores import profile_scores, score_histogram
from tidemark.operators.thresholds import FREE, Policy, choose_thresholds

# The default grid.
DEFAULT_SEEDS = (7, 21, 42, 84, 2026)
DEFAULT_FALSE_NEGATIVE_COSTS = (1.0, 2.0, 4.0, 10.0, 20.0)
DEFAULT_CEILINGS = (0.05, 0.10)
PRIMARY_FALSE_NEGATIVE_COST = 4.0
FIXED_THRESHOLD = 0.5

SELECTED, FIXED, THEORETICAL = "validation_selected", "fixed_0_50", "theoretical_cost_threshold"
ROLES = (SELECTED, FIXED, THEORETICAL)

# The fields of the summary over seeds.
SUMMARY_FIELDS = (
    "threshold",
    "validation_selection_rate",
    "test_selection_rate",
    "test_precision",
    "test_recall",
    "test_f1",
    "test_brier_score",
    "test_calibration_error",
    "fixed_0_50_precision",
    "fixed_0_50_recall",
    "fixed_0_50_selection_rate",
    "fixed_0_50_cost_per_1000",
    "theoretical_threshold",
    "theoretical_precision",
    "theoretical_recall",
    "theoretical_selection_rate",
    "theoretical_cost_per_1000",
    "selected_cost_per_1000",
    "cost_reduction_vs_fixed_0_50",
    "cost_reduction_vs_theoretical",
    "absolute_reduction_vs_fixed_0_50",
    "absolute_reduction_vs_theoretical",
    "false_negatives_avoided_vs_fixed_0_50",
    "additional_false_positives_vs_fixed_0_50",
    "false_negatives_avoided_vs_theoretical",
    "additional_false_positives_vs_theoretical",
)


def policy_grid(
    false_negative_costs: Sequence[float] = DEFAULT_FALSE_NEGATIVE_COSTS,
    ceilings: Sequence[float] = DEFAULT_CEILINGS,
) -> list[Policy]:
    """Every cost with no ceiling and with each ceiling, after checking the arguments."""
    if not false_negative_costs or any(
        not math.isfinite(c) or c <= 0 for c in false_negative_costs
    ):
        raise ContractError("false-negative costs must be finite and positive")
    if any(not math.isfinite(c) or not 0 < c <= 1 for c in ceilings):
        raise ContractError("ceilings must be in (0, 1]")
    grid = [
        Policy(1.0, float(cost), ceiling)
        for ceiling in (None, *ceilings)
        for cost in false_negative_costs
    ]
    if len({(p.label, f"{p.false_negative_cost:g}") for p in grid}) != len(grid):
        raise ContractError("two policies would have the same name")
    return grid


def primary_cost(false_negative_costs: Sequence[float]) -> float:
    for cost in false_negative_costs:
        if math.isclose(cost, PRIMARY_FALSE_NEGATIVE_COST, rel_tol=1e-5):
            return cost
    return false_negative_costs[0]


def _per_policy(values: Sequence[str]) -> str:
    """Look up a literal by ``policy_id``, as SQL text."""
    return f"array({', '.join(values)})[policy_id]"


def frozen_thresholds(
    scored: DataFrame, policies: Sequence[Policy], runs: Sequence[str]
) -> DataFrame:
    """The choice of every policy on the validation rows, per run."""
    validation = scored.where(F.col("split") == "validation")
    return choose_thresholds(validation, policies, runs=runs)


def policy_runs(
    scored: DataFrame, policies: Sequence[Policy], *, runs: Sequence[str] = ("seed",)
) -> DataFrame:
    """Test metrics per run, policy and role.

    ``scored`` has the runs columns, split, row_id, label and score. Roles: the threshold chosen
    on validation, 0.5, and the theoretical threshold of the cost pair. ``ceiling_exceeded`` tells
    whether the test selection is over the policy's ceiling.
    """
    runs = list(runs)
    test = scored.where(F.col("split") == "test")
    profile = profile_scores(scored, order="row_id")
    # Runs times policies rows: small, and read twice below.
    choices = durable(frozen_thresholds(scored, policies, runs))
    frozen = choices.groupBy(*runs).agg(
        F.sort_array(F.collect_list(F.struct("policy_id", "threshold")))["threshold"].alias("cuts")
    )
    literal = sorted({FIXED_THRESHOLD, *[p.theoretical_threshold for p in policies]})
    cuts = [f"cuts[{i}]" for i in range(len(policies))] + [double_text(v) for v in literal]
    counts = (
        with_frozen(score_histogram(test, runs), frozen, runs, "cuts")
        .groupBy(*runs)
        .agg(
            *[
                F.expr(sql)
                for sql in (
                    "first(cuts) as cuts", "sum(pos) as all_pos", "sum(n) as all_n",
                    *[
                        f"coalesce(sum(case when score >= {cut} then {what} end), 0L)"
                        f" as {name}_{i}"
                        for i, cut in enumerate(cuts)
                        for what, name in (("pos", "tp"), ("n", "selected"))
                    ],
                )
            ]
        )
    )
    lines = []
    for i, policy in enumerate(policies):
        at = {
            SELECTED: i,
            FIXED: len(policies) + literal.index(FIXED_THRESHOLD),
            THEORETICAL: len(policies) + literal.index(policy.theoretical_threshold),
        }
        lines += [
            f"named_struct('policy_id', {i}, 'role', '{role}', 'threshold', {cuts[j]},"
            f" 'tp', tp_{j}, 'selected', selected_{j})"
            for role, j in at.items()
        ]
    long = counts.select(*runs, "all_pos", "all_n", F.expr(f"inline(array({', '.join(lines)}))"))
    fn_cost = _per_policy([double_text(p.false_negative_cost) for p in policies])
    judged = with_confusion(
        long, _per_policy([double_text(p.false_positive_cost) for p in policies]), fn_cost
    )
    free = threshold_free_metrics(test, runs=runs, profile=profile).select(
        *runs, *RANKING_COLUMNS
    )
    rate = choices.select(
        *runs, "policy_id", F.col("selection_rate").alias("validation_selection_rate")
    )
    fractions = [p.max_selection_fraction for p in policies]
    ceiling = _per_policy(
        ["cast(null as double)" if f is None else double_text(f) for f in fractions]
    )
    names = _per_policy([f"'{p.label}'" for p in policies])
    return (
        judged.join(F.broadcast(free), runs)
        .join(F.broadcast(rate), [*runs, "policy_id"])
        .selectExpr(
            *runs,
            "policy_id",
            f"{names} as policy",
            f"{fn_cost} as false_negative_cost",
            f"{ceiling} as ceiling",
            "role",
            "threshold",
            "validation_selection_rate",
            *CONFUSION_COLUMNS,
            *RANKING_COLUMNS,
            f"coalesce(selection_rate > {ceiling}, false) as ceiling_exceeded",
        )
    )


def policy_comparison(judged: DataFrame, *, runs: Sequence[str] = ("seed",)) -> DataFrame:
    """One row per run and policy: the selected threshold against both reference thresholds."""
    keys = [*runs, "policy_id", "policy", "false_negative_cost", "ceiling"]
    wanted = (
        "threshold", "validation_selection_rate", "selection_rate", "precision", "recall", "f1",
        "brier_score", "expected_calibration_error", "expected_cost_per_1000", "false_negatives",
        "false_positives", "ceiling_exceeded",
    )
    wide = judged.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("role") == role, F.struct(*wanted))).alias(role)
            for role in ROLES
        ]
    )
    s = SELECTED
    saved = f"{{0}}.expected_cost_per_1000 - {s}.expected_cost_per_1000"
    values = {
        "threshold": f"{s}.threshold",
        "validation_selection_rate": f"{s}.validation_selection_rate",
        "test_selection_rate": f"{s}.selection_rate",
        "test_precision": f"{s}.precision",
        "test_recall": f"{s}.recall",
        "test_f1": f"{s}.f1",
        "test_brier_score": f"{s}.brier_score",
        "test_calibration_error": f"{s}.expected_calibration_error",
        "theoretical_threshold": f"{THEORETICAL}.threshold",
        "selected_cost_per_1000": f"{s}.expected_cost_per_1000",
        "validation_selected_exceeded": f"{s}.ceiling_exceeded",
    }
    for name, other in (("fixed_0_50", FIXED), ("theoretical", THEORETICAL)):
        values |= {
            f"{name}_precision": f"{other}.precision",
            f"{name}_recall": f"{other}.recall",
            f"{name}_f1": f"{other}.f1",
            f"{name}_selection_rate": f"{other}.selection_rate",
            f"{name}_cost_per_1000": f"{other}.expected_cost_per_1000",
            f"cost_reduction_vs_{name}": "coalesce(({0}) / nullif({1}, 0D), 0D)".format(
                saved.format(other), f"{other}.expected_cost_per_1000"
            ),
            f"absolute_reduction_vs_{name}": saved.format(other),
            f"false_negatives_avoided_vs_{name}":
                f"{other}.false_negatives - {s}.false_negatives",
            f"additional_false_positives_vs_{name}":
                f"{s}.false_positives - {other}.false_positives",
            f"{name}_exceeded": f"{other}.ceiling_exceeded",
            f"vs_{name}_feasible": f"not ({s}.ceiling_exceeded or {other}.ceiling_exceeded)",
        }
    return wide.selectExpr(*keys, *[f"{sql} as {name}" for name, sql in values.items()])


def _policy_keys(groups: Sequence[str]) -> list[str]:
    return [*groups, "policy", "false_negative_cost", "ceiling"]


def policy_summary(comparison: DataFrame, *, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, policy, cost, ceiling, field, mean, minimum, maximum) over the seeds."""
    keys = _policy_keys(groups)
    fields = comparison.select(*keys, *[F.col(f).cast("double").alias(f) for f in SUMMARY_FIELDS])
    return (
        fields.unpivot(keys, list(SUMMARY_FIELDS), "field", "value")
        .groupBy(*keys, "field")
        .agg(
            F.avg("value").alias("mean"),
            F.min("value").alias("minimum"),
            F.max("value").alias("maximum"),
        )
    )


def ceiling_diagnostics(comparison: DataFrame, *, groups: Sequence[str] = ()) -> DataFrame:
    """How many runs exceed the ceiling on test rows, and whether comparisons are feasible."""
    return comparison.groupBy(*_policy_keys(groups)).agg(
        F.count_if("validation_selected_exceeded").alias("validation_selected_exceeded_runs"),
        F.count_if("fixed_0_50_exceeded").alias("fixed_0_50_exceeded_runs"),
        F.count_if("theoretical_exceeded").alias("theoretical_cost_threshold_exceeded_runs"),
        F.count(F.lit(1)).alias("total_runs"),
        F.bool_and("vs_fixed_0_50_feasible").alias("vs_fixed_0_50_all_feasible"),
        F.bool_and("vs_theoretical_feasible").alias(
            "vs_theoretical_cost_threshold_all_feasible"
        ),
    )


# The extract's lines, (section, name, summary field).
_UNCONSTRAINED_LINES = (
    ("validation_selected_threshold", "threshold"),
    ("validation_selected_precision", "test_precision"),
    ("validation_selected_recall", "test_recall"),
    ("validation_selected_selection_rate", "test_selection_rate"),
    ("fixed_0_50_modeled_loss_per_1000", "fixed_0_50_cost_per_1000"),
    ("theoretical_threshold_modeled_loss_per_1000", "theoretical_cost_per_1000"),
    ("validation_selected_modeled_loss_per_1000", "selected_cost_per_1000"),
    ("relative_modeled_loss_reduction_vs_fixed_0_50", "cost_reduction_vs_fixed_0_50"),
    (
        "relative_modeled_loss_reduction_vs_theoretical_threshold",
        "cost_reduction_vs_theoretical",
    ),
)
_CEILING_LINES = (
    ("validation_selected_threshold", "threshold"),
    ("validation_selection_rate", "validation_selection_rate"),
    ("test_selection_rate", "test_selection_rate"),
    ("relative_modeled_loss_reduction_vs_fixed_0_50", "cost_reduction_vs_fixed_0_50"),
    (
        "relative_modeled_loss_reduction_vs_theoretical_threshold",
        "cost_reduction_vs_theoretical",
    ),
    ("raw_descriptive_relative_change_vs_fixed_0_50", "cost_reduction_vs_fixed_0_50"),
    (
        "raw_descriptive_relative_change_vs_theoretical_threshold",
        "cost_reduction_vs_theoretical",
    ),
)


def policy_benchmark(
    comparison: DataFrame,
    policies: Sequence[Policy],
    *,
    ceiling: float = 0.05,
    false_negative_cost: float = PRIMARY_FALSE_NEGATIVE_COST,
    groups: Sequence[str] = (),
) -> DataFrame:
    """The reviewed extract at the primary cost: (groups, section, name, mean, minimum, maximum).

    A comparison under the ceiling is null when any run of either policy exceeds the ceiling on
    test rows; the raw change is kept in its own line.
    """
    bound_label = Policy(max_selection_fraction=ceiling).label
    if bound_label not in {p.label for p in policies}:
        raise ContractError("the ceiling is not among the policies")
    primary = comparison.where(F.col("false_negative_cost") == float(false_negative_cost)).where(
        F.col("policy").isin(FREE, bound_label)
    )
    spread = [
        F.struct(
            F.avg(F.col(field).cast("double")).alias("mean"),
            F.min(F.col(field).cast("double")).alias("minimum"),
            F.max(F.col(field).cast("double")).alias("maximum"),
        ).alias(field)
        for field in dict(_UNCONSTRAINED_LINES + _CEILING_LINES).values()
    ]
    spread = list({str(c): c for c in spread}.values())
    rows = primary.groupBy(*groups, "policy").agg(
        *spread,
        F.bool_and("vs_fixed_0_50_feasible").alias("_fixed_ok"),
        F.bool_and("vs_theoretical_feasible").alias("_theoretical_ok"),
    )

    def line(section: str, name: str, field: str, allowed: Column | None = None) -> Column:
        value = F.col(field)
        value = value if allowed is None else F.when(allowed, value)
        return F.struct(
            F.lit(section).alias("section"), F.lit(name).alias("name"),
            *[value[part].alias(part) for part in ("mean", "minimum", "maximum")],
        )

    gates = {
        "relative_modeled_loss_reduction_vs_fixed_0_50": F.col("_fixed_ok"),
        "relative_modeled_loss_reduction_vs_theoretical_threshold": F.col("_theoretical_ok"),
    }
    free = F.array(*[line("seed_summary", n, f) for n, f in _UNCONSTRAINED_LINES])
    bound = F.array(
        *[line("ceiling_sensitivity", n, f, gates.get(n)) for n, f in _CEILING_LINES]
    )
    return rows.select(
        *groups,
        F.inline(F.when(F.col("policy") == FREE, free).otherwise(bound)),
    )
