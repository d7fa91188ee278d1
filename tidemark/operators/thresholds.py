"""Cost-sensitive thresholds: every distinct score is a candidate, and so is selecting none."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.metrics import cost_per_1000, double_text, require_costs
from tidemark.operators.scores import ScoreProfile, profile_scores, threshold_sweep

OBJECTIVE = "minimize_expected_misclassification_cost"
# The names of policies without and with a ceiling.
FREE, CEILED = "unconstrained", "validation_selection_ceiling_"
CHOICE_COLUMNS = (
    "threshold",
    "expected_cost_per_1000",
    "false_positive_cost",
    "false_negative_cost",
    "selected_rows",
    "selection_rate",
    "objective",
    "max_selection_fraction",
    "max_selected_rows",
    "policy_unused_capacity_rows",
    "capacity_binding",
    "max_feasible_selected_rows",
    "frontier_unused_capacity_rows",
    "cutoff_tie_rows",
    "next_infeasible_tie_rows",
)


@dataclass(frozen=True)
class Policy:
    """A cost pair and an optional ceiling on the share of rows selected."""

    false_positive_cost: float = 1.0
    false_negative_cost: float = 10.0
    max_selection_fraction: float | None = None

    def check(self) -> None:
        require_costs(self.false_positive_cost, self.false_negative_cost)
        ceiling = self.max_selection_fraction
        if ceiling is not None and not 0 < ceiling <= 1:
            raise ContractError("selection ceiling must be in (0, 1]")

    @property
    def label(self) -> str:
        """The text that names the ceiling in result tables."""
        share = self.max_selection_fraction
        return FREE if share is None else f"{CEILED}{share:.3f}"

    @property
    def theoretical_threshold(self) -> float:
        """The best threshold when scores are calibrated probabilities."""
        return self.false_positive_cost / (self.false_positive_cost + self.false_negative_cost)


def next_up(value: str) -> str:
    """The next double above ``value``, as SQL text."""
    return f"cast(java_method('java.lang.Math', 'nextUp', {value}) as double)"


def _policy_struct(policy: Policy, i: int, cost: int, limit: str | None) -> str:
    """The fifteen choice columns from the aggregates numbered ``i``, as SQL text."""
    fp_cost, fn_cost = double_text(policy.false_positive_cost), double_text(
        policy.false_negative_cost
    )
    # least() skips nulls, so a policy whose first block is too large falls back to none.
    best, free = f"least(best_{i}, none_{cost})", f"least(free_{i}, none_{cost})"
    null = "cast(null as bigint)"
    values = {
        "threshold": f"-{best}.minus_score",
        "expected_cost_per_1000": f"{best}.cost",
        "false_positive_cost": fp_cost,
        "false_negative_cost": fn_cost,
        "selected_rows": f"{best}.selected",
        "selection_rate": f"cast({best}.selected as double) / all_n",
        "objective": f"'{OBJECTIVE}'",
        "cutoff_tie_rows": f"{best}.ties",
    }
    if limit is None:
        values |= {
            "max_selection_fraction": "cast(null as double)",
            "max_selected_rows": null,
            "policy_unused_capacity_rows": null,
            "capacity_binding": "false",
            "max_feasible_selected_rows": null,
            "frontier_unused_capacity_rows": null,
            "next_infeasible_tie_rows": null,
        }
    else:
        frontier = f"coalesce(frontier_{i}, 0L)"
        values |= {
            "max_selection_fraction": double_text(policy.max_selection_fraction),
            "max_selected_rows": limit,
            "policy_unused_capacity_rows": f"{limit} - {best}.selected",
            "capacity_binding": f"{free}.selected > {limit}",
            "max_feasible_selected_rows": frontier,
            "frontier_unused_capacity_rows": f"{limit} - {frontier}",
            "next_infeasible_tie_rows": f"next_{i}.n",
        }
    fields = ", ".join(f"'{name}', {values[name]}" for name in CHOICE_COLUMNS)
    return f"named_struct('policy_id', {i}, {fields})"


def choose_thresholds(
    frame: DataFrame,
    policies: Sequence[Policy],
    *,
    runs: Sequence[str] = (),
    profile: ScoreProfile | None = None,
) -> DataFrame:
    """One row per run and policy: ``policy_id`` (position in ``policies``) and the choice.

    All policies are aggregates over one sweep; rows are not multiplied by policies.
    """
    if not policies:
        raise ContractError("at least one policy is needed")
    for policy in policies:
        policy.check()
    profile = profile or profile_scores(frame)
    costs = sorted({(p.false_positive_cost, p.false_negative_cost) for p in policies})
    ceilings = sorted({p.max_selection_fraction for p in policies} - {None})
    text = [(double_text(fp), double_text(fn)) for fp, fn in costs]
    work = {"_minus_score": "-score"}
    for i, (fp, fn) in enumerate(text):
        work[f"_cost_{i}"] = cost_per_1000("cum_n - cum_pos", "all_pos - cum_pos", "all_n", fp, fn)
    for i, ceiling in enumerate(ceilings):
        work[f"_limit_{i}"] = f"floor(all_n * {double_text(ceiling)})"
    sweep = threshold_sweep(frame, runs, profile=profile).withColumns(
        {name: F.expr(sql) for name, sql in work.items()}
    )
    aggregates = {
        "all_n": "max(all_n)", "all_pos": "max(all_pos)", "top_score": "max(score)",
        **{f"_limit_{i}": f"max(_limit_{i})" for i in range(len(ceilings))},
    }
    chosen = []
    # Least cost, then highest threshold; equal aggregates of several policies run once.
    for i, policy in enumerate(policies):
        cost = costs.index((policy.false_positive_cost, policy.false_negative_cost))
        block = (
            f"named_struct('cost', _cost_{cost}, 'minus_score', _minus_score,"
            " 'selected', cum_n, 'ties', n)"
        )
        aggregates[f"free_{i}"] = f"min({block})"
        if policy.max_selection_fraction is None:
            limit = None
            aggregates[f"best_{i}"] = f"min({block})"
        else:
            limit = f"_limit_{ceilings.index(policy.max_selection_fraction)}"
            aggregates |= {
                f"best_{i}": f"min(case when cum_n <= {limit} then {block} end)",
                f"frontier_{i}": f"max(case when cum_n <= {limit} then cum_n end)",
                f"next_{i}":
                    f"min(case when cum_n > {limit} then named_struct('c', cum_n, 'n', n) end)",
            }
        chosen.append(_policy_struct(policy, i, cost, limit))
    none = {
        f"none_{i}": "named_struct('cost', "
        + cost_per_1000("0", "all_pos", "all_n", fp, fn)
        + f", 'minus_score', -{next_up('top_score')}, 'selected', 0L, 'ties', 0L)"
        for i, (fp, fn) in enumerate(text)
    }
    return (
        sweep.groupBy(*runs)
        .agg(*[F.expr(sql).alias(name) for name, sql in aggregates.items()])
        .withColumns({name: F.expr(sql) for name, sql in none.items()})
        .select(*runs, F.expr(f"inline(array({', '.join(chosen)}))"))
    )


def select_threshold(
    frame: DataFrame,
    *,
    false_positive_cost: float = 1.0,
    false_negative_cost: float = 10.0,
    max_selection_fraction: float | None = None,
    runs: Sequence[str] = (),
) -> DataFrame:
    """The choice of one policy, per run."""
    policy = Policy(false_positive_cost, false_negative_cost, max_selection_fraction)
    return choose_thresholds(frame, [policy], runs=runs).drop("policy_id")


def candidate_thresholds(frame: DataFrame, *, policy: Policy = Policy()) -> DataFrame:
    """Every candidate with its counts and cost: all distinct scores, and selecting none."""
    policy.check()
    sweep = threshold_sweep(frame)
    first = sweep.agg(
        F.expr(next_up("max(score)")).alias("threshold"),
        F.expr("0L").alias("tie_rows"),
        F.expr("0L").alias("selected_rows"),
        F.expr("0L").alias("true_positives"),
        F.max("all_pos").alias("all_pos"),
        F.max("all_n").alias("all_n"),
    )
    rest = sweep.selectExpr(
        "score as threshold", "n as tie_rows", "cum_n as selected_rows",
        "cum_pos as true_positives", "all_pos", "all_n",
    )
    fp, fn = "selected_rows - true_positives", "all_pos - true_positives"
    cost = cost_per_1000(
        fp, fn, "all_n", double_text(policy.false_positive_cost),
        double_text(policy.false_negative_cost),
    )
    return first.unionByName(rest).selectExpr(
        "threshold", "tie_rows", "selected_rows", f"{fp} as false_positives",
        f"{fn} as false_negatives", f"{cost} as expected_cost_per_1000",
    )
