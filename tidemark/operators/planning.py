"""Enrollment planning: units per arm for a two-proportion test, for every segment."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError


def _fraction(value: object, name: str, *, zero: bool = False) -> float:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if not number or not (0 <= value < 1 if zero else 0 < value < 1):
        raise ContractError(f"{name} must be a number in {'[0, 1)' if zero else '(0, 1)'}")
    return float(value)


def required_units(
    baseline: Column, treatment: Column, *, alpha: float, power: float, attrition: float
) -> Column:
    """Units per arm by the normal approximation, as a column; null outside its range."""
    z_alpha = F.lit(NormalDist().inv_cdf(1 - alpha / 2))
    z_power = F.lit(NormalDist().inv_cdf(power))
    pooled = (baseline + treatment) / 2
    root = z_alpha * F.sqrt(2 * pooled * (1 - pooled)) + z_power * F.sqrt(
        baseline * (1 - baseline) + treatment * (1 - treatment)
    )
    gap = treatment - baseline
    units = F.ceil(root * root / F.when(gap != 0, gap * gap) / F.lit(1 - attrition))
    sound = (baseline > 0) & (baseline < 1) & (treatment > 0) & (treatment < 1) & (root > 0)
    return F.when(sound, units)


def plan_enrollment(
    frame: DataFrame,
    segments: Sequence[str],
    *,
    unit: str,
    outcome: str,
    relative_lift: float,
    alpha: float = 0.05,
    power: float = 0.80,
    attrition: float = 0.05,
) -> DataFrame:
    """Baseline rate over distinct units and the units each arm needs, per segment.

    A unit counts as converted when any of its rows is. ``reason`` says why a segment has no
    plan.
    """
    alpha, power = _fraction(alpha, "alpha"), _fraction(power, "power")
    attrition = _fraction(attrition, "attrition", zero=True)
    if not isinstance(relative_lift, (int, float)) or not math.isfinite(relative_lift):
        raise ContractError("relative lift must be a finite number")
    if math.isclose(1.0, 1.0 + relative_lift):
        raise ContractError("baseline and treatment rates must differ")
    rates = (
        frame.groupBy(*segments, unit)
        .agg(F.max(F.col(outcome).cast("int")).alias("hit"))
        .groupBy(*segments)
        .agg(
            F.count(F.lit(1)).alias("units"),
            F.avg(F.col("hit").cast("double")).alias("baseline_rate"),
        )
        .withColumn("treatment_rate", F.col("baseline_rate") * F.lit(1 + relative_lift))
    )
    baseline, treatment = F.col("baseline_rate"), F.col("treatment_rate")
    per_arm = required_units(
        baseline, treatment, alpha=alpha, power=power, attrition=attrition
    ).cast("bigint")
    reason = (
        F.when(baseline <= 0, "no_conversions")
        .when(baseline >= 1, "all_converted")
        .when((treatment <= 0) | (treatment >= 1), "treatment_rate_out_of_range")
    )
    return rates.withColumns(
        {"units_per_arm": per_arm, "total_units": per_arm * 2, "reason": reason}
    ).select(
        *segments, "units", "baseline_rate", "treatment_rate", "units_per_arm", "total_units",
        "reason",
    )
