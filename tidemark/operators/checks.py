"""Contract checks: violation counters of one table, read in a single pass.

Each rule is one aggregate column. A table's rules run together, and the first broken one, in
the order given, is raised with its count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.errors import ContractError


@dataclass(frozen=True)
class Rule:
    """``position`` fixes the order in which broken rules are raised."""

    position: int
    table: str
    name: str
    count: Column


def broken(invalid: Column) -> Column:
    """Rows where ``invalid`` is true; null counts as not broken."""
    return F.coalesce(F.count_if(invalid), F.lit(0)).cast("bigint")


def broken_unless(valid: Column) -> Column:
    """Rows where ``valid`` is not true; null counts as broken."""
    return F.count_if(~F.coalesce(valid, F.lit(False))).cast("bigint")


def violation_rows(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(position, table, rule, violations), one row per rule, from one aggregate."""
    wide = frame.agg(*[rule.count.alias(f"_{i}") for i, rule in enumerate(rules)])
    lines = ", ".join(
        f"named_struct('position', {rule.position}, 'table', '{rule.table}',"
        f" 'rule', '{rule.name}', 'violations', cast(coalesce(_{i}, 0) as bigint))"
        for i, rule in enumerate(rules)
    )
    return wide.select(F.expr(f"inline(array({lines}))"))


def raise_first(violations: DataFrame, error: type[ContractError] = ContractError) -> None:
    """Run the counters and raise the first broken rule. The result has one row per rule."""
    worst = violations.where("violations > 0").orderBy("position").limit(1).first()
    if worst is not None:
        raise_violation(worst, error)


def raise_violation(row: Row, error: type[ContractError] = ContractError) -> None:
    raise error(f"{row['table']}: {row['rule']}; count={row['violations']}")


def require_unique_columns(
    columns: Iterable[str], context: str, error: type[ContractError] = ContractError
) -> None:
    """Reject names that collide. Spark resolves names ignoring case, so case does not help."""
    seen = Counter(name.lower() for name in columns)
    count = sum(n for n in seen.values() if n > 1)
    if count:
        raise error(f"{context}: duplicate column names; count={count}")


def require_columns(
    frame: DataFrame, expected: Sequence[str], context: str,
    error: type[ContractError] = ContractError,
) -> DataFrame:
    """Project to ``expected``; extra columns are dropped."""
    require_unique_columns(frame.columns, context, error)
    missing = sorted(set(expected) - set(frame.columns))
    if missing:
        raise error(f"{context}: missing columns {missing}; count={len(missing)}")
    return frame.select(*expected)


def require_exact_columns(
    frame: DataFrame, expected: Sequence[str], context: str,
    error: type[ContractError] = ContractError,
) -> DataFrame:
    """Project to ``expected``; extra columns are an error."""
    require_unique_columns(frame.columns, context, error)
    missing = sorted(set(expected) - set(frame.columns))
    extra = sorted(set(frame.columns) - set(expected))
    if missing or extra:
        raise error(
            f"{context}: missing columns {missing}, unexpected columns {extra}; "
            f"count={len(missing) + len(extra)}"
        )
    return frame.select(*expected)


def duplicate_key_rows(frame: DataFrame, key: Column) -> DataFrame:
    """One row, column ``rows``: how many rows sit in groups that share a key."""
    return (
        frame.where(key.isNotNull())
        .groupBy(key.alias("_key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    )
