"""Contract of a scoring request: the model's features in training order, other columns ignored.

Missing values and unseen categories are allowed, since the model imputes and encodes them.
Impossible values are not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.text import strip
from tidemark.operators.checks import (
    Rule,
    broken,
    raise_first,
    require_columns,
    violation_rows,
)
from tidemark.operators.conversion import as_number, require_sound_features


def _invalid(frame: DataFrame, column: str) -> list[tuple[str, Column]]:
    """(rule, row is broken) for one numeric feature, in the order of raising."""
    value, number = F.col(column), as_number(frame, column)
    boolean = isinstance(frame.schema[column].dataType, T.BooleanType)
    out = []
    if column in schemas.COUNT_LIKE:
        out.append(("has boolean values", F.lit(boolean) & value.isNotNull()))
    out.append(("has values that are no numbers", value.isNotNull() & number.isNull()))
    out.append(("has values that are not finite", F.abs(number) == float("inf")))
    if column in schemas.COUNT_LIKE:
        out.append(("has values that are not whole", number % 1 != 0))
    if column == "new_user":
        out.append(("is not binary", ~F.isnan(number) & ~number.isin(0.0, 1.0)))
    elif column == "age":
        low, high = schemas.AGE_RANGE
        out.append(("is out of range", ~F.isnan(number) & ~number.between(low, high)))
    elif column == "total_pages_visited":
        out.append(("is not positive", number < 1))
    return out


def _rules(frame: DataFrame, features: Sequence[str]) -> list[Rule]:
    numeric = [c for c in features if c not in schemas.CATEGORICAL]
    # The kinds of fault come first in the order, the columns second.
    order = (
        "has boolean values",
        "has values that are no numbers",
        "has values that are not finite",
        "has values that are not whole",
        "is not binary",
        "is out of range",
        "is not positive",
    )
    found = [
        (order.index(what), column, f"{column} {what}", broken(bad))
        for column in numeric
        for what, bad in _invalid(frame, column)
    ]
    found.sort(key=lambda f: f[0])
    return [Rule(i, "scoring request", f[2], f[3]) for i, f in enumerate(found)]


def scoring_violations(frame: DataFrame, scenario: str) -> DataFrame:
    """All counters of the scoring contract, from one pass."""
    features = schemas.features_of(scenario)
    work = require_columns(frame, features, "scoring request")
    return violation_rows(work, _rules(work, features))


def typed_features(frame: DataFrame, features: Sequence[str]) -> list[Column]:
    """The features in training order: trimmed categories (blank is null), finite doubles."""
    out = []
    for column in features:
        if column in schemas.CATEGORICAL:
            text = strip(F.col(column))
            out.append(F.when(text != "", text).alias(column))
        else:
            number = as_number(frame, column)
            out.append(F.when(~F.isnan(number), number).alias(column))
    return out


def prepare_features(
    frame: DataFrame, scenario: str, *, keep: Sequence[str] = (), validate: bool = True
) -> DataFrame:
    """Project a scoring request to the scenario's features, in training order."""
    features = schemas.features_of(scenario)
    require_columns(frame, (*keep, *features), "scoring request")
    if validate:
        raise_first(scoring_violations(frame, scenario))
    return frame.select(*keep, *typed_features(frame, features))


def guarded_features(frame: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Like ``prepare_features`` but checked row by row when the plan runs.

    A row that breaks a rule fails the job, so a lazily scored table cannot carry a bad value.
    """
    require_sound_features(tuple(features))
    require_columns(frame, (*keep, *features), "scoring request")
    columns = []
    for name, column in zip(features, typed_features(frame, features)):
        if name not in schemas.CATEGORICAL:
            faults = F.lit(None).cast("string")
            for what, bad in reversed(_invalid(frame, name)):
                text = F.lit(f"scoring request: {name} {what}")
                faults = F.when(F.coalesce(bad, F.lit(False)), text).otherwise(faults)
            column = F.when(faults.isNull(), column).otherwise(
                F.raise_error(faults).cast("double")
            ).alias(name)
        columns.append(column)
    return frame.select(*keep, *columns)
