"""Contract of the conversion table: one row per session, six columns, no key and no time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.errors import ContractError
from tidemark.functions.text import strip
from tidemark.operators.checks import (
    Rule,
    broken,
    broken_unless,
    raise_first,
    require_columns,
    violation_rows,
)
from tidemark.operators.combine import side_by_side

NUMERIC = ("age", "new_user", "total_pages_visited", "converted")
FEATURES = tuple(c for c in schemas.CONVERSION_COLUMNS if c != "converted")


def as_number(frame: DataFrame, column: str) -> Column:
    """The column as a double; text that is no number gives null."""
    value = F.col(column)
    if isinstance(frame.schema[column].dataType, T.BooleanType):
        value = value.cast("int")
    elif isinstance(frame.schema[column].dataType, T.StringType):
        value = strip(value)
    return value.try_cast("double")


def _rules(frame: DataFrame) -> list[Rule]:
    table = "conversions"
    rules: list[Rule] = []

    def add(name: str, count: Column) -> None:
        rules.append(Rule(len(rules), table, name, count))

    for column in NUMERIC:
        value, number = F.col(column), as_number(frame, column)
        boolean = isinstance(frame.schema[column].dataType, T.BooleanType)
        if column in schemas.COUNT_LIKE:
            add(
                f"{column} has boolean values",
                F.count(F.lit(1)) if boolean else F.lit(0).cast("bigint"),
            )
        add(f"{column} has values that are no numbers", broken(value.isNotNull() & number.isNull()))
    for column in schemas.BINARY:
        number = as_number(frame, column)
        add(
            f"{column} is not binary",
            broken(number.isNotNull() & ~F.isnan(number) & ~number.isin(0.0, 1.0)),
        )
    for column in schemas.CONVERSION_COLUMNS:
        value = F.col(column)
        missing = value.isNull()
        if column in NUMERIC:
            missing = missing | F.coalesce(F.isnan(as_number(frame, column)), F.lit(False))
        add(f"{column} has missing values", broken(missing))
    for column in schemas.CATEGORICAL:
        add(f"{column} has blank values", broken(strip(F.col(column)) == ""))
    for column in schemas.COUNT_LIKE:
        number = as_number(frame, column)
        add(f"{column} has values that are not finite", broken(F.abs(number) == float("inf")))
        add(f"{column} has values that are not whole", broken(number % 1 != 0))
    return rules


def conversion_violations(frame: DataFrame) -> DataFrame:
    """All counters of the contract, from one pass."""
    work = require_columns(frame, schemas.CONVERSION_COLUMNS, "conversions")
    return violation_rows(work, _rules(work))


def _typed(frame: DataFrame) -> DataFrame:
    """Trimmed categories and numbers in place; extra columns stay."""
    return frame.withColumns(
        {
            **{c: strip(F.col(c)) for c in schemas.CATEGORICAL},
            **{c: as_number(frame, c) for c in NUMERIC},
        }
    )


def _flags(minimum_age: int, maximum_age: int) -> tuple[Column, Column]:
    return (
        ~F.col("age").between(minimum_age, maximum_age),
        F.col("total_pages_visited") < 1,
    )


def clean_conversions(
    frame: DataFrame,
    *,
    minimum_age: int = schemas.AGE_RANGE[0],
    maximum_age: int = schemas.AGE_RANGE[1],
    keep: tuple[str, ...] = (),
    validate: bool = True,
) -> DataFrame:
    """Rows with a plausible age and at least one page, in canonical columns and types.

    ``keep`` names key columns to carry along; all other extra columns are dropped.
    """
    if validate:
        raise_first(conversion_violations(frame))
    work = require_columns(frame, (*keep, *schemas.CONVERSION_COLUMNS), "conversions")
    bad_age, bad_pages = _flags(minimum_age, maximum_age)
    return (
        _typed(work)
        .where(~(bad_age | bad_pages))
        .select(
            *keep,
            *[F.col(c).cast("int") if c in NUMERIC else F.col(c)
              for c in schemas.CONVERSION_COLUMNS],
        )
    )


def conversion_quality(
    frame: DataFrame,
    *,
    minimum_age: int = schemas.AGE_RANGE[0],
    maximum_age: int = schemas.AGE_RANGE[1],
) -> DataFrame:
    """Six counters: rows in and out, dropped ages and pages, exact duplicates, profiles.

    Rows are first reduced to distinct rows with a count, on the map side as well, so repeated
    rows are not shuffled one by one.
    """
    work = _typed(require_columns(frame, schemas.CONVERSION_COLUMNS, "conversions"))
    bad_age, bad_pages = _flags(minimum_age, maximum_age)
    rows = work.groupBy(*schemas.CONVERSION_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("bigint")

    counts = rows.agg(
        total(F.lit(True)).alias("input_rows"),
        total(~(bad_age | bad_pages)).alias("output_rows"),
        total(bad_age).alias("invalid_age_rows"),
        total(bad_pages).alias("invalid_page_rows"),
        (total(F.lit(True)) - F.count(F.lit(1))).alias("exact_duplicate_rows"),
    )
    profiles = (
        rows.where(~(bad_age | bad_pages)).select(*FEATURES).distinct()
        .agg(F.count(F.lit(1)).alias("unique_feature_profiles"))
    )
    return side_by_side([counts, profiles])


def require_sound_features(features: tuple[str, ...]) -> None:
    """A model needs a non-empty list of distinct, known features."""
    if not features:
        raise ContractError("the model needs at least one feature")
    if len(set(features)) != len(features):
        raise ContractError("the model has duplicate features")
    unknown = sorted(set(features) - set(FEATURES))
    if unknown:
        raise ContractError(f"unknown model features; count={len(unknown)}")
