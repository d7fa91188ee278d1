"""Contract of the point-in-time feature table, and exact comparison of two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.errors import ContractError
from tidemark.functions.text import blank
from tidemark.operators.checks import (
    Rule,
    broken,
    broken_unless,
    duplicate_key_rows,
    raise_first,
    require_exact_columns,
    violation_rows,
)
from tidemark.operators.combine import multiset_delta

TABLE = "features"
INTEGERS = tuple(
    c for c in schemas.FEATURE_COLUMNS
    if c not in schemas.TEXT_FEATURES and c not in schemas.NULLABLE_FEATURES
)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_long(frame: DataFrame, column: str) -> Column:
    """The column as a long; engine doubles with NaN for null are accepted where null is."""
    kind, value = frame.schema[column].dataType, F.col(column)
    if isinstance(kind, _WHOLE):
        return value.cast("bigint")
    if isinstance(kind, T.NumericType) and column in schemas.NULLABLE_FEATURES:
        return F.when(~F.isnan(value.cast("double")), value).try_cast("bigint")
    return F.lit(None).cast("bigint")


def _typed(frame: DataFrame) -> DataFrame:
    return frame.select(
        *[
            F.col(c) if c in schemas.TEXT_FEATURES else _as_long(frame, c).alias(c)
            for c in schemas.FEATURE_COLUMNS
        ]
    )


def _type_rules(frame: DataFrame) -> list[Rule]:
    rules: list[Rule] = []

    def add(name: str, count: Column) -> None:
        rules.append(Rule(len(rules), TABLE, name, count))

    for column in schemas.TEXT_FEATURES:
        text = isinstance(frame.schema[column].dataType, T.StringType)
        add(
            f"{column} is not non-empty text",
            broken(blank(F.col(column))) if text else F.count(F.lit(1)),
        )
    for column in INTEGERS:
        whole = isinstance(frame.schema[column].dataType, _WHOLE)
        add(
            f"{column} is not an integer",
            broken_unless(F.col(column).isNotNull()) if whole else F.count(F.lit(1)),
        )
    for column in schemas.NULLABLE_FEATURES:
        kind, value = frame.schema[column].dataType, F.col(column)
        if isinstance(kind, _WHOLE):
            count = F.lit(0).cast("bigint")
        elif isinstance(kind, T.NumericType):
            number = value.cast("double")
            count = broken(
                ~F.isnan(number) & ((F.abs(number) == float("inf")) | (number % 1 != 0))
            )
        elif isinstance(kind, T.NullType):
            count = F.lit(0).cast("bigint")
        else:
            count = F.count(value)
        add(f"{column} is not a finite integer", count)
    return rules


def _meaning_rules() -> list[Rule]:
    pages = F.col("pages_observed_at_score_time")
    categories = F.col("unique_page_categories_observed")
    elapsed = F.col("seconds_since_session_start")
    seen, recency = F.col("feature_max_event_at_us"), F.col("seconds_since_last_page_view")
    low, high = schemas.AGE_RANGE
    # Differences of far-apart times do not fit a long; floored, since times may be negative.
    gap = F.col("score_at_us").cast("decimal(38,0)") - seen.cast("decimal(38,0)")
    floored = F.floor(gap / F.lit(1_000_000).cast("decimal(38,0)"))
    cases = [
        ("event is at or after the score time", seen >= F.col("score_at_us")),
        ("age is out of range", ~F.col("age").between(low, high)),
        ("new_user is not binary", ~F.col("new_user").isin(0, 1)),
        ("seconds_since_session_start is negative", elapsed < 0),
        ("pages_observed_at_score_time is negative", pages < 0),
        ("unique_page_categories_observed is negative", categories < 0),
        ("more categories than pages", categories > pages),
        ("pages without categories", (pages > 0) & (categories == 0)),
        (
            "page history and nullable fields disagree",
            ((pages == 0) != seen.isNull()) | ((pages == 0) != recency.isNull()),
        ),
        ("seconds_since_last_page_view is negative", recency < 0),
        ("page recency exceeds elapsed time", recency > elapsed),
        ("page recency is not the floored time difference", recency != floored),
    ]
    return [Rule(21 + i, TABLE, name, broken(bad)) for i, (name, bad) in enumerate(cases)]


def feature_violations(frame: DataFrame) -> DataFrame:
    """All counters of the feature-table contract: two passes over the table."""
    work = require_exact_columns(frame, schemas.FEATURE_COLUMNS, TABLE)
    repeated = duplicate_key_rows(work, F.col("score_id").cast("string"))
    return (
        violation_rows(work, _type_rules(work))
        .unionAll(
            violation_rows(repeated, [Rule(20, TABLE, "score_id is not unique", F.sum("rows"))])
        )
        .unionAll(violation_rows(_typed(work), _meaning_rules()))
    )


def canonical_features(frame: DataFrame, *, validate: bool = True) -> DataFrame:
    """The thirteen columns in order, with longs and with null for NaN.

    Rows keep no order; ask for one with ``in_score_order``.
    """
    work = require_exact_columns(frame, schemas.FEATURE_COLUMNS, TABLE)
    if validate:
        raise_first(feature_violations(work))
    return _typed(work)


def feature_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many feature rows only one of the two tables has."""
    tables = [canonical_features(t, validate=False) for t in (left, right)]
    return multiset_delta(*tables, schemas.FEATURE_COLUMNS)


def require_same_features(left: DataFrame, right: DataFrame) -> None:
    """Fail unless both tables keep the contract and hold the same rows."""
    for table in (left, right):
        raise_first(feature_violations(table))
    row = feature_differences(left, right).first()
    if row["only_left"] or row["only_right"]:
        raise ContractError(
            f"feature tables differ; count={row['only_left'] + row['only_right']}"
        )
