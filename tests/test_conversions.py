from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.errors import ContractError
from tidemark.operators.conversion import clean_conversions, conversion_quality
from tidemark.operators.metrics import descriptive_rates
from tidemark.operators.planning import plan_enrollment
from tidemark.operators.scoring import guarded_features, prepare_features
from tidemark.schemas import features_of

SCHEMA = (
    "country string, age int, new_user int, source string, total_pages_visited int, converted int"
)


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("US", 25, 1, "Ads", 3, 0), (" UK ", 111, 0, "Seo", 8, 1), ("US", 36, 0, "Ads", 12, 1)],
        SCHEMA,
    )


def test_rows_are_dropped_and_counted(table):
    assert clean_conversions(table).count() == 2
    assert conversion_quality(table).first().asDict() == {
        "input_rows": 3, "output_rows": 2, "invalid_age_rows": 1, "invalid_page_rows": 0,
        "exact_duplicate_rows": 0, "unique_feature_profiles": 2,
    }


def test_duplicates_are_extra_rows_and_text_is_trimmed(table):
    doubled = table.unionAll(table.withColumn("country", F.concat(F.lit("\t"), "country")))
    assert conversion_quality(doubled).first()["exact_duplicate_rows"] == 3
    assert {r["country"] for r in clean_conversions(doubled, maximum_age=120).collect()} == {
        "US", "UK"
    }


def test_extra_columns_and_any_order(table):
    odd = table.select(F.lit(1).alias("extra"), *reversed(table.columns))
    assert rows(clean_conversions(odd)) == rows(clean_conversions(table))


@pytest.mark.parametrize("column, value, message", [
    ("converted", "2", "converted is not binary; count=3"),
    ("age", "true", "age has boolean values"),
    ("age", "'old'", "age has values that are no numbers"),
    ("age", "30.5D", "age has values that are not whole"),
    ("age", "double('inf')", "age has values that are not finite"),
    ("total_pages_visited", "double('nan')", "total_pages_visited has missing values"),
    ("country", "' \u3000'", "country has blank values"),
    ("source", "cast(null as string)", "source has missing values"),
])
def test_faults_raise_with_counts_only(table, column, value, message):
    with pytest.raises(ContractError) as error:
        clean_conversions(table.withColumn(column, F.expr(value)))
    assert message in str(error.value) and "old" not in str(error.value).split(";")[1]


def test_boolean_binary_fields_are_accepted(table):
    flags = table.withColumn("new_user", F.col("new_user") == 1)
    assert rows(clean_conversions(flags)) == rows(clean_conversions(table))


def test_missing_and_repeated_columns(table):
    with pytest.raises(ContractError, match="missing columns"):
        clean_conversions(table.drop("age"))
    with pytest.raises(ContractError, match="duplicate column names; count=2"):
        clean_conversions(table.select("*", F.lit(1).alias("age")))


def test_scoring_request_keeps_nulls_and_new_levels(spark):
    request = spark.createDataFrame(
        [(None, 30, "Atlantis", None, 1, "x"), (" ", 31, "US", 4, 0, "y")],
        "source string, age int, country string, total_pages_visited int, new_user int, note string",
    )
    got = prepare_features(request, "in_session")
    assert got.columns == list(features_of("in_session"))
    assert [tuple(r) for r in got.collect()] == [
        ("Atlantis", 30.0, 1.0, None, None), ("US", 31.0, 0.0, None, 4.0)
    ]


BAD_REQUESTS = [
    ("age", "'x'", "no numbers"), ("age", "12", "out of range"),
    ("age", "30.5D", "not whole"), ("age", "double('inf')", "not finite"),
    ("age", "true", "boolean"), ("new_user", "3", "not binary"),
    ("total_pages_visited", "0", "not positive"),
]


@pytest.mark.parametrize("column, value, message", BAD_REQUESTS)
def test_bad_scoring_values(table, column, value, message):
    bad = table.where("age < 100").withColumn(column, F.expr(value))
    with pytest.raises(ContractError, match=message):
        prepare_features(bad, "in_session")
    with pytest.raises(Exception, match=message):
        guarded_features(bad, features_of("in_session"), []).collect()


def test_unknown_scenario():
    with pytest.raises(ContractError, match="acquisition and in_session"):
        features_of("later")


def test_descriptive_bands_are_closed_on_the_right(spark):
    ages = spark.createDataFrame(
        [("US", a, 0, "Ads", 1, a % 2) for a in (13, 20, 21, 60, 61, 100)], SCHEMA
    )
    got = descriptive_rates(ages).where("panel = 'age_band'").select("level", "rows")
    assert rows(got) == [("(12, 20]", 2), ("(20, 30]", 1), ("(50, 60]", 1), ("(60, 100]", 2)]


def test_enrollment(spark):
    units = spark.range(10_000).selectExpr(
        "id as unit", "if(id < 323, 1, 0) as outcome", "'a' as segment"
    )
    # Repeated rows of a unit do not count twice.
    plan = plan_enrollment(
        units.unionAll(units), ["segment"], unit="unit", outcome="outcome", relative_lift=0.1
    ).first()
    assert (plan["units_per_arm"], plan["total_units"]) == (51_893, 103_786)
    none = plan_enrollment(
        units.withColumn("outcome", F.lit(0)), ["segment"], unit="unit", outcome="outcome",
        relative_lift=0.1,
    ).first()
    assert none["units_per_arm"] is None and none["reason"] == "no_conversions"
    for bad in ({"alpha": 0.0}, {"power": 1.0}, {"attrition": 1.0}, {"relative_lift": 0.0}):
        with pytest.raises(ContractError):
            plan_enrollment(units, ["segment"], unit="unit", outcome="outcome",
                            **{"relative_lift": 0.1, **bad})
