from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.pit_output import (
    canonical_features,
    feature_differences,
    feature_violations,
    require_same_features,
)
from tidemark.schemas import FEATURE_COLUMNS

SCHEMA = (
    "score_id string, session_id string, user_id string, score_at_us long, country string,"
    " age long, new_user long, source string, seconds_since_session_start long,"
    " pages_observed_at_score_time long, unique_page_categories_observed long,"
    " feature_max_event_at_us long, seconds_since_last_page_view long"
)
VALID = dict(zip(FEATURE_COLUMNS, (
    "r1", "s1", "u1", 5_000_000, "US", 35, 1, "Ads", 5, 2, 2, 3_750_000, 1
)))
PAGES, CATEGORIES = "pages_observed_at_score_time", "unique_page_categories_observed"
SEEN, RECENCY = "feature_max_event_at_us", "seconds_since_last_page_view"
ELAPSED = "seconds_since_session_start"


def frame(spark, **changes):
    row = {**VALID, **changes}
    return spark.createDataFrame([tuple(row[c] for c in FEATURE_COLUMNS)], SCHEMA)


@pytest.mark.parametrize("changes", [
    {"age": 12}, {"age": 101}, {"new_user": -1}, {"new_user": 2}, {ELAPSED: -1}, {PAGES: -1},
    {CATEGORIES: -1}, {CATEGORIES: 3}, {PAGES: 0}, {PAGES: 0, CATEGORIES: 0},
    {PAGES: 0, CATEGORIES: 0, SEEN: None}, {CATEGORIES: 0}, {SEEN: None}, {RECENCY: None},
    {RECENCY: -1}, {RECENCY: 0}, {RECENCY: 2}, {RECENCY: 6},
    {ELAPSED: 0}, {SEEN: 5_000_000, RECENCY: 0}, {SEEN: 5_000_001, RECENCY: -1},
    {"country": " "}, {"score_id": None}, {"age": None}, {"score_at_us": None},
])
def test_bad_rows_are_rejected(spark, changes):
    with pytest.raises(ContractError, match="count=1"):
        canonical_features(frame(spark, **changes))


@pytest.mark.parametrize("changes", [
    {}, {"age": 13}, {"age": 100}, {"new_user": 0},
    {PAGES: 0, CATEGORIES: 0, SEEN: None, RECENCY: None},
    {"score_at_us": 900, ELAPSED: 0, SEEN: 100, RECENCY: 0},
    {"score_at_us": -1_000_000, SEEN: -2_500_001, RECENCY: 1},
    {"score_at_us": 9 * 10**18, SEEN: -9 * 10**18, RECENCY: 18 * 10**12, ELAPSED: 18 * 10**12},
])
def test_good_rows_are_kept(spark, changes):
    got = canonical_features(frame(spark, **changes)).first().asDict()
    assert got == {**VALID, **changes}


def test_engine_doubles_become_longs(spark):
    rows = frame(spark, **{PAGES: 0, CATEGORIES: 0, SEEN: None, RECENCY: None}).withColumns(
        {SEEN: F.lit(float("nan")), RECENCY: F.lit(float("nan"))}
    )
    got = canonical_features(rows.select(*reversed(FEATURE_COLUMNS)))
    assert got.columns == list(FEATURE_COLUMNS)
    assert got.first()[SEEN] is None and dict(got.dtypes)[RECENCY] == "bigint"
    for bad in (float("inf"), 1.5):
        with pytest.raises(ContractError, match="finite integer"):
            canonical_features(frame(spark).withColumn(SEEN, F.lit(bad)))


def test_types_schema_and_keys(spark):
    with pytest.raises(ContractError, match="not an integer"):
        canonical_features(frame(spark).withColumn("age", F.lit(35.0)))
    with pytest.raises(ContractError, match="not an integer"):
        canonical_features(frame(spark).withColumn("new_user", F.lit(True)))
    with pytest.raises(ContractError, match="unexpected"):
        canonical_features(frame(spark).withColumn("converted", F.lit(1)))
    with pytest.raises(ContractError, match="not unique; count=2"):
        canonical_features(frame(spark).unionAll(frame(spark)))
    assert canonical_features(frame(spark).limit(0)).count() == 0
    assert feature_violations(frame(spark)).where("violations > 0").count() == 0


def test_comparison_counts_rows_of_either_side(spark):
    left = frame(spark).unionAll(frame(spark, score_id="r2"))
    right = frame(spark).unionAll(frame(spark, score_id="r3", age=36))
    assert tuple(feature_differences(left, right).first()) == (1, 1)
    with pytest.raises(ContractError, match="differ; count=2"):
        require_same_features(left, right)
    require_same_features(left, left.select(*reversed(left.columns)))
