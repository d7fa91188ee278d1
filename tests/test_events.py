from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import pattern_frames, rows
from tidemark.errors import ContractError, EventContractError
from tidemark.operators.events import event_report, event_tables, event_violations
from tidemark.operators.pit import (
    in_score_order,
    load_point_in_time_sql,
    model_features,
    pit_audit,
    point_in_time_features,
    require_grain,
    sql_features,
)
from tidemark.operators.pit_output import feature_differences, require_same_features
from tidemark.plans.verification import (
    only_requests,
    poison_delta,
    require_uniform,
    single_delta,
    verification_report,
)


def test_valid_tables_pass(event_frames):
    report = event_report(event_tables(*event_frames)).first()
    assert tuple(report) == (1, 1, 1, 1)


def minutes(n):
    return F.make_dt_interval(mins=F.lit(n))


SESSION, REQUEST, EVENT = 0, 1, 2
BROKEN = [
    (SESSION, lambda f: f.unionAll(f), "session_id has rows in duplicate keys; count=2"),
    (REQUEST, lambda f: f.unionAll(f), "score_id has rows in duplicate keys; count=2"),
    (EVENT, lambda f: f.unionAll(f), "event_id has rows in duplicate keys; count=2"),
    (SESSION, lambda f: f.withColumn("user_id", F.lit(" \t")), "user_id has missing or empty"),
    (SESSION, lambda f: f.withColumn("session_id", F.lit("\x1f ")), "session_id has missing"),
    (REQUEST, lambda f: f.withColumn("score_id", F.lit(None).cast("string")), "score_id has miss"),
    (EVENT, lambda f: f.withColumn("page_category", F.lit("")), "page_category has missing"),
    (SESSION, lambda f: f.withColumn("age", F.lit(30.5)), "age has invalid values"),
    (SESSION, lambda f: f.withColumn("age", F.lit(True)), "age has invalid values"),
    (SESSION, lambda f: f.withColumn("age", F.lit(101)), "age has invalid values"),
    (SESSION, lambda f: f.withColumn("new_user", F.lit(2)), "new_user has non-binary"),
    (REQUEST, lambda f: f.withColumn("session_id", F.lit("zz")), "unknown foreign keys"),
    (EVENT, lambda f: f.withColumn("session_id", F.lit("zz")), "unknown foreign keys"),
    (REQUEST, lambda f: f.withColumn("score_at", F.col("score_at") - minutes(60)),
     "score_at is before sessions.session_start_at; count=1"),
    (EVENT, lambda f: f.withColumn("event_at", F.col("event_at") - minutes(60)),
     "event_at is before sessions.session_start_at; count=1"),
    (EVENT, lambda f: f.withColumn("available_at", F.col("event_at") - minutes(1)),
     "available_at is before event_at"),
    (EVENT, lambda f: f.withColumn("event_at", F.lit(None).cast("timestamp")), "missing timest"),
    (EVENT, lambda f: f.withColumn("event_at", F.col("event_at").cast("timestamp_ntz")),
     "without a UTC offset; count=1"),
    (REQUEST, lambda f: f.withColumn("score_at", F.lit("2026-01-01T12:05:00")),
     "without a UTC offset"),
    (REQUEST, lambda f: f.withColumn("score_at", F.lit("soon")), "invalid timestamps"),
    (REQUEST, lambda f: f.withColumn("score_at", F.lit("2026-01-01T12:05:00.0000001Z")),
     "finer than microseconds"),
    (SESSION, lambda f: f.withColumn("converted", F.lit(1)), "unexpected columns"),
    (SESSION, lambda f: f.drop("country"), "missing columns"),
    (SESSION, lambda f: f.select("*", F.lit("x").alias("AGE")), "duplicate column names; count=2"),
]


@pytest.mark.parametrize("table, change, message", BROKEN)
def test_broken_tables_are_rejected(event_frames, table, change, message):
    frames = list(event_frames)
    frames[table] = change(frames[table])
    with pytest.raises(EventContractError) as error:
        event_tables(*frames)
    text = str(error.value)
    assert message in text and "count=" in text
    # Keys and values never show up in a message.
    assert not any(value in text for value in ("s1", "r1", "e1", "u1", "zz", "soon"))


def test_text_times_with_offset_are_accepted(event_frames):
    sessions, requests, events = event_frames
    text = requests.withColumn("score_at", F.lit(" 2026-01-01T14:05:00.250000+02:00"))
    tables = event_tables(sessions, text, events)
    at = tables.requests.first()["score_at_us"]
    assert at == 1_767_269_100_250_000


def test_pattern_counts_match_the_published_ones(spark):
    tables = event_tables(*pattern_frames(spark, 500))
    audit = pit_audit(tables)
    require_grain(audit)
    assert audit.first().asDict() == {
        "session_rows": 500,
        "score_request_rows": 1500,
        "page_event_rows": 3000,
        "candidate_event_score_pairs": 9000,
        "eligible_event_score_pairs": 3000,
        "exact_score_boundary_pairs_excluded": 500,
        "exact_availability_boundary_pairs_included": 500,
        "future_event_score_pairs_excluded": 5000,
        "late_event_score_pairs_excluded": 500,
        "zero_history_score_requests": 500,
        "output_rows": 1500,
    }


@pytest.fixture(scope="module")
def small(spark):
    return event_tables(*pattern_frames(spark, 6))


def test_pattern_features(small):
    got = in_score_order(point_in_time_features(small)).limit(3).select(
        "pages_observed_at_score_time", "unique_page_categories_observed",
        "seconds_since_last_page_view", "seconds_since_session_start",
    )
    assert [tuple(r) for r in got.collect()] == [
        (0, 0, None, 0), (2, 2, 30, 120), (4, 4, 60, 300)
    ]
    assert "score_id" not in model_features(got.sparkSession.createDataFrame(
        [], point_in_time_features(small).schema)).columns


@pytest.mark.parametrize("rows_per_slice", [2, 5, 10**6])
def test_both_forms_and_all_slicings_agree(spark, small, rows_per_slice):
    whole = point_in_time_features(small)
    cut = point_in_time_features(small, rows_per_slice=rows_per_slice)
    text = sql_features(spark, small, rows_per_slice=rows_per_slice)
    for other in (cut, text):
        assert tuple(feature_differences(whole, other).first()) == (0, 0)
    assert rows(pit_audit(small)) == rows(pit_audit(small, rows_per_slice=rows_per_slice))


def test_one_session_with_most_rows_against_brute_force(spark):
    """A hot session with many equal times, cut into slices, against the pair definition."""
    sessions = spark.sql(
        "select concat('s', id) as session_id, 'u' as user_id,"
        " timestamp_micros(0L) as session_start_at, 'US' as country, 20L as age,"
        " 0L as new_user, 'Ads' as source from range(4)"
    )
    events = spark.sql(
        "select concat('e', id) as event_id, if(id % 3 < 2, 's0', concat('s', id % 4)) as"
        " session_id, timestamp_micros(pmod(id * 7919, 40L)) as event_at,"
        " timestamp_micros(pmod(id * 7919, 40L) + id % 5) as available_at,"
        " concat('c', id % 6) as page_category from range(900)"
    )
    requests = spark.sql(
        "select concat('r', id) as score_id, if(id % 2 = 0, 's0', concat('s', id % 4)) as"
        " session_id, timestamp_micros(id % 50) as score_at from range(200)"
    )
    tables = event_tables(sessions, requests, events)
    pairs = (
        tables.requests.join(tables.events, "session_id")
        .where("event_at_us < score_at_us and available_at_us <= score_at_us")
        .groupBy("score_id")
        .agg(
            F.count(F.lit(1)).alias("p"), F.count_distinct("page_category").alias("c"),
            F.max("event_at_us").alias("m"),
        )
    )
    wanted = tables.requests.join(pairs, "score_id", "left").selectExpr(
        "score_id", "coalesce(p, 0)", "coalesce(c, 0)", "m"
    )
    for slices in (15, 60, 10**6):
        got = point_in_time_features(tables, rows_per_slice=slices).select(
            "score_id", "pages_observed_at_score_time", "unique_page_categories_observed",
            "feature_max_event_at_us",
        )
        assert rows(got) == rows(wanted)


def test_future_events_and_single_requests_change_nothing(spark, small):
    assert tuple(poison_delta(small).first()) == (0, 0)
    assert tuple(single_delta(small).first()) == (0, 0)
    some = small.requests.where(F.col("score_id").endswith("#120"))
    assert tuple(single_delta(small, some).first()) == (0, 0)
    assert only_requests(small, some).events.count() == small.events.count()


def test_verification_report(small):
    report = verification_report(small).first().asDict()
    gates = [name for name, value in report.items() if isinstance(value, bool)]
    assert len(gates) == 8 and all(report[g] for g in gates)
    assert report["score_requests_per_session"] == 3 and report["page_events_per_session"] == 6
    assert require_uniform(small.sessions, small.events, "page event") == 6
    with pytest.raises(ContractError):
        require_uniform(small.sessions, small.events.limit(7), "page event")


def test_empty_tables(spark, small):
    none = event_tables(*[f.limit(0) for f in pattern_frames(spark, 1)])
    assert point_in_time_features(none).count() == 0
    assert sql_features(spark, none).count() == 0
    assert pit_audit(none).first()["candidate_event_score_pairs"] == 0
    without = type(small)(small.sessions, small.requests, small.events.limit(0))
    got = point_in_time_features(without)
    assert got.where("pages_observed_at_score_time = 0").count() == small.requests.count()


def test_repartitioning_changes_nothing(small):
    spread = type(small)(*[
        f.repartition(n) for f, n in zip((small.sessions, small.requests, small.events), (1, 7, 13))
    ])
    require_same_features(point_in_time_features(small), point_in_time_features(spread))


def test_packaged_sql_has_both_cutoffs_and_no_outcome():
    text = load_point_in_time_sql()
    assert "greatest(event_at_us + 1, available_at_us)" in text
    assert "converted" not in text and "outcome" not in text


def test_violation_table_lists_every_rule(event_frames):
    got = event_violations(*event_frames)
    assert got.count() == got.select("position").distinct().count() == 35
    assert got.agg(F.sum("violations")).first()[0] == 0
