"""Leakage and parity gates of the point-in-time features, as a one-row report."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.errors import ContractError
from tidemark.operators.combine import side_by_side
from tidemark.operators.events import EventTables
from tidemark.operators.pit import (
    MICROS,
    load_point_in_time_sql,
    pit_audit,
    point_in_time_features,
    sql_features,
)
from tidemark.operators.pit_output import feature_differences

POISON_DELAY_US = 10 * 60 * MICROS
POISON_CATEGORY = "future_poison"


def with_future_poison(tables: EventTables) -> EventTables:
    """One more event per session, ten minutes after its last request."""
    at = (F.max("score_at_us") + POISON_DELAY_US).alias("event_at_us")
    poison = (
        tables.requests.groupBy("session_id")
        .agg(at)
        .select(
            F.concat(F.lit("future_poison_"), F.col("session_id")).alias("event_id"),
            "session_id",
            "event_at_us",
            F.col("event_at_us").alias("available_at_us"),
            F.lit(POISON_CATEGORY).alias("page_category"),
        )
    )
    return EventTables(tables.sessions, tables.requests, tables.events.unionByName(poison))


def only_requests(tables: EventTables, requests: DataFrame) -> EventTables:
    """The tables as a caller with just these requests would have them."""
    ids = requests.select("session_id").distinct()
    return EventTables(
        tables.sessions.join(ids, "session_id", "left_semi"),
        requests,
        tables.events.join(ids, "session_id", "left_semi"),
    )


def first_request(tables: EventTables) -> DataFrame:
    return tables.requests.orderBy("score_id").limit(1)


def _batch(tables: EventTables, features: DataFrame | None) -> DataFrame:
    return point_in_time_features(tables) if features is None else features


def poison_delta(tables: EventTables, *, features: DataFrame | None = None) -> DataFrame:
    """Feature rows that change when future events are added: both counts must be zero.

    Here and below, ``features`` are those of ``tables`` where they have been made already.
    """
    return feature_differences(
        _batch(tables, features), point_in_time_features(with_future_poison(tables))
    )


def single_delta(
    tables: EventTables, requests: DataFrame | None = None, *, features: DataFrame | None = None
) -> DataFrame:
    """Feature rows that differ between the batch and a run over ``requests`` alone.

    By default the first request is taken. Both counts must be zero.
    """
    requests = first_request(tables) if requests is None else requests
    alone = point_in_time_features(only_requests(tables, requests))
    batch = _batch(tables, features).join(
        requests.select("score_id"), "score_id", "left_semi"
    )
    return feature_differences(batch, alone)


def engine_delta(tables: EventTables, *, features: DataFrame | None = None) -> DataFrame:
    """Feature rows that differ between the DataFrame form and the packaged SQL."""
    spark = tables.sessions.sparkSession
    return feature_differences(_batch(tables, features), sql_features(spark, tables))


def rows_per_session(sessions: DataFrame, child: DataFrame) -> DataFrame:
    """Least and most child rows over all sessions, sessions without a child row included."""
    counts = child.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    rows = F.coalesce(F.col("n"), F.lit(0))
    return (
        sessions.select("session_id")
        .join(counts, "session_id", "left")
        .agg(F.min(rows).alias("fewest"), F.max(rows).alias("most"))
    )


def require_uniform(sessions: DataFrame, child: DataFrame, table: str) -> int:
    """The common number of child rows per session; fails when there is none."""
    row = rows_per_session(sessions, child).first()
    if row["fewest"] != row["most"]:
        raise ContractError(f"{table} is not uniform across sessions")
    return row["most"]


def verification_report(tables: EventTables) -> DataFrame:
    """Counters, gates and the query hash in one row; a gate is true when it holds.

    The tables and their features are read by most parts, so they are written once.
    """
    spark = tables.sessions.sparkSession
    tables = EventTables(written(tables.sessions), written(tables.requests), written(tables.events))
    features = written(point_in_time_features(tables))

    def no_difference(delta: DataFrame, name: str) -> DataFrame:
        return delta.select(((F.col("only_left") + F.col("only_right")) == 0).alias(name))

    def per_session(child: DataFrame, name: str) -> DataFrame:
        spread = rows_per_session(tables.sessions, child)
        return spread.select(F.when(F.col("fewest") == F.col("most"), F.col("most")).alias(name))

    counts = pit_audit(tables)
    parts = [
        counts,
        tables.sessions.agg(F.count_distinct("user_id").alias("users")),
        per_session(tables.requests, "score_requests_per_session"),
        per_session(tables.events, "page_events_per_session"),
        no_difference(poison_delta(tables, features=features), "future_poison_invariance"),
        no_difference(single_delta(tables, features=features), "batch_single_request_exact_parity"),
        no_difference(engine_delta(tables, features=features), "spark_sql_exact_parity"),
    ]
    query = load_point_in_time_sql().encode("utf-8")
    return side_by_side(parts).withColumns(
        {
            "exact_score_boundary_excluded": F.col("exact_score_boundary_pairs_excluded") > 0,
            "exact_availability_boundary_included":
                F.col("exact_availability_boundary_pairs_included") > 0,
            "future_events_excluded": F.col("future_event_score_pairs_excluded") > 0,
            "late_events_excluded": F.col("late_event_score_pairs_excluded") > 0,
            "one_row_per_score_request": F.col("output_rows") == F.col("score_request_rows"),
            "event_time_rule": F.lit("event_at < score_at"),
            "availability_rule": F.lit("available_at <= score_at"),
            "analysis_unit": F.lit("one row per score_id"),
            "query_sha256": F.lit(hashlib.sha256(query).hexdigest()),
            "spark_sql_timezone": F.lit(spark.conf.get("spark.sql.session.timeZone")),
        }
    )
