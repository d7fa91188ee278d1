from __future__ import annotations

import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

START = datetime(2026, 1, 1, 12, 0, tzinfo=timezone.utc)
# Fixed values: (occurred, available, category) in seconds after the session start.
PATTERN = (
    (30, 31, "landing"),
    (90, 120, "product"),
    (120, 120, "comparison"),
    (180, 360, "pricing"),
    (240, 240, "checkout"),
    (360, 360, "help"),
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def event_frames(spark):
    """One session with one request and one event, as (sessions, requests, events)."""
    at = lambda minutes: START + timedelta(minutes=minutes)
    return (
        spark.createDataFrame(
            [("s1", "u1", START, "US", 31, 1, "Ads")],
            "session_id string, user_id string, session_start_at timestamp, country string,"
            " age long, new_user long, source string",
        ),
        spark.createDataFrame(
            [("r1", "s1", at(5))], "score_id string, session_id string, score_at timestamp"
        ),
        spark.createDataFrame(
            [("e1", "s1", at(1), at(2), "product")],
            "event_id string, session_id string, event_at timestamp, available_at timestamp,"
            " page_category string",
        ),
    )


def pattern_frames(spark, count: int):
    """``count`` sessions with the fixed timing pattern, as (sessions, requests, events)."""
    base = START.timestamp()
    starts = spark.range(count).selectExpr(
        "concat('s', lpad(id, 4, '0')) as session_id",
        f"concat('u', id % {max(1, count // 2)}) as user_id",
        f"timestamp_micros(cast(({base} + id * 600) * 1000000 as bigint)) as session_start_at",
    )
    sessions = starts.selectExpr(
        "*", "'US' as country", "30L as age", "1L as new_user", "'Ads' as source"
    )
    requests = starts.selectExpr(
        "session_id", "session_start_at", "explode(array(0, 120, 300)) as gap"
    ).selectExpr(
        "concat(session_id, '#', lpad(gap, 3, '0')) as score_id", "session_id",
        "session_start_at + make_dt_interval(0, 0, 0, gap) as score_at",
    )
    lines = ", ".join(f"struct({o} as o, {a} as a, '{c}' as c)" for o, a, c in PATTERN)
    events = starts.selectExpr(
        "session_id", "session_start_at", f"inline(array({lines}))"
    ).selectExpr(
        "concat(session_id, '-', o, '-', c) as event_id", "session_id",
        "session_start_at + make_dt_interval(0, 0, 0, o) as event_at",
        "session_start_at + make_dt_interval(0, 0, 0, a) as available_at",
        "c as page_category",
    )
    return sessions, requests, events


def rows(frame, *order):
    """Collected rows as tuples, sorted."""
    return sorted((tuple(r) for r in frame.collect()), key=lambda t: tuple(str(x) for x in t))
