"""Contract of the session, request and page-event tables.

The checks are counters over whole tables. Child tables are reduced to one row per session before
they meet the sessions, so a session that holds a third of all events is no hot join key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.errors import EventContractError
from tidemark.functions.text import blank, strip
from tidemark.operators.checks import (
    Rule,
    broken,
    broken_unless,
    duplicate_key_rows,
    raise_first,
    raise_violation,
    require_exact_columns,
    violation_rows,
)
from tidemark.operators.combine import side_by_side

# Text instants: date, time to the minute at least, optional fraction, optional offset.
_INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"
# Positions of the rules on times before the session start.
ORDER_RULES = (42, 43)
_SUB_MICRO = r"\.\d{6}\d*[1-9]\d*"


@dataclass(frozen=True)
class EventTables:
    """The three tables with trimmed keys and times as epoch microseconds."""

    sessions: DataFrame
    requests: DataFrame
    events: DataFrame


def _instant_rules(frame: DataFrame, start: int, table: str, column: str) -> list[Rule]:
    value, kind = F.col(column), frame.schema[column].dataType
    rows = F.count(value).cast("bigint")
    none = F.lit(0).cast("bigint")
    if isinstance(kind, T.TimestampType):
        invalid, naive, fine = none, none, none
    elif isinstance(kind, T.TimestampNTZType):
        invalid, naive, fine = none, rows, none
    elif isinstance(kind, T.StringType):
        text = strip(value)
        parsed = text.rlike(_INSTANT) & text.try_cast("timestamp").isNotNull()
        invalid = broken_unless(value.isNull() | parsed)
        naive = broken_unless(value.isNull() | ~parsed | text.rlike(_OFFSET))
        fine = broken_unless(value.isNull() | ~parsed | ~text.rlike(_SUB_MICRO))
    else:
        invalid, naive, fine = rows, none, none
    what = [
        ("missing timestamps", broken_unless(value.isNotNull())),
        ("invalid timestamps", invalid),
        ("timestamps without a UTC offset", naive),
        ("timestamps finer than microseconds", fine),
    ]
    return [
        Rule(start + i, table, f"{column} has {text}", count)
        for i, (text, count) in enumerate(what)
    ]


def _micros(frame: DataFrame, column: str) -> Column:
    value, kind = F.col(column), frame.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.unix_micros(strip(value).try_cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    # Any other type is already counted as broken; keep the plan valid for the counters.
    return F.lit(None).cast("bigint")


def _number(frame: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(frame.schema[column].dataType, T.BooleanType):
        value = value.cast("int")
    return value.try_cast("double")


def _present(position: int, table: str, column: str, what: str = "identifiers") -> Rule:
    return Rule(
        position, table, f"{column} has missing or empty {what}",
        broken_unless(~blank(F.col(column))),
    )


def _row_counter(rows: DataFrame, position: int, table: str, rule: str) -> DataFrame:
    """The sum of column ``rows`` as a counter line."""
    return violation_rows(rows, [Rule(position, table, rule, F.sum("rows"))])


def _duplicates(frame: DataFrame, position: int, table: str, key: str) -> DataFrame:
    rows = duplicate_key_rows(frame, strip(F.col(key)))
    return _row_counter(rows, position, table, f"{key} has rows in duplicate keys")


def event_violations(
    sessions: DataFrame, requests: DataFrame, events: DataFrame, *, exact_order: bool = True
) -> DataFrame:
    """All counters of the three-table contract; ``position`` is the order of raising.

    Columns: position, table, rule, violations. Every row is looked at. The two rules on times
    before the session start count rows; with ``exact_order=False`` they count the sessions that
    have such rows, which saves a second reading of the child tables.
    """
    sessions, requests, events = _exact(sessions, requests, events)
    tables = EventTables(*_minimal(sessions, requests, events))
    age, new_user = _number(sessions, "age"), _number(sessions, "new_user")
    low, high = schemas.AGE_RANGE
    session_rules = [
        _present(0, "sessions", "session_id"),
        _present(2, "sessions", "user_id"),
        _present(10, "sessions", "country", "values"),
        _present(11, "sessions", "source", "values"),
        Rule(
            12, "sessions", "age has invalid values",
            broken_unless(age.between(low, high) & (age % 1 == 0)),
        ),
        Rule(
            13, "sessions", "new_user has non-binary values",
            broken_unless(new_user.isin(0.0, 1.0)),
        ),
        *_instant_rules(sessions, 14, "sessions", "session_start_at"),
    ]
    request_rules = [
        _present(3, "score_requests", "score_id"),
        _present(5, "score_requests", "session_id"),
        *_instant_rules(requests, 20, "score_requests", "score_at"),
    ]
    event_rules = [
        _present(6, "page_events", "event_id"),
        _present(8, "page_events", "session_id"),
        _present(9, "page_events", "page_category", "values"),
        *_instant_rules(events, 30, "page_events", "event_at"),
        *_instant_rules(events, 34, "page_events", "available_at"),
        Rule(
            44, "page_events", "available_at is before event_at",
            broken(_micros(events, "available_at") < _micros(events, "event_at")),
        ),
    ]
    parts = [
        violation_rows(sessions, session_rules),
        _duplicates(sessions, 1, "sessions", "session_id"),
        violation_rows(requests, request_rules),
        _duplicates(requests, 4, "score_requests", "score_id"),
        violation_rows(events, event_rules),
        _duplicates(events, 7, "page_events", "event_id"),
        _child_checks(
            tables.requests, tables.sessions, "score_at_us", "score_requests", 40, 42, exact_order
        ),
        _child_checks(
            tables.events, tables.sessions, "event_at_us", "page_events", 41, 43, exact_order
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _child_checks(
    child: DataFrame, sessions: DataFrame, at: str, table: str, known: int, order: int, exact: bool
) -> DataFrame:
    """Unknown sessions and times before the session start.

    The child is first reduced to (rows, earliest time) per session; for the exact count only the
    sessions whose earliest time is too early are read row by row.
    """
    starts = sessions.groupBy("session_id").agg(F.min("session_start_at_us").alias("start"))
    reduced = (
        child.groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(at).alias("first"))
        .join(starts, "session_id", "left")
    )
    unknown = Rule(
        known, table, "session_id has unknown foreign keys",
        F.sum(F.when(F.col("start").isNull(), F.col("rows"))),
    )
    late_rule = f"{at.removesuffix('_us')} is before sessions.session_start_at"
    if not exact:
        early = Rule(order, table, late_rule, broken(F.col("first") < F.col("start")))
        return violation_rows(reduced, [unknown, early])
    early_sessions = reduced.where("first < start").select("session_id", "start")
    early = (
        child.join(early_sessions, "session_id")
        .where(F.col(at) < F.col("start"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return violation_rows(reduced, [unknown]).unionAll(
        _row_counter(early, order, table, late_rule)
    )


def _exact(sessions, requests, events):
    pick = require_exact_columns
    return (
        pick(sessions, schemas.SESSION_COLUMNS, "sessions", EventContractError),
        pick(requests, schemas.REQUEST_COLUMNS, "score_requests", EventContractError),
        pick(events, schemas.EVENT_COLUMNS, "page_events", EventContractError),
    )


def _minimal(sessions, requests, events):
    """Trimmed, typed projections; no check is made here."""
    text = {name: strip(F.col(name)).alias(name) for name in (
        "session_id", "user_id", "country", "source", "score_id", "event_id", "page_category"
    )}
    return (
        sessions.select(
            text["session_id"],
            text["user_id"],
            _micros(sessions, "session_start_at").alias("session_start_at_us"),
            text["country"],
            _number(sessions, "age").try_cast("bigint").alias("age"),
            _number(sessions, "new_user").try_cast("bigint").alias("new_user"),
            text["source"],
        ),
        requests.select(
            text["score_id"], text["session_id"], _micros(requests, "score_at").alias("score_at_us")
        ),
        events.select(
            text["event_id"],
            text["session_id"],
            _micros(events, "event_at").alias("event_at_us"),
            _micros(events, "available_at").alias("available_at_us"),
            text["page_category"],
        ),
    )


def event_tables(
    sessions: DataFrame, requests: DataFrame, events: DataFrame, *, validate: bool = True
) -> EventTables:
    """The three tables ready for the feature query, after the contract has been checked.

    ``validate=False`` is for tables that have passed before; the projections are the same.
    """
    sessions, requests, events = _exact(sessions, requests, events)
    if validate:
        quick = event_violations(sessions, requests, events, exact_order=False)
        found = quick.where("violations > 0").orderBy("position").limit(1)
        if (worst := found.first()) is not None:
            counted = worst["position"] not in ORDER_RULES
            if counted:
                raise_violation(worst, EventContractError)
            raise_first(event_violations(sessions, requests, events), EventContractError)
    return EventTables(*_minimal(sessions, requests, events))


def event_report(tables: EventTables) -> DataFrame:
    """Row counts of the three tables and the number of users."""
    sizes = [
        tables.sessions.agg(
            F.count(F.lit(1)).alias("session_rows"),
            F.count_distinct("user_id").alias("unique_users"),
        ),
        tables.requests.agg(F.count(F.lit(1)).alias("score_request_rows")),
        tables.events.agg(F.count(F.lit(1)).alias("page_event_rows")),
    ]
    return side_by_side(sizes)

