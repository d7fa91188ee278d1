"""Point-in-time features and their audit counters.

An event counts for a request when it occurred strictly before the request and had arrived by
it. On integer microseconds both conditions are one: visible_at = max(event_at + 1, available_at)
is at or before the request. Features are running totals along that line, in
O((events + requests) log) work and without (request, event) pairs.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.errors import ContractError
from tidemark.operators.combine import side_by_side
from tidemark.operators.events import EventTables
from tidemark.operators.slices import ROWS_PER_SLICE, session_slices, with_slice

MICROS = 1_000_000


def _visible_at() -> Column:
    return F.greatest(F.col("event_at_us") + 1, F.col("available_at_us"))


def _spread(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(65536))


def _moments(tables: EventTables, *, occurred: bool = False) -> DataFrame:
    """Events, first category sightings and requests on one time line per session.

    ``side`` orders rows of one instant: what happened before what asks. Its spread only makes
    rows of one instant separable.
    """
    none_long, none_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def line(frame, at, side, pages=zero, categories=zero, before=zero, seen=none_long,
             score=none_text):
        return frame.select(
            "session_id", at.alias("at"), side.cast("bigint").alias("side"),
            pages.alias("pages"), categories.alias("categories"), before.alias("occurred"),
            seen.alias("seen_at"), score.alias("score_id"),
        )

    events = tables.events
    sightings = events.groupBy("session_id", "page_category").agg(F.min(_visible_at()).alias("at"))
    past = F.lit(-1) - _spread("event_id")
    parts = [
        line(events, _visible_at(), past, pages=one, seen=F.col("event_at_us")),
        line(sightings, F.col("at"), F.lit(-1), categories=one),
        line(
            tables.requests, F.col("score_at_us"), F.lit(1) + _spread("score_id"),
            score=F.col("score_id"),
        ),
    ]
    if occurred:
        parts.append(line(events, F.col("event_at_us") + 1, past, before=one))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _line_points(tables: EventTables) -> DataFrame:
    """The columns that decide the slices, read straight from the inputs."""
    events = tables.events.select(
        "session_id", _visible_at().alias("at"), (F.lit(-1) - _spread("event_id")).alias("side")
    )
    requests = tables.requests.select(
        "session_id", F.col("score_at_us").alias("at"),
        (F.lit(1) + _spread("score_id")).alias("side"),
    )
    return events.unionAll(requests)


def _history(tables: EventTables, rows_per_slice: int, *, occurred: bool = False) -> DataFrame:
    """Running totals at every request, before the session columns are added."""
    moments = _moments(tables, occurred=occurred)
    slices = session_slices(_line_points(tables), rows_per_slice=rows_per_slice)
    sums, keep = ("pages", "categories", "occurred"), ("session_id", "score_id", "at")
    if slices.isEmpty():
        upto = Window.partitionBy("session_id").orderBy("at", "side").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return moments.select(
            *keep,
            *[F.sum(name).over(upto).alias(name) for name in sums],
            F.max("seen_at").over(upto).alias("seen_at"),
        ).where("score_id is not null")
    placed = with_slice(moments, slices)
    earlier = Window.partitionBy("session_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per slice of a cut session: the broadcast is bounded by the number of cuts.
    carry = (
        placed.where("is_sliced")
        .groupBy("session_id", "slice")
        .agg(*[F.sum(n).alias(n) for n in sums], F.max("seen_at").alias("seen_at"))
        .select(
            "session_id",
            "slice",
            *[F.sum(n).over(earlier).alias(f"{n}_before") for n in sums],
            F.max("seen_at").over(earlier).alias("seen_at_before"),
        )
    )
    upto = Window.partitionBy("session_id", "slice").orderBy("at", "side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        placed.select(
            *keep,
            "slice",
            *[F.sum(n).over(upto).alias(n) for n in sums],
            F.max("seen_at").over(upto).alias("seen_at"),
        )
        .where("score_id is not null")
        .join(F.broadcast(carry), ["session_id", "slice"], "left")
        .select(
            *keep,
            *[(F.col(n) + F.coalesce(F.col(f"{n}_before"), F.lit(0))).alias(n) for n in sums],
            F.greatest("seen_at", "seen_at_before").alias("seen_at"),
        )
    )


def point_in_time_features(
    tables: EventTables, *, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """One row per score request with the thirteen feature columns."""
    return (
        _history(tables, rows_per_slice)
        .join(tables.sessions, "session_id")
        .withColumnsRenamed(
            {
                "at": "score_at_us",
                "pages": "pages_observed_at_score_time",
                "categories": "unique_page_categories_observed",
                "seen_at": "feature_max_event_at_us",
            }
        )
        .withColumns(
            {
                "seconds_since_session_start": F.expr(
                    f"(score_at_us - session_start_at_us) div {MICROS}"
                ),
                "seconds_since_last_page_view": F.expr(
                    f"(score_at_us - feature_max_event_at_us) div {MICROS}"
                ),
            }
        )
        .select(*schemas.FEATURE_COLUMNS)
    )


def load_point_in_time_sql() -> str:
    """The packaged feature query; its text is versioned by its SHA-256."""
    return (
        resources.files("tidemark.plans")
        .joinpath("sql", "point_in_time_features.sql")
        .read_text(encoding="utf-8")
    )


def sql_features(
    spark: SparkSession, tables: EventTables, *, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """The packaged query over ``tables``; same result as ``point_in_time_features``.

    The tables are handed over by name, so no view of the session is touched.
    """
    slices = session_slices(_line_points(tables), rows_per_slice=rows_per_slice)
    if slices.isEmpty():
        # Known to be empty, the planner leaves out what only sliced sessions need.
        slices = slices.limit(0)
    return spark.sql(
        load_point_in_time_sql(), sessions=tables.sessions, score_requests=tables.requests,
        page_events=tables.events, session_slices=slices,
    )


def in_score_order(features: DataFrame) -> DataFrame:
    return features.orderBy("score_id")


def model_features(features: DataFrame) -> DataFrame:
    """The columns a model may see: no keys and no audit times."""
    return features.select(*schemas.MODEL_FEATURES)


def pit_audit(tables: EventTables, *, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Eleven counters over all (request, event) pairs of a session, without the pairs.

    Candidates are products of per-session counts, boundary pairs are equi-joins of counts, and
    the rest are sums of running totals. Products are exact decimals; the final cast fails rather
    than wraps.
    """
    events, requests = tables.events, tables.requests
    wide = "decimal(38,0)"

    def total(value: str) -> Column:
        return F.coalesce(F.sum(F.expr(value).cast(wide)), F.lit(0).cast(wide))

    def at_same_time(side: DataFrame, column: str) -> DataFrame:
        left = side.groupBy("session_id", F.col(column).alias("at")).agg(
            F.count(F.lit(1)).alias("e")
        )
        right = requests.groupBy("session_id", F.col("score_at_us").alias("at")).agg(
            F.count(F.lit(1)).alias("r")
        )
        return left.join(right, ["session_id", "at"])

    per_session = (
        events.groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("e"))
        .join(requests.groupBy("session_id").agg(F.count(F.lit(1)).alias("r")), "session_id")
    )
    product = "cast(e as decimal(19,0)) * cast(r as decimal(19,0))"
    history = _history(tables, rows_per_slice, occurred=True)
    parts = [
        tables.sessions.agg(F.count(F.lit(1)).cast(wide).alias("session_rows")),
        requests.agg(F.count(F.lit(1)).cast(wide).alias("score_request_rows")),
        events.agg(F.count(F.lit(1)).cast(wide).alias("page_event_rows")),
        per_session.agg(total(product).alias("candidates")),
        at_same_time(events, "event_at_us").agg(total(product).alias("same_event_time")),
        at_same_time(events.where("event_at_us < available_at_us"), "available_at_us").agg(
            total(product).alias("same_arrival")
        ),
        history.agg(
            total("pages").alias("eligible"),
            total("occurred").alias("occurred"),
            F.count_if(F.col("pages") == 0).cast(wide).alias("no_history"),
            F.count(F.lit(1)).cast(wide).alias("output_rows"),
        ),
    ]
    return side_by_side(parts).selectExpr(
        "cast(session_rows as bigint) as session_rows",
        "cast(score_request_rows as bigint) as score_request_rows",
        "cast(page_event_rows as bigint) as page_event_rows",
        "cast(candidates as bigint) as candidate_event_score_pairs",
        "cast(eligible as bigint) as eligible_event_score_pairs",
        "cast(same_event_time as bigint) as exact_score_boundary_pairs_excluded",
        "cast(same_arrival as bigint) as exact_availability_boundary_pairs_included",
        "cast(candidates - occurred - same_event_time as bigint)"
        " as future_event_score_pairs_excluded",
        "cast(occurred - eligible as bigint) as late_event_score_pairs_excluded",
        "cast(no_history as bigint) as zero_history_score_requests",
        "cast(output_rows as bigint) as output_rows",
    )


def require_grain(audit: DataFrame) -> None:
    """Fail when the feature table has more or fewer rows than there are requests."""
    row = audit.select("score_request_rows", "output_rows").first()
    if row["score_request_rows"] != row["output_rows"]:
        raise ContractError(
            "features changed the request grain; "
            f"count={abs(row['score_request_rows'] - row['output_rows'])}"
        )
