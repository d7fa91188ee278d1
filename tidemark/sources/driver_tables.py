"""Adapters from the driver's Parquet tables to our input tables (FIXTURES.md section 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUEST_HOURS = (0, 1, 6, 12)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def use_utc(spark: SparkSession) -> None:
    """The driver's times carry no zone and are declared UTC here."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def page_events(spark: SparkSession, folder: str) -> DataFrame:
    use_utc(spark)
    at = F.col("ts").cast("timestamp")
    minutes = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat_ws(
            "-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")
        ).alias("session_id"),
        at.alias("event_at"),
        (at + F.make_dt_interval(mins=minutes)).alias("available_at"),
        F.col("event_type").alias("page_category"),
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return (
        table(spark, folder, "customer")
        .select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("source"))
        .join(nation, "c_nationkey")
        .drop("c_nationkey")
    )


def _starts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per session: its user and its first event."""
    use_utc(spark)
    user = F.col("user_id")
    return (
        table(spark, folder, "events")
        .groupBy(
            user,
            F.concat_ws("-", user.cast("string"), F.date_format("ts", "yyyyMMdd")).alias(
                "session_id"
            ),
        )
        .agg(F.min(F.col("ts").cast("timestamp")).alias("session_start_at"))
    )


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    customers = _customers(spark, folder).withColumnRenamed("c_custkey", "user_id")
    return (
        _starts(spark, folder)
        .join(customers, "user_id")
        .select(
            "session_id",
            F.col("user_id").cast("string").alias("user_id"),
            "session_start_at",
            "country",
            (F.lit(13) + F.col("user_id") % 88).alias("age"),
            (F.col("user_id") % 2).alias("new_user"),
            "source",
        )
    )


def score_requests(spark: SparkSession, folder: str) -> DataFrame:
    hour = F.explode(F.array(*[F.lit(h) for h in REQUEST_HOURS])).alias("hour")
    return (
        _starts(spark, folder)
        .select("session_id", "session_start_at", hour)
        .select(
            F.concat_ws("#", "session_id", F.col("hour").cast("string")).alias("score_id"),
            "session_id",
            (F.col("session_start_at") + F.make_dt_interval(hours=F.col("hour"))).alias(
                "score_at"
            ),
        )
    )


def conversions(spark: SparkSession, folder: str) -> DataFrame:
    """The six conversion columns plus ``row_id``, the order key."""
    customers = _customers(spark, folder).withColumnRenamed("c_custkey", "o_custkey")
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", "o_totalprice")
        .join(customers, "o_custkey")
        .select(
            F.col("o_orderkey").alias("row_id"),
            "country",
            (F.lit(13) + F.col("o_custkey") % 88).cast("int").alias("age"),
            (F.col("o_custkey") % 2).cast("int").alias("new_user"),
            "source",
            (F.lit(1) + F.floor(F.col("o_totalprice") / 25000)).cast("int").alias(
                "total_pages_visited"
            ),
            ((F.col("o_totalprice") > 400000) & (F.col("o_orderkey") % 5 != 0))
            .cast("int")
            .alias("converted"),
        )
    )


def _scores(spark: SparkSession, folder: str, score) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("label"),
        score.alias("score"),
    )


def fine_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores that are nearly all distinct."""
    return _scores(spark, folder, F.col("o_totalprice") / 500000)


def tied_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores with some fifty distinct values."""
    return _scores(spark, folder, F.floor(F.col("o_totalprice") / 10000) / 50)
