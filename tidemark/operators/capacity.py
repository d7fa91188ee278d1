"""Hard batch capacity: at most K requests, chosen by score, then by hashed key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ContractError
from tidemark.functions.text import strip
from tidemark.operators.checks import (
    Rule,
    broken_unless,
    duplicate_key_rows,
    raise_first,
    violation_rows,
)
from tidemark.operators.prefix import ROWS_PER_BUCKET
from tidemark.operators.ranking import boundary_value

TIE_DOMAIN = "tidemark:batch-capacity:v1:"


def capacity_violations(frame: DataFrame, *, key: str = "key", score: str = "score") -> DataFrame:
    """Counters over all rows: scores in [0, 1]; keys present, unpadded and unique."""
    value, text = F.col(score), F.col(key)
    if isinstance(frame.schema[score].dataType, T.NumericType):
        sound = value.cast("double").between(0.0, 1.0) & ~F.isnan(value.cast("double"))
    else:
        sound = F.lit(False)
    whole = (
        (text != "") & (text == strip(text))
        if isinstance(frame.schema[key].dataType, T.StringType) else F.lit(False)
    )
    rows = violation_rows(
        frame,
        [
            Rule(0, "batch", "score is not a number in [0, 1]", broken_unless(sound)),
            Rule(1, "batch", "key is missing, empty or padded", broken_unless(whole)),
        ],
    )
    repeated = violation_rows(
        duplicate_key_rows(frame, text.cast("string")),
        [Rule(2, "batch", "key is not unique", F.sum("rows"))],
    )
    return rows.unionAll(repeated)


def _check_arguments(capacity: object, minimum_score: object) -> None:
    if isinstance(capacity, bool) or not isinstance(capacity, int) or capacity < 0:
        raise ContractError("capacity must be a non-negative integer")
    if minimum_score is None:
        return
    number = isinstance(minimum_score, (int, float)) and not isinstance(minimum_score, bool)
    if not number or not 0 <= minimum_score <= 1:
        raise ContractError("minimum score must be a number in [0, 1]")


def select_top_k(
    frame: DataFrame,
    *,
    capacity: int,
    minimum_score: float | None = None,
    key: str = "key",
    score: str = "score",
    domain: str = TIE_DOMAIN,
    validate: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``frame`` with ``selected``: the first ``capacity`` rows by descending score, then by
    SHA-256 of domain and key, then by key.

    With a floor, rows below it are never selected. The selection depends on the set of rows and
    not on their order. The boundary is searched for first; the selection is then a comparison
    on each row, so neither a large capacity nor a large block of equal scores is sorted whole.
    """
    _check_arguments(capacity, minimum_score)
    if validate:
        raise_first(capacity_violations(frame, key=key, score=score))
    digest = F.sha2(F.concat(F.lit(domain), F.col(key)).cast("binary"), 256)
    value = F.col(score).cast("double") + F.lit(0.0)
    eligible = F.lit(True) if minimum_score is None else value >= F.lit(float(minimum_score))
    ranked = frame.where(eligible).select(
        value.alias("_score"), digest.alias("_digest"), F.col(key).alias("_key"),
        # The first 52 bits of the digest as a number: exact in a double, and even.
        F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").alias("_head"),
    )
    if capacity == 0:
        return frame.withColumn("selected", F.lit(False))
    last = boundary_value(
        ranked, "_score", capacity, descending=True, rows_per_bucket=rows_per_bucket
    )
    if last is None or last.before + last.ties == capacity:
        floor = eligible if last is None else eligible & (value >= F.lit(last.value))
        return frame.withColumn("selected", floor)
    above = value > F.lit(last.value)
    block = ranked.where(F.col("_score") == F.lit(last.value))
    wanted = capacity - last.before
    head = boundary_value(block, "_head", wanted, rows_per_bucket=rows_per_bucket)
    # Rows that share 52 bits of a SHA-256: hardly ever more than one.
    final = (
        block.where(F.col("_head") == F.lit(head.value))
        .orderBy("_digest", "_key")
        .limit(wanted - head.before)
        .agg(F.max(F.struct("_digest", "_key")).alias("last"))
        .first()["last"]
    )
    within = F.struct(digest.alias("d"), F.col(key).alias("k")) <= F.struct(
        F.lit(final["_digest"]).alias("d"), F.lit(final["_key"]).alias("k")
    )
    return frame.withColumn("selected", above | ((value == F.lit(last.value)) & within))
