"""Helpers that the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as empty.

    ``lower`` is quick, and the same on texts of ASCII characters alone.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(
        F.lower(text)
    )


def bare(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that further columns cannot clash with ours."""
    return documents.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
