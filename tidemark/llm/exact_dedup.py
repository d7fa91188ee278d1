"""Exact duplicates by digest, with frequent digests split from the rest.

A summary of the Misra-Gries kind (``freqItems``, which keeps a bounded number of counters and
decrements all of them when they are full) names the digests that may be frequent. It may name
too many, never too few above its support, so its candidates are counted exactly; the verified
ones, at most ``1 / support``, are broadcast with the row that stays, and their copies are
resolved on the map side. All other digests meet in an ordinary shuffle of (id, digest) rows.
Texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm.text import ascii_lower, bare

#: Share of the rows from which a digest counts as frequent. Bounds the broadcast at its inverse.
SUPPORT = 0.001


def digests(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256, in lower-case hex, of the text after lower-casing A-Z."""
    return bare(documents).select(
        "doc_id", F.sha2(ascii_lower(F.col("text")), 256).alias("digest")
    )


def frequent(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Verified frequent digests with ``keep_id`` and ``group_size``; at most ``1 / support``."""
    total = rows.count()
    candidates = rows.stat.freqItems(["digest"], support).select(
        F.explode("digest_freqItems").alias("digest")
    ).distinct()
    return (
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") > total * support)
    )


def exact_duplicates(documents: DataFrame, *, support: float = SUPPORT) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest ``doc_id`` stays; a null id is smaller than any other. Rows
    that repeat a ``doc_id`` count as documents each and share its answer. An empty table gives
    an empty result; columns other than ``doc_id`` and ``text`` are not read.
    """
    rows = written(digests(documents))
    heavy = written(
        frequent(rows, support).select(F.col("digest").alias("h"), "keep_id", "group_size")
    )
    light = rows.join(F.broadcast(heavy), F.col("digest") == F.col("h"), "left_anti")
    groups = light.groupBy(F.col("digest").alias("g")).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    resolved = rows.join(F.broadcast(heavy), F.col("digest") == F.col("h")).unionByName(
        light.join(groups, F.col("digest") == F.col("g")).withColumnRenamed("g", "h")
    )
    return resolved.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows that stay, with all columns of ``documents``; of rows equal in id and text, one."""
    own = "tidemark_digest"
    marked = documents.withColumn(own, F.sha2(ascii_lower(F.col("text")), 256))
    stay = exact_duplicates(documents).where("kept").groupBy(
        F.col("doc_id").alias("i"), F.col("text_sha256").alias("d")
    ).agg(F.count(F.lit(1)).alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col(own) == F.col("d"))
    once = marked.join(stay.where("n = 1"), same, "left_semi")
    often = marked.join(stay.where("n > 1"), same, "left_semi").dropDuplicates(["doc_id", own])
    return once.unionByName(often).drop(own)
