"""The corpus pipeline: language, exact and near duplicates, leaks of the benchmark, tokens.

Every stage works on all that the one before kept. Null and repeated ids, null and empty texts,
empty tables and further columns are taken as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm import bpe_codec, decontamination, exact_dedup, language_spans, near_dedup
from tidemark.llm.queries import encoded_digests, remainder, table
from tidemark.llm.shipping import ship

#: The stage has no contract of its own, unlike op8 with its 85 %.
NEAR_PERCENT = 80


#: Tells rows apart by id and text, since one id, or none, may stand for several texts.
KEY = "tidemark_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 256-bit digest of id and text. A null text counts as empty, as in the operators."""
    both = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\x00"),
        F.coalesce(F.col("text").cast("string"), F.lit("")),
    )
    return docs.withColumn(KEY, F.unhex(F.sha2(both, 256)))


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of keyed ``docs`` whose key is not the ``row_key`` of any of ``rows``."""
    gone = rows.select(F.col("row_key").alias("tidemark_gone")).distinct()
    return docs.join(gone, F.col(KEY) == F.col("tidemark_gone"), "left_anti").drop(KEY)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which no language can be told (null, empty, or without a letter) go."""
    ship(spark)
    model = language_spans.fit(docs, remainder(3) != 1)
    own = "tidemark_language"
    marked = docs.withColumn(own, language_spans.predicted(F.col("text"), model, words=50_000))
    return marked.where(F.col(own)["lang"] != language_spans.UNKNOWN).drop(own)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the document with the least id stays.

    Links join texts whose five-word shingles agree in ``NEAR_PERCENT`` of their union or more.
    """
    ship(spark)
    docs = _keyed(docs)
    found = near_dedup.near_duplicates(docs, percent=NEAR_PERCENT, key=KEY)
    return _without(docs, found.where("NOT kept"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    docs = _keyed(docs)
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), key=KEY)
    return _without(docs, found.where("contaminated"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded texts of what is left, as digests."""
    ship(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    # Stages share the workers: what one keeps in memory is missing for the others.
    return encoded_digests(bpe_codec.encode_documents(docs, path, rows=400, remembered=200_000, release=True))


STAGES = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("leaks", leaks),
    ("tokens", tokens),
]

#: A fitted language model and a tokenizer decide, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
