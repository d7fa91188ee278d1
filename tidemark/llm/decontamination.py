"""Benchmark windows inside documents, by a prefix-filtered join.

The words of an item's windows are ordered by rarity in the whole corpus. A document that contains
a window contains its rarest word, so this one word is the prefix that has to be joined: every
position of a document whose word is some window's rarest is a candidate. The start that the word
implies must leave room for the whole window on both sides (position and length bounds), and the
words there are then compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm.text import ascii_lower

WINDOW = 10
#: Windows that are broadcast at once; a larger benchmark is joined block by block.
BLOCK = 200_000

_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: F.Column) -> F.Column:
    """Runs of digits, letters and non-ASCII characters after lower-casing A-Z; null has none."""
    return F.array_remove(F.split(ascii_lower(text), _GAPS), "")


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``words, items, n``: the distinct windows and the ids, as strings, of their items.

    An item of fewer words than ``window``, but not none, is one window. A null id shows as "".
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words_of(F.col("text")).alias("w"),
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("n", F.size("words"))


def _with_rarest(windows: DataFrame, documents: DataFrame) -> DataFrame:
    """Windows with their rarest word and its offset; those with a word no document has go."""
    own = windows.select(F.explode("words").alias("word")).distinct()
    counts = (
        documents.select(F.explode("words").alias("word"))
        .join(F.broadcast(own), "word")
        .groupBy("word").agg(F.count(F.lit(1)).alias("seen"))
    )
    each = windows.select("*", F.posexplode("words").alias("offset", "word"))
    ranked = each.join(counts, "word", "left").groupBy("words", "items", "n").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "word", "offset")).alias("least")
    )
    return ranked.where("least.seen > 0").select(
        "words", "items", "n", F.col("least.word").alias("word"), F.col("least.offset").alias("offset")
    )


def occurrences(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """``row, start, n, items`` for every place where a window occurs (``row, words`` given)."""
    start = F.col("pos") - F.col("offset")
    found = documents.select("row", F.col("words").alias("own"), F.posexplode("words").alias("pos", "word"))
    return (
        found.join(F.broadcast(windows), "word")
        .where((start >= 0) & (start + F.col("n") <= F.size("own")))
        .where(F.slice("own", start + 1, F.col("n")) == F.col("words"))
        .select("row", start.alias("start"), "n", "items")
    )


def _covered(spans: F.Column) -> F.Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("to"))

    def step(seen, span):
        end = span["start"] + span["n"]
        more = F.greatest(end - F.greatest(span["start"], seen["to"]), F.lit(0))
        return F.struct((seen["total"] + more).alias("total"), F.greatest(end, seen["to"]).alias("to"))

    return F.aggregate(spans, start, step)["total"]


def contamination(
    documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block: int = BLOCK,
    key: str | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, contaminated``.

    ``n_hit`` counts the words inside any occurrence of an item's window and ``items`` lists the
    items with such windows, sorted as strings. Null and empty texts have no words. Rows are told
    apart by a number of their own, so null and repeated ids and repeated rows are answered each.
    An empty benchmark hits nothing; an empty table gives an empty result. Further columns are not
    read, but for one that ``key`` names, which each row keeps as ``row_key``.
    """
    own_key = [] if key is None else [F.col(key).alias("row_key")]
    keyed = ["row_key"] if own_key else []
    rows = written(
        documents.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id"),
            words_of(F.col("text").cast("string")).alias("words"), *own_key,
        ).withColumn("n_words", F.size("words").cast("long"))
    )
    windows = windows_of(benchmark, window)
    blocks = max(1, -(-windows.count() // block))
    marked = written(_with_rarest(windows, rows).withColumn("b", F.pmod(F.xxhash64("words"), F.lit(blocks))))
    hits = reduce(
        DataFrame.unionByName,
        [occurrences(rows, marked.where(F.col("b") == b).drop("b")) for b in range(blocks)],
    )
    per_row = hits.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    ).select(F.col("row").alias("r"), _covered(F.col("spans")).alias("n_hit"), "items")
    return rows.select("row", "doc_id", "n_words", *keyed).join(per_row, F.col("row") == F.col("r"), "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"), *keyed,
    )
