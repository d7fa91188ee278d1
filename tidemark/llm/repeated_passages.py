"""Passages that occur in earlier documents, located by sharded Aho-Corasick automata.

1. Phrases of ``SEED`` words are chosen so that every window of ``LENGTH`` words holds one, and
   equal windows the same. Spark counts them; those of two documents or more are confirmed.
2. Confirmed phrases are dealt into shards by the document they first occur in, so the phrases of
   one source lie together. A document goes to the shards of the phrases it holds, no other shard
   has a pattern for it; crowded shards are split by documents, each part with all patterns.
3. Each part compiles an automaton over words, one character per word, and streams its documents
   through it, which gives every place of every confirmed phrase.
4. The windows around these places are ranked as in ``repeats``, and the words of those that an
   earlier document has are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm import repeats
from tidemark.llm.repeats import ROW
from tidemark.llm.word_hash import WordHashes

LENGTH = 50
SEED = 20
#: Phrases per automaton, about, and bytes of the texts that one of its parts streams, about.
PHRASES, BYTES = 20_000, 16 << 20

_HASHES = WordHashes()


def _words(text: str | None) -> list[bytes]:
    """Cut at ASCII white space."""
    return (text or "").encode("utf-8").split()


def _numbers(text: str | None) -> np.ndarray:
    return _HASHES.of(_words(text))


KIND = repeats.Kind(length=LENGTH, seed=SEED, numbers=_numbers, within=False)


def _characters(numbers: np.ndarray) -> str:
    """One character beyond the basic plane per word: 20 bits of its hash."""
    return ((numbers >> np.uint64(44)).astype("<u4") + np.uint32(0x10000)).tobytes().decode("utf-32-le")


def _phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for o, v, text in zip(batch["o"], batch["v"], batch["text"], strict=True):
            parts = [seed for seed, *_ in repeats.positions(_numbers(text), KIND)]
            if parts:
                found.append((o, v, np.unique(np.concatenate(parts))))
        yield repeats.rows_of(found, ["phrase"])


def _unshared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts without confirmed phrases are done; the others go on."""
    for batch in batches:
        words = [_words(t) for t in batch["text"]]
        alone = batch["shards"].isna()
        yield batch.assign(
            n_words=[len(w) for w in words],
            kept=[b" ".join(w) if a else None for w, a in zip(words, alone, strict=True)],
            text=batch["text"].where(~alone, None), doc_id=batch["doc_id"].astype("Int64"),
        )


def _patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The confirmed phrases that a text is the first to hold, as characters."""
    for batch in batches:
        out = []
        for text, firsts in zip(batch["text"], batch["firsts"], strict=True):
            wanted = {x["phrase"]: x["shard"] for x in firsts}
            data = _numbers(text)
            for seed, _, _, place in repeats.positions(data, KIND):
                for s, p in zip(seed.tolist(), place.tolist(), strict=True):
                    if s in wanted:
                        out.append((wanted.pop(s), _characters(data[p : p + SEED])))
        yield pd.DataFrame(out, columns=["shard", "pattern"])


def _located(patterns: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    """Seed and region ranks around every place where a pattern of the shard occurs."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for pattern in patterns["pattern"]:
        automaton.add_word(pattern)
    found = []
    if len(automaton):
        automaton.make_automaton()
        for o, v, text in zip(texts["o"], texts["v"], texts["text"], strict=True):
            data = _numbers(text)
            place = np.array([end - SEED + 1 for end, _ in automaton.iter(_characters(data))], np.int64)
            # Windows that hold the phrase, inside the text and inside their piece.
            piece = place // repeats.PIECE * repeats.PIECE
            first = np.maximum(place - (LENGTH - SEED), 0)
            last = np.minimum(place, len(data) - LENGTH)
            for low, high in ((np.maximum(first, piece), last), (first, np.minimum(last, piece - 1))):
                own = low <= high
                at = repeats.packed(low[own], high[own], place[own])
                found += [(o, v, *ranks) for ranks in repeats.region_ranks(data, at, KIND)]
    return repeats.rows_of(found, ["seed", "region", "at"])


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
            words = _words(text)
            lost = repeats.gone(spans, len(words), LENGTH)
            left = b" ".join([w for w, x in zip(words, lost.tolist(), strict=True) if not x])
            out.append((doc, len(words), int(lost.sum()), left))
        yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"doc_id": "Int64"})


def removed_passages(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept``.

    Every word goes that lies in a window of ``LENGTH`` words which also starts in a document with
    a smaller id; windows are judged on the input. Words are cut at ASCII white space, and ``kept``
    has those that stay, in UTF-8, joined by a space. Null, empty and blank texts have no words.
    Null ids come after all others and, like rows that share an id, remove nothing from each other;
    each such row is answered by its own text. An empty table gives an empty result; further
    columns are not read.
    """
    own = repeats.texts_of(documents)
    # Read three times below, so the texts are cut and hashed once.
    phrases = written(own.select("o", "v", "text").mapInPandas(_phrases, f"{ROW}phrase long"))
    confirmed = written(
        phrases.groupBy("phrase").agg(F.min(F.struct("o", "v")).alias("first"), F.max("o").alias("high"))
        .where("first.o < high").select("phrase", "first")
    )
    shards = max(1, -(-confirmed.count() // PHRASES))
    dealt = confirmed.withColumn("shard", F.pmod(F.xxhash64("first.o"), F.lit(shards)))
    mine = (F.col("o") == F.col("first.o")) & (F.col("v") == F.col("first.v"))
    routes = phrases.join(dealt, "phrase").groupBy("o", "v").agg(
        F.collect_set("shard").alias("shards"),
        F.collect_set(F.when(mine, F.struct("phrase", "shard"))).alias("firsts"),
    )
    fields = (
        f"doc_id long, text string, {ROW}shards array<long>,"
        " firsts array<struct<phrase: long, shard: long>>, n_words long, kept binary"
    )
    joined = written(
        own.join(routes, ["o", "v"], "left").select("doc_id", "text", "o", "v", "shards", "firsts")
        .mapInPandas(_unshared, fields)
    )
    texts = joined.where("shards IS NOT NULL")
    single = texts.select("o", "v", "text", "shards", "firsts").dropDuplicates(["o", "v"])
    patterns = single.where(F.size("firsts") > 0).select("text", "firsts").mapInPandas(
        _patterns, "shard long, pattern string"
    )
    parts = single.select(F.explode("shards").alias("s"), F.octet_length("text").alias("size")).groupBy(
        "s"
    ).agg(F.ceil(F.sum(F.col("size") + 1) / BYTES).alias("parts"))
    left = patterns.join(parts, F.col("shard") == F.col("s")).select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "pattern"
    )
    streamed = single.select("o", "v", "text", F.explode("shards").alias("shard"))
    right = streamed.join(parts, F.col("shard") == F.col("s")).select(
        F.col("shard"), F.pmod(F.xxhash64("o", "v"), F.col("parts")).alias("part"), "o", "v", "text"
    )
    regions = written(
        left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(
            _located, f"{ROW}seed long, region long, at long"
        )
    )
    spans = repeats.repeated_spans(texts.select("o", "v", "text"), regions, KIND)
    some = texts.select("doc_id", "o", "v", "text").join(spans, ["o", "v"], "left")
    done = some.select("doc_id", "text", "spans").mapInPandas(
        _kept, "doc_id long, n_words long, n_removed long, kept binary"
    )
    return done.unionByName(
        joined.where("shards IS NULL").select(
            "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept"
        )
    )
