"""How the words of the sources of a language diverge, by in-mapper stripes.

A partition folds whole documents into stripes, one per language and term: the number of documents
and the occurrences per source. A full table of stripes is spilled to the shuffle. Stripes of one
key meet sorted and are merged as they pass; those of too few documents end there. What is left,
one stripe per kept term, directly gives differences of the shares of every two sources and of a
source and its language, which are summed over terms, and ranked.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import written

LEAST_DOCUMENTS = 30
TOP = 50
#: Added to every count.
SMOOTHING = 5
#: Shares are whole numbers of this part.
SCALE_STEPS = 3  # thousands: a billionth
#: Terms and sources that a task's table of stripes holds before it is spilled.
ENTRIES = 400_000
#: Characters of a text whose terms are listed at once; longer ones are walked through.
LISTED = 1 << 20
#: Parts that the kept terms of a language are dealt to.
SHARDS = 16
#: Cells of the differences between sources that a task holds; more are split by source.
CELLS = 4_000_000

#: Letters A-Z and all characters beyond ASCII, over UTF-8 after lower-casing.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: No term is empty: its stripe counts documents instead.
DOCUMENTS = b""
_STRIPE = "lang string, term binary, docs long, sources array<string>, counts array<long>"
_TYPE = pa.schema([
    ("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64()),
    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])


def _terms(text: bytes) -> Counter:
    text = text.lower()
    if len(text) <= LISTED:
        return Counter(TERM.findall(text))
    return Counter(map(itemgetter(0), TERM.finditer(text)))


def _spilled(table: dict[str, dict[bytes, list]], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    lines = [(lang, term, *s) for lang, own in table.items() for term, s in own.items()]
    for i in range(0, len(lines), rows):
        langs, terms, docs, by = zip(*lines[i : i + rows], strict=True)
        ends = np.cumsum([0, *map(len, by)], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()), pa.array(terms, pa.binary()), pa.array(docs, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array([s for x in by for s in x], pa.string())),
                pa.ListArray.from_arrays(ends, pa.array([n for x in by for n in x.values()], pa.int64())),
            ],
            schema=_TYPE,
        )


def _folded(entries: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole documents into stripes; a full table is spilled and begun afresh."""
        table: dict[str, dict[bytes, list]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = table.setdefault(lang, {})
                found = _terms(text)
                found[DOCUMENTS] = 1
                for term, n in found.items():
                    stripe = own.get(term)
                    if stripe is None:
                        own[term] = [1, {source: n}]
                        size += 1
                        continue
                    stripe[0] += 1
                    by = stripe[1]
                    if source in by:
                        by[source] += n
                    else:
                        by[source] = n
                        size += 1
                if size > entries:
                    yield from _spilled(table)
                    table, size = {}, 0
        yield from _spilled(table)

    return fold


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def _merged(rows: pa.Table) -> pa.RecordBatch:
    """One stripe per key of sorted stripes."""
    rows = rows.combine_chunks()
    lang, term, docs, sources, counts = (
        c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rows.columns
    )
    new = np.ones(len(rows), bool)
    new[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(
        zero_copy_only=False
    )
    first = np.flatnonzero(new)
    key = np.repeat(np.cumsum(new) - 1, pc.list_value_length(sources).to_numpy(zero_copy_only=False))
    names = pc.list_flatten(sources).dictionary_encode()
    entry = key * len(names.dictionary) + names.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(entry, kind="stable")
    entry = entry[order]
    start = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]]))
    total = _sums(pc.list_flatten(counts).to_numpy(zero_copy_only=False)[order], start)
    of, name = np.divmod(entry[start], len(names.dictionary))
    ends = np.searchsorted(of, np.arange(len(first) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            lang.take(pa.array(first)), term.take(pa.array(first)),
            pa.array(_sums(docs.to_numpy(zero_copy_only=False), first)),
            pa.ListArray.from_arrays(ends, names.dictionary.take(pa.array(name))),
            pa.ListArray.from_arrays(ends, pa.array(total)),
        ],
        schema=_TYPE,
    )


def _kept(least: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merge sorted stripes; those of ``least`` documents and the counts of documents stay."""

        def enough(rows: pa.RecordBatch) -> pa.RecordBatch:
            docs = pc.greater_equal(rows["docs"], least)
            return rows.filter(pc.or_(docs, pc.equal(rows["term"], pa.scalar(DOCUMENTS))))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(batch.columns, _TYPE, strict=True)], schema=_TYPE
            )
            merged = _merged(pa.Table.from_batches([*held, batch]))
            # The last key may go on in the next batch; it waits as one stripe.
            yield enough(merged.slice(0, merged.num_rows - 1))
            held = [merged.slice(merged.num_rows - 1)]
        yield from map(enough, held)

    return merge


def stripes(
    documents: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, entries: int = ENTRIES
) -> DataFrame:
    """``lang, term, docs, sources, counts`` of terms in at least ``least_documents`` documents.

    The stripe of the empty term counts the documents of a language and of its sources, even of
    those without a term. ``term`` is UTF-8.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    folded = documents.select(*plain, text.alias("text")).mapInArrow(_folded(entries), _STRIPE)
    return (
        folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
        .mapInArrow(_kept(least_documents), _STRIPE)
    )


def shares(counts: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """``floor(10^9 * counts / whole)`` exactly, by long division; counts up to ``whole`` < 9e15."""
    out, rest = np.divmod(counts, whole)
    for _ in range(SCALE_STEPS):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out


class _Language:
    """Sums and best terms of the sources of one language, over the terms that a task sees."""

    def __init__(self, shape: dict, top: int):
        self.lang, self.block, self.blocks, self.top = shape["lang"], shape["block"], shape["blocks"], top
        self.names = shape["sources"]
        self.at = {s: i for i, s in enumerate(self.names)}
        self.smooth = SMOOTHING * shape["terms"]
        self.whole = np.array(shape["counts"], np.int64) + self.smooth
        # Differences of a block's sources, every so-manieth, from all.
        self.own = np.arange(self.block, len(self.names), self.blocks)
        self.differ = np.zeros((len(self.own), len(self.names)), np.int64)
        self.best: list[list[tuple[int, bytes]]] = [[] for _ in self.own]

    def add(self, terms: list[bytes], sources: list[list[str]], counts: list[list[int]]) -> None:
        table = np.zeros((len(terms), len(self.names)), np.int64)
        line = np.repeat(np.arange(len(terms)), [len(s) for s in sources])
        table[line, [self.at[s] for x in sources for s in x]] = [n for x in counts for n in x]
        whole = int(self.whole.sum()) - self.smooth * (len(self.names) - 1)
        every = 1 + shares(table.sum(axis=1) + SMOOTHING, whole)
        each = 1 + shares(table + SMOOTHING, self.whole[None, :])
        for k, i in enumerate(self.own):
            self.differ[k] += np.abs(each - each[:, i : i + 1]).sum(axis=0)
            above = np.flatnonzero((table[:, i] > 0) & (each[:, i] > every))
            self.best[k] += [(int(every[t] - each[t, i]), terms[t]) for t in above]
            if len(self.best[k]) > 4 * self.top:
                self.best[k] = sorted(self.best[k])[: self.top]

    def rows(self) -> Iterator[tuple[str, str, str, bytes, int]]:
        for k, i in enumerate(self.own):
            for j, value in enumerate(self.differ[k]):
                if i != j:
                    yield self.lang, self.names[i], "pair", self.names[j].encode(), int(value)
            for value, term in sorted(self.best[k])[: self.top]:
                yield self.lang, self.names[i], "term", term, -value


_PART = "lang string, source string, part string, item binary, value long"


def _emitted(top: int, rows: int = 500):
    kinds = pa.schema([
        ("lang", pa.string()), ("source", pa.string()), ("part", pa.string()),
        ("item", pa.binary()), ("value", pa.int64()),
    ])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A language's shape comes first, then its stripes; sums go out when it ends."""
        now: _Language | None = None
        for batch in batches:
            i = 0
            shape = batch["shape"].to_pylist()
            for k in [*(k for k, s in enumerate(shape) if s), len(shape)]:
                # A wide language takes fewer terms at once.
                while i < k:
                    step = min(k, i + max(1, min(rows, CELLS // len(now.names)))) - i
                    part = batch.slice(i, step)
                    now.add(*(part[c].to_pylist() for c in ("term", "sources", "counts")))
                    i += step
                if k == len(shape):
                    break
                if now is None or (now.lang, now.block) != (shape[k]["lang"], shape[k]["block"]):
                    if now:
                        yield from sent(now)
                    now = _Language(shape[k], top)
                i = k + 1
        if now:
            yield from sent(now)

    def sent(one: _Language) -> Iterator[pa.RecordBatch]:
        lines = list(one.rows())
        for i in range(0, len(lines), 100_000):
            columns = zip(*lines[i : i + 100_000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds
            )

    return emit


def _shapes(kept: DataFrame) -> DataFrame:
    """Per language, its sources in order, their occurrences of kept terms, and how many there are."""
    real = kept.where(F.col("term") != F.lit(DOCUMENTS))
    each = kept.select(
        "lang", (F.col("term") == F.lit(DOCUMENTS)).alias("documents"),
        F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))),
    ).toDF("lang", "documents", "source", "n")
    whole = each.groupBy("lang", "source").agg(
        F.coalesce(F.sum(F.when(~F.col("documents"), F.col("n"))), F.lit(0)).alias("n")
    )
    lines = whole.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("x"))
    terms = real.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("terms"))
    return lines.join(terms, F.col("lang") == F.col("of"), "left").select(
        "lang", F.col("x.source").alias("sources"), F.col("x.n").alias("counts"),
        F.coalesce("terms", F.lit(0)).alias("terms"),
    )


def source_divergence(
    documents: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, top: int = TOP,
    entries: int = ENTRIES,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    A term is a run of letters A-Z and characters beyond ASCII, with A-Z lower-cased; a language
    keeps those in at least ``least_documents`` of its documents. The share of a term is
    ``p = 1 + floor(10^9 * (count + 5) / (all + 5 * terms))``. Part ``pair``: the other sources of
    a language by their distance, the sum of differences of ``p`` over its kept terms. Part
    ``term``: the ``top`` terms that a source has with more than its language's share, by the
    excess. Ranks go by value descending, then by the item's UTF-8.

    Null language, source and text count as empty. A source without terms is a source; a language
    without kept terms has distances of 0. Every row is a document, repeated ones too; an empty
    table gives an empty result; further columns are not read. Sources of one language are held
    in one row, as their square is the size of the result; terms are not.
    """
    kept = written(stripes(documents, least_documents=least_documents, entries=entries))
    shapes = written(_shapes(kept))
    widest = shapes.agg(F.max(F.size("sources")).alias("n")).first()["n"] or 0
    blocks = -(-widest * widest // CELLS) or 1
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("term", "binary"), ("sources", "array<string>"), ("counts", "array<long>"))]
    heads = shapes.select("*", every).select(
        "lang", "block", F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1))).alias("shard"),
        F.struct("lang", "block", F.lit(blocks).alias("blocks"), "sources", "counts", "terms").alias("shape"),
        *none,
    )
    shard = F.pmod(F.xxhash64("term"), F.lit(SHARDS)).cast("int").alias("shard")
    lines = kept.where(F.col("term") != F.lit(DOCUMENTS)).select(
        "lang", every, shard, F.lit(None).cast(heads.schema["shape"].dataType).alias("shape"),
        "term", "sources", "counts",
    )
    parts = (
        heads.unionByName(lines).repartition("lang", "block", "shard")
        .sortWithinPartitions("lang", "block", "shard", F.col("shape").isNull())
        .mapInArrow(_emitted(top), _PART)
    )
    item = F.col("item").cast("string").alias("item")
    sums = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    return _ranked(sums.select("lang", "source", "part", item, "value"), top)


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    group = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    within: Column = (F.col("part") == "pair") | (F.col("rank") <= top)
    return rows.withColumn("rank", F.row_number().over(group)).where(within)
