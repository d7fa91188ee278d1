"""Packs documents into sequences of a fixed room: dominance reduction, then best fit.

What a packing needs to know of the corpus is how many pieces there are of each length, at most
``limit`` numbers whatever its size. On them, sets of pieces are fixed for good that dominate every
other set around their longest piece: an exact pair, a piece that nothing fits beside, the largest
single partner where one at most, or no better two, fit (Martello and Toth). What is left is
packed by best fit, longest first, many equal pieces at a step. The plan says which rank among the
pieces of a length goes where, and the pieces find their places by their ranks.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm.pieces import ODD, SYMBOLS, Pieces, as_symbols, pieces
from tidemark.llm.text import bare

LIMIT = 2048
#: The id after each document.
END = 0
#: Distinct chunks that a worker remembers before it begins anew, looking up the ones before.
REMEMBERED = 600_000
#: A word before one of these is a pre-token, and so is the mark, at the end of a chunk.
MARKS = frozenset(".,;:!?")
#: Characters of a text that are held as chunks at once.
BLOCK = 1 << 20

Runs = tuple[tuple[int, int], ...]

_BYTES = {s: b for b, s in SYMBOLS.items()}


def _merging(own: Pieces) -> Callable[[str], list[int]]:
    """Merges one pre-token into ids.

    Where tokens are numbered in the order of their merges, and each is the encoding of its own
    string, merging by rank in ``tiktoken`` gives the same ids in half the time.
    """
    tokenize = own.tokenizer.model.tokenize
    singles = {s: i for s, i in own.vocab.items() if s not in own.added}
    order = [own.vocab.get(a + b) for a, b in own.merges]
    if None not in order and order == sorted(order) and all(
        [t.id for t in tokenize(s)] == [i] for s, i in singles.items()
    ):
        ranks = {bytes(_BYTES[c] for c in s): i for s, i in singles.items()}
        whole = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        return whole.encode_ordinary
    return lambda word: [t.id for t in tokenize(as_symbols(word))]


class ChunkIds:
    """Ids of whole texts; the chunks between single spaces are encoded once and remembered.

    A space between two characters that are no white space begins a pre-token, whatever is around
    it, so what lies between two such spaces is encoded alike in every text. Texts with other
    white space around their spaces and line ends are cut by the full pattern.
    """

    def __init__(self, path: str):
        self.own = pieces(path)
        if self.own.suffix:
            raise ValueError("a byte-level vocabulary is needed")
        self.merge = _merging(self.own)
        self.added = {t: i.to_bytes(4, "little") for t, i in self.own.added.items()}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            self.words[word] = ids = array("I", self.merge(word)).tobytes()
        return ids

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self._word, self.own.pre_tokens(text)))

    def _learned(self, chunk: str) -> bytes | None:
        """Encode a chunk behind a space; None if what is around it matters."""
        ids = self.older.get(chunk)
        if ids is None:
            word, mark = chunk[:-1], chunk[-1:]
            if chunk.isalpha():
                ids = array("I", self.merge(" " + chunk)).tobytes()
            elif mark in MARKS and word.isalpha():
                ids = (self.chunks.get(word) or self._learned(word)) + self._word(mark)
            else:
                inner = chunk.removeprefix("\n")
                if not inner or inner != inner.strip():
                    return None
                ids = self._cut(chunk if chunk[0] == "\n" else " " + chunk)
        self.chunks[chunk] = ids
        return ids

    def _block(self, text: str) -> bytes:
        if ODD.search(text):
            return self._cut(text)
        first, *chunks = text.replace("\n", " \n").split(" ")
        if first != first.rstrip():
            return self._cut(text)
        codes = list(map(self.chunks.get, chunks))
        new = codes.count(None)
        at = -1
        for _ in range(new):
            at = codes.index(None, at + 1)
            codes[at] = self._learned(chunks[at])
            if codes[at] is None:
                return self._cut(text)
        return (self._cut(first) if first else b"") + b"".join(codes)

    def _blocks(self, text: str) -> Iterator[str]:
        """The text cut before spaces that begin a pre-token."""
        start = 0
        while len(text) - start > BLOCK:
            cut = text.find(" ", start + BLOCK)
            while 0 <= cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
                cut = text.find(" ", cut + 1)
            if not 0 <= cut < len(text) - 1:
                break
            yield text[start:cut]
            start = cut
        yield text[start:]

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids; added strings become their id, null is empty."""
        if len(self.chunks) > REMEMBERED:
            self.older, self.chunks = self.chunks, {}
        if len(self.words) > REMEMBERED // 6:
            self.words.clear()
        return b"".join(
            self.added[part] if added else b"".join(map(self._block, self._blocks(part)))
            for added, part in self.own.segments(text or "")
        )


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    """One per worker process and file."""
    return ChunkIds(path)


class Plan(NamedTuple):
    """Where the pieces of each length go; the arrays are sorted by ``key``.

    A line holds for ranks from ``key & RANKS`` on among the pieces of length ``key >> 48``:
    ``copies`` of them at a time go to the next sequence from ``base`` on, side by side from
    ``offset``.
    """

    key: np.ndarray
    copies: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int
    fixed: int


RANKS = (1 << 48) - 1


class _Lengths:
    """A multiset of lengths that shrinks."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {n: c for n, c in counts.items() if c}
        self.sizes = sorted(self.counts)

    def take(self, parts: tuple[int, ...]) -> int:
        """Remove the set ``parts`` as often as it is there."""
        times = min(self.counts[n] // parts.count(n) for n in parts)
        for n in parts:
            self.counts[n] -= times
        for n in set(parts):
            if not self.counts[n]:
                del self.counts[n]
                self.sizes.remove(n)
        return times

    def left(self, n: int, without: tuple[int, ...]) -> int:
        return self.counts.get(n, 0) - without.count(n)

    def most(self, room: int, without: tuple[int, ...]) -> int | None:
        """The longest length up to ``room``, not counting the pieces ``without``."""
        at = bisect_right(self.sizes, room) - 1
        while at >= 0 and self.left(self.sizes[at], without) <= 0:
            at -= 1
        return self.sizes[at] if at >= 0 else None

    def least(self, above: int, without: tuple[int, ...], wanted: int) -> list[int]:
        """Up to ``wanted`` of the shortest pieces that are longer than ``above``."""
        found: list[int] = []
        at = bisect_right(self.sizes, above)
        while at < len(self.sizes) and len(found) < wanted:
            n = self.sizes[at]
            found += [n] * min(wanted - len(found), max(0, self.left(n, without)))
            at += 1
        return found


def dominating(lengths: _Lengths, longest: int, limit: int) -> tuple[int, ...] | None:
    """A set with ``longest`` that dominates all others with it, or None if none is proved.

    Set A dominates B if the pieces of B can be laid into those of A: any packing with B then
    turns into one with A that is no larger.
    """
    room, own = limit - longest, (longest,)
    shortest = lengths.least(0, own, 3)
    if not shortest or shortest[0] > room:
        return own
    single = lengths.most(room, own)
    if single == room or sum(shortest[:2]) > room or len(shortest) == 1:
        return (longest, single)  # an exact pair, or only single pieces fit beside
    if len(shortest) == 3 and sum(shortest) <= room:
        return None
    # Two pieces at most fit beside. All single ones lie within the largest, so do pairs whose
    # second lies within the one taken with it, and pairs that are no longer than the largest.
    pair = (longest, single)
    second = lengths.most(room - single, pair)
    longer = lengths.least(second or 0, own, 2)
    if len(longer) == 2 and sum(longer) <= room:
        return None
    return pair if second is None else (*pair, second)


def reduced(lengths: _Lengths, limit: int) -> list[tuple[Runs, int]]:
    """Fix dominating sets, as often as they are there, until none is proved any more."""
    fixed: list[tuple[Runs, int]] = []

    def fix(parts: tuple[int, ...]) -> None:
        times = lengths.take(parts)
        runs = tuple((n, parts.count(n)) for n in sorted(set(parts), reverse=True))
        fixed.append((runs, times))

    for n in [n for n in reversed(lengths.sizes) if 2 * n >= limit]:
        parts = (n, limit - n) if n < limit else (n,)
        if n in lengths.counts and all(lengths.left(m, ()) >= parts.count(m) for m in parts):
            fix(parts)
    shrunk = True
    while shrunk:
        shrunk = False
        for n in list(reversed(lengths.sizes)):
            while n in lengths.counts and (parts := dominating(lengths, n, limit)):
                fix(parts)
                shrunk = True
    return fixed


def best_fit(lengths: _Lengths, limit: int) -> list[tuple[Runs, int]]:
    """Longest first, each piece goes where it leaves the least room; equal ones in one step."""
    done: list[tuple[Runs, int]] = []
    rooms: dict[int, list[tuple[Runs, int]]] = {}
    order: list[int] = []

    def put(runs: Runs, times: int, room: int) -> None:
        if times and not room:
            done.append((runs, times))
        elif times:
            if room not in rooms:
                rooms[room] = []
                order.insert(bisect_left(order, room), room)
            rooms[room].append((runs, times))

    for n in reversed(lengths.sizes):
        left = lengths.counts[n]
        while left:
            at = bisect_left(order, n)
            if at == len(order):
                runs, times, room = (), -(-left // (limit // n)), limit
            else:
                room = order[at]
                runs, times = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[at]
            each = room // n
            whole = min(times, left // each)
            put((*runs, (n, each)), whole, room - each * n)
            left -= whole * each
            times -= whole
            if times and left:
                put((*runs, (n, left)), 1, room - left * n)
                left, times = 0, times - 1
            put(runs, times, room)
    return done + [x for found in rooms.values() for x in found if x[0]]


def plan(counts: dict[int, int], limit: int = LIMIT) -> Plan:
    """A packing of ``counts[length]`` pieces of each length."""
    if any(not 0 < n <= limit for n in counts):
        raise ValueError("lengths must be between 1 and the limit")
    lengths = _Lengths(counts)
    fixed = reduced(lengths, limit)
    patterns = fixed + best_fit(lengths, limit)
    used: dict[int, int] = {}
    lines, base = [], 0
    for runs, times in patterns:
        offset = 0
        for n, copies in runs:
            lines.append(((n << 48) + used.get(n, 0), copies, base, offset))
            used[n] = used.get(n, 0) + copies * times
            offset += n * copies
        base += times
    columns = np.array(sorted(lines), np.int64).reshape(-1, 4).T
    return Plan(*columns, base, sum(t for _, t in fixed))


def _encoded(path: str, limit: int, ids: bool) -> Column:
    """Struct of the length and, per piece, its checksum, number among its likes, and ids."""
    kind = "n long, crc array<long>, nth array<long>, ids array<binary>"

    @F.pandas_udf(kind)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = chunk_ids(path)
        end = END.to_bytes(4, "little")
        seen = np.zeros(limit + 1, np.int64)  # a task's pieces of each length
        for texts in batches:
            rows = []
            for text in texts:
                data = own.ids(text) + end
                n = len(data) // 4
                first = (n - 1) % limit + 1
                cuts = [0, *range(first * 4, len(data) + 1, limit * 4)]
                parts = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                nth = int(seen[first]), *range(int(seen[limit]), int(seen[limit]) + len(parts) - 1)
                if first == limit:
                    nth = tuple(range(nth[0], nth[0] + len(parts)))
                seen[first] += 1
                seen[limit] += len(parts) - 1
                rows.append((n, [zlib.crc32(p) for p in parts], nth, parts if ids else None))
            yield pd.DataFrame(rows, columns=["n", "crc", "nth", "ids"])

    return encode(F.col("text"))


def cut_documents(
    documents: DataFrame, path: str, *, limit: int = LIMIT, ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, nth`` and, if asked for, ``ids``.

    ``nth`` numbers the pieces of one length within ``part``, a task. The first piece takes what
    the others, of ``limit`` tokens each, leave.
    """
    rows = bare(documents).select(
        "doc_id", F.spark_partition_id().alias("part"), _encoded(path, limit, ids).alias("e")
    )
    rows = rows.select("doc_id", "part", F.col("e.n").alias("n"), F.posexplode(
        F.arrays_zip("e.crc", "e.nth", *(["e.ids"] if ids else []))
    ).alias("piece", "p"))
    first = (F.col("n") - 1) % limit + 1
    later = F.col("piece") > 0
    return rows.select(
        "doc_id", "piece",
        F.when(later, first + (F.col("piece") - 1) * limit).otherwise(0).cast("long").alias("start"),
        F.when(later, limit).otherwise(first).cast("long").alias("length"),
        F.col("p.crc").alias("ids_crc32"), "part", F.col("p.nth").alias("nth"),
        *([F.col("p.ids").alias("ids")] if ids else []),
    )


def packed(
    documents: DataFrame, path: str, *, limit: int = LIMIT, ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece of a document.

    A document is its ids and then ``END``; only one of more than ``limit`` tokens is cut. With
    ``ids`` the pieces' ids come along, little-endian unsigned 32-bit. Null and empty texts are
    documents of one token. Every row is a document of its own, so null and repeated ids and
    repeated rows are packed like others; further columns are not read; an empty table gives an
    empty result. Of pieces of one length any may take any of their places.
    """
    rows = written(cut_documents(documents, path, limit=limit, ids=ids))
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per length and task. A length has as many rows as the step before had tasks.
    offsets = written(
        counts.select(
            F.col("length").alias("l"), F.col("part").alias("p"), "n",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        )
    )
    # At most ``limit`` rows reach the driver, and the plan has a few lines for each.
    made = plan({r["l"]: r["n"] for r in offsets.groupBy("l").agg(F.sum("n").alias("n")).collect()}, limit)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        line = np.searchsorted(made.key, (n << 48) + r, side="right") - 1
        nth = r - (made.key[line] & RANKS)
        return pd.DataFrame({
            "sequence_id": made.base[line] + nth // made.copies[line],
            "offset": made.offset[line] + nth % made.copies[line] * n,
        })

    ranked = rows.join(offsets, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p")))
    return ranked.withColumn("at", place(F.col("length"), F.col("first") + F.col("nth"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset",
        *(["ids"] if ids else []),
    )
