"""Windows of a text that occur earlier in the corpus, ranked by growing prefixes.

The units of a text are numbers: one per byte, or one per word. A *region* is a run of successive
windows that hold the same *seed*, a shorter string, at the same place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm.text import bare
from tidemark.llm.word_hash import mixed

#: Windows of one text that are ranked at once; longer texts go in pieces that overlap.
PIECE = 1 << 20
#: Regions compared at once. A seed with more than half as many goes by rows of windows instead.
TOGETHER = 4000

_BASE = 0x9E3779B97F4A7C15
_ROOM = PIECE + 256


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.full(_ROOM, base, np.uint64)) * np.uint64(pow(base, -1, 1 << 64))


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


@dataclass(frozen=True)
class Kind:
    """What a window is: its size, the size of a seed, and the numbers of a text.

    Where a text has ``units`` that are smaller than their numbers, regions travel as those, and
    ``of_units`` gives the numbers.
    With ``within`` a window may have started earlier in the same document, else the earlier
    document must have a smaller id.
    """

    length: int
    seed: int
    numbers: Callable[[str | None], np.ndarray]
    within: bool
    units: Callable[[str | None], np.ndarray] | None = None
    of_units: Callable[[np.ndarray], np.ndarray] | None = None

    def sent(self, text: str | None) -> np.ndarray:
        """What regions of a text travel as."""
        return self.numbers(text) if self.units is None else self.units(text)

    def received(self, data: bytes) -> np.ndarray:
        """The numbers of what was sent."""
        if self.units is None:
            return np.frombuffer(data, np.uint64)
        return self.of_units(np.frombuffer(data, self.units(None).dtype))


def running_sums(values: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any range; see ``ranges``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _UP[: len(values)], out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each range of numbers, from ``start`` to before ``end``."""
    return mixed((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64))


def all_ranges(sums: np.ndarray, size: int) -> np.ndarray:
    """A hash of every range of ``size`` numbers."""
    n = max(len(sums) - size, 0)
    return mixed((sums[size:] - sums[:n]) * _DOWN[:n] + np.uint64(size))


def least_places(order: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` successive numbers."""
    n = len(order) - span + 1
    blocks = -(-len(order) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(order)] = order
    grid = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[span - 1 : span - 1 + n])


def runs_of(grams: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, and place of the representative, of windows that share one."""
    low = np.uint64((1 << 24) - 1)
    order = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    place = (least_places(order, span) & low).astype(np.int64)
    cuts = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate([[0], cuts])
    return first, np.concatenate([cuts - 1, [len(place) - 1]]), place[first]


def positions(data: np.ndarray, kind: Kind) -> Iterator[tuple[np.ndarray, ...]]:
    """``seed, first, last, place`` of the regions of a text, in pieces."""
    for begin in range(0, len(data) - kind.length + 1, PIECE):
        seeds = all_ranges(running_sums(data[begin : begin + PIECE + kind.length - 1]), kind.seed)
        first, last, place = runs_of(seeds, kind.length - kind.seed + 1)
        yield seeds[place].view(np.int64), first + begin, last + begin, place + begin


def packed(first, last, place) -> np.ndarray:
    """Place and extent of a region in one number."""
    return (first << 16) | ((last - first) << 8) | (place - first)


def region_ranks(data: np.ndarray, at: np.ndarray, kind: Kind) -> Iterator[tuple[np.ndarray, ...]]:
    """``seed, region, at`` of regions of a text, which do not leave their piece."""
    first, size, shift = at >> 16, (at >> 8) & 255, at & 255
    for begin in range(0, len(data), PIECE):
        own = (first >= begin) & (first < begin + PIECE)
        if own.any():
            sums = running_sums(data[begin : begin + _ROOM])
            start = first[own] - begin
            place = start + shift[own]
            region = ranges(sums, start, start + size[own] + kind.length)
            yield (
                ranges(sums, place, place + kind.seed).view(np.int64),
                (region + mixed(shift[own].astype(np.uint64))).view(np.int64), at[own],
            )


def rows_of(found: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows from (o, v, array, ...) tuples whose arrays have one size each."""
    sizes = [len(x[2]) for x in found]
    columns = {n: np.repeat(np.array([x[i] for x in found], np.int64), sizes) for i, n in enumerate("ov")}
    for i, n in enumerate(names, 2):
        columns[n] = np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64)
    return pd.DataFrame(columns)


ROW = "o long, v long, "


def _functions(kind: Kind) -> dict[str, Callable]:
    """The functions that run in tasks."""

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The units of regions."""
        for batch in batches:
            out = []
            for o, v, text, ats in zip(batch["o"], batch["v"], batch["text"], batch["ats"], strict=True):
                data = kind.sent(text)
                for own in ats:
                    first, size = own["at"] >> 16, (own["at"] >> 8) & 255
                    part = data[first : first + size + kind.length]
                    out.append((own["seed"], o, v, own["at"], part.tobytes()))
            yield pd.DataFrame(out, columns=["seed", "o", "v", "at", "data"])

    def repeats(rows: pd.DataFrame) -> pd.DataFrame:
        """Windows that an earlier row has too, as spans; rows are in order of position."""
        data = [kind.received(x) for x in rows["data"]]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        counts = sizes - kind.length + 1
        begin = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(data)), counts)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = begin[row] + inside
        rank = ranges(running_sums(np.concatenate(data)), start, start + kind.length)
        _, least, of_rank = np.unique(rank, return_index=True, return_inverse=True)
        if kind.within:
            hit = np.ones(len(rank), bool)
            hit[least] = False
        else:
            ids = rows["o"].to_numpy()[row]
            hit = ids > ids[least][of_rank]
        at = np.flatnonzero(hit)
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(row[at]) != 0)
        heads = np.flatnonzero(new)
        lengths = np.diff(np.concatenate([heads, [len(at)]]))
        of = row[at[heads]]
        first = (rows["at"].to_numpy() >> 16)[of] + inside[at[heads]]
        return pd.DataFrame(
            {"o": rows["o"].to_numpy()[of], "v": rows["v"].to_numpy()[of], "span": (first << 8) | (lengths - 1)}
        )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by seed; those of one seed are compared together."""
        waiting = pd.DataFrame()
        for batch in batches:
            for i in range(0, len(batch), TOGETHER // 2):
                rows = pd.concat([waiting, batch.iloc[i : i + TOGETHER // 2]], ignore_index=True)
                whole = int(np.searchsorted(rows["seed"].to_numpy(), rows["seed"].iat[-1]))
                waiting = rows.iloc[whole:]
                if whole:
                    yield repeats(rows.iloc[:whole])
        if len(waiting):
            yield repeats(waiting)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every window of the regions of a text, ranked by its numbers."""
        for batch in batches:
            out = []
            for o, v, text, ats in zip(batch["o"], batch["v"], batch["text"], batch["ats"], strict=True):
                data, at = kind.numbers(text), np.unique(np.asarray(ats, np.int64))
                first, size = at >> 16, (at >> 8) & 255
                starts = np.unique(
                    np.concatenate([np.arange(f, f + n + 1) for f, n in zip(first, size, strict=True)])
                )
                for begin in range(0, len(data), PIECE):
                    own = starts[(starts >= begin) & (starts < begin + PIECE)]
                    if len(own):
                        sums = running_sums(data[begin : begin + _ROOM])
                        place = own - begin
                        rank = ranges(sums, place, place + kind.length)
                        head = ranges(sums, place, place + kind.seed)
                        out.append((o, v, rank.view(np.int64), head.view(np.int64), own))
            yield rows_of(out, ["rank", "head", "start"])

    return {"contents": contents, "compare": compare, "windows": windows}


def by_text(rows: DataFrame, *columns: str) -> DataFrame:
    """``o, v, ats``: what rows say of each text."""
    what = F.struct(*columns) if len(columns) > 1 else F.col(columns[0])
    return rows.groupBy("o", "v").agg(F.collect_set(what).alias("ats"))


def repeated_spans(texts: DataFrame, regions: DataFrame, kind: Kind) -> DataFrame:
    """``o, v, span`` of the windows that start earlier: first window << 8 | further windows.

    ``texts`` has ``o, v, text`` (where it is dealt by ``o, v``, it is not dealt again, and all its
    columns go along so that a caller can share that) and ``regions`` has ``o, v, seed, region, at``. A region that is
    not the first of its rank has occurred as a whole. Of the first ones, those that share their
    seed with other regions are compared by windows.
    """
    run = _functions(kind)
    place = F.struct("o", "v", "at") if kind.within else F.struct("o")
    firsts = regions.groupBy(F.col("seed").alias("s"), F.col("region").alias("r")).agg(F.min(place).alias("f"))
    marked = written(
        regions.join(firsts, (F.col("seed") == F.col("s")) & (F.col("region") == F.col("r"))).select(
            "o", "v", "seed", "region", "at", (place > F.col("f")).alias("again")
        ),
        drop_shuffles=True,
    )
    first, size = F.shiftright("at", 16), F.shiftright("at", 8).bitwiseAND(F.lit(255))
    whole = marked.where("again").select("o", "v", (F.shiftleft(first, 8) + size).alias("span"))

    fresh = marked.where("NOT again")
    several = fresh.groupBy(F.col("seed").alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.min("region").alias("low"), F.max("region").alias("high")
    ).where("low < high")
    edges = written(fresh.join(several, F.col("seed") == F.col("s")).select("seed", "o", "v", "at", "n"), drop_shuffles=True)
    few, many = edges.where(F.col("n") <= TOGETHER // 2), edges.where(F.col("n") > TOGETHER // 2)
    single = texts.dropDuplicates(["o", "v"])
    near = (
        single.join(by_text(few, "seed", "at"), ["o", "v"])
        .mapInPandas(run["contents"], f"seed long, {ROW}at long, data binary")
        .repartition("seed").sortWithinPartitions("seed", "o", "v", "at")
        .mapInPandas(run["compare"], f"{ROW}span long")
    )
    windows = written(
        single.join(by_text(many, "at"), ["o", "v"])
        .mapInPandas(run["windows"], f"{ROW}rank long, head long, start long"),
        drop_shuffles=True,
    )
    start = F.struct("o", "v", "start") if kind.within else F.struct("o")
    least = windows.groupBy(F.col("rank").alias("r"), F.col("head").alias("h")).agg(F.min(start).alias("first"))
    far = windows.join(least, (F.col("rank") == F.col("r")) & (F.col("head") == F.col("h"))).where(
        start > F.col("first")
    )
    spans = whole.unionByName(near).unionByName(far.select("o", "v", F.shiftleft("start", 8).alias("span")))
    return by_text(spans, "span").withColumnRenamed("ats", "spans")


def gone(spans: np.ndarray | None, size: int, length: int) -> np.ndarray:
    """Which units of a text of ``size`` units the spans cover."""
    edge = np.zeros(size + 1, np.int64)
    if spans is not None and len(spans):
        one = np.asarray(spans, np.int64)
        np.add.at(edge, one >> 8, 1)
        np.add.at(edge, (one >> 8) + (one & 255) + length, -1)
    return np.cumsum(edge[:-1]) > 0


def texts_of(documents: DataFrame) -> DataFrame:
    """``doc_id, text, o, v``: ``o`` orders documents, nulls last; ``v`` tells texts of one id apart.

    ``v`` is the first 64 bits of the SHA-256 of the text, with null as the empty text.
    """
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    return bare(documents).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("o"),
        F.conv(F.substring(digest, 1, 16), 16, -10).cast("long").alias("v"),
    )
