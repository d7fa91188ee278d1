"""What a task of the bootstrap does with one bucket of positions.

Positions are those of the rows in the order of falling scores, positives first. A draft counts a
position by a Poisson draw hashed from it and from the block of its replicate, digit for digit as
``functions.draws`` has it in Spark's expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd

#: Kinds of line in the table of a bucket.
PART, SINGLE, OFFSET = 0, 1, 2

TOTALS = "bucket long, edge double, continues boolean, replicate int, n long, pos long"
SUMS = (
    "replicate int, all_pos long, all_n long, average_precision double, roc_auc double,"
    " brier_score double"
)


@dataclass(frozen=True)
class Draw:
    """A bootstrap: rows of the table and of a bucket, replicates, and the cuts of its counts."""

    rows: int
    size: int
    samples: int
    seed: int
    width: int
    cuts: list[int]

    def blocks(self, first: int, until: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first replicate, last + 1, drafted counts of the positions by replicate), by block."""
        heads = [b"%d" % p for p in range(first, until)]
        for block in range(-(-self.samples // self.width)):
            tail = b":%d:%d" % (block, self.seed)
            text = b"".join([sha256(head + tail).digest() for head in heads])
            drawn = np.frombuffer(text, ">u4").astype(np.uint32)
            counts = np.zeros(len(drawn), np.uint8)
            for cut in self.cuts:
                counts += drawn >= np.uint32(cut)
            start = block * self.width
            stop = min(start + self.width, self.samples)
            yield start, stop, counts.reshape(-1, self.width)[:, : stop - start]


@dataclass(frozen=True)
class Parts:
    """The parts of cells that lie in a bucket, by position."""

    bucket: int
    at: np.ndarray
    until: np.ndarray
    ones: np.ndarray
    score: np.ndarray
    continues: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, own: pd.DataFrame) -> Parts:
        own = own.sort_values("at")
        at, until = (own[c].to_numpy(np.int64) for c in ("at", "until"))
        # Positives lie before ``ones``, which may be in another bucket.
        ones = np.clip(own["ones"].to_numpy(np.int64), at, until)
        return cls(
            int(own["bucket"].iloc[0]), at, until, ones, own["score"].to_numpy(float),
            own["continues"].to_numpy(bool), own["ends"].to_numpy(bool),
        )

    def sums(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and positives by part and replicate, from the counts by position."""
        upto = np.zeros((len(counts) + 1, counts.shape[1]), np.int64)
        np.cumsum(counts, axis=0, dtype=np.int64, out=upto[1:])
        start = upto[self.at - self.at[0]]
        return upto[self.until - self.at[0]] - start, upto[self.ones - self.at[0]] - start

    def place(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of each position, and whether it is a positive."""
        part = np.searchsorted(self.at, position, side="right") - 1
        return part, position < self.ones[part]

    def totals(self, replicate: np.ndarray, n: np.ndarray, pos: np.ndarray) -> pd.DataFrame:
        """Sums by replicate of the cells inside, and of each one that goes over an edge."""
        open_ = self.continues | ~self.ends
        lines = []
        for at in [np.flatnonzero(~open_), *([i] for i in np.flatnonzero(open_))]:
            if len(at):
                lines.append(pd.DataFrame({
                    "bucket": self.bucket, "edge": self.score[at[0]] if open_[at[0]] else np.nan,
                    "continues": bool(self.continues[at[0]]), "replicate": replicate,
                    "n": n[at].sum(axis=0), "pos": pos[at].sum(axis=0),
                }))
        return pd.concat(lines)


def drafted(draw: Draw, own: pd.DataFrame) -> pd.DataFrame:
    """Totals of the drafted counts of a bucket."""
    parts = Parts.of(own)
    lines = [
        parts.totals(np.arange(start, stop), *parts.sums(counts))
        for start, stop, counts in draw.blocks(int(parts.at[0]), int(parts.until[-1]))
    ]
    return _nulls(pd.concat(lines))


def single_totals(own: pd.DataFrame, single: pd.DataFrame) -> pd.DataFrame:
    """Totals of the draws that were missing and fell into a bucket."""
    parts = Parts.of(own)
    replicate = np.unique(single["replicate"].to_numpy(np.int64))
    n = np.zeros((len(parts.at), len(replicate)), np.int64)
    pos = np.zeros_like(n)
    if len(replicate):
        part, positive = parts.place(single["position"].to_numpy(np.int64))
        column = np.searchsorted(replicate, single["replicate"].to_numpy(np.int64))
        np.add.at(n, (part, column), 1)
        np.add.at(pos, (part, column), positive.astype(np.int64))
    return _nulls(parts.totals(replicate, n, pos))


def _nulls(lines: pd.DataFrame) -> pd.DataFrame:
    """A missing edge is null, not NaN."""
    return lines.assign(edge=lines["edge"].astype(object).where(lines["edge"].notna(), None))


def metric_sums(draw: Draw, lines: pd.DataFrame) -> pd.DataFrame:
    """A bucket's share of each metric, by replicate.

    A cell counts where it ends, with its parts in earlier buckets.
    """
    parts = Parts.of(lines[lines["kind"] == PART])
    single = lines[lines["kind"] == SINGLE]
    offset = lines[lines["kind"] == OFFSET].sort_values("replicate")
    above = {c: offset[c].to_numpy(np.int64) for c in (
        "before_n", "before_pos", "all_n", "all_pos", "carry_n", "carry_pos"
    )}
    own, position = (single[c].to_numpy(np.int64) for c in ("replicate", "position"))
    part, positive = parts.place(position)
    score, ends = parts.score[parts.ends, None], parts.ends
    found = []
    for start, stop, counts in draw.blocks(int(parts.at[0]), int(parts.until[-1])):
        n, pos = parts.sums(counts)
        mine = (own >= start) & (own < stop)
        np.add.at(n, (part[mine], own[mine] - start), 1)
        np.add.at(pos, (part[mine], own[mine] - start), positive[mine].astype(np.int64))
        at = {c: values[start:stop] for c, values in above.items()}
        cum_n, cum_pos = at["before_n"] + n.cumsum(axis=0), at["before_pos"] + pos.cumsum(axis=0)
        first = parts.continues[:, None]
        n, pos = n + first * at["carry_n"], pos + first * at["carry_pos"]
        n, pos, cum_n, cum_pos = n[ends], pos[ends], cum_n[ends], cum_pos[ends]
        # A cell that no draw fell on adds nothing; before the first draw there are no rows at all.
        precision = cum_pos / np.maximum(cum_n, 1)
        below = (at["all_n"] - at["all_pos"] - cum_n + cum_pos) + (n - pos) / 2.0
        found.append(pd.DataFrame({
            "replicate": np.arange(start, stop, dtype=np.int32),
            "all_pos": at["all_pos"], "all_n": at["all_n"],
            "average_precision": (pos * precision).sum(axis=0),
            "roc_auc": (pos * below).sum(axis=0),
            "brier_score": (pos * (score - 1) ** 2 + (n - pos) * score**2).sum(axis=0),
        }))
    return pd.concat(found)
