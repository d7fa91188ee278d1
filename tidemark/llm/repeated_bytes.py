"""Byte strings that occur earlier, by prefix doubling over sparse suffix positions.

Positions are ranked by growing prefixes: ``SEED`` bytes first, then all bytes that windows around
the position reach. Not every byte is a position. A window of ``LENGTH`` bytes is represented by
the least of the hashed ``SEED``-byte strings in it, so equal windows have the same representative
at the same place, and successive windows that share one form a region of ``LENGTH`` bytes or more.

1. Rank by ``SEED`` bytes: Spark counts the seeds; positions with a unique seed drop out.
2. Rank by region: positions left are grouped by seed and region; whatever is not the first of its
   group has occurred before as a whole.
3. Where one seed has several regions, windows are ranked by their ``LENGTH`` bytes, which is past
   the threshold, so the doubling ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm import repeats
from tidemark.llm.repeats import ROW

LENGTH = 100
SEED = 28

_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8"), np.uint8)


def _of_bytes(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def _numbers(text: str | None) -> np.ndarray:
    return _of_bytes(_bytes(text))


KIND = repeats.Kind(
    length=LENGTH, seed=SEED, numbers=_numbers, within=True, units=_bytes, of_units=_of_bytes
)


def _seed_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = [s for t in batch["text"] for s, *_ in repeats.positions(_numbers(t), KIND)]
        seeds, n = np.unique(np.concatenate(parts), return_counts=True) if parts else ([], [])
        yield pd.DataFrame({"seed": seeds, "n": n})


def _positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for i in range(0, len(batch), 500):
            part = batch.iloc[i : i + 500]
            yield repeats.rows_of(
                [
                    (o, v, seed, repeats.packed(*where))
                    for o, v, t in zip(part["o"], part["v"], part["text"], strict=True)
                    for seed, *where in repeats.positions(_numbers(t), KIND)
                ],
                ["seed", "at"],
            )


def _regions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Seed and region ranks of the positions that are left."""
    for batch in batches:
        yield repeats.rows_of(
            [
                (o, v, *ranks)
                for o, v, t, ats in zip(batch["o"], batch["v"], batch["text"], batch["ats"], strict=True)
                for ranks in repeats.region_ranks(_numbers(t), np.asarray(ats, np.int64), KIND)
            ],
            ["seed", "region", "at"],
        )


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
            data = _bytes(text)
            lost = repeats.gone(spans, len(data), LENGTH)
            runs = int((np.diff(np.concatenate([[False], lost]).astype(np.int8)) == 1).sum())
            out.append((doc, len(data), int(lost.sum()), runs, data[~lost].tobytes()))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype(
            {"doc_id": "Int64"}
        )


def removed_bytes(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Every byte goes that lies in a string of ``LENGTH`` bytes which also starts earlier: in a
    document with a smaller id, or before in the same one. Overlaps count, and strings are judged
    on the input. Texts are taken as UTF-8; null and empty ones have no bytes. Null ids come after
    all others. Rows that share an id and the text are one document and answered alike; rows that
    share only the id are ordered by a hash of their text. An empty table gives an empty result;
    further columns are not read.
    """
    own = repeats.texts_of(documents)
    common = own.select("text").mapInPandas(_seed_counts, "seed long, n long")
    common = common.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
    left = own.select("o", "v", "text").mapInPandas(_positions, f"{ROW}seed long, at long")
    places = repeats.by_text(left.join(common, "seed", "left_semi"), "at")
    joined = written(
        own.join(places, ["o", "v"], "left").select(
            "doc_id", "o", "v", "ats", F.when(F.col("ats").isNotNull(), F.col("text")).alias("text"),
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
            F.when(F.col("ats").isNull(), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("sha"),
        ),
        drop_shuffles=True,
    )
    # No order and no hash is null. Saying so, as the joins do, lets them share one shuffle of the texts.
    texts = joined.where("ats IS NOT NULL AND o IS NOT NULL AND v IS NOT NULL")
    dealt = texts.select("doc_id", "o", "v", "text").repartition("o", "v")
    regions = texts.select("o", "v", "text", "ats").mapInPandas(
        _regions, f"{ROW}seed long, region long, at long"
    )
    spans = repeats.repeated_spans(dealt, written(regions), KIND)
    some = dealt.join(spans, ["o", "v"], "left")
    done = some.select("doc_id", "text", "spans").mapInPandas(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    counts = ["doc_id", "n_bytes", "n_removed", "n_spans"]
    none = F.lit(0).cast("long")
    return done.select(*counts, F.sha2("kept", 256).alias("kept_sha256")).unionByName(
        joined.where("ats IS NULL").select(
            "doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"),
            F.col("sha").alias("kept_sha256"),
        )
    )
