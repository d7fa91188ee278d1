"""Quality by votes of the nearest labelled texts in a latent semantic space.

A text is a bag of terms: hashed words, word shapes (runs of upper and lower case, digits and each
symbol), adjacent shapes and repeats of the word before. Terms are weighted and projected on the
leading singular vectors of the labelled sample. The sample's vectors are broadcast; every text is
compared with all of them by blocked products, and the nearest vote with their similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import bare

#: Labelled texts, about, that are compared with: the bound of what is collected and broadcast.
SAMPLE = 3000
WORDS, SHAPES = 512, 512
TERMS = WORDS + SHAPES + 2
DIMENSIONS = 48
NEIGHBOURS = 25
REMEMBERED = 400_000

_RUNS = re.compile(r"[a-zß-ÿ]+|[A-ZÀ-Þ]+|[0-9]+|(.)\1*", re.DOTALL)


def _shape(word: str) -> str:
    out = []
    for run in _RUNS.finditer(word):
        c = run.group()[0]
        out.append("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c)
        if len(out) == 8:
            break
    return "".join(out)


class _Places(dict):
    """Two term numbers per word, in one integer: its own and its shape's."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        own = xxhash.xxh32_intdigest(word.lower()) % WORDS
        shape = WORDS + xxhash.xxh32_intdigest(_shape(word)) % SHAPES
        self[word] = place = own * TERMS + shape
        return place


def term_weights(texts: list[str], places: _Places) -> np.ndarray:
    """Square roots of the share of each term, so that long and short texts compare."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for row, text in zip(out, texts, strict=True):
        words = text.split()
        if not words:
            continue
        both = np.array(list(map(places.__getitem__, words)), np.int64)
        row[: WORDS] = np.bincount(both // TERMS, minlength=WORDS)[:WORDS] * 0.25
        row[WORDS : WORDS + SHAPES] = np.bincount(both % TERMS, minlength=TERMS)[WORDS : WORDS + SHAPES]
        repeats = int((both[1:] == both[:-1]).sum()) if len(both) > 1 else 0
        row[-2], row[-1] = repeats, len(words) - repeats
        row /= len(words)
    return np.sqrt(out)


@dataclass
class Votes:
    mean: np.ndarray
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled texts x dimensions, of length one
    labels: np.ndarray
    share: float

    def project(self, weights: np.ndarray) -> np.ndarray:
        v = (weights - self.mean) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, weights: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled texts, weighted by their similarity."""
        if not len(self.labels):
            return np.full(len(weights), self.share)
        k = min(NEIGHBOURS, len(self.labels))
        like = self.project(weights) @ self.vectors.T
        near = np.argpartition(-like, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(like, near, axis=1), 0, 1) ** 4
        total = weight.sum(axis=1)
        score = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-9)
        return np.where(total > 0, score, self.share)


def _constant(share: float) -> Votes:
    none = np.zeros((0, DIMENSIONS), np.float32)
    axes = np.zeros((TERMS, DIMENSIONS), np.float32)
    return Votes(np.zeros(TERMS, np.float32), axes, none, none[:, 0], share)


def fit(documents: DataFrame, labels: DataFrame, learn: Column, *, sample: int = SAMPLE) -> Votes:
    """Fit on about ``sample`` documents, half of each ``quality``, among those ``learn`` allows.

    ``learn`` is a condition on ``labels``. The rows are those whose hashed id falls below a cut
    per label, so the sample is bounded, and the same at every partitioning. Null and other labels
    are left out; a document with several labels counts with each. Without rows scores are 0.5.
    """
    rows = labels.where(learn).where("quality IN (0, 1)").select(
        F.col("doc_id").alias("l"), F.col("quality").cast("int").alias("label")
    )
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return _constant(0.5)
    key = F.xxhash64("l").bitwiseAND(F.lit((1 << 40) - 1))
    cuts = {k: int(min(1.0, sample / 2 / n) * (1 << 40)) for k, n in counts.items()}
    chosen = rows.where(
        F.when(F.col("label") == 0, key < cuts.get(0, 0)).otherwise(key < cuts.get(1, 0))
    )
    picked = bare(documents).join(F.broadcast(chosen), F.col("doc_id") == F.col("l")).select(
        F.coalesce("text", F.lit("")).alias("text"), "label"
    )

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = _Places()
        for batch in batches:
            weights = term_weights(list(batch["text"]), places)
            yield pd.DataFrame({"label": batch["label"], "w": [w.tobytes() for w in weights]})

    table = picked.mapInPandas(vectors, "label int, w binary").toPandas()  # about `sample` rows
    share = counts.get(1, 0) / sum(counts.values())
    if not len(table):
        return _constant(share)
    table = table.sort_values(["label", "w"])
    weights = np.frombuffer(b"".join(table["w"]), np.float32).reshape(-1, TERMS)
    labels = table["label"].to_numpy(np.float32)
    mean = weights.mean(axis=0)
    centred = weights - mean
    _, vectors_ = np.linalg.eigh(centred.T @ centred)
    axes = np.ascontiguousarray(vectors_[:, ::-1][:, :DIMENSIONS], dtype=np.float32)
    model = Votes(mean, axes, np.zeros((0, DIMENSIONS), np.float32), labels, share)
    model.vectors = model.project(weights).astype(np.float32)
    return model


def quality(text: Column, model: Votes, *, rows: int = 1000) -> Column:
    """Score from 0 to 1 of a text column; null and empty texts are scored as texts without terms."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places = _Places()
        for texts in batches:
            own = [t or "" for t in texts]
            parts = [
                model.score(term_weights(own[i : i + rows], places)) for i in range(0, len(own), rows)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0), dtype="float64")

    return score(text)


def quality_scores(
    documents: DataFrame, labels: DataFrame, learn: Column, *, threshold: float = 0.3
) -> DataFrame:
    """``doc_id, score, predicted`` per document; ``predicted`` is 1 from ``threshold`` on.

    Every row is answered by itself, so null and repeated ids, repeated rows and further columns
    change nothing. Empty and null texts share one score. An empty table gives an empty result.
    """
    model = fit(documents, labels, learn)
    rows = bare(documents).select("doc_id", quality(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
