"""Language of every text, and spans of languages in mixed ones.

The script of a word (its Unicode range) narrows the candidate languages. Every word has a score
per candidate from hashed letter trigrams, and a Viterbi path with a penalty per switch labels the
words of a text; runs of equal labels are its spans. The model is fitted on a bounded sample of
labelled texts, in two rounds: the second leaves out texts that the first contradicts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm.text import bare

UNKNOWN = "und"
#: Labelled texts per language, about, that the model is fitted on.
SAMPLE = 2000
#: Hashed trigrams; also what the model's size is bounded by, times the languages.
BUCKETS = 1 << 15
#: Log-likelihood that a switch of language costs.
SWITCH = 12.0
#: Distinct words that a worker remembers before it starts afresh.
REMEMBERED = 400_000

#: Distinct words of a task that wait to be counted by their trigrams.
DISTINCT = 200_000

# First letters of Unicode blocks and the script that begins there.
_BLOCKS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"),
    (0x0F00, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "han"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"),
)
_STARTS = [b for b, _ in _BLOCKS]
_WORD = re.compile(r"[^\W\d_]+")


def script(word: str) -> str:
    """The script of the first letter."""
    return _BLOCKS[bisect_right(_STARTS, ord(word[0])) - 1][1]


@lru_cache(maxsize=1 << 15)
def _bucket(trigram: str) -> int:
    return xxhash.xxh32_intdigest(trigram) % BUCKETS


def _trigrams(word: str) -> list[int]:
    marked = f"^{word.lower()}$"
    return [_bucket(marked[i : i + 3]) for i in range(max(1, len(marked) - 2))]


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # log-probability per language and bucket
    scripts: dict[str, np.ndarray]  # script to mask over languages


class _Scorer:
    """Scores per word, remembered, and Viterbi over batches of texts."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages)), np.float32)
        # The scores of one trigram at a time, per language: a word adds a few rows.
        self.rows = np.ascontiguousarray(model.weights.T)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Rows of the table for words; new ones are scored together."""
        found = list(map(self.number.get, words))
        if None in found:
            self._add(list(dict.fromkeys(w for w, n in zip(words, found, strict=True) if n is None)))
            found = list(map(self.number.__getitem__, words))
        return np.array(found, np.int32)

    def _add(self, words: list[str]) -> None:
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words)), strict=True))
        while len(self.number) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for k in range(0, len(words), 10_000):
            some = words[k : k + 10_000]
            grams = [_trigrams(w) for w in some]
            starts = np.cumsum([0, *map(len, grams[:-1])])
            rows = self.rows[np.fromiter((g for own in grams for g in own), np.int32)]
            score = np.add.reduceat(rows, starts, axis=0)
            for name in set(kinds := [script(w) for w in some]):
                mask = self.model.scripts.get(name)
                if mask is not None and not mask.all():
                    own = np.array([kind == name for kind in kinds])
                    low = score[own].min(axis=1, keepdims=True) - SWITCH
                    score[own] = np.where(mask, score[own], low)
            self.table[first + k : first + k + len(some)] = score

    def labels(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The language number of each word of each text.

        If in no run of words any language gains half a switch over the one that is best for the
        whole text, no path with switches is better than staying with that one. Viterbi is for
        the other texts.
        """
        if len(self.number) > REMEMBERED:
            self.number.clear()
        ids = self.numbers([w for words in texts for w in words])
        ends = np.cumsum([0, *map(len, texts)])
        out: list[np.ndarray | None] = []
        for a, b in zip(ends, ends[1:], strict=False):
            out.append(self._constant(self.table[ids[a:b]]) if b > a else np.zeros(0, np.int32))
        mixed = [i for i, path in enumerate(out) if path is None]
        for i, path in zip(mixed, self._viterbi([ids[ends[i] : ends[i + 1]] for i in mixed]), strict=True):
            out[i] = path
        return out

    def _constant(self, scores: np.ndarray) -> np.ndarray | None:
        best = int(scores.sum(axis=0, dtype=np.float64).argmax())
        gain = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
        # The largest gain of a run: the sum at its end less the least sum before it.
        low = np.minimum.accumulate(gain, axis=0)
        most = max(float(gain.max()), float((gain[1:] - np.minimum(low[:-1], 0)).max(initial=0.0)))
        return np.full(len(scores), best, np.int32) if most < SWITCH / 2 else None

    def _viterbi(self, flat: list[np.ndarray]) -> list[np.ndarray]:
        """Best paths of texts given as rows of the table, all texts step by step together."""
        sizes = np.array([len(f) for f in flat], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes, kinds = sizes[order], len(self.model.languages)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        ids = np.concatenate([flat[i] for i in order]) if len(sizes) else np.zeros(0, np.int32)
        stay = np.zeros((len(ids), kinds), bool)
        came = np.zeros(len(ids), np.int32)
        value = np.zeros((len(sizes), kinds), np.float32)
        live = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
        for t, n in enumerate(live):
            at = starts[:n] + t
            v = value[:n]
            if t:
                best = v.max(axis=1, keepdims=True) - SWITCH
                came[at] = v.argmax(axis=1)
                stay[at] = v >= best
                np.maximum(v, best, out=v)
                # Only differences matter; small numbers keep their precision.
                v -= v.max(axis=1, keepdims=True)
            v += self.table[ids[at]]
        path = np.zeros(len(ids), np.int32)
        now = value.argmax(axis=1).astype(np.int32) if len(sizes) else np.zeros(0, np.int32)
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            at = starts[:n] + t
            path[at] = now[:n]
            keep = stay[at, now[:n]] if t else True
            now[:n] = np.where(keep, now[:n], came[at])
        out: list = [None] * len(order)
        for k, i in enumerate(order):
            out[i] = path[starts[k] : starts[k] + sizes[k]]
        return out


def _batches(texts: Iterator[str], words: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Texts with their words, together until they have ``words`` of them."""
    held, size = [], 0
    for text in texts:
        cut = _WORD.findall(text)
        held.append((text, cut))
        size += len(cut) + 1
        if size >= words:
            yield held
            held, size = [], 0
    if held:
        yield held


def _chosen(words: list[str], path: np.ndarray, kinds: int) -> tuple[int, float]:
    """The language with most letters, and its share of all letters."""
    letters = np.bincount(path, np.fromiter(map(len, words), float, len(words)), kinds)
    best = int(letters.argmax())
    return best, float(letters[best] / letters.sum())


def _spans(words: list[tuple[int, int]], path: np.ndarray, names: list[str]) -> list[dict]:
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return [
        {"start": words[a][0], "end": words[b - 1][1], "lang": names[path[a]]}
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]


def predicted(text: Column, model: LanguageModel, *, spans: bool = False, words: int = 200_000) -> Column:
    """Struct of ``lang`` and ``score``; with ``spans`` also (start, end, lang) in code points.

    ``lang`` has most letters of the labelled words and ``score`` is its share of them. Texts
    without a letter, empty and null texts are ``und`` with score 0 and have no spans. Ties go to
    the language that sorts first. ``words`` bounds the words that a worker holds at once, but for
    those of one text.
    """
    fields = "lang string, score double"
    if spans:
        fields += ", spans array<struct<start: int, end: int, lang: string>>"

    @F.pandas_udf(fields)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer, names = _Scorer(model), model.languages
        for texts in batches:
            out = []
            for held in _batches((t or "" for t in texts), words):
                paths = scorer.labels([cut for _, cut in held]) if names else [()] * len(held)
                for (text_, cut), path in zip(held, paths, strict=True):
                    if not cut or not names:
                        row = [UNKNOWN, 0.0, []]
                    else:
                        best, share = _chosen(cut, path, len(names))
                        row = [names[best], share, []]
                        if spans:
                            places = [m.span() for m in _WORD.finditer(text_)]
                            row[2] = _spans(places, path, names)
                    out.append(row if spans else row[:2])
            yield pd.DataFrame(out, columns=["lang", "score", "spans"][: 2 + spans])

    return predict(text)


def fit(documents: DataFrame, learn: Column, *, per_language: int = SAMPLE) -> LanguageModel:
    """Fit on about ``per_language`` documents of each non-null ``lang`` among those of ``learn``.

    The rows are those whose hashed id falls below a cut per language, so the sample is bounded,
    and the same at every partitioning. Without rows the model has no languages.
    """
    key = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 40) - 1))
    rows = documents.where(learn).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(counts)
    if not names:
        return LanguageModel([], np.zeros((0, BUCKETS), np.float32), {})
    cut = F.create_map(
        *[x for k in names for x in (F.lit(k), F.lit(int(min(1.0, per_language / counts[k]) * (1 << 40))))]
    )
    sample = written(rows.where(key < F.element_at(cut, F.col("lang"))).select("text", "lang"))
    first = _counted(sample, names)
    kept = sample.withColumn("guess", predicted(F.col("text"), first)).where("guess.lang = lang")
    # Written, so that no task needs two Python workers at once.
    return _counted(written(kept.select("text", "lang")), names)


def _counted(sample: DataFrame, names: list[str]) -> LanguageModel:
    place = {n: i for i, n in enumerate(names)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = np.zeros((len(names), BUCKETS), np.int64)
        scripts: dict[tuple[int, str], int] = {}
        words: Counter[tuple[int, str]] = Counter()

        def fold() -> None:
            for (k, word), n in words.items():
                np.add.at(grams[k], _trigrams(word), n)
                seen = (k, script(word))
                scripts[seen] = scripts.get(seen, 0) + n
            words.clear()

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                own = Counter(_WORD.findall(text))
                words.update({(place[lang], w): n for w, n in own.items()})
                if len(words) > DISTINCT:
                    fold()
        fold()
        at = np.nonzero(grams)
        rows = [(int(a), int(b), "", int(grams[a, b])) for a, b in zip(*at, strict=True)]
        rows += [(a, -1, b, n) for (a, b), n in scripts.items()]
        yield pd.DataFrame(rows, columns=["lang", "bucket", "script", "n"])

    schema = "lang int, bucket int, script string, n long"
    sums = sample.mapInPandas(count, schema).groupBy("lang", "bucket", "script").agg(F.sum("n").alias("n"))
    table = sums.toPandas()  # bounded by languages x (buckets + scripts)
    grams = np.full((len(names), BUCKETS), 0.5)
    own = table[table["bucket"] >= 0]
    grams[own["lang"], own["bucket"]] += own["n"]
    weights = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    words = table[table["bucket"] < 0].pivot_table(index="script", columns="lang", values="n", fill_value=0)
    words = words.reindex(columns=range(len(names)), fill_value=0)
    share = words / words.sum(axis=0).clip(lower=1)
    scripts = {s: (share.loc[s] >= 0.01).to_numpy() for s in share.index}
    return LanguageModel(names, weights, {s: m for s, m in scripts.items() if m.any()})


def languages(documents: DataFrame, model: LanguageModel, *, spans: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` per document, and ``spans`` on demand; see ``predicted``.

    Every row is answered by itself, so null and repeated ids, repeated rows and further columns
    change nothing. An empty table gives an empty result.
    """
    rows = bare(documents).select("doc_id", predicted(F.col("text"), model, spans=spans).alias("p"))
    own = ["doc_id", F.col("p.lang").alias("lang_pred"), "p.score"]
    return rows.select(*own, *(["p.spans"] if spans else []))
