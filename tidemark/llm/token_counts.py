"""Token counts with a shortcut for pre-tokens that are one token as a whole.

Before the job, every vocabulary string is encoded alone; those that form one pre-token and give
one token are proved whole. In the tasks a pre-token found among them counts one without any
merging, and only the rest is merged, once per distinct pre-token and worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import SYMBOLS, as_symbols, from_symbols, pieces
from tidemark.llm.text import bare

#: Distinct merged pre-tokens that a worker remembers before it starts afresh.
REMEMBERED = 500_000


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that are one pre-token and encode alone as exactly one token."""
    own = pieces(path)
    spelled = (from_symbols(s) for s in own.vocab if all(c in SYMBOLS.values() for c in s))
    texts = [t for t in spelled if "�" not in t and own.pre_tokens(t) == [t]]
    encoded = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, encoded, strict=True) if len(e.ids) == 1]


class _Counts(dict):
    """Tokens per pre-token: whole ones are given, others are merged when first met."""

    def __init__(self, path: str, whole: tuple[str, ...]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.own = whole, pieces(path)
        self.merge = self.own.tokenizer.model.tokenize

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self.merge(as_symbols(piece)))
        return n

    def tokens(self, text: str | None) -> int:
        if len(self) > len(self.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        total = 0
        for added, part in self.own.segments(text or ""):
            total += 1 if added else sum(map(self.__getitem__, self.own.pre_tokens(part)))
        return total


@lru_cache(maxsize=2)
def _counts(path: str, whole: tuple[str, ...]) -> _Counts:
    return _Counts(path, whole)


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text column as the ``tokenizers`` file at ``path`` counts them; null: 0."""
    whole = tuple(whole_tokens(path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = _counts(path, whole)
        for texts in batches:
            yield pd.Series([counts.tokens(t) for t in texts], dtype="int64")

    return count(text)


def token_counts(documents: DataFrame, path: str, *, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document.

    Null and empty texts have no bytes and no tokens. Every row is answered by itself, so null
    and repeated ids, repeated rows and further columns change nothing; an empty table gives an
    empty result. Strings of added tokens inside a text count as one token, as is the default of
    the library.
    """
    return bare(documents).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col("text"), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
