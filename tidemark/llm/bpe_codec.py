"""BPE encoding and decoding in which words share the encodings of their prefixes.

For every prefix of a word exactly one last token is right: the token ``t`` that ends there, is
its own encoding, and may follow the last token of what precedes it. Two tokens may follow each
other when the pair, joined, encodes as these two. So a prefix is encoded by its last token and
the encoding of a shorter prefix. The distinct new words of a batch are visited in the depth-first
order of their trie (their sorted order), and the state of each shared prefix is computed once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import ODD, Pieces, as_symbols, pieces
from tidemark.llm.text import bare

#: Distinct chunks, and pairs of tokens, that a worker remembers before it starts afresh.
REMEMBERED = 600_000

FIELDS = "n_tokens long, ids binary, decoded string"


class PrefixCodec:
    """Encodes distinct words of a vocabulary whose tokens at word ends have a suffix."""

    def __init__(self, own: Pieces):
        self.own = own
        self.end = own.suffix
        self.rank = {tuple(m): i for i, m in enumerate(own.merges)}
        self.pairs: dict[tuple[str, str, bool], bool] = {}
        self.remembered = REMEMBERED
        # Tokens that merging cannot reach from their own symbols are never the right ones.
        codes = {t: i.to_bytes(4, "little") for t, i in own.vocab.items() if self._merged(t) == [t]}
        self.inner = {t: c for t, c in codes.items() if not self._ends(t)}
        self.last = {t.removesuffix(self.end): c for t, c in codes.items() if self._ends(t)}

    def _ends(self, token: str) -> bool:
        return bool(self.end) and token.endswith(self.end) and token != self.end

    def _merged(self, spelled: str) -> list[str]:
        """Merge by rank from single symbols; the last symbol carries the word end."""
        if self._ends(spelled):
            symbols = [*spelled[: -len(self.end)]]
            symbols[-1] += self.end
        else:
            symbols = [*spelled]
        none = len(self.rank)
        while len(symbols) > 1:
            ranks = [self.rank.get(p, none) for p in zip(symbols, symbols[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            joined, i = [], 0
            while i < len(symbols):
                if i < len(ranks) and ranks[i] == best:
                    joined.append(symbols[i] + symbols[i + 1])
                    i += 2
                    # A pair that overlaps the one just merged is no longer there.
                else:
                    joined.append(symbols[i])
                    i += 1
            symbols = joined
        return symbols

    def _may_follow(self, before: str, token: str, final: bool) -> bool:
        if len(self.pairs) > self.remembered:
            self.pairs.clear()
        token_end = token + self.end if final else token
        follows = self._merged(before + token_end) == [before, token_end]
        self.pairs[before, token, final] = follows
        return follows

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of words, computed in the depth-first order of their trie."""
        inner, last, pairs = self.inner, self.last, self.pairs
        tokens, encoded, before, out = [""], [b""], "", {}
        for spelled, word in sorted(
            (w if w.isascii() and w.isprintable() else as_symbols(w), w) for w in words
        ):
            # The last symbol differs inside and at the end of a word, so it is never shared.
            body = len(spelled) - 1
            shared, most = 0, min(len(before), body)
            while shared < most and before[shared] == spelled[shared]:
                shared += 1
            del tokens[shared + 1 :], encoded[shared + 1 :]
            for at in range(shared + 1, body + 2):
                final = at > body
                known = last if final else inner
                for size in range(1, at + 1):
                    token = spelled[at - size : at]
                    code = known.get(token)
                    if code is None:
                        continue
                    if size == at:
                        break
                    pair = (tokens[at - size], token, final)
                    follows = pairs.get(pair)
                    if follows or follows is None and self._may_follow(*pair):
                        break
                else:
                    raise ValueError(f"no token ends {spelled[:at]!r}")
                if final:
                    out[word] = encoded[at - size] + code
                else:
                    tokens.append(token)
                    encoded.append(encoded[at - size] + code)
            before = spelled[:body]
        return out


class Codec:
    """Whole texts to ids and back to text."""

    def __init__(self, path: str):
        self.own = pieces(path)
        if self.own.tokenizer.decoder is not None or not self.own.suffix:
            raise ValueError("a vocabulary with word ends and without a decoder is needed")
        self.prefixes = PrefixCodec(self.own)
        self.special = {t: i.to_bytes(4, "little") for t, i in self.own.added.items()}
        by_id = {i: t for t, i in [*self.own.vocab.items(), *self.own.added.items()]}
        self.spelled = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        self.chunks: dict[str, bytes] = {}
        self.remember(REMEMBERED)

    def remember(self, most: int) -> None:
        """Bound the distinct chunks, and the pairs of tokens, that are kept."""
        self.remembered = self.prefixes.remembered = most

    def _cut(self, text: str) -> list[str]:
        """Chunks between white space; pre-tokens never reach over it."""
        if ODD.search(text):
            return self.own.pre_tokens(text)
        return text.lower().split()

    def _add(self, missing: set[str]) -> None:
        cut = {c: self.own.pre_tokens(c) for c in missing}
        words = self.prefixes.learn({w for parts in cut.values() for w in parts})
        self.chunks |= {c: b"".join([words[w] for w in parts]) for c, parts in cut.items()}

    def batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > self.remembered:
            self.chunks.clear()
        known, missing, lines = self.chunks.get, set(), []
        for text in texts:
            lines.append(line := [])
            for special, part in self.own.segments(text or ""):
                if special:
                    line.append(([part], [self.special[part]]))
                    continue
                chunks = self._cut(part)
                codes = list(map(known, chunks))
                if None in codes:
                    missing.update(c for c, x in zip(chunks, codes, strict=True) if x is None)
                    line.append((chunks, codes))
                else:
                    line.append(((), codes))
        self._add(missing)
        return [
            b"".join(
                b"".join([known(c) if x is None else x for c, x in zip(chunks, codes, strict=True)])
                if chunks else b"".join(codes)
                for chunks, codes in line
            )
            for line in lines
        ]

    def decode(self, ids: bytes) -> str:
        """The library's decoding without a decoder: token strings, special ones too, by spaces."""
        return " ".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker process and file."""
    return Codec(path)


def encoded(
    text: Column, path: str, *, rows: int = 2000, remembered: int = REMEMBERED, release: bool = False
) -> Column:
    """Struct of ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` text.

    Strings of added tokens become their id, as is the default of the library; nothing is added
    before or after. ``rows`` bounds the texts that a worker holds as words at once, and
    ``remembered`` the distinct chunks whose ids it keeps, and the pairs of tokens. With
    ``release`` a worker forgets vocabulary and ids after each task and leaves the memory to others.
    """

    @F.pandas_udf(FIELDS)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        own.remember(remembered)
        for texts in batches:
            # Results go out in small parts, since they are larger than the texts.
            for i in range(0, len(texts), rows):
                ids = own.batch(texts.iloc[i : i + rows])
                yield pd.DataFrame(
                    {
                        "n_tokens": [len(x) // 4 for x in ids],
                        "ids": ids,
                        "decoded": [own.decode(x) for x in ids],
                    }
                )
        if release:
            codec.cache_clear()
            pieces.cache_clear()

    return encode(text)


def encode_documents(
    documents: DataFrame, path: str, *, rows: int = 2000, remembered: int = REMEMBERED, release: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` per document.

    Null and empty texts give no ids and an empty decoded text. Every row is answered by itself,
    so null and repeated ids, repeated rows and further columns change nothing; an empty table
    gives an empty result.
    """
    codes = encoded(F.col("text"), path, rows=rows, remembered=remembered, release=release)
    own = bare(documents).select("doc_id", codes.alias("e"))
    return own.select("doc_id", "e.n_tokens", "e.ids", "e.decoded")
