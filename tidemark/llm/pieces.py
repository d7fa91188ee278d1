"""What the token operators need of a tokenizer file: added strings, pre-tokens, byte symbols."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import regex
from tokenizers import Tokenizer

# The pre-token patterns of the two tokenizer families, with white space spelled out.
_SPACE = "\t-\r \x85\xa0  -     　"
BYTE_LEVEL = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
WORD_ENDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+"

#: Beyond these characters Unicode versions may disagree, so the library itself cuts the text.
#: The four separators are white space to Python and not to the library.
ODD = re.compile("[^\x00-\x1b\x20-ɏ]")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary strings."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


SYMBOLS = byte_symbols()
_TABLE = SYMBOLS  # str.translate over Latin-1 text: code point = byte


def as_symbols(piece: str) -> str:
    """A pre-token as vocabulary strings spell it."""
    return piece.encode("utf-8").decode("latin-1").translate(_TABLE)


class Pieces:
    """Cuts texts as the library does: at added strings, then into pre-tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.vocab = spec["model"]["vocab"]
        self.merges = spec["model"]["merges"]
        added = spec["added_tokens"]
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("added tokens that strip or normalise are not supported")
        self.added = {a["content"]: a["id"] for a in added}
        longest = sorted(self.added, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self._find = regex.compile(WORD_ENDS if self.suffix else BYTE_LEVEL).findall

    def segments(self, text: str) -> list[tuple[bool, str]]:
        """(is an added string, text) in order; empty segments are left out."""
        if self._cut is None or not text:
            return [(False, text)] if text else []
        return [(s in self.added, s) for s in self._cut.split(text) if s]

    def pre_tokens(self, text: str) -> list[str]:
        """The normalised pre-tokens of a segment without added strings."""
        if ODD.search(text) is None:
            return self._find(text.lower() if self.suffix else text)
        normalizer, cutter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [from_symbols(s) for s, _ in cutter.pre_tokenize_str(text)]


_BYTES = {s: b for b, s in SYMBOLS.items()}


def from_symbols(piece: str) -> str:
    """The text that vocabulary symbols stand for; what is not UTF-8 shows as replacements."""
    return bytes(_BYTES[s] for s in piece).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """One per worker process and file."""
    return Pieces(path)
