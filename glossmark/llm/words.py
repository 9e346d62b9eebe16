"""Words of whole texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

from glossmark.llm.common import keep_only

#: Characters of text that one numpy pass takes; a longer text is a pass of its own.
PASS_CHARS = 4 << 20
#: Texts of a pass are told apart by 16-bit numbers.
PASS_TEXTS = 1 << 16
MEMO_WORDS = 100_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text: str | None) -> list[str]:
    """The runs of characters other than space, tab, newline, vertical tab, form feed and carriage return."""
    if not text:
        return []
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return _WORD.findall(text)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode(errors="surrogatepass"))
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value


_memo = _Hashes()
_hash = _memo.__getitem__


def hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_hash, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling(h: np.ndarray, width: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash for each run of width numbers of h; another odd factor gives another hash."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        out = out * np.uint64(factor) + h[k : len(h) - width + 1 + k]
    return mix(out)


def passes(texts: list[str | None], chars: int = PASS_CHARS, most: int = PASS_TEXTS) -> Iterator[range]:
    """Runs of positions in texts, most at a time, whose characters add up to about so many."""
    keep_only("words", _memo.clear)
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars or i + 1 - start == most:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))
