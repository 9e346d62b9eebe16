"""Byte-pair encoding of whole texts, equal to the tokenizers library's, on top of its own merge model.

A chunk is what lies between hard boundaries, places that neither the pre-tokenizer's pattern nor any merge crosses whatever
stands around them; chunks repeat, so a worker keeps the ids of those it has seen. A chunk that is new is cut into
pre-tokens by the pattern and each is given to the library's merge model. Every text above a leaf is encoded in pieces:
TreeJoin halves it again and again and joins what the halves give; Splices encodes overlapping pieces and splices them.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from array import array
from typing import NamedTuple

import numpy as np
import regex
from tokenizers import Tokenizer

from glossmark.llm.common import keep_only

#: Chunks, and pre-tokens, kept by a worker process, at about 200 bytes each: those that came twice, as most words come but once.
#: Once full, new ones are encoded each time they come.
CACHE_ENTRIES = 160_000

# fixed values: the pre-tokenizers' patterns as the tokenizer files and the byte-level scheme define them
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters that Python takes for white space and the library doesn't.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
_LATIN = re.compile(r"[\x09\x0a\x0d\x20-\x7e\xa1-\xff]*\Z")


def _byte_alphabet() -> dict[int, int]:
    """For str.translate: the printable stand-in that byte-level vocabularies use for each byte."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


BYTES_TO_TEXT = _byte_alphabet()


class Memo(dict):
    """A dict that computes what it lacks, and keeps what it lacked twice, while there is room."""

    def __init__(self, compute, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.entries = compute, entries
        self.seen = bytearray(1 << 21)

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.entries:
            at = hash(key) & 0x1FFFFF
            if self.seen[at]:
                self[key] = value
            else:
                self.seen[at] = 1
        return value


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers in bytes; special tokens as the file sets them."""

    def __init__(self, file: str):
        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.lowers = self.library.normalizer is not None
        self.pattern = regex.compile(WORD_PATTERN if self.lowers else BYTE_PATTERN)
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.pretokens = Memo(self._pretoken)
        self.chunks = Memo(self._chunk)

    def by_library(self, text: str):
        return self.library.encode(text, add_special_tokens=False)

    def _pretoken(self, pretoken: str) -> bytes:
        mapped = pretoken if pretoken.isascii() and pretoken.isalnum() else pretoken.encode().decode("latin-1").translate(BYTES_TO_TEXT)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """A chunk of Latin-1 letters, which normal form leaves as they are, goes to the model piece by piece; others to the library."""
        if len(chunk) > TreeJoin.LEAF_CHARS:
            return self.tree.encode(chunk)
        if not _LATIN.match(chunk) or any(s in chunk for s in self.special):
            return array("I", self.by_library(chunk).ids).tobytes()
        if self.lowers:
            chunk = chunk.lower()
            if chunk.isalpha():
                return self._pretoken(chunk)
        return b"".join(map(self.pretokens.__getitem__, self.pattern.findall(chunk)))

    def split(self, text: str) -> list[str]:
        """The text's chunks. Where white space is dropped, any of it is a hard boundary; in the byte-level scheme one lies before
        each space after a character that isn't white space, as only the head of a match can be a space there."""
        if self.lowers:
            if any(s in text for s in _SEPARATORS):
                return re.split(r"[ \t\n\r\x0b\x0c]+", text)
            return text.split()
        if _before_space(text):
            return re.split(r"(?<=\S)(?= )", text)
        head, *rest = text.split(" ")
        return [head, *[" " + x for x in rest]] if head else [" " + x for x in rest]

    def encode(self, text: str) -> bytes:
        return self.flat(text) if len(text) <= TreeJoin.LEAF_CHARS else self.tree.encode(text)

    def flat(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, self.split(text)))

    @functools.cached_property
    def tree(self) -> TreeJoin:
        return TreeJoin(self)

    @functools.cached_property
    def splices(self) -> Splices:
        return Splices(self)

    @functools.cached_property
    def counts(self) -> Memo:
        """By byte-level chunk without its leading space: its number of tokens."""
        return Memo(lambda rest: len(self._chunk(" " + rest)) // 4)

    def count(self, text: str) -> int:
        return sum(self.chunk_counts(text)[1]) if len(text) <= TreeJoin.LEAF_CHARS else self.splices.count(text)

    def chunk_counts(self, text: str) -> tuple[list[int], list[int]]:
        """Where the text's chunks start, and how many tokens each has."""
        if not self.lowers and not _before_space(text):
            head, *rest = text.split(" ")
            counts, sizes = list(map(self.counts.__getitem__, rest)), [len(x) + 1 for x in rest]
            if head:
                counts, sizes = [len(self.chunks[head]) // 4, *counts], [len(head), *sizes]
            return [0, *itertools.accumulate(sizes)][:-1], counts
        if self.lowers:
            found = [(m.start(), m.group()) for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", text)]
            return [x for x, _ in found], [len(self.chunks[x]) // 4 for _, x in found]
        chunks = self.split(text)
        return [0, *itertools.accumulate(map(len, chunks))][:-1], [len(self.chunks[x]) // 4 for x in chunks]

    @functools.cached_property
    def tokens(self) -> list[str]:
        size = self.library.get_vocab_size(with_added_tokens=True)
        return [self.library.id_to_token(i) or "" for i in range(size)]

    def decode(self, ids: bytes) -> str:
        """As decode(ids, skip_special_tokens=False): without a decoder, the tokens with a space between each two."""
        numbers = memoryview(ids).cast("I")
        if self.library.decoder is None:
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.library.decode(list(numbers), skip_special_tokens=False)


def _before_space(text: str) -> bool:
    """Whether some white space stands before a space: then a space needn't be a hard boundary."""
    if text.isascii():
        return any(w in text for w in ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ", "\x1c ", "\x1d ", "\x1e ", "\x1f "))
    return re.search(r"\s ", text) is not None


class Run(NamedTuple):
    """A stretch of text; if it is longer than a leaf, with its encoding: ids and their places, in characters."""

    text: str
    ids: np.ndarray | None = None
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None


class Piece(NamedTuple):
    """What a stretch of a text gives by itself: the ids between its first and last hard boundary. What stands before and behind these, its
    neighbours decide. A stretch without a hard boundary is all head, and has no tail."""

    head: Run
    body: bytes
    tail: Run | None


class TreeJoin:
    """Encoding by tree concatenation: halves first, then windows around the join, which grow until both sides agree.

    The ids of left + right are those of left up to a place p, those of a window around the join from p to q, and those of right
    from q. That is exact in two cases. meet() does the first on pieces, whose ends are kept as text up to the nearest hard
    boundary; join() does both on runs with arrays, so that long text without any such boundary needn't be encoded again.

    1. p and q are hard boundaries: white space that the pre-tokenizer's pattern cannot join to what stands before it.
    2. The window lies in one pre-token, a run of letters or of punctuation, and its encoding begins with a token that left has
       at that place too, and ends, before its last token, with one that right has there. No merge crosses the ends of an agreed
       token: merges act by rank, then from the left, on neighbours alone; up to the first merge that would cross such an end,
       both neighbours develop as in the window, where the same merge would have crossed it. A token that is last in a piece
       is not used, as a word's last symbol may carry an end mark.

    If neither holds, the window doubles, at the worst up to both whole sides, whose encoding is the result itself.
    """

    LEAF_CHARS = 2048
    WINDOW_CHARS = 64
    CONTEXT_CHARS = 4  # more than the longest contraction

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.one_run = regex.compile(r"\p{L}+|[^\s\p{L}\p{N}']+" + ("" if encoder.lowers else r"|\p{N}+"))

    def leaf(self, text: str):
        found = self.encoder.by_library(text)
        places = np.array(found.offsets, np.uint32).reshape(-1, 2)
        return text, np.array(found.ids, np.uint32), places[:, 0], places[:, 1]

    def pieces(self, text: str) -> list[str]:
        """Halves of halves, down to leaves."""
        if len(text) <= self.LEAF_CHARS:
            return [text]
        cut = len(text) // 2
        return [*self.pieces(text[:cut]), *self.pieces(text[cut:])]

    def encode(self, text: str) -> bytes:
        return self.ids(self.tree(text))

    def tree(self, text: str) -> Piece:
        return self.met([self.piece(x) for x in self.pieces(text)])

    def piece(self, text: str) -> Piece:
        """A leaf by itself."""
        chunks = self.encoder.split(text)
        if self.encoder.lowers and not any(s in text for s in _SEPARATORS):
            chunks = [*[""] * text[:1].isspace(), *chunks, *[""] * text[-1:].isspace()]
        if len(chunks) < 2:
            return Piece(Run(text), b"", None)
        return Piece(Run(chunks[0]), b"".join(map(self.encoder.chunks.__getitem__, filter(None, chunks[1:-1]))), Run(chunks[-1]))

    def met(self, pieces: list[Piece]) -> Piece:
        while len(pieces) > 1:
            pieces = [self.meet(*pieces[i : i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
        return pieces[0]

    def meet(self, left: Piece, right: Piece) -> Piece:
        """Both as one: what stands between the last hard boundary of left and the first of right is encoded again."""
        if left.tail is None:
            return Piece(self.glue(left.head, right.head), right.body, right.tail)
        middle = self.glue(left.tail, right.head)
        if right.tail is None:
            return Piece(left.head, left.body, middle)
        return Piece(left.head, left.body + self.run_ids(middle) + right.body, right.tail)

    def glue(self, left: Run, right: Run, overlap: int = 0) -> Run:
        """The two as one, where the last overlap characters of left are the first of right."""
        if len(left.text) + len(right.text) - overlap <= self.LEAF_CHARS:
            return Run(left.text + right.text[overlap:])
        left, right = (x if x.ids is not None else Run(*self.leaf(x.text)) for x in (left, right))
        return Run(*(self.spliced(left, right, overlap) if overlap else self.join(left, right)))

    def run_ids(self, run: Run) -> bytes:
        return self.encoder.flat(run.text) if run.ids is None else run.ids.tobytes()

    def ids(self, piece: Piece) -> bytes:
        return self.run_ids(piece.head) + piece.body + (self.run_ids(piece.tail) if piece.tail else b"")

    def join(self, left, right):
        if not left[0] or not right[0]:
            return right if not left[0] else left
        n, width = len(left[0]), self.WINDOW_CHARS
        while True:
            a, b = max(0, n - width), min(len(right[0]), width)
            if a == 0 and b == len(right[0]):
                return self.leaf(left[0] + right[0])
            p, q = self._hard(left[0], a, last=True) if a else 0, self._hard(right[0], b, last=False) if b < len(right[0]) else b
            if p is not None and q is not None:
                return self._put(left, right, p, q, self.leaf(left[0][p:] + right[0][:q]), p)
            if (found := self._agreed(left, right, a, b)) is not None:
                return found
            width *= 2

    def _hard(self, text: str, edge: int, last: bool) -> int | None:
        """The hard boundary that is nearest to the join, within edge."""
        places = [m.start() + 1 for m in re.finditer(r"\S(?=[ \t\n])", text[edge - 1 :] if last else text[: edge + 1])]
        if not places:
            return None
        return edge - 1 + places[-1] if last else places[0]

    def _one_run(self, text: str) -> bool:
        return bool(self.one_run.fullmatch(text)) and unicodedata.is_normalized("NFC", text) and len(text.lower()) == len(text)

    def _agreed(self, left, right, a: int, b: int):
        """Case 2 of the class: p and q at agreed tokens, or None."""
        n = len(left[0])
        first, stop = np.searchsorted(left[2], a), np.searchsorted(right[3], b, side="right")
        if first == len(left[2]) or stop == 0:
            return None
        a, b = int(left[2][first]), int(right[3][stop - 1])
        if not self._one_run(left[0][max(0, a - self.CONTEXT_CHARS) :] + right[0][: b + self.CONTEXT_CHARS]):
            return None
        middle = self.leaf(left[0][a:] + right[0][:b])
        mine = {(i, s + a, e + a) for i, s, e in _rows(middle)}
        theirs = {(i, s + a - n, e + a - n) for i, s, e in _rows(middle)[:-1]}
        p = next((x[2] for x in _rows(left, first) if x[2] < n and x in mine), None)
        q = next((x[1] for x in reversed(_rows(right, 0, stop)) if 0 < x[1] and x[2] < b and x in theirs), None)
        return None if p is None or q is None else self._put(left, right, p, q, middle, a)

    def _put(self, left, right, p: int, q: int, middle, a: int):
        """left up to p, from there to q in right what middle has, whose text starts at a in left; the rest of right."""
        n = len(left[0])
        head = slice(0, np.searchsorted(left[2], p))
        body = slice(np.searchsorted(middle[2], p - a), np.searchsorted(middle[3], n + q - a, side="right"))
        tail = slice(np.searchsorted(right[2], q), None)
        return left[0] + right[0], *(np.concatenate([x[head], y[body] + np.uint32(k and a), z[tail] + np.uint32(k and n)]) for k, x, y, z in zip((0, 1, 1), left[1:], middle[1:], right[1:], strict=True))

    def spliced(self, left, right, overlap: int):
        """The two as one, where the last overlap characters of left are the first of right: up to a common boundary from left, on
        from there from right. It is a hard boundary or the end of an agreed token within one pre-token, as above; if the
        overlap has neither, it is widened: the join goes on without it."""
        n = len(left[0]) - overlap
        if overlap and (p := self._hard(left[0], max(n, 1), last=True)) is not None:
            return self._cut(left, right, p, n)
        if overlap and self._one_run(left[0][max(0, n - self.CONTEXT_CHARS) :] + right[0][overlap : overlap + self.CONTEXT_CHARS]):
            mine = {x for x in _rows(left, np.searchsorted(left[2], n)) if x[2] < len(left[0])}
            agreed = [e for i, s, e in _rows(right, 0, np.searchsorted(right[2], overlap)) if (i, s + n, e + n) in mine]
            if agreed:
                return self._cut(left, right, agreed[0] + n, n)
        rest = right[0][overlap:]
        return self.join(left, self.leaf(rest)) if rest else left

    def _cut(self, left, right, p: int, n: int):
        head, tail = slice(0, np.searchsorted(left[2], p)), slice(np.searchsorted(right[2], p - n), None)
        return left[0] + right[0][len(left[0]) - n :], *(np.concatenate([x[head], y[tail] + np.uint32(k and n)]) for k, x, y in zip((0, 1, 1), left[1:], right[1:], strict=True))


class Splices:
    """Token counts by overlap resynchronisation: overlapping pieces are encoded with offsets, and neighbours are spliced at a
    boundary that both have in their overlap and that provably stands in the whole text: a hard one. If the overlap has none, it is
    widened to both sides, up to the nearest hard boundaries; where they are far apart, what lies between is a run without any, and
    its own overlapping pieces are spliced at tokens that both sides have (TreeJoin.spliced)."""

    OVERLAP_CHARS = 256

    def __init__(self, encoder: Encoder):
        self.encoder, self.join = encoder, TreeJoin(encoder)

    def part(self, text: str) -> tuple[np.ndarray, np.ndarray, Run, Run | None]:
        """(starts, counts, head, tail) of a piece: its hard boundaries, the tokens from each to the next, and what stands before the
        first and behind the last. A piece without any is all head."""
        starts, counts = self.encoder.chunk_counts(text)
        if starts and starts[0] == 0:  # the cut, which is no boundary
            starts, counts = starts[1:], counts[1:]
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), self.run(text), None
        return np.array(starts), np.array(counts), self.run(text[: starts[0]]), self.run(text[starts[-1] :])

    def run(self, text: str) -> Run:
        if len(text) <= self.join.LEAF_CHARS:
            return Run(text)
        size, overlap = self.join.LEAF_CHARS, min(self.OVERLAP_CHARS, self.join.LEAF_CHARS // 2)
        done = None
        for at in range(0, max(1, len(text) - overlap), size):
            piece = self.join.leaf(text[at : at + size + overlap])
            done = piece if done is None else self.join.spliced(done, piece, len(done[0]) - at)
        return Run(*done)

    def count(self, text: str) -> int:
        size, overlap = self.join.LEAF_CHARS, self.OVERLAP_CHARS
        return self.counted([(at, *self.part(text[at : at + size + overlap])) for at in range(0, max(1, len(text) - overlap), size)])

    def counted(self, parts: list[tuple]) -> int:
        """Tokens of a text from its parts (at, starts, counts, head, tail), in order. All before from_, the start or a hard boundary,
        is counted in total; run is what is known from there to end."""
        total, run, from_, end = 0, Run(""), 0, 0
        for at, starts, counts, head, tail in parts:
            found = np.searchsorted(starts, from_ - at) if from_ > at else len(starts)
            if found < len(starts):  # from_ is a boundary of both sides: spliced there
                total += int(counts[found:-1].sum())
            else:
                run = self.join.glue(run, head, min(max(0, end - at), len(head.text)))
                end = at + len(head.text)
                if tail is None:
                    continue
                total += len(self.join.run_ids(run)) // 4 + int(counts[:-1].sum())
            run, from_ = tail, at + int(starts[-1])
            end = from_ + len(tail.text)
        return total + len(self.join.run_ids(run)) // 4


def _rows(piece, start: int = 0, stop: int | None = None) -> list[tuple[int, int, int]]:
    return list(zip(*(x[start:stop].tolist() for x in piece[1:]), strict=True))


_encoder = functools.cache(Encoder)


def encoder(file: str) -> Encoder:
    """One for each file and worker process, until the worker goes on to another operator."""
    keep_only("encoder", _encoder.cache_clear)
    return _encoder(file)
