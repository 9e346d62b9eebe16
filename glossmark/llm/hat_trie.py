"""Phrase collocations by exact counts of word windows, in a trie of hash containers that spills whole subtrees as sorted runs."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmark.llm.common import slices, written
from glossmark.llm.words import mix, passes

#: Entries of a task's trie (or words of its dictionary) at which it spills.
SPILL_ENTRIES = 1_000_000
#: A hash container with more entries bursts into a node of containers, one for each next word.
BURST_ENTRIES = 8192
#: Windows counted for each prefix partition, so that one partition's runs fit in a task.
PARTITION_WINDOWS = 1_500_000
#: A word with this share of all words is hot: partitions go by the second word too below a hot first one, and by the third one below
#: two hot ones. There can be no more hot words than the inverse.
HOT_SHARE = 1 / 1000
#: A language that is null counts as this one.
NO_LANGUAGE = "und"

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(46 if c in _PIECE_ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_UNSIGNED, _KEY = np.uint64, np.uint32


def tokens(text: bytes | None) -> list[bytes]:
    """A text's words, A-Z lower-cased, with a full stop, which no word has, wherever a piece ends."""
    return text.translate(_BYTES).replace(b".", b" . ").split() if text else []


def word_id(lang: str, word: bytes, seed: int) -> int:
    """64 bits for a word of a language, never 0, which stands for no word."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode(), seed)) or 1


class HatTrie:
    """Counts of windows of three words, given by numbers below 2^32; 0 stands for no word. The root and burst nodes lead from a word to
    what follows; a container is a hash table from the rest of a window to its count."""

    def __init__(self):
        self.root: dict[int, Counter | dict[int, Counter]] = {}
        self.entries = 0

    def add(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> None:
        """Count windows. They come many at a time and in order of the first words, so that a container takes its own in one go."""
        order = np.argsort(first, kind="stable")
        first = first[order]
        rest = (second[order].astype(_UNSIGNED) << _UNSIGNED(32)) | third[order]
        ends = np.flatnonzero(np.r_[first[1:] != first[:-1], True]) + 1
        suffixes, start = rest.tolist(), 0
        for word, end in zip(first[ends - 1].tolist(), ends.tolist(), strict=True):
            node = self.root.get(word)
            if type(node) is dict:
                self._add_below(node, rest[start:end])
            else:
                if node is None:
                    node = self.root[word] = Counter()
                before = len(node)
                node.update(suffixes[start:end])
                self.entries += len(node) - before
                if len(node) > BURST_ENTRIES:
                    self._burst(word, node)
            start = end

    def _add_below(self, node: dict[int, Counter], rest: np.ndarray) -> None:
        rest = np.sort(rest)
        second = rest >> _UNSIGNED(32)
        ends = np.flatnonzero(np.r_[second[1:] != second[:-1], True]) + 1
        thirds, start = (rest & _UNSIGNED(0xFFFFFFFF)).tolist(), 0
        for word, end in zip(second[ends - 1].tolist(), ends.tolist(), strict=True):
            container = node.get(word)
            if container is None:
                container = node[word] = Counter()
            before = len(container)
            container.update(thirds[start:end])
            self.entries += len(container) - before
            start = end

    def _burst(self, word: int, container: Counter) -> None:
        node = self.root[word] = {}
        for key, n in container.items():
            node.setdefault(key >> 32, Counter())[key & 0xFFFFFFFF] = n

    def drained(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, second, third, count) of all entries, and the trie is empty."""
        flat = [(w, 0, c) for w, c in self.root.items() if type(c) is not dict] + [(w, s, c) for w, node in self.root.items() if type(node) is dict for s, c in node.items()]
        sizes = [len(c) for _, _, c in flat]
        keys = np.fromiter(chain.from_iterable(c for _, _, c in flat), _UNSIGNED, sum(sizes))
        counts = np.fromiter(chain.from_iterable(c.values() for _, _, c in flat), np.int64, sum(sizes))
        first, above = (np.repeat(np.array([f[i] for f in flat], _UNSIGNED), sizes) for i in (0, 1))
        self.root, self.entries = {}, 0
        return first, (keys >> _UNSIGNED(32)) | above, keys & _UNSIGNED(0xFFFFFFFF), counts


class Runs:
    """Sorted runs of entries by prefix partition: nested, so that a prefix is written once for what is below it."""

    NAMES = ("first", "below_first", "second", "below_second", "third", "count")
    SCHEMA = "part int, " + ", ".join(f"{n} binary" for n in NAMES)

    @staticmethod
    def of(parts: np.ndarray, first: np.ndarray, second: np.ndarray, third: np.ndarray, count: np.ndarray) -> Iterator[tuple]:
        """A row for each partition; entries come in its order, then in that of their words."""
        starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else []
        for a, b in zip(starts, np.r_[starts[1:], len(parts)], strict=True):
            one, two = first[a:b], second[a:b]
            new_one = np.r_[True, one[1:] != one[:-1]]
            new_two = new_one | np.r_[True, two[1:] != two[:-1]]
            at_two = np.flatnonzero(new_two)
            at_one = np.flatnonzero(new_one[at_two])
            below = (np.diff(np.r_[at_one, len(at_two)]), np.diff(np.r_[at_two, b - a]))
            arrays = (one[new_one], below[0].astype(_KEY), two[new_two], below[1].astype(_KEY), third[a:b], count[a:b].astype(np.int64))
            yield int(parts[a]), *(x.tobytes() for x in arrays)

    @staticmethod
    def entries(row: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        first, second, third = (np.frombuffer(row[n], _UNSIGNED) for n in ("first", "second", "third"))
        second_of, third_of = (np.frombuffer(row[n], _KEY) for n in ("below_first", "below_second"))
        return np.repeat(np.repeat(first, second_of), third_of), np.repeat(second, third_of), third, np.frombuffer(row["count"], np.int64)


def prefix_part(first: np.ndarray, second: np.ndarray, third: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a window: by its first word, its first two if that one is hot, all three if both are. hot is sorted."""

    def is_hot(x: np.ndarray) -> np.ndarray:
        if not len(hot):
            return np.zeros(len(x), bool)
        return hot[np.minimum(np.searchsorted(hot, x), len(hot) - 1)] == x

    h = mix(first)
    deeper = is_hot(first)
    h = np.where(deeper, mix(h ^ second), h)
    return (np.where(deeper & is_hot(second), mix(h ^ third), h) % _UNSIGNED(parts)).astype(np.int32)


def _word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, id, n): how often each word comes, summed up in each task as far as its memory goes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items() if w != b"."]
            ids = np.array([word_id(lang, w, seed) for lang, w, _ in rows], _UNSIGNED).view(np.int64)
            columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()).cast(pa.string()), pa.array(ids), pa.array([r[2] for r in rows], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "id", "n"])

        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                held.setdefault(lang, Counter()).update(tokens(text.as_py()))
            if sum(map(len, held.values())) > SPILL_ENTRIES:
                yield out()
        yield out()

    return docs.mapInArrow(count, "lang string, word string, id long, n long").groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def _spilled(docs: DataFrame, seed: int, hot: np.ndarray, parts: int) -> DataFrame:
    """Every task's sorted runs: a row for each spill and partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie()
        numbers: dict[str, dict[bytes, int]] = {}
        ids: list[int] = [0]

        class Numbers(dict):
            """The task's own number for each word of a language; what it stands for is in ids."""

            def __init__(self, lang: str):
                super().__init__({b".": 0})
                self.lang = lang

            def __missing__(self, word: bytes) -> int:
                ids.append(word_id(self.lang, word, seed))
                self[word] = found = len(ids) - 1
                return found

        def spill() -> Iterator[pa.RecordBatch]:
            first, second, third, n = trie.drained()
            known = np.array(ids, _UNSIGNED)
            first, second, third = (known[x.astype(np.int64)] for x in (first, second, third))
            part = prefix_part(first, second, third, hot, parts)
            order = np.lexsort((third, second, first, part))
            rows = list(Runs.of(*(x[order] for x in (part, first, second, third, n))))
            numbers.clear()
            del ids[1:]
            for at in range(0, len(rows), 64):
                columns = zip(*rows[at : at + 64], strict=True)
                kinds = [pa.int32(), *[pa.binary()] * len(Runs.NAMES)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", *Runs.NAMES])

        for batch in slices(batches):
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for run in passes(texts):
                found: list[int] = []
                for i in run:
                    number = numbers.get(langs[i])
                    if number is None:
                        number = numbers[langs[i]] = Numbers(langs[i])
                    found += map(number.__getitem__, tokens((texts[i] or "").encode()))
                    found.append(0)
                words = np.array([*found, 0, 0], _KEY)
                at = np.flatnonzero(words[:-2])
                first, second = words[at], words[at + 1]
                trie.add(first, second, np.where(second == 0, _KEY(0), words[at + 2]))
                if trie.entries > SPILL_ENTRIES or len(ids) > SPILL_ENTRIES:
                    yield from spill()
        if trie.entries:
            yield from spill()

    return docs.mapInArrow(count, Runs.SCHEMA)


def _merged(runs: DataFrame, hot: np.ndarray, least: int) -> DataFrame:
    """(first, second, third, n) from a partition's runs: windows of three words that come least times or more, and of two (third is null);
    of two hot words each partition has a part of the windows, so these come whatever their count, to be summed up."""
    split = set(hot.tolist())

    def merge(table: pa.Table) -> pa.Table:
        first, second, third, n = (np.concatenate(x) for x in zip(*(Runs.entries(r) for r in table.to_pylist()), strict=True))
        order = np.lexsort((third, second, first))  # a stable merge of what is sorted already
        first, second, third, n = (x[order] for x in (first, second, third, n))
        found = []
        for three in (True, False):
            new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (three & (third[1:] != third[:-1]))]
            at = np.flatnonzero(new)
            sums = np.add.reduceat(n, at)
            one, two, last = first[at], second[at], third[at]
            if three:
                good = (last != 0) & (sums >= least)
            else:
                partial = np.fromiter((a in split and b in split for a, b in zip(one.tolist(), two.tolist(), strict=True)), bool, len(at)) if split else np.zeros(len(at), bool)
                good = (two != 0) & (partial | (sums >= least))
            found.append(pa.table({"first": one[good].view(np.int64), "second": two[good].view(np.int64), "third": pa.array(last[good].view(np.int64), mask=np.full(int(good.sum()), not three)), "n": sums[good]}))
        return pa.concat_tables(found)

    return runs.groupBy("part").applyInArrow(merge, "first long, second long, third long, n long")


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    whole = "cast({} as decimal(38, 0))".format
    return F.expr(f"cast((1000000BD * {whole(a)} * {whole(a)}) div ({whole(left)} * {whole(right)}) as long)")


def phrases(docs: DataFrame, least: int = 10, top: int = 2000, text_col: str = "text", lang_col: str = "lang", covered_percent: int = 50, seed: int = 42) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases of two and three words by score, that come least times.

    Pass one counts words; a word is known by 64 bits, which are told one-to-one on the corpus' words (with another seed if not). Pass
    two counts every window of three words in each task's HAT-trie, which spills whole subtrees as sorted runs; runs are dealt by prefix,
    as long as it takes to split hot words, and merged in each partition. Scores come from joins of counted phrases with the
    counts of their parts. All counts are exact; scores are whole numbers of up to 38 digits, which serves phrases that come up to 10^16 times.

    A null text has no words, a null language counts as NO_LANGUAGE, repeated rows count each, an empty table gives no rows; columns
    other than the two are not read. Ties: score, then a, both descending, then the phrase in byte order. A text is held whole by its task.
    """
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text"))
    while True:
        words = written(_word_counts(docs, seed), "words")
        clash = words.groupBy("id").agg(F.count(F.lit(1)).alias("same")).where("same > 1")
        if clash.isEmpty():
            break
        seed += 1
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = words.where(F.col("n") >= max(1, total * HOT_SHARE)).select("id").collect()  # 1 / HOT_SHARE rows at most
    hot = np.sort(np.array([r["id"] for r in hot], np.int64).view(_UNSIGNED))
    runs = _spilled(docs, seed, hot, max(1, math.ceil(total / PARTITION_WINDOWS)))
    grams = written(_merged(runs, hot, least), "phrases")
    two = grams.where(F.col("third").isNull()).groupBy("first", "second").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    three = grams.where(F.col("third").isNotNull())

    def word(i: str) -> DataFrame:
        return words.where(F.col("n") >= least).select(F.col("id").alias(i), F.col("word").alias(f"word_{i}"), F.col("n").alias(f"n_{i}"))

    with_language = words.where(F.col("n") >= least).select(F.col("id").alias("first"), "lang", F.col("word").alias("word_first"), F.col("n").alias("n_first"))
    # a phrase that a longer one covers: its count there, at most
    cover = three.select(F.explode(F.array(F.struct("first", "second"), F.struct(F.col("second").alias("first"), F.col("third").alias("second")))).alias("p"), "n")
    cover = cover.groupBy("p.first", "p.second").agg(F.max("n").alias("longest"))
    pairs = two.join(cover, ["first", "second"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < covered_percent * F.col("n"))).drop("longest")
    pairs = pairs.join(with_language, "first").join(word("second"), "second")
    pairs = pairs.select("lang", F.concat_ws(" ", "word_first", "word_second").alias("phrase"), F.col("n").alias("a"), F.col("n_first").alias("l"), F.col("n_second").alias("r"))
    pairs = pairs.withColumn("score", _score("a", "l", "r"))
    head = two.select("first", "second", F.col("n").alias("n_head"))
    tail = two.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("n").alias("n_tail"))
    triples = three.join(head, ["first", "second"]).join(tail, ["second", "third"]).join(with_language, "first").join(word("second"), "second").join(word("third"), "third")
    triples = triples.withColumns({"one": _score("n", "n_first", "n_tail"), "two": _score("n", "n_head", "n_third")})
    early = F.col("one") <= F.col("two")
    cut = [F.when(early, F.col(x)).otherwise(F.col(y)).alias(name) for x, y, name in (("n_first", "n_head", "l"), ("n_tail", "n_third", "r"), ("one", "two", "score"))]
    triples = triples.select("lang", F.concat_ws(" ", "word_first", "word_second", "word_third").alias("phrase"), F.col("n").alias("a"), *cut)
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
