import bisect
import hashlib
import random
import re
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from oracle import duck, spark_rows
from tokenizers import Tokenizer

from glossmark.llm import bpe, bpe_codec, common, exact_dedup, long_texts, packing, queries, token_counts

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["a", "Th", "ing", "'s", "'re", "'", "!", "?!", " ", "  ", "\n", "\n\n", "\t", "\xa0", "　", "é", "É", "Σ", "İ", "1", "23", "中", "文字", "ᄀ", "ᅡ", "😀", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "x" * 30, "-" * 20, "​", "́", "ª", "½"]


def odd_texts(n, size, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op3_warc", "op4_url_filter", "op7_substring_dedup"])
def test_against_sql(spark, small, name):
    assert spark_rows(queries.queries()[name](spark, small)) == duck(small, queries.oracle_sql()[name])


@pytest.mark.parametrize("clash", [False, True])
def test_exact_dedup_edges(spark, docs_of, clash):
    texts = ["a  b", "a b", None, "", "a\tb", "c", "c", "long " * 50_000, "long " * 50_000, "a b"]
    df = docs_of(texts, [5, 3, 9, 8, 3, 1, None, 20, 21, 3], clash)
    rows = exact_dedup.exact_dedup(exact_dedup.with_digest(df)).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", r.text or "")].append(r)
    assert len(rows) == len(texts)
    for text, some in groups.items():
        assert sum(r.kept for r in some) == 1
        ids = [r.doc_id for r in some if r.doc_id is not None]
        for r in some:
            assert (r.keep_id, r.group_size, r.text_sha256) == (min(ids), len(some), hashlib.sha256(text.encode()).hexdigest())
            assert not r.kept or r.doc_id == r.keep_id


def test_exact_dedup_empty_and_hot(spark, docs_of):
    assert exact_dedup.exact_dedup(exact_dedup.with_digest(docs_of([]).limit(0))).count() == 0
    rows = exact_dedup.exact_dedup(exact_dedup.with_digest(docs_of(["same"] * 2000 + [f"t{i}" for i in range(1000)]))).collect()
    assert sum(r.kept for r in rows) == 1001 and max(r.group_size for r in rows) == 2000


@pytest.mark.parametrize(("bytes_a_part", "most_parts", "blocks"), [(32 << 20, 8, 12), (8192, 8, 12), (4096, 8, 8), (4096, 1, 1)])
def test_probe_of_large_filters_shuffles_no_rows(spark, docs_of, monkeypatch, bytes_a_part, most_parts, blocks):
    monkeypatch.setattr(common, "MAX_BROADCAST_BYTES", bytes_a_part)
    monkeypatch.setattr(common, "MOST_PARTS", most_parts)
    docs = docs_of([f"text {i}" for i in range(3000)], clash=True)
    held = docs.where("doc_id % 10 = 0")
    assert common.bloom_blocks(12 * common.BLOCK_BITS, 1) == blocks
    filter_ = common.written(common.bloom_filter(held, "text", blocks, 2), "filter")
    probed = common.bloom_probe(docs, "text", filter_, blocks, 2, "may_hold")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = probed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning" not in plan
    rows = probed.collect()
    assert len(rows) == 3000 and probed.columns == [*docs.columns, "may_hold"] and all(r.bloom_map == "clash" for r in rows)
    assert all(r.may_hold for r in rows if r.doc_id % 10 == 0) and sum(r.may_hold for r in rows) < 330


def test_exact_dedup_with_a_filter_in_parts(spark, docs_of, monkeypatch):
    docs = exact_dedup.with_digest(docs_of([f"text {i % 900}" for i in range(1500)] + [f"alone {i}" for i in range(1500)], clash=True))
    want = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect())
    assert want == sorted((i, i % 900 if i < 1500 else i, 1 + (i % 900 < 600) if i < 1500 else 1, i >= 1500 or i < 900) for i in range(3000))
    monkeypatch.setattr(common, "MAX_BROADCAST_BYTES", 4 * 4096)
    monkeypatch.setattr(exact_dedup, "BITS_PER_SLOT", 1024)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()) == want
    # a filter that may not grow holds too much, and the rows that it takes for repeated ones are settled all the same
    monkeypatch.setattr(common, "MOST_PARTS", 1)
    monkeypatch.setattr(exact_dedup, "HASHES", 200)
    probed = exact_dedup.exact_dedup(docs)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in probed.collect()) == want


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_encoder_is_the_library(file):
    coder = bpe.Encoder(file)
    for t in odd_texts(1500, 40, 1):
        want = coder.library.encode(t, add_special_tokens=False).ids
        assert list(memoryview(coder.encode(t)).cast("I")) == want and coder.count(t) == len(want)
        assert coder.decode(coder.encode(t)) == coder.library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_joins_and_splices_are_exact(file):
    join = bpe.TreeJoin(bpe.Encoder(file))
    rnd = random.Random(2)
    long = ["".join(rnd.choice("abcdefgh") for _ in range(3000)), "ab" * 2000, "a" * 3000, "!?" * 2000, "".join(rnd.choice("中文字漢語") for _ in range(2000)), " " * 2000, "1" * 2000, *odd_texts(20, 1500, 3)]
    for size, window in ((2048, 64), (40, 8)):
        join.LEAF_CHARS, join.WINDOW_CHARS = size, window
        for t in long:
            want = join.encoder.library.encode(t, add_special_tokens=False).ids
            assert list(memoryview(join.encode(t)).cast("I")) == want
            if size > 40:
                for overlap in (30, 200):
                    done, at = None, 0
                    for at in range(0, len(t), 700):
                        piece = join.leaf(t[at : at + 700 + overlap])
                        done = piece if done is None else join.spliced(done, piece, len(done[0]) - at)
                    assert done is None or done[1].tolist() == want


@pytest.mark.parametrize("part_chars", [50, 65536])
def test_codec_counts_and_pieces(spark, docs_of, part_chars):
    texts = [None, "", *odd_texts(60, 60, 4), "word " * 9000, "word " * 9000]
    ids = [*range(len(texts) - 1), len(texts) - 2]
    df = docs_of(texts, ids, clash=True)
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    want = sorted((i, word.encode(t or "", add_special_tokens=False).ids) for i, t in zip(ids, texts, strict=True))
    found = sorted(bpe_codec.encode_and_decode(df, WORD, part_chars=part_chars).collect())
    assert [(r.doc_id, list(struct.unpack(f"<{r.n_tokens}I", r.ids))) for r in found] == want
    assert [r.decoded for r in found] == [word.decode(x, skip_special_tokens=False) for _, x in want]
    counts = sorted(tuple(r) for r in token_counts.token_counts(df, BYTE, part_chars=part_chars, overlap=20).collect())
    assert counts == sorted((i, len((t or "").encode()), len(byte.encode(t or "", add_special_tokens=False).ids)) for i, t in zip(ids, texts, strict=True))
    assert bpe_codec.encode_and_decode(df.limit(0), WORD).count() == 0 and token_counts.token_counts(df.limit(0), BYTE).count() == 0


@pytest.mark.parametrize(("leaf", "overlap"), [(2048, 256), (40, 10), (16, 6)])
@pytest.mark.parametrize("file", [WORD, BYTE])
def test_trees_and_splices_of_whole_texts(file, leaf, overlap, monkeypatch):
    monkeypatch.setattr(bpe.TreeJoin, "LEAF_CHARS", leaf)
    monkeypatch.setattr(bpe.Splices, "OVERLAP_CHARS", overlap)
    coder = bpe.Encoder(file)
    rnd = random.Random(6)
    texts = [*odd_texts(60, 6000 if leaf == 2048 else 300, 7), " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9))) for _ in range(3000)), "ab" * 3000, " " * 5000, "!?" * 3000, "  a" * 3000, "x" * 5000 + " y " + "z" * 5000, "\n\n " * 2000]
    for t in texts:
        want = coder.library.encode(t, add_special_tokens=False).ids
        assert list(memoryview(coder.encode(t)).cast("I")) == want and coder.count(t) == len(want)


@pytest.mark.parametrize("name", ["op5_bpe_codec", "op8_token_counts"])
def test_registered_queries_against_the_library(spark, small, tmp_path, name):
    """The whole table, and texts of 70,000 and 1,000,000 characters, with and without white space, at production settings."""
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghé") for _ in range(rnd.randrange(1, 10))) for _ in range(5000)]
    long = [" ".join(rnd.choice(words) for _ in range(n // 6))[:n] for n in (70_000, 1_000_000)] + ["".join(rnd.choice("abcdefgh") for _ in range(140_000)), "\n \n" * 40_000, "中文字" * 30_000]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame([(10**6 + i // 2, t, None, None, None) for i, t in enumerate([x for t in long for x in (t, t)])], docs.schema)
    docs.unionByName(extra).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(queries.queries()[name](spark, str(tmp_path)).collect())
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    want = []
    for r in docs.unionByName(extra).collect():
        t = r.text or ""
        if name == "op5_bpe_codec":
            ids = word.encode(t, add_special_tokens=False).ids
            want.append((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(word.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        else:
            n = len(byte.encode(t, add_special_tokens=False).ids)
            want.append((r.doc_id, len(t.encode()), n, n > 1024))
    assert [tuple(r) for r in rows] == sorted(want)


def test_parts_cover_texts(spark, docs_of):
    df = docs_of(["abcdefghij"]).selectExpr("doc_id AS id", "text")
    assert [r.text for r in long_texts.parts_of(df, 4, 2).orderBy("part").collect()] == ["abcdef", "efghij", "ij"]
    # Code points of any width, line ends and parts far longer than a stack is deep.
    text = "w\u00f6rd \U0001f600\r\n\u2028" * 40_000
    cut = [r.text for r in long_texts.parts_of(docs_of([text]).selectExpr("doc_id AS id", "text"), 65536, 300).orderBy("part").collect()]
    assert cut == [text[i : i + 65536 + 300] for i in range(0, len(text), 65536)]
    assert long_texts.parts_of(docs_of(["", None]).selectExpr("doc_id AS id", "text"), 4, 2).count() == 0


def sequences(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for some in by.values():
        some.sort()
        assert some[0][0] == 0 and sum(n for _, n in some) <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(some, some[1:], strict=False))
    return len(by)


def test_packing_matches_the_library_and_the_bound(spark, small):
    rows = queries.queries()["op9_best_fit_packing"](spark, small).collect()
    word = Tokenizer.from_file(WORD)
    want = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = [*word.encode(r.text or "", add_special_tokens=False).ids, 1]
        want |= {(r.doc_id, i // 4096): (i, len(ids[i : i + 4096]), zlib.crc32(struct.pack(f"<{len(ids[i : i + 4096])}I", *ids[i : i + 4096]))) for i in range(0, len(ids), 4096)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert sequences(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_packing_edges(spark, docs_of):
    rows = packing.pack_documents(docs_of([None, "", "one two three", "one two three"], [1, 2, 3, 3], clash=True), WORD, capacity=3).collect()
    sequences(rows, 3)
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in rows) == [(1, 0, 0, 1), (2, 0, 0, 1), (3, 0, 0, 3), (3, 0, 0, 3), (3, 1, 3, 1), (3, 1, 3, 1)]
    assert packing.pack_documents(docs_of(["x"]).limit(0), WORD).count() == 0


def test_plan_fills_exactly():
    plan = packing.Plan({6: 2, 4: 1, 3: 2, 1: 1, 2: 1}, 10)
    used = [sum(n) for t, n in plan.patterns for _ in range(t)]
    assert sum(used) == 25 and len(used) == 3
    triple = packing.Plan({7: 1, 1: 3}, 10)
    assert [(t, sorted(n)) for t, n in triple.patterns] == [(1, [1, 1, 1, 7])]
    rnd = random.Random(3)
    for _ in range(30):
        lengths = [rnd.randrange(1, 101) for _ in range(200)]
        plan = packing.Plan({n: lengths.count(n) for n in lengths}, 100)
        packed = sorted(n for t, some in plan.patterns for n in some * t)
        assert packed == sorted(lengths) and all(sum(some) <= 100 for _, some in plan.patterns)
        rooms = []
        for n in sorted(lengths, reverse=True):
            at = bisect.bisect_left(rooms, n)
            bisect.insort(rooms, (rooms.pop(at) if at < len(rooms) else 100) - n)
        assert sum(t for t, _ in plan.patterns) <= len(rooms)  # no more than plain best fit
