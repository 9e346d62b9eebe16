import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from oracle import duck, spark_rows
from pyspark.sql import functions as F

from glossmark.llm import ann, dart_minhash, langid, page_archive, queries, substring, url_filter, warc, words

TEXTS = [None, "", "one two three", "one two three", " \t\n", "x" * 200_000]


def table(spark, small, name):
    return spark.read.parquet(f"{small}/{name}.parquet")


def split(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def test_words_split_on_ascii_space_only():
    texts = ["a b\x0bc", "a\xa0b\x85c d", "\x1ca b", "　x y"]
    assert [words.split(t) for t in texts] == [split(t) for t in texts] and words.split(None) == []


def test_language_accuracy_on_the_held_out_fold(spark, small):
    labels = {r.doc_id: r.lang for r in table(spark, small, "documents").collect()}
    rows = queries.queries()["op2_language_id"](spark, small).collect()
    assert len(rows) == len(labels)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == labels[r.doc_id] for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and abs(sum(r.mixture.values()) - 1) < 1e-6 for r in rows if r.lang_pred != "und")


def brute_mixture(model, text):
    """The same inference over dicts of trigrams, in plain Python: every language is tried in order of its share."""
    if text is None or not re.search(r"[^\W\d_]", text):
        return {}
    raw = b" ".join(re.sub(rb"[^A-Za-z\x80-\xff]", b" ", text.lower().encode()).split())
    grams = Counter(raw[i : i + 3] for i in range(len(raw) - 2))
    if not grams:
        return {model.languages[0]: 1 / len(model.languages)}
    slot = lambda g: ((g[0] * 257 * 257 + g[1] * 257 + g[2]) * 2654435761 % 2**32) >> 16
    counts = Counter()
    for g, n in grams.items():
        counts[slot(g)] += n
    p = {k: {g: float(model.probability[k, g]) for g in counts} for k in range(len(model.languages))}
    total = sum(counts.values())

    def em(some):
        share = {k: 1 / len(some) for k in some}
        for _ in range(model.rounds):
            new = dict.fromkeys(some, 0.0)
            for g, n in counts.items():
                whole = sum(share[k] * p[k][g] for k in some)
                for k in some:
                    new[k] += share[k] * p[k][g] * n / whole
            new = {k: v / total for k, v in new.items()}
            done = max(abs(new[k] - share[k]) for k in some) < 1e-4
            share = new
            if done:
                break
        return share, sum(n * math.log(sum(share[k] * p[k][g] for k in some)) for g, n in counts.items())

    single = {k: sum(n * math.log(p[k][g]) for g, n in counts.items()) for k in p}
    chosen = [max(single, key=lambda k: (single[k], -k))]
    best, share = single[chosen[0]], {chosen[0]: 1.0}
    if len(p) > 1:
        everything, _ = em(list(p))
        for other in sorted(p, key=lambda k: -everything[k]):
            if other in chosen:
                continue
            new, likelihood = em([*chosen, other])
            if likelihood - best <= model.penalty * math.log(total + 1):
                break
            chosen, best, share = [*chosen, other], likelihood, new
    return {model.languages[k]: v for k, v in share.items()}


def test_language_mixtures_against_brute_force(spark, small):
    """The registered query, and texts that mix languages, against the same EM over dicts."""
    docs = table(spark, small, "documents")
    model = langid.fit(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.queries()["op2_language_id"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_mixture(model, texts[r.doc_id])
        assert r.mixture.keys() == want.keys() and all(abs(r.mixture[k] - want[k]) < 1e-6 for k in want)
        assert (r.lang_pred, r.score) == ("und", 0.0) if not want else r.lang_pred == min(want, key=lambda k: (-round(want[k], 9), k)) and abs(r.score - max(want.values())) < 1e-6
    some = [t for t in texts.values() if t and 300 < len(t) < 3000][:12]
    for a, b in zip(some, some[1:], strict=False):
        text = a + " " + b[: len(b) // 3]
        want, mine = brute_mixture(model, text), model.mixture(text)
        assert mine.keys() == want.keys() and all(abs(mine[k] - want[k]) < 1e-6 for k in want)


def test_language_ties_and_dirty_labels(spark, docs_of):
    tied = langid.LanguageModel(["aa", "bb"], np.full((2, 1 << langid.TABLE_BITS), 1 / (1 << langid.TABLE_BITS)))
    assert tied.predict("some text")[0] == "aa"
    docs = docs_of(["plain text"] * 50, range(50), langs={i: f"l{i}" for i in range(40)})
    model = langid.fit(docs, languages=3)
    assert len(model.languages) == 3 and "en" in model.languages


def test_language_edges(spark, small, docs_of):
    model = langid.fit(table(spark, small, "documents"))
    english, french = (next(r.text for r in table(spark, small, "documents").where(f"lang = '{k}' and n_chars > 2000").limit(1).collect()) for k in ("en", "fr"))
    found = {r.doc_id: r for r in langid.identify(docs_of([None, "", "12 !?", english, french, english[:1500] + french[:1500], french * 100], clash=True), model).collect()}
    assert [found[i].lang_pred for i in range(5)] == ["und", "und", "und", "en", "fr"] and found[6].lang_pred == "fr"
    assert set(found[5].mixture) == {"en", "fr"} and all(0.3 < v < 0.7 for v in found[5].mixture.values())
    nothing = langid.fit(docs_of(["a"]).where("false"))
    assert {r.lang_pred for r in langid.identify(docs_of(["text"]), nothing).collect()} == {"und"}
    assert langid.identify(docs_of(["a"]).where("false"), model).count() == 0


def test_the_held_out_fold_is_not_learned(spark, docs_of):
    ids = [i for i in range(200) if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert langid.fit(docs_of(["text here"] * len(ids), ids)).languages == []


def classes_of(texts):
    """Brute force: connected pairs of weighted Jaccard 0.8 and more."""
    grams = {}
    for i, t in texts.items():
        w = split(t)
        k = min(5, len(w))
        grams[i] = Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else Counter()
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(texts)
    for n, a in enumerate(order):
        for b in order[:n]:
            x, y = grams[a], grams[b]
            if not x or not y or min(len(x), len(y)) == 0:
                continue
            both = sum((x & y).values())
            if both >= 0.8 * (sum(x.values()) + sum(y.values()) - both):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in texts}


def test_near_duplicates_against_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in table(spark, small, "documents").collect()}
    rows = queries.queries()["op6_near_duplicates"](spark, small).collect()
    want = classes_of(texts)
    assert {r.doc_id: r.class_id for r in rows} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in rows)


def test_near_duplicates_of_a_large_loose_group(spark, docs_of):
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 120):
        w = list(base)
        for _ in range(rnd.randrange(0, 9)):
            w[rnd.randrange(150)] = f"v{rnd.randrange(10**6)}"
        texts[i] = " ".join(w)
    rows = dart_minhash.near_duplicates(docs_of(list(texts.values()))).collect()
    assert {r.doc_id: r.class_id for r in rows} == classes_of(texts)


def test_near_duplicate_edges(spark, docs_of):
    rows = dart_minhash.near_duplicates(docs_of(TEXTS, [4, 3, 2, None, 1, 0], clash=True)).collect()
    found = sorted((r.class_id, r.class_size, r.kept) for r in rows)
    assert found == [(0, 1, True), (1, 1, True), (2, 2, False), (2, 2, True), (3, 1, True), (4, 1, True)]
    assert dart_minhash.near_duplicates(docs_of(["a"]).where("false")).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rnd = random.Random(5)
    a = [f"w{rnd.randrange(400)}" for _ in range(3000)]
    b = a[:2400] + [f"u{rnd.randrange(400)}" for _ in range(600)]
    owner, element = dart_minhash.elements([" ".join(a), " ".join(b), "one", None])
    s = dart_minhash.signatures(owner, element, 4)
    x, y = (set(element[owner == k].tolist()) for k in (0, 1))
    exact = len(x & y) / len(x | y)
    assert abs((s[0] == s[1]).mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / dart_minhash.COORDINATES)
    assert (s[2] != 0).all() and (s[3] == 0).all()
    owner, element = dart_minhash.elements([" ".join(b)])
    assert (dart_minhash.signatures(owner, element, 1)[0] == s[1]).all()


def removed(texts):
    least = {}
    for i in sorted(texts):
        w = split(texts[i])
        for k in range(len(w) - 12):
            least.setdefault(tuple(w[k : k + 13]), i)
    out = {}
    for i, t in texts.items():
        w = split(t)
        gone = set()
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    return out


def test_substring_dedup_against_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in table(spark, small, "documents").collect()}
    rows = queries.queries()["op7_substring_dedup"](spark, small).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == removed(texts)


def test_substring_dedup_of_repeats_and_shifts(spark, docs_of):
    rnd = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    texts = {i: " ".join([f"a{rnd.randrange(10**6)}" for _ in range(rnd.randrange(20))] + passage[rnd.randrange(20) :][: rnd.randrange(10, 25)] + [f"b{rnd.randrange(10**6)}" for _ in range(3)] + ["t"] * rnd.randrange(30)) for i in range(150)}
    rows = substring.remove_repeats(docs_of(list(texts.values()), clash=True)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows} == removed(texts)


def test_substring_dedup_of_one_id_with_two_texts(spark, docs_of):
    """Rows that share an id but not a text are told apart, and don't count against each other."""
    passage = " ".join(f"p{i}" for i in range(20))
    rows = substring.remove_repeats(docs_of([passage, "a b " + passage, passage + " c", "z " * 20], [1, 2, 2, 3])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in rows) == [(1, 20, 0), (2, 21, 20), (2, 22, 20), (3, 20, 0)]


def test_substring_edges(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(30))
    rows = substring.remove_repeats(docs_of([None, "", long, long, long, long, "few words"], [1, 2, 3, 3, 4, None, 5])).collect()
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed) for r in rows)
    assert found == [(-1, 30, 0), (1, 0, 0), (2, 0, 0), (3, 30, 0), (3, 30, 0), (4, 30, 30), (5, 2, 0)]
    assert substring.remove_repeats(docs_of(["a"]).where("false")).count() == 0


def test_warc_round_trip(spark, small):
    pages = {r.page_id: (r.html or "").encode() for r in table(spark, small, "pages").collect()}
    largest = {}
    for k, v in pages.items():
        largest[v] = max(k, largest.get(v, k))
    b32 = lambda v: base64.b32encode(hashlib.sha1(v).digest()).decode()
    want = {k: (len(v), b32(v), "response" if largest[v] == k else "revisit", None if largest[v] == k else largest[v]) for k, v in pages.items()}
    rows = queries.queries()["op3_warc"](spark, small).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == want and len(rows) == len(want)


def test_warc_edges_pushdown_and_splits(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://c", ""), (5, "http://d", "é" * 100_000), (None, "http://e", "same"), (2, "http://b", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("kept", F.lit("clash"))
    path = f"file://{tmp_path}/w"
    page_archive.archive_pages(pages, path)
    archive = warc.read_warc(spark, path)
    found = page_archive.archived_pages(archive).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in found) == {(1, "revisit", 2): 1, (2, "response", None): 1, (2, "revisit", 2): 1, (None, "revisit", 2): 1, (3, "revisit", 4): 1, (4, "response", None): 1, (5, "response", None): 1}
    kept = archive.where("record_type = 'response' and target_uri = 'http://d'")
    assert kept.count() == 1
    assert kept.first().payload == ("é" * 100_000).encode()
    split = warc.read_warc(spark, path, splitBytes="200", payload="false")
    assert split.count() == 7 and split.where("payload is not null").count() == 0
    assert archive.where(F.col("record_type").isin("revisit")).count() == 4
    page_archive.archive_pages(pages.where("false"), f"file://{tmp_path}/empty")
    assert warc.read_warc(spark, f"file://{tmp_path}/empty").count() == 0


def test_warc_splits_around_a_nested_archive_and_long_payloads(spark, tmp_path):
    """An archive as a payload is no start of a range; a payload of 3 MB is one record, in whatever range it begins."""
    row = {"record_type": "response", "record_id": "<urn:page:1>", "target_uri": "http://a", "payload": b"x", "payload_digest": base64.b32encode(hashlib.sha1(b"x").digest()).decode(), "payload_length": 1, "refers_to": None}
    rng = np.random.default_rng(4)
    noise = rng.integers(0, 256, 3_000_000, np.uint8).tobytes()
    nested = b"".join(warc.member(warc.record(row | {"payload": rng.integers(0, 256, 400, np.uint8).tobytes()})) for _ in range(20))
    assert warc.member(nested).count(warc._MEMBER) == 1
    payloads = [nested, noise, b"end"]
    records = [row | {"record_id": f"<urn:page:{i}>", "payload": p, "payload_length": len(p), "payload_digest": base64.b32encode(hashlib.sha1(p).digest()).decode()} for i, p in enumerate(payloads)]
    schema = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary"
    path = f"file://{tmp_path}/w"
    warc.write_warc(spark.createDataFrame([tuple(r[k.split()[0]] for k in schema.split(", ")) for r in records], schema).coalesce(1), path)
    got = warc.read_warc(spark, path, splitBytes="1000", verify="true").orderBy("record_id").collect()
    assert [bytes(r.payload) for r in got] == payloads


def test_warc_skips_what_filters_rule_out(spark, tmp_path):
    """Revisits are read without touching response payloads: a broken response is no error there."""
    row = {"record_type": "response", "record_id": "<urn:page:1>", "target_uri": "http://a", "payload": b"hello", "payload_digest": "WRONG"}
    revisit = {"record_type": "revisit", "record_id": "<urn:page:2>", "target_uri": "http://a", "payload": None, "payload_digest": "X", "payload_length": 5, "refers_to": "<urn:page:1>"}
    (tmp_path / "a.warc.gz").write_bytes(warc.member(warc.record(row)) + warc.member(warc.record(revisit)))
    found = warc.read_warc(spark, f"file://{tmp_path}", verify="true").where("record_type = 'revisit'").collect()
    assert [(r.record_id, r.payload_length) for r in found] == [("<urn:page:2>", 5)]
    with pytest.raises(Exception, match="digest"):
        warc.read_warc(spark, f"file://{tmp_path}", verify="true").collect()


def test_warc_reads_foreign_files(spark, tmp_path):
    row = {"record_type": "response", "record_id": "<urn:x:1>", "target_uri": "http://a", "payload": b"hello", "payload_digest": base64.b32encode(hashlib.sha1(b"hello").digest()).decode()}
    raw = [warc.record(row), warc.record(row | {"record_id": "<urn:x:2>", "payload": b"x" * 5000, "payload_digest": base64.b32encode(hashlib.sha1(b"x" * 5000).digest()).decode()})]
    (tmp_path / "plain.warc").write_bytes(b"".join(raw))
    (tmp_path / "zipped.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in raw))
    got = warc.read_warc(spark, f"file://{tmp_path}", verify="true").where("record_id = '<urn:x:2>'").collect()
    assert [r.payload for r in got] == [b"x" * 5000] * 2
    (tmp_path / "bad.warc").write_bytes(warc.record(row | {"payload_digest": "WRONG"}))
    with pytest.raises(Exception, match="digest"):
        warc.read_warc(spark, f"file://{tmp_path}", verify="true").collect()


def test_url_edges(spark):
    urls = [None, "", "no scheme/en/7", "HTTP://A.EXAMPLE.COM/en/71?q#f", "x://example.com/en/8", "x://notexample.com/en/7", "x://com/en/", "x://h.net/de/", "x://h.net?de/", "a://b://net/de/1", "x://example.net/de/8x", "x://h.org/es"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"host": F.lit(1), "template": F.lit(2)})
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(rows).collect()}
    assert found[0] == found[1] == found[2] == ("", "", None, "allow")
    assert found[3] == ("a.example.com", "/en/71", "example.com/en/7", "allow")
    assert found[4][2:] == ("com/en/", "block") and found[5][2:] == ("com/en/", "block") and found[6][2:] == ("com/en/", "block")
    assert found[7][2:] == ("net/de/", "block") and found[8][:2] == ("h.net", "") and found[8][3] == "allow"
    assert found[9][:2] == ("b:", "//net/de/1") and found[10][2] == "example.net/de/8" and found[11][2:] == (None, "allow")
    assert url_filter.judge_urls(rows.where("false")).count() == 0


def test_url_templates_generalise_and_reject(spark):
    rows = [(f"h{i}", "site", f"/shop/{i}/buy", 1) for i in range(30)] + [("q", "site", "/shop/99/buy", None)] + [(f"u{i}", "site", f"/user/name{i}", None) for i in range(20)] + [(f"d{i}", "site", f"/{k}/x", v) for i in range(12) for k, v in (("aa", 0), ("bb", 0))]
    df = spark.createDataFrame(rows, "page_id string, host string, path string, blocked int")
    grown = {r.shape: r.template for r in url_filter.tree(df).collect()}
    found = {r.page_id: grown[r.shape] for r in url_filter.shapes(df).collect()}
    assert found["q"] == "/shop/{n}/buy" and found["u3"] == "/user/*"


def test_url_paths_of_any_depth(spark):
    """Paths that part at the thirtieth segment are told apart there; a path of 100,000 segments, and one of a million characters, are paths like others."""
    head = "/".join(f"s{k}" for k in range(30))
    paths = [f"/{head}/left/x", f"/{head}/right/x", f"/{head}", "/" + "/".join(["a"] * 100_000), "/" + "z" * 1_000_000, "/" + "/".join(["c"] * 500) + "/d", "/" + "/".join(["c"] * 500) + "/e"]
    df = spark.createDataFrame([("h", p, None) for p in paths], "host string, path string, blocked int")
    found = {r.shape: r.template for r in url_filter.tree(df).collect()}
    assert {"h" + p: p for p in paths} == found


def test_url_branches_merge_pairwise(spark):
    """Two clusters of branches, nearly all blocked and nearly none, are two branches, not one and not each alone."""
    rows = []
    for seg, bad in (("aa", 19), ("bb", 20), ("cc", 1), ("dd", 0), ("ee", None)):
        rows += [("h", f"/{seg}/p", None if bad is None else int(i < bad)) for i in range(20)]
    found = {r.shape: r.template for r in url_filter.tree(spark.createDataFrame(rows, "host string, path string, blocked int")).collect()}
    assert found["h/aa/p"] == found["h/bb/p"] == "/~2/p" and found["h/cc/p"] == found["h/dd/p"] == "/~1/p" and found["h/ee/p"] == "/ee/p"


def test_url_trees_against_sql(spark, tmp_path):
    """Random trees, deep and with labels of all kinds, against the recursive SQL."""
    rnd = random.Random(11)
    hosts = ["a.com", "example.com", "b.example.com", "x.net", "example.net", "y.org", "z.io"]
    words_ = ["en", "de", "es", "7", "71", "8", "8x", "shop", "2024-01-02", "3.html", "deadbeefdeadbeef", "~1", "*", "u1", "u2"]
    urls = ["http://" + rnd.choice(hosts) + "".join("/" + (rnd.choice(words_) if rnd.random() < 0.9 else f"v{rnd.randrange(400)}") for _ in range(min(12, int(rnd.expovariate(0.3))))) + rnd.choice(["", "/", "?q", "#f"]) for _ in range(3000)] + [None, "", "none"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert spark_rows(queries.queries()["op4_url_filter"](spark, str(tmp_path))) == duck(str(tmp_path), queries.oracle_sql()["op4_url_filter"])


def test_neighbours_recall_and_edges(spark, small):
    rows = queries.queries()["op10_nearest_neighbours"](spark, small).collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table(spark, small, "embeddings").collect()}
    ids = np.array(sorted(vectors))
    all_ = np.stack([vectors[i] for i in ids])
    found = defaultdict(list)
    for r in rows:
        found[r.query_id].append(r)
    recall = []
    for q in (i for i in ids.tolist() if i % 20 == 0):
        exact = (all_ * vectors[q]).sum(1)
        exact[ids == q] = -np.inf
        top = set(ids[np.lexsort((ids, -exact))[:20]].tolist())
        mine = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1)) and len(mine) == 20
        assert all(abs(r.score - vectors[q] @ vectors[r.vec_id]) < 1e-12 for r in mine)
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(mine, mine[1:], strict=False))
        recall.append(len(top & {r.vec_id for r in mine}) / 20)
    assert np.mean(recall) >= 0.9


def test_few_vectors_are_verified_at_good_recall():
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet", columns=["vec_id", "embedding"])
    ids, all_ = rows["vec_id"].to_numpy(), np.array(rows["embedding"].to_pylist(), float)
    block = ann.Block(ids, all_)
    recall, verified = [], []
    for q in np.flatnonzero(ids % 20 == 0):
        exact = (all_ * all_[q]).sum(1)
        exact[q] = -np.inf
        found, _, seen = block.nearest(ids[q], all_[q], 20)
        recall.append(len(set(ids[np.lexsort((ids, -exact))[:20]].tolist()) & set(found.tolist())) / 20)
        verified.append(seen / len(ids))
    assert np.mean(recall) >= 0.9 and np.mean(verified) <= 0.1


def test_neighbours_of_many_repeated_rows_and_blocks(spark, monkeypatch):
    """Rows that repeat id and vector are dealt out like any others; several blocks and query groups give what one gives."""
    rng = np.random.default_rng(3)
    rows = [(7, [1.0, 0.0, 0.0])] * 3000 + [(i, rng.standard_normal(3).tolist()) for i in range(20, 120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "BLOCK", 500)
    monkeypatch.setattr(ann, "QUERY_GROUP", 2)
    found = ann.nearest_neighbours(df, lambda i: i % 20 == 0, k=3).collect()
    assert Counter(r.query_id for r in found) == {i: 3 for i in range(20, 120, 20)}
    vectors = {i: np.array(v) for i, v in rows}
    for q in range(20, 120, 20):
        exact = sorted(((-float((vectors[i] * vectors[q]).sum()), i) for i, _ in rows if i != q))[:3]
        mine = sorted((r.rank, r.vec_id) for r in found if r.query_id == q)
        assert [i for _, i in mine] == [i for _, i in exact]


def test_neighbour_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 1.0, 1.0]), (9, [-3.0, 0.5]), (None, [1.0, 1.0]), (40, []), (60, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rank": F.lit("c"), "score": F.lit("c"), "id": F.lit("c")})
    found = sorted(tuple(r) for r in ann.nearest_neighbours(df, lambda i: i % 20 == 0).collect())
    assert found == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (0, 4, 9, -3.0), (20, 1, 9, 1.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0)]
    assert ann.nearest_neighbours(df.where("false"), lambda i: i % 20 == 0).count() == 0


def test_many_equal_vectors_go_by_id(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0] if i % 2 else rng.standard_normal(3).tolist()) for i in range(1, 400)] + [(400, [1.0, 2.0, 3.0])]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i == 400).orderBy("rank").collect()
    better = [i for i, v in rows if i != 400 and np.dot(v, [1, 2, 3]) > 14]
    assert [r.vec_id for r in found if r.score == 14.0] == [i for i in range(1, 400, 2)][: 20 - len(better)]


def test_components_of_any_size_have_answers(spark):
    """Whatever doubles can be: products that leave their range are infinite or 0, as plain arithmetic has them, and ids decide."""
    rng = np.random.default_rng(4)
    for size in (1e200, 1e-200, 1e-310, 1e307, 1.0):
        rows = [(i, (rng.standard_normal(4) * size).tolist()) for i in range(1, 61)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest_neighbours(df, lambda i: i % 20 == 0, k=5).collect())
        with np.errstate(all="ignore"):
            want = []
            for q in (20, 40, 60):
                scores = [(float((np.array(v) * rows[q - 1][1]).sum()), i) for i, v in rows if i != q]
                scores.sort(key=lambda x: (np.isnan(x[0]), -x[0], x[1]))
                want += [(q, n + 1, i, s) for n, (s, i) in enumerate(scores[:5])]
        assert [f[:3] for f in found] == [w[:3] for w in want]
        assert all(f[3] == w[3] or np.isnan(w[3]) or abs(f[3] - w[3]) <= 1e-12 * abs(w[3]) for f, w in zip(found, want, strict=True))


@pytest.mark.parametrize("factor", [10, 1000, 1e200])
def test_one_long_vector_does_not_switch_the_method_off(spark, factor, monkeypatch):
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet", columns=["vec_id", "embedding"]).to_pylist()
    rows[7]["embedding"] = [x * factor for x in rows[7]["embedding"]]
    frame = spark.createDataFrame([(r["vec_id"], [float(x) for x in r["embedding"]]) for r in rows], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in ann.nearest_neighbours(frame, lambda i: i % 20 == 0).collect():
        found[r.query_id].add(r.vec_id)
    ids, all_ = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        exact = (all_ * all_[q]).sum(1)
        exact[q] = -np.inf
        recall.append(len(set(ids[np.lexsort((ids, -exact))[:20]].tolist()) & found[ids[q]]) / 20)
    assert np.mean(recall) >= 0.9
    norms = np.log2(np.abs(all_).max(1)) + 0.5 * np.log2(((all_ / np.abs(all_).max(1, keepdims=True)) ** 2).sum(1))
    octave = np.floor(norms - np.median(norms) + 0.5)
    verified = np.zeros(0)
    for o in set(octave.tolist()):
        block = ann.Block(ids[octave == o], all_[octave == o])
        verified = np.r_[verified, [block.nearest(ids[q], all_[q], 20)[2] for q in np.flatnonzero(ids % 20 == 0)[:40]]]
    assert verified.sum() / 40 <= 0.1 * len(ids)


def test_a_shard_is_compared_in_parts():
    """What _probe sorts at a time is a part of a shard, and it finds what one sort of the whole finds."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows, expected = [], []
    for name in range(20):
        h = rng.integers(0, 1 << 22, 50_000).astype(np.uint32) * np.uint32(2654435761)
        owner, bits = rng.integers(0, 100, len(h)).astype(np.uint16), rng.integers(0, 4, (2, len(h))) == 0
        rows.append((0, name, h.astype(np.uint16).tobytes(), (h >> np.uint32(16)).astype(np.uint16).tobytes(), owner.tobytes(), *(np.packbits(x).tobytes() for x in bits)))
        expected += zip([name] * len(h), h.tolist(), owner.tolist(), *bits.tolist(), strict=True)
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    table = pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in substring._ANCHOR_ROW.split(", ")])
    tracemalloc.start()
    answers = substring._probe(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    counts, block, several = Counter(v for _, v, *_ in expected), set(), set()
    for _, v, _, b, s in expected:
        block |= {v} if b else set()
        several |= {v} if s else set()
    found = Counter((n, int(v), int(o)) for n, os, vs in zip(*(answers.column(c).to_pylist() for c in ("pass", "owner", "value")), strict=True) for o, v in zip(np.frombuffer(os, np.uint16), np.frombuffer(vs, np.uint32), strict=True))
    assert found == Counter((n, v, o) for n, v, o, _, _ in expected if v in block and (counts[v] > 1 or v in several))
    assert peak < 45 * len(expected), f"{peak / len(expected):.0f} bytes an entry"


def test_a_worker_keeps_what_one_stage_needs():
    import public_tokenizers

    from glossmark.llm import bpe

    list(words.passes(["a b"]))
    words.hashes(["a", "b"])
    assert words._memo
    bpe.encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not words._memo and bpe._encoder.cache_info().currsize == 1
    list(words.passes(["a b"]))
    assert bpe._encoder.cache_info().currsize == 0
