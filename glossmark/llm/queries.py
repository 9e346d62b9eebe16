"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.llm import ann, ball_tree, bpe_codec, dart_minhash, exact_dedup, hat_trie, invertible_sketch, langid, packing, page_archive, substring, token_counts, url_filter
from glossmark.llm.common import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = exact_dedup.with_digest(_table(spark, sf_dir, "documents")).select("doc_id", "text_sha256")
    # The texts are read once: 70 bytes a document are all that the two passes need here.
    return exact_dedup.exact_dedup(exact_dedup.written(docs, "digests"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "mixture")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    page_archive.archive_pages(_table(spark, sf_dir, "pages"), path)
    return page_archive.read_pages(spark, path)


#: Base32 of the digest: each five hex digits are four characters.
OP3_SQL = """
WITH d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY sha256(h)) AS top FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - i % 4 * 5)::INT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def _op4_sql(limits: url_filter.TreeLimits = url_filter.TreeLimits()) -> str:
    """The same tree in SQL, one level after the other, whatever their number."""
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, int(a == "block")) for a, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    label = "CASE " + " ".join(f"WHEN {f} THEN {b}" for f, _, b in fits) + " END"
    return rf"""WITH RECURSIVE parts AS (
  SELECT page_id, CASE WHEN contains(u, '://') THEN translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(u, '://') THEN regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
  FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)),
r AS (
  SELECT page_id, host, path, {rule} AS rule, {label} AS blocked, '' AS template, 0 AS k,
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda e: CASE WHEN regexp_matches(e, '^[0-9]+$') THEN '{{n}}' WHEN regexp_matches(e, '^[0-9]{{4}}-[0-9]{{2}}(-[0-9]{{2}})?$') THEN '{{date}}'
      WHEN regexp_matches(e, '^[0-9]+\.[A-Za-z]{{1,5}}$') THEN '{{n}}.' || regexp_extract(e, '\.(.*)$', 1) WHEN regexp_matches(e, '^[0-9a-fA-F-]{{16,}}$') THEN '{{hex}}' ELSE e END) AS s
  FROM parts
  UNION ALL
  SELECT * FROM (
    WITH g AS (SELECT *, s[k + 1] AS step FROM r WHERE len(s) > k),
    c AS (SELECT host, template, step, count(*) AS n, count(blocked) AS labelled, coalesce(sum(blocked), 0)::DOUBLE AS bad FROM g GROUP BY ALL),
    w AS (SELECT host, template, count(*) >= {limits.min_children} AND count(*) >= {limits.variable_share} * sum(n) AS variable FROM c GROUP BY ALL),
    o AS (SELECT *, lag(labelled) OVER v AS n0, lag(bad) OVER v AS bad0, (bad0 + bad) / (n0 + labelled) AS p FROM (SELECT host, template, labelled, bad, count(*) AS alike FROM c WHERE labelled >= {limits.min_labelled} GROUP BY ALL)
      WINDOW v AS (PARTITION BY host, template ORDER BY bad / labelled, labelled)),
    h AS (SELECT *, sum(CASE WHEN abs(bad / labelled - bad0 / n0) > {limits.z} * sqrt(p * (1 - p) * (1 / n0 + 1 / labelled)) THEN 1 ELSE 0 END) OVER (PARTITION BY host, template ORDER BY bad / labelled, labelled ROWS UNBOUNDED PRECEDING) AS grp FROM o),
    m AS (SELECT *, sum(alike) OVER (PARTITION BY host, template, grp) AS members FROM h)
    SELECT g.page_id, g.host, g.path, g.rule, g.blocked, g.template || '/' || CASE WHEN w.variable THEN '*' WHEN m.members > 1 THEN '~' || (m.grp + 1)::INT ELSE g.step END AS template, g.k + 1 AS k, g.s
    FROM g JOIN c ON g.host = c.host AND g.template = c.template AND g.step = c.step JOIN w ON g.host = w.host AND g.template = w.template
      LEFT JOIN m ON g.host = m.host AND g.template = m.template AND c.labelled = m.labelled AND c.bad = m.bad)),
e AS (SELECT * FROM r WHERE len(s) = k),
p AS (SELECT host, template, (coalesce(sum(blocked), 0) + 1) / (count(blocked) + 2) >= {limits.purity} AS rejected FROM e GROUP BY ALL)
SELECT page_id, host, path, rule, CASE WHEN coalesce(blocked, rejected::INT) = 1 THEN 'block' ELSE 'allow' END AS verdict, template
FROM e JOIN p USING (host, template)"""


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH w AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents)),
k AS (SELECT doc_id, pos, word, CASE WHEN count(*) OVER a = 13 THEN string_agg(word, ' ') OVER a END AS run FROM w WINDOW a AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
m AS (SELECT doc_id, pos, word, (run IS NOT NULL AND min(doc_id) OVER (PARTITION BY run) < doc_id)::INT AS late FROM k),
c AS (SELECT doc_id, pos, word, max(late) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM m)
SELECT d.doc_id, count(word) AS n_words, coalesce(sum(gone), 0)::BIGINT AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0), '')) AS kept_sha256
FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id
"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(_table(spark, sf_dir, "embeddings"), lambda id_: id_ % 20 == 0)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_OP11_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_OP11_TERMS} AS t FROM documents),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_OP11_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
p AS (SELECT r, doc_id, len(t)::BIGINT AS n, term, tf FROM d JOIN (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL) USING (r)),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
c AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
      FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hat_trie.phrases(_table(spark, sf_dir, "documents"))


def _op12_score(left: str, right: str) -> str:
    return f"((1000000::HUGEINT * t.f * t.f) // ({left}::HUGEINT * {right}))::BIGINT"


OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT r, lang, generate_subscripts(pieces, 1) AS k, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS words FROM d),
w AS (SELECT r, lang, k, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM p),
g AS (SELECT lang, w AS w1, lead(w) OVER x AS w2, lead(w, 2) OVER x AS w3 FROM w WINDOW x AS (PARTITION BY r, k ORDER BY pos)),
one AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cover AS (SELECT lang, w1, w2, max(f) AS most FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
c AS (
  SELECT lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r, {_op12_score("x.f", "y.f")} AS score
  FROM two t JOIN one x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM one) y USING (lang, w2) LEFT JOIN cover USING (lang, w1, w2) WHERE most IS NULL OR 100 * most < 50 * t.f
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM (
    SELECT lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l1, tail.f AS r1, head.f AS l2, z.f AS r2, {_op12_score("x.f", "tail.f")} AS s1, {_op12_score("head.f", "z.f")} AS s2
    FROM three t JOIN one x USING (lang, w1) JOIN (SELECT lang, w1 AS w3, f FROM one) z USING (lang, w3) JOIN two head USING (lang, w1, w2) JOIN (SELECT lang, w1 AS w2, w2 AS w3, f FROM two) tail USING (lang, w2, w3))),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT lang, rank, phrase, a, l, r, n, score FROM k JOIN (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang) USING (lang) WHERE rank <= 2000
"""


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invertible_sketch.fingerprints(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_language_id": op2_language_id,
        "op3_warc": op3_warc,
        "op4_url_filter": op4_url_filter,
        "op5_bpe_codec": op5_bpe_codec,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_token_counts": op8_token_counts,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_nearest_neighbours": op10_nearest_neighbours,
        "op11_ranked_search": op11_ranked_search,
        "op12_phrases": op12_phrases,
        "op13_fingerprints": op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op3_warc": OP3_SQL, "op4_url_filter": _op4_sql(), "op7_substring_dedup": OP7_SQL, "op11_ranked_search": OP11_SQL, "op12_phrases": OP12_SQL}
