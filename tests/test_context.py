"""The asset context reads the texts once."""

from glossmark.operators import mentions as M
from glossmark.plans import jobs, search


def test_one_scan_and_one_exchange(spark, small):
    plan = jobs.asset_mentions(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    after = jobs.asset_context(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in after
    assert after.count("Exchange ") <= 12


def test_one_scan_finds_what_the_joins_find(spark, small):
    keys = ["doc_id"]
    known = spark.createDataFrame(sorted({(s,) for s, _ in search.ALIASES}), "symbol string")
    direct = search._direct(spark, small)
    found = M.united(direct, search.sectors_seen(spark, small)[0], keys)
    found = M.united(found, M.observed_symbols(search.observed(spark, small), known, keys), keys)
    found = M.united(found, M.proxy_minus_direct(search._proxies(spark, small), direct, keys), keys)
    want = sorted(tuple(r) for r in search._flat(found).select("doc_id", "symbol", "matched_aliases", "sources").collect())
    assert sorted(tuple(r) for r in jobs.asset_mentions(spark, small).select("doc_id", "symbol", "matched_aliases", "sources").collect()) == want
