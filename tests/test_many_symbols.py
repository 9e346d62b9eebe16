import datetime

from glossmark.plans import market


def test_no_symbol_is_left_out(spark, tmp_path):
    day = datetime.datetime(1995, 1, 2)
    orders = [(f"S{i:04d}", day, 100.0 + i) for i in range(1005)]
    spark.createDataFrame(orders, "o_orderpriority string, o_orderdate timestamp, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r.doc_id, r.symbol): r.close for r in market.asof_snapshot(spark, str(tmp_path)).collect()}
    assert found == {(d, s): c for d in (1, 2) for s, _, c in orders}
