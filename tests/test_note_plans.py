"""Notes are parsed once a row, however many rules read them."""

from pyspark.sql import functions as F

from glossmark.operators import note_jobs as J
from glossmark.operators import note_rules


def parses(spark, column):
    """How often a text is parsed in the plan of a column over (raw, u)."""
    old = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        return spark.createDataFrame([("{}", "a")], "raw string, u string").select(column)._jdf.queryExecution().optimizedPlan().toString().count("parse_json(raw")
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", old)


def test_rules_parse_a_note_once(spark):
    for rules in (note_rules.FIRST_FORMAT, note_rules.SECOND_FORMAT):
        assert parses(spark, note_rules.validate(_parsed(), rules)) == parses(spark, _parsed()) == 1


def test_a_record_is_parsed_once_where_it_is_located_and_repaired(spark):
    assert parses(spark, note_rules.located(_parsed())) == 1
    assert parses(spark, J.first_format(F.col("u")).repair(note_rules.located(_parsed()))) == 1


def _parsed():
    return F.try_parse_json("raw")
