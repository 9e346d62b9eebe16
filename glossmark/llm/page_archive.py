"""Pages as WARC records, a payload that several have in full once."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from glossmark.llm.exact_dedup import exact_dedup
from glossmark.llm.warc import read_warc, write_warc

RECORD_PREFIX, RECORD_SUFFIX = "<urn:page:", ">"


@F.arrow_udf(StringType())
def base32(digest: pa.Array) -> pa.Array:
    """Hex to upper-case base32."""
    return pa.array([None if x is None else base64.b32encode(bytes.fromhex(x)).decode() for x in digest.to_pylist()], pa.string())


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> None:
    """A record for each row of pages, written under path; the payload is the html in UTF-8, null as empty.

    Of rows whose payloads are equal, by SHA-256, and have min_bytes at least, that with the largest id is a response and the
    others are revisits of it; all others are responses. Only rows whose digest a Bloom filter takes for a repeated one are shuffled.
    Rows that repeat an id are told apart by their columns; an id that is null is smaller than all others. Other columns of
    pages, whatever their names, are not read. An empty table gives no records."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"), html.alias("html"))
    rows = rows.withColumns({"digest": F.coalesce(F.sha2("html", 256), F.lit("")), "sha1": F.sha1("html")}).withColumn("payload_length", F.octet_length("html").cast("long"))
    small, large = rows.where(F.col("payload_length") < min_bytes), rows.where(F.col("payload_length") >= min_bytes)
    judged = exact_dedup(large, "id", "digest", keep="max")
    judged = judged.unionByName(small.withColumns({"keep_id": F.col("id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})) if min_bytes else judged
    name = lambda c: F.concat(F.lit(RECORD_PREFIX), F.coalesce(c.cast("string"), F.lit("")), F.lit(RECORD_SUFFIX))
    records = judged.select(
        name(F.col("id")).alias("record_id"),
        F.when(F.col("kept"), "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        F.when(~F.col("kept"), name(F.col("keep_id"))).alias("refers_to"),
        base32("sha1").alias("payload_digest"),
        "payload_length",
        F.when(F.col("kept"), F.col("html").cast("binary")).alias("payload"),
    )
    write_warc(records, path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records that archive_pages wrote under path.

    Two scans, each with its record type pushed down: a scan decides on a record's headers, before the rest of it is decompressed.
    Responses are decoded and held against their digest; of revisits nothing but headers is read."""
    responses = read_warc(spark, path, payload="false", verify="true").where("record_type = 'response'")
    revisits = read_warc(spark, path, payload="false").where("record_type = 'revisit'")
    return archived_pages(responses).unionByName(archived_pages(revisits))


def archived_pages(archive: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records that archive_pages wrote."""
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    as_long = lambda c: F.when(F.length(number(c)) > 0, number(c)).cast("long")
    return archive.select(as_long("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", as_long("refers_to").alias("refers_to"))
