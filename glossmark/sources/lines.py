"""Lines of text files with their numbers, however many splits a file is read in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of all lines, numbered from 1 in each file.

    Splits of a file are read by different tasks. A first pass counts the lines of each split, a row a split, and a running sum over a file's splits
    tells with which number each begins; the second pass adds a line's place in its split, which is that of its row in the task. Lines aren't
    shuffled. Both passes must cut files alike: settings of file splits must not change between planning and running."""
    at = F.monotonically_increasing_id().alias("at__")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start__"), at, F.col("value").alias("line"))
    splits = lines.groupBy("file", "start__").agg(F.min("at__").alias("first__"), F.count(F.lit(1)).alias("n__"))
    before = F.sum("n__").over(W.partitionBy("file").orderBy("start__").rowsBetween(W.unboundedPreceding, -1))
    begins = splits.select("file", "start__", "first__", F.coalesce(before, F.lit(0)).alias("before__"))
    numbered = lines.join(begins, ["file", "start__"])
    return numbered.select("file", (F.col("at__") - F.col("first__") + F.col("before__") + 1).alias("line_no"), "line")


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of the lines that aren't JSON objects, blank ones aside."""
    kind = F.schema_of_variant(F.try_parse_json("line"))
    return numbered_lines(spark, path).where((F.trim("line") != "") & ~F.coalesce(kind.startswith("OBJECT"), F.lit(False)))


def first_bad(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): the first bad line of each file that has one."""
    return bad_lines(spark, path).groupBy("file").agg(F.min("line_no").alias("line_no"), F.min_by("line", "line_no").alias("line"))


class BadLine(ValueError):
    """A line that isn't an object, with its file and number."""

    def __init__(self, file: str, line_no: int, line: str):
        super().__init__(f"{file}, line {line_no}: not a JSON object: {line[:200]}")
        self.file, self.line_no = file, line_no


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A row a line. Fails, before anything is read for use, with the file and number of the first line that is no object: of the first file by
    name that has one."""
    worst = first_bad(spark, path).orderBy("file").take(1)
    if worst:
        raise BadLine(*worst[0])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
