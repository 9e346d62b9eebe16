"""What the jobs leave behind: JSONL, long CSV, one document an entity, Markdown, request batches for language models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.operators.sync import running_sum


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_document(df: DataFrame, path: str) -> None:
    """Each row as an indented JSON document; Spark sorts no keys, so they stand in the columns' order."""
    df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value")).write.mode("overwrite").text(path)


def manifest(df: DataFrame, name: str, key: str, outputs: dict[str, str]) -> DataFrame:
    """One row that tells what a job wrote: its name and time, the rows and distinct keys, and where its outputs are."""
    paths = F.create_map(*[F.lit(x) for kv in outputs.items() for x in kv]) if outputs else F.create_map().cast("map<string, string>")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys")).select(F.lit(name).alias("job"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("written_at"), "rows", "keys", paths.alias("outputs"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_by_entity(df: DataFrame, key: str, path: str) -> None:
    """A folder of JSON for each entity; those of entities that are gone go too."""
    df.repartition(key).write.mode("overwrite").partitionBy(key).json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def markdown(title: Column, meta: dict[str, Column], body: Column) -> Column:
    """A document with frontmatter; empty values are left out."""
    lines = [F.when(F.coalesce(v.cast("string"), F.lit("")) != "", F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in meta.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n# "), title, F.lit("\n\n"), body, F.lit("\n"))


def transcript_lines(segments: Column) -> Column:
    """array<struct<seconds, text>> as `[hh:mm:ss] text` lines."""
    from glossmark.functions.times import clock

    return F.array_join(F.transform(segments, lambda s: F.concat(F.lit("["), clock(s["seconds"]), F.lit("] "), F.trim(s["text"]))), "\n")


def request_line(id_: str, prompt: Column, style: str = "chat", model: str = "model", max_tokens: int = 4096) -> Column:
    """A JSON line in one of three batch formats: chat, messages or plain."""
    said = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))
    key = F.col(id_).cast("string").alias("custom_id")
    body = F.struct(F.lit(model).alias("model"), F.lit(max_tokens).alias("max_tokens"), said.alias("messages"))
    if style == "chat":
        line = F.struct(key, F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"))
    elif style == "messages":
        line = F.struct(key, body.alias("params"))
    elif style == "plain":
        line = F.struct(key, prompt.alias("prompt"))
    else:
        raise ValueError(f"unknown style {style}")
    return F.to_json(line)


def request_lines(df: DataFrame, id_: str, prompt: Column, style: str = "chat", model: str = "model", max_tokens: int = 4096) -> DataFrame:
    """(value): a JSON line for each row, in one of three batch formats: chat, messages or plain."""
    return df.select(request_line(id_, prompt, style, model, max_tokens).alias("value"))


def request_batches(lines: DataFrame, order: str, max_bytes: int, value: str = "value") -> DataFrame:
    """lines (order, value) with batch, from 0: files of at most max_bytes each, line ends included, in order. The order should tell lines apart.

    A batch is what begins in one stretch of the running sum of bytes. Stretches are as long as a file may be, less the longest line, so that what
    begins in one ends within max_bytes; no batch depends on the one before, and no task sees all. A longer line than max_bytes is an error."""
    size = (F.octet_length(value) + 1).cast("long")
    longest = lines.agg(F.coalesce(F.max(size), F.lit(0))).first()[0]
    if longest > max_bytes:
        raise ValueError(f"a line has {longest} bytes, a file may have {max_bytes}")
    summed = running_sum(lines, [F.asc(order)], size, "end__")
    return summed.withColumn("batch", F.floor((F.col("end__") - size) / (max_bytes - longest + 1)).cast("long")).drop("end__")


def write_batches(batches: DataFrame, order: str, path: str, value: str = "value") -> None:
    """A folder a batch, with one text file, its lines in order."""
    batches.repartition("batch").sortWithinPartitions("batch", order).select("batch", F.col(value).alias("value")).write.mode("overwrite").partitionBy("batch").text(path)


def report(df: DataFrame, heading: str, columns: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """(value): the first rows as one Markdown table."""
    top = df.orderBy(*order).limit(limit).select(F.struct(*columns).alias("r"))
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(f"r.{c}").cast("string"), F.lit("")) for c in columns]), F.lit(" |"))
    lines = top.agg(F.collect_list(row).alias("rows"))
    head = f"# {heading}\n\n| {' | '.join(columns)} |\n|{'---|' * len(columns)}\n"
    return lines.select(F.concat(F.lit(head), F.array_join("rows", "\n"), F.lit("\n")).alias("value"))
