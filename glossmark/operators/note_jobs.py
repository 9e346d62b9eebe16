"""Note jobs end to end: what is still to be written becomes request files, outputs become notes, notes become counts of what is wrong."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmark.checkpoints import settled
from glossmark.operators import note_rules
from glossmark.operators.notes import settle_batches
from glossmark.sources import sinks

#: Messages kept of one note; n_errors counts them all.
MOST_ERRORS = 20

FIRST_STRUCT = "struct<episode: int, date: string, title: string, market_regime: string, topics: array<string>, " + note_rules.FIRST_SCHEMA.split("topics array<string>,", 1)[1].strip().replace(" array<", ": array<") + ">"


@dataclass(frozen=True)
class Format:
    """A note format: its rules, and what brings a note (Variant) and its record's columns nearer to them before they are checked."""

    name: str
    rules: note_rules.Rules
    repair: Callable[[Column], Column] | None = None


def first_format(title: Column, episode: Column | None = None, date: Column | None = None) -> Format:
    """The first format, its notes repaired: what they lack comes from the columns given."""
    nothing = F.lit(None).cast("int")

    def repair(note: Column) -> Column:
        def one(there: Column) -> Column:
            record = F.try_variant_get(there, "$", FIRST_STRUCT)
            fixed = note_rules.repaired(record, nothing if episode is None else episode, F.lit("") if date is None else date, title)
            # null fields must be absent, which JSON text does and a cast to Variant doesn't
            return F.when(there.isNotNull(), F.parse_json(F.to_json(fixed)))

        return note_rules.let(note, one)

    return Format("first", note_rules.FIRST_FORMAT, repair)


SECOND = Format("second", note_rules.SECOND_FORMAT)


def prepare(targets: DataFrame, valid: DataFrame, key: str, prompt: Column, max_bytes: int, style: str = "chat") -> DataFrame:
    """(key, value, batch): request lines of the targets without a valid note, in files below max_bytes and in order of key.

    targets has a key once; keys that are null ask for nothing. Repeated keys of valid count once. valid is often the end of a long job, and the
    lines are read more than once to be batched, so its keys are settled first."""
    open_ = targets.where(F.col(key).isNotNull()).join(settled(valid.select(key).distinct()), key, "left_anti")
    lines = open_.select(key, sinks.request_line(key, prompt, style).alias("value"))
    return sinks.request_batches(lines, key, max_bytes)


def checked(outputs: DataFrame, keys: list[str], record: str, form: Format) -> DataFrame:
    """outputs (keys, record: JSON text) with n_errors and errors (the first MOST_ERRORS); both null where the record holds no note.

    The record is parsed once; an envelope that is no JSON, null or holds none is a missing note."""
    note = note_rules.located(F.try_parse_json(record))
    fixed = note if form.repair is None else form.repair(note)
    found = outputs.withColumn("note__", fixed)
    errors = F.when(F.col("note__").isNotNull(), note_rules.validate(F.col("note__"), form.rules))
    found = found.withColumn("all__", errors)
    return found.select(*keys, F.when(F.col("all__").isNotNull(), F.size("all__")).alias("n_errors"), F.slice("all__", 1, MOST_ERRORS).alias("errors"))


def job(targets: DataFrame, outputs: DataFrame, key: str, order: list[str], record: str, form: Format) -> DataFrame:
    """(key, status, n_errors, errors): each target with its settled note. Of several outputs the last valid one counts, else the last.

    status is valid, invalid, or missing: no output, or none that holds a note. Outputs of no target are left out; a target's
    outputs are brought together by key alone, and of a key with many runs each task keeps one."""
    rows = checked(outputs, [key, *order], record, form)
    valid = F.coalesce(F.col("n_errors") == 0, F.lit(False))
    # a run without a note never stands before one with a note
    last = settle_batches(rows.withColumn("valid__", valid).withColumn("there__", F.col("n_errors").isNotNull()), key, ["there__", *order], "valid__")
    every = targets.select(key).join(last.select(key, "n_errors", "errors"), key, "left")
    status = F.when(F.col("n_errors").isNull(), "missing").when(F.col("n_errors") == 0, "valid").otherwise("invalid")
    return every.select(key, status.alias("status"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"), F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))


def rule_of(error: Column) -> Column:
    """The rule that a message is of: without places in arrays and without the value found."""
    return F.regexp_replace(F.regexp_replace(error, r"\[\d+\]", "[]"), r"(?s)(invalid|missing catalyst|got)(:?) .*$", "$1")


def totals(jobs: DataFrame, by: str) -> DataFrame:
    """(by, target, valid, missing, invalid, rule, notes): the counts of each kind of job, and a row for each rule with the notes that break it.

    One grouping: a job counts under the rules of its messages and, as rule '', itself."""
    rules = F.array_distinct(F.concat(F.array(F.lit("")), F.transform("errors", rule_of)))
    each = jobs.select(by, "status", F.explode(rules).alias("rule"))
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    grouped = each.groupBy(by, "rule").agg(F.count(F.lit(1)).alias("notes"), count("valid"), count("missing"), count("invalid"))
    # one row a rule is left, so the groups are as small as the formats' lists of rules
    whole = grouped.groupBy(by).agg(
        F.max_by(F.struct(F.col("notes").alias("target"), "valid", "missing", "invalid"), F.col("rule") == "").alias("t__"),
        F.filter(F.collect_list(F.struct("rule", "notes")), lambda r: r["rule"] != "").alias("r__"),
    )
    return whole.select(by, "t__.*", F.explode_outer("r__").alias("r__")).select(by, "target", "valid", "missing", "invalid", "r__.rule", "r__.notes")
