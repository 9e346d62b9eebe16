"""Keeping tables current: keyed merges, upserts, diffs, queues. Rows carry an ord where order decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossmark.checkpoints import settled


def last_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, by max_by: partial sums keep one row a key and task, so a hot key costs nothing."""
    struct = F.struct(*rows.columns)
    best = rows.groupBy(*keys).agg(F.max_by(struct, F.struct(*order)).alias("row__"))
    return best.select("row__.*")


def full_merge(preferred: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys of both; each column from preferred, or where it is missing or '' there, from other; and which side had the key."""
    a = preferred.select(*keys, *[F.col(c).alias(f"a__{c}") for c in columns], F.lit(True).alias("in_a__"))
    b = other.select(*keys, *[F.col(c).alias(f"b__{c}") for c in columns], F.lit(True).alias("in_b__"))
    both = a.join(b, list(keys), "full")
    kind = F.when(F.col("in_a__") & F.col("in_b__"), "both").when(F.col("in_a__"), "preferred").otherwise("other")
    pick = lambda c, t: F.coalesce(F.nullif(F.col(f"a__{c}"), F.lit("")), F.col(f"b__{c}")) if t == "string" else F.coalesce(f"a__{c}", f"b__{c}")
    types = dict(preferred.dtypes)
    return both.select(*keys, *[pick(c, types[c]).alias(c) for c in columns], kind.alias("kind"))


def keyed_merge(rows: DataFrame, key: str, ord_: str, first_of: Sequence[str], paths: str, last_of: Sequence[str] = ()) -> DataFrame:
    """One row a key: the first non-empty value of each of first_of and the last of each of last_of, by ord, and the distinct paths in the
    order first seen. Paths are made distinct before any is collected, so a key holds each once."""
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(ord_))
    values = [F.min_by(c, filled(c)).alias(c) for c in first_of] + [F.max_by(c, filled(c)).alias(c) for c in last_of]
    seen = rows.groupBy(key, paths).agg(F.min(ord_).alias("seen__")).where(F.coalesce(F.col(paths), F.lit("")) != "")
    listed = F.array_sort(F.collect_list(F.struct("seen__", F.col(paths).alias("p"))))
    found = seen.groupBy(key).agg(F.transform(listed, lambda x: x["p"]).alias(paths))
    empty = F.array().cast("array<string>")
    return rows.groupBy(key).agg(*values).join(found, key, "left").withColumn(paths, F.coalesce(paths, empty))


def upsert_preserving(new: DataFrame, old: DataFrame, key: str, preserved: Sequence[str]) -> DataFrame:
    """new rows, but for preserved columns the old value where there is a non-empty one."""
    kept = old.select(key, *[F.col(c).alias(f"old__{c}") for c in preserved])
    joined = new.join(kept, key, "left")
    return joined.select(key, *[F.coalesce(F.nullif(F.col(f"old__{c}"), F.lit("")), F.col(c)).alias(c) if c in preserved else F.col(c) for c in new.columns if c != key])


def upsert_new_wins(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Old rows overlaid with what new rows give for their key; new keys are added.

    A column that new gives, told by has_<column> where new has that column too, wins even if its value is null or empty."""
    columns = [c for c in old.columns if c != key]
    given = [c for c in columns if c in new.columns]
    has = {c: F.coalesce(F.col(f"has_{c}"), F.lit(False)) if f"has_{c}" in new.columns else F.lit(True) for c in given}
    a = new.select(key, *[F.col(c).alias(f"new__{c}") for c in given], *[has[c].alias(f"has__{c}") for c in given])
    joined = old.join(a, key, "full")
    return joined.select(key, *[F.when(F.col(f"has__{c}"), F.col(f"new__{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in columns])


def recording_status(transcribed: Column, previous: Column, audio: Column) -> Column:
    """done where a transcript is there; else an error or a run that was noted stays; else pending, or missing_audio without an address."""
    waiting = F.when(F.coalesce(audio, F.lit("")) != "", "pending").otherwise("missing_audio")
    return F.when(transcribed, "done").when(previous.isin("error", "running"), previous).otherwise(waiting)


def merge_status(rows: DataFrame, statuses: DataFrame, key: str, columns: Sequence[str], done: Column, error: str) -> DataFrame:
    """rows updated by one status row a key. A column that the status has, told by has_<column>, replaces the value; an empty value
    deletes it; a status that is done clears the error. changed tells whether anything did."""
    s = statuses.select(key, *[F.col(c).alias(f"s__{c}") for c in columns], *[F.col(f"has_{c}").alias(f"h__{c}") for c in columns], done.alias("done__"))
    joined = rows.join(s, key, "left")
    value = {c: F.when(F.col(f"h__{c}"), F.nullif(F.col(f"s__{c}"), F.lit(""))).otherwise(F.col(c)) for c in columns}
    value[error] = F.when(F.coalesce("done__", F.lit(False)), F.lit(None)).otherwise(value.get(error, F.col(error)))
    changed = F.lit(False)
    for c, v in value.items():
        changed = changed | ~v.eqNullSafe(F.nullif(F.col(c), F.lit("")))
    others = [c for c in rows.columns if c != key and c not in value]
    return joined.select(key, *others, *[v.alias(c) for c, v in value.items()], changed.alias("changed"))


def signature_diff(before: DataFrame, after: DataFrame, key: str, signature: str) -> DataFrame:
    """(key, change): added, changed or removed. A key counts as there whatever its signature; null signatures are equal."""
    a, b = (x.select(key, F.col(signature).alias(n), F.lit(True).alias(f"in_{n}")) for x, n in ((before, "before__"), (after, "after__")))
    both = a.join(b, key, "full")
    change = F.when(F.col("in_before__").isNull(), "added").when(F.col("in_after__").isNull(), "removed").when(~F.col("before__").eqNullSafe(F.col("after__")), "changed")
    return both.select(key, change.alias("change")).where("change is not null")


def reconcile(manifest: DataFrame, files: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """The manifest, and a row of defaults for each file it lacks."""
    missing = files.join(manifest.select(key), key, "left_anti")
    return manifest.unionByName(missing.select(*[defaults[c].alias(c) if c in defaults else F.col(c) for c in manifest.columns]))


def newest_first(date: Column, ord_: Column) -> list[Column]:
    """By date, the newest first, a missing one last; of equal dates what stands first in the queue."""
    return [F.desc(F.coalesce(date, F.lit(""))), ord_.asc()]


def running_sum(rows: DataFrame, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """rows with the sum of value over all rows up to and with their own, in the order, whatever their number: ranges of the order are summed up by
    themselves, and each range begins where those before it end. Only the ranges' sums, a row a range, come together. The order should tell all
    rows apart."""
    ranges = settled(rows.repartitionByRange(*order).withColumns({"range__": F.spark_partition_id(), "value__": value}))
    sums = ranges.groupBy("range__").agg(F.sum("value__").alias("sum__"))
    before = F.coalesce(F.sum("sum__").over(W.orderBy("range__").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("range__", before.alias("before__"))
    within = F.sum("value__").over(W.partitionBy("range__").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return ranges.withColumn("in__", within).join(F.broadcast(starts), "range__").withColumn(name, F.col("in__") + F.col("before__")).drop("range__", "value__", "in__", "before__")


def placed(rows: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """rows with their place in the order, from 1."""
    return running_sum(rows, order, F.lit(1), name)


def pending(queue: DataFrame, ord_: str, shards: int, shard: int, ready: Column, done: DataFrame, key: str, date: Column | None = None, limit: int | None = None) -> DataFrame:
    """A worker's share of a queue: the shard is taken by place before any filter, so shares never move. With a limit, the first so
    many of it, newest first where a date is given, else in the queue's order."""
    rows = queue.where(F.pmod(F.col(ord_), F.lit(shards)) == shard).where(ready).join(done.select(key).distinct(), key, "left_anti")
    order = [F.asc(ord_)] if date is None else newest_first(date, F.col(ord_))
    return rows.orderBy(*order).limit(limit) if limit else rows


def due_today(runs: DataFrame, today: Column, changed: DataFrame, waiting: DataFrame, forced: bool = False) -> DataFrame:
    """(due, reason): whether a daily run has work. It has if forced, if no run of today is noted, if sources changed, or if targets wait."""
    one = lambda df, name: df.agg((F.count(F.lit(1)) > 0).alias(name))
    seen = one(runs.where(F.col("checked_date") == today), "checked").crossJoin(one(changed, "changed")).crossJoin(one(waiting, "waiting"))
    reason = F.when(F.lit(forced), "forced").when(~F.col("checked"), "not_checked_today").when(F.col("changed"), "sources_changed").when(F.col("waiting"), "targets_waiting").otherwise("already_checked")
    return seen.select((reason != "already_checked").alias("due"), reason.alias("reason"))


def full_recording(title: Column, seconds: Column, least: int, short_marks: Sequence[str]) -> Column:
    """Not one of the short formats by its title, and long enough."""
    short = F.lit(False)
    for mark in short_marks:
        short = short | F.contains(F.lower(F.coalesce(title, F.lit(""))), F.lit(mark))
    return ~short & (F.coalesce(seconds, F.lit(0)) >= least)


def any_flag(flags: Sequence[Column], words: Sequence[Column], texts: Sequence[Column], id_: Column, word: str, names: Sequence[str], prefix: str) -> Column:
    """Whether a row belongs: a flag is true, its id has the prefix, one of words has the word in any case, or a text one of the names."""
    found = F.coalesce(F.startswith(id_, F.lit(prefix)), F.lit(False))
    for f in flags:
        found = found | F.coalesce(f, F.lit(False))
    found = found | F.contains(F.lower(F.concat_ws(" ", *words)), F.lit(word))
    text = F.concat_ws(" ", *texts)
    for n in names:
        found = found | F.contains(text, F.lit(n))
    return found


def sort_time(*candidates: Column) -> Column:
    """Epoch seconds of the first candidate that can be read, a bare date as its midnight in UTC; 0 if none can."""
    read = [F.unix_timestamp(F.try_to_timestamp(F.when(F.length(c) == 10, F.concat(c, F.lit("T00:00:00Z"))).otherwise(c))) for c in candidates]
    return F.coalesce(*read, F.lit(0).cast("long"))


def content_key(title: Column, day: Column, seconds: Column, drop: Sequence[str] = ("#shorts",), bucket: int = 30) -> Column:
    """What near-copies of an episode share: day, title without marks and white space, and length in buckets."""
    for mark in drop:
        title = F.regexp_replace(title, "(?i)" + mark, "")
    return F.concat_ws("|", F.coalesce(day, F.lit("")), F.regexp_replace(title, r"(?U)\s+", ""), F.floor(F.coalesce(seconds, F.lit(0)) / bucket).cast("string"))


def newest_target(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Which episodes to transcribe next, from rows (id, day, ts, dedicated, seconds, full, done, key): those of the newest day, full ones
    if there are any; the latest of them and its copies; none if one of these is done already. Windows need no single task:
    each step is a one-row aggregate that is broadcast."""
    day = rows.agg(F.max("day").alias("day"))
    newest = rows.join(F.broadcast(day), "day", "left_semi")
    full = newest.agg(F.max("full").alias("any_full"))
    newest = newest.crossJoin(F.broadcast(full)).where("full or not any_full").drop("any_full")
    first = newest.agg(F.max_by("key", F.struct("ts", F.col("dedicated").cast("int"), "seconds", F.negate("id"))).alias("key"))
    copies = newest.join(F.broadcast(first), "key", "left_semi")
    settled = copies.agg(F.max("done").alias("any_done"))
    chosen = copies.crossJoin(F.broadcast(settled)).where("not any_done").drop("any_done")
    return chosen.orderBy(F.desc("ts"), F.desc("dedicated"), F.desc("seconds"), "id").limit(limit) if limit else chosen


def names_of(rows: DataFrame, ids: str, names: DataFrame, key: str) -> DataFrame:
    """rows with category_names for an array of ids: the name, or the id itself where there is none, in order."""
    flat = rows.select(key, F.posexplode(ids).alias("pos__", "id"))
    named = flat.join(names, "id", "left").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos__", F.coalesce("name", F.col("id").cast("string")).alias("n")))).alias("l__"))
    return rows.join(named.select(key, F.transform("l__", lambda x: x["n"]).alias("category_names")), key, "left")


def first_by_key(rows: DataFrame, key: str, ord_: str, limit: int | None = None) -> DataFrame:
    """The first row of each key, in order."""
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), ord_).alias("row__")).select("row__.*")
    return best.orderBy(ord_).limit(limit) if limit else best


def allowed_only(rows: DataFrame, allowed: DataFrame | None, path: str = "path") -> DataFrame:
    """rows whose path the inventory has (allowed: path, any other columns, repeats); all rows if there is no inventory. Null and empty paths are no
    entries, so a row without a path passes only where there is no inventory. The inventory's paths alone are shuffled, each once."""
    if allowed is None:
        return rows
    paths = allowed.select(path).where(F.coalesce(F.col(path) != "", F.lit(False))).distinct()
    return rows.join(paths, path, "left_semi").select(*rows.columns)
