"""The stream of runs against the batch over the whole log, also after a kill."""

import datetime as dt
import random
import shutil

from glossmark.streaming import supervisor

T0 = dt.datetime(2024, 5, 1)
SCHEMA = "key string, at timestamp, status string, error string"
SILENT = 600


def log_rows(seed, n=120):
    draw, rows, now = random.Random(seed), [], 0
    for _ in range(n):
        now += draw.randint(1, 200)
        key, status = f"k{draw.randrange(6)}", draw.choice(["running", "running", "running", "done", "error", "pending"])
        rows.append((key, T0 + dt.timedelta(seconds=now), status, "broke" if status == "error" else None))
    return rows


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def states(df):
    return sorted((r.key, r.status, r.error, r.attempts, r.at) for r in df.collect())


def run(spark, tmp, name="a"):
    log = spark.readStream.schema(SCHEMA).parquet(f"{tmp}/log")
    query = supervisor.keep_watch(spark, log, SILENT, f"{tmp}/out-{name}", f"{tmp}/state-{name}")
    assert query.awaitTermination(180)
    return supervisor.current(spark.read.option("basePath", f"{tmp}/out-{name}").parquet(f"{tmp}/out-{name}/batch=*"))


def test_stream_comes_to_what_the_batch_has_and_a_replay_changes_nothing(spark, tmp_path):
    rows = log_rows(1)
    path = f"{tmp_path}/log"
    put(spark, path, rows[:70])
    run(spark, tmp_path)
    shutil.copytree(f"{tmp_path}/state-a", f"{tmp_path}/before")
    put(spark, path, rows[70:])
    found = states(run(spark, tmp_path))
    assert found == states(supervisor.replayed(spark.createDataFrame(rows, SCHEMA), SILENT))
    # killed after the changes were stored, before the batch was noted: the batch runs again from the state before
    shutil.rmtree(f"{tmp_path}/state-a")
    shutil.move(f"{tmp_path}/before", f"{tmp_path}/state-a")
    assert states(run(spark, tmp_path)) == found
    assert {s for _, s, *_ in found} >= {"error"} or any(e for _, _, e, *_ in found)


def test_silence_ends_a_run_and_a_sign_of_life_begins_another(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    first = [("a", at(0), "running", None), ("b", at(1), "running", None), ("b", at(5), "done", None), ("z", at(2000), "pending", None)]
    put(spark, f"{tmp_path}/log", first)
    assert states(run(spark, tmp_path)) == [("a", "error", f"no sign of life for {SILENT} s", 1, at(0)), ("b", "done", None, 1, at(5)), ("z", "pending", None, 0, at(2000))]
    put(spark, f"{tmp_path}/log", [("a", at(2100), "running", None), ("a", at(2150), "running", None)])
    found = {r[0]: r[1:] for r in states(run(spark, tmp_path))}
    assert found["a"] == ("running", None, 2, at(2150))
    assert found == {r[0]: r[1:] for r in states(supervisor.replayed(spark.createDataFrame([*first, ("a", at(2100), "running", None), ("a", at(2150), "running", None)], SCHEMA), SILENT))}
