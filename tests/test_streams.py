"""Bounded generated streams, append-mode windows, arrival order of log lines, probe rates."""

import datetime as dt
import random

from pyspark.sql import functions as F

from streamledger import session as S
from streamledger.operators import monitor as M
from streamledger.schema import SAMPLE_RECORD_SCHEMA
from streamledger.sources.generate import bounded_stream, generate_rows
from streamledger.sources.logs import read_metric_log
from streamledger.streaming.sliding import late_rows, sliding_to_table


def test_bounded_stream_ends_and_replays(spark):
    stream = bounded_stream(spark, SAMPLE_RECORD_SCHEMA, rows_per_second=70, max_seconds=10, string_bytes=3)
    out, ck = S.scratch_path(spark, "bounded"), S.scratch_path(spark, "ck")

    def run(folder):
        def keep(rows, batch_id):
            rows.write.mode("overwrite").parquet(f"{out}/{folder}/b{batch_id}")

        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", ck).trigger(availableNow=True).start()
        assert q.awaitTermination(120) and q.exception() is None

    run("one")
    done = sorted(int(n) for n in S.list_names(spark, f"{ck}/commits") if n.isdigit())
    S.delete_path(spark, f"{ck}/commits/{done[-1]}")
    run("two")

    def read(folder):
        return sorted(map(tuple, spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/{folder}").collect()))

    want = sorted(map(tuple, generate_rows(spark, SAMPLE_RECORD_SCHEMA, 700, string_bytes=3).collect()))
    assert read("one") == want and set(read("two")) <= set(want) and read("two")


def test_paced_stream_stops_at_its_target(spark):
    stream = bounded_stream(spark, SAMPLE_RECORD_SCHEMA, rows_per_second=40, max_seconds=1, paced=True)
    q = stream.writeStream.format("memory").queryName("paced").trigger(processingTime="300 milliseconds").start()
    try:
        for _ in range(100):
            if spark.table("paced").count() >= 40:
                break
            q.awaitTermination(0.3)
        q.awaitTermination(2)
    finally:
        q.stop()
    assert sorted(r.seq for r in spark.table("paced").collect()) == list(range(1, 41))


def test_windows_are_written_once_and_late_rows_counted(spark):
    src, out, ck = (S.scratch_path(spark, n) for n in ("ticks", "windows", "ck"))
    t0 = dt.datetime(2024, 1, 1)

    def add(seconds):
        rows = [(t0 + dt.timedelta(seconds=s), "k") for s in seconds]
        spark.createDataFrame(rows, "ts timestamp, key string").coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema("ts timestamp, key string").option("maxFilesPerTrigger", 1).parquet(src)
        q = sliding_to_table(stream, out, ck, keys=["key"], window="10 seconds", slide="10 seconds", watermark="5 seconds", mode="append")
        q.awaitTermination(120)
        return late_rows(q)

    add([1, 2, 11, 31])
    assert run() == 0
    first = set(S.list_names(spark, out))
    add([33, 58])
    add([3, 41, 59])  # 3 is later than the watermark
    assert run() == 1
    assert first <= set(S.list_names(spark, out))  # no file was written over
    got = {(int((r.window_start - t0).total_seconds()), r.n) for r in spark.read.parquet(out).collect()}
    assert got == {(0, 2), (10, 1), (30, 2), (40, 1)}


def test_lines_without_an_instant_come_as_written(spark):
    path = S.scratch_path(spark, "bare")
    lines = [["a 5", "b 1"], ["a 3", "a 4", "b 0"], ["a 2"]]
    for part in lines:
        text = [f"Sink task batch: task_id={x.split()[0]} processed=1 total_completed={x.split()[1]} elapsed_ms=1.000 rps=1.00 last_lsn=1" for x in part]
        spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.mode("append").text(path)
    want = {("a", 2), ("b", 0)}
    batch = M.latest_per_task(M.parse_batch_lines(read_metric_log(spark, path)))
    assert {(r.task_id, r.total_completed) for r in batch.collect()} == want
    stream = M.latest_per_task(M.parse_batch_lines(read_metric_log(spark, path, streaming=True, max_files_per_trigger=1)))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("bare_lines").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.task_id, r.total_completed) for r in spark.table("bare_lines").collect()} == want


def test_previous_row_across_buckets(spark):
    rng = random.Random(5)
    at = sorted(rng.sample(range(-50_000, 4_000_000), 300))
    df = spark.createDataFrame([(x,) for x in at], "x long").repartition(4)
    got = M.with_previous(df, "x", F.col("x"), "before", width=50, fanout=7, levels=3)
    assert {r.x: r.before for r in got.collect()} == dict(zip(at, [None, *at[:-1]]))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "Window" in plan and "], [], [" not in plan
