import pytest
from pyspark.sql import functions as F

from streamledger import session as S
from streamledger.plans import events as P
from streamledger.sinks import table as TB
from streamledger.sources.logs import format_log_line, read_metric_log
from streamledger.sources.wire import read_wire
from streamledger.sinks.wire import publish
from streamledger.streaming.ingest import PERMISSIVE, durable_lsn, ingest_batch

SF001 = "/root/testdata/sf0.001"


def test_table_lifecycle_and_status(spark):
    wh = S.scratch_path(spark, "wh")
    target = TB.target_for(spark, "lifecycle", "events", wh)
    assert target.location == f"{wh}/lifecycle/events"
    assert not TB.table_exists(spark, "lifecycle", "events")
    TB.ensure_table(spark, target, P.EVENT_SCHEMA)
    assert TB.table_exists(spark, "lifecycle", "events")
    assert "lifecycle.events" in TB.list_tables(spark, "lifecycle").first().tables
    assert '"name":"flag"' in TB.table_schema(spark, target)

    wire = P.events_wire(P.table(spark, SF001, "events"))
    ingest_batch(wire, 0, target, P.EVENT_SCHEMA, mode=PERMISSIVE)
    ok = wire.count() - spark.read.parquet(target.quarantine_path).count()
    st = TB.table_status(spark, target).first()
    assert (st.cardinality, st.commit_lsn, st.flush_lsn) == (ok, ok, ok)
    assert durable_lsn(TB.read_ledger(spark, target)).first().durable_lsn == ok

    # a batch written without its ledger row is invisible to readers
    TB.read_table(spark, target).drop("batch_id").write.mode("overwrite").parquet(target.batch_path("data", 1))
    assert TB.read_table(spark, target).count() == ok
    assert TB.read_location(spark, target.data_path).count() == 2 * ok
    st = TB.table_status(spark, target).first()
    assert st.flush_lsn == ok and st.cardinality == ok

    snap_path = S.scratch_path(spark, "snap")
    snap = TB.snapshot_at(spark, target, ok // 2, path=snap_path)
    assert snap.count() == ok // 2 and snap.agg(F.max("_lsn")).first()[0] == ok // 2

    TB.drop_table(spark, target)
    assert not TB.table_exists(spark, "lifecycle", "events")
    assert not S.path_exists(spark, target.location)


def test_registry_join(spark):
    target = TB.target_for(spark, "reg", "t", S.scratch_path(spark, "wh"))
    TB.register_schema(spark, target, 7, P.EVENT_RECORD)
    TB.register_schema(spark, target, 7, P.EVENT_RECORD)  # idempotent per id
    assert TB.read_registry(spark, target).count() == 1
    frames = spark.createDataFrame([(7,), (8,), (None,)], "_schema_id int")
    got = {r._schema_id: r._schema_registered for r in TB.with_schema(frames, TB.read_registry(spark, target)).collect()}
    assert got == {7: True, 8: False, None: False}


def test_metric_log_batch_and_stream(spark):
    path = S.scratch_path(spark, "log")
    lines = spark.createDataFrame(
        [("2024-01-01 00:00:05", "Sink task batch: task_id=0 processed=1 total_completed=1 elapsed_ms=1.000 rps=1.00 last_lsn=1"),
         ("2024-01-01 00:00:09", "noise")],
        "t string, msg string",
    )
    lines.select(format_log_line(F.col("t").cast("timestamp_ntz"), F.col("msg")).alias("value")).write.text(path)
    batch = read_metric_log(spark, path).orderBy("ts").collect()
    assert [r.ts.second for r in batch] == [5, 9]
    assert batch[0].line.startswith("2024-01-01T00:00:05.000000Z Sink task batch:")
    stream = read_metric_log(spark, path, streaming=True)
    q = stream.writeStream.format("memory").queryName("log_lines").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("log_lines").count() == 2


def test_wire_folder_roundtrip(spark):
    path = S.scratch_path(spark, "wire")
    publish(P.events_wire(P.table(spark, SF001, "events")), path=path)
    static = read_wire(spark, path=path, streaming=False, topics=["events"])
    assert static.count() == P.table(spark, SF001, "events").count()
    assert read_wire(spark, path=path, topics=["other"], streaming=False).count() == 0


def test_append_rows_batches_and_replay(spark):
    target = TB.ensure_table(spark, TB.target_for(spark, "app", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    rows = spark.createDataFrame(
        [("click", i, True, "events", i % 2, i // 2) for i in range(10)],
        "event_type string, event_id int, flag boolean, _topic string, _partition int, _offset long",
    )
    first = TB.append_rows(rows, target)
    second = TB.append_rows(rows.withColumn("_offset", F.col("_offset") + 100), target)
    assert (first["batch_id"], second["batch_id"]) == (0, 1)
    lsns = sorted(r._lsn for r in TB.read_table(spark, target).collect())
    assert lsns == list(range(1, 21))
    # a committed batch is not written again
    before = sorted(map(tuple, TB.read_table(spark, target).drop("_timestamp").collect()))
    assert TB.append_rows(rows.limit(2), target, source_batch=0)["already"]
    assert sorted(map(tuple, TB.read_table(spark, target).drop("_timestamp").collect())) == before


def test_lsn_base_reads_previous_batch_and_falls_back(spark):
    target = TB.ensure_table(spark, TB.target_for(spark, "base", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    rows = spark.createDataFrame(
        [("view", i, None, "events", 0, i) for i in range(7)],
        "event_type string, event_id int, flag boolean, _topic string, _partition int, _offset long",
    )
    TB.append_rows(rows, target)
    TB.append_rows(rows.withColumn("_offset", F.col("_offset") + 7), target)
    assert TB.read_ledger(spark, target).agg(F.max("high_lsn")).first()[0] == 14
    assert TB.lsn_base(spark, target, 2) == 14  # from batch 1's ledger folder only
    assert TB.lsn_base(spark, target, 5) == 14  # gap: full ledger scan
    assert TB.lsn_base(spark, target, 1) == 7 and TB.lsn_base(spark, target, 0) == 0


def test_two_topics_into_one_table(spark):
    from streamledger.streaming.ingest import STRICT

    target = TB.ensure_table(spark, TB.target_for(spark, "topics", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    ev = P.table(spark, SF001, "events").where((F.col("event_id") % 97 != 0) & (F.col("event_id") % 89 != 0) & (F.col("event_id") % 83 != 0))
    wire = P.events_wire(ev)
    two = wire.withColumn("topic", F.when(F.col("offset") % 2 == 0, F.lit("a")).otherwise(F.lit("b")))
    ingest_batch(two, 0, target, P.EVENT_SCHEMA, mode=STRICT)
    got = TB.read_table(spark, target).select("_topic", "_partition", "_offset", "_lsn").collect()
    assert {r._topic for r in got} == {"a", "b"} and len(got) == ev.count()
    ordered = sorted(got, key=lambda r: (r._topic, r._partition, r._offset))
    assert [r._lsn for r in ordered] == list(range(1, len(got) + 1))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_push_filters_and_broadcast_commits(spark):
    from streamledger.operators import ledger as LG

    target = TB.ensure_table(spark, TB.target_for(spark, "plans", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    ingest_batch(P.events_wire(P.table(spark, SF001, "events")), 0, target, P.EVENT_SCHEMA, mode=PERMISSIVE)
    snap = _plan(TB.snapshot_at(spark, target, 100))
    assert "LessThanOrEqual(_lsn,100)" in snap  # pushed to the Parquet scan
    idx = TB.read_table(spark, target).select(
        F.col("_topic").alias("topic"), F.col("_partition").alias("partition"), F.col("_offset").alias("offset"), F.col("_lsn").alias("lsn")
    )
    commits = idx.groupBy("topic", "partition").agg((F.max("offset") / 2).cast("long").alias("upto"))
    covered = LG.covered_by(idx, commits)
    covered.collect()
    plan = _plan(covered)
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_status_of_a_fresh_table(spark):
    target = TB.ensure_table(spark, TB.target_for(spark, "fresh", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    st = TB.table_status(spark, target).first()
    assert (st.cardinality, st.commit_lsn, st.flush_lsn) == (0, None, None)


def test_read_of_a_fresh_table_is_empty_with_schema(spark):
    import pytest

    target = TB.ensure_table(spark, TB.target_for(spark, "fresh2", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    df = TB.read_table(spark, target)
    assert df.count() == 0 and {"event_type", "event_id", "flag", "_lsn", "batch_id"} <= set(df.columns)
    assert TB.snapshot_at(spark, target, 10).count() == 0
    with pytest.raises(FileNotFoundError):
        TB.read_table(spark, TB.target_for(spark, "none", "t", S.scratch_path(spark, "wh")))


def _event_rows(spark, n, partition=0, start=0):
    return spark.createDataFrame(
        [("view", i, None, "events", partition, i) for i in range(start, start + n)],
        "event_type string, event_id int, flag boolean, _topic string, _partition int, _offset long",
    )


def test_streams_and_appends_share_a_table(spark):
    """5 rows by a writer, 5 by append, 3 by the first writer again: 13 rows, dense LSNs."""
    target = TB.ensure_table(spark, TB.target_for(spark, "mixed", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    TB.append_rows(_event_rows(spark, 5), target, source_batch=0, writer="stream-a")
    TB.append_rows(_event_rows(spark, 5, 1), target)
    TB.append_rows(_event_rows(spark, 3, 0, 5), target, source_batch=1, writer="stream-a")
    TB.append_rows(_event_rows(spark, 2, 2), target, source_batch=0, writer="stream-b")
    assert TB.append_rows(_event_rows(spark, 5), target, source_batch=0, writer="stream-a")["already"]
    t = TB.read_table(spark, target)
    assert t.count() == 15 and sorted(r._lsn for r in t.collect()) == list(range(1, 16))
    assert TB.read_by_name(spark, "mixed", "t").count() == 15


def test_failed_replay_leaves_durable_rows(spark):
    target = TB.ensure_table(spark, TB.target_for(spark, "durable", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    TB.append_rows(_event_rows(spark, 20), target, source_batch=0, writer="w")
    broken = _event_rows(spark, 20).withColumn("event_type", F.raise_error(F.lit("task fails")))
    assert TB.append_rows(broken, target, source_batch=0, writer="w")["already"]
    with pytest.raises(Exception, match="task fails"):
        TB.append_rows(broken, target, source_batch=1, writer="w")
    assert TB.read_table(spark, target).count() == 20
    TB.append_rows(_event_rows(spark, 4, 0, 20), target, source_batch=1, writer="w")
    assert sorted(r._lsn for r in TB.read_table(spark, target).collect()) == list(range(1, 25))


def test_conflicts_are_refused(spark):
    target = TB.ensure_table(spark, TB.target_for(spark, "conflict", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    TB.ensure_table(spark, target, P.EVENT_SCHEMA)
    with pytest.raises(ValueError, match="another record schema"):
        TB.ensure_table(spark, target, P.schema_from_spec([{"name": "b", "data_type": "int"}]))
    TB.register_schema(spark, target, 7, P.EVENT_RECORD)
    with pytest.raises(ValueError, match="another text"):
        TB.register_schema(spark, target, 7, {"type": "record", "name": "X", "fields": []})


def test_strict_mode_fails_under_any_plan(spark):
    from streamledger.operators.decode import decode_payload, require_ok

    decoded = require_ok(decode_payload(P.events_wire(P.table(spark, SF001, "events")), P.EVENT_SCHEMA))
    for plan in (decoded, decoded.select("event_id"), decoded.groupBy().count()):
        with pytest.raises(Exception, match="bad record"):
            plan.collect()


def test_content_check_sees_moved_nulls(spark):
    from streamledger.operators.verify import reconcile_content

    wire = spark.createDataFrame([("t", 0, 0, None, "x"), ("t", 0, 1, "a", "b")], "topic string, partition int, offset long, u string, v string")
    table = spark.createDataFrame([("t", 0, 0, "x", None), ("t", 0, 1, "a", "b")], "topic string, partition int, offset long, u string, v string")
    assert not reconcile_content(wire, table).first().checksum_match
    assert reconcile_content(wire, wire).first().checksum_match


def test_later_lsn_wins_in_a_batch(spark):
    from streamledger.operators.sequence import upsert_index

    rows = [("t", 0, 4, 5, 1), ("t", 0, 4, 9, 1), ("t", 0, 4, 7, 0)]
    for order in (rows, rows[::-1]):
        got = upsert_index(spark.createDataFrame(order, "topic string, partition int, offset long, lsn long, batch_id long")).collect()
        assert [(r.lsn, r.batch_id) for r in got] == [(9, 1)]


def test_flush_point_by_the_ledger_equals_the_index(spark):
    from streamledger.operators import ledger as LG

    target = TB.ensure_table(spark, TB.target_for(spark, "flush", "t", S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)
    for k in range(4):
        TB.append_rows(_event_rows(spark, 10, k % 2, 10 * k), target)
    idx = TB.read_table(spark, target).select(*[F.col(f"_{c}").alias(c) for c in ("topic", "partition", "offset", "lsn")])
    for a, b in ((4, 35), (9, 5), (100, 100), (-1, 12), (-1, -1)):
        commits = spark.createDataFrame([("events", 0, a), ("events", 1, b), ("other", 0, 9)], "topic string, partition int, upto long")
        assert TB.flush_point_of(spark, target, commits).first() == LG.flush_point(idx, commits).first()
