"""The commit point of a table, redelivery, and what is built on its records."""

import json
import random

import pytest
from pyspark.sql import functions as F

from streamledger import session as S
from streamledger.plans import events as P
from streamledger.sinks import table as TB
from streamledger.streaming.ingest import PERMISSIVE, durable_lsn, ingest_batch

SF001 = "/root/testdata/sf0.001"
DDL = "event_type string, event_id int, flag boolean, _topic string, _partition int, _offset long"


def _table(spark, name):
    return TB.ensure_table(spark, TB.target_for(spark, "commits", name, S.scratch_path(spark, "wh")), P.EVENT_SCHEMA)


def _rows(spark, n, start=0, partition=0):
    return spark.createDataFrame([("view", i, None, "events", partition, i) for i in range(start, start + n)], DDL)


def _lsns(df):
    return sorted(r._lsn for r in df.select("_lsn").collect())


def test_success_markers_mean_nothing(spark):
    target = _table(spark, "unmarked")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for k in range(3):
            TB.append_rows(_rows(spark, 5, 5 * k), target)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert _lsns(TB.read_table(spark, target)) == list(range(1, 16))
    assert _lsns(TB.read_by_name(spark, "commits", "unmarked")) == list(range(1, 16))


def test_two_writers_that_meet(spark, monkeypatch):
    """Both have read the same last commit; the one that commits second gets an error, and
    neither's rows are lost or doubled."""
    target = _table(spark, "meet")
    TB.append_rows(_rows(spark, 3), target)
    real, met = TB.write_ledger, []

    def other_first(*args):
        if not met:
            met.append(True)
            TB.append_rows(_rows(spark, 4, 100), target, writer="fast")
        return real(*args)

    monkeypatch.setattr(TB, "write_ledger", other_first)
    with pytest.raises(TB.CommitConflict, match="fast"):
        TB.append_rows(_rows(spark, 9, 200), target, writer="slow")
    monkeypatch.setattr(TB, "write_ledger", real)
    assert _lsns(TB.read_table(spark, target)) == list(range(1, 8))
    assert len(S.list_names(spark, target.batch_path("data", 1))) == 1  # the loser's rows are gone
    TB.append_rows(_rows(spark, 9, 200), target, writer="slow")
    assert _lsns(TB.read_table(spark, target)) == _lsns(TB.read_by_name(spark, "commits", "meet")) == list(range(1, 17))


def test_a_record_is_created_once(spark):
    path = f"{S.scratch_path(spark, 'once')}/record.json"
    assert S.create_once(spark, path, "first") and not S.create_once(spark, path, "second")
    assert S.read_text(spark, path) == "first"
    assert S.list_names(spark, path.rsplit("/", 1)[0]) == ["record.json"]


def test_crash_before_the_catalog_is_repaired(spark):
    """By replay of the batch, by the next append, or by asking for it."""
    for how in ("replay", "append", "repair"):
        target = _table(spark, f"catalog_{how}")
        TB.append_rows(_rows(spark, 5), target, source_batch=0, writer="w")

        def crash(batch_id):
            raise RuntimeError("crash")

        with pytest.raises(RuntimeError, match="crash"):
            TB.append_rows(_rows(spark, 3, 5), target, source_batch=1, writer="w", on_committed=crash)
        assert TB.read_table(spark, target).count() == 8
        assert TB.read_by_name(spark, "commits", target.table).count() == 5
        if how == "replay":
            assert TB.append_rows(_rows(spark, 3, 5), target, source_batch=1, writer="w")["already"]
        elif how == "append":
            TB.append_rows(_rows(spark, 2, 50), target)
        else:
            assert TB.repair_catalog(spark, target) == 1 and TB.repair_catalog(spark, target) == 0
        assert _lsns(TB.read_by_name(spark, "commits", target.table)) == _lsns(TB.read_table(spark, target))


def test_a_table_found_by_another_catalog_gets_its_partitions(spark):
    target = _table(spark, "moved")
    TB.append_rows(_rows(spark, 5), target)
    spark.sql("DROP TABLE commits.moved")
    TB.ensure_table(spark, target, P.EVENT_SCHEMA)
    assert TB.read_by_name(spark, "commits", "moved").count() == 5


def test_lost_hint_and_unread_leftovers(spark):
    target = _table(spark, "hint")
    for k in range(3):
        TB.append_rows(_rows(spark, 2, 2 * k), target)
    _rows(spark, 7).withColumn("_lsn", F.lit(99)).write.parquet(f"{target.batch_path('data', 3)}/leftover")
    for text in (None, "", "1", "77"):
        S.delete_path(spark, f"{target.commits_path}/_last")
        if text is not None:
            S.write_text(spark, f"{target.commits_path}/_last", text)
        assert TB.last_commit(spark, target)["batch_id"] == 2 and TB.next_batch_id(spark, target) == 3
    st = TB.table_status(spark, target).first()
    assert (st.cardinality, st.flush_lsn, st.commit_lsn) == (6, 6, 99)
    TB.append_rows(_rows(spark, 1, 6), target)
    assert _lsns(TB.read_table(spark, target)) == list(range(1, 8))


def test_records_hold_what_the_next_batch_needs(spark, monkeypatch):
    """The ledger isn't read for a commit, however many there are."""
    target = _table(spark, "cost")
    for k in range(4):
        TB.append_rows(_rows(spark, 2, 2 * k), target, source_batch=k, writer="w")

    def unread(*_a, **_k):
        raise AssertionError("the ledger was read")

    monkeypatch.setattr(TB, "_read_records", unread)
    monkeypatch.setattr(TB, "_commit_ids", unread)
    wire = P.events_wire(P.table(spark, SF001, "events")).withColumn("topic", F.lit("other"))
    ingest_batch(wire, 4, target, P.EVENT_SCHEMA, PERMISSIVE, f"{target.location}/_log", "w")
    head, *ranges = TB.read_record(spark, target, 4)
    assert head["high_lsn"] == 8 + head["rows"] and head["writers"] == {"w": [4, 4]} and len(ranges) == 4
    assert {tuple(t[:3]) for t in head["totals"] if t[0] == "events"} == {("events", 0, 8)}


def test_ledger_rows_by_measure_equal_those_of_the_files(spark):
    """Ranges measured before the write against those read from the written files."""
    wire = P.events_wire(P.table(spark, SF001, "events"))
    target = _table(spark, "measured")
    ingest_batch(wire, 0, target, P.EVENT_SCHEMA, PERMISSIVE)
    head = TB.last_commit(spark, target)
    paths = [f"{target.batch_path(kind, 0)}/{head['attempt']}" for kind in ("data", "quarantine")]
    by_files = {r["partition"]: r for r in TB._written_ranges(spark, *paths)}
    for r in TB.read_ledger(spark, target).collect():
        assert {k: r[k] for k in by_files[r["partition"]]} == by_files[r["partition"]]


def test_a_write_that_differs_from_its_measure_is_not_committed(spark):
    from streamledger.operators.sequence import plan_in_place

    target = _table(spark, "differs")
    rows = _rows(spark, 10).persist()
    plan = plan_in_place(rows, ["_topic", "_partition"], "_offset")
    plan.ranges = [type(r)(**{**r.asDict(), "n": r["n"] + 1}) for r in plan.ranges]
    with pytest.raises(RuntimeError, match="counted"):
        TB.append_rows(rows, target, plan=plan)
    assert TB.last_commit(spark, target) is None and TB.read_table(spark, target).count() == 0
    plan.close()


def test_compacted_ledger(spark):
    target = _table(spark, "compact")
    assert TB.compact_ledger(spark, target) == -1
    for k in range(6):
        TB.append_rows(_rows(spark, 2, 2 * k), target, source_batch=k, writer="w")
    key = lambda r: tuple(map(str, r))
    before = sorted(TB.read_ledger(spark, target).collect(), key=key)
    assert TB.compact_ledger(spark, target, keep=3) == 2
    assert len([n for n in S.list_names(spark, target.commits_path) if n.endswith(".json")]) == 3
    assert TB.compact_ledger(spark, target, keep=1) == 4
    assert sorted(TB.read_ledger(spark, target).collect(), key=key) == before
    assert TB.batch_of(spark, target, "w", 1) == 1 and TB.lsn_base(spark, target, 2) == 4
    TB.append_rows(_rows(spark, 2, 12), target, source_batch=6, writer="w")
    assert TB.append_rows(_rows(spark, 2), target, source_batch=0, writer="w")["already"]
    assert _lsns(TB.read_table(spark, target)) == list(range(1, 15))
    assert durable_lsn(TB.read_ledger(spark, target)).first().durable_lsn == 14


def test_redelivered_records_are_dropped_new_ones_kept(spark):
    wire = P.events_wire(P.table(spark, SF001, "events"))
    target = _table(spark, "again")
    ingest_batch(wire.where("offset < 100 AND offset % 3 <> 1"), 0, target, P.EVENT_SCHEMA, PERMISSIVE)
    ingest_batch(wire.where("offset < 150"), 1, target, P.EVENT_SCHEMA, PERMISSIVE)
    ingest_batch(wire.where("offset BETWEEN 20 AND 40"), 2, target, P.EVENT_SCHEMA, PERMISSIVE)
    ingest_batch(wire, 3, target, P.EVENT_SCHEMA, PERMISSIVE)
    rows = TB.read_table(spark, target)
    total = rows.count()
    assert total + TB.read_quarantine(spark, target).count() == wire.count()
    assert rows.select("_partition", "_offset").distinct().count() == total
    assert _lsns(rows) == list(range(1, total + 1))
    led = {r.batch_id: r for r in TB.read_ledger(spark, target).groupBy("batch_id").agg(F.sum("redelivered").alias("again"), F.sum("rows").alias("rows")).collect()}
    assert (led[0].again, led[2].rows, led[2].again) == (0, 0, 4 * 21)
    assert led[1].again == wire.where("offset < 100 AND offset % 3 <> 1").count()


def test_pruned_index_reads_cut_batches_only(spark):
    from streamledger.operators import ledger as LG

    target = _table(spark, "prune")
    for k in range(6):
        TB.append_rows(_rows(spark, 10, 10 * k, k % 2), target)
    commits = spark.createDataFrame([("events", 0, 24), ("events", 1, 39), ("events", 7, 5)], "topic string, partition int, upto long")
    for flushed in (None, 0, 22, 35, 60):
        left, pruned = TB.prune_table_index(spark, target, commits, flushed)
        want, count = LG.prune_index(TB.read_index(spark, target), commits, flushed)
        assert sorted(left.collect()) == sorted(want.collect()) and pruned.first() == count.first()
    left, _ = TB.prune_table_index(spark, target, commits, 35)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.batch_id for r in left.select("batch_id").distinct().collect()} == {2, 3, 4, 5}


def _faulty(spark, rng, n, width):
    """Wire offsets with gaps, and a table with losses, doubles and strangers."""
    wire = [(k, o) for k in (0, None) for o in range(n) if o % 97]
    table = []
    for k, o in wire:
        if not ((o // 13) % 11 == 5 or 2 * width <= o < 4 * width + 3):
            table += [(k, o)] * (2 if (o // 7) % 17 == 3 else 1)
    table += [(0, 97 * 4), (None, n + 5), (None, n + 6), (3, 1)]
    rng.shuffle(table)
    return wire, table


def test_offset_ranges_against_counting(spark):
    from streamledger.operators.verify import reconcile_ranges

    width, n = 32, 700
    wire, table = _faulty(spark, random.Random(1), n, width)
    ddl = "partition int, offset long"
    got = reconcile_ranges(spark.createDataFrame(wire, ddl), spark.createDataFrame(table, ddl), keys=["partition"], width=width).collect()
    found = set()
    for r in got:
        assert r.offsets == r.last_offset - r.first_offset + 1
        found |= {(r.partition, r.fault, o) for o in range(r.first_offset, r.last_offset + 1)}
    want = set()
    for key in set(wire) | set(table):
        w, t = wire.count(key), table.count(key)
        if w != t:
            want.add((key[0], "missing" if t == 0 else "extra" if w == 0 else "doubled", key[1]))
    assert found == want
    ends = {(r.partition, r.fault, r.last_offset + 1) for r in got}
    assert not ends & {(r.partition, r.fault, r.first_offset) for r in got}  # ranges are as long as can be
    same = spark.createDataFrame(wire, ddl)
    assert reconcile_ranges(same, same, keys=["partition"], width=width).count() == 0


def test_differing_rows_and_pruned_reads(spark):
    from streamledger.operators import verify as V

    base = [("t", p, o, f"v{o}", o if o % 5 else None) for p in (0, 1) for o in range(5000)]
    ddl = "topic string, partition int, offset long, a string, b long"
    changed = [r for r in base if r[:3] != ("t", 0, 17)] + [("t", 1, 40, "v40", None)]
    changed = [(*r[:3], "x", r[4]) if r[1:3] == (1, 4999) else (*r[:4], 7) if r[1:3] == (0, 4000) else r for r in changed]
    path = S.scratch_path(spark, "diff")
    wire = spark.createDataFrame(base, ddl)
    spark.createDataFrame(changed, ddl).repartitionByRange(8, "partition", "offset").write.parquet(path)
    table = spark.read.parquet(path)
    got = {(r.partition, r.offset): (r.fault, r.columns) for r in V.reconcile_diff(wire, table, width=64).collect()}
    assert got == {(0, 17): ("missing", None), (1, 40): ("doubled", None), (1, 4999): ("changed", "a"), (0, 4000): ("changed", "b")}
    keys = ["topic", "partition"]
    trees = [V.checksum_tree(x, keys, "offset", ["a", "b"], 64, 8, 2) for x in (wire, table)]
    buckets = V.differing_buckets(*trees, keys, 64, 8, 2)
    assert {(r.partition, r.node) for r in buckets.collect()} == {(0, 0), (0, 3968), (1, 0), (1, 4992)}
    plan = V._within(table, buckets, keys, "offset", 64)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1].split("ReadSchema")[0]
    assert "offset" in pushed and "GreaterThanOrEqual" in pushed
    nothing = V.reconcile_diff(wire, wire, width=64)
    assert nothing.count() == 0


def test_many_differing_buckets_are_joined(spark, monkeypatch):
    from streamledger.operators import verify as V

    monkeypatch.setattr(V, "NAMED_BUCKETS", 2)
    wire = spark.range(1000).selectExpr("0 AS partition", "id AS offset", "id AS v")
    table = wire.withColumn("v", F.when(F.col("offset") % 100 == 1, -1).otherwise(F.col("v")))
    got = V.reconcile_diff(wire, table, keys=["partition"], width=16).collect()
    assert {(r.offset, r.fault, r.columns) for r in got} == {(o, "changed", "v") for o in range(1, 1000, 100)}


def test_record_is_one_json_line_per_range(spark):
    target = _table(spark, "lines")
    TB.append_rows(_rows(spark, 4), target)
    text = S.read_text(spark, target.commit_path(0)).split("\n")
    assert [json.loads(x)["kind"] for x in text] == ["batch", "range"]
