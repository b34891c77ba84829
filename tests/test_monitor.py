import datetime as dt

from pyspark.sql import functions as F

from streamledger.functions.scalar import progress_pct, table_uri, target_total, throughput
from streamledger.operators import monitor as M

LINES = [
    "INFO Sink task batch: task_id=0 processed=5 total_completed=12 elapsed_ms=1.250 rps=4,000.00 last_lsn=99",
    "INFO something else task_id=7 total_completed=1000",
    "INFO Sink task batch: task_id=1 processed=2 total_completed=3 elapsed_ms=0.500 rps=4000.00 last_lsn=",
    "INFO Sink task batch: task_id= processed=2 total_completed=3 elapsed_ms=0.500 rps=4000.00 last_lsn=5",
    "INFO Sink task batch: task_id=0 processed=1 total_completed=2 elapsed_ms=0.500 rps=2000.00 last_lsn=101",
    "INFO Sink task flush done: task_id=0 flushed_lsn=99 pruned_entries=12 elapsed_ms=8.000 offsets={events-0=OffsetAndMetadata{offset=13, leaderEpoch=null}}",
    "INFO Sink task flush done: task_id=1 flushed_lsn=120 pruned_entries=3 elapsed_ms=8.000 offsets={}",
    "INFO Sink task flush done: task_id=1 flushed_lsn=121 pruned_entries=0 elapsed_ms=2.000 offsets={}",
]


def _log(spark):
    return spark.createDataFrame([(l, i) for i, l in enumerate(LINES)], "line string, line_no long")


def test_parse_batch_lines(spark):
    got = M.parse_batch_lines(_log(spark)).orderBy("line_no").collect()
    assert [(r.task_id, r.total_completed, r.last_lsn) for r in got] == [("0", 12, 99), ("1", 3, None), ("0", 2, 101)]
    assert got[0].rps == 4000.0


def test_latest_and_overall_progress(spark):
    parsed = M.parse_batch_lines(_log(spark))
    latest = {r.task_id: r.total_completed for r in M.latest_per_task(parsed, order=("line_no",)).collect()}
    assert latest == {"0": 2, "1": 3}  # a restarted task's total falls; the last line wins
    r = M.overall_progress(parsed, order=("line_no",)).first()
    assert (r.total_completed, r.tasks, r.highest_lsn) == (5, 2, 101)


def test_flush_latency_first_max_wins(spark):
    r = M.flush_latency(M.parse_flush_lines(_log(spark))).first()
    assert (r.flush_count, r.flush_avg_ms, r.flush_max_ms) == (3, 6.0, 8.0)
    assert "flushed_lsn=99" in r.flush_max_line


def test_flush_latency_empty(spark):
    r = M.flush_latency(M.parse_flush_lines(_log(spark).where("false"))).first()
    assert (r.flush_count, r.flush_avg_ms, r.flush_max_ms, r.flush_max_line) == (0, 0.0, 0.0, None)


def test_probe_rates_and_target(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    probes = spark.createDataFrame(
        [(t0 + dt.timedelta(seconds=5), 50), (t0 + dt.timedelta(seconds=5, microseconds=500), 60), (t0 + dt.timedelta(seconds=15), 60), (t0 + dt.timedelta(seconds=25), 200)],
        "probe_ts timestamp_ntz, total_completed long",
    )
    got = M.probe_rates(probes, start_ts=F.lit(t0)).orderBy("probe_ts").collect()
    assert [(r.delta_rows, r.window_s) for r in got] == [(50, 5), (10, 1), (0, 10), (140, 10)]
    assert got[0].probe_rps == 10.0
    hit = M.target_reached(probes, 100).first()
    assert hit.total_completed == 200
    assert M.target_reached(probes, 10**6).first().probe_ts is None


def test_health(spark):
    docs = [
        '{"name":"a","connector":{"state":"RUNNING"},"tasks":[{"id":0,"state":"RUNNING"},{"id":1,"state":"RUNNING"}]}',
        '{"name":"b","connector":{"state":"RUNNING"},"tasks":[{"id":0,"state":"FAILED","trace":"boom"},{"id":1,"state":"RUNNING"}]}',
        '{"name":"c","connector":{"state":"RUNNING"},"tasks":[]}',
        '{"name":"d","tasks":[{"id":0,"state":"RUNNING"}]}',
        '{"name":"e","connector":{"state":"FAILED","trace":"conn down"},"tasks":[{"id":0}]}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], "status_json string")
    got = {r.status_json[9:10]: (r.tasks_not_running, r.healthy, r.failed_traces) for r in M.health(df).collect()}
    assert got == {"a": (0, True, []), "b": (1, False, ["boom"]), "c": (0, True, []), "d": (0, False, []), "e": (1, False, [])}
    assert M.health(df).where("connector_state = 'FAILED'").first().connector_trace == "conn down"


def test_scalars(spark):
    df = spark.createDataFrame([(5, 10), (30, 20), (1, 0)], "c long, t long")
    got = df.select(progress_pct("c", "t").alias("p"), throughput("c", F.lit(0.0)).alias("r")).collect()
    assert [r.p for r in got] == [50, 100, None]
    assert got[0].r == 5000.0
    assert target_total(10, 60) == 600 and target_total(10, 60, True) == 0 and target_total(0, 5) == 5
    uris = spark.createDataFrame([("s3://w",), ("s3://w/",), ("s3://w/db/t",)], "loc string").select(table_uri("loc", F.lit("db"), F.lit("t")).alias("u"))
    assert [r.u for r in uris.collect()] == ["s3://w/db/t"] * 3


def test_sliding_flush_metrics_with_extra_aggregate(spark):
    from streamledger.streaming.sliding import sliding_metrics

    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(t0 + dt.timedelta(seconds=s), ms) for s, ms in [(1, 2.0), (6, 4.0), (11, 6.0), (13, 8.0)]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, elapsed_ms double")
    out = sliding_metrics(df, window="12 seconds", slide="5 seconds", aggs=[F.avg("elapsed_ms").alias("avg_ms")])
    got = {(r.window_start.second if r.window_start.minute == 0 else r.window_start.second - 60): (r.n, r.avg_ms) for r in out.collect()}
    # windows [-10,2) [-5,7) [0,12) [5,17) [10,22)
    assert got == {-10: (1, 2.0), -5: (2, 3.0), 0: (3, 4.0), 5: (3, 6.0), 10: (2, 7.0)}


def test_table_uri_text_matches_column_rule(spark):
    from streamledger.functions.scalar import table_uri_text

    locs = ["s3://w", "s3://w/", "s3://w/db/t", "s3://w//", "/local/path/"]
    df = spark.createDataFrame([(x,) for x in locs], "loc string").select(table_uri("loc", F.lit("db"), F.lit("t")).alias("u"))
    assert [r.u for r in df.collect()] == [table_uri_text(x, "db", "t") for x in locs]
