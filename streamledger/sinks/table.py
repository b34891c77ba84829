"""Append-only target tables with one commit point.

Layout under the table location::

    commits/N.json                one record per batch, created once: it alone makes batch N visible
    data/batch_id=N/attempt/      decoded rows + _topic, _partition, _offset, _schema_id, _timestamp, _lsn
    quarantine/batch_id=N/attempt/ rejected wire records with their _verdict (permissive mode)
    compacted/                    the ledger rows of older commits as Parquet (``compact_ledger``)
    schemas/                      registered schema versions (schema_id, schema_json)
    _schema.json                  the record schema the table was created with

A batch is committed if its record exists, for readers and writers alike; success markers of
the data files mean nothing. A record names the attempt whose folder holds the rows, the writer
(a stream's checkpoint, or one call of ``append_rows``) with its own number of the batch, one
ledger row per (topic, partition) with its offset and LSN range, and what the next batch needs
to know: the high-water LSN, each writer's last batch, each partition's totals. So the cost of a
commit doesn't grow with the number of batches. Records are numbered without gaps and created
only if absent: of two writers that meet, one gets a ``CommitConflict`` and its rows are
removed. A crash before the record leaves a folder that nobody reads; a batch whose record
exists is never written again. Catalog partitions follow the records: every commit and every
replay adds what is missing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session as S
from ..functions.scalar import qualified_name, table_uri_text
from ..operators.ledger import prune_index
from ..operators.sequence import InPlace, assign_lsn
from ..schema import schema_from_spec, to_avro_json

META_COLUMNS = ("_topic", "_partition", "_offset", "_schema_id", "_timestamp", "_lsn")
LEDGER_DDL = (
    "topic STRING, partition INT, rows BIGINT, min_offset BIGINT, max_offset BIGINT, "
    "min_lsn BIGINT, max_lsn BIGINT, quarantined BIGINT, redelivered BIGINT, elapsed_ms DOUBLE, high_lsn BIGINT, "
    "writer STRING, source_batch BIGINT, batch_id BIGINT"
)


class CommitConflict(RuntimeError):
    """Another writer has committed the batch number; nothing of this attempt is visible."""


@dataclass(frozen=True)
class Target:
    database: str
    table: str
    location: str

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}"

    @property
    def data_path(self) -> str:
        return f"{self.location}/data"

    @property
    def commits_path(self) -> str:
        return f"{self.location}/commits"

    @property
    def compacted_path(self) -> str:
        return f"{self.location}/compacted"

    @property
    def quarantine_path(self) -> str:
        return f"{self.location}/quarantine"

    @property
    def schemas_path(self) -> str:
        return f"{self.location}/schemas"

    def batch_path(self, kind: str, batch_id: int) -> str:
        return f"{self.location}/{kind}/batch_id={int(batch_id)}"

    def commit_path(self, batch_id: int) -> str:
        return f"{self.commits_path}/{int(batch_id):012d}.json"


def target_for(spark: SparkSession, database: str, table: str, warehouse: str | None = None) -> Target:
    """P10: the table location is ``warehouse/db/table`` unless the warehouse already ends so."""
    root = warehouse or f"{S.checkpoint_root(spark)}/warehouse"
    return Target(database, table, table_uri_text(root, database, table))


def _catalog_ddl(schema: T.StructType) -> str:
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    cols += ["_topic STRING", "_partition INT", "_offset BIGINT", "_schema_id INT", "_timestamp TIMESTAMP"]
    cols += ["_lsn BIGINT", "batch_id BIGINT"]
    return ", ".join(cols)


def ensure_table(spark: SparkSession, target: Target, schema: T.StructType, recreate: bool = False) -> Target:
    """K3: create the table unless it exists; ``recreate`` drops it first. An existing table
    must have the same record schema."""
    if recreate:
        drop_table(spark, target)
    wanted = to_avro_json(schema, name=target.table)
    if not S.path_exists(spark, f"{target.location}/_schema.json"):
        S.write_text(spark, f"{target.location}/_schema.json", wanted)
    elif json.loads(table_schema(spark, target))["fields"] != json.loads(wanted)["fields"]:
        raise ValueError(f"{target.name} exists with another record schema")
    fs, data_dir = S._fs_and_path(spark, target.data_path)
    fs.mkdirs(data_dir)  # the catalog entry points here before the first batch lands
    db_location = target.location.rsplit("/", 1)[0]  # warehouse/db, beside the table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{target.database}` LOCATION '{db_location}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{target.database}`.`{target.table}` ({_catalog_ddl(schema)}) "
        f"USING parquet PARTITIONED BY (batch_id) LOCATION '{target.data_path}'"
    )
    if last_commit(spark, target) is not None:
        repair_catalog(spark, target)
    return target


def drop_table(spark: SparkSession, target: Target) -> None:
    """K3: drop the catalog entry and the files."""
    spark.sql(f"DROP TABLE IF EXISTS `{target.database}`.`{target.table}`")
    if S.path_exists(spark, target.location):
        S.delete_path(spark, target.location)


def table_schema(spark: SparkSession, target: Target) -> str:
    return S.read_text(spark, f"{target.location}/_schema.json")


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    """Exact match on database and table."""
    if not spark.catalog.databaseExists(database):
        return False
    return bool(spark.catalog.tableExists(f"`{database}`.`{table}`"))


def _batch_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("batch_id", F.col("batch_id").cast("long"))


# ------------------------------------------------------------------ commit records


def read_record(spark: SparkSession, target: Target, batch_id: int) -> list[dict]:
    """The lines of batch N's record: its head, then one per (topic, partition)."""
    return [json.loads(x) for x in S.read_text(spark, target.commit_path(batch_id)).split("\n")]


def _commit(spark: SparkSession, target: Target, batch_id: int) -> dict | None:
    """The head of batch N's record, or None if it is not committed."""
    if batch_id < 0 or not S.path_exists(spark, target.commit_path(batch_id)):
        return None
    return read_record(spark, target, batch_id)[0]


def last_commit(spark: SparkSession, target: Target) -> dict | None:
    """The head of the newest record. A hint file says where to look first; records have no
    gaps, so the newest is the last one found from there (without a hint: by name)."""
    hint = f"{target.commits_path}/_last"
    text = S.read_text(spark, hint) if S.path_exists(spark, hint) else ""
    ids = [int(text)] if text.strip().isdigit() else _commit_ids(spark, target)[-1:]
    if not ids or not S.path_exists(spark, target.commit_path(ids[0])):
        ids = _commit_ids(spark, target)[-1:]
    if not ids:
        return None
    n = ids[0]
    while S.path_exists(spark, target.commit_path(n + 1)):
        n += 1
    return _commit(spark, target, n)


def _commit_ids(spark: SparkSession, target: Target) -> list[int]:
    """Numbers of the record files (older ones may be compacted away)."""
    names = S.list_names(spark, target.commits_path)
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _compacted(spark: SparkSession, target: Target) -> int:
    """The last batch whose ledger rows are compacted, or -1."""
    names = S.list_names(spark, target.compacted_path)
    return max((int(n[:-5]) for n in names if n.endswith(".done")), default=-1)


def _read_records(spark: SparkSession, target: Target, kind: str, ddl: str) -> DataFrame:
    upto = _compacted(spark, target)
    parts = []
    if upto >= 0:
        parts.append(spark.read.schema(f"kind STRING, attempt STRING, {LEDGER_DDL}").parquet(f"{target.compacted_path}/{upto}"))
    paths = [target.commit_path(n) for n in _commit_ids(spark, target) if n > upto]
    if paths:
        parts.append(spark.read.schema(f"kind STRING, attempt STRING, {LEDGER_DDL}").json(paths))
    cols = [c.strip().split()[0] for c in ddl.split(",")]
    if not parts:
        return spark.createDataFrame([], ddl)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.where(F.col("kind") == kind).select(*cols)


def read_ledger(spark: SparkSession, target: Target) -> DataFrame:
    """One row per committed batch and (topic, partition)."""
    return _read_records(spark, target, "range", LEDGER_DDL)


def read_commits(spark: SparkSession, target: Target) -> DataFrame:
    """One row per committed batch, with the ``attempt`` that holds its rows."""
    return _read_records(spark, target, "batch", "batch_id BIGINT, attempt STRING, writer STRING, source_batch BIGINT, high_lsn BIGINT")


def compact_ledger(spark: SparkSession, target: Target, keep: int = 100) -> int:
    """Write the records of all but the last ``keep`` batches as one Parquet table and remove
    their files; returns the last batch in it (-1 if there is nothing to do). The newest record
    always stays. Readers use the newest complete table and the records after it."""
    ids = _commit_ids(spark, target)
    old = _compacted(spark, target)
    upto = ids[-1] - max(1, keep) if ids else -1
    if upto <= old:
        return old
    records = f"kind STRING, attempt STRING, {LEDGER_DDL}"
    rows = spark.read.schema(records).json([target.commit_path(n) for n in ids if old < n <= upto])
    if old >= 0:
        rows = rows.unionByName(spark.read.schema(records).parquet(f"{target.compacted_path}/{old}"))
    rows.repartitionByRange("batch_id").sortWithinPartitions("batch_id").write.mode("overwrite").parquet(f"{target.compacted_path}/{upto}")
    S.create_once(spark, f"{target.compacted_path}/{upto}.done", "")
    for n in ids:
        if n <= upto:
            S.delete_path(spark, target.commit_path(n))
    return upto


def read_location(spark: SparkSession, uri: str, schema: str | None = None) -> DataFrame:
    """All files under a data location (committed or not), by ``schema`` (DDL) or by what
    Spark infers from the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return _batch_ids(reader.parquet(uri))


def read_by_name(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A table by its catalog name: the committed batches, which are its partitions."""
    return spark.table(f"`{database}`.`{table}`")


def _columns_ddl(spark: SparkSession, target: Target) -> str:
    if not S.path_exists(spark, f"{target.location}/_schema.json"):
        raise FileNotFoundError(f"no table {target.name} at {target.location}")
    return _catalog_ddl(schema_from_spec(table_schema(spark, target), codec_types=True))


def _read_batches(spark: SparkSession, target: Target, commits: Sequence[Row], kind: str = "data", ddl: str | None = None) -> DataFrame:
    """The rows of the given commits (batch_id, attempt): only their folders are listed."""
    paths = [f"{target.batch_path(kind, c['batch_id'])}/{c['attempt']}" for c in commits]
    reader = spark.read.option("basePath", f"{target.location}/{kind}")
    return _batch_ids((reader.schema(ddl) if ddl else reader).parquet(*paths))


def _named(spark: SparkSession, target: Target, ids: DataFrame | None = None) -> list[Row]:
    """(batch_id, attempt) of all commits, or of those in ``ids``: names of folders."""
    commits = read_commits(spark, target).select("batch_id", "attempt")
    return (commits if ids is None else commits.join(ids, "batch_id", "left_semi")).collect()


def read_table(spark: SparkSession, target: Target, committed_only: bool = True, batches: DataFrame | None = None) -> DataFrame:
    """The table's rows, by the schema it was created with; by default those of committed
    batches (of ``batches`` alone, a frame with ``batch_id``)."""
    ddl = _columns_ddl(spark, target)
    if not committed_only:
        has_data = S.path_exists(spark, target.data_path) and S.list_names(spark, target.data_path)
        return read_location(spark, target.data_path, ddl) if has_data else spark.createDataFrame([], ddl)
    commits = _named(spark, target, batches)
    return _read_batches(spark, target, commits, ddl=ddl) if commits else spark.createDataFrame([], ddl)


QUARANTINE_DDL = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, _verdict STRING, batch_id BIGINT"


def read_quarantine(spark: SparkSession, target: Target) -> DataFrame:
    """Rejected wire records of committed batches."""
    ids = read_ledger(spark, target).where("quarantined > 0").select("batch_id").distinct()
    commits = _named(spark, target, ids)
    if not commits:
        return spark.createDataFrame([], QUARANTINE_DDL)
    return _read_batches(spark, target, commits, "quarantine", QUARANTINE_DDL)


def next_batch_id(spark: SparkSession, target: Target) -> int:
    last = last_commit(spark, target)
    return 0 if last is None else last["batch_id"] + 1


def batch_of(spark: SparkSession, target: Target, writer: str, source_batch: int, last: dict | None = None) -> int | None:
    """The table's id of a writer's batch, or None if it is not committed. The newest record
    knows each writer's last batch; only for an earlier one the ledger is searched."""
    last = last or last_commit(spark, target)
    if last is None or writer not in last["writers"]:
        return None
    newest, batch_id = last["writers"][writer]
    if source_batch >= newest:
        return batch_id if source_batch == newest else None
    mine = read_commits(spark, target).where((F.col("writer") == writer) & (F.col("source_batch") == int(source_batch)))
    row = mine.select("batch_id").first()
    return None if row is None else int(row["batch_id"])


def lsn_base(spark: SparkSession, target: Target, batch_id: int) -> int:
    """Highest LSN of the batches before ``batch_id`` (0 for the first), as the record before
    it says."""
    last = last_commit(spark, target)
    if last is None or batch_id <= 0:
        return 0
    before = last if batch_id > last["batch_id"] else _commit(spark, target, batch_id - 1)
    if before is None:  # compacted
        before = read_commits(spark, target).where(F.col("batch_id") == batch_id - 1).first()
    return int(before["high_lsn"])


def append_rows(
    rows: DataFrame,
    target: Target,
    source_batch: int | None = None,
    reproducible: bool = False,
    started: float | None = None,
    writer: str = "append",
    quarantine: DataFrame | None = None,
    plan: InPlace | None = None,
    bad_ranges: Sequence[Row] = (),
    redelivered: dict[tuple, int] | None = None,
    last: dict | None = None,
    on_committed: Callable[[int], None] | None = None,
) -> dict:
    """K1: append decoded rows as a batch. Returns the table's batch id, whether it was
    ``already`` committed, and the seconds spent writing rows and committing (the flush).

    ``rows`` hold the record fields plus ``_topic, _partition, _offset`` (and optionally
    ``_schema_id``, ``_timestamp``). ``writer`` and ``source_batch`` name the batch: if it is
    committed, nothing is written (only its catalog partition, if a crash left it out); without
    ``source_batch`` every call is a new batch. LSNs continue from the commit before (W3). The
    rows go to a folder of this attempt, then the record is created (see the module's
    description). ``quarantine`` rows go to the attempt's quarantine folder.

    ``reproducible`` allows in-place numbering (see ``assign_lsn``). With ``plan``, the rows'
    ranges measured for it (and ``bad_ranges`` for ``quarantine``), the ledger rows come from
    the ranges and the write only confirms them, by the counts it observes; without, they are
    read from the written files. ``last`` is the newest record, if the caller has read it."""
    spark = rows.sparkSession
    started = time.monotonic() if started is None else started
    last = last or last_commit(spark, target)
    known = None if source_batch is None else batch_of(spark, target, writer, source_batch, last)
    if known is not None:
        _add_partitions(spark, target, _named(spark, target, spark.createDataFrame([(known,)], "batch_id BIGINT")))
        return {"batch_id": known, "already": True, "write_s": 0.0, "flush_s": 0.0}
    batch_id, base = (0, 0) if last is None else (last["batch_id"] + 1, last["high_lsn"])
    if source_batch is None:
        source_batch = batch_id
    attempt = uuid.uuid4().hex
    bad_path = f"{target.batch_path('quarantine', batch_id)}/{attempt}"
    if quarantine is not None and (plan is None or bad_ranges):
        quarantine.write.parquet(bad_path)
    for c, t in (("_schema_id", "int"), ("_timestamp", "timestamp")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(t))
    numbered = assign_lsn(rows, base=base, keys=("_topic", "_partition"), order="_offset", reproducible=reproducible, plan=plan)
    seen = Observation()
    watched = numbered.observe(seen, F.count(F.lit(1)).alias("n"), F.min("_lsn").alias("lo"), F.max("_lsn").alias("hi"))
    data_path = f"{target.batch_path('data', batch_id)}/{attempt}"
    watched.write.parquet(data_path)
    written = time.monotonic()
    if plan is None:
        ranges = _written_ranges(spark, data_path, bad_path if quarantine is not None else None)
    else:
        ranges = _planned_ranges(plan.ranges, bad_ranges, base)
        total, found = sum(r["rows"] for r in ranges), seen.get
        if found["n"] != total or (total and (found["lo"], found["hi"]) != (base + 1, base + total)):
            raise RuntimeError(f"batch {batch_id} of {target.name}: {total} rows were counted, {found} written")
    record = write_ledger(spark, target, batch_id, attempt, ranges, written - started, last, writer, source_batch, redelivered or {})
    if on_committed is not None:
        on_committed(batch_id)
    # the partition before, too, should a crash have come between its record and the catalog
    _add_partitions(spark, target, [*([last] if last else []), record])
    return {"batch_id": batch_id, "already": False, "write_s": written - started, "flush_s": time.monotonic() - written}


def _written_ranges(spark: SparkSession, data_path: str, bad_path: str | None) -> list[dict]:
    """Ledger ranges computed from the files of an attempt: one partial aggregate."""
    written = spark.read.parquet(data_path).select(
        F.col("_topic").alias("topic"), F.col("_partition").cast("int").alias("partition"), F.lit(0).alias("bad"),
        F.col("_offset").alias("offset"), F.col("_lsn").alias("lsn"),
    )
    if bad_path is not None:
        written = written.unionByName(
            spark.read.parquet(bad_path).select("topic", "partition", F.lit(1).alias("bad"), "offset", F.lit(None).cast("long").alias("lsn"))
        )
    per = written.groupBy("topic", "partition").agg(
        F.sum(1 - F.col("bad")).alias("rows"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"),
        F.min("lsn").alias("min_lsn"), F.max("lsn").alias("max_lsn"), F.sum("bad").alias("quarantined"),
    )
    return [r.asDict() for r in per.collect()]  # one row per (topic, partition) of the batch


def _key_order(key: tuple) -> tuple:
    """Spark's ascending order of (topic, partition): NULLs first, strings by their bytes."""
    return tuple((x is not None, x.encode() if isinstance(x, str) else x if x is not None else 0) for x in key)


def _planned_ranges(good: Sequence[Row], bad: Sequence[Row], base: int) -> list[dict]:
    """Ledger ranges from those measured before the write: LSNs are dense in key order."""
    out: dict[tuple, dict] = {}
    for r in sorted(good, key=lambda r: _key_order((r["_topic"], r["_partition"]))):
        key = (r["_topic"], r["_partition"])
        out[key] = {
            "topic": key[0], "partition": key[1], "rows": r["n"], "min_offset": r["lo"], "max_offset": r["hi"],
            "min_lsn": base + 1, "max_lsn": base + r["n"], "quarantined": 0,
        }
        base += r["n"]
    for r in bad:
        key = (r["_topic"], r["_partition"])
        old = out.setdefault(key, {"topic": key[0], "partition": key[1], "rows": 0, "min_offset": r["lo"], "max_offset": r["hi"], "min_lsn": None, "max_lsn": None})
        old |= {"min_offset": min(old["min_offset"], r["lo"]), "max_offset": max(old["max_offset"], r["hi"]), "quarantined": r["n"]}
    return list(out.values())


def write_ledger(
    spark: SparkSession, target: Target, batch_id: int, attempt: str, ranges: Sequence[dict], seconds: float,
    last: dict | None, writer: str, source_batch: int, redelivered: dict[tuple, int],
) -> dict:
    """Commit batch N: create its record, unless another writer has. Offsets are those
    delivered, good or quarantined. Returns the record's head."""
    totals = {(t, p): [n, o, x] for t, p, n, o, x in (last or {}).get("totals", [])}
    for r in ranges:
        key = (r["topic"], r["partition"])
        n, top, lsn = totals.get(key, [0, -1, None])
        totals[key] = [n + r["rows"], max(top, r["max_offset"]), lsn if r["max_lsn"] is None else r["max_lsn"]]
    high = (last or {}).get("high_lsn", 0) + sum(r["rows"] for r in ranges)
    same = {
        "batch_id": int(batch_id), "writer": writer, "source_batch": int(source_batch), "high_lsn": high,
        "elapsed_ms": round(seconds * 1000.0, 3), "attempt": attempt,
    }
    head = same | {
        "kind": "batch", "rows": sum(r["rows"] for r in ranges),
        "writers": (last or {}).get("writers", {}) | {writer: [int(source_batch), int(batch_id)]},
        "totals": [[*k, *v] for k, v in totals.items()],
    }
    again = {k: n for k, n in redelivered.items() if n}
    lines = [head] + [{"kind": "range", **r, "redelivered": again.pop((r["topic"], r["partition"]), 0), **same} for r in ranges]
    # partitions of which nothing is new
    lines += [{"kind": "range", "topic": t, "partition": p, "rows": 0, "quarantined": 0, "redelivered": n, **same} for (t, p), n in again.items()]
    if not S.create_once(spark, target.commit_path(batch_id), "\n".join(json.dumps(x) for x in lines)):
        now = _commit(spark, target, batch_id)
        if now is None or now["attempt"] != attempt:
            for kind in ("data", "quarantine"):
                S.delete_path(spark, f"{target.batch_path(kind, batch_id)}/{attempt}")
            raise CommitConflict(f"batch {batch_id} of {target.name} was committed by {now and now['writer']}")
    S.write_text(spark, f"{target.commits_path}/_last", str(batch_id))
    return head


def _add_partitions(spark: SparkSession, target: Target, commits: Sequence) -> None:
    if commits:
        parts = [f"PARTITION (batch_id={c['batch_id']}) LOCATION '{target.batch_path('data', c['batch_id'])}/{c['attempt']}'" for c in commits]
        spark.sql(f"ALTER TABLE `{target.database}`.`{target.table}` ADD IF NOT EXISTS {' '.join(parts)}")


def repair_catalog(spark: SparkSession, target: Target) -> int:
    """Add the partitions of committed batches that the catalog lacks; how many it were."""
    shown = spark.sql(f"SHOW PARTITIONS `{target.database}`.`{target.table}`")
    have = shown.select(F.regexp_extract("partition", r"batch_id=(\d+)", 1).cast("long").alias("batch_id"))
    lost = read_commits(spark, target).select("batch_id", "attempt").join(have, "batch_id", "left_anti").collect()
    for lo in range(0, len(lost), 500):
        _add_partitions(spark, target, lost[lo : lo + 500])
    return len(lost)


def snapshot_at(spark: SparkSession, target: Target, lsn: int, path: str | None = None) -> DataFrame:
    """K4: committed rows with ``_lsn <= lsn``; written to ``path`` when given. Batches are
    chosen by the ledger's LSN ranges, so only their folders are read; the filter is pushed to
    the Parquet scan (row-group min/max on ``_lsn``) for the one that the LSN cuts."""
    ids = read_ledger(spark, target).where(F.col("min_lsn") <= F.lit(int(lsn))).select("batch_id").distinct()
    snap = read_table(spark, target, batches=ids).where(F.col("_lsn") <= F.lit(int(lsn)))
    if path is None:
        return snap
    snap.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_index(spark: SparkSession, target: Target, batches: DataFrame | None = None) -> DataFrame:
    """The offset -> LSN index of committed batches (of ``batches`` alone): four columns and
    the batch."""
    return read_table(spark, target, batches=batches).select(
        "batch_id", F.col("_topic").alias("topic"), F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"), F.col("_lsn").alias("lsn"),
    )


def flush_point_of(spark: SparkSession, target: Target, commits: DataFrame, upto: str = "upto") -> DataFrame:
    """A1 for a table: ``flush_lsn`` (NULL when nothing is covered) and ``entries_considered``.

    A batch whose offsets in a partition all lie within the commit counts by its ledger row;
    only batches that a commit cuts are read, and of them only the four index columns."""
    c = commits.select(F.col("topic"), F.col("partition"), F.col(upto).alias("__upto"))
    led = read_ledger(spark, target).join(c, ["topic", "partition"]).where(F.col("min_offset") <= F.col("__upto"))
    inside = F.col("max_offset") <= F.col("__upto")
    whole = led.where(inside).agg(F.max("max_lsn").alias("lsn"), F.sum("rows").alias("n"))
    cut = led.where(~inside).select("batch_id", "topic", "partition", "__upto")
    index = read_index(spark, target, cut.select("batch_id").distinct())
    part = index.join(cut, ["batch_id", "topic", "partition"]).where(F.col("offset") <= F.col("__upto"))
    part = part.agg(F.max("lsn").alias("lsn"), F.count(F.lit(1)).alias("n"))
    return whole.unionByName(part).agg(
        F.max("lsn").alias("flush_lsn"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("entries_considered")
    )


def prune_table_index(
    spark: SparkSession, target: Target, commits: DataFrame, flushed_lsn: int | None, upto: str = "upto"
) -> tuple[DataFrame, DataFrame]:
    """J2 for a table: (remaining entries, one-row ``pruned`` count), as ``prune_index`` over
    the whole index gives them. Batches whose entries are all covered and durable by their
    ledger ranges are counted there and not read; the others are, and joined."""
    if flushed_lsn is None:
        return prune_index(read_index(spark, target), commits, None)
    c = commits.select(F.col("topic"), F.col("partition"), F.col(upto).alias("__upto"))
    led = read_ledger(spark, target).join(c, ["topic", "partition"], "left")
    gone = (F.col("rows") == 0) | ((F.col("max_offset") <= F.col("__upto")) & (F.col("max_lsn") <= int(flushed_lsn)))
    state = led.groupBy("batch_id").agg(F.min(F.coalesce(gone, F.lit(False)).cast("int")).alias("gone"), F.sum("rows").alias("n"))
    left = [r["batch_id"] for r in state.where("gone = 0").select("batch_id").collect()]  # batch numbers
    kept = spark.createDataFrame([(x,) for x in left], "batch_id BIGINT")
    index = read_index(spark, target, kept).where(F.col("batch_id").isin(left))
    remaining, pruned = prune_index(index, commits, flushed_lsn, upto=upto)
    whole = state.where("gone = 1").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("pruned"))
    return remaining, pruned.unionByName(whole).agg(F.sum("pruned").cast("long").alias("pruned"))


def without_delivered(spark: SparkSession, target: Target, wire: DataFrame, ranges: Sequence[tuple]) -> DataFrame:
    """The records of ``wire`` whose offsets no committed batch holds, good or quarantined.
    ``ranges`` are the offset ranges (topic, partition, lo, hi) of the records; only committed
    batches whose ledger ranges meet them are read, and of them only the coordinates."""
    arriving = spark.createDataFrame(list(ranges), "topic STRING, partition INT, __lo BIGINT, __hi BIGINT")
    met = read_ledger(spark, target).join(arriving, ["topic", "partition"])
    met = met.where((F.col("min_offset") <= F.col("__hi")) & (F.col("max_offset") >= F.col("__lo")))
    coords = ["topic", "partition", "offset"]
    delivered = read_index(spark, target, met.select("batch_id").distinct()).select(*coords)
    bad = _named(spark, target, met.where("quarantined > 0").select("batch_id").distinct())
    if bad:
        delivered = delivered.unionByName(_read_batches(spark, target, bad, "quarantine", QUARANTINE_DDL).select(*coords))
    return wire.join(delivered, coords, "left_anti")


REGISTRY_DDL = "schema_id INT, schema_json STRING"


def register_schema(spark: SparkSession, target: Target, schema_id: int, schema_json: str | dict) -> None:
    """K5: record a schema version for the table. The same text again is nothing new;
    another text for a registered id is refused."""
    text = schema_json if isinstance(schema_json, str) else json.dumps(schema_json, separators=(",", ":"))
    known = read_registry(spark, target).where(F.col("schema_id") == int(schema_id)).first()
    if known is not None:
        if known["schema_json"] != text:
            raise ValueError(f"schema id {schema_id} of {target.name} is registered with another text")
        return
    row = spark.createDataFrame([(int(schema_id), text)], REGISTRY_DDL)
    row.write.mode("overwrite").parquet(f"{target.schemas_path}/schema_id={int(schema_id)}")


def read_registry(spark: SparkSession, target: Target) -> DataFrame:
    if not S.path_exists(spark, target.schemas_path):
        return spark.createDataFrame([], REGISTRY_DDL)
    return spark.read.parquet(target.schemas_path).select(F.col("schema_id").cast("int"), "schema_json")


def with_schema(df: DataFrame, registry: DataFrame, schema_id: str = "_schema_id") -> DataFrame:
    """Flag rows whose schema id has a registered schema (left join; Spark broadcasts the
    registry below its size threshold)."""
    reg = registry.select(F.col("schema_id").alias("__sid"), F.lit(True).alias("__reg")).distinct()
    joined = df.join(reg, F.col(schema_id) == F.col("__sid"), "left")
    return joined.withColumn("_schema_registered", F.coalesce(F.col("__reg"), F.lit(False))).drop("__sid", "__reg")


def table_status(spark: SparkSession, target: Target) -> DataFrame:
    """A2: database, table, commit LSN (max written, committed or not), flush LSN (max
    committed), cardinality (committed rows) and location. One row.

    All but the commit LSN come from the newest record; for that one, only folders of a batch
    that isn't committed yet are read. A fresh table reports 0 rows and NULL LSNs."""
    last = last_commit(spark, target)
    rows = sum(t[2] for t in last["totals"]) if last else 0
    flushed = last["high_lsn"] if rows else None
    ahead = target.batch_path("data", last["batch_id"] + 1 if last else 0)
    written = None
    if S.list_names(spark, ahead):
        written = spark.read.schema("_lsn BIGINT").option("recursiveFileLookup", "true").parquet(ahead).agg(F.max("_lsn")).first()[0]
    commit_lsn = max((x for x in (flushed, written) if x is not None), default=None)
    return spark.range(1).select(
        F.lit(target.database).alias("database"),
        F.lit(target.table).alias("table"),
        F.lit(commit_lsn).cast("long").alias("commit_lsn"),
        F.lit(flushed).cast("long").alias("flush_lsn"),
        F.lit(rows).cast("long").alias("cardinality"),
        F.lit(target.location).alias("location"),
    )


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """A2: one row with all tables as ``db.table, db.table`` (sorted)."""
    dbs = [database] if database else [d.name for d in spark.catalog.listDatabases()]
    listed = None
    for d in dbs:
        own = spark.sql(f"SHOW TABLES IN `{d}`").where("NOT isTemporary").select(F.col("namespace").alias("database"), F.col("tableName").alias("table"))
        listed = own if listed is None else listed.unionByName(own)
    if listed is None:
        listed = spark.createDataFrame([], "database STRING, table STRING")
    return listed.agg(
        F.array_join(F.sort_array(F.collect_list(qualified_name("database", "table"))), ", ").alias("tables")
    )
