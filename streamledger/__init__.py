"""streamledger: framed Avro record streams into append-only tables, on Spark.

Main entry points (see the README for the full list):

- ``schema_from_spec`` — record spec (Avro record JSON or legacy field array) -> StructType
- ``generate_rows`` / ``generate_stream`` / ``bounded_stream`` — generated rows for a schema (batch / rate stream / one that ends)
- ``encode_wire`` / ``publish`` / ``publish_stream`` — Avro + 5-byte frame, to Kafka or a folder
- ``read_wire`` — framed records with topic / partition / offset
- ``decode_payload`` / ``require_ok`` / ``split_bad`` — frame check, decode, bad-record policy
- ``ingest`` — the streaming ingest into a ledgered table (exactly-once effect)
- ``Target``, ``target_for``, ``ensure_table``, ``read_table``, ``snapshot_at``, ``table_status``
- ``CommitConflict``, ``compact_ledger``, ``repair_catalog`` — the table's commit records
- ``assign_lsn``, ``flush_point``, ``prune_index``, ``reconcile``, ``reconcile_content``
- ``reconcile_ranges``, ``reconcile_diff`` — which offsets are missing or doubled, which rows differ
"""

from .operators.decode import decode_payload, require_ok, split_bad
from .operators.ledger import flush_point, prune_index
from .operators.sequence import assign_lsn
from .operators.verify import reconcile, reconcile_content, reconcile_diff, reconcile_ranges
from .schema import schema_from_spec
from .sinks.table import (
    CommitConflict,
    Target,
    append_rows,
    compact_ledger,
    ensure_table,
    read_table,
    repair_catalog,
    snapshot_at,
    table_status,
    target_for,
)
from .sinks.wire import encode_wire, publish, publish_stream
from .sources.generate import bounded_stream, generate_rows, generate_stream
from .sources.wire import read_wire
from .streaming.ingest import ingest

__all__ = [
    "CommitConflict",
    "Target",
    "append_rows",
    "assign_lsn",
    "bounded_stream",
    "compact_ledger",
    "decode_payload",
    "encode_wire",
    "ensure_table",
    "flush_point",
    "generate_rows",
    "generate_stream",
    "ingest",
    "prune_index",
    "publish",
    "publish_stream",
    "read_table",
    "read_wire",
    "reconcile",
    "reconcile_content",
    "reconcile_diff",
    "reconcile_ranges",
    "repair_catalog",
    "require_ok",
    "schema_from_spec",
    "snapshot_at",
    "split_bad",
    "table_status",
    "target_for",
]
