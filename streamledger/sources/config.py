"""Generator settings from a source-connector style JSON config.

Clamping follows the reference generator: a rate or size <= 0 becomes 1; a duration
<= 0 or ``task.run.indefinitely`` means unbounded. The schema is required.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalar import clamp_positive
from ..schema import SchemaSpecError, schema_from_spec
from .generate import generate_stream

# Source config keys and their defaults.
RATE_KEY, RATE_DEFAULT = "task.messages.per.second", 1
SIZE_KEY, SIZE_DEFAULT = "message.size.bytes", 100
DURATION_KEY, DURATION_DEFAULT = "task.max.duration.seconds", 5
INDEFINITE_KEY = "task.run.indefinitely"
TOPIC_KEY, TOPIC_DEFAULT = "output.topic", "source-1"
SCHEMA_KEY = "record.schema.json"


def _int(value, default: int) -> int:
    try:
        return int(str(value).strip())
    except (TypeError, ValueError):
        return default


def generator_options(config: dict | str) -> dict:
    """Keyword arguments for ``generate_stream`` plus ``topic`` and ``schema``."""
    cfg = json.loads(config) if isinstance(config, str) else dict(config)
    cfg = cfg.get("config", cfg)  # accept the connector envelope {"name", "config"}
    spec = cfg.get(SCHEMA_KEY)
    if spec is None or (isinstance(spec, str) and not spec.strip()):
        raise SchemaSpecError(f"Missing required {SCHEMA_KEY}")
    return {
        "schema": schema_from_spec(spec),
        "rows_per_second": clamp_positive(_int(cfg.get(RATE_KEY), RATE_DEFAULT)),
        "string_bytes": clamp_positive(_int(cfg.get(SIZE_KEY), SIZE_DEFAULT)),
        "max_seconds": _int(cfg.get(DURATION_KEY), DURATION_DEFAULT),
        "run_indefinitely": str(cfg.get(INDEFINITE_KEY, "false")).strip().lower() == "true",
        "topic": cfg.get(TOPIC_KEY) or TOPIC_DEFAULT,
    }


def stream_from_config(spark: SparkSession, config: dict | str, **overrides) -> DataFrame:
    """S2 configured like the source connector (``topic`` is left to the publisher)."""
    opts = generator_options(config)
    opts.pop("topic")
    opts.update(overrides)
    return generate_stream(spark, **opts)
