"""Small scalar helpers (P6-P10, P12-P14) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
# The bit generator of ``random_boolean`` (Lehmer / MINSTD step).
MINSTD_MOD, MINSTD_MUL = 2147483647, 48271


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def saturating_int(x: Column | str) -> Column:
    """Long -> int, clamped to the 32-bit range."""
    return F.least(F.greatest(_col(x).cast("long"), F.lit(INT_MIN)), F.lit(INT_MAX)).cast("int")


def sized_string(n: int) -> Column:
    """``n`` ASCII 'A' characters; n <= 0 gives the empty string."""
    return F.repeat(F.lit("A"), max(0, int(n)))


def random_boolean(seq: Column | str, seed: int = 0) -> Column:
    """A replay-safe pseudo-random boolean of a sequence number.

    One MINSTD step of ``(seq + seed) mod m``, then bit 4 of the result: integer
    arithmetic only, so SQL engines can repeat it, and a replay yields the same value.
    """
    x = (_col(seq).cast("long") + F.lit(int(seed))) % F.lit(MINSTD_MOD)
    x = F.when(x < 0, x + F.lit(MINSTD_MOD)).otherwise(x)
    step = (x * F.lit(MINSTD_MUL)) % F.lit(MINSTD_MOD)
    return F.shiftright(step, 4).bitwiseAND(F.lit(1)) == 1


def clamp_positive(value: int) -> int:
    """Configuration values <= 0 become 1."""
    return value if value > 0 else 1


def target_total(rows_per_second: int, seconds: int, run_indefinitely: bool = False) -> int:
    """Rows a bounded generator emits; 0 means unlimited."""
    if run_indefinitely or seconds <= 0:
        return 0
    return int(clamp_positive(rows_per_second)) * int(seconds)


def qualified_name(db: Column | str, table: Column | str) -> Column:
    """P10: ``db.table``."""
    return F.concat_ws(".", _col(db), _col(table))


def table_uri(location: Column | str, db: Column | str, table: Column | str) -> Column:
    """P10: the location if it already ends in ``/db/table``, else location minus one
    trailing slash, plus ``/db/table``."""
    loc, suffix = _col(location), F.concat(F.lit("/"), _col(db), F.lit("/"), _col(table))
    return F.when(loc.endswith(suffix), loc).otherwise(
        F.concat(F.regexp_replace(loc, "/$", ""), suffix)
    )


def table_uri_text(location: str, db: str, table: str) -> str:
    """P10 for one configured location (the same rule as ``table_uri``, without Spark)."""
    suffix = f"/{db}/{table}"
    if location.endswith(suffix):
        return location
    return (location[:-1] if location.endswith("/") else location) + suffix


def progress_pct(current: Column | str, total: Column | str) -> Column:
    """Integer min(100, current*100 div total); NULL when total <= 0."""
    cur, tot = _col(current).cast("long"), _col(total).cast("long")
    pct = F.least(F.lit(100).cast("long"), F.call_function("div", cur * 100, F.when(tot > 0, tot)))
    return F.when(tot > 0, pct)


def throughput(rows: Column | str, seconds: Column | str) -> Column:
    """Rows / max(0.001, seconds)."""
    return _col(rows).cast("double") / F.greatest(F.lit(0.001), _col(seconds).cast("double"))
