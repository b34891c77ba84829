"""Reconciliation (A7, A8): counts and contents of the stream against the table.

Contents are compared by order-free checksums of offset buckets: a partial aggregate per side,
so the shuffle carries a row per bucket and task, not a row per offset. Only buckets that
differ are looked at row by row, for ranges of missing and doubled offsets or for the rows
that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COORDS = ("topic", "partition", "offset")


#: Offsets of a bucket, buckets of a node of the tree above them, and levels above the buckets.
BUCKET, FANOUT, LEVELS = 4096, 64, 3
#: Up to so many differing buckets are named in a filter that reaches the scan; more are joined.
NAMED_BUCKETS = 256


class ReconcileError(AssertionError):
    pass


def reconcile(expected, readers: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """One row per reader: ``reader, rows, expected, matches``. ``expected`` is an int
    or a one-row DataFrame with column ``expected``. Strict mode raises on a mismatch.

    Each reader count is a partial aggregate; the per-reader rows are unioned."""
    if not isinstance(expected, int):
        # one scalar to the driver: the expected count of a one-row frame
        expected = int(expected.select(F.col("expected").cast("long")).first()[0])
    counts = None
    for name, df in readers.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("reader"), "rows")
        counts = c if counts is None else counts.unionByName(c)
    out = counts.select(
        "reader",
        "rows",
        F.lit(int(expected)).cast("long").alias("expected"),
        (F.col("rows") == F.lit(int(expected))).alias("matches"),
    )
    if strict:
        bad = out.where(~F.col("matches")).collect()
        if bad:
            raise ReconcileError(f"row counts differ: {[r.asDict() for r in bad]}")
    return out


def _checksum(cols: Sequence[str]):
    # xxhash64 passes over NULLs, so where they stand is hashed too
    flags = [F.col(c).isNull() for c in cols]
    return F.sum(F.xxhash64(*flags, *cols).cast("decimal(38,0)"))


def _bucket(offset: str, width: int) -> Column:
    """First offset of the bucket."""
    return F.col(offset) - F.pmod(F.col(offset), F.lit(int(width)))


def _sides(wire: DataFrame, table: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per ``by`` the columns ``sums`` of both frames, as ``w_`` and ``t_`` (0 where a side has
    none). A union and an aggregate: NULL keys are values."""

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        zero = [F.lit(0).cast(df.schema[c].dataType).alias(f"{other}_{c}") for c in sums]
        return df.select(*by, *[F.col(c).alias(f"{own}_{c}") for c in sums], *zero)

    names = [f"{x}_{c}" for x in "wt" for c in sums]
    both = side(wire, "w", "t").unionByName(side(table, "t", "w"))
    return both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names])


def checksum_tree(
    df: DataFrame, keys: Sequence[str], offset: str, content: Sequence[str] = (),
    width: int = BUCKET, fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """(``level, *keys, node, rows, checksum``): level 0 has the buckets of ``width`` offsets,
    every level above the nodes of ``fanout`` times as many. ``node`` is the first offset. Rows
    are aggregated once, to buckets; the levels above are sums of these. It can be stored beside
    a table, by level."""
    leaves = df.groupBy(*keys, _bucket(offset, width).alias("node")).agg(
        F.count(F.lit(1)).alias("rows"), _checksum([offset, *content]).alias("checksum")
    )
    spans = F.array(*[F.struct(F.lit(k).alias("level"), (F.col("node") - F.pmod("node", F.lit(width * fanout**k))).alias("at")) for k in range(levels + 1)])
    placed = leaves.select(*keys, F.explode(spans).alias("__n"), "rows", "checksum")
    return placed.groupBy(F.col("__n.level").alias("level"), *keys, F.col("__n.at").alias("node")).agg(
        F.sum("rows").alias("rows"), F.sum("checksum").cast("decimal(38,0)").alias("checksum")
    )


def differing_buckets(
    wire_tree: DataFrame, table_tree: DataFrame, keys: Sequence[str], width: int = BUCKET, fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """(``*keys, node``): the buckets in which two trees differ, found from the top down: of
    every level only the children of differing nodes are compared."""
    at = None
    for level in range(levels, -1, -1):
        one, two = (t.where(F.col("level") == level).drop("level") for t in (wire_tree, table_tree))
        if at is not None:
            parent = width * fanout ** (level + 1)
            up = (F.col("node") - F.pmod("node", F.lit(parent))).alias("__up")
            over = at.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("node").alias("__n"))
            same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
            one, two = (t.select("*", up).join(over, [*same, F.col("__up") == F.col("__n")], "left_semi").drop("__up") for t in (one, two))
        met = _sides(one, two, [*keys, "node"], ["rows", "checksum"])
        at = met.where((F.col("w_rows") != F.col("t_rows")) | (F.col("w_checksum") != F.col("t_checksum"))).select(*keys, "node")
    return at


def _within(df: DataFrame, buckets: DataFrame, keys: Sequence[str], offset: str, width: int) -> DataFrame:
    """The rows of the given buckets. A few buckets become a filter on keys and offsets, which
    Parquet scans use to skip files and row groups; many are joined."""
    few = buckets.limit(NAMED_BUCKETS + 1).collect()
    if len(few) > NAMED_BUCKETS:
        own = buckets.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("node").alias("__n"))
        same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
        return df.join(own, [*same, _bucket(offset, width) == F.col("__n")], "left_semi")
    hit = F.lit(False)
    for r in few:
        one = F.col(offset).between(r["node"], r["node"] + width - 1)
        for k in keys:
            one = one & (F.col(k).isNull() if r[k] is None else F.col(k) == F.lit(r[k]))
        hit = one if r is few[0] else hit | one
    return df.where(hit)


def _islands(faults: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """(``*keys, fault, first_offset, last_offset, offsets``): runs of consecutive offsets of
    (``*keys, fault, offset``). Runs are formed inside buckets; those that touch a bucket's edge
    are then joined across edges, of which a bucket has two at most."""
    by = [*keys, "fault"]
    in_bucket = Window.partitionBy(*by, "__b").orderBy("offset")
    ranked = faults.select("*", _bucket("offset", width).alias("__b"))
    ranked = ranked.select("*", (F.col("offset") - F.row_number().over(in_bucket)).alias("__run"))
    runs = ranked.groupBy(*by, "__b", "__run").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    edge = (F.col("lo") == F.col("__b")) | (F.col("hi") == F.col("__b") + (width - 1))
    inner = runs.where(~edge).select(*by, "lo", "hi")
    along = Window.partitionBy(*by).orderBy("lo")
    outer = runs.where(edge).select(*by, "lo", "hi", (F.col("lo") != F.coalesce(F.lag("hi").over(along) + 1, F.lit(-1))).cast("int").alias("__new"))
    outer = outer.select("*", F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("__g"))
    outer = outer.groupBy(*by, "__g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(*by, "lo", "hi")
    return inner.unionByName(outer).select(
        *by, F.col("lo").alias("first_offset"), F.col("hi").alias("last_offset"), (F.col("hi") - F.col("lo") + 1).alias("offsets")
    )


def _fault() -> Column:
    """What the counts of one offset on both sides say (NULL: the same number)."""
    w, t = F.col("w_n"), F.col("t_n")
    return F.when((w > 0) & (t == 0), "missing").when((w == 0) & (t > 0), "extra").when(t > w, "doubled").when(t < w, "missing")


def reconcile_ranges(
    wire: DataFrame,
    table: DataFrame,
    keys: Sequence[str] = ("topic", "partition"),
    offset: str = "offset",
    table_offset: str | None = None,
    width: int = BUCKET,
) -> DataFrame:
    """Per partition the ranges of consecutive offsets that are ``missing`` in the table,
    ``doubled`` (there more often than on the wire) or ``extra`` (not on the wire):
    ``*keys, fault, first_offset, last_offset, offsets``. No row: the same offsets. Offsets are
    counted one by one in differing buckets only."""
    keys = list(keys)
    t = table.select(*keys, F.col(table_offset or offset).alias("offset"))
    w = wire.select(*keys, F.col(offset).alias("offset"))
    buckets = differing_buckets(*(checksum_tree(x, keys, "offset", (), width) for x in (w, t)), keys, width)
    counted = [_within(x, buckets, keys, "offset", width).groupBy(*keys, "offset").agg(F.count(F.lit(1)).alias("n")) for x in (w, t)]
    met = _sides(*counted, [*keys, "offset"], ["n"]).select(*keys, "offset", _fault().alias("fault")).where("fault IS NOT NULL")
    return _islands(met, keys, width)


def reconcile_diff(
    wire: DataFrame,
    table: DataFrame,
    keys: Sequence[str] = ("topic", "partition"),
    offset: str = "offset",
    content: Sequence[str] | None = None,
    table_offset: str | None = None,
    width: int = BUCKET,
) -> DataFrame:
    """The rows that differ: ``*keys, offset, fault, columns``. A ``changed`` row names the
    columns whose values differ (NULL is a value); the other faults are those of
    ``reconcile_ranges``. Trees of checksums are compared from the top down, and rows are read
    in differing buckets only."""
    keys = list(keys)
    if content is None:
        content = [c for c in wire.columns if c in table.columns and c not in (*keys, offset, table_offset)]
    content = list(content)
    w = wire.select(*keys, F.col(offset).alias("offset"), *content)
    t = table.select(*keys, F.col(table_offset or offset).alias("offset"), *content)
    buckets = differing_buckets(*(checksum_tree(x, keys, "offset", content, width) for x in (w, t)), keys, width)
    values = F.struct(*content) if content else F.struct(F.lit(0).alias("__none"))

    def per_offset(df: DataFrame, side: str) -> DataFrame:
        rows = _within(df, buckets, keys, "offset", width).groupBy(*keys, "offset")
        return rows.agg(F.count(F.lit(1)).alias("n"), _checksum(["offset", *content]).alias("s"), F.max(values).alias(f"{side}_v"))

    one, two = per_offset(w, "w"), per_offset(t, "t")
    by = [*keys, "offset"]
    sums = _sides(one, two, by, ["n", "s"])
    both = one.select(*by, "w_v", F.lit(None).cast(one.schema["w_v"].dataType).alias("t_v"))
    both = both.unionByName(two.select(*by, F.lit(None).cast(one.schema["w_v"].dataType).alias("w_v"), "t_v"))
    both = both.groupBy(*by).agg(F.max("w_v").alias("w_v"), F.max("t_v").alias("t_v"))
    met = sums.alias("a").join(both.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by])
    changed = (F.col("w_n") == F.col("t_n")) & (F.col("w_s") != F.col("t_s"))
    unequal = [F.when(~F.col(f"w_v.{c}").eqNullSafe(F.col(f"t_v.{c}")), F.lit(c)) for c in content]
    names = F.concat_ws(",", *unequal) if content else F.lit("")
    return met.select(
        *[F.col(f"a.{c}") for c in by],
        F.coalesce(_fault(), F.when(changed, "changed")).alias("fault"),
        F.when(changed, names).alias("columns"),
    ).where("fault IS NOT NULL")


def reconcile_content(
    wire: DataFrame,
    table: DataFrame,
    keys: Sequence[str] = ("topic", "partition"),
    offset: str = "offset",
    content: Sequence[str] | None = None,
    table_offset: str | None = None,
) -> DataFrame:
    """Per partition, an order-free checksum comparison and duplicate / gap counts.

    Equal row counts can hide a lost row plus a duplicate; the checksum (sum of 64-bit
    hashes as a decimal) and the number of distinct offsets expose both. Gaps are offsets
    missing between the table's min and max. ``content`` names the columns compared beside the
    offset (default: every column that both sides have); NULL is a value. Distinct offsets are
    counted by one bitmap per 32,768 offsets, combined before the shuffle; all else is a partial
    aggregate too."""
    keys = list(keys)
    table_offset = table_offset or offset
    if content is None:
        content = [c for c in wire.columns if c in table.columns and c not in (*keys, offset, table_offset)]
    content = list(content)
    hcols_w = [offset, *content]
    t = table.select(*keys, F.col(table_offset).alias(offset), *content)

    w = wire.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("wire_rows"), _checksum(hcols_w).alias("__wire_sum")
    )
    per_bitmap = t.groupBy(*keys, F.bitmap_bucket_number(offset).alias("__bitmap")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(offset))).alias("d"),
        F.min(offset).alias("lo"),
        F.max(offset).alias("hi"),
        _checksum(hcols_w).alias("s"),
    )
    tb = per_bitmap.groupBy(*keys).agg(
        F.sum("n").alias("table_rows"),
        F.sum("d").alias("__distinct"),
        F.min("lo").alias("__min"),
        F.max("hi").alias("__max"),
        F.sum("s").cast("decimal(38,0)").alias("__table_sum"),
    )
    j = w.join(tb, keys, "full")
    return j.select(
        *keys,
        F.coalesce("wire_rows", F.lit(0)).alias("wire_rows"),
        F.coalesce("table_rows", F.lit(0)).alias("table_rows"),
        F.coalesce(F.col("table_rows") - F.col("__distinct"), F.lit(0)).alias("duplicates"),
        F.coalesce(F.col("__max") - F.col("__min") + 1 - F.col("__distinct"), F.lit(0)).alias("gaps"),
        F.coalesce(F.col("__wire_sum") == F.col("__table_sum"), F.lit(False)).alias("checksum_match"),
    )
