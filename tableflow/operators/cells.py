"""Key-value cell tables: (rowkey, family, qualifier, value).

A wide table is unpivoted into cells, row keys can be salted so that
monotonic keys spread over buckets, the bulk layout writes one sorted file
set per salt, and the read side offers column scans, row-key scans, a
typed wide read (pivot), a single-column prefix filter and cell-level
upserts (last write per cell wins).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.defaults import DEFAULT_FAMILY
from tableflow.functions.codec import bytes4_to_int, int_to_bytes4, text_to_bytes
from tableflow.functions.hashing import java_string_hash, salt_prefix
from tableflow.operators.columns import _q

CELL_COLUMNS = ("rowkey", "family", "qualifier", "value")
#: Size that a file of a bulk load aims at, and the most partitions derived from an estimate.
FILE_BYTES = 256 << 20
MAX_FILES = 100_000


def _cell_value(df: DataFrame, name: str, value_format: str) -> Column:
    c = F.col(_q(name))
    dtype = df.schema[name].dataType
    if value_format == "text":
        return c.cast("string")
    if value_format == "bytes":
        if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
            return int_to_bytes4(c)
        if isinstance(dtype, T.BinaryType):
            return c
        return text_to_bytes(c.cast("string"))
    raise ValueError("value_format must be 'text' or 'bytes'")


def rows_to_cells(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    family: str = DEFAULT_FAMILY,
    key_as_cell: bool = False,
    drop_empty: bool = False,
    value_format: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Unpivot rows into cells keyed by the text of ``key``.

    ``value_format='text'`` stores every value as its string form;
    ``'bytes'`` stores strings as UTF-8 and ints as 4 big-endian bytes.
    NULL values become absent cells; ``drop_empty`` also drops ``''``.
    ``carry`` columns (e.g. a write timestamp) are copied onto every cell.
    """
    cols = list(columns) if columns is not None else [c for c in df.columns if c != key]
    if key_as_cell and key not in cols:
        cols = [key] + cols
    if not cols:
        raise ValueError("no value columns")
    carry = list(carry)
    wide = df.select(
        F.col(_q(key)).cast("string").alias("rowkey"),
        *[F.col(_q(c)) for c in carry],
        *[_cell_value(df, c, value_format).alias(c) for c in cols],
    )
    ids = ["rowkey", *carry]
    cells = wide.unpivot(ids, cols, "qualifier", "value").filter(F.col("value").isNotNull())
    if drop_empty:
        cells = cells.filter(F.length("value") > 0)
    return cells.select("rowkey", F.lit(family).alias("family"), "qualifier", "value", *carry)


def salt_cells(cells: DataFrame, modulus: int, key_col: str = "rowkey") -> DataFrame:
    """Add ``salt`` (zero-padded bucket) and ``salted`` (``salt:key``)."""
    h = "_jhash"
    with_hash = cells.withColumn(h, java_string_hash(key_col))
    salted = with_hash.withColumn("salt", salt_prefix(key_col, modulus, hash_col=F.col(h)))
    return salted.withColumn("salted", F.concat_ws(":", F.col("salt"), F.col(key_col))).drop(h)


def salt_of(salted: str | Column) -> Column:
    """Salt part of a salted key."""
    c = F.col(salted) if isinstance(salted, str) else salted
    return F.split(c, ":").getItem(0)


def _partitions_for(df: DataFrame) -> int:
    """Partitions of about ``FILE_BYTES`` by the optimizer's size estimate."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, min(MAX_FILES, -(-size // FILE_BYTES)))


def bulk_layout(salted_cells: DataFrame, num_files: int | None = None, ordering: str = "range") -> DataFrame:
    """Order cells for a bulk load.

    ``ordering='range'`` (default): one range shuffle on the full sort key
    (salted key, qualifier, value) does the job of a global sort plus a
    per-salt repartition in ONE exchange; each output partition is one
    sorted key range that overlaps no other, and sampled bounds split hot
    salts or rows across files.  Spark samples the input for the bounds
    first, so the input plan runs twice.

    ``ordering='hash'``: one pass, no sampling - cells are spread over
    partitions by (salt, hash of the row key), so a hot salt still uses many
    files and all cells of a row stay in one file; each file is sorted, but
    files of one salt overlap in key range.

    ``num_files`` sets the number of partitions; it defaults to the planned size
    of the cells over ``FILE_BYTES``, at least ``spark.sql.shuffle.partitions``.
    Sorting leads with ``salt`` (a prefix of ``salted``, so the order is the
    same) so the per-salt partitioned writer keeps this order.
    """
    keys = ["salted", "qualifier", "value"]
    parts = num_files or _partitions_for(salted_cells)
    if ordering == "range":
        spread = salted_cells.repartitionByRange(parts, *keys)
    elif ordering == "hash":
        spread = salted_cells.repartition(parts, "salt", F.xxhash64("rowkey"))
    else:
        raise ValueError("ordering must be 'range' or 'hash'")
    return spread.sortWithinPartitions("salt", *keys)


def write_bulk(salted_cells: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite",
               ordering: str = "range") -> None:
    """Write the bulk layout as parquet, one directory per salt."""
    (
        bulk_layout(salted_cells, num_files, ordering)
        .write.mode(mode)
        .partitionBy("salt")
        .parquet(path)
    )


def read_bulk(spark: SparkSession, path: str, value_type: str = "string") -> DataFrame:
    """Read a bulk layout back; ``salt`` stays text (no type inference)."""
    schema = f"rowkey string, family string, qualifier string, value {value_type}, salted string, salt string"
    return spark.read.schema(schema).parquet(path)


def write_cells(cells: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite") -> None:
    """Store cells ordered by (qualifier, value, row key), so that column and prefix
    scans skip the row groups without a match."""
    keys = ["qualifier", "value", "rowkey"]
    spread = cells.select(*CELL_COLUMNS).repartitionByRange(num_files or _partitions_for(cells), *keys)
    spread.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def scan_columns(cells: DataFrame, qualifiers: Sequence[str], family: str = DEFAULT_FAMILY) -> DataFrame:
    """Column projection on a cell table (filters reach the parquet scan)."""
    return cells.filter((F.col("family") == family) & F.col("qualifier").isin(list(qualifiers)))


def row_keys(cells: DataFrame) -> DataFrame:
    return cells.select("rowkey").distinct()


def cells_long(cells: DataFrame) -> DataFrame:
    """Scan flattened to (qualifier, value) pairs."""
    return cells.select("qualifier", "value")


def _decode(value: Column, kind: str | None) -> Column:
    if kind is None or kind == "raw":
        return value
    if kind == "int4":
        return bytes4_to_int(value)
    if kind == "utf8":
        return F.decode(value, "UTF-8")
    return value.try_cast(kind)


def cells_to_rows(
    cells: DataFrame,
    columns: Mapping[str, str | None] | Sequence[str],
    key_name: str = "rowkey",
    family: str = DEFAULT_FAMILY,
) -> DataFrame:
    """Typed wide read: one row per row key, one column per declared qualifier.

    ``columns`` maps qualifier -> decoding (``None``/``'raw'`` keeps the
    value, ``'int4'`` reads 4 big-endian bytes, ``'utf8'`` decodes bytes,
    any other name is a ``try_cast`` target).  The qualifier list is
    declared, so the pivot needs no extra job to find its values.
    """
    decl = dict(columns) if isinstance(columns, Mapping) else {c: None for c in columns}
    quals = list(decl)
    wide = (
        cells.filter((F.col("family") == family) & F.col("qualifier").isin(quals))
        .groupBy("rowkey")
        .pivot("qualifier", quals)
        .agg(F.first("value", ignorenulls=True))
    )
    return wide.select(
        F.col("rowkey").alias(key_name),
        *[_decode(F.col(_q(q)), decl[q]).alias(q) for q in quals],
    )


def prefix_filter(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose ``column`` starts with ``prefix`` (a parquet pushed filter)."""
    return df.filter(F.col(_q(column)).startswith(prefix))


def cells_prefix_filter(
    cells: DataFrame,
    qualifier: str,
    prefix: str,
    family: str = DEFAULT_FAMILY,
    keep_missing: bool = False,
) -> DataFrame:
    """All cells of the rows whose ``qualifier`` cell starts with ``prefix``.

    ``keep_missing=True`` also keeps rows that have no such cell (the
    behaviour of a value filter without filter-if-missing).
    """
    this_col = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    if keep_missing:
        failing = cells.filter(this_col & ~F.col("value").startswith(prefix)).select("rowkey")
        return cells.join(failing, "rowkey", "left_anti")
    matching = cells.filter(this_col & F.col("value").startswith(prefix)).select("rowkey")
    return cells.join(matching, "rowkey", "left_semi")


#: Key ranges that an indexed scan pushes down at most.
MOST_RANGES = 64


def write_indexed_cells(cells: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite",
                        row_group_bytes: int = 16 << 20) -> None:
    """Store cells twice: ``<path>/cells`` in the order of the row keys, and ``<path>/index``, by
    qualifier and value, with the row keys that hold them."""
    keys = ["rowkey", "family", "qualifier"]
    rows = cells.select(*CELL_COLUMNS).repartitionByRange(num_files or _partitions_for(cells), *keys).sortWithinPartitions(*keys)
    # row groups are what a scan can skip
    rows.write.mode(mode).option("parquet.block.size", row_group_bytes).parquet(f"{path}/cells")
    write_cells(cells, f"{path}/index", num_files, mode)


def key_ranges(keys: DataFrame, most: int = MOST_RANGES) -> list[tuple[str, str]]:
    """At most ``most`` ranges that cover all row keys: the least and greatest key of each beginning.

    Keys are grouped by their first characters, as many as leave no more than
    ``most`` groups; only those groups reach the driver.
    """
    # a longer beginning gives more groups: one pass finds how many characters are still few enough
    lengths = [0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32]
    groups = keys.agg(*[F.approx_count_distinct(F.left("rowkey", F.lit(n)), 0.02).alias(f"n{n}") for n in lengths]).first()
    for n in reversed([n for n in lengths if groups[f"n{n}"] <= most]):
        found = keys.groupBy(F.left("rowkey", F.lit(n))).agg(F.min("rowkey").alias("low"), F.max("rowkey").alias("high")).limit(most + 1).collect()
        if len(found) <= most:
            return sorted((r["low"], r["high"]) for r in found)
    return []


def indexed_prefix_filter(spark: SparkSession, path: str, qualifier: str, prefix: str, family: str = DEFAULT_FAMILY) -> DataFrame:
    """All cells of the rows whose ``qualifier`` cell starts with ``prefix``, by the index.

    The index gives the row keys (its filters are pushed down), their ranges are
    pushed down to the cells, so row groups outside them are skipped, and a semi join
    keeps the rows themselves.
    """
    index = spark.read.parquet(f"{path}/index")
    found = (index.filter((F.col("qualifier") == qualifier) & F.col("value").startswith(prefix) & (F.col("family") == family))
             .select("rowkey").distinct())
    ranges = key_ranges(found)
    cells = spark.read.parquet(f"{path}/cells")
    if not ranges:
        return cells.filter(F.lit(False))
    inside = reduce(Column.__or__, [F.col("rowkey").between(low, high) for low, high in ranges])
    return cells.filter(inside).join(found, "rowkey", "left_semi").select(*CELL_COLUMNS)


def upsert_cells(
    base: DataFrame, updates: DataFrame, order_cols: Sequence[str], keep_order: bool = False
) -> DataFrame:
    """Cell-level upsert: per (rowkey, family, qualifier) the last write wins.

    Both inputs carry the cell columns plus ``order_cols`` (a unique,
    increasing write order).  Cells absent from later writes survive; NULL
    values are not writes.  ``max_by`` is a partial aggregate, so a hot cell
    collapses map-side before the shuffle.
    """
    order = list(order_cols)
    cols = [*CELL_COLUMNS, *order]
    both = base.select(*cols).unionByName(updates.select(*cols))
    return latest_cells(both, order, keep_order)


def latest_cells(writes: DataFrame, order_cols: Sequence[str], keep_order: bool = False) -> DataFrame:
    """Per cell the value of the last write (``order_cols`` ascending).

    ``keep_order=True`` also returns the winning write's order columns, so
    the result can take part in later upserts.
    """
    order = list(order_cols)
    live = writes.filter(F.col("value").isNotNull())
    if not keep_order:
        return live.groupBy("rowkey", "family", "qualifier").agg(
            F.max_by("value", F.struct(*order)).alias("value")
        )
    win = live.groupBy("rowkey", "family", "qualifier").agg(
        F.max_by(F.struct("value", *order), F.struct(*order)).alias("_w")
    )
    return win.select("rowkey", "family", "qualifier", *[F.col(f"_w.{c}").alias(c) for c in ["value", *order]])


def append_cell_writes(writes: DataFrame, path: str, order_cols: Sequence[str]) -> None:
    """Store cell writes (with their write order) by appending new files only;
    nothing already stored is read or rewritten."""
    writes.select(*CELL_COLUMNS, *order_cols).write.mode("append").parquet(path)


def read_latest_cells(spark: SparkSession, path: str, order_cols: Sequence[str], keep_order: bool = False) -> DataFrame:
    """Read a cell store: every stored write, resolved to the last one per cell."""
    return latest_cells(spark.read.parquet(path), order_cols, keep_order)


def compact_cells(spark: SparkSession, path: str, new_path: str, order_cols: Sequence[str]) -> str:
    """Write the resolved store to ``new_path`` (never over the input) and
    return it; readers switch to the new path when the write has committed."""
    if new_path.rstrip("/") == path.rstrip("/"):
        raise ValueError("compaction must write to a new location")
    read_latest_cells(spark, path, order_cols, keep_order=True).write.parquet(new_path)
    return new_path


def create_cell_table(spark: SparkSession, name: str, path: str, value_type: str = "string") -> bool:
    """Create a catalog table over ``path`` if missing; True if created."""
    from tableflow.sinks.files import create_table_if_missing

    return create_table_if_missing(
        spark, name, f"rowkey STRING, family STRING, qualifier STRING, value {value_type.upper()}", path
    )
