"""Parquet table store: definitions, refresh, staging, keyed upsert, retention.

Fact tables are Parquet directories partitioned by date (``sale_date`` /
``snapshot_date``) and sorted by sku inside each file, so date predicates prune
whole directories and sku predicates skip row groups.

Upserts rewrite only the partitions inside the staged batch's date range
(``partitionOverwriteMode=dynamic``); the merged rows are first written to the
shared checkpoint folder, so the target is never overwritten while it is
still being read, and a lost executor only recomputes from intact inputs.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas
from shelfcast.functions.semantics import date_lit
from shelfcast.session import checkpoint_dir


# ------------------------------------------------------------------ C09 table definitions
def table_schema(name: str) -> T.StructType:
    return schemas.TABLES[name][0]


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """Typed empty relation (``SELECT CAST(NULL AS T) ... WHERE FALSE``)."""
    return spark.createDataFrame([], table_schema(name))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast ``df`` to the fixed schema of table ``name`` (missing columns become NULL)."""
    sch = table_schema(name)
    cols = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in sch.fields])


def require_not_null(df: DataFrame, name: str) -> DataFrame:
    """Fail the job if a NOT NULL key of table ``name`` is NULL (Parquet does not enforce it)."""
    keys = schemas.TABLES[name][3]
    if not keys:
        return df
    bad = F.lit(False)
    for k in keys:
        bad = bad | F.col(k).isNull()
    # a filter predicate (not a dropped column, which the optimizer would prune)
    return df.filter(F.when(bad, F.raise_error(F.lit(f"NULL key in {name}")).cast("boolean")).otherwise(F.lit(True)))


def create_if_absent(spark: SparkSession, path: str, name: str) -> None:
    """``CREATE TABLE IF NOT EXISTS``."""
    sch, part, _, _ = schemas.TABLES[name]
    w = empty_table(spark, name).write.mode("ignore")
    if part:
        w = w.partitionBy(part)
    w.parquet(path)


def read_fact(spark: SparkSession, path: str, name: str, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Partition-filtered fact read; the date range is mandatory (``require_partition_filter``)."""
    part = schemas.TABLES[name][1]
    df = spark.read.schema(table_schema(name)).parquet(path)
    cond = F.col(part) >= date_lit(start)
    if end is not None:
        cond = cond & (F.col(part) <= date_lit(end))
    return df.filter(cond)


FACT_KEYS = {"sales_history_raw": "sale_id", "inventory_snapshots_raw": "snapshot_id"}


def write_fact(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> None:
    """Partitioned + clustered write.

    One range shuffle on (date, cluster column, row key): a heavy day is cut
    into several sku ranges written by different tasks (never one task per
    day), each file holds a narrow sku range (tight min/max statistics for
    row-group skipping), and the unique row key splits even a single hot
    (day, sku) value.
    """
    _, part, cluster, _ = schemas.TABLES[name]
    keys = [c for c in (part, cluster, FACT_KEYS.get(name)) if c]
    out = require_not_null(conform(df, name), name)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # an overwrite replaces the partitions it brings, whatever the session's own setting is
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


# ------------------------------------------------------------------ C05 / C06 dimension refresh, staging
def refresh_dimension(current: DataFrame | None, new: DataFrame) -> DataFrame:
    """C05 as a function: the new contents, or the old ones when the load is empty (Q13)."""
    if current is None:
        return new
    has_new = new.select(F.count(F.lit(1)) > 0).scalar()
    return new.filter(has_new).unionByName(current.filter(~has_new))


def write_dimension(df: DataFrame, path: str, name: str) -> bool:
    """Replace a dimension table; an empty load is a no-op. Returns True if written."""
    if df.isEmpty():
        return False
    require_not_null(conform(df, name), name).write.mode("overwrite").parquet(path)
    return True


def stage(df: DataFrame, path: str, name: str) -> DataFrame:
    """Replace the staging table (empty batches truncate it) and return it re-read."""
    spark = df.sparkSession
    require_not_null(conform(df, name), name).write.mode("overwrite").parquet(path)
    return spark.read.schema(table_schema(name)).parquet(path)


# ------------------------------------------------------------------ keyed upsert
def dedupe(df: DataFrame, key: str, order: list[str], latest: bool = False) -> DataFrame:
    """One row per ``key``: the first (or, with ``latest``, last) row in the total order ``order``.

    Written as a struct min/max aggregate, so it combines map-side: a key with
    millions of copies never lands whole on one task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    s = F.struct(*[F.col(c) for c in order + rest])
    agg = F.max(s) if latest else F.min(s)
    return df.groupBy(key).agg(agg.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in order + rest]) \
        .select(*df.columns)


def batch_range(source: DataFrame, date_col: str) -> tuple[Column, Column]:
    """``min``/``max`` of the staged batch's dates from ONE scalar subquery.

    Every reference is the same subquery, so Spark evaluates it once
    (ReuseSubquery) instead of once per bound and per use.
    """
    rng = source.select(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))).scalar()
    return rng["lo"], rng["hi"]


def merge_rows(target_in_range: DataFrame, source: DataFrame, key: str, date_col: str,
               keep_on_match: tuple[str, ...] = ()) -> DataFrame:
    """MERGE semantics inside the batch range.

    Matched rows take the source columns except ``date_col`` and
    ``keep_on_match``, which stay as stored; unmatched source rows are inserted;
    unmatched target rows stay. One full outer join on the key.
    """
    cols = target_in_range.columns
    j = target_in_range.alias("t").join(source.alias("s"), F.col("t." + key) == F.col("s." + key), "full_outer")
    matched_t = F.col("t." + key).isNotNull()
    matched_s = F.col("s." + key).isNotNull()
    out = []
    for c in cols:
        if c == key:
            out.append(F.coalesce(F.col("s." + c), F.col("t." + c)).alias(c))
        elif c == date_col or c in keep_on_match:
            out.append(F.when(matched_t, F.col("t." + c)).otherwise(F.col("s." + c)).alias(c))
        else:
            out.append(F.when(matched_s, F.col("s." + c)).otherwise(F.col("t." + c)).alias(c))
    return j.select(*out)


def upsert(target: DataFrame, source: DataFrame, key: str, date_col: str,
           keep_on_match: tuple[str, ...] = ()) -> DataFrame:
    """The whole table after merging ``source`` into ``target`` (pure form of C07/C08).

    Only target rows with ``date_col`` in the batch's [min, max] can match
    (the reference's partition bound): a key stored outside the range is
    inserted again, exactly as the warehouse MERGE would (SURVEY §2.9).
    """
    lo, hi = batch_range(source, date_col)
    in_range = F.col(date_col).between(lo, hi)
    keep = target.filter(~F.coalesce(in_range, F.lit(False)))
    merged = merge_rows(target.filter(in_range), source.select(*target.columns), key, date_col, keep_on_match)
    return keep.unionByName(merged)


def upsert_inventory(target: DataFrame, source: DataFrame) -> DataFrame:
    """Key ``snapshot_id``; every column but the date is updated on match."""
    return upsert(target, source, "snapshot_id", "snapshot_date")


def upsert_sales(target: DataFrame, source: DataFrame) -> DataFrame:
    """Key ``sale_id``; ``sale_date`` and ``line_price`` are not updated on match."""
    return upsert(target, source, "sale_id", "sale_date", keep_on_match=("line_price",))


def multi_matched_keys(target_in_range: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source keys that match a stored row more than once (a MERGE error in the warehouse)."""
    dup = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dup.join(target_in_range.select(key).distinct(), key, "left_semi")


BITS_PER_KEY, HASHES, MAX_BLOOM_WORDS = 16, 4, 1 << 21        # at most 16 MB


def bloom_words(keys: DataFrame, key: str, n: int) -> tuple[Column, int]:
    """A Bloom filter of ``keys`` as (array of 64-bit words from one scalar subquery, number of words).

    ``n`` is the number of keys; beyond `MAX_BLOOM_WORDS` words the filter lets
    more rows through, which the exact join after it sorts out.
    """
    words = min(MAX_BLOOM_WORDS, max(1, -(-n * BITS_PER_KEY // 64)))
    at = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(words * 64)) for i in range(HASHES)])).alias("bit")
    filled = (keys.select(at).selectExpr("bit div 64 AS word", "shiftleft(1L, CAST(bit % 64 AS INT)) AS mask")
              .groupBy("word").agg(F.bit_or("mask").alias("mask")))
    every = keys.sparkSession.range(words).select(F.col("id").alias("word"))
    return (every.join(filled, "word", "left")
            .agg(F.expr("transform(array_sort(collect_list(struct(word, coalesce(mask, 0L) AS mask))), w -> w.mask) AS words"))
            .scalar(), words)


def may_contain(words: Column, n_words: int, key: str) -> Column:
    """Whether a row's key may be in the filter of `bloom_words` (never false for one that is)."""
    bits = [F.pmod(F.xxhash64(F.lit(i), key), F.lit(n_words * 64)) for i in range(HASHES)]
    hit = F.lit(True)
    for b in bits:
        hit = hit & (F.call_function("getbit", F.get(words, F.floor(b / 64).cast("int")), (b % 64).cast("int")) == 1)
    return hit


def moved_keys(target: DataFrame, source: DataFrame, key: str, date_col: str) -> DataFrame:
    """(key, stored_date, staged_date): staged keys that are stored under a date outside the batch's range.

    The bounded MERGE cannot see them and inserts them again. Only the key and
    date columns of the other partitions are read; a Bloom filter of the staged
    keys leaves few of their rows, and only those meet the batch in an exact
    join, so the stored table is not shuffled.
    """
    b = source.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    staged = source.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(date_col).alias("staged_date"))
    outside = target.select(key, F.col(date_col).alias("stored_date"))
    if b["lo"] is None:
        return outside.filter(F.lit(False)).join(staged, key).select(key, "stored_date", "staged_date")
    words, n_words = bloom_words(source.select(key).filter(F.col(key).isNotNull()), key, b["n"])
    candidates = outside.filter(~F.col("stored_date").between(date_lit(b["lo"]), date_lit(b["hi"])) & may_contain(words, n_words, key))
    return candidates.join(staged, key).select(key, "stored_date", "staged_date")


class Upserted(NamedTuple("Upserted", [("partitions", int), ("dropped", int)])):
    """Partitions rewritten, and staged rows given up for a later one of their key.

    ``dates`` are the partitions' values: what rollups of the table have to look at again.
    """

    dates: tuple[str, ...] = ()

    @classmethod
    def of(cls, dates: list[str], dropped: int) -> "Upserted":
        out = cls(len(dates), dropped)
        out.dates = tuple(sorted(dates))
        return out


def one_row_per_match(target_in_range: DataFrame, source: DataFrame, name: str, on_duplicate: str) -> tuple[DataFrame, int]:
    """The batch with at most one row for a stored one, and how many rows that dropped (see `upsert_partitions`)."""
    key = FACT_KEYS[name]
    if on_duplicate == "latest":
        ts_col = "sale_timestamp" if name == "sales_history_raw" else "snapshot_timestamp"
        kept = dedupe(source, key, [ts_col] + [c for c in source.columns if c not in (key, ts_col)], latest=True)
        return kept, source.count() - kept.count()
    if on_duplicate != "error":
        raise ValueError(f"on_duplicate is 'error' or 'latest', not {on_duplicate!r}")
    if not multi_matched_keys(target_in_range, source, key).isEmpty():
        raise ValueError(f"upsert into {name}: a stored row matches several staged rows")
    return source, 0


def kept_on_match(name: str) -> tuple[str, ...]:
    """Columns of a fact table that an update leaves as stored (beside its date)."""
    return ("line_price",) if name == "sales_history_raw" else ()


def upsert_partitions(spark: SparkSession, path: str, name: str, source: DataFrame,
                      on_duplicate: str = "error") -> Upserted:
    """Apply a batch to a stored fact table; rewrites only partitions in the batch range.

    ``on_duplicate``: 'error' fails when two source rows match one stored row;
    'latest' keeps the newest source row per key first and reports how many
    rows that dropped. An empty batch changes nothing (C06's skip). The batch
    and the merged rows are each written once to the shared folder, and both
    copies are deleted afterwards.
    """
    _, date_col, _, _ = schemas.TABLES[name]
    work = f"{checkpoint_dir(spark)}/upsert-{name}-{uuid.uuid4().hex}"
    try:
        conform(source, name).write.parquet(f"{work}/source")
        source = spark.read.schema(table_schema(name)).parquet(f"{work}/source")
        bounds = source.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
        if bounds["lo"] is None:
            return Upserted(0, 0)
        lo, hi = bounds["lo"], bounds["hi"]
        create_if_absent(spark, path, name)
        target = read_fact(spark, path, name, lo, hi)       # literal range: static partition pruning
        source, dropped = one_row_per_match(target, source, name, on_duplicate)
        merge_rows(target, source, FACT_KEYS[name], date_col, kept_on_match(name)).write.parquet(f"{work}/merged")
        write_fact(spark.read.schema(table_schema(name)).parquet(f"{work}/merged"), path, name, mode="overwrite")
        touched = [v for v in partition_values(spark, path, date_col) if lo <= dt.date.fromisoformat(v) <= hi]
        return Upserted.of(touched, dropped)
    finally:
        delete_folder(spark, work)


# ------------------------------------------------------------------ C12 retention, C18b partition metadata
def retained(df: DataFrame, date_col: str, as_of: dt.date, days: int = 365) -> DataFrame:
    """C12 as a function: rows whose partition has not expired (``date >= as_of - days``)."""
    return df.filter(F.col(date_col) >= date_lit(as_of - dt.timedelta(days=days)))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values from the directory listing (metadata only, no data read)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = column + "="
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            v = name[len(prefix):]
            if v not in ("__HIVE_DEFAULT_PARTITION__",):
                out.append(v)
    return out


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, size, modification time in ms) of the files below ``path``; hidden ones, as Spark's readers skip, are left out."""
    fs, p = _fs(spark, path)
    out = []
    for st in fs.listStatus(p) if fs.exists(p) else []:
        if st.getPath().getName().startswith(("_", ".")):
            continue
        name = st.getPath().toString()
        out += data_files(spark, name) if st.isDirectory() else [(name, st.getLen(), st.getModificationTime())]
    return out


def latest_partition(spark: SparkSession, path: str, column: str, until: dt.date | None = None) -> dt.date | None:
    """C18b on a stored table: newest partition date (not after ``until``), NULL/default partitions skipped."""
    days = (dt.date.fromisoformat(v) for v in partition_values(spark, path, column))
    return max((d for d in days if until is None or d <= until), default=None)


def write_rollup(df: DataFrame, path: str, date_col: str, cluster: str) -> None:
    """Replace a date-partitioned rollup: each file holds a narrow range of dates and cluster keys."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, date_col, cluster).sortWithinPartitions(date_col, cluster)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(date_col).parquet(path))


def enforce_retention(spark: SparkSession, path: str, column: str, as_of: dt.date, days: int = 365) -> list[str]:
    """Drop partitions older than ``as_of - days`` (partition expiry). Returns dropped values."""
    cutoff = as_of - dt.timedelta(days=days)
    fs, p = _fs(spark, path)
    dropped = []
    for v in partition_values(spark, path, column):
        if dt.date.fromisoformat(v) < cutoff:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"{column}={v}"), True)
            dropped.append(v)
    return dropped


# ------------------------------------------------------------------ self-referencing replace, hand-off files
def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def replace_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` with ``df`` even when ``df`` is computed from it.

    Writes a new version next to it, then swaps directories (old -> backup,
    new -> path, backup deleted). The path being read is never overwritten in
    place; a failed write leaves the old table untouched.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    new_path, old_path = f"{path}.__new_{tag}", f"{path}.__old_{tag}"
    df.write.parquet(new_path)
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    newp, oldp = jvm.org.apache.hadoop.fs.Path(new_path), jvm.org.apache.hadoop.fs.Path(old_path)
    had_old = fs.exists(p)
    if had_old and not fs.rename(p, oldp):
        raise IOError(f"could not move {path} aside")
    if not fs.rename(newp, p):
        if had_old:
            fs.rename(oldp, p)
        raise IOError(f"could not move the new version into {path}")
    if had_old:
        fs.delete(oldp, True)


def write_sync_tables(tables: dict[str, DataFrame], out_dir: str) -> None:
    """The hand-off of products, variants, locations, inventory and sales as JSON lines.

    Re-aimed from the single 5-array document, which would route every row
    through one writer; each array becomes its own splittable dataset.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{out_dir}/{name}")


SYNC_TABLES = {"products": "products", "variants": "variants", "locations": "locations",
               "inventory": "inventory_snapshots_raw", "sales": "sales_history_raw"}


def read_sync_tables(spark: SparkSession, in_dir: str) -> dict[str, DataFrame]:
    """The hand-off tables back, with their fixed schemas."""
    return {name: spark.read.schema(table_schema(table)).json(f"{in_dir}/{name}") for name, table in SYNC_TABLES.items()}
