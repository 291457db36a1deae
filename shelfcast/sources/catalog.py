"""Fact tables in Spark's catalog: every change is one commit, readers go by name.

A fact ``db.name`` is a view over the external table ``db.name__v<n>`` of its
current version, whose partitions name their own folders. A change writes new
folders below ``<root>/v=<n+1>`` (never into one that is read), registers a
table of the unchanged and the new folders, and replaces the view. That last
statement is the commit: a job that fails anywhere before it leaves the old
version as it was, for readers and for the next run.

The list of folders of each version is a small table under
``<root>/_versions``, from which `attach` registers a fact in a session whose
catalog does not outlive it. The version before the current one keeps its
folders until the next commit, so queries that have begun on it can end.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions.semantics import date_lit
from shelfcast.session import checkpoint_dir
from shelfcast.sources import store

VERSION = "shelfcast.version"
SPECS_PER_STATEMENT = 400          # partitions named in one ADD PARTITION statement


def exists(spark: SparkSession, fact: str) -> bool:
    return spark.catalog.tableExists(fact)


def version(spark: SparkSession, fact: str) -> int:
    """The current version, 0 for a fact that is not in the catalog."""
    if not exists(spark, fact):
        return 0
    return int(spark.sql(f"SHOW TBLPROPERTIES {fact}").filter(F.col("key") == VERSION).first()["value"])


def partition_dates(spark: SparkSession, fact: str) -> list[str]:
    """``SHOW PARTITIONS`` of the current version: dates, oldest first, without reading a file."""
    n = version(spark, fact)
    return sorted(r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {fact}__v{n}").collect()) if n else []


def _folders(spark: SparkSession, root: str, n: int) -> dict[str, str]:
    """Folder of each partition of version ``n``: one row a date."""
    path = f"{root}/_versions/n={n}"
    return {r["date"]: r["folder"] for r in spark.read.schema("date string, folder string").parquet(path).collect()} if (
        n and store.table_exists(spark, f"{path}/_SUCCESS")) else {}


def _columns(table: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in store.table_schema(table).fields)


def _register(spark: SparkSession, fact: str, table: str, root: str, n: int, folders: dict[str, str]) -> None:
    """Make version ``n`` the one that readers of ``fact`` see."""
    date_col = schemas.TABLES[table][1]
    part = f"{fact}__v{n}"
    spark.sql(f"DROP TABLE IF EXISTS {part}")
    spark.sql(f"CREATE TABLE {part} ({_columns(table)}) USING parquet PARTITIONED BY ({date_col}) LOCATION '{root}/v={n}'")
    specs = [f"PARTITION ({date_col} = '{d}') LOCATION '{folder}'" for d, folder in sorted(folders.items())]
    for i in range(0, len(specs), SPECS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {part} ADD " + " ".join(specs[i:i + SPECS_PER_STATEMENT]))
    names = ", ".join(store.table_schema(table).names)
    spark.sql(f"CREATE OR REPLACE VIEW {fact} TBLPROPERTIES ('{VERSION}' = '{n}') AS SELECT {names} FROM {part}")


def attach(spark: SparkSession, fact: str, table: str, root: str) -> int:
    """Register the newest committed version below ``root`` under the name ``fact``; returns it (0 without any)."""
    listed = [int(v) for v in store.partition_values(spark, f"{root}/_versions", "n")]
    n = max((v for v in listed if store.table_exists(spark, f"{root}/_versions/n={v}/_SUCCESS")), default=0)
    if n and version(spark, fact) != n:
        _register(spark, fact, table, root, n, _folders(spark, root, n))
    return n


def _commit(spark: SparkSession, fact: str, table: str, root: str, n: int, folders: dict[str, str]) -> None:
    rows = spark.createDataFrame(sorted(folders.items()), "date string, folder string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/_versions/n={n}")
    _register(spark, fact, table, root, n, folders)
    if n < 3:
        return
    # past the commit: what only versions before the last one use can go
    spark.sql(f"DROP TABLE IF EXISTS {fact}__v{n - 2}")
    old = _folders(spark, root, n - 2)
    for folder in set(old.values()) - set(_folders(spark, root, n - 1).values()) - set(folders.values()):
        store.delete_folder(spark, folder)
    store.delete_folder(spark, f"{root}/_versions/n={n - 2}")


def _new_folders(spark: SparkSession, root: str, n: int, date_col: str) -> dict[str, str]:
    return {d: f"{root}/v={n}/{date_col}={d}" for d in store.partition_values(spark, f"{root}/v={n}", date_col)}


def create(spark: SparkSession, fact: str, table: str, root: str, rows: DataFrame | None = None) -> None:
    """Replace the fact with ``rows`` (empty without): version 1, or the one after the current."""
    n = attach(spark, fact, table, root) + 1
    folders = {}
    if rows is not None:
        store.delete_folder(spark, f"{root}/v={n}")             # left by a run that failed before its commit
        store.write_fact(rows, f"{root}/v={n}", table)
        folders = _new_folders(spark, root, n, schemas.TABLES[table][1])
    _commit(spark, fact, table, root, n, folders)


def upsert(spark: SparkSession, fact: str, table: str, root: str, source: DataFrame,
           on_duplicate: str = "error", on_moved: str = "insert") -> store.Upserted:
    """`store.upsert_partitions` as one commit; the partitions of the batch's range get new folders, the others stay.

    ``on_moved`` says what happens to staged keys that are stored under a date
    outside the batch's range: 'insert' adds them a second time, as the bounded
    MERGE does, 'error' fails before anything is written.
    """
    date_col, key = schemas.TABLES[table][1], store.FACT_KEYS[table]
    if on_moved not in ("insert", "error"):
        raise ValueError(f"on_moved is 'insert' or 'error', not {on_moved!r}")
    n = attach(spark, fact, table, root)
    if not n:
        create(spark, fact, table, root)
        n = 1
    staging = f"{checkpoint_dir(spark)}/upsert-{table}-{uuid.uuid4().hex}"
    try:
        store.conform(source, table).write.parquet(staging)
        source = spark.read.schema(store.table_schema(table)).parquet(staging)
        bounds = source.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
        if bounds["lo"] is None:
            return store.Upserted(0, 0)
        stored = spark.table(fact)
        if on_moved == "error" and not store.moved_keys(stored, source, key, date_col).isEmpty():
            raise ValueError(f"upsert into {fact}: staged keys are stored under dates outside the batch's range")
        target = stored.filter(F.col(date_col).between(date_lit(bounds["lo"]), date_lit(bounds["hi"])))
        source, dropped = store.one_row_per_match(target, source, table, on_duplicate)
        store.delete_folder(spark, f"{root}/v={n + 1}")
        store.write_fact(store.merge_rows(target, source, key, date_col, store.kept_on_match(table)), f"{root}/v={n + 1}", table)
        new = _new_folders(spark, root, n + 1, date_col)
        _commit(spark, fact, table, root, n + 1, _folders(spark, root, n) | new)
        return store.Upserted.of(list(new), dropped)
    finally:
        store.delete_folder(spark, staging)


def expire(spark: SparkSession, fact: str, table: str, root: str, as_of: dt.date, days: int = 365) -> list[str]:
    """C12 as a commit: a version without the partitions older than ``as_of - days``; returns their dates."""
    n = attach(spark, fact, table, root)
    folders = _folders(spark, root, n)
    cutoff = (as_of - dt.timedelta(days=days)).isoformat()
    gone = sorted(d for d in folders if d < cutoff)
    if gone:
        _commit(spark, fact, table, root, n + 1, {d: f for d, f in folders.items() if d >= cutoff})
    return gone


def add_table(spark: SparkSession, name: str, path: str) -> None:
    """An unpartitioned Parquet folder (dimension, output) as an external table ``name``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def tables(spark: SparkSession, database: str) -> DataFrame:
    """``INFORMATION_SCHEMA.TABLES``: (table_name, is_view) of a database; a fact's version tables are left out."""
    rows = [(t.name, t.tableType == "VIEW") for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(rows, "table_name string, is_view boolean").filter(~F.col("table_name").rlike("__v[0-9]+$"))


def partitions(spark: SparkSession, facts: dict[str, str]) -> DataFrame:
    """``INFORMATION_SCHEMA.PARTITIONS``: (table_name, partition_date) of ``facts`` (name in the result -> catalog name)."""
    rows = [(name, dt.date.fromisoformat(d)) for name, fact in facts.items() for d in partition_dates(spark, fact)]
    return spark.createDataFrame(rows, "table_name string, partition_date date")
