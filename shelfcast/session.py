"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every shelfcast job relies on (see SURVEY §4).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",     # longer methods are never compiled by the JVM: they run some 7 times slower
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelfcast", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to an existing session (e.g. the driver's)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem folder and
    is used as-is. Only a local session may go without: it gets its own
    temporary folder, which other machines could not read.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="shelfcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
