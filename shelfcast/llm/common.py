"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import checkpoint_dir

# Folders written by `materialize` in this Python process, for `drop_scratch`.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the folders of `materialize`; frames built on them end with it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder of `scratch_path` that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _SCRATCH:
        _SCRATCH.remove(path)


def map_rows(df: DataFrame, schema: T.StructType,
             fn: Callable[[list[tuple]], Iterable[tuple]]) -> DataFrame:
    """``mapInArrow`` over Python tuples: ``fn`` gets the rows of one Arrow batch.

    Strings arrive as UTF-8 bytes: the text helpers work on bytes, where
    ``lower()`` and ``split()`` are the ASCII-only forms the contracts ask for.
    """
    types = arrow_schema(schema)
    n_out = len(schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.cast(pa.large_binary()).to_pylist() if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)
                    else c.to_pylist() for c in batch.columns]
            rows = list(fn(list(zip(*cols))))
            out = list(zip(*rows)) if rows else [[] for _ in range(n_out)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(v), type=f.type) for v, f in zip(out, types)], schema=types)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def hash_fraction(*cols: Column | str, seed: int) -> Column:
    """A repeatable number in [0, 1) per row, for hash-chosen samples."""
    h = F.xxhash64(F.lit(seed), *cols)
    return F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the fold no model may learn labels from."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(F.encode(c.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges (a, b)``: one row (node, component) per
    node that has an edge, component = its smallest reachable node.

    Alternating large-star / small-star rounds. Each star is a ``min``
    aggregate (combined map-side) joined back to the edges, so a hub with a
    third of all edges is a skewed join side that Spark can split and never a
    list in one task. Each round is one written table in the shared folder.
    """
    def star(directed: DataFrame) -> DataFrame:
        # a table of its own, or the join would take over the aggregate's layout and could not be split
        least = materialize(directed.groupBy("a").agg(F.min("b").alias("m")), "least")
        return directed.join(least, "a").select("a", "b", F.least("a", "m").alias("m"))

    def state(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    cur = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    before = state(cur)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = materialize(star(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        s = star(large)
        small = (s.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(s.select("a", F.col("m").alias("b"))).distinct())
        cur = materialize(small, "stars")
        after = state(cur)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"connected_components: no fixed point after {max_rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
