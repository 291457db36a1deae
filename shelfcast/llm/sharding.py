"""Sharding by longest-processing-time scheduling (operator 8).

Documents with equal texts form a group that stays in one shard. Groups go,
largest first, to the least-loaded shard through a heap, so shards end up near
equal in bytes (law ``bytes``).

The heap runs over a bounded list whatever the input size: a group larger than
``1 / (n_shards * units_per_shard)`` of all bytes is a unit of its own (there
cannot be more than ``n_shards * units_per_shard`` of those), and the smaller
groups are first dealt by their hash into that many bundles, each a unit. Both
maps back to shards are therefore broadcast with a proven bound.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import materialize

UNITS_PER_SHARD = 500
ROWS_PER_CELL = 50_000


def longest_first(units: list[tuple[int, tuple]], n_shards: int) -> dict[tuple, int]:
    """Shard of each (size, key): largest first, each to the least-loaded shard."""
    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for size, key in sorted(units, key=lambda u: (-u[0], u[1])):
        load, shard = heapq.heappop(heap)
        out[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({
        "_size": (F.octet_length(text) + 1).cast("bigint"),
        "_g1": F.xxhash64(text),
        "_g2": F.xxhash64(F.lit(1), text),
    })


def assign_shards(docs: DataFrame, n_shards: int = 8, text_col: str = "text",
                  units_per_shard: int = UNITS_PER_SHARD, shard_col: str = "shard") -> DataFrame:
    """``docs`` with ``shard_col`` added (replaced if it exists).

    A null text is an empty one. Equal texts share a shard, however often they
    repeat; ties in size are broken by the group's hash. An empty table gives
    an empty result. Column names beginning with an underscore followed by
    ``size``, ``g1``, ``g2``, ``unit`` are kept apart by wrapping the row.
    """
    spark = docs.sparkSession
    n_units = n_shards * units_per_shard
    columns = [c for c in docs.columns if c != shard_col]
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                          F.col(f"`{text_col}`").alias("_text"))
    keyed = _keyed(wrapped, "_text").drop("_text")
    groups = materialize(keyed.groupBy("_g1", "_g2").agg(F.sum("_size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    cut = total / n_units
    big = groups.filter(F.col("bytes") > cut).collect()                       # fewer than n_units rows
    bundle = F.pmod("_g1", F.lit(n_units))
    small = (groups.filter(F.col("bytes") <= cut).groupBy(bundle.alias("unit"))
             .agg(F.sum("bytes").alias("bytes")).collect())                   # at most n_units rows
    shard_of = longest_first([(r["bytes"], (1, r["_g1"], r["_g2"])) for r in big]
                             + [(r["bytes"], (0, r["unit"], 0)) for r in small], n_shards)
    longs = "_g1 bigint, _g2 bigint, _s1 int"
    big_map = spark.createDataFrame([(k[1], k[2], s) for k, s in shard_of.items() if k[0]], longs)
    small_map = spark.createDataFrame([(k[1], s) for k, s in shard_of.items() if not k[0]], "_unit bigint, _s0 int")
    out = (keyed.join(F.broadcast(big_map), ["_g1", "_g2"], "left")
           .withColumn("_unit", F.when(F.col("_s1").isNull(), bundle))
           .join(F.broadcast(small_map), "_unit", "left"))
    return out.select("_row.*", F.coalesce("_s1", "_s0").alias(shard_col))


def with_slots(assigned: DataFrame, shard_col: str = "shard", order: tuple[str, ...] = ("doc_id", "text_crc32"),
               rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard.

    Rows are numbered inside (shard, cell) windows of about ``rows_per_cell``
    rows; a cell's first slot is the count of the cells before it, taken from
    the aggregated counts. ``assigned`` should be narrow and materialized.
    """
    rows = assigned.count()
    n_cells = max(16, math.ceil(rows / rows_per_cell))
    celled = assigned.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(n_cells)))
    counts = celled.groupBy(shard_col, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard_col).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard_col, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(shard_col, "_cell").orderBy(*order)
    return (celled.withColumn("_i", F.row_number().over(inside)).join(offsets, [shard_col, "_cell"])
            .withColumn("slot", (F.col("_first") + F.col("_i") - 1).cast("bigint"))
            .drop("_cell", "_first", "_i"))


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    text = F.coalesce("text", F.lit(""))
    narrow = assign_shards(docs.select("doc_id", "text"), n_shards).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.col("shard").cast("int").alias("shard"))
    slotted = with_slots(materialize(narrow, "assigned"))
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
