"""SimHash near-duplicates by covering locality-sensitive hashing (operator 3).

Fingerprint: A-Z lower-cased, words between ASCII white space, word shingles
(repeats included), XXH64 (seed 42) of each; a bit is set when more than half
of the hashes have it. Documents link at ``radius`` or fewer differing bits.

Candidates: a covering family of bit masks. Each bit position i gets a
non-zero vector m(i) of ``radius + 1`` bits; for each non-zero v there is one
table whose mask holds the positions with <m(i), v> odd. For any set of
``radius`` positions some v is orthogonal to all their m(i), so two
fingerprints within the radius agree on that table's whole mask: every such
pair collides in some table, none can be missed. With radius 2 there are 7
tables whose masks hold 36 or 37 of the 64 bits.

Exact copies are one fingerprint before any pairing. A bucket of more than
``max_bucket`` distinct fingerprints is not paired: two fingerprints differ in
at most 2 bits exactly if flipping at most one bit of each can make them
equal, so its members are expanded to their 65 neighbours within one bit and
joined to the smallest member that shares one. That is exact and linear in the
bucket, and gives the same components.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import connected_components, map_rows, materialize

SHINGLE_WORDS = 3
RADIUS = 2
BITS = 64
SEED = 42
MAX_BUCKET = 64
CHUNK = 1 << 15

_FP = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text as a signed 64-bit integer; 0 without words."""
    tokens = (text or b"").lower().split()
    n = len(tokens) - words + 1
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        shingles = iter([b" ".join(tokens)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, CHUNK):
        size = min(CHUNK, n - start)
        h = np.fromiter((digest(next(shingles), SEED) for _ in range(size)), dtype="<u8", count=size)
        ones += np.unpackbits(h.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 masks as signed 64-bit integers."""
    n = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, n + 1):
        mask = sum(1 << i for i in range(bits) if bin((1 + i % n) & v).count("1") % 2)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, key: Column | None = None) -> DataFrame:
    """(doc_id, fp) per row of ``docs``, and ``row_key`` if a key (string) of the rows is given."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *([] if key is None else [key.alias("row_key")]))
    schema = _FP if key is None else T.StructType([*_FP, T.StructField("row_key", T.StringType())])
    return map_rows(rows, schema, lambda batch: ((d, fingerprint(t, words), *(k.decode() for k in more)) for d, t, *more in batch))


def _near(a: str, b: str, radius: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) between distinct ``fps (fp)`` that join all within ``radius`` bits.

    ``radius`` must be 1 or 2: the exact way for crowded buckets flips one bit
    of one side (1) or of both (2).
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("bucket"))
                       for t, m in enumerate(covering_masks(radius))])
    keyed = fps.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.bucket")
    sizes = keyed.groupBy("t", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(keyed.join(sizes, ["t", "bucket"]), "buckets")

    few = members.filter(F.col("n") <= max_bucket)
    pairs = (few.select("t", "bucket", F.col("fp").alias("a"))
             .join(few.select("t", "bucket", F.col("fp").alias("b")), ["t", "bucket"])
             .filter((F.col("a") < F.col("b")) & _near("a", "b", radius)).select("a", "b"))

    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0)))
                                   for i in range(BITS)])
    crowd = members.filter(F.col("n") > max_bucket).select("fp").distinct()
    around = crowd.select("fp", F.explode(flips).alias("near"))
    centres = (crowd.select(F.col("fp").alias("near"), F.col("fp").alias("a")) if radius == 1 else
               around.groupBy("near").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    stars = around.join(centres, "near").filter("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, key: Column | None = None) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``; component_id is the smallest doc_id reachable.

    With ``key`` also row_key and component, the component's smallest
    fingerprint, which every component has.

    Texts without words (null, empty, white space) have fingerprint 0 and link
    like any other. A row with a null doc_id takes part, but names no
    component; a component without any doc_id has a null component_id.
    Repeated rows come back as often. Extra columns are ignored, and an empty
    table gives an empty result.
    """
    fps = materialize(fingerprints(docs, words, key), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = fingerprint_links(distinct.select("fp"), radius)
    parts = connected_components(links).select(F.col("node").alias("fp"), "component")
    labelled = materialize(distinct.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "labelled")
    # a table of its own: Spark can then split the join on a component that holds many fingerprints
    least = materialize(labelled.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    ids = labelled.join(least, "component").select("fp", "component_id", "component")
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id", *([] if key is None else ["row_key", "component"]))


def fingerprint_hex(fp: str = "fp"):
    """16 lowercase hex digits of a signed 64-bit column."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
