"""Line-level deduplication (operator 4).

Every text is split at newlines; a line's key is the line without surrounding
ASCII white space and with A-Z lower-cased. A key of at least ``min_chars``
code points found in at least ``min_docs`` documents is repeated boilerplate:
its lines go everywhere but in the largest doc_id that holds it.

Lines travel as 128-bit hashes, one row per (document, key) with the positions
it takes, so the shuffle carries no text; distinct documents per hash are
counted with map-side combining, so a line that a third of all documents share
arrives as one partial row per task. Only the positions to drop are joined
back to the documents, which are reassembled by position.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import map_rows, materialize

MIN_CHARS = 20
MIN_DOCS = 3
SPACE = b" \t\n\x0b\x0c\r"

_KEYS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text_hash", T.LongType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("positions", T.ArrayType(T.IntegerType())),
])


def _line_keys(min_chars: int):
    def keys(rows):
        for doc_id, text_hash, text in rows:
            held: dict[bytes, list[int]] = {}
            for pos, line in enumerate((text or b"").split(b"\n")):
                key = line.strip(SPACE).lower()
                if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
                    continue
                held.setdefault(key, []).append(pos)
            for key, positions in held.items():
                yield doc_id, text_hash, xxhash.xxh3_128_digest(key), positions
    return keys


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every document with its repeated lines dropped.

    A null or empty text is one empty line and comes back as ''. A document
    whose lines all go comes back as ''. A row with a null doc_id counts as no
    document and keeps no repeated line. Rows that repeat a doc_id are the
    same document for the count, and each is cleaned. Extra columns are
    ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    keys = map_rows(texts.select("doc_id", "text_hash", "text"), _KEYS, _line_keys(min_chars))
    # a table of its own: the join below then deals out both sides itself, and Spark can split a line that many share
    repeated = materialize(keys.groupBy("key").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
                           .filter(F.col("n_docs") >= min_docs).select("key", "keeper"), "repeated-lines")
    drops = (keys.join(repeated, "key").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
             .groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("positions")).alias("drop")))
    t, d = texts.alias("t"), drops.alias("d")
    joined = t.join(d, F.expr("t.doc_id <=> d.doc_id AND t.text_hash = d.text_hash"), "left").select(
        F.col("t.doc_id").alias("doc_id"), F.col("t.text").alias("text"), F.col("d.drop").alias("drop"))
    lines = joined.withColumn("lines", F.split("text", "\n", -1)).withColumn("n_lines", F.size("lines"))
    kept = lines.withColumn("kept", F.when(F.col("drop").isNotNull(), F.array_except(
        F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("drop"))))
    return kept.select(
        "doc_id",
        F.when(F.col("drop").isNull(), F.col("text"))
         .otherwise(F.array_join(F.expr("transform(kept, i -> lines[i])"), "\n")).alias("text"),
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).cast("bigint").alias("n_dropped"))


# DuckDB: the same rule on the line texts themselves.
ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE r.k IS NOT NULL AND doc_id <> keeper)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE r.k IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated r USING (k)
GROUP BY doc_id
"""
