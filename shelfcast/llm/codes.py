"""Vector code compression by Drake-Hamerly adaptive bounds (operator 13).

Vectors become whole numbers, are cut into equal parts, and every part position
has its own small codebook, refined by integer k-means. The state of the
assignment is a table of packed blocks: beside its vectors, a block keeps for
every part the entry assigned, an upper bound of the distance to it, the b next
closest entries with lower bounds in ascending order, and one outer bound of
all the rest. A round shifts the bounds by what the entries moved:

* a part whose upper bound stays below its first lower bound keeps its entry
  without a distance;
* otherwise the exact integer distances of the assigned entry and of those
  whose lower bounds the upper bound reaches decide, ties to the lower index;
* only a part that reaches its outer bound looks at the whole codebook.

b starts at a quarter of the entries and shrinks per part to the number that
would have cost the last round least, never below an eighth. Bounds are rounded outwards, so that they never
decide a case which the integers would decide otherwise.

A round is one written table (the one before it is deleted after) and one sum
over its blocks; codebooks are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, drop_folder, scratch_path
from shelfcast.llm.vectors import exact, kept_vectors, longest, pack, scaled_floor, unpack

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
SLACK = 1e-12                  # relative error allowed to a square root or a sum of two bounds
_SAFE = 2 ** 28                # below this, squared distances of up to 64 components fit in a long

Codebooks = list[list[list[int]]]          # part, entry, component


@dataclass
class Bounds:
    """Assignment of one part position of a block: entry, upper bound, next entries, their lower bounds, outer bound."""

    entry: np.ndarray          # uint8 (rows)
    upper: np.ndarray          # float32 (rows)
    near: np.ndarray           # uint8 (rows, b), ascending by lower bound
    lower: np.ndarray          # float32 (rows, b): bounds its entry and all after it
    outer: np.ndarray          # float32 (rows)

    def tobytes(self) -> bytes:
        return b"".join(np.ascontiguousarray(v).tobytes() for v in (self.upper, self.lower, self.outer, self.entry, self.near))

    @classmethod
    def frombytes(cls, data: bytes, rows: int) -> "Bounds":
        b = (len(data) // rows - 9) // 5
        f = np.frombuffer(data, dtype="<f4", count=rows * (b + 2))
        i = np.frombuffer(data, dtype=np.uint8, offset=rows * (b + 2) * 4)
        return cls(i[:rows], f[:rows], i[rows:].reshape(rows, b), f[rows:rows * (b + 1)].reshape(rows, b), f[rows * (b + 1):])


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - SLACK) if x.dtype == np.float64 else x).astype("<f4"), np.float32(-np.inf))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + SLACK)).astype("<f4"), np.float32(np.inf))


def squared_distances(x: np.ndarray, book: list[list[int]]) -> np.ndarray:
    """Exact squared distances of the rows of one part to all entries (longs, or Python integers where they need to be)."""
    x, c = exact(x, _SAFE), exact(np.array(book, dtype=object), _SAFE)
    if x.dtype != c.dtype:
        x, c = x.astype(object), c.astype(object)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in c], axis=1)


def full_search(x: np.ndarray, book: list[list[int]], b: int) -> Bounds:
    d2 = squared_distances(x, book)
    order = np.argsort(d2, axis=1, kind="stable").astype(np.uint8)             # ties to the lower index
    d = np.sqrt(np.take_along_axis(d2, order, axis=1).astype(np.float64))
    return Bounds(order[:, 0], _up(d[:, 0]), order[:, 1:b + 1], _down(d[:, 1:b + 1]),
                  _down(d[:, b + 1]) if d.shape[1] > b + 1 else np.full(len(d), np.inf, "<f4"))


def drifts(before: Codebooks, after: Codebooks) -> list[np.ndarray]:
    """How far each entry moved, rounded up."""
    return [np.array([np.sqrt(float(sum((p - q) ** 2 for p, q in zip(u, v)))) * (1 + SLACK) for u, v in zip(old, new)])
            for old, new in zip(before, after)]


def _distances_to(x: np.ndarray, book: list[list[int]], ids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to its own entries ``ids`` (rows, m)."""
    x, c = exact(x, _SAFE), exact(np.array(book, dtype=object), _SAFE)
    if x.dtype != c.dtype:
        x, c = x.astype(object), c.astype(object)
    return ((x[:, None, :] - c[ids]) ** 2).sum(axis=2)


def update(state: Bounds, x: np.ndarray, book: list[list[int]], moved: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """The assignment after the entries moved, and how many rows reached each depth (0 to b, b + 1: whole codebook).

    The result keeps ``b`` near entries; ``state`` may hold more.
    """
    held = state.near.shape[1]
    upper = _up(state.upper.astype(np.float64) + moved[state.entry])
    rest = state.outer.astype(np.float64) - moved.max(initial=0.0)
    bounds = np.empty((len(x), held + 1))
    bounds[:, held] = rest
    for i in range(held - 1, -1, -1):                                # in order: each bounds all after it too
        rest = bounds[:, i] = np.minimum(state.lower[:, i] - moved[state.near[:, i]], rest)
    bounds = _down(bounds)[:, :b + 1]
    entry, near = state.entry.copy(), state.near[:, :b].copy()

    unsure = np.flatnonzero(~(upper < bounds[:, 0]))
    own = _distances_to(x[unsure], book, entry[unsure, None])[:, 0]
    upper[unsure] = _up(np.sqrt(own.astype(np.float64)))
    reach = np.zeros(len(x), dtype=np.int64)
    reach[unsure] = (~(upper[unsure, None] < bounds[unsure])).sum(axis=1)      # bounds ascend: so many are not excluded
    for depth in range(1, b + 1):
        at = np.flatnonzero(reach == depth)
        if not len(at):
            continue
        ids = np.sort(np.hstack([entry[at, None], near[at, :depth]]), axis=1)  # ties to the lower index
        d2 = _distances_to(x[at], book, ids)
        order = np.argsort(d2, axis=1, kind="stable")
        ids, d = np.take_along_axis(ids, order, axis=1), np.sqrt(np.take_along_axis(d2, order, axis=1).astype(np.float64))
        entry[at], near[at, :depth], upper[at] = ids[:, 0], ids[:, 1:], _up(d[:, 0])
        bounds[at, :depth] = np.minimum(_down(d[:, 1:]), bounds[at, depth, None])
    whole = np.flatnonzero(reach == b + 1)
    if len(whole):
        fresh = full_search(x[whole], book, b)
        entry[whole], near[whole], upper[whole] = fresh.entry, fresh.near, fresh.upper
        bounds[whole] = np.hstack([fresh.lower, fresh.outer[:, None]])
    return Bounds(entry, upper, near, bounds[:, :b], bounds[:, b]), np.bincount(reach, minlength=b + 2)


def _sums(x: np.ndarray, entry: np.ndarray, entries: int) -> list[tuple[int, int, list[str]]]:
    """(entry, count, sums as decimal text) of the entries in use."""
    wide = exact(x, 2 ** 62 // max(len(x), 1))
    out = []
    for e in np.unique(entry):
        own = wide[entry == e]
        out.append((int(e), len(own), [str(int(v)) for v in own.sum(axis=0)]))
    return out


_SUMS = "array<struct<part:int,entry:int,n:bigint,sums:array<string>>>"
_SCHEMA = (f"vec_id array<bigint>, label {{label}}, kind string, vectors binary, bounds array<binary>, sums {_SUMS}, "
           "depths array<array<bigint>>")


def adapted(b: int, reached: dict[int, int], entries: int, least: int) -> int:
    """The b of at most ``b`` that costs least: b bounds to keep for each row, and a whole search for rows that reach further."""
    def cost(c: int) -> int:
        return c * sum(reached.values()) + entries * sum(n for depth, n in reached.items() if depth > c)

    return min(range(b, min(least, b) - 1, -1), key=cost)


@dataclass
class Compression:
    """Result of `fit`: the last assignment (a written table of blocks) and the final codebooks."""

    blocks: DataFrame
    codebooks: Codebooks
    width: int
    path: str
    needed: list[list[int]]       # b of each part position, by round

    @property
    def digest(self) -> str:
        numbers = (str(v) for book in self.codebooks for entry in book for v in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _start(vectors: DataFrame, width: int, parts: int, entries: int, scale: int) -> Codebooks:
    """Parts of the vectors with the smallest ids (null ids last, equal ids by their vectors)."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    part = width // parts
    rows = [scaled_floor(pa.array([list(r.embedding)], pa.list_(pa.float64())), scale, width)[0] for r in first]
    return [[[int(v) for v in row[p * part:(p + 1) * part]] for row in rows] for p in range(parts)]


def _write(df: DataFrame, spark: SparkSession, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def fit(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compression:
    """Codebooks after ``rounds`` rounds and the assignment to them.

    Rows whose vector is null or holds null or non-finite components are
    dropped. A vector shorter than the longest, or whose length is no multiple
    of ``parts``, counts as continued with zeros. With fewer vectors than
    ``entries`` a codebook has as many entries as there are vectors.
    """
    spark = df.sparkSession
    vectors = kept_vectors(df, F.col("vec_id").cast("bigint").alias("vec_id"), "label")
    width = -(-longest(vectors) // parts) * parts
    part = width // parts
    label_type = vectors.schema["label"].dataType
    schema = T.StructType.fromDDL(_SCHEMA.format(label=f"array<{label_type.simpleString()}>"))
    books = _start(vectors, width, parts, entries, scale)
    k = len(books[0])
    floor_b, b = min(max(entries // 8, 1), max(k - 1, 0)), [min(max(entries // 4, 1), max(k - 1, 0))] * parts

    def record(batch_ids, batch_labels, kind, data, x, states, depths):
        sums = [{"part": p, "entry": e, "n": n, "sums": s}
                for p, state in enumerate(states) for e, n, s in _sums(x[:, p * part:(p + 1) * part], state.entry, k)]
        return pa.RecordBatch.from_pylist([{
            "vec_id": batch_ids, "label": batch_labels, "kind": kind, "vectors": data,
            "bounds": [s.tobytes() for s in states], "sums": sums, "depths": [d.tolist() for d in depths]}], schema=arrow)

    arrow = arrow_schema(schema)

    def begin(batches):
        for batch in batches:
            if batch.num_rows:
                whole = scaled_floor(batch.column(2), scale, width).astype(np.int64)
                kind, data = pack(whole)
                x = unpack(kind, data, width)
                states = [full_search(x[:, p * part:(p + 1) * part], books[p], b[p]) for p in range(parts)]
                yield record(batch.column(0).to_pylist(), batch.column(1).to_pylist(), kind, data, x, states, [])

    def next_round(moved: list[np.ndarray], books: Codebooks, b: list[int]):
        def run(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    x = unpack(r["kind"], r["vectors"], width)
                    done = [update(Bounds.frombytes(r["bounds"][p], len(x)), x[:, p * part:(p + 1) * part], books[p], moved[p], b[p])
                            for p in range(parts)]
                    yield record(r["vec_id"], r["label"], r["kind"], r["vectors"], x, [s for s, _ in done], [d for _, d in done])
        return run

    blocks, path = _write(vectors.mapInArrow(begin, schema), spark, "codes-0")
    needed = [list(b)]
    for i in range(rounds):
        new = _means(blocks, books)
        depth = blocks.select(F.posexplode("depths").alias("part", "d")).select("part", F.posexplode("d").alias("depth", "n")) \
            .groupBy("part", "depth").agg(F.sum("n").alias("n")).collect()
        for p in range(parts):
            b[p] = adapted(b[p], {r["depth"]: r["n"] for r in depth if r["part"] == p}, k, floor_b)
        blocks, newer = _write(blocks.select("vec_id", "label", "kind", "vectors", "bounds")
                               .mapInArrow(next_round(drifts(books, new), new, list(b)), schema), spark, f"codes-{i + 1}")
        drop_folder(spark, path)
        books, path = new, newer
        needed.append(list(b))
    return Compression(blocks, books, width, path, needed)


def _means(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry as the componentwise floor of its parts' mean; unused entries stay."""
    rows = (blocks.select(F.explode("sums").alias("s")).select("s.part", "s.entry", "s.n", F.posexplode("s.sums").alias("at", "v"))
            .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("total")).collect())
    new = [[list(entry) for entry in book] for book in books]
    for r in rows:
        new[r["part"]][r["entry"]][r["at"]] = int(r["total"]) // r["n"]
    return new


def encode(model: Compression) -> DataFrame:
    """(vec_id, label, code, error) of every kept row: one byte a part, and the exact squared error.

    Null and repeated vec_ids keep their rows; an empty table gives an empty
    result. ``error`` is decimal(38, 0).
    """
    import decimal

    books, width = model.codebooks, model.width
    parts = len(books)
    part = width // parts
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", model.blocks.schema["label"].dataType.elementType),
                           T.StructField("code", T.BinaryType()), T.StructField("error", T.DecimalType(38, 0))])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x = unpack(r["kind"], r["vectors"], width)
                entries = [Bounds.frombytes(data, len(x)).entry for data in r["bounds"]]
                total = sum(_distances_to(x[:, p * part:(p + 1) * part], books[p], e[:, None])[:, 0] for p, e in enumerate(entries))
                codes = np.stack(entries, axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["vec_id"], pa.int64()), pa.array(r["label"], label_arrow),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array([decimal.Decimal(int(v)) if v < 10 ** 38 else None for v in total], pa.decimal128(38, 0))],
                    names=["vec_id", "label", "code", "error"])

    label_arrow = arrow_schema(schema).field("label").type
    return model.blocks.select("vec_id", "label", "kind", "vectors", "bounds").mapInArrow(run, schema)


def with_label_error(encoded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the error summed over the rows of a label, null labels together.

    The sums are one row a label and are joined back, so a hot label is a
    skewed join side and never one task's window.
    """
    sums = encoded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return (encoded.alias("e").join(sums.alias("s"), F.col("e.label").eqNullSafe(F.col("s.label")))
            .select("e.*", "s.label_error"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same result in DuckDB SQL: plain rounds of full comparison, written from the rule, not from the bounds."""
    assign = """
    a{i} AS (
      SELECT v.row_no, v.part, v.x, arg_min(c.entry, (q.d, c.entry)) AS entry, min(q.d) AS d
      FROM v JOIN c{i} c ON c.part = v.part,
           LATERAL (SELECT list_sum([(v.x[j] - c.x[j]) * (v.x[j] - c.x[j]) FOR j IN range(1, len(v.x) + 1)]) AS d) q
      GROUP BY v.row_no, v.part, v.x)"""
    step = """,
    m{j} AS (
      SELECT part, entry, list(f ORDER BY pos) AS x FROM (
        SELECT part, entry, pos, (sum(val) - ((sum(val) % count(*)) + count(*)) % count(*)) // count(*) AS f
        FROM (SELECT part, entry, unnest(x) AS val, unnest(range(1, len(x) + 1)) AS pos FROM a{i}) GROUP BY part, entry, pos)
      GROUP BY part, entry),
    c{j} AS (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{j} m ON m.part = c.part AND m.entry = c.entry)"""
    text = f"""
    WITH kept AS (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row_no, vec_id, label,
             [CAST(floor({scale} * CAST(e AS DOUBLE)) AS HUGEINT) FOR e IN embedding] AS x
      FROM embeddings
      WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0),
    v AS (
      SELECT row_no, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x
      FROM kept, range(0, {parts}) AS t(part)),
    c0 AS (SELECT part, row_no - 1 AS entry, x FROM v WHERE row_no <= {entries}),"""
    for i in range(rounds + 1):
        text += assign.format(i=i) + (step.format(i=i, j=i + 1) + "," if i < rounds else "")
    return text.replace(" AS (", " AS MATERIALIZED (") + f""",
    book AS MATERIALIZED (
      SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h
      FROM (SELECT part, entry, unnest(x) AS val, unnest(range(1, len(x) + 1)) AS pos FROM c{rounds})),
    coded AS MATERIALIZED (
      SELECT row_no, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY row_no)
    SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
           book.h AS codebooks_sha256
    FROM kept k JOIN coded c USING (row_no), book"""
