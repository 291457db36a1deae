import duckdb
import numpy as np
import pytest
from llm_cases import SF
from pyspark.sql import types as T

from shelfcast.llm import codes, queries

NAN, INF = float("nan"), float("inf")


def vectors_of(spark, rows, kind=T.FloatType(), extra=()):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind)),
                           T.StructField("label", T.IntegerType())])
    df = spark.createDataFrame(rows, schema)
    for name in extra:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def whole(v, scale, width):
    """floor(scale * x) as Python integers, continued with zeros."""
    return [int(np.floor(np.float64(x) * scale)) for x in v] + [0] * (width - len(v))


def brute(rows, kind, parts=8, entries=16, rounds=6, scale=4096):
    """Plain k-means on Python integers."""
    rows = [(i, [float(kind(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max([len(v) for _, v, _ in rows] + [1]) // parts) * parts
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    part, xs = width // parts, [whole(v, scale, width) for _, v, _ in rows]
    books = [[x[p * part:(p + 1) * part] for x in xs[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for step in range(rounds + 1):
        found = [[nearest(x[p * part:(p + 1) * part], books[p]) for p in range(parts)] for x in xs]
        if step < rounds:
            for p in range(parts):
                for j in range(len(books[p])):
                    own = [x[p * part:(p + 1) * part] for x, f in zip(xs, found) if f[p][1] == j]
                    if own:
                        books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    error = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, lab), e in zip(rows, error):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted([(i, bytes(j for _, j in f), e, by_label[lab]) for (i, _, lab), f, e in zip(rows, found, error)], key=repr), books


def result(df):
    model = codes.fit(df)
    rows = codes.with_label_error(codes.encode(model)).collect()
    return sorted([(r.vec_id, bytes(r.code), int(r.error), int(r.label_error)) for r in rows], key=repr), model


def test_equals_plain_rounds_in_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    rel = con.sql(codes.oracle())
    got = queries.op13_codes(spark, SF).select(*rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall()) and len(got) == 500


@pytest.mark.parametrize("kind, numpy_kind, scale", [(T.FloatType(), np.float32, 1.0), (T.DoubleType(), np.float64, 1.0),
                                                     (T.DoubleType(), np.float64, 1e6)])
def test_equals_brute_force_with_ties_and_edge_rows(spark, kind, numpy_kind, scale):
    rng = np.random.default_rng(3)
    grid = rng.integers(-2, 3, (120, 16)) / 4096 * scale                      # few distinct values: many ties
    rows = [(int(i), v.tolist(), int(i % 3)) for i, v in enumerate(grid)]
    rows += [(5, rows[5][1], 1), (None, rows[7][1], None), (None, rows[8][1], None), (900, [0.0] * 16, None), (901, [], 2),
             (902, [1.0, 2.0, 3.0], 0), (903, None, 1), (904, [NAN] * 16, 1), (905, [INF] + [0.0] * 15, 1), (906, [None] + [0.0] * 15, 1)]
    got, model = result(vectors_of(spark, rows, kind, extra=("code", "error", "entry", "kind")))
    expected, books = brute(rows, numpy_kind)
    assert got == expected
    assert model.codebooks == books


def test_few_rows_and_none(spark):
    assert result(vectors_of(spark, []))[0] == []
    rows = [(2, [0.5] * 8, 1), (1, [-0.5] * 8, 1), (3, None, 1)]
    assert result(vectors_of(spark, rows))[0] == brute(rows, np.float32)[0]


def test_bounds_never_decide_against_the_integers():
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (400, 4))
    book = rng.integers(-3, 4, (16, 4)).tolist()
    state, b, work = codes.full_search(x, book, 4), 4, []
    for step in range(12):
        moved = [[v + int(rng.integers(-1, 2)) * (step % 3 == 0) for v in e] if rng.random() < 0.4 else e for e in book]
        state, depths = codes.update(codes.Bounds.frombytes(state.tobytes(), len(x)), x, moved, codes.drifts([book], [moved])[0], b)
        book, b = moved, codes.adapted(b, dict(enumerate(depths.tolist())), 16, 2)
        d2 = codes.squared_distances(x, book)
        assert (state.entry == d2.argmin(axis=1)).all() and depths.sum() == len(x)
        d = np.sqrt(d2)
        assert (state.upper >= d.min(axis=1)).all()
        for row in range(len(x)):                                              # every bound holds for all entries after it
            near = state.near[row].tolist()
            rest = [j for j in range(16) if j != state.entry[row] and j not in near]
            assert state.outer[row] <= min(d[row, rest])
            for i, lower in enumerate(state.lower[row]):
                assert lower <= min(d[row, near[i:] + rest])
        work.append(depths[0])
    assert max(work) > 200                                                     # most rows need no distance once entries rest


def test_adapted_b():
    assert codes.adapted(4, {0: 80, 4: 20}, 16, 2) == 4                        # 4 x 100 bounds against 2 x 100 and 20 whole searches
    assert codes.adapted(4, {0: 99, 1: 1}, 16, 2) == 2
    assert codes.adapted(1, {}, 16, 2) == 1


def test_large_integers_are_exact():
    x = np.array([[2 ** 40, -2 ** 40], [3, 4]], dtype=np.int64)
    assert codes.squared_distances(x, [[0, 0], [2 ** 40, 1]]).tolist() == [[2 ** 81, (2 ** 40 + 1) ** 2], [25, (2 ** 40 - 3) ** 2 + 9]]
