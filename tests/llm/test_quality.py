import zlib

import numpy as np
import pytest
from llm_cases import docs_of

from shelfcast.llm import quality
from shelfcast.llm.common import held_out

DATA = "/root/testdata/sf0.1"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    out = quality.predict(docs.join(labels, "doc_id", "left_semi"), quality.fit(docs, labels)).join(labels, "doc_id") \
        .filter(held_out()).collect()
    good, bad = [r.score for r in out if r.quality == 1], [r.score for r in out if r.quality == 0]
    assert all(0 <= s <= 1 for s in good + bad)
    assert np.mean([s >= 0.7 for s in good]) >= 0.97 and np.mean([s < 0.7 for s in bad]) >= 0.9


def test_edge_rows(spark):
    rows = [(i, f"a plain sentence of number {i}, and more words follow." if i % 2 else "%%% ### %%% " * 20) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "w " * 100_000), (None, "no id"), (5, "again row five"), (1004, "é" * 50_000)]
    labels = [(i, i % 2, 0) for i in range(300)] + [(None, 1, 0), (1, None, 0), (2, 0, None), (9999, 1, 0), (3, 0, 1)]
    docs = docs_of(spark, rows, extra=("y", "x", "score", "calibrate", "quality"))
    model = quality.fit(docs, labels_of(spark, labels))
    out = quality.predict(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 7 in ids and 8 not in ids


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, [(1, "a"), (3, "b")])
    assert [r.score for r in quality.predict(docs, quality.fit(docs, labels_of(spark, []))).collect()] == [1.0, 1.0]
    one = [i for i in (1, 3) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert one
    assert quality.fit(docs, labels_of(spark, [(i, 0, 0) for i in one])) == 0.0
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert quality.fit(docs_of(spark, [(i, "t") for i in held]), labels_of(spark, [(i, i % 2, 0) for i in held])) == 1.0
    assert quality.predict(docs_of(spark, []), 1.0).count() == 0
    assert quality.accepted(docs, 1.0).count() == 2 and quality.accepted(docs, 0.0).count() == 0


def test_isotonic_matches_the_min_max_formula():
    rng = np.random.default_rng(0)
    x, y = rng.random(150), (rng.random(150) < 0.5).astype(float)
    knots, values = quality.isotonic(x, y)
    xs, ys = np.sort(x), y[np.argsort(x)]
    fit = np.array([max(min(ys[i:j + 1].mean() for j in range(k, 150)) for i in range(k + 1)) for k in range(150)])
    pools = np.unique(np.round(fit, 12))
    assert values == pytest.approx(pools)
    assert knots == pytest.approx([xs[np.round(fit, 12) == v].mean() for v in pools])
