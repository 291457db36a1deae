import itertools

import numpy as np
import pytest
from llm_cases import rows_of

from shelfcast.llm import embdedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], label, "x") for i, v, label in rows], SCHEMA)


def brute(rows):
    ok = []
    for i, v, label in rows:
        good = v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v)
        ok.append(np.array(v, dtype=np.float32).astype(float) if good else None)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = ok[a], ok[b]
        if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y):
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[a], links[b] = links[a] + 1, links[b] + 1
                root[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    comp = [least.get(find(i)) for i in range(len(rows))]
    return sorted(((r[0], links[i], comp[i], r[0] is not None and r[0] == comp[i]) for i, r in enumerate(rows)), key=repr)


def found(spark, rows, **kw):
    return rows_of(embdedup.near_duplicates(frame(spark, rows), **kw).drop("recall"))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0], 1), (2, [2, 0], 1), (3, [1, 0], 2), (4, None, 1), (5, [], 1), (6, [0, 0], 1), (7, [1, None], 1),
            (8, [nan, 1], 1), (9, [inf, 1], 1), (10, [1, 0], None), (11, [1, 0, 0], 1), (12, [1, 0.2], 1), (13, [1, 0.3], 1),
            (None, [1, 0.2], 1), (1, [1, 0], 1), (14, [0, 1], 3), (14, [0, 1], 3), (15, [1e-30, 0], 1), (None, None, None),
            (16, [-1, 0], 1), (17, [1e30, 1e30], 4), (18, [1, 1], 4)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert embdedup.near_duplicates(frame(spark, [])).count() == 0


def cloud(seed, n, groups, dim=24):
    """Random vectors with groups of near copies; ids shuffled."""
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(dim) for _ in range(n)]
    for size in groups:
        centre = rng.standard_normal(dim)
        out += [centre + 0.02 * rng.standard_normal(dim) for _ in range(size)]
    order = rng.permutation(len(out))
    return [(int(k), out[i].astype(np.float32).tolist(), int(i % 2 if i < n else 0)) for k, i in enumerate(order)]


@pytest.mark.parametrize("max_shard", [2048, 96])
def test_split_shards_and_dense_groups_reach_the_recall(spark, max_shard):
    rows = cloud(5, 500, [2, 3, 40, 260])
    want = {r[0]: r for r in brute(rows)}
    got = {r[0]: r for r in found(spark, rows, max_shard=max_shard)}
    assert got.keys() == want.keys()
    assert all(got[i][1] <= want[i][1] for i in want)                      # none below the threshold
    assert sum(r[1] for r in got.values()) >= 0.99 * sum(r[1] for r in want.values())
    assert sum(got[i][2] == want[i][2] for i in want) >= 0.99 * len(want)


def test_audit_sees_lost_links(spark):
    _, classes = embdedup.classes_of(frame(spark, cloud(6, 20, [60])))
    links, _ = embdedup.class_links(classes)
    assert embdedup.mean_recall(embdedup.audit_recall(classes, links, sample=1000)) == 1.0
    half = links.withColumn("links", (links["links"] / 2).cast("bigint"))
    assert embdedup.mean_recall(embdedup.audit_recall(classes, half, sample=1000)) < 0.6


def test_a_dense_group_does_not_hide_lost_small_groups(spark):
    """One dense group and 300 pairs: recall counts classes, not links, and leaves exactly compared ones out."""
    _, classes = embdedup.classes_of(frame(spark, cloud(8, 50, [400] + [2] * 300)))
    links, compared = embdedup.class_links(classes, max_shard=96)
    assert compared.count() >= 300
    lost = links.withColumn("links", (links["links"] > 50).cast("bigint") * links["links"])        # the pairs' links are gone
    assert embdedup.mean_recall(embdedup.audit_recall(classes, lost, sample=5000, compared=compared)) < 0.2
    assert embdedup.mean_recall(embdedup.audit_recall(classes, links, sample=5000, compared=compared)) >= embdedup.MIN_RECALL


def test_labels_below_the_recall_are_compared_exactly(spark, monkeypatch):
    rows = cloud(9, 200, [3, 5, 8, 30])
    plain = embdedup.class_links

    def loses(classes, *a):
        links, compared = plain(classes, *a)
        return links.filter("cid IS NULL"), compared.limit(0)

    monkeypatch.setattr(embdedup, "class_links", loses)
    out = embdedup.near_duplicates(frame(spark, rows), max_shard=32)
    assert rows_of(out.drop("recall")) == brute(rows) and out.first().recall == 1.0


def test_double_vectors_stay_double_when_shards_are_split(spark):
    rng = np.random.default_rng(10)
    vectors = rng.standard_normal((300, 8))
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(vectors)], SCHEMA.replace("float", "double"))
    _, classes = embdedup.classes_of(df)
    shards, solid = embdedup.cluster_shards(classes, max_shard=64)
    placed = {tuple(r.vec) for part in (shards, solid) for r in part.select("vec").collect()}
    assert placed == {tuple(v) for v in vectors.tolist()}


def test_dense_group_is_counted_by_whole_blocks(spark):
    """A tight group needs no comparison, one near the bound some, a wide one all; each gives all links, repeated vectors too."""
    rng = np.random.default_rng(11)
    centre = rng.standard_normal(16)
    compared = {}
    for name, spread in (("tight", 0.03), ("middle", 0.1), ("wide", 0.13)):
        vectors = [(centre + spread * rng.standard_normal(16)).astype(np.float32).tolist() for _ in range(420)]
        rows = [(i, v, 1) for i, v in enumerate(vectors + vectors[:30])]
        assert found(spark, rows, max_shard=64) == brute(rows)
        _, classes = embdedup.classes_of(frame(spark, rows))
        _, solid = embdedup.cluster_shards(classes, 64)
        held = solid.groupBy("cid").agg(embdedup.F.array_sort(embdedup.F.collect_set("path")).alias("paths"))
        pairs = embdedup.dense_blocks(solid.join(held, "cid"), 64)[1]
        counts = {r["sure"]: r["count"] for r in pairs.groupBy("sure").count().collect()}
        compared[name] = counts.get(False, 0) / sum(counts.values())
    assert compared["tight"] == 0
    assert 0 < compared["middle"] < compared["wide"] <= 1


def test_group_of_equal_angles_is_dealt_to_blocks(spark):
    """Vectors at one angle to their mean: no block grows with the group."""
    rows = [(i, [10.0] + [1.0 if j == i else 0.0 for j in range(200)], 1) for i in range(200)]
    assert found(spark, rows, max_shard=32) == brute(rows)
    _, classes = embdedup.classes_of(frame(spark, rows))
    _, solid = embdedup.cluster_shards(classes, 32)
    members, _ = embdedup.dense_blocks(solid.withColumn("paths", embdedup.F.array("path")), 32)
    assert members.groupBy("path", "block").count().agg({"count": "max"}).first()[0] <= 40
