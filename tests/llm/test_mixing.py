import collections
import math

import pytest
from llm_cases import SF, docs_of

from shelfcast.llm import mixing
from shelfcast.llm.mixing import Target


def rows(sizes, length=10):
    return [(i * 1000 + k, " ".join(["w"] * (1 + (k * 7) % length)), None, s) for i, (s, n) in enumerate(sizes.items()) for k in range(n)]


def tokens(data):
    t = collections.Counter()
    for r in data:
        t[r[3]] += len((r[1] or "").split())
    return t


def brute_exponent(t, target):
    """Plain bisection for both conditions."""
    total = sum(t.values())
    p = [v / total for v in t.values()]

    def entropy(x):
        w = [q ** x for q in p]
        return -sum(a / sum(w) * math.log(a / sum(w)) for a in w)

    def most(x):
        w = [q ** x for q in p]
        e = [a / sum(w) / q for a, q in zip(w, p)]
        scale = target.budget_tokens / total if target.budget_tokens else 1 / min(e)
        return max(e) * scale

    def bisect(good_low, ok):
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            if ok(mid) == good_low:
                lo = mid
            else:
                hi = mid
        return lo if good_low else hi

    even = 1.0 if entropy(1.0) >= target.entropy_share * math.log(len(p)) else bisect(
        True, lambda x: entropy(x) >= target.entropy_share * math.log(len(p)))
    calm = 0.0 if most(0.0) <= target.max_repetition else bisect(False, lambda x: most(x) <= target.max_repetition)
    return max(even, calm)


@pytest.mark.parametrize("target", [Target(), Target(0.99, 100.0), Target(0.9, 1.2), Target(0.97, 3.0, 2_000), Target(0.97, 3.0, 300)])
def test_weights_and_copies(spark, target):
    data = rows({"big": 300, "mid": 60, "small": 20, None: 12})
    t, total = tokens(data), sum(tokens(data).values())
    x = brute_exponent(t, target)
    z = sum((v / total) ** x for v in t.values())
    weights = {s: (v / total) ** x / z for s, v in t.items()}
    budget = target.budget_tokens or total * z * (max(t.values()) / total) ** (1 - x)
    out = mixing.mix(docs_of(spark, data), target).collect()
    seen = collections.Counter()
    for r in out:
        seen[r.source] += r.n_tokens
        assert r.weight == pytest.approx(weights[r.source], rel=1e-6)
        assert r.epochs == pytest.approx(weights[r.source] * budget / t[r.source], rel=1e-6)
    for s in t:
        want = weights[s] * budget
        assert want - 10 <= seen[s] <= want + 1e-3, s           # short of the budget by less than a document
    per_doc = collections.defaultdict(collections.Counter)
    places = collections.defaultdict(list)
    for r in out:
        per_doc[r.source][r.doc_id] += 1
        places[r.source, r.epoch, r.block].append(r.position)
    for s, c in per_doc.items():
        assert max(c.values()) - min(c.values()) <= 1           # whole epochs, and one in part
        if target.budget_tokens is None:
            assert len(c) == sum(1 for d in data if d[3] == s)  # nothing is dropped
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_repeated_documents_keep_their_columns(spark):
    data = rows({"big": 200, "small": 20}) + [(None, None, None, None), (7, "", None, "small"), (7, "", None, "small")]
    docs = docs_of(spark, data, extra=("key", "n", "whole", "cut", "_row"))
    out = mixing.repeat_documents(docs)
    assert out.columns == docs.columns
    copies = collections.Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert collections.Counter(r.doc_id for r in out.collect()) == copies
    assert set(copies) == {d[0] for d in data}


def test_repeated_documents_stand_in_the_order_of_the_plan(spark):
    docs = docs_of(spark, rows({"big": 3000, "small": 400}))
    out = [(r.source, r.doc_id) for r in mixing.repeat_documents(docs).collect()]
    plan = sorted(mixing.mix(docs).collect(), key=lambda r: (r.epoch, r.block, r.position))
    for source in ("big", "small"):
        assert [d for s, d in out if s == source] == [r.doc_id for r in plan if r.source == source]
    whole = collections.Counter(s for s, _ in out)["small"] / len(out)
    for i in range(0, len(out) - 500, 500):                                # every stretch holds the sources by their weights
        assert abs(sum(s == "small" for s, _ in out[i:i + 500]) / 500 - whole) < 0.08


def test_one_source_no_tokens_and_empty_table(spark):
    assert mixing.mix(docs_of(spark, [(1, "a b", None, "s"), (2, "c", None, "s")])).count() == 2
    assert mixing.mix(docs_of(spark, [(1, None, None, "s"), (2, "", None, "t")])).count() == 2
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert mixing.repeat_documents(docs_of(spark, [])).count() == 0


def test_whole_table_keeps_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert mixing.mix(docs).select("doc_id").distinct().count() == docs.count()
