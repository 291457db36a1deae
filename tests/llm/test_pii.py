import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from llm_cases import SF, docs_of

from shelfcast.llm import pii, queries

# The contract's patterns, as they stand.
PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def passes(kind, span):
    digits = [int(c) for c in span if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d - 9 if 2 * d > 9 else 2 * d) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute_base(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(k, m.group())]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


EDGE = [
    (1, None), (2, ""), (3, "a@b.c_d@e.f x@y @z.w a@b a@b. a@b.c. %+-@-.-"), (4, "1.2.3.4.5.6.7.8.9 256.1.1.1 00001.2.3.004 1.2.3"),
    (5, "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111"), (6, "+1 (555) 010-9999 +12 +1( +44 20 7946 0958. +1234567890123456"),
    (7, "é a@b.c 😀 10.0.0.1 😀+49 30 1234567"), (None, "me@example.org"), (7, "me@example.org"), (8, "+1 4111111111111111@x.y"),
    (9, "4465758382889437 4465758382889437"), (10, "٣٤.1.2.3 １.2.3.4"), (11, "a@b.c@d.e a+1@b.c"), (12, "1.2.3.4" * 40), (13, "\x00+1-555-010-9999\n"),
    (14, "Call (743) 555-3824, write jane [at] mail [dot] org or 2001:0db8:0000:0000:0000:ff00:0042:8329")]


def found_by(df):
    return [(r.doc_id, [f"{s.kind}:{s.start}:{s.end}" for s in r.base], [f"{s.kind}:{s.start}:{s.end}" for s in r.spans]) for r in df.collect()]


def test_base_spans_match_the_plain_patterns(spark):
    out = found_by(pii.find_personal_data(docs_of(spark, EDGE, extra=("found", "base", "spans", "kind", "n"))))
    assert sorted([(i, b) for i, b, _ in out], key=repr) == sorted([(i, brute_base(t)) for i, t in EDGE], key=repr)
    assert all(set(b) <= set(s) for _, b, s in out)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op11_personal_data(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = brute_base(texts[r.doc_id])
        kinds = [b.split(":")[0] for b in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in pii.BASE_KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(","))


def test_random_texts_match_the_plain_patterns():
    rng = random.Random(11)
    for _ in range(3000):
        text = "".join(rng.choice(["a@b.c", "1.2", "+1", "4111 1111", " ", ".", "-", "@", "_", "(", ")", "12", "é", "3.4.5.6", "\n"])
                       for _ in range(rng.randrange(14)))
        got = sorted((a, k, b) for k, a, b, base in pii.candidates(text) if base)
        assert [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in got] == brute_base(text), text


@pytest.mark.parametrize("text, n", [("a" * 2_000_000 + "@", 0), ("1" * 2_000_000, 0), ("+1" + " (" * 1_000_000, 0), ("@" * 1_000_000, 0),
                                     ("1." * 1_000_000, 250_000), ("a@b.c " * 200_000, 200_000), ("1 " * 1_000_000, 0),
                                     ("A" * 1_000_000 + "0" * 1_000_000, 0), ("+1 555 010 9999, " * 50_000, 50_000), ("Hans Peter " * 100_000, 0)])
def test_very_long_texts_take_linear_time(text, n):
    start = time.perf_counter()
    assert sum(base for *_, base in pii.candidates(text)) == n
    assert time.perf_counter() - start < 20


def test_added_spans(spark):
    rng = random.Random(3)

    def card(good):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        check = next(c for c in "0123456789" if pii.luhn(body + c))
        return body + (check if good else str((int(check) + 1 + rng.randrange(8)) % 10))

    rows = [(i, f"some words before {card(i % 2)} and some after") for i in range(200)]
    rows += [(200 + i, f"call +1 (743) 555-{1000 + i} today") for i in range(100)]
    rows += [(300, "+1 (826) 555-4081 190.137.2.1"), (301, f"one {card(True)} {card(True)} row"), (302, "call (743) 555-3824 now"),
             (303, "nothing of the kind: 12 apples, version 1.2, order 1234567890123")]
    out = {i: (set(b), set(s)) for i, b, s in found_by(pii.find_personal_data(docs_of(spark, rows)))}
    assert all(out[i][1] == out[i][0] and len(out[i][0]) == i % 2 for i in range(200))     # failing check digits are not added
    assert "phone:0:17" in out[300][1] and not [s for s in out[300][0] if s.startswith("phone")]
    assert len(out[301][1]) == 2 and not out[301][0]
    assert out[302][1] == {"phone:5:19"} and out[303][1] == set()


def test_reliabilities_match_em_by_candidate():
    """The same iteration over single candidates with plain dictionaries."""
    rng = np.random.default_rng(7)
    truth = rng.random(600) < 0.6
    say = [(0.95, 0.9), (0.99, 0.9), (0.6, 0.95)]                                # P(yes | real), P(no | false); the second one is check
    votes = np.zeros((600, len(pii.LABELERS)), dtype=int)
    for j, (hit, reject) in enumerate(say):
        right = rng.random(600) < np.where(truth, hit, reject)
        votes[:, j] = np.where(rng.random(600) < 0.2, pii.ABSTAIN, np.where(truth == right, pii.YES, pii.NO))
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    real, share, table = pii.reliabilities(patterns, counts.astype(float), rounds=30)

    post = [(1 + sum(v == 2 for v in row)) / (2 + sum(v != 0 for v in row)) for row in votes.tolist()]
    for _ in range(30):
        tables, prior = {}, {}
        for c in (0, 1):
            w = [p if c else 1 - p for p in post]
            prior[c] = (sum(w) + 2) / (600 + 4)
            for j, name in enumerate(pii.LABELERS):
                pseudo = (pii.CHECK_PRIOR if name == "check" else pii.VOTE_PRIOR)[c]
                t = [pseudo[v] + sum(wi for wi, row in zip(w, votes.tolist()) if row[j] == v) for v in range(3)]
                tables[c, j] = [x / sum(t) for x in t]
                if name == "check" and c == 1:
                    says = tables[c, j][1] + tables[c, j][2]
                    tables[c, j][1:] = [0.01 * says, 0.99 * says]
        post = []
        for row in votes.tolist():
            like = [prior[c] * math.prod(tables[c, j][v] for j, v in enumerate(row)) for c in (0, 1)]
            post.append(like[1] / sum(like))
    assert real[back.ravel()] == pytest.approx(post, abs=1e-9) and share == pytest.approx(prior[1], abs=1e-9)
    assert table[0, 1] == pytest.approx(tables[1, 0], abs=1e-9)
    assert ((real[back.ravel()] > 0.5) == truth).mean() > 0.9
    assert table[0, 1, pii.YES] > table[2, 1, pii.YES]                           # the first labeler is more reliable than the third


def test_classifier_is_the_optimum_of_its_loss(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = pii.scan(docs)
    model = pii.fit(found)
    spans = [s for r in found.collect() for s in r.found]
    x = pii.design(np.array([s.kind for s in spans]), np.array([list(s.features) for s in spans], dtype=float))
    goal = np.array([model.posterior[s.kind, s.votes] for s in spans])
    gradient = x.T @ (goal - 1 / (1 + np.exp(-x @ model.weights))) - pii.RIDGE * model.weights
    assert len(spans) > 50 and np.abs(gradient).max() < 1e-6


def test_choose_and_mask():
    def span(kind, start, end, base):
        return {"kind": kind, "start": start, "end": end, "base": base}

    spans = [span(0, 0, 5, True), span(3, 4, 9, False), span(2, 10, 20, False), span(3, 12, 30, False), span(1, 40, 50, True),
             span(2, 45, 60, True), span(4, 58, 62, False), span(5, 62, 66, False), span(6, 66, 70, False)]
    got = pii.choose(spans, [0.1, 0.9, 0.85, 0.95, 0.5, 0.5, 0.99, 0.81, 0.79])
    assert [(s, k, e) for s, k, e, _ in got] == [(0, 0, 5), (12, 3, 30), (40, 1, 50), (45, 2, 60), (62, 5, 66)]
    assert pii.mask("ab cd ef", [("email", 3, 5), ("ip", 4, 7), ("card", 0, 1)]) == "<card>b <email>f"


def test_empty_table(spark):
    assert pii.find_personal_data(docs_of(spark, [])).count() == 0
