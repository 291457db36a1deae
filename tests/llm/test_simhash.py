import itertools

import numpy as np
import xxhash
from llm_cases import SF, docs_of, rows_of

from shelfcast.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, fps=None):
    fps = fps or [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 2:
            root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], f"{fps[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)), key=repr)


def found(docs):
    return rows_of(simhash.near_duplicates(docs).select("doc_id", simhash.fingerprint_hex(), "component_id"))


def test_every_pair_of_positions_is_covered():
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks()]
    assert len(masks) == 7 and all(36 <= bin(m).count("1") <= 37 for m in masks)
    for a, b in itertools.combinations_with_replacement(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_edge_rows_match_brute_force(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One two"), (6, "one  TWO"), (7, "É é É"), (8, "é é é"),
            (9, base), (10, base.upper()), (11, base + " tail"), (None, base), (None, "nobody else says this at all"),
            (9, base), (12, "x " * 50_000), (13, "x " * 40_000), (14, "a\x0bb\x0cc")]
    assert found(docs_of(spark, rows, extra=("fp", "component", "t", "bucket", "n", "near"))) == brute(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_crowded_buckets_lose_no_link(spark):
    """Chains of fingerprints a few bits apart, with every bucket over the limit or none."""
    rng = np.random.default_rng(3)
    fps = {0}
    for _ in range(300):
        at = sorted(fps)[rng.integers(len(fps))]
        for _ in range(rng.integers(1, 4)):
            at ^= 1 << int(rng.integers(64))
        fps.add(at)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(fps)]
    df = spark.createDataFrame(signed, "fp bigint")
    rows = [(i, None) for i in range(len(signed))]
    expected = {r[0]: r[2] for r in brute(rows, sorted(fps))}
    for limit in (1, 64, 10_000):
        links = simhash.fingerprint_links(df, max_bucket=limit)
        comp = {r.node: r.component for r in simhash.connected_components(links).collect()}
        groups = {}
        for i, (f,) in enumerate(signed):
            groups.setdefault(comp.get(f, f), []).append(i)
        assert {i: min(g) for g in groups.values() for i in g} == expected, limit
        for a, b in links.collect():
            assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 2
