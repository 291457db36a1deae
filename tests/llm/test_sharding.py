import zlib

from llm_cases import SF, docs_of

from shelfcast.llm import sharding


def check(rows, texts, n_shards=8):
    assert len(rows) == len(texts)
    by_text, slots, loads = {}, {}, [0] * n_shards
    for r, text in zip(rows, texts):
        data = (text or "").encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes" and r.grown_shard is None
        assert by_text.setdefault(data, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        loads[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return loads


def test_whole_table_is_balanced(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sorted(sharding.shard_documents(docs).collect())
    loads = check(rows, [texts[r.doc_id] for r in rows])
    groups = {}
    for t in texts.values():
        groups[t] = groups.get(t, 0) + len((t or "").encode()) + 1
    # plain longest-first over all groups
    plain = sharding.longest_first([(n, (t or "",)) for t, n in groups.items()], 8)
    best = [0] * 8
    for t, n in groups.items():
        best[plain[(t or "",)]] += n
    assert max(loads) <= max(best) * 1.01


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "é"), (4, "y" * 300_000), (None, "a"), (None, "a"), (5, "a"), (5, "a"), (5, "b")]
    docs = docs_of(spark, rows, extra=("shard", "_unit", "_g1", "bytes", "slot", "size"))
    out = sharding.shard_documents(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    texts = sorted(rows, key=lambda r: (key(r), zlib.crc32((r[1] or "").encode())))
    check(sorted(out, key=lambda r: (key(r), r.text_crc32)), [t for _, t in texts])


def test_bundled_groups_are_balanced(spark):
    rows = [(i, "t" * (i % 50) + str(i)) for i in range(2_000)]
    out = sharding.assign_shards(docs_of(spark, rows), 4, units_per_shard=10)
    loads = {r.shard: r.n for r in out.groupBy("shard").agg({"n_chars": "sum"}).toDF("shard", "n").collect()}
    assert len(loads) == 4 and max(loads.values()) <= 1.05 * sum(loads.values()) / 4


def test_extra_columns_stay_and_empty_table(spark):
    docs = docs_of(spark, [(1, "a")], extra=("_unit", "shard"))
    out = sharding.assign_shards(docs, 2)
    assert sorted(out.columns) == sorted(docs.columns) and out.first()["_unit"] == "x" and out.first()["shard"] in (0, 1)
    assert sharding.shard_documents(docs_of(spark, [])).count() == 0
