import collections

import corpus_pipeline
from llm_cases import SF, docs_of
from test_decontam import brute as brute_leaks
from test_simhash import brute as brute_parts

from shelfcast.llm import decontam, quality, stages
from shelfcast.llm.common import drop_scratch, materialize


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "decontaminate", "mix", "shard"]
    good = materialize(stages.quality(spark, docs, SF), "q")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.predict(docs, model).collect()}
    assert {d for d, _ in texts(good)} == {d for d, s in scores.items() if s >= quality.KEEP_AT}

    single = materialize(stages.simhash(spark, good, SF), "s")
    assert sorted(d for d, _ in texts(single)) == sorted(d for d, _, c in brute_parts(texts(good)) if d == c)

    clean = materialize(stages.decontaminate(spark, single, SF), "d")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_leaks(texts(single), items)}
    assert {d for d, _ in texts(clean)} == {d for d, _ in texts(single)} - leaks
    assert decontam.find_contamination(clean, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0

    mixed = materialize(stages.mix(spark, clean, SF), "m")
    assert {d for d, _ in texts(mixed)} == {d for d, _ in texts(clean)}
    for stage in (good, single, clean, mixed):
        assert stage.dtypes == docs.dtypes

    out = stages.shard(spark, mixed, SF)
    assert out.columns == [*docs.columns, "shard"]
    shard_of = collections.defaultdict(set)
    for r in out.collect():
        shard_of[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values()) and set().union(*shard_of.values()) == set(range(8))
    assert out.count() == mixed.count()


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = entry.queries().keys()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert corpus_pipeline.run(spark, SF).count() > 0
    drop_scratch(spark)


def test_simhash_stage_keeps_one_row(spark):
    base, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    kept = lambda rows: sorted(((r.doc_id, r.text) for r in stages.simhash(spark, docs_of(spark, rows, extra=("fp", "row_key")), SF).collect()), key=repr)
    assert kept([(2, base), (1, base), (1, base), (None, base), (3, other)]) == [(1, base), (3, other)]
    assert kept([(1, base), (2, base), (2, other)]) == [(1, base), (2, other)]        # two texts under one id are two documents
    assert kept([(2, base), (2, other)]) == sorted([(2, base), (2, other)])
    assert kept([(None, base), (None, base), (None, other), (4, None), (5, "")]) == sorted([(None, base), (None, other), (4, None)], key=repr)
    assert kept([]) == []
