import zlib

from llm_cases import docs_of

from shelfcast.llm import langid
from shelfcast.llm.common import held_out

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_whole_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = langid.predict(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id") \
        .withColumn("held", held_out()).collect()
    assert len(out) == 1000 and all(0 <= r.score <= 1 for r in out)
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    test = [r for r in out if r.held]
    assert sum(r.lang == r.lang_pred for r in test) >= 0.98 * len(test)


def train_rows():
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][:60]
    return [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in ids]


def test_edge_texts(spark):
    rows = train_rows()
    model = langid.fit(docs_of(spark, rows, extra=("word", "n", "gram", "w")))
    asked = [(1, None), (2, ""), (3, "123 !? ²"), (4, "THE CAT"), (5, "katzen"), (None, "und die"), (4, "THE CAT"),
             (6, "漢字"), (7, "the " * 100_000), (8, "katze" * 20_000)]
    got = langid.predict(docs_of(spark, asked, extra=("score", "word")), model).collect()
    assert len(got) == len(asked)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3, 4, 5, None, 7, 8)] == ["und", "und", "und", "en", "de", "de", "en", "de"]
    assert by[1].score == by[3].score == 0.0 and by[6].lang_pred in ("de", "en")
    assert langid.predict(docs_of(spark, []), model).count() == 0


def test_held_out_and_null_langs_teach_nothing(spark):
    held = [(i, "xyzzy plugh", "zz") for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    model = langid.fit(docs_of(spark, train_rows() + held + [(1, "xyzzy", None)]))
    assert model.langs == ["de", "en"] and "xyzzy" not in model.words
    nothing = langid.fit(docs_of(spark, held))
    got = langid.predict(docs_of(spark, [(1, "xyzzy")]), nothing).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_unseen_words_back_off_to_shorter_grams():
    model = langid.Model(["a", "b"], [0.0, 0.0], {"known": [-1.0, -9.0]},
                         {"^kno": [-1.0, -9.0], "ki": [-9.0, -1.0], "k": [-1.0, -1.0]})
    s = langid.Scorer(model)
    one = lambda *words: s.scores(langid.Counter(words)).tolist()
    assert one("known") == [-1, -9] and one("kiwi") == [-9, -1] and one("kno") == [-1, -9]
    assert one("sk") == [-1, -1] and one("zzz") == [0, 0]
    assert one("known", "known", "kiwi") == [-11, -19] and one("kiwi", "k" * 40) == [-10, -2]
