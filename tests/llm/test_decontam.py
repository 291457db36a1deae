import collections
import math
import random
import re

import numpy as np
import pytest
from llm_cases import SF, docs_of

from shelfcast.llm import decontam


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def runs(words):
    """The test's own 5-word shingles, as joined strings; the whole sequence of a shorter text."""
    n = min(5, len(words))
    return {" ".join(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set()


def plain_words(text):
    return re.findall(r"\w+", (text or "").lower())


def passages_of(words, item_sizes, size):
    """Windows of twice the longest item between this size's powers of two, one every that many words."""
    top = 1
    while top <= size:
        top *= 2
    longest = max(n for n in item_sizes if top // 2 <= n < top)
    starts = range(0, max(len(words) - longest, 1), longest)
    return [words[s:s + 2 * longest] for s in starts]


def brute(docs, items):
    """Every passage of every document against every item: BM25 share of a half, then 0.8 of the whole or of both parts."""
    own = [(i, plain_words(t)) for i, t in items if plain_words(t)]
    sizes = [len(w) for _, w in own]
    df = collections.Counter(w for _, words in own for w in set(words))
    idf = {w: math.log(1 + (len(own) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = set()
    for d, text in docs:
        words = plain_words(text)
        for i, item in own:
            if len(set(item) & set(words)) < 0.3 * len(set(item)):           # far from any rule below
                continue
            tf = collections.Counter(item)
            weight = {w: idf[w] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(item) * len(own) / sum(sizes))) for w, n in tf.items()}
            cut = len(item) - max(math.ceil(len(item) / 4), 5)
            question, answer = (runs(item), runs(item)) if len(item) < 10 else (runs(item[:cut]), runs(item[cut:]))
            n = min(5, len(item))
            for passage in passages_of(words, sizes, len(item)):
                here = {" ".join(passage[k:k + n]) for k in range(len(passage) - n + 1)}
                share = lambda part: len(part & here) / len(part)  # noqa: E731, B023
                score = sum(v for w, v in weight.items() if w in set(passage)) / sum(weight.values())
                if score >= 0.5 and (share(runs(item)) >= 0.8 or min(share(question), share(answer)) >= 0.8):
                    out.add((d, i))
                    break
    return out


def found(docs, items):
    return {(r.doc_id, r.item_id) for r in decontam.find_contamination(docs, items).collect()}


def test_whole_table_matches_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and found(docs, items) == want


def test_edge_rows(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    item = [word() for _ in range(30)]
    other = [word() for _ in range(30)]
    noise = lambda n: " ".join(word() for _ in range(n))
    text = " ".join(item)
    docs = [(1, None), (2, ""), (3, text), (4, noise(300) + " " + text.upper().replace(" ", ",\n") + " " + noise(300)),
            (5, " ".join(item[:15])), (6, " ".join(item[:20]) + " " + noise(10)), (None, text), (3, text),
            (7, noise(20_000) + " " + text + " " + noise(20_000)), (8, " ".join(item[::-1])), (9, text + " " + " ".join(other)),
            (10, " ".join(w if k != 1 else "changed" for k, w in enumerate(item))), (11, "tiny item"), (12, "tiny thing item")]
    items = [(1, text), (2, " ".join(other)), (3, None), (4, ""), (None, "tiny item"), (5, text)]
    df = docs_of(spark, docs, extra=("item_id", "score", "words"))
    got = decontam.find_contamination(df, items_of(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    assert {d for d, i in brute(docs, items) if i == 1} == {3, 4, None, 7, 9, 10}
    assert sum(r.doc_id == 3 and r.item_id == 1 for r in got) == 2
    kept = [r.doc_id for r in decontam.clean_rows(df, items_of(spark, items)).collect()]
    assert sorted(kept) == [1, 2, 5, 6, 8, 12]


def test_short_items_are_found(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    noise = lambda: " ".join(word() for _ in range(40))
    items = [(n, [word() for _ in range(n)]) for n in range(5, 13)]
    docs, want = [], set()
    for n, words in items:
        for kind, part in enumerate((words, words[:-1], words[1:], words[:-2])):
            d = 10 * n + kind
            docs.append((d, f"{noise()} {' '.join(part)} {noise()}"))
            if len(runs(words) & runs(docs[-1][1].split())) >= 0.8 * len(runs(words)):
                want.add((d, n))
    got = found(docs_of(spark, docs), items_of(spark, [(n, " ".join(w)) for n, w in items]))
    assert {(10 * n, n) for n, _ in items} <= got
    assert {p for p in got if p[1] < 10} == {p for p in want if p[1] < 10}


def test_a_word_changed_anywhere(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    noise = lambda: " ".join(word() for _ in range(40))
    items = [(n, [word() for _ in range(n)]) for n in (12, 15, 25, 33, 40, 59)]
    docs, want = [], {}
    for n, words in items:
        for k in range(n):
            edit = words[:k] + ["changed"] + words[k + 1:]
            docs.append((100 * n + k, f"{noise()} {' '.join(edit)} {noise()}"))
            share = len(runs(words) & runs(edit)) / len(runs(words))
            if share >= 0.8:
                want[100 * n + k, n] = share
    got = decontam.find_contamination(docs_of(spark, docs), items_of(spark, [(n, " ".join(w)) for n, w in items])).collect()
    overlap = {(r.doc_id, r.item_id): r.overlap for r in got}
    assert len(want) > 100 and want.keys() <= overlap.keys()
    assert all(abs(overlap[k] - v) < 1e-9 for k, v in want.items())
    # question and answer apart, with other words between: as before
    apart = items[1][1][:10] + ["between"] * 8 + items[1][1][10:]
    assert found(docs_of(spark, [(1, " ".join(apart))]), items_of(spark, [(15, " ".join(items[1][1]))])) == {(1, 15)}


def test_empty_tables(spark):
    docs = docs_of(spark, [(1, "some text of some length")])
    assert decontam.find_contamination(docs, items_of(spark, [])).count() == 0
    assert decontam.find_contamination(docs_of(spark, []), items_of(spark, [(1, "a b c d e f")])).count() == 0


def test_several_slices_give_the_same(spark, monkeypatch):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    one = sorted(map(tuple, decontam.find_contamination(docs, items).select("doc_id", "item_id", "n_passages").collect()))
    monkeypatch.setattr(decontam, "INDEX_WORDS", 700)
    many = sorted(map(tuple, decontam.find_contamination(docs, items).select("doc_id", "item_id", "n_passages").collect()))
    assert one == many
    clean = sorted(r.doc_id for r in decontam.clean_rows(docs, items).collect())     # a table between the slices
    assert clean == sorted({r.doc_id for r in docs.collect()} - {d for d, _, _ in one})


def test_slices_keep_the_passages(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    items = [(n, " ".join(word() for _ in range(n))) for n in range(10, 60, 3)]
    filler = lambda: " ".join(word() for _ in range(rng.randint(20, 200)))
    docs = docs_of(spark, [(d, " ".join(f"{filler()} {t} {filler()}" for _, t in rng.sample(items, 4))) for d in range(20)])
    rows = lambda: sorted((r.doc_id, r.item_id, r.n_passages, r.first_word, r.question_overlap, r.answer_overlap, r.overlap,
                           round(r.score, 9)) for r in decontam.find_contamination(docs, items_of(spark, items)).collect())
    one = rows()
    monkeypatch.setattr(decontam, "INDEX_WORDS", 150)
    assert len(one) == 80 and rows() == one


def plain_scores(items, passages):
    """(passage, item) -> share of the item's BM25 score, written out."""
    df = collections.Counter(w for _, words in items for w in set(words))
    mean = sum(len(w) for _, w in items) / len(items)
    out = {}
    for i, words in items:
        tf = collections.Counter(words)
        weight = {w: math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words) / mean))
                  for w, n in tf.items()}
        for p, held in enumerate(passages):
            out[p, i] = sum(v for w, v in weight.items() if w in held) / sum(weight.values())
    return dict(df), mean, out


@pytest.mark.parametrize(("vocabulary", "touched"), [(120, 1_000_000), (120, 50), (3_000, 1_000_000)])
def test_retrieval_returns_all_above_the_threshold(monkeypatch, vocabulary, touched):
    monkeypatch.setattr(decontam, "TOUCHED_POSTINGS", touched)
    rng = random.Random(2)
    word = lambda: f"w{int(vocabulary ** rng.random())}"
    items = [(i, [word() for _ in range(rng.randint(3, 60))]) for i in range(150)]
    texts = [[word() if rng.random() < 0.6 else rng.choice(items[rng.randrange(150)][1]) for _ in range(rng.randint(1, 300))]
             for _ in range(40)]
    texts += [["other"] * 30 + words + ["other"] * 9 for _, words in items[::9]]
    held = {}                                               # passages of each class, by text and first word
    longest = collections.defaultdict(int)
    for _, words in items:
        c = math.floor(math.log2(len(words)))
        longest[c] = max(longest[c], len(words))
    for c, n in longest.items():
        for k, words in enumerate(texts):
            for s in range(0, max(len(words) - n, 1), n):
                held[k, s, c] = set(words[s:s + 2 * n])
    df, mean, scores = plain_scores(items, list(held.values()))
    want = {(k, s, i): scores[p, i] for p, (k, s, c) in enumerate(held) for i, words in items
            if c == math.floor(math.log2(len(words))) and scores[p, i] >= 0.5}
    index = decontam.build_index(items, df, len(items), mean)
    docs = [np.array([index.term_ids.get(w, -1) for w in words], dtype=np.int32) for words in texts]
    got = {(k, s, index.ids[i]): v for part in index.classes for k, s, i, v in decontam.retrieve(index, part, docs)}
    assert len(want) > 20 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_items_of_all_lengths(spark):
    rng = random.Random(8)
    word = lambda: f"v{int(4_000 ** rng.random())}"
    items = [(n, [word() for _ in range(n)]) for n in (5, 6, 9, 10, 13, 31, 32, 64, 200, 511, 900, 2_000)]
    docs = [(0, " ".join(word() for _ in range(5_000)))]
    for n, words in items:
        noise = [word() for _ in range(rng.randint(0, 400))]
        docs.append((n, " ".join(noise + words + noise[::-1])))
        docs.append((10_000 + n, " ".join(noise + words[:max(len(words) * 3 // 5, 1)] + noise)))
        edit = ["changed" if k == n // 2 else w for k, w in enumerate(words)]
        docs.append((20_000 + n, " ".join(edit)))
    items = [(n, " ".join(w)) for n, w in items]
    got = found(docs_of(spark, docs), items_of(spark, items))
    assert {(n, n) for n, _ in items} <= got and got == brute(docs, items)


def test_very_long_text_and_many_copies(spark):
    rng = random.Random(9)
    item = [f"x{rng.randrange(50_000)}" for _ in range(40)]
    filler = [f"x{rng.randrange(50_000)}" for _ in range(1_000)]
    text = " ".join((filler + item) * 500)
    got = decontam.find_contamination(docs_of(spark, [(1, text), (2, " ".join(filler * 500))]),
                                      items_of(spark, [(1, " ".join(item))])).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 1)] and got[0].n_passages >= 500
