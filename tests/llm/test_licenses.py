import re

from llm_cases import SF, docs_of

from shelfcast.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels)


EDGE = [(1, None), (2, ""), (3, "CC BY cc-by, cc  by"), (4, "All rights reserved. all\nrights\treserved"), (5, "ccby cc éby"),
        (6, "General Public\x00License"), (7, "the gnu general public license version 3"), (None, "cc by"), (7, "cc by"),
        (8, "cc by " * 50_000), (9, "é all rights reservedé"), (10, "cc by 4.0 ccc by")]


def got(df):
    return [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df]


def test_base_columns_match_brute_force(spark):
    out = licenses.scan_licenses(docs_of(spark, EDGE, extra=("labels", "score", "n_words"))).collect()
    assert sorted(got(out), key=repr) == sorted((brute_base(t) for _, t in EDGE), key=repr)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = licenses.scan_licenses(docs).collect()
    assert [(r.doc_id, g) for r, g in zip(out, got(out))] == [(r.doc_id, brute_base(texts[r.doc_id])) for r in out]
    assert all(set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 for r in out)


def test_templates_need_alignment_and_key_phrases(spark):
    filler = "some other words stand here " * 5
    rows = [
        (1, filler + "Licensed under the Apache License, Version 2.0 (the License)"), (2, "Released under the MIT License."),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
        (4, "Licensed under CC BY-NC 4.0."), (5, "This work is licensed under the GNU General Public License, version 3."),
        (6, "the apache helicopter has a license plate version"), (7, "MIT " + filler + "license"), (8, filler),
        (9, "All rights reserved."), (10, "License Apache the under licensed 0 2 version")]
    out = {r.doc_id: r for r in licenses.scan_licenses(docs_of(spark, rows)).collect()}
    assert {i: out[i].labels for i in out} == {
        1: ["apache-2.0"], 2: ["mit"], 3: ["mit"], 4: ["cc-by", "cc-by-nc-4.0"], 5: ["gpl", "gpl-3.0"], 6: [], 7: [], 8: [],
        9: ["reserved"], 10: []}
    assert out[8].score == 0 and out[1].score > 0.9


def test_repeated_phrases_take_linear_time(spark):
    import time

    for unit, n in (("cc by ", 1_000_000), ("apache license under the version ", 200_000), ("general public license ", 250_000)):
        start = time.perf_counter()
        r = licenses.scan_licenses(docs_of(spark, [(1, unit * n)])).first()
        assert r.n_words == n * len(unit.split()) and r.n_base == (0 if "apache" in unit else n)
        assert time.perf_counter() - start < 60


def brute_labels(text, weights):
    """Labels by trying every template at every place of the text, from the rule: half of the anchors' weight within the slack, and all key phrases."""
    words = licenses.words_of((text or "").encode())
    found = set(brute_base(text)[4])
    for (label, notice, keys), anchors in zip(licenses.TEMPLATES, weights):
        template = notice.encode().split()
        for offset in range(-len(template), len(words) + 1):
            near = {(w, p) for p, w in enumerate(template) if w in anchors
                    for d in range(-licenses.SLACK // 2, licenses.SLACK // 2 + 1) if 0 <= offset + p + d < len(words) and words[offset + p + d] == w}
            if sum(anchors[w] for w in {w for w, _ in near}) >= 0.5 * sum(anchors.values()):
                region = words[max(offset - licenses.SLACK, 0):offset + len(template) + licenses.SLACK + 1]
                text_region = " " + " ".join(w.decode() for w in region) + " "
                if all(f" {k} " in text_region for k in keys):
                    found.add(label)
    return sorted(found)


def test_labels_match_templates_tried_at_every_place(spark):
    notices = [notice for _, notice, _ in licenses.TEMPLATES]
    texts = [t for n in notices for t in (f"x y z {n} and more", f"{n.replace(' ', ' q ', 1)} tail", " ".join(reversed(n.split())),
                                          " ".join(n.split()[::2]), f"{n} {notices[0]}")]
    docs = docs_of(spark, list(enumerate(texts)))
    _, weights = licenses.build_index(*licenses.document_frequencies(docs))
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [brute_labels(t, weights) for t in texts]
    assert sum(map(len, got.values())) > len(notices)


def test_empty_table(spark):
    assert licenses.scan_licenses(docs_of(spark, [])).count() == 0
