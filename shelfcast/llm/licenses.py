"""License scans by a positional rare-token index (operator 2).

The templates are short licence notices. Each template's ``ANCHORS`` highest-IDF
words (document frequencies counted over the whole corpus) are indexed by
position. A file looks up the anchors it holds; postings that agree on the
relative position (file position minus template position, within ``SLACK``
words) make a template a candidate, which counts when its mandatory key
phrases stand where the alignment puts the template.

Base labels are independent of the index: they name every phrase of
``BASE_PHRASES`` found.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import map_rows

ANCHORS = 4
SLACK = 3

# The contract's phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public licence notices, as (label, notice, mandatory key phrases).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction",
     ("permission is hereby granted free of charge", "without restriction")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license", "version 3")),
    ("gpl-3.0", "gnu general public license as published by the free software foundation either version 3 of the license",
     ("general public license", "version 3")),
    ("gpl-2.0", "gnu general public license as published by the free software foundation either version 2 of the license",
     ("general public license", "version 2")),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "gnu lesser general public license as published by the free software foundation",
     ("lesser general public license",)),
    ("agpl-3.0", "gnu affero general public license as published by the free software foundation",
     ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd", "licensed under the bsd 3 clause license", ("bsd 3 clause license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ("permission to use copy modify and", "with or without fee")),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc", "4 0")),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa", "4 0")),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
    ("cc0-1.0", "creative commons cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software", "public domain")),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    ("reserved", "all rights reserved", ("all rights reserved",)),
)

WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: bytes | None) -> list[bytes]:
    return WORDS.findall((text or b"").lower())


def phrase_starts(joined: bytes, phrase: bytes) -> list[int]:
    """Word positions where ``phrase`` stands in ``joined`` (words between single blanks, one blank at either end)."""
    needle = b" " + phrase + b" "
    out, word, counted = [], 0, 0
    at = joined.find(needle)
    while at >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        out.append(word)
        at = joined.find(needle, at + 1)
    return out


def vocabulary() -> frozenset[bytes]:
    return frozenset(w for _, notice, _ in TEMPLATES for w in notice.encode().split())


def document_frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those that hold each licence word; the words are a fixed list."""
    wanted = vocabulary()

    def count(rows):
        counts = Counter(w for (text,) in rows for w in wanted.intersection(words_of(text)))
        counts[b""] = len(rows)
        yield from ((w.decode(), n) for w, n in counts.items())

    rows = map_rows(docs.select("text"), T.StructType([T.StructField("word", T.StringType()),
                                                       T.StructField("n", T.LongType())]), count)
    n = {r["word"].encode(): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return n.pop(b"", 0), n


def build_index(n_docs: int, df: dict[bytes, int]) -> tuple[dict, list]:
    """Postings word -> [(template, position)] of each template's rarest words, and the templates' weights."""
    postings, weights = defaultdict(list), []
    for t, (_, notice, _) in enumerate(TEMPLATES):
        words = notice.encode().split()
        idf = {w: math.log(1 + (n_docs + 1) / (df.get(w, 0) + 0.5)) for w in words}
        anchors = sorted(idf, key=lambda w: (-idf[w], w))[:ANCHORS]
        for p, w in enumerate(words):
            if w in anchors:
                postings[w].append((t, p))
        weights.append({w: idf[w] for w in anchors})
    return dict(postings), weights


def _templates_at(words: list[bytes], joined: bytes, postings: dict, weights: list) -> dict[str, float]:
    """Labels whose templates align with the file and pass their key phrases, with the anchors' weighted share."""
    aligned: dict[tuple[int, int], set] = defaultdict(set)
    for pos, word in enumerate(words):
        for t, p in postings.get(word, ()):
            for shifted in {(pos - p) // (SLACK + 1), (pos - p + SLACK // 2 + 1) // (SLACK + 1)}:
                aligned[t, shifted].add((word, pos - p))
    labels: dict[str, float] = {}
    phrases: dict[str, list[int]] = {}
    for (t, _), hits in aligned.items():
        held = {w for w, _ in hits}
        share = sum(weights[t][w] for w in held) / sum(weights[t].values())
        label, notice, keys = TEMPLATES[t]
        if share < 0.5 or share <= labels.get(label, 0.0):
            continue
        low, high = min(o for _, o in hits) - SLACK, max(o for _, o in hits) + SLACK + len(notice.split())
        for key in keys:
            if key not in phrases:
                phrases[key] = phrase_starts(joined, key.encode())
            first = bisect.bisect_left(phrases[key], low)                  # starts ascend
            if first == len(phrases[key]) or phrases[key][first] + len(key.split()) > high:
                break
        else:
            labels[label] = share
    return labels


_OUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("score", T.DoubleType())])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``labels`` and ``base_labels`` are sorted arrays. ``score`` is 0 without a
    label, 0.5 for a base phrase alone, and 0.5 plus half the weighted share of
    anchors found for the best template. A null text is empty. Extra columns
    are ignored; repeated rows are scanned as often.
    """
    postings, weights = build_index(*document_frequencies(docs))
    base = {p.encode(): label for p, label in BASE_PHRASES.items()}

    def scan(rows):
        for doc_id, text in rows:
            words = words_of(text)
            joined = b" " + b" ".join(words) + b" "
            found = {label: phrase_starts(joined, phrase) for phrase, label in base.items()}
            starts = [s for at in found.values() for s in at]
            base_labels = sorted(label for label, at in found.items() if at)
            own = _templates_at(words, joined, postings, weights) if not postings.keys().isdisjoint(words) else {}
            score = 0.5 + 0.5 * max(own.values()) if own else 0.5 if base_labels else 0.0
            yield (doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
                   base_labels, sorted({*base_labels, *own}), min(score, 1.0))

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), _OUT, scan)
