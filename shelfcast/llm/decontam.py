"""Benchmark decontamination (operator 6).

Test items are kept in an inverted index with BM25 impacts, each divided by
the item's score against itself, so a passage's score is the share of the
item's weight it holds and one threshold serves all items. Items stand in
classes by length (each class up to twice as long as the one before). For
every class a document is cut into overlapping passages, long enough that any
item of the class stands whole in one of them, and every passage is a query.

Retrieval is block-max WAND, rarest terms first, over a batch of passages at a
time. An item's commonest terms, up to ``REST`` of its weight, have no
postings: an item at the threshold must reach the rest of it by its rarer
terms alone. Postings are laid out in blocks of items, each (term, block)
entry with its largest impact. A passage goes on to a block's postings only if
the block's maxima for its terms, with the largest rest of the block, add up
to the threshold; what the postings leave possible is scored by the item's
whole term list. All items at or above the threshold are retrieved. A hit is
verified by 5-word shingles: at least 0.8 of the whole item's shingles must be
in the passage, or 0.8 of its question shingles and 0.8 of its answer shingles
(the last quarter of its words), which may then stand apart. An item of under
10 words is one part. Shingles are compared as 64-bit hashes of term numbers.

The index is collected in slices of about ``INDEX_WORDS`` item words, which
bound its terms, postings and shingles alike (arrays of under 60 bytes a word,
and one dictionary of the terms). A larger benchmark takes several slices,
with one pass over the documents for each; the BM25 statistics and the
passages are always those of all items. A batch is cut by the postings that
its passages can touch, so neither its memory nor a very long text's grows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import map_rows, materialize

K1, B = 1.2, 0.75
THRESHOLD = 0.5              # share of an item's own BM25 score
REST = 0.4                   # share of an item's weight, in its commonest terms, that has no postings
SHINGLE_WORDS = 5
OVERLAP = 0.8
ANSWER_SHARE = 0.25
BLOCK_ITEMS = 16
INDEX_WORDS = 2_000_000
BATCH_WORDS = 200_000
TOUCHED_POSTINGS = 1_000_000
SLACK = 1e-4                 # impacts of postings are single precision; whole scores are double

WORDS = re.compile(r"\w+")


def words_of(text: bytes | None) -> list[str]:
    return WORDS.findall((text or b"").decode("utf-8", "replace").lower())


def length_class(n_words: int) -> int:
    return n_words.bit_length()


def shingle_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` term numbers; runs with an unknown term (-1) are left out."""
    if len(ids) < n:
        return np.empty(0, dtype=np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    size = len(ids) - n + 1
    out, known = np.zeros(size, dtype=np.uint64), np.ones(size, dtype=bool)
    for j in range(n):
        out = out * np.uint64(0x94D049BB133111EB) + mixed[j:j + size]
        known &= ids[j:j + size] >= 0
    return out[known]


def item_shingles(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of an item and, for each, 1 if the question holds it plus 2 if the answer does.

    The answer is the last quarter of the words, at least one shingle long. An
    item too short for a whole shingle in each is one part, question and answer alike.
    """
    n = min(SHINGLE_WORDS, len(ids))
    whole = np.unique(shingle_hashes(ids, n))
    if len(ids) < 2 * SHINGLE_WORDS:
        return whole, np.full(len(whole), 3, dtype=np.uint8)
    answer = max(math.ceil(len(ids) * ANSWER_SHARE), SHINGLE_WORDS)
    part = np.isin(whole, shingle_hashes(ids[:-answer], n)) + 2 * np.isin(whole, shingle_hashes(ids[-answer:], n))
    return whole, part.astype(np.uint8)


@dataclass
class ClassIndex:
    """Items of one length class; postings are sorted by (term, item) and cut at block ends into entries."""
    longest: int                     # words of the longest item of the class, in any slice
    items: np.ndarray                # item -> its row of the index
    rest: np.ndarray                 # item -> weight of its terms without postings
    block_rest: np.ndarray
    terms: np.ndarray                # the terms with postings, ascending
    term_entries: np.ndarray         # place in terms -> its first entry; the next one's first ends it
    entry_block: np.ndarray
    entry_max: np.ndarray
    term_max: np.ndarray
    entry_postings: np.ndarray       # entry -> its first posting
    posting_item: np.ndarray
    posting_impact: np.ndarray


@dataclass
class Index:
    """Items of one slice: the terms' numbers, each item's whole term list and shingles, and the postings by class."""
    ids: list[int | None]
    term_ids: dict[str, int]
    item_terms: np.ndarray           # item -> its first term; so for shingles
    term: np.ndarray
    impact: np.ndarray
    item_shingles: np.ndarray
    shingle: np.ndarray
    part: np.ndarray
    n_words: np.ndarray
    classes: list[ClassIndex]


def build_index(items: Iterable[tuple[int | None, list[str]]], df: dict[str, int], n_items: int, mean_len: float,
                longest: dict[int, int] | None = None) -> Index:
    """Index of a slice of items, under the statistics of all items; ``longest`` by class is that of the slice if not given."""
    item_ids, texts, shingles, parts, term_ids = [], [], [], [], {}
    for i, words in items:
        ids = np.fromiter((term_ids.setdefault(w, len(term_ids)) for w in words), dtype=np.int32, count=len(words))
        whole, part = item_shingles(ids)
        item_ids.append(i)
        texts.append(ids)
        shingles.append(whole)
        parts.append(part)
    n_words = np.array([len(t) for t in texts])
    known = np.fromiter((df[t] for t in term_ids), dtype=np.float64, count=len(term_ids))
    idf = np.log(1 + (n_items - known + 0.5) / (known + 0.5))
    keys, counts = np.unique(np.repeat(np.arange(len(texts)), n_words) * len(term_ids) + np.concatenate(texts), return_counts=True)
    item, term = keys // len(term_ids), keys % len(term_ids)
    norm = K1 * (1 - B + B * n_words / mean_len)
    impact = idf[term] * counts * (K1 + 1) / (counts + norm[item])
    impact /= np.bincount(item, weights=impact)[item]

    # commonest terms first, while their weights stay within REST
    order = np.lexsort((term, -known[term], item))
    item, term, impact = item[order], term[order], impact[order]
    first = np.searchsorted(item, np.arange(len(texts) + 1))
    sums = np.concatenate([[0.0], np.cumsum(impact)])
    within = sums[1:] - sums[first[item]] <= REST
    rest = np.bincount(item, weights=np.where(within, impact, 0.0), minlength=len(texts))

    classes = np.array([length_class(int(n)) for n in n_words])
    if longest is None:
        longest = {int(c): int(n_words[classes == c].max()) for c in set(classes.tolist())}
    commonest = term[first[:-1]]
    index = Index(item_ids, term_ids, first, term.astype(np.int32), impact,
                  np.concatenate([[0], np.cumsum([len(s) for s in shingles])]), np.concatenate(shingles), np.concatenate(parts),
                  n_words, [])
    for c in sorted(set(classes.tolist())):
        # Items that share their commonest word stand together: it mostly tells the language, and tightens block maxima.
        members = np.flatnonzero(classes == c)
        members = members[np.lexsort((members, n_words[members], commonest[members]))]
        index.classes.append(_class_index(members, longest[c], item, term, impact, within, rest))
    return index


def _class_index(members: np.ndarray, longest: int, item: np.ndarray, term: np.ndarray, impact: np.ndarray,
                 within: np.ndarray, rest: np.ndarray) -> ClassIndex:
    place = np.full(len(rest), -1)
    place[members] = np.arange(len(members))
    own = (place[item] >= 0) & ~within
    at, t, v = place[item[own]], term[own], impact[own].astype(np.float32)
    order = np.lexsort((at, t))
    at, t, v = at[order], t[order], v[order]
    block = at // BLOCK_ITEMS
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (block[1:] != block[:-1])])
    entries = np.flatnonzero(new)
    terms, term_entries = np.unique(t[entries], return_index=True)
    entry_max = np.maximum.reduceat(v, entries)
    starts = np.arange(0, len(members), BLOCK_ITEMS)
    return ClassIndex(longest, members, rest[members], np.maximum.reduceat(rest[members], starts), terms.astype(np.int32),
                      np.append(term_entries, len(entries)), block[entries].astype(np.int32), entry_max,
                      np.maximum.reduceat(entry_max, term_entries), np.append(entries, len(at)).astype(np.int32),
                      at.astype(np.int32), v)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [start, end): the number of the range and the value, for every value."""
    sizes = ends - starts
    which = np.repeat(np.arange(len(starts)), sizes)
    return which, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def _sums(keys: np.ndarray, values: np.ndarray, n_keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, each key's sum, and the place of every row's key; keys below ``n_keys``."""
    if n_keys <= 4 * len(keys) + 1_000_000:
        return np.arange(n_keys), np.bincount(keys, weights=values, minlength=n_keys), keys
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, weights=values, minlength=len(distinct)), inverse


def candidates(part: ClassIndex, passage: np.ndarray, term: np.ndarray,
               threshold: float = THRESHOLD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(passages, items of the class) that may reach the threshold, some passages at a time.

    (passage, term) are distinct, in order of the passage; a term is its place in ``part.terms``.
    """
    if not len(passage):
        return
    near = threshold - SLACK
    bound = np.bincount(passage, weights=part.term_max[term])
    alive = bound[passage] >= near - part.rest.max()         # WAND: the terms' maxima must reach the threshold
    passage, term = passage[alive], term[alive]
    postings = part.entry_postings[part.term_entries]
    touched = np.cumsum(postings[term + 1] - postings[term])
    at = 0
    while at < len(passage):
        before = touched[at - 1] if at else 0
        end = int(np.searchsorted(touched, before + TOUCHED_POSTINGS, "right"))
        if end < len(passage):                                # whole passages: back to the last one's start, or to its end
            start = int(np.searchsorted(passage, passage[end]))
            end = start if start > at else int(np.searchsorted(passage, passage[at], "right"))
        yield _within(part, passage[at:end], term[at:end], near)
        at = end


def _within(part: ClassIndex, passage: np.ndarray, term: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    base, n_passages = int(passage[0]), int(passage[-1] - passage[0]) + 1
    row, entry = _ranges(part.term_entries[term], part.term_entries[term + 1])
    n_blocks = len(part.block_rest)
    _, bound, place = _sums((passage[row] - base) * n_blocks + part.entry_block[entry], part.entry_max[entry], n_passages * n_blocks)
    alive = bound[place] >= near - part.block_rest[part.entry_block[entry]]    # block-max: other postings are never touched
    row, entry = row[alive], entry[alive]
    which, posting = _ranges(part.entry_postings[entry], part.entry_postings[entry + 1])
    n_items = len(part.items)
    keys, score, _ = _sums((passage[row][which] - base) * n_items + part.posting_item[posting], part.posting_impact[posting],
                           n_passages * n_items)
    held = score > 0
    keys, score = keys[held], score[held]
    keys = keys[score >= near - part.rest[keys % n_items]]
    return keys // n_items + base, keys % n_items


def _n_passages(n_words: np.ndarray, longest: int) -> np.ndarray:
    """Windows of twice the longest item, one every ``longest`` words: any item stands whole in one of them."""
    return np.maximum(1, -(-(n_words - longest) // longest))


def retrieve(index: Index, part: ClassIndex, docs: list[np.ndarray],
             threshold: float = THRESHOLD) -> Iterator[tuple[int, int, int, float]]:
    """All (text, first word of the passage, item, score) of the class at or above the threshold; texts as term numbers."""
    sizes = np.array([len(d) for d in docs])
    own = _n_passages(sizes, part.longest)
    first = np.concatenate([[0], np.cumsum(own)])
    words = np.concatenate(docs)
    at = np.minimum(np.searchsorted(part.terms, words), len(part.terms) - 1)
    rare = np.flatnonzero(part.terms[at] == words)
    of = np.repeat(np.arange(len(docs)), sizes)[rare]
    later = (rare - (np.cumsum(sizes) - sizes)[of]) // part.longest   # a word is in the passage that starts here, and the one before
    pairs = []
    for passage in (later, later - 1):
        inside = (passage >= 0) & (passage < own[of])
        pairs.append((first[of] + passage)[inside] * len(part.terms) + at[rare][inside])
    distinct = np.unique(np.concatenate(pairs))
    for passages, items in candidates(part, distinct // len(part.terms), distinct % len(part.terms), threshold):
        held, seen = None, -1
        for p, i in zip(passages.tolist(), part.items[items].tolist()):
            k = int(np.searchsorted(first, p, "right")) - 1
            start = (p - int(first[k])) * part.longest
            if p != seen:
                held, seen = np.unique(docs[k][start:start + 2 * part.longest]), p
            own_terms = slice(index.item_terms[i], index.item_terms[i + 1])
            term = index.term[own_terms]
            score = float(index.impact[own_terms][held[np.minimum(np.searchsorted(held, term), len(held) - 1)] == term].sum())
            if score >= threshold - 1e-9:
                yield k, start, i, score


def match_texts(texts: list[bytes | None], index: Index) -> list[tuple[int, int, float, float, float, int, int, float]]:
    """(text, item id, score, question overlap, answer overlap, passages, first passage's word, overlap) per verified pair."""
    found: dict[tuple[int, int], list] = {}
    held: list[tuple[int, np.ndarray]] = []                 # text, its words as term numbers

    def flush():
        docs = [ids for _, ids in held]
        for part in index.classes:
            for k, start, i, score in retrieve(index, part, docs):
                window = docs[k][start:start + 2 * part.longest]
                here = np.unique(shingle_hashes(window, min(SHINGLE_WORDS, int(index.n_words[i]))))
                if not len(here):
                    continue
                own = slice(index.item_shingles[i], index.item_shingles[i + 1])
                whole, parts = index.shingle[own], index.part[own]
                kept = here[np.minimum(np.searchsorted(here, whole), len(here) - 1)] == whole
                w = float(kept.mean())
                q, a = (float(kept[(parts & side) > 0].mean()) for side in (1, 2))
                if w >= OVERLAP or (q >= OVERLAP and a >= OVERLAP):
                    hit = found.setdefault((held[k][0], i), [0.0, 0.0, 0.0, 0, start, 0.0])
                    hit[:] = [max(hit[0], score), max(hit[1], q), max(hit[2], a), hit[3] + 1, min(hit[4], start), max(hit[5], w)]

    n_held = 0
    for k, text in enumerate(texts):
        words = words_of(text)
        ids = np.fromiter(map(index.term_ids.get, words, repeat(-1)), dtype=np.int32, count=len(words))
        if not (ids >= 0).any():
            continue
        held.append((k, ids))
        n_held += len(ids)
        if n_held >= BATCH_WORDS:
            flush()
            held.clear()
            n_held = 0
    if held:
        flush()
    return [(k, index.ids[i], *v) for (k, i), v in found.items()]


_TERMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("words", T.ArrayType(T.StringType()))])
_HITS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType()),
    T.StructField("n_passages", T.LongType()), T.StructField("first_word", T.LongType()), T.StructField("overlap", T.DoubleType())])


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, n_passages, first_word, overlap) per document and item it holds.

    ``overlap`` is that of the whole item.

    Documents without a verified item have no row. Items and documents without
    words (null, empty) match nothing; an item with a null item_id is matched
    and reported under null. Repeated rows of ``docs`` are reported as often;
    items that repeat an item_id are items of their own. Extra columns are
    ignored; without items, or without documents, the result is empty.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], _HITS)
    for index in _indexes(benchmark):
        out = out.unionByName(_scan(texts, index))
    return out


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The index of each slice of the items; none without items."""
    read = map_rows(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text"), _TERMS,
                    lambda rows: ((i, w) for i, w in ((i, words_of(t)) for i, t in rows) if w))
    items = materialize(read, "items")
    size = F.size("words")
    lengths = items.groupBy(F.length(F.bin(size.cast("bigint"))).alias("class")).agg(
        F.count("*").alias("n"), F.sum(size).alias("words"), F.max(size).alias("longest")).collect()    # a row per power of two
    n_items, n_words = sum(r["n"] for r in lengths), sum(r["words"] for r in lengths)
    longest = {r["class"]: r["longest"] for r in lengths}
    df = items.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n_slices = max(1, math.ceil(n_words / INDEX_WORDS))
    for k in range(n_slices if n_items else 0):
        part = items.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(n_slices)) == k)
        terms = part.select(F.explode("words").alias("term")).distinct()
        counts = {r["term"]: r["df"] for r in df.join(terms, "term", "left_semi").collect()}   # of one slice's text
        rows = part.select("item_id", F.concat_ws(" ", "words").alias("text")).collect()        # one slice's text
        if rows:
            yield build_index(((r["item_id"], r["text"].split(" ")) for r in rows), counts, n_items, n_words / n_items, longest)


def _scan(texts: DataFrame, index: Index) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(index)

    def scan(rows):
        hits = match_texts([t for _, t in rows], shared.value)
        return [(rows[k][0], *hit) for k, *hit in hits]

    return map_rows(texts, _HITS, scan)


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, each decided by its own text, whatever its doc_id; columns stay as they are.

    What one slice of the items leaves is written before the next slice reads
    it, so a task holds one index at a time.
    """
    for k, index in enumerate(_indexes(benchmark)):
        docs = _without(materialize(docs, "clean") if k else docs, index)
    return docs


def _without(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            held = {k for k, *_ in match_texts(batch.column(at).cast(pa.large_binary()).to_pylist(), shared.value)}
            yield batch.filter(pa.array([k not in held for k in range(batch.num_rows)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
