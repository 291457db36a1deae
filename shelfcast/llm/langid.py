"""Language identification by word-first backoff (operator 1).

A known word is scored by its log frequency in each language. An unseen word
backs off to its character 5-grams, then 4-grams, down to single letters,
until some gram is known, and takes the mean of the known grams' log
frequencies. A text's scores are the sums over its words, every word counted.

The model is fitted on a hash-chosen sample of about ``max_train_docs``
labelled documents and keeps every word and gram of it, so its size is that of
the sample whatever the corpus; prediction reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import hash_fraction, held_out, map_rows, materialize

MAX_TRAIN_DOCS = 12_000
LONGEST_GRAM = 5
SMOOTHING = 0.5
CACHE_WORDS = 300_000
UNKNOWN = "und"

WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: bytes | None) -> list[str]:
    """Lower-cased runs of letters; empty if the text holds no letter at all."""
    found = WORDS.findall((text or b"").decode("utf-8", "replace").lower())
    return found if any(any(map(str.isalpha, w)) for w in found) else []


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Table(dict):
    """Keys with the place of their log frequencies in ``rows`` (one column a language)."""

    def __init__(self, places=(), rows: np.ndarray | None = None):
        super().__init__(places)
        self.rows = rows

    def __reduce__(self):
        return Table, (dict(self), self.rows)

    @classmethod
    def of(cls, vectors: dict[str, list[float]], n_langs: int) -> "Table":
        return vectors if isinstance(vectors, cls) else cls(
            zip(vectors, range(len(vectors))), np.array(list(vectors.values()), dtype=float).reshape(len(vectors), n_langs))


@dataclass
class Model:
    langs: list[str]
    prior: list[float]                       # log share of the training documents
    words: dict[str, list[float]]            # log frequency per language (`fit` makes a `Table`)
    grams: dict[str, list[float]]


def _counted(counts: DataFrame, key: str, langs: list[str]) -> Table:
    """All keys of ``counts (lang, key, n)`` with smoothed log frequencies, in code point order."""
    per_lang = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}")
                for i, lang in enumerate(langs)]
    if not langs:
        return Table((), np.zeros((0, 0)))
    found = counts.groupBy(key).agg(*per_lang).toArrow()
    keys = found.column(0).to_pylist()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    table = np.stack([found.column(1 + i).to_numpy() for i in range(len(langs))], axis=1)[order] + SMOOTHING
    return Table(((keys[j], i) for i, j in enumerate(order)), np.log(table / table.sum(0)))


def fit(docs: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Learn from the documents outside the held-out fold that have a lang."""
    labelled = docs.filter(F.col("lang").isNotNull() & ~held_out()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), "text")
    share = max_train_docs / max(labelled.count(), 1)
    sample = labelled.filter(hash_fraction("doc_id", F.xxhash64("text"), seed=1) < share).select("lang", "text")

    def count(rows):
        counts: dict[str, Counter] = {}
        docs_of = Counter(lang for lang, _ in rows)
        for lang, text in rows:
            counts.setdefault(lang, Counter()).update(words_of(text))
        for lang, n in docs_of.items():
            yield lang.decode(), None, n                    # a null word counts documents
        for lang, words in counts.items():
            for word, n in words.items():
                yield lang.decode(), word, n

    counted = map_rows(sample, T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()),
                                             T.StructField("n", T.LongType())]), count)
    words = materialize(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    priors = {r.lang: r.n for r in words.filter("word IS NULL").orderBy("lang").collect()}    # one row a language
    langs = sorted(priors)
    words = words.filter("word IS NOT NULL")
    marked = words.select("lang", "n", F.concat(F.lit("^"), "word", F.lit("$")).alias("w"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST_GRAM), F.length("w")))
    grams = (marked.select("lang", "n", "w", F.explode(sizes).alias("size"))
             .select("lang", "n", "w", "size", F.explode(F.sequence(F.lit(1), F.length("w") - F.col("size") + 1)).alias("at"))
             .select("lang", "n", F.substring("w", F.col("at"), F.col("size")).alias("gram"))
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    total = sum(priors.values())
    return Model(langs, [math.log(priors[lang] / total) for lang in langs],
                 _counted(words, "word", langs), _counted(grams, "gram", langs))


class Scorer:
    """Scores texts with a model; remembers the backoff of at most ``CACHE_WORDS`` unseen words.

    Every known or remembered word is a row of one matrix, so a text is its
    word counts times the rows they point at.
    """

    def __init__(self, model: Model):
        self.model = model
        self.words, self.grams = (Table.of(t, len(model.langs)) for t in (model.words, model.grams))
        self.n_known = len(self.words)
        self.rows = np.zeros((self.n_known + CACHE_WORDS + 1, max(len(model.langs), 1)))
        if self.n_known:
            self.rows[:self.n_known] = self.words.rows
        self.index = dict(self.words)                                # then the remembered words

    def _backoff(self, word: str) -> list[float]:
        grams = self.grams.get
        for n in range(min(LONGEST_GRAM, len(word) + 2), 0, -1):
            found = [v for v in map(grams, grams_of(word, n)) if v is not None]
            if found:
                return (self.grams.rows[found].sum(axis=0) / len(found)).tolist()
        return [0.0] * len(self.model.langs)

    def scores(self, counts: Counter) -> np.ndarray:
        """Log scores of the words, each as often as it is counted."""
        at = list(map(self.index.get, counts))
        extra = 0.0
        for place, word in [(k, w) for k, (i, w) in enumerate(zip(at, counts)) if i is None]:
            vector = self._backoff(word)
            if len(word) <= 32 and len(self.index) < self.n_known + CACHE_WORDS:
                at[place] = self.index[word] = len(self.index)
                self.rows[at[place]] = vector
            else:
                at[place] = -1                                    # a row of zeros
                extra = extra + counts[word] * np.array(vector)
        total = np.fromiter(counts.values(), dtype=float, count=len(counts)) @ self.rows[at] + extra
        if len(self.index) >= self.n_known + CACHE_WORDS:         # remember anew
            self.index = dict(self.words)
        return total

    def predict(self, text: bytes | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.langs:
            return UNKNOWN, 0.0
        scores = self.scores(Counter(words)) + np.array(self.model.prior)
        best = int(np.argmax(scores))
        return self.model.langs[best], float(1.0 / np.exp(scores - scores[best]).sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest learned language and its posterior.

    ``und`` with score 0 for a null text, a text without letters, or a model
    that learned nothing. Ties go to the language first in code point order.
    Extra columns are ignored; repeated rows are predicted as often.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)        # the words and grams of the bounded sample
    scorers: list[Scorer] = []

    def run(rows):
        if not scorers:
            scorers.append(Scorer(shared.value))
        for doc_id, text in rows:
            yield (doc_id, *scorers[0].predict(text))

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType())]), run)
