"""Quality classifier (operator 7).

A document becomes a vector of statistics of its whole text. Random Fourier
features of the standardized statistics approximate a Gaussian kernel, and a
ridge regression on them is fitted from normal equations that every partition
sums for itself. Isotonic regression on a fold of its own turns the raw score
into the share of good documents.

The fit reads a hash-chosen sample of about ``max_train_docs`` labelled
documents, so what reaches the driver (a moment row, one matrix of
``n_features + 1`` squared per partition, and the raw scores of the
calibration fold) is bounded whatever the corpus. Scoring reads every text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import hash_fraction, held_out, map_rows, materialize

MAX_TRAIN_DOCS = 24_000
N_FEATURES = 256
RIDGE = 1e-3
SEED = 7
FIT_PARTITIONS = 8
KEEP_AT = 0.7

_CLASSES = {
    "digit": b"0123456789",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "space": b" \t\n\x0b\x0c\r",
    "stop": b".,;:!?",
    "quote": b"'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
}
_TRAILING = re.compile(rb"[#$%&*+/<=>@\\^_`|~]{2,}")
STATISTICS = ("log_bytes", "log_words", "word_len", "word_len_sd", "distinct", "top_word", "next_same",
              *_CLASSES, "high", "log_lines", "line_len", "line_repeats", "line_stops", "symbol_runs",
              "lone_marks", "short_words", "long_words", "deflate", "sentence_words")


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one whole text; an empty text has zeros throughout."""
    text = text or b""
    n = len(text)
    words = text.split()
    if not words:
        return [float(np.log1p(n))] + [0.0] * (len(STATISTICS) - 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    counts = Counter(words)
    lines = text.split(b"\n")
    line_set = set(lines)
    shares = [(n - len(text.translate(None, chars))) / n for chars in _CLASSES.values()]
    high = np.count_nonzero(np.frombuffer(text, dtype=np.uint8) >= 128) / n
    ends = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines)
    sentences = 1 + sum(text.count(c) for c in (b". ", b"! ", b"? ", b".\n"))
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), float(lengths.mean()), float(lengths.std()),
        len(counts) / len(words) ** 0.85, max(counts.values()) / len(words),
        sum(map(bytes.__eq__, words, words[1:])) / len(words),
        *shares, high,
        float(np.log1p(len(lines))), float(np.log1p(n / len(lines))), 1 - len(line_set) / len(lines),
        ends / len(lines), len(_TRAILING.findall(text)) / len(words),
        sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum()) / len(words),
        float((lengths <= 3).mean()), float((lengths >= 12).mean()),
        len(zlib.compress(text, 1)) / n, float(np.log1p(len(words) / sentences)),
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray           # frequencies of the Fourier features
    phases: np.ndarray
    beta: np.ndarray              # ridge solution, the intercept last
    knots: np.ndarray             # raw scores and their calibrated values
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([f, np.ones((len(f), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean x and mean y of each pool, both ascending."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []                     # weight, sum of x, sum of y
    for a, b in zip(x[order], y[order]):
        pools.append([1.0, float(a), float(b)])
        while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
            w, sx, sy = pools.pop()
            pools[-1] = [pools[-1][0] + w, pools[-1][1] + sx, pools[-1][2] + sy]
    p = np.array(pools)
    return p[:, 1] / p[:, 0], p[:, 2] / p[:, 0]


_STATS = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("calibrate", T.BooleanType()),
                       T.StructField("x", T.ArrayType(T.DoubleType()))])


def fit(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS,
        n_features: int = N_FEATURES) -> Model | float:
    """Fit on labelled documents outside the held-out fold.

    Without both labels among them there is nothing to separate: the result is
    the share of label 1 (1.0 without any labelled document), which `predict`
    gives to every text. A doc_id that is labelled twice counts once, with its
    largest label; null doc_ids and labels are ignored.
    """
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
              .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
              .agg(F.max(F.col("quality").cast("double")).alias("y")))
    share = max_train_docs / max(marked.count(), 1)
    chosen = marked.filter(hash_fraction("doc_id", seed=SEED) < share)
    fold = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(4)) == 3
    # `chosen` has about max_train_docs rows of two numbers whatever the labels' size: broadcast, so no text is shuffled
    texts = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
             .select("y", fold.alias("calibrate"), "text"))
    stats = materialize(map_rows(texts, _STATS, lambda rows: ((y, c, statistics(t)) for y, c, t in rows)), "quality-stats")
    d = len(STATISTICS)
    moments = stats.agg(F.count("*").alias("n"), F.avg("y").alias("good"), F.min("y").alias("lo"), F.max("y").alias("hi"),
                        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)],
                        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    if not moments["n"] or moments["lo"] == moments["hi"]:
        return 1.0 if not moments["n"] else float(moments["good"])
    rng = np.random.default_rng(SEED)
    scale = np.array([moments[f"s{i}"] for i in range(d)])
    model = Model(np.array([moments[f"m{i}"] for i in range(d)]), np.where(scale > 1e-9, scale, 1.0),
                  rng.standard_normal((d, n_features)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, n_features),
                  np.zeros(n_features + 1), np.array([0.0]), np.array([0.0]))

    partial = T.StructType([T.StructField("normal", T.BinaryType())])

    def normal_equations(batches):
        import pyarrow as pa

        total = np.zeros((n_features + 1, n_features + 2))
        for batch in batches:
            rows = batch.to_pydict()
            if rows["y"]:
                f = model.features(np.array(rows["x"]))
                total += f.T @ np.hstack([f, np.array(rows["y"])[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["normal"])

    def solve(rows: DataFrame) -> np.ndarray:
        sums = [np.frombuffer(bytes(r.normal)).reshape(n_features + 1, n_features + 2)
                for r in rows.select("y", "x").coalesce(FIT_PARTITIONS).mapInArrow(normal_equations, partial).collect()]
        total = np.sum(sums, axis=0)
        n = max(total[-1, n_features], 1.0)
        penalty = RIDGE * n * np.eye(n_features + 1)
        penalty[-1, -1] = 1e-9 * n
        return np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    def fold_scores() -> tuple[np.ndarray, np.ndarray]:
        scored = map_rows(stats.filter("calibrate").select("y", "x"), T.StructType([
            T.StructField("raw", T.DoubleType()), T.StructField("y", T.DoubleType())]),
            lambda rows: zip(model.raw(np.array([x for _, x in rows])).tolist(), [y for y, _ in rows])).collect()
        return np.array([r.raw for r in scored]), np.array([r.y for r in scored])

    # Calibrate on documents the ridge has not seen.
    model.beta = solve(stats.filter("NOT calibrate"))
    raw, y = fold_scores()
    if len(y) < 20 or y.min() == y.max():               # too few for a fold of their own
        model.beta = solve(stats)
        every = stats.collect()
        raw, y = model.raw(np.array([r.x for r in every])), np.array([r.y for r in every])
    model.knots, model.values = isotonic(raw, y)
    return model


def predict(docs: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id, score) of every row: the calibrated probability of label 1.

    Null and empty texts have the statistics of an empty text and a score like
    any other. Extra columns are ignored; repeated rows are scored as often.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)          # a fixed number of arrays

    def run(rows):
        if not rows:
            return
        m = shared.value
        if isinstance(m, float):
            yield from ((d, m) for d, _ in rows)
            return
        scores = m.score(np.array([statistics(t) for _, t in rows]))
        yield from zip([d for d, _ in rows], scores.tolist())

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())]), run)


def accepted(docs: DataFrame, model: Model | float, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that score at least ``keep_at``, in one pass and without a join; columns stay as they are."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for batch in batches:
            if isinstance(m, float):
                good = [m >= keep_at] * batch.num_rows
            elif batch.num_rows:
                texts = batch.column(at).cast(pa.binary()).to_pylist()
                good = (m.score(np.array([statistics(t) for t in texts])) >= keep_at).tolist()
            else:
                good = []
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
