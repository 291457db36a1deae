"""Mixing sources to target weights (operator 5).

Temperature mixing: source s with token share p_s gets the weight
p_s^t / sum(p^t). The exponent t is found by repeated section, the largest one
that meets the target entropy, but none that would repeat a source more often
than the limit allows. Every round evaluates a grid of exponents in one
aggregate over the sources (64 points: six bisection steps at once), so the
number of sources is free to grow.

A source is then read in epochs. Each epoch is a permutation of its documents:
a hash of (epoch, document) deals them into blocks and orders each block. Whole
epochs take every document; the last, partial one takes the permutation up to
its token budget: block totals find the block where the budget ends, and only
that block is looked at row by row. So no source, however large, is sorted or
summed in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import materialize

ENTROPY_SHARE = 0.95         # of the entropy of equal weights
MAX_REPETITION = 1.5
BLOCK_ROWS = 4096
GRID = 64
ROUNDS = 5
SEED = 5


@dataclass(frozen=True)
class Target:
    """What the weights have to meet.

    ``budget_tokens`` None takes the smallest budget that reads every source at
    least once, so mixing adds repetitions and drops nothing.
    """
    entropy_share: float = ENTROPY_SHARE
    max_repetition: float = MAX_REPETITION
    budget_tokens: int | None = None


def _draw(epoch: Column) -> Column:
    """A repeatable number in [0, 1) per document and epoch."""
    return F.pmod(F.xxhash64(F.lit(SEED), epoch, "doc_id", "text_hash"), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _source_key(col: str = "source") -> Column:
    """Null is a source of its own, apart from ''."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _source_key().alias("key"), "source",
                       F.regexp_count(text, F.lit(r"\S+")).cast("bigint").alias("n_tokens"),
                       F.xxhash64(text).alias("text_hash"))


def fit_exponent(sources: DataFrame, target: Target) -> float:
    """The exponent for ``sources (key, tokens, p)`` with positive p."""
    whole = sources.agg(F.count("*").alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi"),
                        F.sum("tokens").alias("tokens")).first()
    if whole["n"] < 2:
        return 1.0
    goal = target.entropy_share * math.log(whole["n"])

    def meets(grid: list[float]) -> tuple[list[bool], list[bool]]:
        row = sources.agg(*[F.sum(F.pow("p", F.lit(t))).alias(f"z{i}") for i, t in enumerate(grid)],
                          *[F.sum(F.pow("p", F.lit(t)) * F.log("p")).alias(f"l{i}") for i, t in enumerate(grid)]).first()
        entropy = [math.log(row[f"z{i}"]) - t * row[f"l{i}"] / row[f"z{i}"] for i, t in enumerate(grid)]
        budget = [target.budget_tokens if target.budget_tokens is not None
                  else whole["tokens"] * row[f"z{i}"] * whole["hi"] ** (1 - t) for i, t in enumerate(grid)]
        most = [whole["lo"] ** (t - 1) * b / (row[f"z{i}"] * whole["tokens"]) for i, (t, b) in enumerate(zip(grid, budget))]
        return [h >= goal - 1e-12 for h in entropy], [m <= target.max_repetition + 1e-12 for m in most]

    # Entropy and repetition both fall as the exponent rises from 0 (equal weights) to 1 (token shares).
    even = (0.0, 1.0)                       # entropy is met at the lower end
    calm = (0.0, 1.0)                       # repetition is met at the upper end
    for _ in range(ROUNDS):
        e_grid = [even[0] + (even[1] - even[0]) * i / (GRID - 1) for i in range(GRID)]
        c_grid = [calm[0] + (calm[1] - calm[0]) * i / (GRID - 1) for i in range(GRID)]
        e_met, _ = meets(e_grid)
        _, c_met = meets(c_grid)
        k = max((i for i, ok in enumerate(e_met) if ok), default=0)
        even = (e_grid[k], e_grid[min(k + 1, GRID - 1)])
        k = min((i for i, ok in enumerate(c_met) if ok), default=GRID - 1)
        calm = (c_grid[max(k - 1, 0)], c_grid[k])
    return max(even[0], calm[1])


def plan(docs: DataFrame, target: Target = Target()) -> tuple[DataFrame, DataFrame]:
    """(narrow documents, sources).

    ``sources``: key, tokens, weight, epochs, whole (epochs read entirely),
    blocks (per epoch), cut (the partial epoch takes draws up to it).
    A source without tokens costs nothing and is read once.
    """
    narrow = materialize(_narrow(docs), "mix-docs")
    counted = materialize(narrow.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows")),
                          "mix-sources")
    total = counted.agg(F.sum("tokens")).first()[0] or 0
    shares = counted.filter("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))
    t = fit_exponent(shares, target)
    powers = shares.agg(F.sum(F.pow("p", F.lit(t))).alias("z"), F.max("p").alias("hi")).first()
    z = powers["z"] or 1.0
    budget = float(target.budget_tokens if target.budget_tokens is not None
                   else total * z * (powers["hi"] or 1.0) ** (1 - t))
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(t)) / F.lit(z)).otherwise(0.0)
    weighted = counted.select("key", "tokens", weight.alias("weight"),
                              F.ceil(F.col("n_rows") / F.lit(BLOCK_ROWS)).cast("bigint").alias("blocks"))
    epochs = F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.lit(budget) / F.col("tokens"), 9)).otherwise(1.0)
    sources = weighted.withColumn("epochs", epochs).withColumn("whole", F.floor("epochs").cast("bigint"))

    # Where the partial epoch of each source ends.
    partial = (narrow.join(sources.filter("epochs > whole"), "key")
               .withColumn("u", _draw(F.col("whole"))).withColumn("block", F.floor(F.col("u") * F.col("blocks")))
               .withColumn("budget", (F.col("epochs") - F.col("whole")) * F.col("tokens")))
    sums = partial.groupBy("key", "block").agg(F.sum("n_tokens").alias("n"), F.first("budget").alias("budget"))
    upto = Window.partitionBy("key").orderBy("block")                     # rows of a source / BLOCK_ROWS
    last = (sums.withColumn("through", F.sum("n").over(upto)).filter("through > budget")
            .groupBy("key").agg(F.min_by(F.struct("block", (F.col("through") - F.col("n")).alias("before")), "block").alias("b"))
            .select("key", "b.block", "b.before"))
    inside = Window.partitionBy("key").orderBy("u")                       # one block of each source; equal draws together
    taken = (partial.select("key", "block", "u", "n_tokens", "budget").join(last, ["key", "block"])
             .withColumn("through", F.col("before") + F.sum("n_tokens").over(inside)).filter("through <= budget")
             .groupBy("key").agg(F.max("u").alias("u")))
    ends = last.join(taken, "key", "left").join(sources.select("key", "blocks"), "key").select(
        "key", F.coalesce("u", F.col("block") / F.col("blocks") - F.lit(2.0 ** -53)).alias("cut"))
    cut = F.when(F.col("epochs") > F.col("whole"), F.coalesce("cut", F.lit(1.0))).otherwise(F.lit(-1.0))
    return narrow, materialize(sources.join(ends, "key", "left").withColumn("cut", cut), "mix-plan")


def _copies() -> Column:
    return F.col("whole") + F.when(_draw(F.col("whole")) <= F.col("cut"), 1).otherwise(0)


def mix(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """One row per copy: doc_id, source, n_tokens, weight, epochs, epoch, block, position.

    ``position`` orders a block from 0. Null sources are one source; null and
    empty texts have no tokens; repeated rows are drawn alike and each counts.
    Extra columns are ignored, and an empty table gives an empty result.
    """
    narrow, sources = plan(docs, target)
    copies = (narrow.join(sources, "key").withColumn("n", _copies()).filter("n > 0")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1))))
    placed = copies.withColumn("u", _draw(F.col("epoch"))).withColumn("block", F.floor(F.col("u") * F.col("blocks")).cast("bigint"))
    in_block = Window.partitionBy("key", "epoch", "block").orderBy("u")
    return placed.select("doc_id", "source", "n_tokens", "weight", "epochs", "epoch", "block",
                         (F.row_number().over(in_block) - 1).cast("bigint").alias("position"))


def repeat_documents(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """``docs`` with every row as often as its source's weight asks, in the order of `mix`; the columns stay as they are.

    A copy stands at the share of its source's epochs that its draw has
    reached, so every stretch of the result holds the sources by their weights
    and each source's copies epoch by epoch, block by block, in drawn order.
    """
    _, sources = plan(docs, target)
    text = F.coalesce("_row.text", F.lit(""))
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.col("_row.doc_id").cast("bigint").alias("doc_id"), _source_key("_row.source").alias("key"),
        F.xxhash64(text).alias("text_hash"))
    drawn = rows.join(sources.select("key", "whole", "cut", "epochs"), "key").withColumn("n", _copies()).filter("n > 0")
    copies = drawn.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    return copies.orderBy((F.col("epoch") + _draw(F.col("epoch"))) / F.col("epochs"), "text_hash", "doc_id").select("_row.*")
