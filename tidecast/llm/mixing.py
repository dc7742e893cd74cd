"""Mixing sources to target weights: temperature mixing.

A source's share of all tokens is raised to an exponent a between 0 and 1
and the results are normalised to weights: 1 keeps the shares, 0 makes all sources equal.
The exponent is bisected: it is the smallest, hence the flattest mix, in
which no source has to be repeated more than ``max_epochs`` times within the
budget; or, if ``entropy`` is given, the largest whose weights reach that
share of the greatest possible entropy, raised again where repetition asks for it.
Each step evaluates 64 exponents in one aggregation over the table of
sources, so the number of sources may be large.

The weights are realised by block permutations.  Documents are dealt to
blocks of their source by a hash; each pass over a source takes its blocks in a
seeded order of their own.  A source whose tokens due are ``e`` times its
own gets ``floor(e)`` whole passes and, in one more, the blocks in order up
to the rest.  Within the block where the rest ends, documents are taken in
a seeded order as long as they begin before its end, so each source ends less
than a document away from its tokens due.  Cumulated sums run over the blocks of a
source, of which there are at most ``BLOCKS``, and over the documents of one block of
it, never over a whole source.

Cases: a null source is a source of its own; a null or blank text has no
tokens and is taken in every whole pass, and in the last one with its block; null ids
and repeated rows each count as a row; sources without tokens have the
weight 0 and one copy of each row; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import text_of, written

#: Most blocks of a source; a block holds at least BLOCK_TOKENS tokens on average.
BLOCKS, BLOCK_TOKENS = 4096, 10_000
GRID = 64
#: Exponents are found to this step, coarser than any difference that the order of a sum makes.
STEP = 1e-6


def token_count(text: str = "text") -> Column:
    """Words of the whole text."""
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _evaluate(sources: DataFrame, total: float, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy of the weights, largest weight / share) for each exponent, from
    sums over the source table: with z the sum of share^a, the entropy is
    ln z - a / z * (sum of share^a ln share)."""
    each = F.explode(F.array(*map(F.lit, exponents))).alias("a")
    power = F.pow("share", "a")
    sums = (
        sources.select((F.col("tokens") / F.lit(total)).alias("share"), each)
        .groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("l"), F.max(power / F.col("share")).alias("m"))
    )
    by = {r.a: (math.log(r.z) - r.a / r.z * r.l, r.m / r.z) for r in sums.collect()}  # a row for each exponent
    return [by[a] for a in exponents]


def _bisect(sources: DataFrame, total: float, good, smallest: bool) -> float:
    """The smallest (or largest) exponent in [0, 1] for which ``good`` holds;
    ``good`` changes once from 0 to 1.  1 (or 0) if it never holds."""
    low, high = 0, round(1 / STEP)
    while high - low > 1:
        at = sorted({*np.linspace(low, high, GRID + 1).round().astype(int).tolist()})
        ok = [good(*v) for v in _evaluate(sources, total, [x * STEP for x in at])]
        if smallest:
            first = next((i for i, x in enumerate(ok) if x), len(at) - 1)
        else:
            first = next((i for i, x in enumerate(ok) if not x), len(at))
        if smallest and first == 0 or not smallest and first == len(at):
            return at[0 if smallest else -1] * STEP
        if not smallest and first == 0:
            return low * STEP
        low, high = at[first - 1], at[first]
    return (high if smallest else low) * STEP


def exponent(sources: DataFrame, total: float, budget: float, max_epochs: float, entropy: float | None) -> float:
    """sources: (source, tokens), tokens above 0."""
    def within(_, ratio):
        return ratio * budget / total <= max_epochs * (1 + 1e-9)

    least = _bisect(sources, total, within, smallest=True)
    if entropy is None:
        return least
    most = math.log(max(sources.count(), 1))
    return max(least, _bisect(sources, total, lambda h, _: h >= entropy * most * (1 - 1e-9), smallest=False))


def mix(
    docs: DataFrame,
    budget: int | None = None,
    max_epochs: float = 4.0,
    entropy: float | None = None,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: doc_id, source, n_tokens, weight, block, copies.

    copies: how often the document is drawn; 0 where the budget ends before
    it.  budget: tokens of the mix; as many as the documents have if None.
    max_epochs must allow the budget: at least budget / tokens."""
    named = F.col(source).cast("string")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), named.alias("source"), token_count(text).alias("n_tokens"),
        F.coalesce(F.concat(F.lit("="), named), F.lit("null")).alias("key"),  # also joins where the source is null
    )
    rows = written(rows)
    every = written(rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens")))
    total = every.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    if total and budget > max_epochs * total:
        raise ValueError(f"a budget of {budget} tokens needs over {max_epochs} passes over {total}")
    some = every.where("tokens > 0")
    a = exponent(some, float(total), float(budget), max_epochs, entropy) if total else 1.0
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    mass = some.agg(F.sum(F.pow(share, F.lit(a)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(a)) / F.lit(mass)).otherwise(0.0)
    blocks = F.least(F.greatest(F.floor(F.col("tokens") / BLOCK_TOKENS), F.lit(1)), F.lit(BLOCKS))
    plan = every.select("key", "tokens", F.round(weight, 9).alias("weight"), blocks.cast("int").alias("blocks"))
    due = F.round(F.col("weight") * F.lit(float(budget))).cast("long")
    plan = plan.withColumn("due", due)
    plan = plan.withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("due") / F.col("tokens"))).otherwise(1).cast("long"))
    plan = written(plan.withColumn("rest", F.when(F.col("tokens") > 0, F.col("due") - F.col("passes") * F.col("tokens")).otherwise(0)))
    # the table of sources is the small side: Spark broadcasts it by its size or shuffles
    spot = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "key"), F.col("blocks")).cast("int")
    placed = rows.join(plan, "key", "left").withColumn("block", spot)
    by_block = placed.groupBy("key", "block").agg(F.sum("n_tokens").alias("size"), F.first("passes").alias("pass"), F.first("rest").alias("due"))
    turn = F.xxhash64(F.lit(seed), "key", "block", "pass")  # the order of the blocks in the last pass
    by_block = by_block.withColumn("upto", F.sum("size").over(_order(["key"], turn, F.col("block"))))
    state = F.when(F.col("due") <= 0, None).when(F.col("upto") <= F.col("due"), "whole").when(F.col("upto") - F.col("size") < F.col("due"), "cut")
    by_block = by_block.select("key", "block", state.alias("state"), (F.col("due") - F.col("upto") + F.col("size")).alias("room"))
    drawn = written(placed.join(by_block.where("state is not null"), ["key", "block"], "left"))
    cut = drawn.where("state = 'cut'")
    before = F.sum("n_tokens").over(_order(["key", "block"], F.xxhash64(F.lit(seed + 1), "doc_id", "passes"), F.col("doc_id"))) - F.col("n_tokens")
    cut = cut.withColumn("before", before)
    last = F.when(F.col("state") == "whole", 1).otherwise(0)
    columns = ["doc_id", "source", "n_tokens", "weight", "block"]
    return (
        drawn.where("state is null or state <> 'cut'").select(*columns, (F.col("passes") + last).alias("copies"))
        .unionByName(cut.select(*columns, (F.col("passes") + (F.col("before") < F.col("room")).cast("int")).alias("copies")))
    )


def _order(keys: list[str], *by: Column):
    return Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
