"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent between 0 and 1 and the results are
normalised: 1 keeps the shares, 0 makes all sources equal. The exponent is the largest whose
weights reach the target entropy, a fraction of the largest possible; if some source would
then be repeated more often than the limit allows, the smallest that keeps the limit. Both
are found by halving, ten halvings a pass over the table of sources.

The weights become token budgets, split into blocks of equal composition. Every source is read
in a random permutation, a new one each epoch, until its budget is spent, and what falls into
its k-th part belongs to block k. Permutations are orders of hashes, so a source's part is a
range of hashes and a document learns its blocks from a table with one row per source; no
document moves. Running token sums come from hash buckets, so a source with a third of all
rows is summed by many tasks.

Tokens are words. A null source is a source of its own. Null and empty texts have no token and
go where their hash falls; a source without any token is left out, or with ``empty_sources``
read once. A source whose budget covers it is read whole, texts without tokens too. Exact repeats of a row share
one place and are counted together. No input column but id, text and source is read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import packed, settled, words

TARGET_ENTROPY = 0.95
MAX_REPEAT = 2.0
BLOCKS = 64
SEED = 17
# Hash ranges in which running sums are taken apart, for each source and epoch.
BUCKET_BITS = 12
# A plan of at most so many sources is sent to all tasks; a longer one is joined by shuffle.
SMALL_PLAN = 10_000
_HALVINGS = 10


@dataclass(frozen=True)
class Weights:
    """``sources`` has ``source, tokens, weight, budget``; ``exponent`` made the weights."""

    sources: DataFrame
    exponent: float


def _measures(shares: DataFrame, exponents: list[float], budget: float | None) -> dict[float, tuple[float, float]]:
    """Entropy and largest repetition of the weights that each exponent gives."""
    power = F.pow("share", "tau")
    found = (
        shares.select("share", "tokens", F.explode(F.array(*[F.lit(t) for t in exponents])).alias("tau"))
        .groupBy("tau")
        .agg(
            F.sum(power).alias("z"),
            F.sum(power * F.ln("share")).alias("zl"),
            F.max(power / F.col("share")).alias("most"),
            F.min(power / F.col("share")).alias("least"),
            F.sum("tokens").alias("tokens"),
        )
        .collect()
    )
    return {
        r.tau: (
            log(r.z) - r.tau * r.zl / r.z,
            r.most / r.least if budget is None else budget / r.tokens * r.most / r.z,
        )
        for r in found
    }


def _bisect(good, low: float, high: float, passes: int) -> float:
    """The end of the stretch of exponents from ``low`` for which ``good`` holds."""
    n = 1 << _HALVINGS
    for _ in range(passes):
        grid = [low + (high - low) * i / n for i in range(1, n)]
        held = good(grid)
        k = 0
        while k < len(grid) and held[grid[k]]:
            k += 1
        low, high = ([low, *grid][k], [*grid, high][k])
    return low


def weigh(
    shares: DataFrame,
    target_entropy: float = TARGET_ENTROPY,
    max_repeat: float = MAX_REPEAT,
    budget: float | None = None,
    passes: int = 3,
) -> Weights:
    """Weights and token budgets for ``source, tokens``.

    Without a ``budget`` the total is the least at which every source is read once in full.
    """
    filled = shares.where("tokens > 0")
    total = filled.agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).first()
    if not total.n:
        none = filled.withColumn("weight", F.lit(0.0)).withColumn("budget", F.lit(0.0))
        return Weights(none, 1.0)
    shared = filled.withColumn("share", F.col("tokens") / total.tokens)
    goal = target_entropy * log(total.n) - 1e-12

    def entropy_held(grid):
        return {t: m[0] >= goal for t, m in _measures(shared, grid, budget).items()}

    def repeat_held(grid):
        # Counted from above: 1 - t, as repetition grows when the exponent falls.
        found = _measures(shared, [1 - t for t in grid], budget)
        return {t: found[1 - t][1] <= max_repeat + 1e-12 for t in grid}

    ends = _measures(shared, [0.0, 1.0], budget)
    exponent = 1.0 if ends[1.0][0] >= goal else _bisect(entropy_held, 0.0, 1.0, passes)
    if _measures(shared, [exponent], budget)[exponent][1] > max_repeat + 1e-12:
        exponent = 0.0 if ends[0.0][1] <= max_repeat else 1 - _bisect(repeat_held, 0.0, 1.0, passes)
    power = F.pow("share", F.lit(exponent))
    z = shared.agg(F.sum(power).alias("z"), F.max(F.col("share") / power).alias("cover")).first()
    whole = total.tokens * z.cover * z.z if budget is None else budget
    weighed = shared.withColumn("weight", power / z.z).withColumn("budget", F.col("weight") * whole)
    return Weights(weighed.drop("share"), exponent)




def _plan(narrow: DataFrame, weights: Weights, blocks: int, bucket_bits: int, seed: int) -> DataFrame:
    """``source, parts``: for each epoch and block the hash from which it begins.

    Block number ``blocks`` stands for what is beyond the budget.
    """
    sources = weights.sources.select(
        F.col("source").alias("_s"), "tokens", "budget", F.ceil(F.col("budget") / F.col("tokens") - 1e-9).alias("epochs")
    )
    sources = F.broadcast(sources) if sources.count() <= SMALL_PLAN else sources
    epoch = F.explode(F.sequence(F.lit(0), F.col("epochs").cast("int") - 1)).alias("epoch")
    turns = narrow.join(sources, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "tokens", "budget", "n", "id", "key", epoch
    )
    placed = (
        turns.withColumn("place", F.xxhash64(F.lit(seed), F.col("epoch"), F.col("id"), F.col("key")))
        .groupBy("source", "epoch", "place")
        .agg(F.sum("n").alias("n"), F.first("tokens").alias("tokens"), F.first("budget").alias("budget"))
        .withColumn("bucket", F.shiftright("place", 64 - bucket_bits))
    )
    placed = settled(placed)
    in_bucket = Window.partitionBy("source", "epoch", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # At most 2 ** bucket_bits rows for a source and epoch.
    earlier = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy("source", "epoch", "bucket")
        .agg(F.sum("n").alias("_n"))
        .select(
            F.col("source").alias("_s"), F.col("epoch").alias("_e"), F.col("bucket").alias("_b"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    spent = (
        placed.withColumn("_own", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
        .join(
            before,
            F.col("source").eqNullSafe(F.col("_s")) & (F.col("epoch") == F.col("_e")) & (F.col("bucket") == F.col("_b")),
        )
        .withColumn("spent", F.col("epoch") * F.col("tokens") + F.col("_before") + F.col("_own"))
    )
    block = F.least(F.floor(F.col("spent") * blocks / F.col("budget") + 1e-9), F.lit(blocks)).cast("int")
    # A text without tokens behind the last token has spent all of a budget that just covers its source.
    whole = (F.col("epoch") == 0) & (F.col("budget") >= F.col("tokens") * (1 - 1e-9))
    starts = (
        spent.withColumn("block", F.when(whole, F.least(block, F.lit(blocks - 1))).otherwise(block))
        .groupBy("source", "epoch", "block")
        .agg(F.min("place").alias("start"))
    )
    # At most blocks + epochs entries for a source.
    part = F.struct("epoch", "block", "start")
    return starts.groupBy("source").agg(F.array_sort(F.collect_list(part)).alias("parts"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    target_entropy: float = TARGET_ENTROPY,
    max_repeat: float = MAX_REPEAT,
    budget: float | None = None,
    blocks: int = BLOCKS,
    bucket_bits: int = BUCKET_BITS,
    seed: int = SEED,
    empty_sources: bool = False,
) -> DataFrame:
    """``row, epoch, block, place``: a row for each time that a document is read.

    Sorted by ``block`` and ``place`` the rows are the mixed data.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = settled(
        docs.select(
            F.col(source_col).cast("string").alias("source"),
            F.col(id_col).alias("id"),
            F.xxhash64(text).alias("key"),
            F.size(words(text)).cast("long").alias("n"),
        )
    )
    shares = settled(narrow.groupBy("source").agg(F.sum("n").alias("tokens")))
    weights = weigh(shares, target_entropy, max_repeat, budget)
    plan = _plan(narrow, weights, blocks, bucket_bits, seed)
    if empty_sources:
        # Nothing to weigh: one epoch, cut into blocks by equal ranges of hashes.
        step = (1 << 64) // blocks
        even = [F.struct(F.lit(0).alias("epoch"), F.lit(k).alias("block"), F.lit(k * step - (1 << 63)).cast("long").alias("start")) for k in range(blocks)]
        plan = plan.unionByName(shares.where("tokens = 0").select("source", F.array(*even).alias("parts")))
    plan = settled(plan).select(F.col("source").alias("_s"), "parts")
    plan = F.broadcast(plan) if plan.count() <= SMALL_PLAN else plan
    keyed = docs.select(
        packed(docs).alias("row"),
        F.col(source_col).cast("string").alias("_source"),
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_key"),
    )
    epochs = F.array_distinct(F.col("parts.epoch"))
    turns = keyed.join(plan, F.col("_source").eqNullSafe(F.col("_s"))).select(
        "row", "_id", "_key", "parts", F.explode(epochs).alias("epoch")
    )
    placed = turns.withColumn("place", F.xxhash64(F.lit(seed), F.col("epoch"), F.col("_id"), F.col("_key")))
    reached = F.filter("parts", lambda p: (p["epoch"] == F.col("epoch")) & (p["start"] <= F.col("place")))
    return (
        placed.withColumn("block", F.array_max(F.transform(reached, lambda p: p["block"])))
        .where(F.col("block") < blocks)
        .select("row", "epoch", "block", "place")
    )


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The documents as often as the mix reads them, those of sources without tokens once."""
    return mix(docs, **{"empty_sources": True, **how}).select("row.*")
