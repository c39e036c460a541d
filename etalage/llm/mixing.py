"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of equal blocks of ``block_words`` words. A source's target gives
its number of blocks (highest quotients ``target / (2 s + 1)``); the blocks of a
source are dealt to its shards in the same way by the shards' sizes, so every
shard has an integer quota. Inside a shard the documents stand in seeded order
and the shard's words, read round and round, are cut into blocks; the quota's
blocks are taken from a seeded start.

Scale: documents are dealt to shards by a seeded hash of id and text, and the number
of shards follows the total size, so no source (hot or not) meets in one task: the
only window over documents runs within (source, shard). The shards' quotients are
ranked over all sources at once, in key ranges, so no task sees all shards of a source
either. What the driver sees is one row per source.

Defined cases: a null text has size 0; a null source is a source of its own, the
last; sources of size 0 get nothing; a mix of nothing is empty; documents that
repeat are separate rows of the mix; the caller's columns travel in one struct, so
their names clash with none of the names used here.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.operators.rank import running_total

from .storage import fresh_name, store

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_REPEATS = 2
BLOCK_WORDS = 32
SHARD_WORDS = 1_000_000
SEED = 7


def n_words(text: str) -> Column:
    """Words between spaces and control white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float = MAX_REPEATS) -> list[float]:
    """Share ``share`` words by weight; no target above ``most`` times its size.

    What a full source cannot take is shared again by weight among the others.
    """
    target, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = float(share)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                target[i] = left * weights[i] / weight
            break
        for i in full:
            target[i] = float(most * sizes[i])
        left -= sum(target[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return target


def apportion(claims: Sequence[float], seats: int) -> list[int]:
    """Sainte-Lague: seats by highest quotients claim / (2 s + 1); ties to the earlier claim."""
    total = sum(claims)
    if total <= 0 or seats <= 0:
        return [0] * len(claims)
    # every quotient above this divisor is certainly among the highest
    divisor = total / max(seats - len(claims) / 2 - 1, 0.25)
    won = [max(0, math.floor(c / divisor + 0.5) - 1) for c in claims]
    heap = [(-c / (2 * w + 1), i) for i, (c, w) in enumerate(zip(claims, won, strict=True)) if c > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(won)):
        _, i = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-claims[i] / (2 * won[i] + 1), i))
    return won


def shard_quotas(shards: DataFrame) -> DataFrame:
    """Blocks of each (src, shard) from the source's blocks, by highest quotients.

    ``shards`` has src, shard, words, source_words, blocks. With m
    shards and Q blocks, a shard's seats lie within words / source_words *
    (Q -+ m / 2), give or take one; only the quotients between are ranked, about
    three for each shard.
    """
    part = F.col("words") / F.col("source_words")
    low = F.greatest(F.lit(0), F.floor(part * (F.col("blocks") - F.col("n_shards") / 2)) - 1)
    high = F.ceil(part * (F.col("blocks") + F.col("n_shards") / 2)) + 1
    shards = store(shards, "supply")  # read twice; it costs a pass over the documents
    sources = shards.groupBy("src").agg(F.count(F.lit(1)).alias("n_shards"))
    ranged = store(shards.join(sources, "src").withColumns({"low": low.cast("long"), "high": high.cast("long")}), "shards")
    seats = store(ranged.select("src", "shard", "words", F.explode(F.sequence(F.col("low"), F.col("high"))).alias("seat")).withColumn(
        "less", -F.col("words") / (2 * F.col("seat") + 1)), "seats")
    # places over all sources; a source's own begin at its first
    placed = running_total(seats, ["src", "less", "shard", "seat"], "place")
    first = placed.groupBy("src").agg(F.min("place").alias("first"))
    spare = ranged.groupBy("src").agg((F.first("blocks") - F.sum("low")).alias("spare"))
    won = placed.join(first, "src").join(spare, "src").where("place - first < spare").groupBy("src", "shard").agg(F.count(F.lit(1)).alias("more"))
    return ranged.join(won, ["src", "shard"], "left").select(
        "src", "shard", (F.col("low") + F.coalesce("more", F.lit(0))).alias("quota"), "words")


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share_percent: float = SHARE_PERCENT,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``keep`` columns, then a struct ``mix`` (``mix_`` if there is such a column...)
    with doc_id, size, source_size, target and taken (words that the mix takes, repeats counted).

    ``weights`` go to the sources in code point order, null last, repeating.
    """
    spark = docs.sparkSession
    name = fresh_name(keep, "mix")
    own = F.struct(*keep) if keep else F.lit(None)
    sized = docs.select(own.alias("own"), F.col(doc_id).alias("_mix_id"), F.col(source).alias("_mix_src"), n_words(text).alias("_mix_size"),
                        F.xxhash64(text).alias("_mix_tie"))
    totals = {r["_mix_src"]: (r["n"], r["k"]) for r in sized.groupBy("_mix_src").agg(
        F.sum("_mix_size").alias("n"), F.count(F.lit(1)).alias("k")).collect()}
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None] * (None in totals)
    sizes = [totals[s][0] for s in names]
    total = sum(sizes)
    target = source_targets(sizes, [weights[i % len(weights)] for i in range(len(names))], total * share_percent / 100)
    blocks = apportion(target, round(sum(target) / block_words))
    plan = spark.createDataFrame(
        [(s is None, s or "", n, float(t), b, max(1, -(-n // shard_words)))
         for s, n, t, b in zip(names, sizes, target, blocks, strict=True)],
        "src_null boolean, src_name string, source_words long, target double, blocks long, shards long",
    ).withColumn("src", F.struct("src_null", "src_name")).drop("src_null", "src_name")

    # the seeded order of a document does not depend on how Spark deals the rows
    src = F.struct(F.col("_mix_src").isNull().alias("src_null"), F.coalesce("_mix_src", F.lit("")).alias("src_name"))
    dealt = sized.withColumns({
        "src": src,
        "_mix_key": F.xxhash64(F.lit(seed), "_mix_id", "_mix_size", "_mix_tie"),
    }).join(F.broadcast(plan), "src").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed + 1), "_mix_id", "_mix_key"), "shards"))
    supply = dealt.groupBy("src", "shard").agg(
        F.sum("_mix_size").alias("words"), *[F.first(c).alias(c) for c in ("source_words", "blocks")]).where("words > 0")
    quotas = shard_quotas(supply)

    before = F.sum("_mix_size").over(
        Window.partitionBy("src", "shard").orderBy("_mix_key", "_mix_id", "_mix_tie", "_mix_size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_mix_size")
    placed = dealt.withColumn("before", before).join(quotas, ["src", "shard"], "left")
    # the quota's words start at a seeded block and run round the shard
    wanted = F.least(F.col("quota") * block_words, MAX_REPEATS * F.col("words"))
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "src", "shard"), F.greatest(F.floor(F.col("words") / block_words), F.lit(1))) * block_words
    rounds = F.floor(wanted / F.col("words"))
    rest = wanted - rounds * F.col("words")

    def overlap(low: Column, high: Column) -> Column:
        here, there = F.col("before"), F.col("before") + F.col("_mix_size")
        return F.greatest(F.least(there, high) - F.greatest(here, low), F.lit(0))

    end = start + rest
    taken = (rounds * F.col("_mix_size") + overlap(start, F.least(end, F.col("words")))
             + overlap(F.lit(0), end - F.col("words")))
    mix = F.struct(
        F.col("_mix_id").alias("doc_id"), F.col("_mix_size").alias("size"),
        F.coalesce("source_words", F.lit(0)).cast("long").alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
    )
    return placed.select(*[F.col("own")[c].alias(c) for c in keep], mix.alias(name))
