"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source gives words up to a target. Its documents are ordered by a hash and cut into blocks
by the leading bits of it, as many as its size asks for; whole passes over the source and a last partial one make its quota of
blocks. A binary tree over the output shards splits the quotas: at every node the left shards draw
their blocks from those of the node without replacement, so every shard has its exact number of blocks, every
block goes to one shard, and the sources of a shard vary as a random draw's do. A shard draws its blocks from
each source's in permuted order and shuffles its rows by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm._frames import Workspace

WEIGHTS = (3.0, 1.0, 2.0)  # of the sources in order, repeating
SHARE = 1.5  # words of the mix by words of all documents
MOST_REPEATS = 2  # a source's target by its size
BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 22
SEED = 7
HASH_BITS = 62
LEVELS = (12, 24)  # leading bits of the hash whose ranges narrow down the end of a source's last pass
URNS = 1 << 12  # the tree splits the blocks of so many groups of sources, the driver's rows of the plan
MAX_BLOCKS = 1 << 28  # numpy draws from fewer than 10**9; blocks grow for a mix of more

ADDED = ["size", "source_size", "target", "shards"]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(work: Workspace, sources: DataFrame, share: float = SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """Sources (``size, weight`` and more) with ``target``, the words to take: shared by weight, none above ``most`` times the size.

    What a source cannot take is shared again among those below their bound, until none is above. Only a
    round's sums reach the driver. A source once at its bound stays there, as the share of a weight never falls.
    """
    bound, full, level, before = most * F.col("size"), F.lit(False), None, None
    while True:
        sums = sources.agg(F.sum("size").alias("size"), F.sum(F.when(full, bound)).alias("given"),
                           F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count_if(full).alias("n")).first()
        rest = share * (sums["size"] or 0) - (sums["given"] or 0)
        if sums["n"] == before or not sums["weight"]:
            break
        before, level = sums["n"], rest * F.col("weight") / F.lit(float(sums["weight"]))
        full = full | (level > bound)
    goal = bound if level is None else F.when(full, bound).otherwise(level)
    return work.stage(sources.withColumn("target", goal.cast("double")), "targets")


def order_hash() -> Column:
    """Place of a document on the scale by which its source is ordered."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "text"), 64 - HASH_BITS)


def _numbered(work: Workspace, totals: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Totals with ``number``, the place of a source in their order by code point with null last, and its ``weight``."""
    rows = work.stage(totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("slice", F.spark_partition_id()), "totals")
    slices = rows.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))
    before = slices.select("slice", (F.sum("rows").over(Window.orderBy("slice")) - F.col("rows")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("slice").orderBy(F.col("source").asc_nulls_last())) - 1
    number = F.col("before") + F.col("inside")
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    return rows.withColumn("inside", inside).join(before, "slice").select("source", "size", number.alias("number"), weight.alias("weight"))


def _cuts(work: Workspace, sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``number, cut``: where on the hash scale the last pass of a source ends.

    Ranges of more and more bits narrow the end down; rows are sorted only within the last, of which a source has 2**24.
    """
    rest = (F.col("target") - F.floor(F.col("target") / F.col("size")) * F.col("size")).alias("more")
    edges = work.stage(sources.where("size > 0").select("number", F.lit(0).cast("bigint").alias("bucket"), rest).where("more > 0"), "rests")
    rows, known = sized.where("size > 0"), 0
    by_bucket = Window.partitionBy("number").orderBy("bucket")
    starts = edges.select("number", F.lit(0).cast("bigint").alias("cut"))
    for bits in LEVELS:
        inside = rows.withColumn("bucket", F.shiftright("place", HASH_BITS - known)).join(edges, ["number", "bucket"], "left_semi")
        sums = (inside.withColumn("bucket", F.shiftright("place", HASH_BITS - bits)).groupBy("number", "bucket").agg(F.sum("size").alias("size")))
        upto = sums.withColumn("upto", F.sum("size").over(by_bucket)).join(edges.select("number", "more"), "number")
        edges = work.stage(upto.where("upto > more and upto - size <= more").select(
            "number", "bucket", (F.col("more") - F.col("upto") + F.col("size")).alias("more")), "edges")
        known = bits
        rows = work.stage(inside.withColumn("bucket", F.shiftright("place", HASH_BITS - bits)).join(edges, ["number", "bucket"], "left_semi"), "inside") \
            .select("number", "place", "size")
        starts = edges.select("number", F.shiftleft(F.col("bucket"), HASH_BITS - bits).alias("cut"))
    last = (rows.groupBy("number", "place").agg(F.sum("size").alias("size")).join(edges.select("number", "more"), "number")
            .withColumn("upto", F.sum("size").over(Window.partitionBy("number").orderBy("place"))))
    taken = last.where(F.col("upto") - F.col("size") / 2 <= F.col("more")).groupBy("number").agg((F.max("place") + 1).alias("cut"))
    return starts.unionByName(taken).groupBy("number").agg(F.max("cut").alias("cut"))


def _plan(work: Workspace, sized: DataFrame) -> DataFrame:
    """One row per source: ``source, number, source_size, target, passes, bits, cut, urn, first, blocks``.

    Its blocks lie at ``first`` in those of its urn: sources share URNS by number, so up to so many sources have one each.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"))
    sources = targets(work, _numbered(work, totals, WEIGHTS))
    goal = sources.agg(F.sum("target")).first()[0] or 0
    width = BLOCK_WORDS
    while goal / width > MAX_BLOCKS:
        width *= 2
    known = sources.select("source", "number")
    numbered = work.stage(sized.alias("row").join(known.alias("known"), F.col("row.source").eqNullSafe(F.col("known.source")))
                          .select("number", "place", "size"), "sizes")
    cuts = work.stage(_cuts(work, numbered, sources), "cuts")
    wide = F.expr(f"(size - 1) div {width}")
    bits = F.when(wide > 0, F.least(F.length(F.bin(wide)), F.lit(HASH_BITS))).otherwise(0)
    passes = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("int")
    blocks = F.expr(f"case when size > 0 then shiftleft(cast(passes as bigint), bits) "
                    f"+ shiftright(cut + shiftleft(1L, {HASH_BITS} - bits) - 1, {HASH_BITS} - bits) else 0 end")
    plan = (sources.join(cuts, "number", "left").withColumns({"bits": bits, "passes": passes, "cut": F.coalesce("cut", F.lit(0))})
            .withColumns({"blocks": blocks, "urn": (F.col("number") % URNS).cast("int")}))
    first = F.sum("blocks").over(Window.partitionBy("urn").orderBy("number")) - F.col("blocks")
    return work.stage(plan.select("source", "number", F.col("size").alias("source_size"), "target", "passes", "bits", "cut",
                                  "urn", first.alias("first"), "blocks"), "plan")


def shard_quotas(blocks: list[int], shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every source for one shard, by its way down the tree.

    The draws of a node depend on the seed and the node alone, so all shards see the same splits.
    """
    low, high = 0, shards
    first, count = np.zeros(len(blocks), np.int64), np.array(blocks, np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        total = int(count.sum())
        left = total * (middle - low) // (high - low)
        draw = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(count, left, method="marginals")
        if shard < middle:
            high, count = middle, draw
        else:
            low, first, count = middle, first + draw, count - draw
    return first, count


@lru_cache(maxsize=URNS)
def _step(blocks: int, seed: int) -> int:
    step = int(np.random.default_rng([seed, blocks]).integers(1, blocks + 1))
    while math.gcd(step, blocks) != 1:
        step = step % blocks + 1
    return step


def permuted(position: int, blocks: int, seed: int) -> int:
    """Block at a position of a source's permuted order."""
    return (position * _step(blocks, seed) + seed) % blocks


def _draws(work: Workspace, plan: DataFrame) -> DataFrame:
    """``urn, block, shard`` for every block of every urn."""
    urns = plan.groupBy("urn").agg(F.sum("blocks").alias("blocks"), F.sum("target").alias("target")).collect()  # URNS rows at most
    blocks = [0] * URNS
    for row in urns:
        blocks[row["urn"]] = row["blocks"]
    while blocks and not blocks[-1]:
        blocks.pop()
    shards = max(1, math.ceil(math.fsum(row["target"] for row in urns) / SHARD_WORDS))

    def drawn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                first, count = shard_quotas(blocks, shards, int(shard))
                for urn in map(int, np.flatnonzero(count)):
                    at = range(int(first[urn]), int(first[urn] + count[urn]))
                    yield pd.DataFrame({"urn": urn, "block": [permuted(i, blocks[urn], SEED + urn) for i in at], "shard": int(shard)})
    return work.stage(work.spark.range(shards).mapInPandas(drawn, "urn int, block bigint, shard int"), "draws")


def planned_mix(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``size, source_size, target`` and ``shards``, the shard of each time the mix takes it.

    ``docs`` has ``doc_id, text, source``; further columns are kept, but none may be called as an added one.
    ``size`` counts the words of the whole text, 0 for null; ``target`` is the words the mix takes from the
    row's source; a null source is one of its own, last in order. Rows alike in id and text share
    their place, so they are taken together. A source without words gives none. No rows give none. There may be any number
    of sources. Texts are read whole, however long.
    """
    work = Workspace(docs.sparkSession, "mix")
    marked = docs.withColumns({"size": words(F.col("text")), "_place": order_hash()})
    sized = work.stage(marked.select("source", "size", F.col("_place").alias("place")), "sizes")
    plan = _plan(work, sized)
    draws = _draws(work, plan)
    known = plan.select(F.struct("source", "source_size", "target", "passes", "bits", "cut", "urn", "first").alias("_plan"))
    rows = marked.join(known, F.col("source").eqNullSafe(F.col("_plan.source")))
    for turn in range(MOST_REPEATS):
        block = F.expr(f"_plan.first + shiftleft({turn}L, _plan.bits) + shiftright(_place, {HASH_BITS} - _plan.bits)")
        taken = (F.col("size") > 0) & ((F.lit(turn) < F.col("_plan.passes")) | (F.lit(turn) == F.col("_plan.passes")) & (F.col("_place") < F.col("_plan.cut")))
        drawn = draws.select(F.col("urn").alias("_urn"), F.col("block").alias("_drawn"), F.col("shard").alias(f"_shard_{turn}"))
        rows = rows.withColumn("_block", F.when(taken, block)).join(
            drawn, (F.col("_plan.urn") == F.col("_urn")) & (F.col("_block") == F.col("_drawn")), "left").drop("_urn", "_drawn", "_block")
    shards = F.array_compact(F.array(*(f"_shard_{turn}" for turn in range(MOST_REPEATS))))
    return rows.select(*docs.columns, "size", F.col("_plan.source_size").alias("source_size"), F.col("_plan.target").alias("target"), shards.alias("shards"))


def mixed(docs: DataFrame, shard: str | None = None) -> DataFrame:
    """The rows of the mix, each as often as it is taken, in their shards and shuffled within them.

    Columns are those of ``docs``, with the shard's number under the name ``shard`` if given. See ``planned_mix``.
    """
    rows = planned_mix(docs).select(*docs.columns, F.posexplode("shards").alias("_turn", "_shard"))
    rows = rows.repartition("_shard").sortWithinPartitions("_shard", F.xxhash64(F.lit(SEED + 1), "doc_id", "_turn"))
    return rows.select(*docs.columns, *([F.col("_shard").alias(shard)] if shard else []))


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document its size, its source's size and target, and the words of it that the mix takes."""
    return planned_mix(docs.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))
