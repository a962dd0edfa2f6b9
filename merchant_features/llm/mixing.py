"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents are cut into blocks by a hash of the document, so that
a block is a random sample of its source and a hot source has as many blocks as
its size asks for. A source's blocks stand in a permuted order; its target in
words gives its quota of block draws: every block once per full pass, then the
head of the order, and of the last block the documents up to the target.

The quotas are distributed over the output shards by a tree: a node halves its
shards and draws, by the multivariate hypergeometric distribution, how many of
each source's block draws go left. Leaves take consecutive draws of each
source's order, so the shards' blocks are disjoint, sources keep their shares in
every shard up to chance, and the counts add up exactly. A shard's documents are
ordered by a hash of seed, document and pass: a local shuffle.

Everything is a function of the rows and the seed; reruns agree. The driver
holds one row per source (the weights are given per source) and the tree's
counts, source by shard.

A source has ``MOST_BLOCKS`` blocks at most: beyond that many times
``BLOCK_WORDS`` words its blocks grow, which the tree does not mind.

Defined cases: null text has size 0. A document of size 0 is never taken. Null
is a source of its own, after all others. Rows of one id are separate documents
that are taken alike if their texts are equal. An empty table gives an empty mix.
Columns that an earlier mix has added are replaced, so a mix can be mixed again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchant_features.llm.frames import row_columns, row_struct, words_of
from merchant_features.sources.storage import materialize

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_PASSES = 2
BLOCK_WORDS = 20_000
MOST_BLOCKS = 8192
SHARDS = 64
SEED = 17
MIX_COLUMNS = ("mix_shard", "mix_pass", "mix_order")


@dataclass(frozen=True)
class Source:
    """``rank`` orders sources by code point, null last."""

    rank: int
    name: str | None
    size: int
    target: float
    blocks: int


def water_fill(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut off is shared again."""
    caps = [float(most * s) for s in sizes]
    targets = [0.0] * len(sizes)
    # a source stops at the level cap / weight: taken in that order, the stopped ones are a prefix
    order = sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i])
    left, weight = float(total), float(sum(weights))
    for n, i in enumerate(order):
        if left * weights[i] / weight < caps[i]:
            for k in order[n:]:
                targets[k] = left * weights[k] / weight
            break
        targets[i] = caps[i]
        left, weight = left - caps[i], weight - weights[i]
    return targets


def splitting_tree(quotas: list[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """counts[source, shard]: the quotas partitioned exactly, each shard with (nearly) the same number of draws."""
    counts = np.zeros((len(quotas), shards), np.int64)

    def split(node: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            counts[:, low] = node
            return
        middle = (low + high) // 2
        take = int(node.sum()) * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(node, take, method="marginals")
        split(left, low, middle)
        split(node - left, middle, high)

    if quotas:
        split(np.asarray(quotas, np.int64), 0, shards)
    return counts


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, tag, source, size) of every row, written once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), text.alias("text"))
    return materialize(
        rows.select("id", F.xxhash64("text").alias("tag"), "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
    )


def plan_sources(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_PASSES,
                 block_words: int = BLOCK_WORDS) -> list[Source]:
    """Targets and block counts: one row per source."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    given = [weights[k % len(weights)] for k in range(len(rows))]
    totals = [r["size"] for r in rows]
    targets = water_fill(totals, given, sum(totals) * share_percent / 100, most)
    return [
        Source(k, r["source"], r["size"], targets[k], min(MOST_BLOCKS, r["size"] // block_words + 1))
        for k, r in enumerate(rows)
    ]


def _source_table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    rows = [(s.rank, s.name, s.size, s.target, s.blocks) for s in sources]
    return spark.createDataFrame(rows, "rank int, source string, source_size long, target double, blocks int")


def draws(sizes: DataFrame, sources: list[Source], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(id, tag, pass, shard) of every document taken, once per time it is taken.

    Also carries ``source``, ``size``, ``source_size`` and ``target``.
    """
    spark = sizes.sparkSession
    table = _source_table(spark, sources)
    # one row per source: bounded as the weights are; a hot source's rows stay where they are
    placed = sizes.where("size > 0").join(F.broadcast(table), sizes["source"].eqNullSafe(table["source"])).drop(table["source"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "id", "tag"), F.col("blocks").cast("long")))
    blocks = placed.groupBy("rank", "block", "target", "source_size").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed + 1), "rank", "block"), "block")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    # words left for the pass when a block's turn comes: at least its own takes it whole, less takes a part of it
    passes = blocks.withColumn("nth", F.row_number().over(order)).withColumn("before", before).select(
        "rank", "block", "words", "nth", F.explode(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1))).alias("pass"),
        (F.col("target") - F.col("pass") * F.col("source_size") - F.col("before")).alias("room"),
    )
    taken = materialize(passes.where("room >= 0.5"))
    quota = dict(taken.groupBy("rank").count().collect())
    counts = splitting_tree([quota.get(s.rank, 0) for s in sources], shards, np.random.Generator(np.random.PCG64(seed)))
    ends = spark.createDataFrame(
        [(s.rank, np.cumsum(counts[k]).tolist()) for k, s in enumerate(sources)], "rank int, ends array<long>"
    )
    # draws of one source in order: pass after pass, block after block
    drawn = Window.partitionBy("rank").orderBy("pass", "nth")
    sharded = (
        taken.withColumn("draw", F.row_number().over(drawn))
        .join(F.broadcast(ends), "rank")
        .select("rank", "block", "words", "room", "pass",
                F.size(F.filter("ends", lambda e: e < F.col("draw"))).alias("shard"))
    )
    copies = placed.join(sharded, ["rank", "block"])
    whole = copies.where("room >= words")
    # the last block of a source: documents in a hashed order while they fit, then the one that fits the rest best
    share = Window.partitionBy("rank", "block", "pass")
    inner = share.orderBy(F.xxhash64(F.lit(seed + 2), "id", "tag"), "id", "tag")
    upto = F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    part = copies.where("room < words").withColumn("upto", upto).withColumn("fits", F.col("upto") <= F.col("room"))
    rest = F.col("room") - F.coalesce(F.max(F.when(F.col("fits"), F.col("upto"))).over(share), F.lit(0))
    part = part.withColumn("rest", rest).withColumn("gap", F.abs(F.col("rest") - F.col("size")))
    best = F.row_number().over(share.orderBy("fits", "gap", "id", "tag")) == 1
    part = part.withColumn("best", best).where("fits OR (best AND gap < rest)")
    columns = ["id", "tag", "pass", "shard", "source", "size", "source_size", "target"]
    return whole.select(columns).union(part.select(columns))


def taken_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every row's id, size, source, the source's size and target, the words the mix takes of it, and the shards
    that the tree sends it to (ascending; one per time it is taken)."""
    sizes = sized(docs, id_col, text_col, source_col)
    sources = plan_sources(sizes)
    table = _source_table(sizes.sparkSession, sources)
    times = draws(sizes, sources, shards, seed).select("id", "tag", "source", "pass", "shard").distinct()
    times = times.groupBy("id", "tag", "source").agg(
        F.count(F.lit(1)).alias("times"), F.sort_array(F.collect_list("shard")).alias("shards")
    )
    sized_rows = sizes.join(F.broadcast(table), sizes["source"].eqNullSafe(table["source"]), "left").drop(table["source"])
    same = (
        sized_rows["id"].eqNullSafe(times["id"]) & (sized_rows["tag"] == times["tag"])
        & sized_rows["source"].eqNullSafe(times["source"])
    )
    joined = sized_rows.join(times, same, "left")
    return joined.select(
        sized_rows["id"], sized_rows["source"], sized_rows["size"], "source_size", "target",
        (sized_rows["size"] * F.coalesce("times", F.lit(0))).alias("taken"),
        F.coalesce("shards", F.array().cast("array<int>")).alias("shards"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixed rows: all columns of ``docs``, with ``mix_shard``, ``mix_pass`` and ``mix_order`` within the shard."""
    sizes = sized(docs, id_col, text_col, source_col)
    taken = draws(sizes, plan_sources(sizes), shards, seed).select("id", "tag", "source", "pass", "shard").distinct()
    rows = docs.select(row_struct(docs)).select(
        "row", F.col("row")[id_col].alias("doc"), F.col("row")[source_col].alias("origin"),
        F.xxhash64(F.coalesce(F.col("row")[text_col], F.lit(""))).alias("digest"),
    )
    same = (
        rows["doc"].eqNullSafe(taken["id"]) & (rows["digest"] == taken["tag"])
        & rows["origin"].eqNullSafe(taken["source"])
    )
    order = F.xxhash64(F.lit(seed + 3), "shard", "pass", "doc", "digest")
    kept = docs.select([c for c in docs.columns if c not in MIX_COLUMNS])
    mixed = rows.join(taken, same).select(
        *row_columns(kept), F.col("shard").alias("mix_shard"), F.col("pass").alias("mix_pass"), order.alias("mix_order")
    )
    return mixed.repartitionByRange("mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")
