"""Mixing sources to target weights, in DataFrame functions only.

Targets. Sources in code-point order (null last) weigh 5, 2, 1, repeating. Together they take as
many words as there are; none takes more than three times its own size. With a common factor f the
targets are min(3 * size, f * weight); sorted by size / weight the capped sources come first, which
gives f in one pass.

Draws. A hash of id and text permutes the documents of a source and cuts them into disjoint blocks
of about equal words. A source draws all its blocks as often as its target holds its size, then the
first blocks of one more pass, then part of one block: documents in hash order up to the gap, and
one more document if that comes nearer. So a source misses its target by less than one document.

Shards. A tree over the output shards splits the block quotas of all sources in two at each node:
the left half is a multivariate hypergeometric draw (an urn without replacement, source after
source), so every shard gets its exact number of blocks and the sources are spread as a random
permutation would spread them, yet only counts are handled. The shards of a source take
consecutive, hence disjoint, runs of its draws; within a shard a hash orders the copies.

Scale. No text moves: one pass reads sizes, everything later handles rows of a few numbers. No
window sees more than the blocks of a source or the documents of one block; blocks number about
`MOST_BLOCKS` at any size, as they grow with the input.

Cases. Null texts and empty ones have size 0 and are taken 0 times their size. Repeated rows (same
id and text) share one fate. A source without words has target 0. Empty tables give empty results.
Extra columns are ignored. All draws hang on fixed seeds, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macrotide.llm.common import staged, table, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 25_000
MOST_BLOCKS = 500_000
BLOCKS_A_SHARD = 64
SEED = 20


def key_of(documents: DataFrame, seed: int = SEED):
    """The hash that permutes documents: of id and text."""
    return F.xxhash64(F.lit(seed), documents["doc_id"], F.coalesce(documents["text"].cast("string"), F.lit("")))


def sized(documents: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size in words and the hash that permutes."""
    text = text_or_empty()
    return documents.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(text).alias("size"),
        key_of(documents, seed).alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: rank, source_size, target. The windows see a row per source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    cap = F.col("source_size") * F.lit(most)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_cap.rowsBetween(0, Window.unboundedFollowing)
    factor = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))) \
        / F.sum("weight").over(from_here)
    return (
        ranked.withColumn("cap", cap).withColumn("factor", factor)
        .withColumn("open", F.col("factor") * F.col("weight") <= F.col("cap"))
        .withColumn("factor", F.min(F.when(F.col("open"), F.struct(by_cap_order(), "factor")))
                    .over(everything)["factor"])
        .select("rank", "source", "source_size", F.when(
            F.col("factor").isNull(), F.col("cap").cast("double")).otherwise(
            F.least(F.col("cap").cast("double"), F.col("factor") * F.col("weight"))).alias("target")))


def by_cap_order():
    return F.struct((F.col("source_size") / F.col("weight")).alias("ratio"), "rank").alias("order")


def uniform(*parts):
    """A number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0 ** -53)


def split_quotas(quotas: DataFrame, draws: int, shards: int, seed: int) -> DataFrame:
    """(rank, shard, blocks) from (rank, quota): the hypergeometric tree. Nodes are rows that carry
    the quotas of their sources in an array; a level halves every node that holds several shards."""

    def edge(shard):
        return F.floor(shard * F.lit(draws) / F.lit(shards)).cast("long")

    def urn(source, total, left):
        """Of the source's blocks, how many are among `left` draws from `total`."""
        state = F.struct(total.alias("total"), left.alias("left"))
        end = F.aggregate(
            F.when(source["quota"] > 0, F.sequence(F.lit(1).cast("long"), source["quota"]))
            .otherwise(F.array().cast("array<bigint>")),
            state, lambda s, i: F.struct(
                (s["total"] - 1).alias("total"),
                (s["left"] - (uniform(F.lit(seed), F.col("low"), F.col("high"), source["rank"], i)
                              * s["total"] < s["left"]).cast("long")).alias("left")))
        return left - end["left"]

    def deal(state, source):
        taken = urn(source, state["total"], state["left"])
        return F.struct(
            (state["total"] - source["quota"]).alias("total"), (state["left"] - taken).alias("left"),
            F.concat(state["split"], F.array(F.struct(
                source["rank"].alias("rank"), taken.alias("l"), (source["quota"] - taken).alias("r")))).alias("split"))

    none = F.array().cast("array<struct<rank:int,l:bigint,r:bigint>>")
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("rank", F.col("quota").cast("long").alias("quota")))).alias("quotas")) \
        .select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "quotas")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("long")
        total, left = edge(F.col("high")) - edge(F.col("low")), edge(middle) - edge(F.col("low"))
        split = F.aggregate(
            "quotas", F.struct(total.alias("total"), left.alias("left"), none.alias("split")), deal, lambda s: s["split"])
        sides = nodes.select("low", "high", middle.alias("middle"), split.alias("split")).select(
            "low", "high", "middle", "split",
            F.explode(F.when(F.col("high") - F.col("low") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("side"))
        nodes = sides.select(
            F.when(F.col("side") == 0, F.col("low")).otherwise(F.col("middle")).alias("low"),
            F.when(F.col("side") == 0, F.col("middle")).otherwise(F.col("high")).alias("high"),
            F.filter(F.transform("split", lambda x: F.struct(
                x["rank"].alias("rank"), F.when(F.col("side") == 0, x["l"]).otherwise(x["r"]).alias("quota"))),
                lambda x: x["quota"] > 0).alias("quotas"))
    return nodes.select(F.col("low").alias("shard"), F.inline("quotas")).select("rank", "shard", F.col("quota").alias("blocks"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, and the output shards of its copies."""
    sizes = staged(sized(documents, seed))
    chosen = staged(targets(sizes, weights))
    total = chosen.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words")).first()["words"]
    block_words = max(BLOCK_WORDS, -(-total // MOST_BLOCKS))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    chosen = chosen.select(
        "*", whole.alias("passes"), (F.col("target") - whole * F.col("source_size")).alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(block_words))).cast("long").alias("n_blocks"))
    placed = sizes.alias("d").join(chosen.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "doc_id", "size", "key", "rank", "source_size", "target", "passes", "rest", "n_blocks",
        F.pmod("key", "n_blocks").alias("block"))
    in_order = Window.partitionBy("rank").orderBy("block")
    blocks = staged(
        placed.groupBy("rank", "block").agg(
            F.sum("size").alias("words"), *(F.first(c).alias(c) for c in ("passes", "rest", "n_blocks")))
        .withColumn("before", F.sum("words").over(in_order) - F.col("words")))
    full = F.col("before") + F.col("words") <= F.col("rest")
    cut = (F.col("before") < F.col("rest")) & ~full
    # documents of the one block of each source that is drawn in part
    inside = placed.join(
        blocks.where(cut).select("rank", "block", (F.col("rest") - F.col("before")).alias("gap")), ["rank", "block"])
    reached = inside.withColumn("upto", F.sum("size").over(Window.partitionBy("rank").orderBy("key")))
    missing = F.col("gap") - F.coalesce(F.max(F.when(F.col("upto") <= F.col("gap"), F.col("upto")))
                                        .over(Window.partitionBy("rank")), F.lit(0))
    edges = (
        reached.withColumn("missing", missing).groupBy("rank", "block").agg(
            F.max(F.when(F.col("upto") <= F.col("gap"), F.col("key"))).alias("cut_key"),
            F.min(F.when((F.col("upto") > F.col("gap")) & (F.abs(F.col("size") - F.col("missing")) < F.col("missing")),
                         F.struct(F.abs(F.col("size") - F.col("missing")).alias("off"), "key")))["key"].alias("extra_key")))
    # the list of draws of each source, dealt to the shards
    drawn = blocks.withColumn("draws", F.col("passes") + (full | cut).cast("long"))
    quotas = staged(drawn.groupBy("rank").agg(F.sum("draws").alias("quota")).where("quota > 0"))
    n_draws = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-n_draws // BLOCKS_A_SHARD))
    shares = split_quotas(quotas, n_draws, shards, seed)
    runs = shares.select(
        "rank", "shard", "blocks",
        (F.sum("blocks").over(Window.partitionBy("rank").orderBy("shard")) - F.col("blocks")).alias("start"))
    slots = runs.where("blocks > 0").select("rank", "shard", F.explode(F.sequence("start", F.col("start") + F.col("blocks") - 1)).alias("draw"))
    lists = drawn.where("draws > 0").select(
            "rank", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("draws") - 1)).alias("pass"))
    numbered = lists.withColumn("draw", F.row_number().over(Window.partitionBy("rank").orderBy("pass", "block")) - 1)
    homes = numbered.join(slots, ["rank", "draw"]).groupBy("rank", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("homes"))
    facts = staged(
        drawn.select("rank", "block", full.alias("full"), cut.alias("cut"))
        .join(homes, ["rank", "block"], "left").join(edges, ["rank", "block"], "left"))
    again = F.col("full") | (F.col("cut") & F.coalesce(
        (F.col("key") <= F.col("cut_key")) | (F.col("key") == F.col("extra_key")),
        F.col("key") <= F.col("cut_key"), F.col("key") == F.col("extra_key"), F.lit(False)))
    copies = F.col("passes") + again.cast("long")
    return placed.join(facts, ["rank", "block"]).select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
        F.transform(F.slice(F.coalesce("homes", F.array().cast("array<struct<pass:bigint,shard:bigint>>")), F.lit(1), copies.cast("int")),
                    lambda x: x["shard"]).alias("shards"),
        "key")


def shuffled(mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """A row per copy, shard by shard, in random order within each shard."""
    return (
        mixed.select("doc_id", F.posexplode("shards").alias("copy", "shard"), "key").repartition("shard")
        .sortWithinPartitions("shard", F.xxhash64(F.lit(seed), "shard", "copy", "key"))
        .select("shard", "copy", "doc_id"))


def op6_mixing(spark, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "shards")
