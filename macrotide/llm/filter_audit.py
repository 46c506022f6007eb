"""Which filters of a chain do the work: counts for every order of five filters.

Four filters look at one text; the fifth fails a document whose text equals that of any smaller id. A
document is then a mask of the filters it fails, and all that is asked of an order (kept, removed,
redundant and so on) is a sum over counts per mask, which are additive: one small row per part.

Repeats. Each text has a word of 64 counters in a counting Bloom sketch and up to three counters in
it, chosen by hashes of the text. The tasks count for themselves, the counts are merged by sums, and what
matters is which counters reach two. A text with a counter below two is the only one of its kind; it is
cleared without moving. Only the others, possible repeats, are shuffled by their full text for the
least id, so hash collisions cost time and never a result.

Scale. Two passes over the documents. The sketch grows with the number of rows, about four rows a word, to
at most `MOST_WORDS` words; its crowded words (16 bytes each) are broadcast, 64 MB of numbers at most. Beyond
that size more texts count as possible repeats, which costs shuffle, not results. A text that very many
documents share is one row per task when the least id is sought, and an ordinary skewed key, which adaptive
execution splits, when the ids are compared with it.

Cases. Null texts count as empty, a null part as the empty string. Rows without id repeat no smaller id, and
none repeats them. Rows that share an id count one by one; labels that share an id count if any of them does. Empty tables
give no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import SPACE_CHARS, SPACES, staged, table, text_or_empty

NAMES = "ABCDE"
ROWS_PER_WORD, MOST_WORDS, PROBES = 4, 1 << 22, 3


def text_mask(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals.cast("long") > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)), F.lit(0)).cast("int")


def words_for(rows: int, most: int = MOST_WORDS) -> int:
    """Words of the sketch: a power of two."""
    size = 64
    while size < most and size * ROWS_PER_WORD < rows:
        size *= 2
    return size


def places(text: Column, words: int) -> tuple[Column, Column]:
    """The text's word in the sketch and its distinct counters there (0 to 63)."""
    first = F.xxhash64(text)
    second = F.xxhash64(first, F.lit(1))
    counters = F.array_distinct(F.array(*(F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(PROBES))))
    return first.bitwiseAND(F.lit(words - 1)), counters


def bits(counters: Column) -> Column:
    return F.aggregate(counters, F.lit(0).cast("long"), lambda all, c: all.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), c)))


def crowded_counters(texts: DataFrame, words: int) -> DataFrame:
    """(word, twice): the counters of each word that reach two, as bits."""
    word, counters = places(F.col("text"), words)
    counted = texts.select(word.alias("word"), F.explode(counters).alias("counter")).groupBy("word", "counter").agg(F.count("*").alias("n"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("counter"))
    return counted.where("n > 1").groupBy("word").agg(F.bit_or(bit).alias("twice"))


def with_masks(documents: DataFrame, part: str = "lang", most_words: int = MOST_WORDS) -> DataFrame:
    """(doc_id, part, mask) per document; bit 16 where a smaller id has the same text."""
    typed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                             text_or_empty().alias("text"))
    words = words_for(documents.count(), most_words)
    word, counters = places(F.col("text"), words)
    marked = (
        typed.withColumn("word", word).join(F.broadcast(crowded_counters(typed, words)), "word", "left")
        .withColumn("own", bits(counters))
        .withColumn("possible", F.coalesce(F.col("twice").bitwiseAND(F.col("own")) == F.col("own"), F.lit(False)))
        .select("doc_id", "part", text_mask(F.col("text")).alias("mask"), F.when(F.col("possible"), F.col("text")).alias("text")))
    marked = staged(marked)
    possible = marked.where(F.col("text").isNotNull())
    least = staged(possible.groupBy("text").agg(F.min("doc_id").alias("least_id")))
    repeats = F.coalesce(F.col("doc_id") > F.col("least_id"), F.lit(False))
    flagged = possible.join(least, "text").select("doc_id", "part", F.when(repeats, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))
    return marked.where(F.col("text").isNull()).select("doc_id", "part", "mask").union(flagged)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, n, good, toxic): arrays by mask, of all documents, of those labelled good, and toxic. The counts of labelled
    documents are joined by id and added to those of all, which need no join."""
    marks = labels.groupBy("doc_id").agg(*(F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(into) for c, into in (("quality", "good"), ("toxic", "toxic"))))
    kinds = ("n", "good", "toxic")
    zero = F.lit(0).cast("long")
    every = masks.groupBy("part", "mask").agg(F.count("*").alias("n")).select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    labelled = masks.join(marks, "doc_id").groupBy("part", "mask").agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).select(
        "part", "mask", zero.alias("n"), "good", "toxic")
    return every.union(labelled).groupBy("part").agg(*(
        F.array(*(F.sum(F.when(F.col("mask") == m, F.col(k)).otherwise(zero)) for m in range(1 << len(NAMES)))).alias(k) for k in kinds))


def steps() -> Column:
    """Every step of every order: its filter as a bit, and the filters before it as bits."""
    found = []
    for order in permutations(NAMES):
        prior = 0
        for step, name in enumerate(order, 1):
            bit = 1 << NAMES.index(name)
            found.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step).alias("step"), F.lit(bit).alias("bit"), F.lit(prior).alias("prior")))
            prior |= bit
    return F.array(*found)


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang", most_words: int = MOST_WORDS) -> DataFrame:
    """A row per part, order of the filters and step."""
    counts = mask_counts(staged(with_masks(documents, part, most_words)), labels)
    every = counts.select("part", "n", "good", "toxic", F.inline(steps()))

    def total(values: str, condition: str, times: str = "1L") -> Column:
        return F.expr(f"aggregate(sequence(0, {(1 << len(NAMES)) - 1}), 0L, (s, m) -> s + IF({condition}, {values}[m] * {times}, 0L))")

    here = "m & bit != 0 AND m & prior = 0"
    return every.select(
        "part", "filter_order", "step",
        total("n", "m & (bit | prior) = 0").alias("kept"),
        total("n", here).alias("removed"),
        total("n", "m & bit != 0 AND m & prior != 0").alias("redundant"),
        total("n", "m = bit").alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        # a filter comes before the others that the document fails in one of their number of orders
        total("n", "m & bit != 0", "(120 div greatest(bit_count(m), 1))").alias("shapley"))


def op12_filter_audit(spark, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
