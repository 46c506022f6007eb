"""Quality rules as a short-circuit cascade.

A document passes if no rule rejects it. Rules share lazily computed facts of the text, so a fact
costs once, and after a rejection no further rule runs. On a sample of about `SAMPLE` documents, drawn from all
partitions alike, the tasks measure the cost and the rejections of each rule; rules are ordered by
rejections per cost. The order changes the time and the rule that is named, never the verdict.

Scale. Two passes, the first over the sample; the driver gets two sums per rule, no texts. The query asks for four counts of every document, so
there they are computed after the verdict even where the cascade stopped early.

Cases. Null texts have no words and fail the base rules. Documents without id, repeated rows and
empty tables need nothing special. Other columns are ignored by the query, kept by `keep`.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import map_batches, table

SAMPLE, SEED = 512, 7
SYMBOLS = "#*$%&|<>"
GRAM = 5
CLOSES = (".", "!", "?", ":", ";", "\"", "”", "…")


class Facts:
    """Counts of one text, each computed when first asked for."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, " \t\n\x0b\x0c\r"))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of `GRAM` words found twice or more, the first included."""
        w = self.words
        n = len(w) - GRAM + 1
        if n < 2 or len(set(windows(w))) == n:
            return 0
        first: dict[tuple, int] = {}
        covered = bytearray(len(w))
        one = b"\x01" * GRAM
        for i, g in enumerate(windows(w)):
            j = first.setdefault(g, i)
            if j != i:
                covered[j:j + GRAM] = covered[i:i + GRAM] = one
        return sum(covered)

    @cached_property
    def n_upper(self) -> int:
        return sum(self.text.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def windows(w: list[bytes]):
    return zip(w, w[1:], w[2:], w[3:], w[4:], strict=False)


#: name -> whether the text is rejected. The first two are the base rules.
RULES: dict[str, Callable[[Facts], bool]] = {
    "few_words": lambda t: t.n_words < 10,
    "repeated_passages": lambda t: 100 * t.n_repeat_words > 20 * t.n_words,
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words,
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "duplicate_lines": lambda t: 2 * t.n_dup_lines > len(t.lines),
    "capitals": lambda t: 2 * t.n_upper > t.word_chars,
}
BASE = ("few_words", "repeated_passages")


def measured(documents: DataFrame, names: list[str], size: int = SAMPLE) -> list[str]:
    """The rules ordered by rejections per second, measured by the tasks on about `size` documents that a fixed seed
    draws from all partitions."""
    def work(batches):
        seconds, rejects = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for name in names:
                    facts = Facts(text)
                    began = time.perf_counter()
                    rejects[name] += RULES[name](facts)
                    seconds[name] += time.perf_counter() - began
        yield {"rule": names, "seconds": [seconds[n] for n in names], "rejects": [rejects[n] for n in names]}

    drawn = documents.select(F.col("text").cast("string").alias("text")).sample(min(1.0, size / max(1, documents.count())), seed=SEED)
    sums = map_batches(drawn, "rule string, seconds double, rejects bigint", work).groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("rejects").alias("rejects"))
    rate = dict.fromkeys(names, 0.0) | {r["rule"]: (r["rejects"] + 0.5) / max(r["seconds"], 1e-9) for r in sums.collect()}
    return sorted(names, key=lambda r: (-rate[r], names.index(r)))


def verdict(facts: Facts, order: list[str]) -> str | None:
    """The first rule that rejects the text."""
    return next((name for name in order if RULES[name](facts)), None)


def judge(documents: DataFrame, names: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule)."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = order or measured(texts, list(names or RULES))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def work(batches):
        for batch in batches:
            out = {c: [] for c in (*counts, "base_failed", "kept", "rule")}
            for text in batch.column(1).to_pylist():
                facts = Facts(text)
                rule = verdict(facts, order)
                base = any(RULES[r](facts) for r in BASE)
                for c in counts:
                    out[c].append(getattr(facts, c))
                out["base_failed"].append(base)
                out["kept"].append(rule is None and not base)
                out["rule"].append(rule)
            yield {"doc_id": batch.column(0)} | out

    return map_batches(
        texts, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in counts) + ", base_failed boolean, kept boolean, rule string", work)


def keep(documents: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The documents, all columns, that no rule rejects; the cascade stops at the first rejection."""
    columns, at = documents.columns, documents.columns.index("text")
    typed = documents.withColumn("text", F.col("text").cast("string"))
    order = measured(typed, list(names or RULES))

    def work(batches):
        for batch in batches:
            stay = [i for i, t in enumerate(batch.column(at).to_pylist()) if verdict(Facts(t), order) is None]
            left = batch.take(stay)
            yield {c: left.column(i) for i, c in enumerate(columns)}

    return map_batches(typed, typed.schema, work)


def op4_quality_rules(spark, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
