"""Benchmark decontamination with a generalised suffix automaton.

Normal form: ASCII letters lower-cased; words are runs of ASCII letters, digits and characters
outside ASCII. The automaton holds every run of words of every item. The words of a document stream
through it; after each word it knows the longest run ending there that some item contains. From
`WINDOW` words on, the last `WINDOW` words are a window of those items; an item of fewer words is
one window, found at its own end. Words inside windows are hit.

Scale. One pass over the documents without a shuffle. Items are broadcast in blocks of at most
`BLOCK_WORDS` words (a proven bound), of which the driver holds one at a time, and the automaton is built by each task; with several blocks
the documents pass once per block and only the rows that hit are merged, by document; `decontaminate` repeats
this for the documents it cut. A single item
longer than a block is cut into pieces that overlap by a window less one word, which keeps every
window.

Cases. Null texts and items have no words. Repeated items count once by id; an item without id hits
but is not listed. An empty benchmark or document table gives clean or no rows. Repeated document
rows give repeated results. Other columns are ignored by the query and kept by `decontaminate`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.llm.common import map_batches, sliced, staged, table

WINDOW = 10
BLOCK_WORDS = 100_000
#: Lower case for letters, a space for the other ASCII characters outside words, bytes from 128 on kept.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

HITS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,stop:bigint>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


class Automaton:
    """States are classes of word runs with the same ends in the items; `go` are transitions, `link`
    leads to the longest shorter suffix in another class, `size` is the longest run of a state."""

    def __init__(self, items: list[tuple[str | None, list[bytes], bool]], window: int) -> None:
        """items: (id, words, whole); only whole items may count as one short window."""
        self.window = window
        self.go: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        for _, words, _ in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.holds: dict[int, set[str | None]] = {}  # of the windows, by state
        shorts: dict[int, tuple[int, set[str | None]]] = {}
        for item, words, whole in items:
            state = 0
            for n, word in enumerate(words, 1):
                state = self.go[state][word]
                if n >= window:
                    self.holds.setdefault(self.window_state(state), set()).add(item)
            if whole and 0 < len(words) < window:
                shorts.setdefault(state, (len(words), set()))[1].add(item)
        # short items that end at a state, from its own class and those behind its links
        self.shorts: list[tuple[tuple[int, set[str | None]], ...]] = [()] * len(self.go)
        for state in sorted(range(1, len(self.go)), key=self.size.__getitem__):
            own = (shorts[state],) if state in shorts else ()
            self.shorts[state] = own + self.shorts[self.link[state]]
        self.least = [min([window, *(n for n, _ in found)]) for found in self.shorts]

    def _new(self, size: int) -> int:
        self.go.append({})
        self.link.append(0)
        self.size.append(size)
        return len(self.go) - 1

    def _split(self, state: int, via: int, word: bytes) -> int:
        """A copy of `via` for the runs up to one word longer than those of `state`."""
        copy = self._new(self.size[state] + 1)
        self.go[copy], self.link[copy] = dict(self.go[via]), self.link[via]
        self.link[via] = copy
        while state >= 0 and self.go[state].get(word) == via:
            self.go[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if (via := self.go[last].get(word)) is not None:  # known from an earlier item
            return via if self.size[via] == self.size[last] + 1 else self._split(last, via, word)
        new, state = self._new(self.size[last] + 1), last
        while state >= 0 and word not in self.go[state]:
            self.go[state][word] = new
            state = self.link[state]
        if state >= 0:
            via = self.go[state][word]
            self.link[new] = via if self.size[via] == self.size[state] + 1 else self._split(state, via, word)
        return new

    def window_state(self, state: int) -> int:
        while self.size[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str | None]]:
        """Maximal hit spans (start, stop in words) and the items whose windows occur."""
        go, link, size, least, window = self.go, self.link, self.size, self.least, self.window
        spans: list[list[int]] = []
        items: set[str | None] = set()
        state = length = 0
        for at, word in enumerate(words, 1):
            onward = go[state].get(word)
            if onward is None:
                while state and onward is None:
                    state = link[state]
                    onward = go[state].get(word)
                if onward is None:
                    length = 0
                    continue
                length = size[state]
            state, length = onward, length + 1
            if length < least[state]:
                continue
            longest = 0
            if length >= window:
                longest = window
                items |= self.holds[self.window_state(state)]
            for n, short in self.shorts[state]:
                if n <= length:
                    longest = max(longest, n)
                    items |= short
            if longest:
                start = at - longest
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = at
                else:
                    spans.append([start, at])
        return spans, items


def item_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[str | None, list[bytes], bool]]]:
    """Items read block by block; each block has at most `block_words` words and a window more. There is one at least."""
    block, filled, given = [], 0, 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).toLocalIterator():
        words = words_of((row["text"] or "").encode())
        for at in range(0, max(1, len(words)), block_words):
            piece = words[at:at + block_words + window - 1]
            if block and filled + len(piece) > block_words:
                yield block
                block, filled, given = [], 0, given + 1
            block.append((row["item"], piece, len(piece) == len(words)))
            filled += len(piece)
    if block or not given:
        yield block


def sent_blocks(benchmark: DataFrame, window: int, block_words: int) -> list[Broadcast]:
    """The blocks as broadcasts. The driver holds one at a time: each is written to a file as it is sent."""
    return [benchmark.sparkSession.sparkContext.broadcast(block) for block in item_blocks(benchmark, window, block_words)]


def _hits_of_block(documents: DataFrame, sent: Broadcast, window: int) -> DataFrame:
    keep = [f for f in documents.schema.fields if f.name != "folded"]
    schema = T.StructType(keep + T.StructType.fromDDL(HITS).fields)
    at, names = documents.columns.index("folded"), documents.columns

    def work(batches):
        automaton = Automaton(sent.value, window)
        for batch in batches:
            out = {"n_words": [], "n_hit": [], "items": [], "spans": []}
            for text in batch.column(at).to_pylist():
                words = words_of(text)
                spans, found = automaton.scan(words)
                out["n_words"].append(len(words))
                out["n_hit"].append(sum(b - a for a, b in spans))
                out["items"].append(sorted(i for i in found if i is not None))
                out["spans"].append([{"start": a, "stop": b} for a, b in spans])
            yield {n: batch.column(i) for i, n in enumerate(names) if i != at} | out

    return map_batches(documents, schema, work)


def _merged(every: DataFrame, keys: list[str]) -> DataFrame:
    """What several blocks found, merged by key: (keys, n_words, items, spans, n_hit)."""
    spans = F.array_sort(F.flatten(F.collect_set("spans")))
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:bigint,stop:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= s["start"]),
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop")))))
        .otherwise(F.concat(done, F.array(s))))
    return every.groupBy(*keys).agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        merged.alias("spans")).withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]))


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) per row; spans are in words."""
    blocks = sent_blocks(benchmark, window, block_words)
    texts = documents.select("doc_id", F.col("text").cast("string").cast("binary").alias("folded"))
    if len(blocks) == 1:
        return _hits_of_block(texts, blocks[0], window)
    # several blocks: what each finds is merged by document; equal rows of one id merge to equal results
    keyed = texts.withColumn("digest", F.sha2("folded", 256))
    found = [_hits_of_block(keyed, b, window) for b in blocks]
    every = found[0]
    for more in found[1:]:
        every = every.union(more.where("n_hit > 0"))
    once = _merged(every, ["doc_id", "digest"])
    rows = keyed.select("doc_id", "digest")
    return rows.alias("k").join(once.alias("o"), F.col("k.doc_id").eqNullSafe(F.col("o.doc_id")) & F.col("k.digest").eqNullSafe(F.col("o.digest"))) \
        .select("k.doc_id", "n_words", "n_hit", "items", "spans")


def cut(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what lies between them."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for start, stop in spans:
        kept.append(text[at:places[start][0]])
        at = places[stop - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(documents: DataFrame, benchmark: DataFrame, longest: int = 0, coverage: float = 0.5,
                  window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, all columns, without benchmark spans of more than `longest` words; documents
    of which hit words cover more than `coverage` go as a whole. Cut texts are scanned again until
    nothing is found, as what stood on both sides of a cut comes together. The result does not depend
    on how the benchmark falls into blocks: coverage and cuts follow the spans of all blocks."""
    columns, at = documents.columns, documents.columns.index("text")
    texts, blocks = documents.withColumn("text", F.col("text").cast("string")), sent_blocks(benchmark, window, block_words)
    if len(blocks) == 1:
        return _clean_block(texts, blocks[0], at, longest, coverage, window).select(columns)
    return _clean_blocks(texts, blocks, at, longest, coverage, window).select(columns)


def _clean_blocks(documents: DataFrame, blocks: list, at: int, longest: int, coverage: float, window: int) -> DataFrame:
    """Rounds over all blocks: the first over the documents, each later one over those cut in the one before."""
    names, key, found = documents.columns, "hit_digest", "hit_found"
    cut_before, done = documents, None

    def work(batches):
        for batch in sliced(batches):
            texts = [cut(t, [(s["start"], s["stop"]) for s in spans]) for t, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)]
            yield {n: batch.column(i) if i != at else texts for i, n in enumerate(names)}

    while True:
        keyed = cut_before.withColumn(key, F.sha2("text", 256))
        folded = keyed.select(key, F.col("text").cast("binary").alias("folded"))
        every = [_hits_of_block(folded, b, window).where("n_hit > 0") for b in blocks]
        merged = staged(_merged(reduce(DataFrame.union, every), [key]).select(key, F.struct("n_words", "n_hit", "spans").alias(found)))
        rows = keyed.join(merged, key, "left")
        if done is None:  # coverage is that of the uncut text
            rows = rows.where(F.col(found).isNull() | (F.col(f"{found}.n_hit") <= coverage * F.col(f"{found}.n_words")))
        long = F.coalesce(F.filter(f"{found}.spans", lambda s: s["stop"] - s["start"] > longest), F.array())
        calm = rows.where(F.size(long) == 0).select(names)
        done = calm if done is None else done.union(calm)
        cut_before = staged(map_batches(rows.where(F.size(long) > 0).select(*names, long.alias(found)), documents.schema, work))
        if cut_before.isEmpty():
            return done


def _clean_block(documents: DataFrame, sent, at: int, longest: int, coverage: float, window: int) -> DataFrame:
    names = documents.columns

    def work(batches):
        automaton = Automaton(sent.value, window)
        for batch in sliced(batches):
            texts, stay = batch.column(at).to_pylist(), []
            for i, text in enumerate(texts):
                words = words_of((text or "").encode())
                spans, _ = automaton.scan(words)
                gone = sum(b - a for a, b in spans) > coverage * len(words)
                while not gone and (long := [s for s in spans if s[1] - s[0] > longest]):
                    text = cut(text, long)
                    spans, _ = automaton.scan(words_of(text.encode()))
                if not gone:
                    texts[i] = text
                    stay.append(i)
            left = batch.take(stay)
            yield {n: left.column(i) if i != at else [texts[k] for k in stay] for i, n in enumerate(names)}

    return map_batches(documents, documents.schema, work)


def op7_decontamination(spark, folder: str) -> DataFrame:
    found = hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
