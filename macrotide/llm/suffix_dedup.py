"""Repeated passages: bytes covered by a string of `LENGTH` bytes that starts anywhere else too.

Method. Suffixes are merged by interleave refinement, without sorting them. Every run of text that is to be
compared is a shard, and a symbol stands for `LENGTH` / `SYMBOLS` bytes (by their 64-bit hash). The interleave
starts as the shards one after another. A round takes the symbols in front of what is in order
already, as the backward step of a Burrows-Wheeler transform does, and deals the suffixes out by symbol, keeping
their order otherwise (counting passes over symbol numbers). A bit per place says whether the prefix shared with the suffix
before ends there; suffixes with a bit on both sides share nothing and drop out. After `SYMBOLS` rounds the
common prefixes are `LENGTH` bytes long, and what lies between two bits is a repeated interval. Single
bytes as symbols would take 400 rounds where this takes 8.

What is merged. A merge of whole shards would end in one task, so suffixes are first dealt to merges
that cannot share an interval: every string of `LENGTH` bytes (a window) is named by the least hash of
the `GRAM`-byte strings in it, and equal windows have equal names. Windows whose name occurs once are
done. Consecutive windows of a text with one name form a run, named by its content as well. Equal
runs decide each other as a whole, and one of them stands for all in the merge of the name, which is
needed only where runs differ. If more than `CROWD` different runs share a name, or they have more than
`PART_WINDOWS` windows, the windows are dealt to several merges by the hash of the window, and one round with
the whole window as its symbol remains. There a run sends each of its different windows once; those it holds several times it knows to be repeated.

Texts that occur several times need none of this: they are repeated from end to end.

Words. A passage of over 50 words is often shorter than `LENGTH` bytes, so the same is done for strings of `PASSAGE` words, with the
hash of a word in place of a byte. Runs of both kinds go through the same joins and merges; the lowest bit of a name
tells them apart. What is found so is told (`passages`) and never removed: only strings of `LENGTH` bytes are.

Scale. Rows are runs (one per about 170 bytes) and the text pieces around what differs between near
copies; texts are shuffled once. Runs of one name are joined, never gathered: a passage in a third of
all texts is one class of equal runs. Long texts are read in blocks of `BLOCK` windows.

Result. Per document the kept bytes, the removed runs and the passages (`deduplicated`); numbers and digest follow from them.

Cases. Null texts have no bytes. Texts shorter than `LENGTH` bytes lose nothing. Repeated rows are
separate documents, hence repeat each other. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from macrotide.llm.common import map_batches, sliced, staged, table

LENGTH, GRAM = 400, 64
PASSAGE, WORD_GRAM = 51, 8
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BLOCK = 1 << 20
CROWD, PART_WINDOWS = 200, 200_000
SYMBOLS = 8
MERGE_WINDOWS, SLICE = 200_000, 500
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MOST = np.uint64(2 ** 64 - 1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of byte strings of a text from prefix sums, all modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            n = 2 * len(data) + 1024
            self.up, self.down = powers(BASE, n), powers(INVERSE, n)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((sums[stops] - sums[starts]) * self.down[starts])

    def all_of(self, sums: np.ndarray, size: int) -> np.ndarray:
        return mixed((sums[size:] - sums[:-size]) * self.down[:len(sums) - size])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive values, from minima of aligned blocks."""
    n = len(h) - width + 1
    padded = np.full(-(-len(h) // width) * width, MOST)
    padded[:len(h)] = h
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def runs_of(data: np.ndarray, hashes: Hashes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(name, content, start, count, periodic) of the runs of windows of a text. A periodic run may
    repeat within itself: its naming string occurs at several places."""
    found = []
    for at in range(0, len(data) - length + 1, BLOCK):
        part = data[at:at + BLOCK + length - 1]
        sums = hashes.sums(part)
        grams = hashes.all_of(sums, gram)
        names = least_of(grams, length - gram + 1)
        starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        counts = np.diff(np.append(starts, len(names)))
        name = names[starts]
        content = hashes.of(sums, starts, starts + counts + length - 1)
        order = np.sort(name)
        once = np.isin(name, order[1:][order[1:] == order[:-1]], invert=True)
        # of a name with one run, the gram may still occur twice in the windows of that run
        placed = np.sort(grams[np.isin(grams, name)])
        twice = placed[1:][placed[1:] == placed[:-1]]
        found.append((name.view(np.int64), content.view(np.int64), starts + at, counts, ~once | np.isin(name, twice)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else ()


def words_of(data: np.ndarray, hashes: Hashes) -> np.ndarray:
    """The hash of every word of a text, in blocks of words."""
    inside = np.concatenate([[False], ~SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    cuts = [0, *(np.flatnonzero(np.diff(starts // BLOCK)) + 1).tolist(), len(starts)]
    out = [np.empty(0, np.uint64)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            sums = hashes.sums(data[starts[a]:stops[b - 1]])
            out.append(hashes.of(sums, starts[a:b] - starts[a], stops[a:b] - starts[a]))
    return np.concatenate(out)


def of_words(name: int) -> bool:
    """Whether a name is of runs of words (even) or of bytes (odd)."""
    return not name & 1


RUN = "name bigint, content bigint, start bigint, count bigint, periodic boolean"
RUNS = f"array<struct<{RUN.replace(' ', ':').replace(',:', ',')}>>"
PARSED = f"rid bigint, doc_id bigint, digest binary, n_bytes bigint, n_words bigint, runs {RUNS}"


def parsed(documents: DataFrame, length: int, gram: int, passage: int, word_gram: int) -> DataFrame:
    """(rid, doc_id, digest, n_bytes, n_words, runs) per document; rid numbers the rows. A batch is worked off in slices."""
    kind = to_arrow_schema(StructType.fromDDL(PARSED)).field("runs").type
    columns = [kind.value_type.field(i) for i in range(kind.value_type.num_fields)]

    def work(batches):
        hashes = Hashes()
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            digests, sizes, words, found, ends = [], [], [], [], [0]
            for text in batch.column(2).to_pylist():
                data = np.frombuffer(text or b"", np.uint8)
                symbols = words_of(data, hashes)
                digests.append(hashlib.sha256(data).digest())
                sizes.append(len(data))
                words.append(len(symbols))
                ends.append(ends[-1])
                for runs, bit in ((runs_of(data, hashes, length, gram), 1), (runs_of(symbols, hashes, passage, word_gram), 0)):
                    if runs:
                        found.append((runs[0] & ~1 | bit, *runs[1:]))
                        ends[-1] += len(runs[0])
            fields = [pa.array(np.concatenate([r[i] for r in found]), type=c.type) if ends[-1] else pa.array([], c.type)
                      for i, c in enumerate(columns)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=columns), type=kind)
            yield {"rid": batch.column(0), "doc_id": batch.column(1), "digest": digests, "n_bytes": sizes, "n_words": words, "runs": lists}

    rows = documents.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_batches(rows, PARSED, work)


def decided(runs: DataFrame) -> DataFrame:
    """(rid, start, count, name, parts, whole, sends): what is known of each run that can repeat.
    whole: all its windows are repeated. sends: its windows have to be compared one by one, in so
    many parts."""
    classes = runs.groupBy("name", "content", "count").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "start")).alias("first"), F.max("periodic").alias("periodic"))
    classes = staged(classes)
    names = classes.groupBy("name").agg(F.count("*").alias("kinds"), F.max("periodic").alias("any_periodic"), F.sum("n").alias("total"),
                                        F.sum("count").alias("windows"))
    names = staged(names.where("total > 1 or any_periodic").drop("total"))
    known = staged(classes.join(names, "name").select("name", "content", "count", "n", "first", "kinds", "windows", "any_periodic"))
    several = (F.col("kinds") > 1) | F.col("any_periodic")
    lead = (F.col("first.rid") == F.col("rid")) & (F.col("first.start") == F.col("start"))
    parts = F.greatest(F.ceil(F.col("kinds") / F.lit(CROWD)), F.ceil(F.col("windows") / F.lit(PART_WINDOWS)))
    return runs.drop("periodic").join(known, ["name", "content", "count"]).select(
        "rid", "start", "count", "name", parts.cast("long").alias("parts"),
        (F.col("n") > 1).alias("whole"), (several & lead).alias("sends"))


def ranges(at: np.ndarray, shift: int) -> list[dict]:
    """Ascending places as spans of neighbours, moved."""
    if not len(at):
        return []
    edges = np.flatnonzero(np.diff(at) > 1)
    starts, stops = at[np.append(0, edges + 1)] + shift, at[np.append(edges, len(at) - 1)] + shift + 1
    return [{"start": a, "stop": b} for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


SPANS = "array<struct<start:bigint,stop:bigint>>"


def pieces(texts: DataFrame, length: int, passage: int = PASSAGE) -> DataFrame:
    """(name, part, rid, whole, start, count, data, places, known) of the runs to be compared; texts: (rid,
    text, runs). data: the bytes, or the hashes of the words, of the run; where a name has several parts the hashes of the different windows at `places`, -1 for
    those that the run holds several times, which are spans in `known` already."""
    columns = ("name", "part", "rid", "whole", "start", "count", "data", "places", "known")

    def work(batches):
        hashes = Hashes()
        for batch in batches:
            for rid, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                out = {c: [] for c in columns}
                symbols = text = np.frombuffer(text or b"", np.uint8)
                if any(of_words(r["name"]) for r in runs):
                    symbols = words_of(text, hashes)

                def put(run, part, count, data, places, known, out=out, rid=rid):
                    for c, v in zip(columns, (run["name"], part, rid, run["whole"], run["start"], count, data, places, known), strict=True):
                        out[c].append(v)

                for r in runs:
                    source, size = (symbols, passage) if of_words(r["name"]) else (text, length)
                    data = source[r["start"]:r["start"] + r["count"] + size - 1]
                    if r["parts"] == 1:
                        put(r, 0, r["count"], data.tobytes(), b"", [])
                        continue
                    windows = hashes.all_of(hashes.sums(data), size)
                    code, different = pd.factorize(windows)
                    times = np.bincount(code)
                    place = np.full(len(different), -1, np.int32)
                    single = times[code] == 1
                    place[code[single]] = np.flatnonzero(single)
                    known = ranges(np.flatnonzero(~single), r["start"])
                    part = (different % np.uint64(r["parts"])).astype(np.int64)
                    for p in np.unique(part).tolist():
                        here = np.flatnonzero(part == p)
                        put(r, p, len(here), different[here].tobytes(), place[here].tobytes(), known)
                        known = []
                yield out

    return map_batches(texts.select("rid", "text", "runs"),
                       f"name bigint, part bigint, rid bigint, whole boolean, start bigint, count bigint, data binary, places binary, known {SPANS}", work)


def dealt_out(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts equal symbols together and keeps what came first first, and the symbols as numbers:
    counting passes over the lower and the upper half of the numbers."""
    code, different = pd.factorize(symbol)
    order = np.argsort((code & 0xFFFF).astype(np.uint16), kind="stable")
    if len(different) > 1 << 16:
        order = order[np.argsort((code[order] >> 16).astype(np.uint16), kind="stable")]
    return order, code


def refined(n: int, symbol: Callable[[int, np.ndarray], np.ndarray], rounds: int) -> np.ndarray:
    """Which of n suffixes share all their symbols with another; symbol(k, some) is the k-th symbol of some."""
    order = np.arange(n)  # the interleave: of suffixes that share no prefix only the dealing counts
    block = np.zeros(n, np.int64)
    for k in range(rounds - 1, -1, -1):
        dealt, code = dealt_out(symbol(k, order))
        order, code, block = order[dealt], code[dealt], block[dealt]
        ends = np.ones(len(order) + 1, bool)  # the prefix shared with the one before ends here
        ends[1:-1] = (code[1:] != code[:-1]) | (block[1:] != block[:-1])
        shared = ~(ends[:-1] & ends[1:])
        order, block = order[shared], np.cumsum(ends[:-1][shared])
        if not len(order):
            break
    same = np.zeros(n, bool)
    same[order] = True
    return same


def merged(rows: list[dict], hashes: Hashes, length: int, kind: type) -> list[np.ndarray]:
    """For each piece, which of its windows are repeated among the pieces; all are of words or all of bytes (`kind` of a symbol)."""
    if rows[0]["places"]:
        windows = np.concatenate([np.frombuffer(r["data"], np.uint64) for r in rows])
        same = refined(len(windows), lambda k, some: windows[some], 1)
    else:
        width = -(-length // SYMBOLS)
        grams = hashes.all_of(hashes.sums(np.frombuffer(b"".join(r["data"] for r in rows), kind)), width)
        sizes = [r["count"] + length - 1 for r in rows]
        first = np.concatenate([np.arange(e - n, e - length + 1) for e, n in zip(np.cumsum(sizes), sizes, strict=True)])
        same = refined(len(first), lambda k, some: grams[first[some] + min(k * width, length - width)], SYMBOLS)
    return np.split(same, np.cumsum([r["count"] for r in rows])[:-1])


def equal_windows(sent: DataFrame, length: int, passage: int = PASSAGE) -> DataFrame:
    """(rid, spans, passages): window starts that are repeated, of bytes and of words, among the runs not decided as a whole."""
    def spans_of(rows: list[dict], hashes: Hashes) -> dict[str, list]:
        out = {"rid": [], "spans": [], "passages": []}
        for crowded, words in product((True, False), repeat=2):
            some = [r for r in rows if bool(r["places"]) == crowded and of_words(r["name"]) == words]
            size, kind = (passage, np.uint64) if words else (length, np.uint8)
            for r, same in zip(some, merged(some, hashes, size, kind) if some else (), strict=True):
                if r["whole"]:
                    continue
                at = np.flatnonzero(same)
                if r["places"]:
                    at = np.frombuffer(r["places"], np.int32)[at]
                    at = np.sort(at[at >= 0])
                if spans := ranges(at, r["start"]) + r["known"]:
                    out["rid"].append(r["rid"])
                    out["spans"].append([] if words else spans)
                    out["passages"].append(spans if words else [])
        return out

    def work(batches):
        hashes, rows, size = Hashes(), [], 0
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            for row in batch.to_pylist():
                if size > MERGE_WINDOWS and (row["name"], row["part"]) != (rows[-1]["name"], rows[-1]["part"]):  # merges stay together
                    yield spans_of(rows, hashes)
                    rows, size = [], 0
                rows.append(row)
                size += row["count"]
        if rows:
            yield spans_of(rows, hashes)

    grouped = sent.repartition("name", "part").sortWithinPartitions("name", "part")
    return map_batches(grouped, f"rid bigint, spans {SPANS}, passages {SPANS}", work)


def covered(windows: list[dict] | None, length: int) -> list[dict]:
    """The maximal runs of what windows of that length cover; windows: spans of their starts."""
    out = []
    for s in sorted(windows or (), key=lambda s: s["start"]):
        start, stop = s["start"], s["stop"] + length - 1
        if out and start <= out[-1]["stop"]:
            out[-1]["stop"] = max(stop, out[-1]["stop"])
        else:
            out.append({"start": start, "stop": stop})
    return out


def removed(texts: DataFrame, length: int, passage: int) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, passages) per row; texts: (doc_id, text, spans and passages of window starts, null for none)."""
    def work(batches):
        for batch in sliced(batches, SLICE):
            out = {c: [] for c in ("n_bytes", "spans", "kept", "passages")}
            for text, windows, passages in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                gone = covered(windows, length)
                edges = [0, *(e for s in gone for e in (s["start"], s["stop"])), len(text)]
                out["n_bytes"].append(len(text))
                out["spans"].append(gone)
                out["kept"].append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                out["passages"].append(covered(passages, passage))
            yield {"doc_id": batch.column(0)} | out

    return map_batches(texts.select("doc_id", "text", "spans", "passages"),
                       f"doc_id bigint, n_bytes bigint, spans {SPANS}, kept binary, passages {SPANS}", work)


def deduplicated(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, passage: int = PASSAGE, word_gram: int = WORD_GRAM) -> DataFrame:
    """(doc_id, n_bytes, spans, kept, passages) per document: the bytes of its text that are kept, the maximal runs of bytes
    that are not (numbered from 0, stop excluded), and the maximal runs of words covered by strings of `passage` words that
    also start anywhere else."""
    rows = staged(parsed(documents, length, gram, passage, word_gram))
    compared = (F.col("n_bytes") >= length) | (F.col("n_words") >= passage)
    copies = staged(rows.where(compared).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1"))
    facts = staged(rows.select("rid", "doc_id", "digest", "n_bytes", "n_words").join(
        copies.select(F.col("digest").alias("copied")), F.col("digest") == F.col("copied"), "left")
        .select("rid", "doc_id", "digest", "n_bytes", "n_words", F.col("copied").isNotNull().alias("copy")))
    marks = decided(rows.select("rid", F.inline("runs")))
    span, of_bytes = F.struct("start", (F.col("start") + F.col("count")).alias("stop")), F.col("name").bitwiseAND(1) == 1
    of_row = marks.groupBy("rid").agg(
        F.collect_list(F.when(F.col("sends"), F.struct("name", "parts", "whole", "start", "count"))).alias("runs"),
        F.collect_list(F.when(F.col("whole") & of_bytes, span)).alias("spans"), F.collect_list(F.when(F.col("whole") & ~of_bytes, span)).alias("passages"))
    marked = staged(of_row.join(facts.select("rid", "doc_id", "digest", "copy"), "rid").select(
        "rid", F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), "copy", "runs", "spans", "passages"))
    # the texts, shuffled once and used by both joins: with the same columns in both, and no key that an inner join would test for nulls
    content = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    digest = F.coalesce(F.unhex(F.sha2(content, 256)), F.lit(b""))
    texts = documents.select(F.col("doc_id").cast("long").alias("text_id"), digest.alias("text_digest"), content.alias("text"))
    same = F.col("text_id").eqNullSafe(F.col("of_id")) & (F.col("text_digest") == F.col("of_digest"))
    senders = texts.join(marked.where(F.size("runs") > 0), same)
    single = marked.where(~F.col("copy"))
    spans = equal_windows(pieces(senders, length, passage), length, passage).union(
        single.where((F.size("spans") > 0) | (F.size("passages") > 0)).select("rid", "spans", "passages"))
    merged = spans.groupBy("rid").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "passages")))
    cut = merged.join(single.drop("spans", "passages", "runs", "copy"), "rid").select("of_id", "of_digest", "spans", "passages")

    def all_of(n: str, size: int):
        windows = F.array(F.struct(F.lit(0).cast("long").alias("start"), (F.col(n) - (size - 1)).alias("stop")))
        return F.filter(windows, lambda s: s["stop"] > 0)

    # a text that occurs several times goes as a whole; one row for all rows of an id, as for the texts with cuts
    whole = facts.where("copy").select("doc_id", "digest", "n_bytes", "n_words").distinct().select(
        "doc_id", "digest", all_of("n_bytes", length), all_of("n_words", passage))
    found = texts.join(cut.union(whole), same, "left").select(F.col("text_id").alias("doc_id"), "text", "spans", "passages")
    return removed(found, length, passage)


def covered_length(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def counted(found: DataFrame) -> DataFrame:
    """The result of `deduplicated` with n_removed, n_spans, kept_sha256 and n_repeat_words."""
    return found.select("doc_id", "n_bytes", covered_length("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"), "spans", "kept", covered_length("passages").alias("n_repeat_words"), "passages")


def repeated(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    return counted(deduplicated(documents, length, gram)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def with_text(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, passage: int = PASSAGE, word_gram: int = WORD_GRAM) -> DataFrame:
    """The columns of `repeated`, the removed runs as start:stop, comma-joined, the kept bytes as text, and the number of words in
    repeated passages with the passages (word numbers, joined likewise). Runs may end within
    a character; what is left of it is a replacement character (U+FFFD) in the text, while kept_sha256 is of the bytes."""
    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias(spans)

    return counted(deduplicated(documents, length, gram, passage, word_gram)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", joined("spans"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"), "n_repeat_words", joined("passages"))


def op9_suffix_dedup(spark, folder: str) -> DataFrame:
    return with_text(table(spark, folder, "documents"))
