"""Periodic runs of words, found on a grammar-compressed text.

A run is a stretch of words in which words `period` places apart are identical, at least twice the
period and `LEAST` words long, with the smallest period of the stretch, that no neighbouring word
extends.

Grammar. The words of a document become numbers. Re-Pair rounds replace pairs of neighbouring symbols
that occur twice or more in the document by new symbols; a round replaces every pair that is more
frequent than the pairs it overlaps, so frequent pairs go first and repeats halve in each round. What is
left once no pair repeats is paired up by place, level by level, until one symbol stands for the document.

Runs. A run lies inside the expansion of exactly one lowest symbol X -> Y Z and crosses the boundary of
Y and Z there. So the runs across its boundary are computed once per symbol, on one place where it
stands: a run of period q holds the three words at the boundary, or those before it, again q places to
the left or right, which gives the periods worth trying; how far the words agree is then read from names
of blocks of 1, 2, 4, ... words (equal names, equal blocks; no hashes). The runs are translated to every place
where the symbol is derived, and of intervals with one period those inside another go: a run cut short by
the end of an expansion is found whole at the symbol that holds it whole. Of equal intervals the
smallest period stays.

Scale. One pass, nothing is shuffled. A task works on slabs of `SLAB` words (a longer document is a slab of its own) and its
memory grows with the slab only: places where symbols stand number less than the words, names take 4
bytes a word and level, and only for documents that have a candidate. Time is n log n in the words.

Cases. Null and empty texts have no words and no runs. A null id rewrites nothing in the query. Repeated rows
give repeated results. Empty tables give empty results. Other columns are ignored by `runs`, kept by
`collapse`.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import map_batches, table

LEAST, SLAB = 12, 1 << 18
#: A run holds at least LEAST / 2 words that equal the one a period on; half of them lie on one side of a boundary.
ANCHOR = LEAST // 4
NONE = np.zeros(0, np.int64)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal keys, equal numbers from 0 on."""
    codes, found = pd.factorize(keys)
    return codes, len(found)


def mixed(keys: np.ndarray) -> np.ndarray:
    """A fixed spread of keys over 64 bits, to order equally frequent pairs."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Grammar:
    """Rules of a slab: rule r stands for words start[r]:end[r] (one of its places), its two parts meet at middle[r];
    rule of[k] also stands at place[k]."""

    def __init__(self, symbols: np.ndarray, limits: np.ndarray) -> None:
        self.parts: dict[str, list[np.ndarray]] = {k: [] for k in ("start", "middle", "end", "of", "place")}
        self.rules = 0
        after = self._repair(symbols.copy(), limits)
        self._pair_up(after, limits)
        for name, found in self.parts.items():
            setattr(self, name, np.concatenate([*found, NONE]))

    def _add(self, start, middle, end, rule=None, places=None) -> None:
        if rule is None:
            rule, places = np.arange(len(start)), start
        for name, value in (("start", start), ("middle", middle), ("end", end), ("of", rule + self.rules), ("place", places)):
            self.parts[name].append(value)
        self.rules += len(start)

    def _repair(self, symbol: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Replaces repeated pairs; returns for each word where the symbol that begins there ends, 0 for words
        that begin none. A boundary whose pair is unique stays so, whatever its sides become: it is dropped."""
        n = len(symbol)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        fresh = int(symbol.max(initial=-1)) + 1
        alive = np.ones(n + 1, bool)
        alive[limits[1:] - 1] = False
        alive[-1] = False
        rank = np.full(n + 1, -1)
        at = np.flatnonzero(alive)
        while len(at):
            pair = symbol[at] * fresh + symbol[after[at]]
            code, kinds = numbered(pair)
            count = np.bincount(code, minlength=kinds)
            stays = count[code] > 1
            alive[at[~stays]] = False
            at, pair, code = at[stays], pair[stays], code[stays]
            if not len(at):
                break
            first = np.zeros(kinds, np.int64)
            first[code] = pair
            order = np.empty(kinds, np.int64)
            order[np.lexsort((mixed(first), count))] = np.arange(kinds)
            rank[at] = order[code]
            left, right = before[at], after[at]
            here, to_left, to_right = rank[at], np.where(left >= 0, rank[left], -1), rank[right]
            # a stretch of one pair (a a a ...): every second one, counted from its start
            begins = np.r_[True, (left[1:] != at[:-1]) | (here[1:] != here[:-1])]
            turn = (np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]) % 2 == 0
            chosen = turn & (to_left <= here) & (to_right <= here)
            rank[at] = -1
            first_of, second_of, code = at[chosen], right[chosen], code[chosen]
            behind = after[second_of]
            rule, rules = numbered(code)
            example = np.empty(rules, np.int64)
            example[rule[::-1]] = np.arange(len(rule))[::-1]
            self._add(first_of[example], second_of[example], behind[example], rule, first_of)
            symbol[first_of] = fresh + rule
            fresh += rules
            after[first_of] = behind
            inner = behind < n
            before[behind[inner]] = first_of[inner]
            alive[first_of], alive[second_of] = alive[second_of], False
            after[second_of] = 0
            at = at[alive[at]]
        return after

    def _pair_up(self, after: np.ndarray, limits: np.ndarray) -> None:
        start = np.flatnonzero(after)
        end = after[start]
        while True:
            doc = np.searchsorted(limits, start, "right")
            opens = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
            place = np.arange(len(doc)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
            left = np.flatnonzero((place[:-1] % 2 == 0) & (doc[1:] == doc[:-1])) if len(doc) else NONE
            if not len(left):
                return
            self._add(start[left], start[left + 1], end[left + 1])
            end[left] = end[left + 1]
            keep = np.ones(len(start), bool)
            keep[left + 1] = False
            start, end = start[keep], end[keep]


class Names:
    """names[k][i] is equal for equal blocks of 2**k words; the documents are laid one after another."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        self.names = [symbols.astype(np.int32)]
        size = 1
        while 2 * size <= longest:
            last = self.names[-1]
            code, kinds = numbered(last[:-size].astype(np.int64) * (int(last.max()) + 1) + last[size:])
            if kinds == len(code):
                break  # no block of this size occurs twice
            self.names.append(np.r_[code, np.full(size, -1)].astype(np.int32))
            size *= 2

    def agree(self, i: np.ndarray, q: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from i on (back: before i) equal those q places on, up to `most`."""
        length = np.zeros(len(i), np.int64)  # less than twice the largest block
        for level in range(len(self.names) - 1, -1, -1):
            fits = np.flatnonzero(length + (1 << level) <= most)
            at = i[fits] - length[fits] - (1 << level) if back else i[fits] + length[fits]
            same = self.names[level][at] == self.names[level][at + q[fits]]
            length[fits[same]] += 1 << level
        return length


def candidates(symbols: np.ndarray, limits: np.ndarray, grammar: Grammar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rule, i, q): words from i on may equal those q places on, next to the rule's boundary."""
    n = len(symbols)
    code = symbols
    for step in range(1, ANCHOR):  # numbers of the blocks of ANCHOR words
        code, _ = numbered(code[:n - step].astype(np.int64) * (int(symbols.max()) + 1) + symbols[step:])
    inside = np.ones(len(code), bool)
    for back in range(1, ANCHOR):
        ends = limits[1:] - back
        inside[ends[(ends >= 0) & (ends < len(code))]] = False
    where = np.flatnonzero(inside)
    count = np.bincount(code[where])
    where = where[count[code[where]] > 1]
    repeated = np.zeros(n + 1, bool)
    repeated[where] = True
    sorted_key = np.sort(code[where] * (n + 1) + where)
    found = []
    for shift in (0, ANCHOR):  # the block at the boundary, and the one before it
        anchor = grammar.middle - shift
        rule = np.flatnonzero((anchor >= 0) & (grammar.end - grammar.start >= LEAST))
        rule = rule[repeated[anchor[rule]]]
        anchor = anchor[rule]
        base = code[anchor] * (n + 1)
        low = np.searchsorted(sorted_key, base + grammar.start[rule])
        high = np.searchsorted(sorted_key, base + grammar.end[rule])
        times = high - low
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        other = sorted_key[np.repeat(low, times) + nth] - np.repeat(base, times)
        rule, anchor = np.repeat(rule, times), np.repeat(anchor, times)
        q = np.abs(other - anchor)
        fits = (q > 0) & (2 * q <= grammar.end[rule] - grammar.start[rule])
        found.append((rule[fits], (np.minimum(anchor, other) + shift)[fits], q[fits]))
    rule, i, q = (np.concatenate(c) for c in zip(*found, strict=True))
    fits = (i >= grammar.start[rule]) & (i + q <= grammar.end[rule])
    return rule[fits], i[fits], q[fits]


def distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct rows, in order."""
    order = np.lexsort(columns[::-1])
    sorted_columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in sorted_columns], axis=0)
    return tuple(c[new] for c in sorted_columns)


def find_runs(symbols: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period. Document d holds the words limits[d]:limits[d + 1];
    no two documents share a symbol."""
    if len(symbols) < LEAST:
        return NONE, NONE, NONE
    grammar = Grammar(symbols, limits)
    rule, i, q = candidates(symbols, limits, grammar)
    if not len(rule):
        return NONE, NONE, NONE
    # names are needed for the documents with candidates only: these are laid side by side
    docs = np.unique(np.searchsorted(limits, i, "right") - 1)
    sizes = limits[docs + 1] - limits[docs]
    words = np.arange(sizes.sum()) + np.repeat(limits[docs] - (np.cumsum(sizes) - sizes), sizes)
    moved = np.zeros(len(symbols) + 1, np.int64)
    moved[words] = np.arange(len(words))
    names = Names(numbered(symbols[words])[0], int(sizes.max()))
    start, end = grammar.start[rule], grammar.end[rule]
    back = names.agree(moved[i], q, i - start, back=True)
    ahead = names.agree(moved[i], q, end - i - q)
    long_enough = back + ahead >= np.maximum(q, LEAST - q)
    rule, i, q, back, ahead = (c[long_enough] for c in (rule, i, q, back, ahead))
    rule, begin, stop, q = smallest_period(rule, i - back, i + ahead + q, q)
    # to every place where the rule is derived
    has = np.bincount(rule, minlength=grammar.rules)
    used = has[grammar.of] > 0
    of, place = grammar.of[used], grammar.place[used]
    offset = np.cumsum(has) - has
    nth = np.arange(has[of].sum()) - np.repeat(np.cumsum(has[of]) - has[of], has[of])
    k = np.repeat(offset[of], has[of]) + nth
    shift = np.repeat(place - grammar.start[of], has[of])
    begin, stop, q = whole(begin[k] + shift, stop[k] + shift, q[k])
    _, begin, stop, q = smallest_period(np.zeros(len(q), np.int64), begin, stop, q)
    begin, q, stop = distinct(begin, q, stop)
    return begin, stop, q


def smallest_period(rule, begin, stop, q):
    """Of equal intervals of a rule the one with the smallest period, rules in order."""
    rule, begin, stop, q = distinct(rule, begin, stop, q)
    first = np.ones(len(rule), bool)
    first[1:] = (rule[1:] != rule[:-1]) | (begin[1:] != begin[:-1]) | (stop[1:] != stop[:-1])
    return rule[first], begin[first], stop[first], q[first]


def whole(begin, stop, q):
    """Intervals of one period without those inside another."""
    order = np.lexsort((-stop, begin, q))
    begin, stop, q = begin[order], stop[order], q[order]
    if not len(q):
        return begin, stop, q
    reach = np.maximum.accumulate(q * (stop.max() + 1) + stop)
    stays = np.ones(len(q), bool)
    stays[1:] = (q[1:] != q[:-1]) | (stop[1:] > reach[:-1] - q[:-1] * (stop.max() + 1))
    return begin[stays], stop[stays], q[stays]


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """The query's rewriting: for ids whose crc32 is a multiple of ten, which original word stands at each place."""
    if doc_id is None or not n:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return None
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


def slabs(batch, rewrite: Callable | None) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """Words, symbols and limits of the documents (doc_id, text) of a batch, some at a time."""
    words, sizes, total = [], [], 0

    def slab():
        limits = np.cumsum([0, *sizes])
        # the same word of two documents is two symbols
        codes = pd.factorize(np.fromiter((w for d in words for w in d), object, limits[-1]))[0].astype(np.int64)
        keys = codes * len(sizes) + np.repeat(np.arange(len(sizes)), sizes)
        return words, numbered(keys)[0], limits

    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        own = (text or b"").split()
        if rewrite and (source := rewrite(len(own), doc_id)) is not None:
            own = [own[i] for i in source]
        if words and total + len(own) > SLAB:
            yield slab()
            words, sizes, total = [], [], 0
        words.append(own)
        sizes.append(len(own))
        total += len(own)
    if words:
        yield slab()


def runs_by_document(batch, rewrite: Callable | None = None):
    """(words, [(start, length, period)]) of each document in turn."""
    for words, symbols, limits in slabs(batch, rewrite):
        begin, stop, q = find_runs(symbols, limits)
        cuts = np.searchsorted(begin, limits)
        for d, own in enumerate(words):
            k = slice(cuts[d], cuts[d + 1])
            yield own, np.stack([begin[k] - limits[d], (stop - begin)[k], q[k]], 1).tolist()


def kept(words: list[bytes], found: list[list[int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not found:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in found:
        stays[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(stays)]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def runs(documents: DataFrame) -> DataFrame:
    """(doc_id, start, length, period) of every run of every document."""
    def work(batches):
        for batch in batches:
            out = {c: [] for c in ("doc_id", "start", "length", "period")}
            for doc_id, (_, found) in zip(batch.column(0).to_pylist(), runs_by_document(batch), strict=True):
                for row in found:
                    for c, v in zip(out, (doc_id, *row), strict=True):
                        out[c].append(v)
            yield out

    return map_batches(_texts(documents), "doc_id bigint, start bigint, length bigint, period bigint", work)


def collapse(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with each run cut to its first period; words of changed texts are joined by
    single spaces, other texts stay as they are."""
    names = documents.columns
    typed = documents.withColumn("text", F.col("text").cast("string"))
    helped = typed.withColumn("__text", F.col("text").cast("binary"))

    def work(batches):
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            for k, (words, found) in enumerate(runs_by_document(batch.select([names.index("text"), len(names)]))):
                if found:
                    texts[k] = b" ".join(kept(words, found)).decode()
            yield {c: batch.column(k) if c != "text" else texts for k, c in enumerate(names)}

    return map_batches(helped, typed.schema, work)


def op11_periodic_runs(spark, folder: str) -> DataFrame:
    """The query: runs of the rewritten texts (see `planted`), the longest one, and digests."""
    numbers = ("n_runs", "start", "length", "period", "exponent_milli")

    def work(batches):
        for batch in batches:
            out = {c: [] for c in (*numbers, "runs_sha256", "collapsed_sha256")}
            for words, found in runs_by_document(batch, planted):
                start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                row = (len(found), start, length, period, 1000 * length // period if found else None,
                       hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
                       hashlib.sha256(b" ".join(kept(words, found))).hexdigest())
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
            yield {"doc_id": batch.column(0)} | out

    return map_batches(
        _texts(table(spark, folder, "documents")),
        "doc_id bigint, " + ", ".join(f"{c} bigint" for c in numbers) + ", runs_sha256 string, collapsed_sha256 string", work)
