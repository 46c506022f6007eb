"""Secrets in text: base patterns, and values in a credential context that are dear to guess.

Base spans come from three patterns (assignments, access keys, hexadecimal runs). The method adds
spans of kind `guess`: wherever a credential word is followed by a separator and a value, the value
is cut into segments of least total guess cost by dynamic programming. A segment is a listed word
(with leet and capital variants), a date, a repeat, a keyboard walk, a sequence, or a brute-force
span priced by its character classes. Costs are base-10 logarithms of guesses; a value that needs
at least `GUESSES` of them is a secret, whatever its characters. Prose after a credential word is cheap, as
its words are listed, and stays. Listed are common English words and, for text of any language, the words of eight letters or more
that occur in `LEAST_DOCUMENTS` documents at least, away from credential words, the `MOST_WORDS` most frequent of them; other words of
eight letters or more are secrets. A value that base spans hold whole is not listed again; one that reaches
beyond them is, and the base spans stay.

Scale. Two passes over the documents, whole texts: one counts long words, combined per batch before the counts are shuffled, the
other scans. The listed words, at most `MOST_WORDS`, go through the driver to the tasks. The dynamic
programme runs over the whole value and stops where every way on is dear enough. In values of more than
`LONGEST` characters a long repeat is tried from its first `LONGEST` places to its last, so its time
grows with the length of the value.

Cases. A value in a credential context ends at white space and at the first character outside ASCII. Null texts count as empty; empty texts, tables and repeated rows give the obvious results.
Other columns are ignored by the query and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import bound_batches, map_batches, sliced, staged, table
from macrotide.llm.english import WORDS

GUESSES, LONGEST, LEAST = 10.0, 64, 6
MOST_WORDS, LEAST_DOCUMENTS = 50_000, 3
HELD_WORDS = 200_000  # words that a task counts before it hands the counts on
KINDS = ("assign", "access", "hex", "guess")

#: Letters in either case, spelled out so that no letter outside ASCII matches.
def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    "(" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key")
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f]{24,}")
#: Fixed words that stand before a value; any may be followed by "is" or a separator.
CONTEXT_WORDS = (
    "password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "apikey", "api key", "api-key", "api_key",
    "access key", "access_key", "auth key", "auth_key", "private key", "private_key", "credential", "credentials",
)
CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:" + "|".join(_either(w) for w in sorted(CONTEXT_WORDS, key=len, reverse=True))
    + r""")(?:["']?[\x20\t]*(?::=|=>|->|[:=])|[\x20\t]+(?:is|was)(?=[\x20\t:]))[\x20\t:]*["'`]?([!-~]+)""")
AFTER = re.compile("[A-Za-z0-9]")
MARKS = tuple(w.split()[0].split("_")[0].split("-")[0].encode() for w in CONTEXT_WORDS)

#: Common password words, most common first: the place is the number of guesses.
COMMON = (
    "password", "qwerty", "letmein", "welcome", "admin", "dragon", "monkey", "master", "login", "princess", "sunshine",
    "football", "baseball", "shadow", "superman", "iloveyou", "trustno", "hello", "freedom", "whatever", "secret", "pass",
    "test", "guest", "root", "user", "default", "changeme", "example", "sample", "demo", "summer", "winter", "spring",
    "autumn", "monday", "sunday", "january", "august", "december", "money", "love", "god", "star", "blue", "red", "green",
    "black", "white", "cat", "dog", "tiger", "house", "home", "work", "school", "the", "and", "for", "you", "your", "this",
    "that", "with", "from", "not", "none", "null", "true", "false", "empty", "required", "optional", "value", "string",
    "key", "token", "reset", "change", "enter", "type", "here", "username", "email", "name", "number", "phone", "server",
)
RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys(COMMON + WORDS))}
LONGEST_WORD = 24
LONG_WORD = re.compile(rf"(?<![^\W\d_])[^\W\d_]{{8,{LONGEST_WORD}}}(?![^\W\d_])")
LEET = str.maketrans("013457@$!", "oleastasi")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
NEXT_TO = {a + b for row in ROWS for a, b in zip(row, row[1:])} | {
    a + b for upper, lower in zip(ROWS, ROWS[1:]) for k, a in enumerate(upper) for b in lower[max(0, k - 1):k + 1]}
NEXT_TO |= {p[::-1] for p in NEXT_TO}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d")


def brute(value: str) -> float:
    """log10 of the guesses for a span tried character by character."""
    classes = 26 * bool(re.search("[a-z]", value)) + 26 * bool(re.search("[A-Z]", value)) + 10 * bool(re.search("[0-9]", value)) \
        + 33 * bool(re.search("[^a-zA-Z0-9]", value))
    return len(value) * math.log10(max(classes, 10))


def segments(value: str, rank: dict[str, int] = RANK):
    """(start, stop, cost) of every span that a guesser would try as a whole."""
    low, n = value.lower(), len(value)
    plain = low.translate(LEET)
    # same[u][i]: how many characters from i on equal the one u places before them, from i + u
    same = {unit: [0] * (n + 1) for unit in range(1, 5)}
    for unit, run in same.items():
        for i in range(n - unit - 1, -1, -1):
            run[i] = run[i + 1] + 1 if value[i] == value[i + unit] else 0
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            for form in {low[i:j], plain[i:j]}:
                if form in rank:
                    changed = (form != low[i:j]) + (low[i:j] != value[i:j])
                    yield i, j, math.log10(rank[form] + 1) + 0.5 * changed
        if m := DATE.match(value, i):
            yield i, m.end(), math.log10(365 * 120) + (0.6 if m.end() - i > 8 else 0)
        for unit, run in same.items():
            if i >= LONGEST and run[i - LONGEST] >= LONGEST + unit:
                continue  # far inside a repeat that was tried from its start
            most = 1 + run[i] // unit
            for times in (*range(2, min(most, LONGEST) + 1), *range(max(LONGEST + 1, most - LONGEST), most + 1)):
                if times * unit >= 3:
                    yield i, i + times * unit, brute(value[i:i + unit]) + math.log10(times)
        j = i + 1
        while j < min(n, i + LONGEST) and low[j - 1] + low[j] in NEXT_TO:
            j += 1
            if j - i >= 3:
                yield i, j, math.log10(47 * 4) + 0.5 * (j - i - 2)
        j = i + 1
        step = ord(low[j]) - ord(low[i]) if j < n else 0
        while step in (1, -1) and j < n and ord(low[j]) - ord(low[j - 1]) == step:
            j += 1
            if j - i >= 3:
                yield i, j, math.log10(26) + math.log10(j - i)


def steps(value: str, per: float, rank: dict[str, int] = RANK):
    """The segments in order of their start, after the brute-force character at each place."""
    at = -1
    for i, j, cost in segments(value, rank):
        while at < i:
            at += 1
            yield at, at + 1, per
        yield i, j, cost
    for at in range(at + 1, len(value)):
        yield at, at + 1, per


def guess_cost(value: str, enough: float = math.inf, rank: dict[str, int] = RANK) -> float:
    """Least log10 of guesses over all ways to cut the value into segments and brute-force spans; once every
    way on costs `enough`, a bound of at least that much."""
    n = len(value)
    best = [0.0] + [math.inf] * n
    per = brute(value) / max(1, n)  # one price per brute-force character: the classes of the whole value
    cheap = at = 0  # the last place known to be reached for less than enough
    for i, j, cost in steps(value, per, rank):
        if i > at:
            at = i
            if cheap < at:
                return enough
        if best[i] + cost < best[j]:
            best[j] = best[i] + cost
            if best[j] < enough:
                cheap = max(cheap, j)
    return best[n]


def is_secret(value: str, guesses: float = GUESSES, rank: dict[str, int] = RANK) -> bool:
    return len(value) >= LEAST and guess_cost(value, guesses, rank) >= guesses


def joined(ranges) -> list[list[int]]:
    """The union of (start, end) ranges, in order."""
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def spans_of(text: str, guesses: float = GUESSES, rank: dict[str, int] = RANK) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in order; kinds by their place in KINDS."""
    low = text.lower().encode()
    found: list[tuple[int, int, int]] = []
    if any(mark in low for mark in (b"passw", b"secret", b"token", b"api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(mark in low for mark in MARKS):
        base = joined((a, b) for a, _, b in found)
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip("\"'`,;:.!?)]}>")
            if (quote := text[m.start(1) - 1]) in "\"'`" and (last := m[1].rfind(quote)) >= 0 and not AFTER.search(m[1], last):
                value = m[1][:last]  # signs before the closing quote belong to the value, those behind it do not
            start, end = m.start(1), m.start(1) + len(value)
            if not any(a <= start and end <= b for a, b in base) and is_secret(value, guesses, rank):
                found.append((start, 3, end))
    return sorted(found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def marked(text: str) -> bool:
    low = text.lower().encode()
    return any(mark in low for mark in MARKS)


def vocabulary(documents: DataFrame, most: int = MOST_WORDS, least: int = LEAST_DOCUMENTS) -> list[str]:
    """Long words of the documents by the number of documents that have them, most first; of the ranges of numbers (an
    eighth of a doubling each) as many as hold `most` words in all at most. What follows a credential
    word does not count, so no secret lists itself, however many copies of it there are."""
    def work(batches):
        times: Counter = Counter()
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                text = text or ""
                if marked(text):
                    text = CONTEXT.sub(" ", ASSIGN.sub(" ", text))
                times.update(set(map(str.lower, LONG_WORD.findall(text))))
            if len(times) >= HELD_WORDS:
                yield {"word": list(times), "n": list(times.values())}
                times.clear()
        yield {"word": list(times), "n": list(times.values())}

    counts = map_batches(documents.select(F.col("text").cast("string").alias("text")), "word string, n bigint", work)
    known = staged(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least).withColumn("range", F.floor(8 * F.log2("n"))))
    lowest, held = None, 0
    for r in sorted(known.groupBy("range").agg(F.count("*").alias("words")).collect(), reverse=True):
        held += r["words"]
        if held > most:
            break
        lowest = r["range"]
    if lowest is None:
        return []
    found = known.where(F.col("range") >= lowest).collect()  # `most` words at most
    return [r["word"] for r in sorted(found, key=lambda r: (-r["n"], r["word"]))]


def ranks(words: list[str]) -> dict[str, int]:
    """Places of the listed English words, then of further ones."""
    return {w: i + 1 for i, w in enumerate(dict.fromkeys([*RANK, *words]))}


def scan(documents: DataFrame, guesses: float = GUESSES, words: list[str] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans) per document; words: further listed ones, by
    default the vocabulary of the documents."""
    sent = documents.sparkSession.sparkContext.broadcast(ranks(vocabulary(documents) if words is None else words))

    def work(batches):
        for batch in sliced(batches):
            out = {c: [] for c in ("n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans")}
            for text in batch.column(1).to_pylist():
                spans = spans_of(text or "", guesses, sent.value)
                for k, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(sum(s[1] == k for s in spans))
                out["base_sha256"].append(hashlib.sha256(listed([s for s in spans if s[1] < 3]).encode()).hexdigest())
                out["spans"].append(listed(spans))
            yield {"doc_id": batch.column(0)} | out

    return map_batches(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, base_sha256 string, spans string", work)


def redacted(text: str, guesses: float = GUESSES, rank: dict[str, int] = RANK) -> str:
    """The text with the union of all spans replaced; names before a value stay readable."""
    kept, at = [], 0
    for start, end in joined((ASSIGN.match(text, a).start(2) if k == 0 else a, b) for a, k, b in spans_of(text, guesses, rank)):
        kept += [text[at:start], "[secret]"]
        at = end
    return "".join([*kept, text[at:]])


def redact(documents: DataFrame, guesses: float = GUESSES, words: list[str] | None = None) -> DataFrame:
    """The documents, all columns, with secrets in their texts replaced; words as for `scan`."""
    sent = documents.sparkSession.sparkContext.broadcast(ranks(vocabulary(documents) if words is None else words))
    names, at = documents.columns, documents.columns.index("text")
    typed = documents.withColumn("text", F.col("text").cast("string"))

    def work(batches):
        for batch in sliced(batches):
            texts = [t and redacted(t, guesses, sent.value) for t in batch.column(at).to_pylist()]
            yield {n: batch.column(i) if i != at else texts for i, n in enumerate(names)}

    return map_batches(typed, typed.schema, work)


def op3_secret_scan(spark, folder: str) -> DataFrame:
    bound_batches(spark)
    return scan(table(spark, folder, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess")
