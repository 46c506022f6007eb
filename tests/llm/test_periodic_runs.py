"""Periodic runs against a search over all periods and places."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from data import LONG, ROWS, SAME, documents, empty

from macrotide.llm import periodic_runs


def plain_runs(words):
    """[(start, length, period)] by start and period: every stretch for every period, smallest periods first."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def of_lists(texts):
    limits = np.cumsum([0, *map(len, texts)])
    names: dict = {}
    symbols = np.array([names.setdefault((d, w), len(names)) for d, t in enumerate(texts) for w in t], np.int64)
    begin, stop, q = periodic_runs.find_runs(symbols, limits)
    out = [[] for _ in texts]
    for b, e, p in zip(begin.tolist(), stop.tolist(), q.tolist(), strict=True):
        d = int(np.searchsorted(limits, b, "right")) - 1
        out[d].append((b - int(limits[d]), e - b, p))
    return out


def random_text(rng):
    kind = rng.random()
    letters = "abcdefgh"[:rng.randint(1, 8)]
    if kind < 0.4:
        return [rng.choice(letters) for _ in range(rng.randint(0, 150))]
    words: list[str] = []
    for _ in range(rng.randint(1, 6)):  # repeats of repeats, cut anywhere
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        for _ in range(rng.randint(0, 2)):
            unit = unit * rng.randint(1, 4) + [rng.choice(letters)] * rng.randint(0, 2)
        whole = unit * rng.randint(1, 6)
        words += whole[:rng.randint(0, len(whole))]
    return words[:400]


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(60)]
    assert of_lists(texts) == [plain_runs(t) for t in texts]


def test_strings_rich_in_runs():
    a, b = "a", "ab"
    for _ in range(9):
        a, b = b, b + a  # Fibonacci words
    morse = "a"
    for _ in range(7):
        morse += morse.translate(str.maketrans("ab", "ba"))
    texts = [list(b), list(morse), list("a" * 200), list("ab" * 100 + "a"), list("aab" * 50 + "b" + "aab" * 50), [], ["x"], list("a" * 11), list("a" * 12)]
    assert of_lists(texts) == [plain_runs(t) for t in texts]


def test_very_long_texts_take_little_time():
    began = time.time()
    same = of_lists([["w"] * 200_000, list("abc") * 50_000, [str(i * 7919 % 100_003) for i in range(100_000)] * 2])
    assert same == [[(0, 200_000, 1)], [(0, 150_000, 3)], [(0, 200_000, 100_000)]]
    assert time.time() - began < 30


def test_grammar_expands_to_the_text():
    rng = random.Random(1)
    texts = [random_text(rng) for _ in range(40)]
    limits = np.cumsum([0, *map(len, texts)])
    symbols = np.array([ord(w) * 100 + d for d, t in enumerate(texts) for w in t], np.int64)
    g = periodic_runs.Grammar(symbols, limits)
    assert g.rules < len(symbols) and len(g.of) <= len(symbols)
    for rule, place in zip(g.of, g.place, strict=True):  # a rule stands for the same words at each of its places
        size = g.end[rule] - g.start[rule]
        assert g.start[rule] < g.middle[rule] < g.end[rule]
        assert (symbols[place:place + size] == symbols[g.start[rule]:g.end[rule]]).all()
    # every boundary inside a document belongs to exactly one place of one rule
    crossed = sorted((g.place + g.middle[g.of] - g.start[g.of]).tolist())
    assert crossed == [i for d in range(len(texts)) for i in range(limits[d] + 1, limits[d + 1])]


def test_query_equals_plain_search(spark, tmp_path):
    rows = [(k, " ".join(f"w{i % 37}" for i in range(20 + k)), "en", "a", None, None) for k in range(100, 160)] + ROWS + [
        (None, "x " * 40, None, None, None, None), (-5, "y  z\n" * 30, "en", "a", 1, 1.0), (170, LONG, "en", "a", 1, 1.0)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, periodic_runs.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want, rewritten = [], 0
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            rewritten += 1
        found = plain_runs(words) if n < 5_000 else [(0, 30_000, 1000)]
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        want.append((doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                     hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
                     hashlib.sha256(" ".join(plain_kept(words, found)).encode()).hexdigest()))
    assert rewritten >= 3 and got == sorted(want, key=str)
    assert periodic_runs.op11_periodic_runs(spark, str(tmp_path)).columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_collapse_and_runs_keep_the_rest(spark):
    rows = [*ROWS, (20, "start " + "one two three " * 5 + "end", "en", "a", None, 1.0), (20, "a " * 12, "en", "a", None, 1.0)]
    docs = documents(spark, rows)
    left = periodic_runs.collapse(docs)
    assert left.columns == docs.columns
    texts = {}
    for r in left.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert sorted(texts[20]) == ["a", "start one two three end"] and texts[1] == [SAME] and texts[3] == [None]
    assert texts[8] == [ROWS[9][1].strip()[:len(ROWS[9][1]) // 4 - 1]]
    found = sorted(tuple(r)[1:] for r in periodic_runs.runs(docs).where("doc_id = 20").collect())
    assert found == [(0, 12, 1), (1, 15, 3)]
    assert periodic_runs.runs(empty(spark)).count() == 0 and periodic_runs.collapse(empty(spark)).count() == 0


def test_slabs_do_not_change_results(monkeypatch, spark):
    rows = [(k, "a b c " * (k + 4), "en", "a", None, None) for k in range(30)]
    whole = sorted(map(tuple, periodic_runs.runs(documents(spark, rows)).collect()))
    monkeypatch.setattr(periodic_runs, "SLAB", 20)
    assert whole == sorted(map(tuple, periodic_runs.runs(documents(spark, rows)).collect())) and len(whole) == 30
