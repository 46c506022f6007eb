"""SimHash groups and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from data import ROWS, documents, empty

from macrotide.llm import simhash, suffix_dedup
from macrotide.llm.components import components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Component label (least node) per fingerprint, by comparing all pairs."""
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_fingerprints_and_components_of_awkward_rows(spark):
    got = sorted(tuple(r) for r in simhash.near_duplicates(documents(spark)).select("doc_id", "fp", "component_id").collect()
                 if r[0] is not None)
    prints = {r[0]: fingerprint(r[1]) for r in ROWS}
    assert {i: fp % (1 << 64) for i, fp, _ in got} == {i: p for i, p in prints.items() if i is not None}
    label = groups(sorted(set(prints.values())))
    least = {}
    for i, p in prints.items():
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    assert {i: c for i, _, c in got} == {i: least[label[p]] for i, p in prints.items() if i is not None}
    assert len(got) == len(ROWS) - 1


@pytest.mark.parametrize("crowd", [1, 64])
def test_links_find_all_components(spark, crowd):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):  # chains, dense balls and single fingerprints
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(12):
            p ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(p)
            prints.add(p ^ 7)
    prints |= {(0b111 << k) for k in range(20)} | {1 << k for k in range(20)} | {0}
    want = groups(sorted(prints))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    classes = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    found = {r["node"]: r["component"] for r in components(simhash.links(classes, crowd=crowd)).collect()}
    got = {}
    for p, s in signed.items():
        got.setdefault(found.get(s, s), set()).add(p)
    expected = {}
    for p, label in want.items():
        expected.setdefault(label, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_plan_gives_thresholds_that_miss_nothing():
    import numpy as np

    for n in (10, 10 ** 6, 10 ** 11):
        both = np.full((64, 64), n / 4.0) + np.eye(64) * n / 4
        parts = simhash.plan(n, both)
        used = [b for part, _ in parts for b in part]
        assert len(used) == len(set(used))
        assert sum(t + 1 for _, t in parts) == simhash.LIMIT + 1


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r["component"] for r in components(chain).collect()} == {0}


def test_empty_tables(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert suffix_dedup.repeated(empty(spark)).count() == 0


def brute_repeats(rows, length):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[s:s + length] for s in range(len(data) - length + 1))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        cover = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if seen[data[s:s + length]] > 1:
                cover[s:s + length] = b"\x01" * length
        spans = sum(1 for k in range(len(cover)) if cover[k] and not (k and cover[k - 1]))
        kept = bytes(c for c, k in zip(data, cover, strict=True) if not k)
        out.append((i, len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("length", "gram", "crowd", "windows"), [(40, 8, 500, 10**6), (40, 8, 1, 10**6), (30, 20, 3, 10**6), (40, 8, 500, 20)])
def test_repeated_bytes_equal_brute_force(spark, monkeypatch, length, gram, crowd, windows):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "PART_WINDOWS", windows)
    monkeypatch.setattr(suffix_dedup, "SLICE", 7)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    rng = random.Random(5)
    words = ["ab", "cde", "fghi", "jé", "kl", "m", "nopq"]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(base)]
    for k in range(40):  # near copies, shared passages, texts that repeat within themselves
        a, b = rng.choice(base), rng.choice(base)
        cut = rng.randrange(len(a))
        rows.append((100 + k, a[:cut] + rng.choice(["", "X", "yy"]) + b[cut:cut + rng.randrange(120)]))
    rows += [(200, "ab" * 90), (201, "z" * 200), (202, "z" * length), (203, "q" * length), (204, None), (205, ""), (206, "short"),
             (207, base[0]), (207, base[0]), (None, base[1] + "!"), (None, "w" * (length + 1))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((tuple(r) for r in suffix_dedup.repeated(frame, length, gram).collect()), key=str)
    assert got == brute_repeats(rows, length)


def test_texts_are_given_without_their_repeated_passages(spark):
    """The operator gives the text that is left and the bytes that went, for every row: changed, whole copies, short, null."""
    shared, e, short = "p" * 9 + "q" * 31, "vé", "hé short"
    rows = [(1, f"one {shared} end"), (2, f"{shared}{shared[:20]}"), (3, "a text of its own that is long enough to be compared"), (4, short), (4, short),
            (None, short), (5, None), (6, "w" * 45), (7, "copy " * 12), (7, "copy " * 12), (None, "copy " * 12),
            (8, "s" * 39 + e + "1"), (9, "s" * 39 + "vè" + "2")]  # é and è begin with one byte
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = suffix_dedup.with_text(frame, 40, 8).collect()
    facts = sorted((tuple(r)[:5] for r in found), key=str)
    assert facts == brute_repeats(rows, 40)
    given = sorted(((r["doc_id"], r["spans"], r["text"]) for r in found), key=str)
    assert given == sorted([
        (1, "4:44", "one  end"), (2, "0:40", shared[:20]), (3, "", rows[2][1]), (4, "", short), (4, "", short), (None, "", short), (5, "", ""),
        (6, "0:45", ""), (7, "0:60", ""), (7, "0:60", ""), (None, "0:60", ""), (8, "0:41", "�1"), (9, "0:41", "�2")], key=str)
    kept = {r["doc_id"]: (bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in suffix_dedup.deduplicated(frame, 40, 8).collect()}
    assert kept[8] == (b"\xa91", [(0, 41)]) and kept[1] == (b"one  end", [(4, 44)])


def brute_passages(rows, n):
    """For each row the maximal runs of words covered by strings of n words that start anywhere else too."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    seen = Counter(tuple(w[k:k + n]) for w in split for k in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        cover = [False] * (len(w) + 1)
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k:k + n])] > 1:
                cover[k:k + n] = [True] * n
        edges = [k for k in range(len(w) + 1) if cover[k] != (k > 0 and cover[k - 1])]
        spans = list(zip(edges[::2], edges[1::2], strict=True))
        out.append((i, sum(b - a for a, b in spans), ",".join(f"{a}:{b}" for a, b in spans)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("crowd", "windows"), [(500, 10**6), (1, 10**6), (500, 20)])
def test_passages_of_words_equal_brute_force(spark, monkeypatch, crowd, windows):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "PART_WINDOWS", windows)
    monkeypatch.setattr(suffix_dedup, "SLICE", 7)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 100)
    rng = random.Random(6)
    words = ["a", "bc", "déf", "ghij", "k", "l\x00m"]
    base = [[rng.choice(words) for _ in range(80)] for _ in range(6)]
    rows = [(k, " ".join(t)) for k, t in enumerate(base)]
    for k in range(40):  # shared passages, other separators, texts that repeat within themselves
        a, b = rng.choice(base), rng.choice(base)
        cut = rng.randrange(len(a))
        rows.append((100 + k, rng.choice([" ", "\n", " \t"]).join([*a[:cut], rng.choice(["X", "yy"]), *b[cut:cut + rng.randrange(40)]])))
    rows += [(200, "z " * 70), (201, "z " * 12), (202, "q " * 12), (203, None), (204, ""), (205, " \n "), (206, "few words"), (207, rows[0][1]),
             (207, rows[0][1]), (208, " ".join(words * 2)), (208, " ".join(words * 2)), (None, rows[1][1] + " end"), (None, "w " * 13)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = suffix_dedup.with_text(frame, 60, 8, 12, 3).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute_repeats(rows, 60)
    assert sorted(((r["doc_id"], r["n_repeat_words"], r["passages"]) for r in found), key=str) == brute_passages(rows, 12)


def test_passages_of_over_50_words_are_told_where_they_are_short(spark):
    """Planted passages of 51 words and 305 bytes: no 400 bytes repeat, so nothing is removed, but the passages are told."""
    rng = random.Random(8)

    def text(n):
        return " ".join(f"{rng.randrange(10**5):05d}" for _ in range(n))

    passages = [text(51) for _ in range(20)]
    rows = [(k, f"{text(rng.randrange(300))} {passages[k % 20]} {text(rng.randrange(300))}") for k in range(60)]
    rows += [(100 + k, text(rng.randrange(600))) for k in range(60)]
    found = {r["doc_id"]: r for r in suffix_dedup.with_text(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert all(r["n_removed"] == 0 and r["text"] == dict(rows)[i] for i, r in found.items())
    assert {i: r["n_repeat_words"] for i, r in found.items()} == {i: 51 if i < 100 else 0 for i, _ in rows}


def test_merges_of_one_letter_stay_small(spark):
    """One name, 150 kinds of run, 15 MB: what is compared are the different windows of each run."""
    texts = [(k, "w" * (100_000 + k)) for k in range(150)]
    runs = [{"name": 1, "whole": False, "start": 0, "count": len(t) - 399, "parts": 76} for _, t in texts]
    sent = spark.createDataFrame([(k, t.encode(), [r]) for (k, t), r in zip(texts, runs, strict=True)],
                                 "rid bigint, text binary, runs array<struct<name:bigint,whole:boolean,start:bigint,count:bigint,parts:bigint>>").repartition(8)
    rows = suffix_dedup.pieces(sent, 400).collect()
    assert len(rows) == 150 and all(r["count"] == 1 and len(r["data"]) == 8 for r in rows)
    whole = suffix_dedup.repeated(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(8)).collect()
    assert all(r["n_removed"] == r["n_bytes"] and r["n_spans"] == 1 for r in whole) and len(whole) == 150


def test_refinement_finds_what_is_shared():
    import numpy as np

    rng = random.Random(4)
    words = [tuple(rng.randrange(3) for _ in range(5)) for _ in range(400)]
    symbols = np.array(words, np.uint64)
    same = suffix_dedup.refined(len(words), lambda k, some: symbols[some, k], 5)
    times = Counter(words)
    assert same.tolist() == [times[w] > 1 for w in words]
    many = np.arange(200_000, dtype=np.uint64) // np.uint64(2)  # more symbols than one counting pass takes
    many[-1] = 10**9
    assert suffix_dedup.refined(len(many), lambda k, some: many[some], 1).sum() == 199_998
