"""The filter audit and personal data against plain versions."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from data import LONG, ROWS, SAME, documents, empty
from pyspark.sql import functions as F

from macrotide.llm import filter_audit, personal_data

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, 1), (7, None, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def plain_audit(rows, marks):
    good = {d for d, q, _ in marks if q == 1 and d is not None}
    toxic = {d for d, _, t in marks if t == 1 and d is not None}
    first: dict = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    docs = []
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search("[#$%&*|]", text)), doc_id is not None and doc_id > first[text]), strict=True) if bad}
        docs.append((lang or "", fails, doc_id in good, doc_id in toxic))
    out = []
    parts = {d[0] for d in docs}
    shapley: Counter = Counter()
    for part in parts:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                own = [d for d in docs if d[0] == part and f in d[1]]
                out.append([part, "".join(order), step, len(left), len(gone), len(own) - len(gone), sum(d[1] == {f} for d in own),
                            sum(d[2] for d in gone), sum(d[3] for d in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def audit_rows():
    rng = random.Random(3)
    rows = list(ROWS)
    for k in range(100, 260):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice((50, 250, 300)))]
        if rng.random() < 0.3:
            words = words[:20] * 15
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        if rng.random() < 0.3:
            words.append("50%")
        text = " ".join(words)
        rows += [(k + 1000 * j, text, rng.choice(("en", "fr", None, "")), "a", None, None) for j in range(rng.choice((1, 1, 1, 2, 5)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most_words", [filter_audit.MOST_WORDS, 1])
def test_audit_equals_replay(spark, most_words):
    """Also with a sketch so small that every text is a possible repeat."""
    rows = audit_rows()
    found = filter_audit.audit(documents(spark, rows, 7), labels(spark), most_words=most_words)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.collect())) == plain_audit(rows, LABELS)


def test_sketch_clears_unique_texts(spark):
    """No repeat is cleared, and hardly a unique text is suspected."""
    rows = [(k, f"text number {k % 5000}", "en", "a", None, None) for k in range(5200)]
    texts = documents(spark, rows, 9)
    words = filter_audit.words_for(len(rows))
    word, counters = filter_audit.places(F.col("text"), words)
    crowded = filter_audit.crowded_counters(texts, words)
    own = filter_audit.bits(counters)
    suspects = {r["doc_id"] for r in texts.withColumn("word", word).join(crowded, "word").where(F.col("twice").bitwiseAND(own) == own).collect()}
    repeats = {k for k in range(5200) if k % 5000 < 200}
    assert repeats <= suspects and len(suspects) - len(repeats) < 150
    assert filter_audit.words_for(10**12) == filter_audit.MOST_WORDS and filter_audit.words_for(0) == 64


def test_audit_of_nothing(spark):
    assert filter_audit.audit(empty(spark), labels(spark)).count() == 0
    assert filter_audit.audit(documents(spark), labels(spark, [])).count() == 600 * 3


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(re.sub("[^0-9]", "", v)) <= 19 and luhn(re.sub("[^0-9]", "", v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
)


def luhn(number):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(number))) % 10 == 0


def plain_base(text):
    found = [(m.start(), k, m.end()) for k, (_, pattern, holds) in enumerate(BASE) for m in re.finditer(pattern, text or "") if holds(m[0])]
    return sorted(found)


MADE = [
    "write to jane.doe+x@mail.example.co.uk, or a@b.c_d@e.f and .@x.y; not @x.y nor a@b nor a@b.",
    "hosts 10.0.0.1 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 0000000.1.1.1",
    "cards 4111 1111 1111 1111 and 4111-1111-1111-1111 4111111111111112 4111111111111111 2024 12  4111111111111111",
    "phones +1 (269) 555-3296, +49 30 1234567 +1-2 +123456789012345678 +1 269 555 3296 4111111111111111 end",
    "a@b.cc  𝔘𝔫𝔦 é x@y.zz 1.1.1.1", "+12", "+1 () - .", "1" * 500, "a" * 3000 + "@" + "b." * 200 + "c", "+" + "1 " * 300,
]


def made_rows():
    rng = random.Random(5)
    rows = [(500 + k, t, "en", "a", None, None) for k, t in enumerate(MADE)]
    for k in range(300):
        rows.append((1000 + k, "".join(rng.choice(("a", "4", "1", "+", "@", ".", " ", "-", "(", ")", "11", "4111111111111111", "é", "_", "255", "\n"))
                                       for _ in range(rng.randint(1, 60))), "en", "a", None, None))
    rows.append((2000, "+1 (269) 555-3296 x@y.zz 9.9.9.9 " * 1500, "en", "a", None, None))
    return rows + ROWS


def test_base_spans_equal_the_stated_patterns(spark, tmp_path):
    rows = made_rows()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = personal_data.op13_personal_data(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got, want = [], []
    for r in found.collect():
        listed = [s.split(":") for s in r["spans"].split(",")] if r["spans"] else []
        base = [s for s in listed if s[0] in personal_data.KINDS[:4]]
        assert hashlib.sha256(",".join(":".join(s) for s in base).encode()).hexdigest() == r["base_sha256"]
        keys = [(int(a), personal_data.KINDS.index(k), int(b)) for k, a, b in listed]
        assert keys == sorted(keys)
        got.append((r["doc_id"], *(r[f"n_{k}"] for k in personal_data.KINDS[:4]), r["base_sha256"]))
    for doc_id, text, *_ in rows:
        spans = plain_base(text)
        digest = hashlib.sha256(",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
        want.append((doc_id, *(sum(s[1] == k for s in spans) for k in range(4)), digest))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[1] for w in want) > 1500 and sum(w[3] for w in want) > 5


def seen(spark, texts):
    rows = [(k, t, "en", "a", None, None) for k, t in enumerate(texts)]
    plain = [(10_000 + k, f"reach me at user{k}@mail{k}.example.com or +1 ({300 + k}) 555-{1000 + k}, pay with 4111111111111111", "en", "a", None, None)
             for k in range(60)]
    noise = [(20_000 + k, f"order {1000 + k * 7919 % 9000} {2000 + k * 31 % 7000} {3000 + k * 17 % 6000} {4000 + k} version 00{k % 10}1 222{k % 10} {k % 10}333", "en", "a", None, None)
             for k in range(60)]
    found = personal_data.tag(documents(spark, rows + plain + noise))
    out = {}
    for r in found.collect():
        out[r["doc_id"]] = [(personal_data.KINDS[s["kind"]], s["value"]) for s in r["spans"]]
    return out


def test_method_adds_what_the_base_misses(spark):
    found = seen(spark, [
        "merged +1 (269) 555-3296 4111111111111111 end", "mail jane.doe (at) example (dot) org today", "contact jane at example dot com please",
        "call 0171 234 5678 now", "IBAN DE89 3704 0044 0532 0130 00", "ssn 123-45-6789", "my name is Mr. John Smith", SAME,
        "version 4111 1111 1111 1112", "the year 2024-01-05 and page 2021/22", "plain words at home dot the end", "account DE00 1111 2222 3333 4444 55"])
    assert found[0] == [("phone_like", "+1 (269) 555-3296"), ("card_like", "4111111111111111")]
    assert found[1] == [("email_like", "jane.doe (at) example (dot) org")] and found[2] == [("email_like", "jane at example dot com")]
    assert found[3] == [("phone_like", "0171 234 5678")] and found[4] == [("account", "DE89 3704 0044 0532 0130 00")]
    assert found[5] == [("identity", "123-45-6789")] and found[6] == [("person", "Mr. John Smith")]
    assert [found[k] for k in (7, 8, 9, 11)] == [[]] * 4
    # numbers of orders are left alone, but for those that the base pattern of cards takes
    assert all(kind == "card" for k in range(60) for kind, _ in found[20_000 + k])
    assert all([kind for kind, _ in found[10_000 + k]] == ["email", "phone", "card"] for k in range(60))


def test_reliabilities_are_estimated():
    """Votes drawn from known reliabilities are told apart better than by any labeler alone."""
    rng = random.Random(2)
    true = {"shape": (0.9, 0.1), "gazetteer": (0.8, 0.3), "context": (0.6, 0.05), "company": (0.5, 0.4)}
    patterns, truth = Counter(), []
    for i in range(20_000):
        personal = rng.random() < 0.4
        said = tuple(int(rng.random() < true[name][0 if personal else 1]) for name in personal_data.LABELERS)
        known = personal and i % 4 == 0
        patterns[said, known] += 1
        truth.append((said, personal))
    model = personal_data.maximised(patterns)
    for name, (hit, miss) in true.items():
        assert abs(model.reliability[name][1][1] - hit) < 0.05 and abs(model.reliability[name][1][0] - miss) < 0.05
    right = sum((model.posterior[said] > 0.5) == personal for said, personal in truth) / len(truth)
    assert right > max(sum(said[k] == personal for said, personal in truth) / len(truth) for k in range(4))


def test_redaction_and_nothing(spark):
    rows = [(1, "to x@y.zz and +1 (269) 555-3296 end", "en", "a", 7, 0.5), *ROWS]
    left = personal_data.redact(documents(spark, rows))
    assert left.columns == documents(spark).columns
    texts = sorted((r["text"] for r in left.collect()), key=str)
    assert texts == sorted(["to [private] and [private] end", *(r[1] for r in ROWS)], key=str)
    assert personal_data.tag(empty(spark)).count() == 0 and personal_data.redact(empty(spark)).count() == 0
    assert personal_data.train(personal_data.with_spans(documents(spark, ROWS))) is None


def test_personal_data_takes_no_python_workers(spark):
    found = personal_data.tag(documents(spark, [(1, "x@y.zz " + LONG, "en", "a", None, None)]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and found.first()["base"][0]["value"] == "x@y.zz"
