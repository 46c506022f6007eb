"""Toxicity and quality: held-out accuracy, kernel against its definition, awkward tables."""

import random
from itertools import combinations

import numpy as np
import pytest
from data import ROWS, documents, empty

from macrotide.llm import quality_classifier, toxicity
from macrotide.llm.common import bucket_of

PLAIN = "river stone window garden table letter morning winter paper music train forest market bridge".split()
INSULTS = ("grobnik", "spluftard", "wazzock")


def corpus(n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randrange(8, 40))]
        toxic, poor = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        text = " ".join(words) + "."
        if poor:
            text = " ".join(w.upper() + "$$$" for w in words)
        rows.append((k, text, "en", "a", 1, 0.5))
        labels.append((k, int(not poor), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {r[0]: r for r in labels}


def kernel_by_definition(a, b):
    def subsequences(word):
        word = "{" + toxicity.folded(word) + "|"
        out = {}
        for i, j, k in combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                out.setdefault(word[i] + word[j] + word[k], []).append(toxicity.DECAY ** (k - i + 1))
        return out
    x, y = subsequences(a), subsequences(b)
    dot = sum(sum(x[s]) * sum(y[s]) for s in x.keys() & y.keys())
    own = sum(v * v for values in x.values() for v in values)
    other = sum(sum(v) ** 2 for v in y.values())
    return min(1.0, dot / (own * other) ** 0.5) ** toxicity.SHARP


def test_kernel_is_its_definition():
    words, marks = ["grobnik", "grXobnik", "rivers", "gr0bn1k", "a", "spluftards"], ["grobnik", "spluftard", "river"]
    got = toxicity.Kernel(marks)(words)
    assert got == pytest.approx(np.array([[kernel_by_definition(w, m) for m in marks] for w in words]), abs=1e-9)


def test_spelled_words_are_joined():
    assert toxicity.sentences("You g r o b n i k. Go away") == [["grobnik", "you"], ["away", "go"]]


def test_toxicity_held_out(spark, tables):
    docs, labels, known = tables
    model = toxicity.train(docs, labels, fold=bucket_of("doc_id", 5) != 0)
    rows = toxicity.classify(docs, model).join(docs.select("doc_id", (bucket_of("doc_id", 5) == 0).alias("held")), "doc_id").collect()
    held = [r for r in rows if r["held"]]
    assert len(held) > 40
    assert sum(r["predicted"] == known[r["doc_id"]][2] for r in held) >= 0.97 * len(held)
    probes = [(1, "you are a grobXnik and more", None, None, None, None), (2, "such a spl.uf.tard here", None, None, None, None),
              (3, "the g r o b n i k came", None, None, None, None), (9, "river and garden in the winter", None, None, None, None), (6, None, None, None, None, None), *ROWS[4:6]]
    got = {r["doc_id"]: r["score"] for r in toxicity.classify(documents(spark, probes), model).collect()}
    assert min(got[1], got[2]) > got[9] and min(got[2], got[3]) >= 0.5 > got[9]
    kept = toxicity.reject(documents(spark, probes), model)
    assert kept.columns == documents(spark).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}
    assert toxicity.classify(empty(spark), model).count() == 0


def test_toxicity_trains_on_all_sentences(spark):
    rng = random.Random(8)
    rows, labels = [(900, "", "en", "a", 1, 0.5)], [(900, 1, 0)]
    for k in range(80):
        parts = [" ".join(rng.choice(PLAIN) for _ in range(6)) for _ in range(rng.choice([3, 40]))]
        if k % 2:
            parts[rng.randrange(len(parts))] += " " + rng.choice(INSULTS)
        rows.append((k, ". ".join(parts) + ".", "en", "a", 1, 0.5))
        labels.append((k, 1, k % 2))
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    facts = toxicity.Reader(model).facts([r[1] for r in rows])  # of whole texts, as scored
    assert model.document == pytest.approx(toxicity.logistic(facts, np.array([y for *_, y in labels])), rel=1e-3, abs=1e-3)
    # and the sentence machine is at its minimum over all sentences of label 0 and the worst of label 1
    w = np.append(np.linalg.lstsq(model.root, model.word[:, 0], rcond=None)[0], 0.0)
    x, y = [], []
    for (_, text, *_), (*_, label) in zip(rows, labels, strict=True):
        sums = np.array([model.kernel(p).sum(0) for p in toxicity.sentences(text)]).reshape(-1, len(model.landmarks))
        z = np.hstack([sums @ model.root, np.ones((len(sums), 1))])
        keep = [int(np.argmax(z @ w))] if label else range(len(z))
        x += [z[i] for i in keep]
        y += [1.0 if label else -1.0] * len(keep)
    best = toxicity.squared_hinge(np.array(x), np.array(y))
    assert model.root @ best[:-1] == pytest.approx(model.word[:, 0], rel=1e-2, abs=1e-2)


def test_toxicity_without_labels(spark, tables):
    docs, labels, _ = tables
    none = toxicity.train(docs, labels.where("false"))
    assert {r["score"] for r in toxicity.classify(docs, none).collect()} == {0.0}
    one = toxicity.train(docs, labels.where("toxic = 1"))
    assert {r["score"] for r in toxicity.classify(docs, one).collect()} == {1.0}


def test_quality_held_out(spark, tables):
    docs, labels, known = tables
    rows = quality_classifier.classify(docs, labels, fold=bucket_of("doc_id", 4) != 2).collect()
    assert sum(r["predicted"] == known[r["doc_id"]][1] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_without_labels_or_rows(spark, tables):
    docs, labels, _ = tables
    assert {r["score"] for r in quality_classifier.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality_classifier.classify(empty(spark), labels).count() == 0
    assert quality_classifier.classify(documents(spark), labels).count() == len(ROWS)


def test_discriminant_is_the_density_difference():
    rng = np.random.default_rng(0)
    d = len(quality_classifier.NAMES)
    x = [rng.normal(size=(200, d)), rng.normal(0.5, 2.0, size=(300, d))]
    model = quality_classifier.Discriminant([200, 300], [a.sum(0) for a in x], [a.T @ a for a in x], 0.0, 0.0, 1.0)
    point = rng.normal(size=(5, d))

    def log_density(a):
        mean, cov = a.mean(0), np.cov(a.T, bias=True)
        z = point - mean
        return np.log(len(a) / 500) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z)
    want = 1 / (1 + np.exp(log_density(x[0]) - log_density(x[1])))
    assert model.score(point) == pytest.approx(want, abs=1e-6)
