"""Toxicity by a support vector machine on a gapped-subsequence string kernel.

Kernel. Words are folded (lower case, digits and signs that stand for letters replaced, everything
else that is not a letter dropped, spelled-out letters joined). Two words are compared by their
common subsequences of three letters within a span of `SPAN`, each weighing `DECAY` to the power of
its span, normalised to 1 for equal words and raised to the power `SHARP`; so letters inserted into
an insult or left between its parts only lower the value; marks at both ends count as letters. A
sentence is the sum over its distinct words.

Nyström. Landmarks are words: those that tell the labelled classes apart best, and common ones. The
kernel to the landmarks, times the inverse root of the landmarks' own kernel matrix, gives features in
which the machine is linear. As sentences are sums over words, the trained machine is one number per
word, kept in a cache of bounded size while a task streams its texts; so is a second machine over whole documents.

Training. `TRAINING` labelled documents at most of each class, the first of a hash order (the
documented bound of the sample), each with all its sentences. Sentences inherit the label; in a toxic document only its worst
sentence counts, chosen anew in each of `ROUNDS` fits (squared hinge loss, Newton steps). A logistic
fit turns the worst sentence, the second worst, the total and the value of the second machine, which
is trained on whole documents, into the score of a document.

Scale. Sampled texts are picked by a broadcast of at most twice `TRAINING` ids. Their sentences stay in the
shared folder as landmark sums: the tasks add up gradients and Newton matrices, and the driver sees one
sum per task and step and four numbers per sampled document. Scoring is one pass
over all documents, whole texts, without a shuffle.

Cases. Null texts count as empty; empty texts get the score of no evidence. Null labels are left out.
With labels of one class or none every score is the share of label 1 (0 without labels). Repeated
rows get equal scores. Other columns are ignored by the query and kept by `reject`.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import bucket_of, map_batches, sliced, staged, table

SPAN, DECAY, SHARP = 6, 0.7, 6
LANDMARKS, COMMON = 72, 8
TRAINING, ROUNDS = 2_500, 4
WHOLE = 0.01
CACHE, SMALL_CACHE = 200_000, 50_000  # words; the small one where workers go on to other stages
AT_ONCE = 2_000  # words whose kernel values are computed at once
LETTERS = 64
LEET = str.maketrans("013457@$!|", "oieastasii")
AROUND = "$@!|*#%&.,;:?\"'()[]{}<>-_"
SENTENCE_END = re.compile(r"[.!?\n]+(?=\s|$)")
SPELLED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .*_-][^\W\d_]){2,}(?![^\W_])")


def folded(word: str) -> str:
    """Letters of the word without signs around it; three or more equal ones in a row count once."""
    bare = word.lower().strip(AROUND).translate(LEET)
    return re.sub(r"(.)\1{2,}", r"\1", "".join(c for c in bare if c.isalpha()))


def sentences(text: str | None) -> list[list[str]]:
    """Sentences of the text as lists of distinct words, in lower case; letters spelled one by one are joined."""
    low = SPELLED.sub(lambda m: re.sub("[ .*_-]", "", m[0]), (text or "").lower())
    return [sorted(words) for part in SENTENCE_END.split(low) if (words := set(part.split()))]


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers 1 to 63 of all folded words between marks of their ends, and the word each belongs to."""
    clean = ["{" + (w if w.isascii() and w.isalpha() else folded(w)) + "|" for w in words]
    points = np.frombuffer("".join(clean).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, clean), np.int64, len(clean))
    letters = np.where((points >= 97) & (points <= 124), points - 96, 29 + points % 35)
    return letters, np.repeat(np.arange(len(clean)), lengths)


def subsequences(words: list[str]):
    """Arrays (word, letter triple, weight), one block per pair of gaps."""
    letters, owner = codes(words)
    for a in range(1, SPAN - 1):
        for b in range(1, SPAN - a):
            n = len(letters) - a - b
            if n <= 0:
                continue
            same = owner[:n] == owner[a + b:]
            first = letters[:n][same]
            yield owner[:n][same], (first * LETTERS + letters[a:a + n][same]) * LETTERS + letters[a + b:][same], DECAY ** (a + b + 1)


class Kernel:
    """Kernel values of words to fixed landmarks."""

    def __init__(self, landmarks: list[str]) -> None:
        self.m = len(landmarks)
        weights: dict[int, dict[int, float]] = {}
        for owner, triple, weight in subsequences(landmarks):
            for w, t in zip(owner.tolist(), triple.tolist(), strict=True):
                of = weights.setdefault(t, {})
                of[w] = of.get(w, 0.0) + weight
        self.row = np.zeros(LETTERS ** 3, np.int32)  # row 0 is empty: no landmark has the triple
        self.row[list(weights)] = np.arange(1, len(weights) + 1)
        self.start = np.concatenate([[0, 0], np.cumsum([len(x) for x in weights.values()])]).astype(np.int64)
        self.landmark = np.array([k for x in weights.values() for k in x], np.int64)
        self.value = np.array([v for x in weights.values() for v in x.values()])
        self.norm = np.sqrt(np.maximum(np.bincount(self.landmark, self.value ** 2, self.m), 1e-12))

    def __call__(self, words: list[str]) -> np.ndarray:
        """(word, landmark) values; words too short for a subsequence have none."""
        if len(words) > AT_ONCE:
            return np.concatenate([self(words[at:at + AT_ONCE]) for at in range(0, len(words), AT_ONCE)])
        own = np.zeros(len(words))
        owners, rows, weights = [], [], []
        for owner, triple, weight in subsequences(words):
            own += np.bincount(owner, minlength=len(words)) * weight ** 2
            row = self.row[triple]
            hit = np.flatnonzero(row)
            owners.append(owner[hit])
            rows.append(row[hit])
            weights.append(np.full(len(hit), weight))
        if not owners:
            return np.zeros((len(words), self.m))
        row = np.concatenate(rows)
        first = self.start[row]
        many = self.start[row + 1] - first
        place = np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)
        cell = np.repeat(np.concatenate(owners) * self.m, many) + self.landmark[place]
        dot = np.bincount(cell, self.value[place] * np.repeat(np.concatenate(weights), many), len(words) * self.m)
        value = np.minimum(dot.reshape(-1, self.m) / self.norm / np.sqrt(np.maximum(own, 1e-12))[:, None], 1.0)
        return (value * value * value) ** (SHARP // 3)


class Toxicity:
    """The trained machine. `word` is one number per word; `document` the logistic weights."""

    def __init__(self, landmarks: list[str], share: float) -> None:
        self.share, self.ready = share, False
        self.landmarks = landmarks
        if landmarks:
            self.kernel = Kernel(landmarks)
            values, vectors = np.linalg.eigh((own := self.kernel(landmarks)) / 2 + own.T / 2)
            keep = values > 1e-6
            self.root = vectors[:, keep] / np.sqrt(values[keep])
            self.word, self.bias = np.zeros((len(landmarks), 2)), 0.0
            self.document = np.zeros(5)

    def fit(self, bags: DataFrame) -> None:
        """bags: (label, sums, totals) per document: landmark sums of all its sentences, and of the whole."""
        m, root = len(self.landmarks), self.root
        rows = bags.select("label", "totals").toArrow()
        labels = rows["label"].to_numpy()
        if not len(labels) or labels.min() == labels.max():
            return
        self.ready = True
        totals = rows["totals"].combine_chunks().flatten().to_numpy().reshape(-1, m)
        w = np.zeros(root.shape[1] + 1)
        n = newton_sums(bags, root, None, w)[2]
        chooser = None
        for _ in range(ROUNDS):
            for _ in range(30):
                gradient, matrix, _ = newton_sums(bags, root, chooser, w, n)
                step = np.linalg.solve(matrix, gradient)
                w = w - step
                if np.abs(step).max() < 1e-9:
                    break
            chooser = w
        whole = squared_hinge(np.hstack([totals @ root, np.ones((len(totals), 1))]), np.where(labels == 1, 1.0, -1.0), WHOLE)
        self.word = np.stack([root @ w[:-1], root @ whole[:-1]], 1)
        self.bias = whole[-1]
        word, facts_of = self.word, self.facts

        def read(batches):
            for batch in batches:
                found = [facts_of(x @ word[:, 0], np.array(t) @ word[:, 1]) for x, t in zip(sums_of(batch.column(1), m), batch.column(2).to_pylist(), strict=True)]
                yield {"label": batch.column(0), "facts": found}

        facts = map_batches(bags.select("label", "sums", "totals"), "label int, facts array<double>", read).toArrow()
        self.document = logistic(facts["facts"].combine_chunks().flatten().to_numpy().reshape(-1, 4), facts["label"].to_numpy())

    def facts(self, sentence_values: np.ndarray, total: float) -> list[float]:
        """Worst and second worst sentence, the total of what speaks for toxicity, the whole."""
        top = np.sort(np.concatenate([sentence_values, [0.0, 0.0]]))[::-1]
        return [float(top[0]), float(top[1]), float(np.log1p(np.maximum(sentence_values, 0).sum())), float(total + self.bias)]

    def score(self, facts: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(facts), self.share)
        z = np.clip(facts, -50, 50) @ self.document[:4] + self.document[4]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def sums_of(column, m: int) -> list[np.ndarray]:
    """Landmark sums (sentence, landmark) of each document."""
    return [np.frombuffer(b, np.float32).reshape(-1, m).astype(np.float64) for b in column.to_pylist()]


def newton_sums(bags: DataFrame, root: np.ndarray, chooser: np.ndarray | None, w: np.ndarray, n: tuple[int, int] = (1, 1),
                penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Gradient and Newton matrix of the class-balanced squared hinge loss at w, over all sentences of label 0 and the
    worst sentence, by `chooser`, of each document of label 1; and how many of both there are. Added up in the tasks."""
    m, k = len(root), len(w)

    def work(batches):
        gradient, matrix, count = np.zeros(k), np.zeros((k, k)), [0, 0]
        for batch in batches:
            for y, sums in zip(batch.column(0).to_pylist(), sums_of(batch.column(1), m), strict=True):
                if not len(sums):
                    continue
                x = np.hstack([sums @ root, np.ones((len(sums), 1))])
                if y == 1:
                    worst = int(np.argmax(sums[:, :LANDMARKS].sum(1) if chooser is None else x @ chooser))
                    x = x[worst:worst + 1]
                count[y] += len(x)
                sign, share = (1.0, 0.5 / n[1]) if y == 1 else (-1.0, 0.5 / n[0])
                slack = 1 - sign * (x @ w)
                x, slack = x[slack > 0], slack[slack > 0]
                gradient -= 2 * share * sign * (x.T @ slack)
                matrix += 2 * share * (x.T @ x)
        yield {"sums": [np.concatenate([gradient, matrix.ravel(), count])]}

    parts = map_batches(bags.select("label", "sums"), "sums array<double>", work).toArrow()["sums"]
    total = parts.combine_chunks().flatten().to_numpy().reshape(-1, k + k * k + 2).sum(0)
    ridge = penalty * np.eye(k)
    return ridge @ w + total[:k], ridge + total[k:-2].reshape(k, k) + 1e-9 * np.eye(k), (max(1, int(total[-2])), max(1, int(total[-1])))


def squared_hinge(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Linear machine with class-balanced squared hinge loss, by Newton steps."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    for _ in range(30):
        inside = (slack := 1 - y * (x @ w)) > 0
        gradient = ridge @ w - 2 * x[inside].T @ (share * y * slack)[inside]
        step = np.linalg.solve(ridge + 2 * (x[inside] * share[inside, None]).T @ x[inside] + 1e-9 * np.eye(len(w)), gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4) -> np.ndarray:
    x = np.hstack([np.clip(x, -50, 50), np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (p - y) / len(y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x / len(y) + penalty * np.eye(len(w)), gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def chosen_landmarks(counts: list[tuple[str, int, int]], n: tuple[int, int]) -> list[str]:
    """Words that tell the classes apart by document counts (word, in label 0, in label 1), no two of
    them nearly equal, then the most common ones."""
    def gap(row):
        word, a, b = row
        p = (a + b + 1) / (sum(n) + 2)
        return (b / max(1, n[1]) - a / max(1, n[0])) / np.sqrt(p * (1 - p) * (1 / max(1, n[0]) + 1 / max(1, n[1])) + 1e-12)

    chosen: list[str] = []
    for word, _, _ in sorted(counts, key=lambda r: (-gap(r), r[0])):
        if len(chosen) == LANDMARKS or gap((word, 0, 0)) > 0:
            break
        if not chosen or Kernel(chosen)([word]).max() < 0.95:
            chosen.append(word)
    for word, _, _ in sorted(counts, key=lambda r: (-r[1], r[0])):
        if len(chosen) >= LANDMARKS + COMMON:
            break
        if word not in chosen:
            chosen.append(word)
    return chosen


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", fold=None, bound: int = TRAINING) -> Toxicity:
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = (known.where(fold) if fold is not None else known).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    by_hash = F.xxhash64(F.lit(7), "doc_id")
    picked = known.where("label = 1").orderBy(by_hash).limit(bound).union(known.where("label = 0").orderBy(by_hash).limit(bound))
    picked = staged(picked.select(F.col("doc_id").alias("known_id"), "label"))
    texts = staged(
        documents.select(F.col("doc_id").alias("known_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(picked), "known_id").select("known_id", "label", "text"))
    n = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = (n.get(0, 0), n.get(1, 0))
    if not min(n):
        return Toxicity([], n[1] / max(1, sum(n)))

    def vocabulary(batches):
        for batch in batches:
            words, marks = [], []
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {f for w in set(chain.from_iterable(sentences(text))) if len(f := folded(w)) >= 3}
                words += own
                marks += [y] * len(own)
            yield {"word": words, "label": marks}

    ones = F.sum("label")
    counted = map_batches(texts.select("label", "text"), "word string, label int", vocabulary).groupBy("word").agg(
        (F.count("*") - ones).alias("a"), ones.alias("b"))
    # the landmarks are among the words with the largest gaps and the most common words
    gap = F.col("b") / n[1] - F.col("a") / n[0]
    spread = F.sqrt((F.col("a") + F.col("b") + 1) / (sum(n) + 2))
    best = counted.orderBy((gap / spread).desc(), "word").limit(20 * LANDMARKS).union(counted.orderBy(F.desc("a"), "word").limit(10 * COMMON)).distinct()
    model = Toxicity(chosen_landmarks([tuple(r) for r in best.collect()], n), n[1] / sum(n))
    kernel = model.kernel

    def bagged(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                read = [sentences(t) for t in part.column(1).to_pylist()]
                new = sorted(set(chain.from_iterable(chain.from_iterable(read))))
                place, values = {w: i for i, w in enumerate(new)}, kernel(new)
                every, totals = [], []
                for parts in read:
                    sums = np.array([values[[place[w] for w in p]].sum(0) for p in parts]).reshape(len(parts), kernel.m)
                    every.append(sums.astype(np.float32).tobytes())
                    totals.append(sums.sum(0))
                yield {"label": part.column(0), "sums": every, "totals": totals}

    bags = staged(map_batches(texts.select("label", "text"), "label int, sums binary, totals array<double>", bagged))
    model.fit(bags.coalesce(documents.sparkSession.sparkContext.defaultParallelism))  # some fifty short passes
    return model


class Reader:
    """Sentence values of texts, with a bounded cache of word values."""

    def __init__(self, model: Toxicity, most: int = CACHE) -> None:
        self.model, self.cache, self.most = model, {}, most

    def facts(self, texts: list[str | None]) -> np.ndarray:
        parsed = [sentences(t) for t in texts]
        cache = self.cache
        if len(cache) > self.most:
            cache.clear()
        if new := [w for w in set(chain.from_iterable(chain.from_iterable(parsed))) if w not in cache]:
            for at in range(0, len(new), 20_000):
                part = new[at:at + 20_000]
                cache.update(zip(part, map(tuple, (self.model.kernel(part) @ self.model.word).tolist()), strict=True))
        found = []
        for parts in parsed:
            values = [tuple(map(sum, zip(*map(cache.__getitem__, s), strict=True))) for s in parts]
            found.append(self.model.facts(np.array([v[0] for v in values]), sum(v[1] for v in values)))
        return np.array(found).reshape(-1, 4)


def scores_of(model: Toxicity, most: int = CACHE):
    """texts -> scores, for use in one task."""
    if not model.ready:
        return lambda texts: np.full(len(texts), model.share)
    reader, step = Reader(model, most), 256
    return lambda texts: np.concatenate([np.zeros(0), *(model.score(reader.facts(texts[i:i + step])) for i in range(0, len(texts), step))])


def classify(documents: DataFrame, model: Toxicity, cut: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) per document."""
    def work(batches):
        score_of = scores_of(model)
        for batch in sliced(batches):
            score = score_of(batch.column(1).to_pylist())
            yield {"doc_id": batch.column(0), "score": score, "predicted": (score >= cut).astype(np.int32)}

    return map_batches(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        "doc_id bigint, score double, predicted int", work)


def reject(documents: DataFrame, model: Toxicity, cut: float = 0.5) -> DataFrame:
    """The documents, all columns, whose score is below the cut."""
    columns, at = documents.columns, documents.columns.index("text")
    typed = documents.withColumn("text", F.col("text").cast("string"))

    def work(batches):
        score_of = scores_of(model, SMALL_CACHE)
        for batch in sliced(batches):
            left = batch.take(np.flatnonzero(score_of(batch.column(at).to_pylist()) < cut))
            yield {c: left.column(i) for i, c in enumerate(columns)}

    return map_batches(typed, typed.schema, work)


def op2_toxicity(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train(documents, table(spark, folder, "labels"), fold=bucket_of("doc_id", 5) != 0)
    return classify(documents, model).select(
        "doc_id", F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
