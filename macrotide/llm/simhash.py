"""SimHash near-duplicates by generalised pigeonhole.

Fingerprints. ASCII letters are lower-cased, words are split at ASCII white space, a shingle is three
words joined by spaces, repeats included. A bit is 1 if it is set in more than half of the 64-bit
hashes (XXH64, seed 42). Without words the fingerprint is zero.

Search within `limit` bits. Equal fingerprints are one class from here on. The second moments of all
bits over all classes (64 x 64 numbers) give the correlations; correlated bits are grouped into m
parts. Two fingerprints within the limit differ by at most T_i bits in some part i whenever the sum
of T_i is limit - m + 1 (T_i = -1: part i need not be looked at). Dynamic programming picks m and the
unequal T_i with the least estimated probes and candidates. Each class is indexed by its exact part
values, probes every value within T_i of its own, and candidates are verified on all 64 bits.

Crowded values. Where more than `CROWD` classes share a part value, pairs would grow with the square
of the crowd. Classes that probe such a value are linked another way, equally exact: each names all
points within limit / 2 bits (65 for limit 2); two classes within the limit name a common point, at
most 65 classes name the same one, and they are all linked to the least of them, which is within
the limit of each. So rows grow with the number of classes, and no link between classes is lost:
the same components follow.

Cases. Null texts count as empty; rows without id have fingerprints and bridge links, and the
component is the least id present (null if there is none). Repeated rows give repeated results.
An empty table gives an empty result. Other columns are ignored.

Near copies (`near_copies`) are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or
more; all of them are found, by prefixes. In any order of the shingles that all texts share, two texts of that similarity have a shingle
in common among the first n - ceil(0.8 n) + 1 of each, n being the shingles of a text; so only these are indexed, and only those that
several texts hold go on. The order puts shingles that occur often in a sample last; the sample steers the
work, any order finds the same. Lengths, the places of the common shingle and counts of shingles by hash bound
the similarity from above and drop pairs below 0.8; the rest is verified on the shingles themselves. Where more than
`NEAR_CROWD` texts hold a shingle, each is first compared to a few leaders: `LEADERS` of them by a hash, and the one with the fewest rarer
shingles ahead, which is next to what a group of near copies was made from. Pairs that the links so far connect need no
comparison; all other pairs of the crowd are then compared. So rows stay few where a crowd is one group of near copies or of texts
with a common passage, and grow with the square only of texts that consist of common shingles for the most part without being linked.
Texts that differ in white space and case only are one class. Texts without words are one class.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macrotide.llm.common import map_batches, sliced, staged, table
from macrotide.llm.components import components

BITS, LIMIT, CROWD = 64, 2, 64
BLOCK = 1 << 16


def fingerprint(text: bytes | None) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < 3:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(words) - 2
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + 2]
        hashes = np.fromiter(
            (digest(b"%b %b %b" % s, 42) for s in zip(part, part[1:], part[2:], strict=False)), np.uint64, len(part) - 2)
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit number."""
    def work(batches):
        for batch in batches:
            values = [fingerprint(t) for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "fp": pa.array(np.array(values, np.uint64).view(np.int64))}

    return map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")),
                       "doc_id bigint, fp bigint", work)


def moments(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of classes, and how many of them have bits i and j set, over all classes."""
    def work(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            bits = np.unpackbits(np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
        i, j = np.nonzero(total)
        yield {"i": i, "j": j, "n": total[i, j]}

    n = classes.count()
    both = np.zeros((BITS, BITS))
    for r in map_batches(classes.select("fp"), "i int, j int, n bigint", work).groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[r["i"], r["j"]] = r["n"]
    return n, both


def parts_of(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits of about equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, parts = set(range(BITS)), []
    for k in range(m):
        room = -(-len(free) // (m - k))
        part = [max(free, key=lambda b: (tie[b, list(free)].sum(), -b))]
        free -= set(part)
        while len(part) < room:
            best = max(free, key=lambda b: (tie[b, part].mean(), -b))
            part.append(best)
            free.discard(best)
        parts.append(sorted(part))
    return parts


def plan(n: int, both: np.ndarray, limit: int = LIMIT) -> list[tuple[list[int], int]]:
    """Parts with their thresholds; those at -1 are left out."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)

    def costs(part: list[int]) -> list[float]:
        near = np.zeros(limit + 2)
        near[0] = 1.0  # chance that two classes differ in 0, 1, ... bits of the part
        for b in part:
            near[1:] = near[1:] * (1 - differ[b]) + near[:-1] * differ[b]
            near[0] *= 1 - differ[b]
        probes = [sum(1 for k in range(t + 1) for _ in combinations(part, k)) for t in range(limit + 1)]
        return [0.0] + [n * probes[t] + 0.5 * n * n * near[:t + 1].sum() for t in range(limit + 1)]

    best = None
    for m in range(1, limit + 2):
        parts = parts_of(n, both, m)
        # table[s]: least cost of the parts so far whose T + 1 sum to s, with the thresholds
        state: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for part in parts:
            cost, following = costs(part), {}
            for spent, (c, chosen) in state.items():
                for t in range(-1, limit + 1):
                    if spent + t + 1 <= limit + 1:
                        new = (c + cost[t + 1], (*chosen, t))
                        following[spent + t + 1] = min(new, following.get(spent + t + 1, (float("inf"), ())))
            state = following
        found = (*state[limit + 1], parts)
        best = found if best is None or found[0] < best[0] else best
    return [(part, t) for part, t in zip(best[2], best[1], strict=True) if t >= 0]


def signed(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def keys(parts: list[tuple[list[int], int]], probe: bool):
    """Array of (part, key): the exact values of the parts, or all within their thresholds."""
    found = []
    for i, (part, t) in enumerate(parts):
        value = F.col("fp").bitwiseAND(F.lit(signed(part)).cast("long"))
        for k in range((t if probe else 0) + 1):
            found += [F.struct(F.lit(i).alias("part"), value.bitwiseXOR(F.lit(signed(flip)).cast("long")).alias("key"))
                      for flip in combinations(part, k)]
    return F.array(*found)


def links(classes: DataFrame, limit: int = LIMIT, crowd: int = CROWD) -> DataFrame:
    """(a, b): fingerprints within the limit whose components are those of all such links."""
    n, both = moments(classes)
    parts = plan(n, both, limit)
    index = classes.select("fp", F.inline(keys(parts, probe=False)))
    probes = classes.select("fp", F.inline(keys(parts, probe=True)))
    crowded = staged(index.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("part", "key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= limit
    left = probes.join(crowded, ["part", "key"], "left_anti").select("part", "key", F.col("fp").alias("a"))
    pairs = left.join(index.withColumnRenamed("fp", "b"), ["part", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    inside = probes.join(crowded, ["part", "key"], "left_semi").select("fp").distinct()
    balls = [F.col("fp").bitwiseXOR(F.lit(signed(flip)).cast("long")) for k in range((limit + 1) // 2 + 1) for flip in combinations(range(BITS), k)]
    shared_points = (
        inside.select("fp", F.explode(F.array(*balls)).alias("point")).groupBy("point")
        .agg(F.sort_array(F.collect_list("fp")).alias("near")).where(F.size("near") > 1))
    stars = shared_points.select(F.explode(F.slice("near", F.lit(2), F.size("near"))).alias("a"), F.col("near")[0].alias("b")).distinct()
    if limit % 2:  # the points reach one bit too far: verify
        raise ValueError("an even limit is needed")
    return pairs.union(stars)


def near_duplicates(documents: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, fp, component_id): a row per document."""
    prints = staged(fingerprints(documents))
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    linked = components(links(classes, limit)).withColumnRenamed("node", "fp")
    grouped = classes.join(linked, "fp", "left").withColumn("group", F.coalesce("component", "fp"))
    least = grouped.groupBy("group").agg(F.min("first_id").alias("component_id"))
    named = staged(grouped.select("fp", "group").join(least, "group").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


# Near copies

SHINGLE, SIMILARITY, FOUND = 5, 0.8, 0.95
NEAR_CROWD, LEADERS, MOST_BROADCAST = 2, 2, 1 << 20
#: The sample that orders shingles: so many texts and a share of all, so that what more than some dozen texts hold is listed at any size;
#: listed are those of several sampled texts, the most frequent of them.
SAMPLE, SAMPLE_SHARE, SAMPLE_LEAST, MOST_COMMON = 10_000, 4, 3, 1 << 20
#: Counts of shingles by hash.
BINS = 256
EDGE = 1e-9  # bounds are rounded towards keeping a pair


# What a search by wide fingerprints would take: it finds a share of the pairs only, so near copies are found by prefixes.

def differing(similarity: float) -> float:
    """Expected share of SimHash bits in which two sets of about one size and this Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def parts_a_word(rows: int) -> int:
    """4, 3 or 2 parts of 16, 21 or 32 bits: unrelated texts meet in a part 16 times each at most, or so."""
    return next((g for g in (4, 3) if rows / 16 <= 2 ** (BITS // g)), 2)


def words_for(rows: int, similarity: float = SIMILARITY, found: float = FOUND) -> int:
    """Words of the fingerprint with which a pair at the least similarity meets in a part with the wanted probability."""
    per_word = parts_a_word(rows)
    meets = (1 - differing(similarity)) ** (BITS / per_word)
    return math.ceil(math.log(1 - found) / math.log(1 - meets) / per_word)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles; fewer words are one shingle, none give none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) > size else [b" ".join(words)]
    return np.unique(np.fromiter((digest(g, 42) for g in grams), np.uint64))


def text_key():
    """Names the text of a row; a null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def common_shingles(documents: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of shingles that several texts of a sample hold: hashes in order, places from the rarest on."""
    rate = max(1, rows // (SAMPLE + rows // SAMPLE_SHARE))
    sampled = documents.select(text_key().alias("text_key"), F.col("text").cast("string").cast("binary").alias("text")).where(
        F.pmod("text_key", F.lit(rate)) == 0).dropDuplicates(["text_key"])

    def work(batches):
        for batch in sliced(batches):
            own = [shingles(t) for t in batch.column(1).to_pylist()]
            found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_counts=True)
            yield {"shingle": found.view(np.int64), "n": n}

    counts = map_batches(sampled, "shingle bigint, n bigint", work).groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= SAMPLE_LEAST).orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).toArrow()
    hashes, n = found["shingle"].to_numpy().view(np.uint64), found["n"].to_numpy()
    place = np.empty(len(n), np.int64)
    place[np.lexsort((hashes, n))] = np.arange(len(n))
    order = np.argsort(hashes)
    return hashes[order], place[order]


def prefix(own: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles, in the order of all texts, of which similar texts share one: by hash, common ones last."""
    length = len(own) - math.ceil(similarity * len(own) - EDGE) + 1
    hashes, place = common
    if not len(own) or not len(hashes):
        return own[:length]
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    listed = hashes[at] == own
    last = own[listed]
    return np.concatenate([own[~listed], last[np.argsort(place[at[listed]])]])[:length]


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)))


def prints_of(documents: DataFrame, common: tuple[np.ndarray, np.ndarray], similarity: float) -> DataFrame:
    """(rid, doc_id, text_key, node, n, prefix, bins): rid numbers the rows, node names the sequence of words, n is its number of
    shingles, bins counts them by hash, up to 255."""
    sent = documents.sparkSession.sparkContext.broadcast(common)

    def work(batches):
        for batch in sliced(batches):
            out = {"node": [], "n": [], "prefix": [], "bins": []}
            for text in batch.column(3).to_pylist():
                own = shingles(text)
                out["node"].append(xxhash.xxh3_128_digest(b" ".join((text or b"").lower().split())))
                out["n"].append(len(own))
                out["prefix"].append(prefix(own, sent.value, similarity))
                out["bins"].append(np.minimum(np.bincount((own % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes())
            yield {"rid": batch.column(0), "doc_id": batch.column(1), "text_key": batch.column(2)} | out | {"prefix": lists_of(out["prefix"])}

    rows = documents.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_batches(rows, "rid bigint, doc_id bigint, text_key bigint, node binary, n int, prefix array<bigint>, bins binary", work)


def holders_of(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, n, pos, holders): the classes that hold a shingle in their prefixes, of all that several hold."""
    index = prints.select(F.col("rid").alias("id"), "n", "prefix").join(small(classes.select("id")), "id").select(F.posexplode("prefix").alias("pos", "key"), "id", "n")
    held = index.withColumn("holders", F.count("*").over(Window.partitionBy("key")))
    return staged(held.where("holders > 1").select("key", "id", "n", "pos", "holders"))


def meeting(left: DataFrame, right: DataFrame, similarity: float, also) -> DataFrame:
    """(a, b): pairs that share a shingle and may be similar by their sizes and its places; of right `other_` columns."""
    # what two texts share lies behind the first shingle that they share
    most = F.least(F.col("n") - F.col("pos"), F.col("other_n") - F.col("other_pos"))
    may = (F.least("n", "other_n") >= similarity * F.greatest("n", "other_n") - EDGE) & (
        most >= similarity / (1 + similarity) * (F.col("n") + F.col("other_n")) - EDGE)
    return left.join(right.withColumnsRenamed({c: f"other_{c}" for c in right.columns if c != "key"}), "key").where(may & also).select(
        F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")).distinct()


def candidate_pairs(holders: DataFrame, similarity: float, crowd: int) -> DataFrame:
    """(a, b): all pairs that meet where few classes hold a shingle, and each class with the leaders where many do."""
    columns = ("key", "id", "n", "pos")
    few, many = holders.where(F.col("holders") <= crowd).select(*columns), holders.where(F.col("holders") > crowd).select(*columns)
    # the least by a hash lead, so that shingles of the same classes have the same leaders; and the one with the fewest rarer shingles of
    # its own ahead, as it differs least from what the holders have in common
    seats = [F.struct(F.lit(0), F.xxhash64(F.lit(k), "id")) for k in range(LEADERS)] + [F.struct("pos", F.xxhash64(F.lit(LEADERS), "id"))]
    first = F.array(*(F.min_by(F.struct("id", "n", "pos"), seat) for seat in seats))
    lead = many.groupBy("key").agg(first.alias("lead")).select("key", F.inline("lead")).select(*columns).distinct()
    return meeting(few, few, similarity, F.col("id") < F.col("other_id")).union(
        meeting(many, lead, similarity, F.col("id") != F.col("other_id"))).distinct()


def pairs_left(holders: DataFrame, linked: DataFrame, similarity: float, crowd: int) -> DataFrame:
    """(a, b): all pairs that meet where many classes hold a shingle and that the links so far do not connect; linked: (node, component)."""
    many = holders.where(F.col("holders") > crowd).join(linked.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "n", "pos", F.coalesce("component", "id").alias("component"))
    many = staged(many)
    sizes = many.groupBy("key", "component").agg(F.count("*").alias("members"))
    main = staged(sizes.groupBy("key").agg(F.max(F.struct("members", "component"))["component"].alias("main"), F.count("*").alias("groups")).where("groups > 1"))
    told = many.join(small(main.drop("groups")), "key")
    # whoever is outside of the largest group of a shingle meets all that hold it
    outside = told.where("component <> main").drop("main")
    apart = (F.col("component") != F.col("other_component")) & ((F.col("other_component") == F.col("other_main")) | (F.col("id") < F.col("other_id")))
    return meeting(outside, told, similarity, apart)


def small(rows: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """Written rows of a few numbers, broadcast if there are so many at most; beyond that the join shuffles both sides."""
    return F.broadcast(rows) if rows.count() <= most else rows


def similar_pairs(documents: DataFrame, pairs: DataFrame, prints: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the pairs of classes whose shingles have the similarity; bounded by the counts in their bins first."""
    share = (1 - similarity) / (1 + similarity)

    def near(batches):
        for batch in sliced(batches):
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("bins_a", "bins_b"))
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            left = batch.take(pa.array(np.flatnonzero(np.abs(a - b).sum(1) <= share * n + EDGE)))
            yield {c: left.column(c) for c in ("a", "b", "key_a", "key_b")}

    facts = prints.select("rid", "n", "bins", "text_key")
    both = pairs.join(facts.toDF("a", "n_a", "bins_a", "key_a"), "a").join(facts.toDF("b", "n_b", "bins_b", "key_b"), "b")
    likely = staged(map_batches(both, "a bigint, b bigint, key_a bigint, key_b bigint", near))
    wanted = staged(likely.select(F.col("key_a").alias("text_key"), F.col("a").alias("id")).union(likely.select("key_b", "b")).distinct())

    def work(batches):
        for batch in sliced(batches):
            yield {"id": batch.column(0), "own": lists_of([shingles(t) for t in batch.column(1).to_pylist()])}

    texts = documents.select(text_key().alias("text_key"), F.col("text").cast("string").cast("binary").alias("text"))
    one_each = texts.join(small(wanted), "text_key").groupBy("id").agg(F.min("text").alias("text"))
    sets = staged(map_batches(one_each, "id bigint, own array<bigint>", work))
    met = likely.join(sets.toDF("a", "own_a"), "a").join(sets.toDF("b", "own_b"), "b").withColumn("common", F.size(F.array_intersect("own_a", "own_b")))
    return met.where(F.col("common") >= similarity * (F.size("own_a") + F.size("own_b") - F.col("common"))).select("a", "b")


def near_links(documents: DataFrame, prints: DataFrame, classes: DataFrame, similarity: float, crowd: int) -> DataFrame:
    """(node, component): class ids by the components of all pairs of the similarity."""
    holders = holders_of(prints, classes)
    links = staged(similar_pairs(documents, staged(candidate_pairs(holders, similarity, crowd)), prints, similarity))
    linked = components(links)
    if not holders.where(F.col("holders") > crowd).limit(1).count():
        return linked
    rest = staged(pairs_left(holders, staged(linked), similarity, crowd))
    if not rest.limit(1).count():
        return linked
    return components(links.union(similar_pairs(documents, rest, prints, similarity)))


def near_copies(documents: DataFrame, similarity: float = SIMILARITY, crowd: int = NEAR_CROWD) -> DataFrame:
    """(doc_id, text_key, node, group, component_id, kept) per document. group: the least class that near copies lead to;
    component_id: its least id; kept: whether the row's text and id stand for the group (all rows that repeat both do)."""
    prints = staged(prints_of(documents, common_shingles(documents, documents.count()), similarity))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "rid"))
    classes = staged(prints.groupBy("node").agg(least.alias("least")).select(
        F.col("least.rid").alias("id"), "node", F.col("least.doc_id").alias("first_id"), F.col("least.text_key").alias("text_key")))
    linked = near_links(documents, prints, classes, similarity, crowd).withColumnRenamed("node", "id")
    several = staged(linked.join(classes.select("id", "node"), "id"))
    named = several.join(several.groupBy("component").agg(F.min("node").alias("group")), "component").select("id", "group")
    grouped = staged(classes.join(named, "id", "left").select(
        "node", "first_id", F.col("text_key").alias("first_key"), F.coalesce("group", "node").alias("group")))
    # the class with the least id stands for the group; of classes without ids, or with one id, the least
    best = grouped.groupBy("group").agg(
        F.min("first_id").alias("component_id"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "node"))["node"].alias("best"))
    named = staged(grouped.join(best, "group").select(
        "node", "first_id", "first_key", "group", "component_id", (F.col("node") == F.col("best")).alias("best")))
    return prints.select("doc_id", "text_key", "node").join(named, "node").select(
        "doc_id", "text_key", "node", "group", "component_id",
        (F.col("best") & F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))).alias("kept"))


def op1_simhash(spark, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
