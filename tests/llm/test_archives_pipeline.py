"""WARC round trip, the pipeline stage by stage, queries against SQL and across layouts."""

import base64
import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from data import documents
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import corpus_pipeline  # noqa: E402
from check import rows_of  # noqa: E402

from macrotide.llm import common, decontamination, registry, secret_scan, simhash, toxicity, warc  # noqa: E402
from macrotide.llm.common import staged, table  # noqa: E402
from macrotide.llm.components import components  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
PAGES = [(3, "https://www.Example.org:443/A?b#c", "<p>same</p>"), (1, "http://example.org/z", "<p>same</p>"), (2, None, None), (4, "ftp://x", ""),
         (5, "http://a.b/c d", "WARC/1.1\r\nWARC-Type: x\r\n\r\n"), (None, "http://n.n", "<p>same</p>"), (6, "http://example.org/z", "é" * 5000), (6, "http://example.org/z", "é" * 5000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, url_key string").repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.history(pages(spark), least).collect()), key=str)
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html in PAGES:
        data, lead = (html or "").encode(), first[html or ""]
        again = i != lead and len(data) >= least
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", lead if again else None))
    assert got == sorted(want, key=str)


def test_archives_are_cut_and_dated_in_utc(spark, tmp_path):
    rows = [(k, f"http://host{k % 3}.org/{k}", "x" * 1000) for k in range(60)]
    warc.write_archives(pages(spark, rows).coalesce(1), str(tmp_path / "a"), archive_bytes=5 * (1000 + warc.HEAD_BYTES), least=2000)
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) >= 12 and all(f.stat().st_size < 10_000 for f in files)
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 60
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        stamps = {r["page_id"]: r["timestamp"] for r in warc.history(pages(spark, rows)).collect()}
        dated = spark.createDataFrame([(1, "http://a.org", "x")], "page_id bigint, url string, html string").selectExpr(
            "*", "timestamp_seconds(1709294399) AS captured_at")  # 2024-03-01 11:59:59 UTC
        assert warc.history(dated).first()["timestamp"] == "20240301115959"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert stamps[0] == "20240101000000" and stamps[59] == "20240101000059"


def test_archives_and_ranges_stay_small(spark, tmp_path):
    """An archive is read whole and a range is merged in memory, so their sizes do not follow the input of a task."""
    rows = spark.range(3000, numPartitions=1).selectExpr("id AS page_id", "'http://a.org/x' AS url", "concat(id, repeat('x', 20000)) AS html")
    warc.write_archives(rows, str(tmp_path / "a"))
    sizes = [f.stat().st_size for f in (tmp_path / "a").glob("part-*")]
    assert sum(sizes) > 60_000_000 and max(sizes) < 9_000_000
    repeated = rows.limit(1).selectExpr("*", "explode(sequence(1, 400)) AS again")
    warc.write_archives(repeated, str(tmp_path / "b"), archive_bytes=1_000_000)
    parts = warc.merge_indexes(warc.indexed(spark, str(tmp_path / "b")), rows_a_range=100).rdd.glom().collect()
    assert len(parts) == 4 and max(map(len, parts)) < 200
    merged = [(r["archive"], r["offset"]) for part in parts for r in part]
    assert merged == sorted(merged) and len(merged) == 400


def test_history_is_in_global_order(spark):
    rng = random.Random(9)
    rows = [(k, f"http://host{rng.randrange(4)}.org/p{rng.randrange(30)}", str(k % 50)) for k in range(400)]
    parts = warc.history(pages(spark, rows)).rdd.glom().collect()
    keys = [(r["url_key"], r["timestamp"], r["page_id"]) for part in parts for r in part]
    assert keys == sorted(keys) and len(keys) == 400
    assert warc.history(pages(spark, rows).where("false")).count() == 0


def test_loser_tree_merges():
    rng = random.Random(1)
    for k in range(9):
        lists = [sorted((rng.randrange(9),) for _ in range(rng.randrange(6))) for _ in range(k)]
        assert [lists[a][b] for a, b in warc.LoserTree(lists)] == sorted(x for one in lists for x in one)


def test_damaged_archives_are_refused():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    with pytest.raises((ValueError, IndexError)):
        list(warc.parsed(record))
    with pytest.raises(ValueError):
        list(warc.parsed(b"junk"))


def words_of(text):
    return (text or "").encode().lower().split()


def shingle_sets(texts):
    return {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := words_of(t)) else set() for i, t in texts.items()}


def alike(texts):
    """All pairs of texts whose five-word shingles have a similarity of 0.8 or more, and the components they make."""
    sets = shingle_sets(texts)
    holders, pairs = {}, set()
    for i, own in sets.items():
        for g in own or {()}:
            holders.setdefault(g, []).append(i)
    label = {i: i for i in texts}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, own in sets.items():
        times = Counter(j for g in own or {()} for j in holders[g] if str(j) < str(i))
        for j, n in times.items():
            if n >= 0.8 * (len(own or {()}) + len(sets[j] or {()}) - n):
                pairs.add((j, i))
                label[top(i)] = top(j)
    return pairs, {i: top(i) for i in texts}


def near_groups(spark, docs):
    return {r["doc_id"]: r["group"] for r in simhash.near_copies(docs).collect()}


def test_near_copies_are_found_and_verified(spark):
    """Copies with words changed, added, dropped, moved; a large crowd of them; short texts; texts that share a part only."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    def changed(words, edits):
        words = list(words)
        for _ in range(edits):
            at = rng.randrange(len(words))
            words[at:at + rng.choice((0, 1, 1))] = [rng.choice(vocabulary)] * rng.choice((0, 1))
        return words

    texts = {}
    for k in range(60):
        base = text(rng.choice((8, 40, 120, 400, 1500)))
        texts[10 * k] = " ".join(base)
        texts[10 * k + 1] = " ".join(base).upper() + " \n"
        for j in range(2, 6):
            texts[10 * k + j] = " ".join(changed(base, rng.randint(1, max(1, len(base) // 40))))
        texts[10 * k + 6] = " ".join(base[:len(base) // 2] + text(len(base) // 2))
    crowd = text(300)
    for k in range(150):
        texts[5000 + k] = " ".join(changed(crowd, rng.randint(1, 4)))
    rows = [(i, t, "en", "a", None, None) for i, t in texts.items()]
    pairs, component = alike(texts)
    for size in (2, simhash.NEAR_CROWD):
        found = {r["doc_id"]: r["group"] for r in simhash.near_copies(documents(spark, rows, 5), crowd=size).collect()}
        assert found.keys() == texts.keys()
        hit = sum(found[a] == found[b] for a, b in pairs) / len(pairs)
        assert hit >= 0.9, hit
        by_group = {}
        for i, g in found.items():
            assert by_group.setdefault(g, component[i]) == component[i]
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows, 5), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(min(i for i in found if found[i] == g) for g in set(found.values()))


def test_no_near_copy_is_left_out(spark):
    """Pairs at the very threshold, and crowds that share a shingle without being near a leader: every pair is linked."""
    rng = random.Random(23)
    vocabulary = [f"v{k}" for k in range(5000)]
    texts = {}

    def add(words):
        texts[len(texts)] = " ".join(words)

    for _ in range(150):  # 0.80 to 0.82: the last words differ
        n = rng.randrange(60, 400)
        base = [rng.choice(vocabulary) for _ in range(n)]
        cut = int((n - 4) * 0.111)
        add(base)
        add(base[:n - cut] + [rng.choice(vocabulary) for _ in range(cut)])
    base = [rng.choice(vocabulary) for _ in range(200)]
    for k in range(60):  # a chain through one crowd: neighbours are near, ends are not
        add(base[2 * k:2 * k + 80])
    shared = [rng.choice(vocabulary) for _ in range(30)]
    for _ in range(40):  # texts of one common passage and little else, in pairs
        own = [rng.choice(vocabulary) for _ in range(12)]
        add(shared + own)
        add(shared + own[:-1])
    rows = [(i, t, "en", "a", None, None) for i, t in texts.items()]
    pairs, component = alike(texts)
    assert len(pairs) > 250
    for crowd in (1, 4, simhash.NEAR_CROWD):
        found = {r["doc_id"]: r["group"] for r in simhash.near_copies(documents(spark, rows, 5), crowd=crowd).collect()}
        assert [(a, b) for a, b in pairs if found[a] != found[b]] == []
        by_group = {}
        assert all(by_group.setdefault(g, component[i]) == component[i] for i, g in found.items())


def test_secret_scan_holds_few_texts_at_once(spark):
    """The query, like the stage of the pipeline, sends whole texts to workers in batches of a thousand at most."""
    before = spark.conf.get(common.BATCH_ROWS)
    try:
        spark.conf.set(common.BATCH_ROWS, "10000")
        assert registry.queries()["op3_secret_scan"](spark, FOLDER).count()
        assert int(spark.conf.get(common.BATCH_ROWS)) <= common.SLICE
    finally:
        spark.conf.set(common.BATCH_ROWS, before)


def test_few_pairs_of_a_crowd_are_left(spark):
    """Copies of one text with up to five words changed: the leaders link all that are near each other through it, and what is
    left to compare does not grow with the square of the crowd."""
    rng = random.Random(31)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for k in range(400):
        words = list(base)
        for j, at in enumerate(rng.sample(range(150), k % 6)):
            words[at] = f"own{k}x{j}"
        rows.append((k, " ".join(words), "en", "a", None, None))
    docs = documents(spark, rows, 5)
    prints = staged(simhash.prints_of(docs, simhash.common_shingles(docs, 400), 0.8))
    classes = staged(prints.groupBy("node").agg(F.min("rid").alias("id")))
    holders = simhash.holders_of(prints, classes)
    near = simhash.similar_pairs(docs, staged(simhash.candidate_pairs(holders, 0.8, simhash.NEAR_CROWD)), prints, 0.8)
    left = simhash.pairs_left(holders, staged(components(staged(near))), 0.8, simhash.NEAR_CROWD).count()
    assert left < 2 * classes.count(), left


def test_passages_of_some_dozen_texts_are_listed_at_any_size(spark):
    """The order of shingles knows a passage that 40 texts share, however many other texts there are."""
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, f"{passage} " + " ".join(f"o{k}x{j}" for j in range(60)), "en", "a", None, None) for k in range(40)]
    wanted = set(simhash.shingles(passage.encode()).tolist())
    for size in (40, 10**6, 10**9):
        assert wanted <= set(simhash.common_shingles(documents(spark, rows), size)[0].tolist())


def test_near_copies_of_awkward_rows(spark):
    """Ties have one outcome: rows of one id are one document only if their texts are equal."""
    rows = [(1, "a b c d e f g", "en", "a", 1, 0.5), (1, "other words of the same id", "en", "a", 1, 0.5), (2, "A b  c d e f g", "en", "a", 1, 0.5),
            (1, "a b c d e f g", "en", "a", 1, 0.5), (None, "no id one two three", None, None, None, None), (None, "NO id one two three", None, None, None, None),
            (3, None, None, None, None, None), (4, "", "en", "a", 1, 0.1), (5, " \t", "en", "a", 1, 0.1), (None, "other words of the same id", "en", "a", 1, 0.5)]
    for parts in (1, 4):
        kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows, parts), "")
        assert kept.columns == documents(spark).columns
        got = [(r["doc_id"], r["text"] and r["text"].lower()) for r in kept.collect()]
        assert sorted(map(str, got)) == sorted(map(str, [
            (1, "a b c d e f g"), (1, "other words of the same id"), (None, "no id one two three"), (3, None)]))
    assert corpus_pipeline.drop_near_duplicates(spark, documents(spark, []), "").count() == 0


def test_words_of_the_wide_fingerprint():
    for rows in (0, 1000, 10**6, 10**7, 10**9):
        n_words, g = simhash.words_for(rows), simhash.parts_a_word(rows)
        missed = (1 - (1 - simhash.differing(0.8)) ** (64 / g)) ** (n_words * g)
        assert missed <= 0.05 and (n_words == 1 or missed >= 0.02)


needs_tables = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables not here")


@needs_tables
@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    frame = registry.queries()[name](spark, FOLDER)
    result = db.execute(registry.oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(frame.columns, frame.collect()) == want


@needs_tables
@pytest.mark.parametrize("name", [n for n in registry.queries() if not n.startswith("op12_")])
def test_query_has_a_row_for_each_document(spark, name):
    of = "pages" if name.startswith("op10_") else "documents"
    assert registry.queries()[name](spark, FOLDER).count() == table(spark, FOLDER, of).count()


@needs_tables
def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["toxicity"](spark, docs, FOLDER)
    assert kept.columns == columns
    model = toxicity.train(docs, table(spark, FOLDER, "labels"))
    rejected = {r["doc_id"] for r in toxicity.classify(docs, model).where("predicted = 1").collect()}
    left = {r["doc_id"] for r in kept.collect()}
    assert rejected and left == set(before) - rejected

    kept = stages["near_duplicates"](spark, docs, FOLDER)
    assert kept.columns == columns
    found = {i: group_of for i, group_of in near_groups(spark, docs).items()}
    pairs, component = alike(before)
    assert all(component[a] == component[b] for a in found for b in found if found[a] == found[b])  # nothing unverified
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(i for i in found if found[i] == g) for g in set(found.values()))

    cut = stages["benchmark_decontamination"](spark, docs, FOLDER)
    assert cut.columns == columns
    hit = {r["doc_id"]: r["n_hit"] for r in decontamination.hits(docs, table(spark, FOLDER, "benchmark")).collect()}
    for r in cut.collect():
        assert r["text"] == before[r["doc_id"]] if not hit[r["doc_id"]] else len(r["text"]) < len(before[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])
    assert {i for i, n in hit.items() if not n} <= {r["doc_id"] for r in cut.collect()}

    masked = stages["secret_scans"](spark, docs, FOLDER)
    assert masked.columns == columns
    listed = secret_scan.ranks(secret_scan.vocabulary(docs))
    for r in masked.collect():
        assert r["text"] == secret_scan.redacted(before[r["doc_id"]], rank=listed)

    mixed = stages["mixing"](spark, docs, FOLDER)
    assert set(columns) <= set(mixed.columns)
    assert all(r["taken"] == len(r["shards"]) * r["size"] > 0 for r in mixed.collect())


def test_stages_stand_awkward_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, documents(spark), FOLDER)
        n = out.count()
        assert n <= documents(spark).count(), name
        assert out.where("text LIKE '%wizards%'").count() > 0, name


def test_workers_hold_few_texts_at_once(spark, monkeypatch):
    """Texts reach the workers in small batches, which are cut where the session allows more; kernel values come in blocks."""
    before = spark.conf.get(common.BATCH_ROWS)
    try:
        for name, stage in corpus_pipeline.STAGES[1:4]:
            spark.conf.set(common.BATCH_ROWS, "10000")
            stage(spark, documents(spark), FOLDER)
            assert int(spark.conf.get(common.BATCH_ROWS)) == common.SLICE, name
            spark.conf.set(common.BATCH_ROWS, "50")
            common.bound_batches(spark)
            assert spark.conf.get(common.BATCH_ROWS) == "50"
    finally:
        spark.conf.set(common.BATCH_ROWS, before)
    batch = pa.RecordBatch.from_pydict({"k": list(range(2500))})
    assert [b.num_rows for b in common.sliced([batch])] == [1000, 1000, 500]
    kernel, words = toxicity.Kernel(["idiot", "stupid"]), [f"idio{chr(97 + k % 26)}x{k}" for k in range(30)]
    whole = kernel(words)
    monkeypatch.setattr(toxicity, "AT_ONCE", 7)
    assert (kernel(words) == whole).all()
    monkeypatch.setattr(secret_scan, "HELD_WORDS", 3)  # counts handed on in parts are the same counts
    rows = [(k, f"perseverance matters greatly {'wonderful' * (k % 2)}", "en", "a", None, None) for k in range(9)]
    assert set(secret_scan.vocabulary(documents(spark, rows))) == {"perseverance", "wonderful"}


@needs_tables
def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    ids = [r["doc_id"] for r in out.collect()]
    assert ids and len(ids) == len(set(ids))
    assert corpus_pipeline.ORACLE_SQL is None
