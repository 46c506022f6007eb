"""WARC archives: write a record per page, read the archives back, merge their indexes.

Writing. Payload digests decide first, on rows of a few numbers: of equal payloads of at least
`least` bytes the smallest page_id is a response, the others are revisits without payload. A task
sorts its captures by URL key and timestamp and writes them as archives of so many records as make `ARCHIVE_BYTES` by
the mean over all records; each archive is a sorted run. An archive is read whole and held several times over on its way to Python, so it is
small. Spark's text writer does the writing, with the record end as line separator, so files
land wherever the shared folder is and a lost task is simply written again. Dates are in UTC, whatever the session's zone.

Reading. Each archive is parsed by its Content-Length fields; digests of responses are computed anew
from the bytes and compared.

Index. The runs are cut at common key ranges (URL key, timestamp, page, place) of about `ROWS_A_RANGE` rows, and each task merges its
slices of all runs with a loser tree of one comparison per level. Slices of one range are index rows
only; a single very common URL is cut by timestamp and page, a page that repeats by place, so no range is larger than the others.
Ranges follow each other, so the parts in order are the capture history of everything.

Cases. Null html is an empty payload, a null url has no target line and an empty key. Pages without
id come last, as revisits where a page with an id has the same payload. Repeated rows repeat.
Without `captured_at` column pages are dated one second per page_id after a fixed day. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import map_batches, shared, staged, table
from macrotide.llm.simhash import small

FIRST_SECOND = 1_704_067_200  # 2024-01-01T00:00:00Z
END = "\r\n"
ROWS_A_BATCH, ROWS_A_RANGE = 10_000, 20_000
#: What a task reads at once, several times over: as bytes, as a row, as Arrow on both sides, as Python bytes.
ARCHIVE_BYTES, HEAD_BYTES = 4 << 20, 600
#: So many revisits are broadcast, some 200 bytes each; with more of them the payloads are shuffled.
MOST_REVISITS = 1 << 19
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "url_key string, timestamp string, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, url string, archive string, offset bigint, length bigint")


def base32(hexadecimal):
    """Base32 of a 40-digit hexadecimal column, ten digits (eight characters) at a time."""
    quarters = [F.lpad(F.conv(F.substring(hexadecimal, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*quarters), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url):
    """Sort-friendly form: host reversed by label, then path and query, lower-cased."""
    rest = F.lower(F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?(?:www\\.)?|#.*$", ""))
    host = F.regexp_extract(rest, "^([^/?]*?)(?::\\d+)?(?=[/?]|$)", 1)
    path = F.regexp_extract(rest, "^[^/?]*(.*)$", 1)
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"),
                               F.when(path == "", "/").otherwise(path)), F.lit(""))


def captures(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    # seconds of UTC, written out from the first day on, so that no time zone has a say
    seconds = F.unix_timestamp(F.col("captured_at").cast("timestamp")) if "captured_at" in pages.columns else (
        F.lit(FIRST_SECOND) + F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(10 ** 10)))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.col("url").cast("string"), "[\\x00-\\x20\\x7F]", "%20").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32(F.sha1(payload)).alias("payload_digest"), seconds.alias("at"))


def utc(seconds):
    """Seconds as a WARC date; null stays null."""
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int")), "yyyy-MM-dd")
    rest = F.pmod(seconds, F.lit(86_400))
    clock = F.format_string("%02d:%02d:%02d", F.floor(rest / 3600), F.floor(rest / 60) % 60, rest % 60)
    return F.when(seconds.isNotNull(), F.concat(day, F.lit("T"), clock, F.lit("Z")))


def record(row: Callable = F.col):
    """The text of one record without its last line end."""
    revisit = row("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    row("payload_bytes"), F.lit(END + END))
    block = F.when(revisit, http).otherwise(F.concat(http, row("payload")))
    name = F.coalesce(row("page_id").cast("string"), F.lit(""))
    lines = F.concat_ws(
        END, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), name, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Target-URI: "), row("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), row("payload_digest")),
        F.when(revisit, f"WARC-Profile: {PROFILE}"), F.concat(F.lit("WARC-Refers-To: <urn:page:"), row("refers_to"), F.lit(">")),
        F.lit("Content-Type: application/http;msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(block)))
    return F.concat(lines, F.lit(END + END), block, F.lit(END))


def write_archives(pages: DataFrame, path: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of about so many bytes at most below the path, each sorted by URL key, timestamp and page."""
    taken = captures(pages)
    marks = staged(taken.select("page_id", "payload_bytes", "payload_digest"))
    firsts = staged(marks.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first")))
    revisits = staged(
        marks.join(firsts, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("revisit"), F.col("first").alias("refers_to"), F.col("payload_digest").alias("of")).distinct())
    known = taken.alias("p").join(small(revisits, MOST_REVISITS), F.col("p.page_id").eqNullSafe(F.col("revisit")) & (F.col("payload_digest") == F.col("of")), "left")
    mean = marks.agg(F.avg(F.col("payload_bytes") + HEAD_BYTES).alias("bytes")).first()["bytes"] or HEAD_BYTES
    runs = known.withColumns({"url_key": url_key(F.col("url")), "date": utc(F.col("at"))}).sortWithinPartitions("url_key", "at", F.col("page_id").asc_nulls_last())
    runs.select(record().alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", max(1, int(archive_bytes / mean))).text(path)


def parsed(data: bytes) -> Iterator[dict]:
    """The records of an archive in order."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/1.1\r\n", at):
            raise ValueError(f"no record at byte {at}")
        head = data.index(b"\r\n\r\n", at)
        fields = dict(line.split(": ", 1) for line in data[at:head].decode().split(END)[1:])
        stop = head + 4 + int(fields["Content-Length"])
        block = data[head + 4:stop]
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = fields["WARC-Type"] == "revisit"
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(http.rsplit(b": ", 1)[1])
        if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"the payload at byte {at} is not the one its digest names")
        yield {"page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To", "")),
               "payload_bytes": size, "payload_digest": digest, "url": fields.get("WARC-Target-URI"), "offset": at, "length": stop + 4 - at,
               "timestamp": "".join(c for c in fields["WARC-Date"] if c.isdigit())}
        at = stop + 4


def number(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_archives(spark, path: str) -> DataFrame:
    """An index row per record; `archive` and `offset` give the place in its sorted run."""
    names = ("timestamp", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url", "archive", "offset", "length")

    def work(batches):
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for row in parsed(data.as_py()):
                    rows.append(row | {"archive": archive})
                    if len(rows) == ROWS_A_BATCH:
                        yield {n: [r[n] for r in rows] for n in names}
                        rows = []
                yield {n: [r[n] for r in rows] for n in names}

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    schema = ", ".join(f for f in INDEX.split(", ") if not f.startswith("url_key"))
    return map_batches(files, schema, work).withColumn("url_key", url_key(F.col("url"))).select([f.split()[0] for f in INDEX.split(", ")])


def indexed(spark, path: str) -> DataFrame:
    """The index rows of the archives below a path, staged. Small archives go to Python together up to the size of one."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(ARCHIVE_BYTES))
    try:
        return staged(read_archives(spark, path))
    finally:
        spark.conf.set(BATCH_BYTES, before)


class LoserTree:
    """Merges sorted lists of keys: inner nodes keep the loser of their match, so the next winner
    costs one comparison per level. Yields (list, place in it)."""

    def __init__(self, lists: list[list[tuple]]) -> None:
        self.lists, self.k = lists, len(lists)
        self.place = [0] * self.k
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _beats(self, a: int, b: int) -> bool:
        """Whether the head of list a comes before that of b; ended lists come last."""
        if self.place[a] >= len(self.lists[a]):
            return False
        if self.place[b] >= len(self.lists[b]):
            return True
        return (self.lists[a][self.place[a]], a) < (self.lists[b][self.place[b]], b)

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # the first of the two to arrive waits here
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        while self.k:
            winner = self.losers[0]
            if self.place[winner] >= len(self.lists[winner]):
                return
            yield winner, self.place[winner]
            self.place[winner] += 1
            self._replay(winner)


def merge_indexes(index: DataFrame, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """The rows of a staged index in global order of URL key, timestamp and page, merged range by range."""
    names = index.columns

    def work(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        keys = list(zip(*(rows[c].to_pylist() for c in ("url_key", "timestamp", "page_id")), strict=True))
        keys = [(u, t, p is None, p or 0) for u, t, p in keys]
        runs: dict[str, list[int]] = {}
        for i, archive in enumerate(rows["archive"].to_pylist()):
            runs.setdefault(archive, []).append(i)
        places = list(runs.values())
        order = [places[run][k] for run, k in LoserTree([[keys[i] for i in run] for run in places])]
        merged = rows.take(order)
        for batch in merged.to_batches(ROWS_A_BATCH):
            yield {n: batch.column(n) for n in names}

    # a number of ranges that follows the rows: Spark joins small ones to one of a size in bytes otherwise, whatever their rows take here
    ranges = max(1, -(-index.count() // rows_a_range))
    cut = index.repartitionByRange(ranges, "url_key", "timestamp", F.col("page_id").asc_nulls_last(), "archive", "offset").sortWithinPartitions("archive", "offset")
    return map_batches(cut, index.schema, work)


def history(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the archives to the shared folder, reads them back and merges their indexes."""
    path = shared(pages.sparkSession)
    write_archives(pages, path, least)
    return merge_indexes(indexed(pages.sparkSession, path))


def op10_warc(spark, folder: str) -> DataFrame:
    return history(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp")
