"""Web archives: writing, reading back, and a globally ordered capture index.

`write_archives` turns pages into WARC/1.1 records, each a gzip member of its
own, and lets Spark's text writer put them into files of a bounded number of
records, on any file system that Spark writes to. (A gzip member below 16 MiB
ends in a zero byte, the top of its length field; that byte is the writer's
line separator. A larger record is followed by an empty member, which ends so.)
Equal payloads share one response record; the others are revisits of it.

`read_archives` parses the files and gives one capture per record, each file's
captures sorted by URL key, timestamp and record: a locally sorted run.
`capture_index` merges the runs. Ranges of the key space go to the tasks; a
range holds many URLs or, as timestamp and record id are part of the key, a
part of one. A task holds the pieces of the runs in its range and merges them
with a loser tree, so the partitions in turn hold the whole capture history.

Edge cases: a null payload is empty; a null URL has the empty key; a null
timestamp counts as 1970; a page without id revisits the response of its payload
if that has an id, and is a response otherwise; repeated rows with the response's
id are responses too; an empty table gives an empty index; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import arrow_map, materialize, scratch_dir, ship, table

CRLF = b"\r\n"
RECORDS_PER_FILE = 2000
_EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()
RESPONSE, REVISIT = "response", "revisit"
CAPTURE = ("url_key string, timestamp string, page_id long, url string, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, archive string, offset long, length long")


def url_key(url: str | None) -> str:
    """Host labels from the top level down, then path and query in lower case."""
    rest = (url or "").strip().split("#", 1)[0]
    if "://" in rest:
        rest = rest.split("://", 1)[1]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:].lower()
    host = host.removesuffix(":80").removesuffix(":443").removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (path or "/") if host else ""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = z.compress(record) + z.flush()
    return out if out[-1] == 0 else out + _EMPTY_MEMBER


def record(page_id: int | None, url: str | None, timestamp: str, payload: bytes, digest: str,
           refers_to: int | None, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {REVISIT if revisit else RESPONSE}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {timestamp}",
            f"WARC-Target-URI: {' '.join((url or '').split())}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2


def responses(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``pages`` with refers_to and revisit: the largest id of each payload is its response.

    Payload classes are summed up before the shuffle; the join back splits a
    payload that many pages share (adaptive skew join).
    """
    keyed = pages.withColumn("payload", F.coalesce(F.col("payload"), F.lit("").cast("binary")))
    keyed = keyed.withColumn("sha", F.sha2("payload", 256))
    top = keyed.groupBy("sha").agg(F.max("page_id").alias("response"))
    j = keyed.join(top, "sha", "left")
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(
        F.col("response"))
    return j.withColumn("revisit", revisit).withColumn(
        "refers_to", F.when(F.col("revisit"), F.col("response"))).drop("sha", "response")


def write_archives(pages: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, timestamp: Column,
                   min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row of ``pages`` below ``path``."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.date_format(F.coalesce(timestamp, F.timestamp_seconds(F.lit(0))),
                                     "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
                       F.col(payload_col).cast("binary").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            cols = [b.column(c) for c in ("page_id", "url", "ts", "payload", "refers_to", "revisit")]
            for i in range(b.num_rows):
                page, url, ts, payload, to, revisit = (c[i].as_py() for c in cols)
                out.append(member(record(page, url, ts, payload, digest_of(payload), to, revisit))[:-1])
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])

    made = arrow_map(responses(src, min_bytes), run, "value binary")
    made.select(F.col("value").cast("string")).write.option("lineSep", "\u0000").option(
        "maxRecordsPerFile", records_per_file).text(path)


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, bytes) of each gzip member."""
    view, at, step = memoryview(content), 0, 1 << 16
    while at < len(view):
        z, parts, pos = zlib.decompressobj(31), [], at
        while not z.eof and pos < len(view):
            parts.append(z.decompress(view[pos:pos + step]))
            pos += step
        end = min(pos, len(view)) - len(z.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """WARC headers and block of a record."""
    head, _, rest = data.partition(CRLF * 2)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def _page(urn: str | None) -> int | None:
    x = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(x) if x else None


def captures_of(content: bytes, archive: str) -> list[tuple]:
    """The file's captures, sorted by key, timestamp and record."""
    out = []
    for offset, length, data in members(content):
        if not data:
            continue
        f, block = parse(data)
        http, _, payload = block.partition(CRLF * 2)
        size = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:"))[15:])
        digest = f["warc-payload-digest"].removeprefix("sha1:")
        if f["warc-type"] == RESPONSE and (len(payload) != size or digest_of(payload) != digest):
            raise ValueError(f"{archive}, offset {offset}: payload and digest differ")
        url = f["warc-target-uri"] or None
        stamp = "".join(c for c in f["warc-date"] if c.isdigit())
        out.append((url_key(url), stamp, _page(f["warc-record-id"]), url, f["warc-type"],
                    _page(f.get("warc-refers-to")), size, digest, archive, offset, length))
    out.sort(key=sort_key)
    return out


def sort_key(c: tuple) -> tuple:
    return c[0], c[1], c[2] is None, c[2] or 0, c[8], c[9]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives below ``path``, a sorted run for each file."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = f"{CAPTURE}, run_pos long"

    def run(rows):
        for batch in rows:
            for i in range(batch.num_rows):
                name = batch.column("path")[i].as_py()
                found = captures_of(batch.column("content")[i].as_buffer().to_pybytes(), name.rsplit("/", 1)[-1])
                cols = list(zip(*found)) or [()] * 11
                yield _batch([*cols, range(len(found))], True)

    ship(spark)
    return arrow_map(files, run, schema)


_FIELDS = [(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in CAPTURE.split(", "))]


def _batch(cols: list, run_pos: bool) -> pa.RecordBatch:
    schema = pa.schema(_FIELDS + ([("run_pos", pa.int64())] if run_pos else []))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


class LoserTree:
    """Tournament over k sorted runs: inner nodes keep the loser of their match,
    so the next smallest item costs one path of comparisons."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.pos = [0] * len(runs)
        k = self.k = max(1, len(runs))
        self.head = [self._head(r) for r in range(len(runs))] or [None]
        self.loser = [0] * k
        winner = [0] * (2 * k)
        for n in range(2 * k - 1, 0, -1):
            if n >= k:
                winner[n] = n - k
            else:
                a, b = winner[2 * n], winner[2 * n + 1]
                first, second = (a, b) if self._beats(a, b) else (b, a)
                winner[n], self.loser[n] = first, second
        self.top = winner[1]

    def _head(self, r: int):
        return self.key(self.runs[r][self.pos[r]]) if self.pos[r] < len(self.runs[r]) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def __iter__(self):
        while self.head[self.top] is not None:
            r = self.top
            yield self.runs[r][self.pos[r]]
            self.pos[r] += 1
            self.head[r] = self._head(r)
            n = (r + self.k) // 2
            while n >= 1:
                if self._beats(self.loser[n], r):
                    self.loser[n], r = r, self.loser[n]
                n //= 2
            self.top = r


def capture_index(captures: DataFrame) -> DataFrame:
    """All captures in the order of URL key, timestamp and record over the partitions."""
    order = ["url_key", "timestamp", "page_id", "archive", "offset"]
    ranges = captures.repartitionByRange(*(F.col(c).asc_nulls_last() for c in order)).sortWithinPartitions(
        "archive", "run_pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list] = {}
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                runs.setdefault(row[8], []).append(row[:-1])
        out = []
        for row in LoserTree([runs[a] for a in sorted(runs)], sort_key):
            out.append(row)
            if len(out) == 4096:
                yield _batch(list(zip(*out)), False)
                out = []
        if out:
            yield _batch(list(zip(*out)), False)

    return arrow_map(ranges, run, CAPTURE)


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path, "page_id", "url", "html",
                   F.timestamp_seconds(F.lit(1577836800) + F.pmod(F.col("page_id"), F.lit(10**9))))
    index = capture_index(materialize(read_archives(spark, path), "captures"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "url_key", "timestamp", "archive", "offset", "length")
