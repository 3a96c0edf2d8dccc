"""WARC archives with a merged capture index.

*Writing.* Each page becomes one WARC/1.1 record, an HTTP response with the page as
payload. Of records with equal payloads of at least ``least`` bytes, that with
the largest id is the response; the others are revisit records that refer to it
and hold its HTTP header but no payload. Spark's text sink writes
the archives, a record per line with the two line breaks that end a WARC record as line
separator, gzip-compressed, about ``ARCHIVE_BYTES`` of payload in each.

*Reading.* Archives are read whole (they are bounded), and records are walked by
their Content-Length, so a payload may hold anything, record markers included.
Digests are recomputed; a record that does not match its header raises an error.

*Index.* Reading yields one index row per capture: URL key (SURT order), timestamp,
digest, archive, offset. Those of an archive are sorted there and form a run. Runs are dealt
to ranges of (key, timestamp), and in each range a loser tree merges the k runs
into one ordered history. Ranges hold about ``RANGE_ROWS`` rows each: the order
includes the id, so even a single URL's captures can be split. ``capture`` numbers the
captures within their range, which is ``range``; both together order the whole index.

Defined cases: null html is an empty payload; a null url gets an empty target and key; pages have no
capture time, so it is derived from the id, a second each; rows with the id of the response are responses themselves; of a repeated or null
id, each payload is a response or a revisit on its own; payloads that only null ids have are all responses; a null id sorts first; an empty table gives empty archives and an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, stored, table, utf8
from tidemark.session import scratch_path

ARCHIVE_BYTES = 16 << 20
RANGE_ROWS = 100_000
BROADCAST_ROWS = 100_000
INDEX = "url_key string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, at long"
NAMES = [c.split()[0] for c in INDEX.split(", ")]
ARROW = [pa.int64() if c.endswith(" long") else pa.string() for c in INDEX.split(", ")]
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line: line breaks and NUL are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A").replace("\0", "%00") if any(c in value for c in "\r\n\0") else value


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record without the two line breaks that end it."""
    when = (EPOCH + timedelta(seconds=(page_id or 0) % 2**31)).strftime("%Y-%m-%dT%H:%M:%SZ")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {when}",
             f"WARC-Target-URI: {_clean(url or '')}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block


def records(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """Header, offset and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        header = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(header["Content-Length"])
        yield header, at, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def url_key(url: str) -> str:
    """Host labels reversed, then path and query: captures of a site stand together."""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    labels = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{labels}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple]:
    """K-way merge of sorted runs by a loser tree; of equal items, that of the earlier run first.

    Inner nodes hold the run that lost there; each item costs one replay from its leaf to the root.
    """
    k = len(runs)
    if not k:
        return
    ends = [iter(r) for r in runs]
    heads = [next(it, None) for it in ends]

    def before(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a], a) < (heads[b], b)

    tree = [-1] * k
    for leaf in range(k):  # seed: a run climbs until it meets an empty place, where it waits
        winner, node = leaf, (leaf + k) // 2
        while node > 0:
            if tree[node] < 0:
                tree[node] = winner
                break
            if before(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        else:
            tree[0] = winner
    while heads[tree[0]] is not None:
        winner = tree[0]
        yield heads[winner]
        heads[winner] = next(ends[winner], None)
        node = (winner + k) // 2
        while node > 0:
            if before(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner


def _write(archive_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, filled, number = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            names, out = [], []
            columns = [b.column(k).to_pylist() for k in (0, 1, 3)]
            for page_id, url, refers_to, payload in zip(*columns, utf8(b.column(2))):
                size, digest = len(payload), digest32(payload)
                if filled and filled + size > archive_bytes:
                    number, filled = number + 1, 0
                filled += 256 + (size if refers_to is None else 0)
                names.append(f"{part:06d}-{number:06d}")
                out.append(record(page_id, url, payload, size, digest, refers_to))
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary()).cast(pa.string()), "archive": pa.array(names, pa.string())})

    return rows


def write_archives(pages: DataFrame, path: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives below ``path``."""
    bounded_batches(pages.sparkSession, 512)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    # Ids and digests alone decide which records are revisits; payloads are not shuffled for it.
    slim = slim.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    marks = stored(slim.select("page_id", F.octet_length("html").cast("long").alias("size"), "digest"), "warc-digests")
    groups = marks.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # A mark is of one id and one payload: rows of an id with other payloads are looked at on their own.
    revisits = marks.join(groups, "digest").where("page_id < first or page_id is null and first is not null").select("page_id", "digest", "first").distinct()
    # Rows without an equal one, nearly all, are written where they are read.
    later = F.broadcast(revisits) if revisits.count() <= BROADCAST_ROWS else revisits
    met = slim.alias("p").join(later.alias("r"), F.expr("p.page_id <=> r.page_id and p.digest = r.digest"), "left").select("p.page_id", "url", "html", F.col("first").alias("refers_to"))
    out = met.mapInArrow(_write(archive_bytes), "value string, archive string")
    out.write.partitionBy("archive").option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record of each archive, sorted: the archive's run of the index."""
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            rows = []
            for header, at, block in records(gzip.decompress(content)):
                head, _, payload = block.partition(b"\r\n\r\n")
                size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                digest, kind = header["WARC-Payload-Digest"].removeprefix("sha1:"), header["WARC-Type"]
                if kind == "response" and (len(payload) != size or digest32(payload) != digest):
                    raise ValueError(f"{path}: the record at byte {at} does not match its digest")
                number = lambda name: int(header[name].removeprefix("<urn:page:").rstrip(">") or "-1") if name in header and header[name] != "<urn:page:>" else None
                url = header["WARC-Target-URI"]
                rows.append((url_key(url), header["WARC-Date"], number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To"), path.rsplit("/", 2)[-2], at))
            rows.sort(key=lambda r: (r[0], r[1], -1 << 63 if r[2] is None else r[2], r[8]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 9, ARROW)], NAMES)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index rows of the archives below ``path``, each archive's run sorted; archives are bounded, and read whole."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    bounded_batches(spark, 4)
    return files.select("path", "content").mapInArrow(_read, INDEX)


def merged_index(index: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The whole index in order: runs dealt to key ranges, and merged in each by a loser tree."""
    ranges = max(1, -(-index.count() // range_rows))
    if ranges > 1:
        dealt = index.repartitionByRange(ranges, "url_key", "timestamp", F.col("page_id").asc_nulls_first())
    else:
        dealt = index.coalesce(1)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, runs = TaskContext.get().partitionId(), {}
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                runs.setdefault(row[7], []).append(((row[0], row[1], -1 << 63 if row[2] is None else row[2], row[7], row[8]), row))
        # Rows of one run arrive in the order of the run unless its file was split or fetched in pieces.
        ordered = [r if all(x[0] <= y[0] for x, y in zip(r, r[1:])) else sorted(r) for _, r in sorted(runs.items())]
        rows = [(*row, part, n) for n, (_, row) in enumerate(merge_runs(ordered))]
        for i in range(0, len(rows), 8192):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 8192]), [*ARROW, pa.int64(), pa.int64()])], [*NAMES, "range", "capture"])

    return dealt.mapInArrow(merge, f"{INDEX}, range long, capture long")


def archived(pages: DataFrame, least: int = 0, archive_bytes: int = ARCHIVE_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``pages`` written as archives in the shared folder, read back and indexed."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_archives(pages, path, least, archive_bytes)
    if not pages.limit(1).count():
        return spark.createDataFrame([], f"{INDEX}, range long, capture long")
    return merged_index(stored(read_archives(spark, path), "warc-runs"), range_rows)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "archive", "at", "range", "capture")


ORACLE = None
