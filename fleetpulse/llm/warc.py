"""WARC archives, and their index by an external merge.

Pages are written as WARC records by Spark's text writer, one record a
row, with the record's closing blank lines as the line separator, in files
compressed by gzip; so any file system of Spark holds the archives, and a
lost task is written anew.
Of equal payloads of SHARED bytes or more, the page with the largest id is
a response, the others are revisits of it. Archives are read back as whole
files, whose size the largest payload bounds, and parsed by their
Content-Length; offsets are those of the uncompressed archive.

The captures of each archive, sorted, are a run. The runs are dealt out by
ranges of (URL key, time, page id) of a bounded number of captures, and in
each range a loser tree merges them. The ranges one after the other hold
all captures in order; a capture's place in it is its range's first place
and its own within the range.

Defined cases: a null payload is empty. A null URL has an empty key and no
target header; a null time is no date header, and first of its URL key. A
null page id is read back as null; it is never the largest, so such a page
revisits any that has its payload, and is a response if none has an id.
Line breaks in a URL are written percent-encoded. Rows that repeat a page
id and payload are all responses (or all revisits); captures that are
alike in key, time and page id stand in the order of their runs. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, table, written
from fleetpulse.session import shared_dir

SHARED = 1000  # bytes from which equal payloads are stored once
FILE_RECORDS = 2000  # records of an archive file, at most
FILE_BYTES = 64 << 20  # and about so many bytes, unless one record has more
RANGE_ROWS = 200_000  # captures of a merged range, about
EPOCH = 1_700_000_000  # capture time of page 0 in the query; a page's id counts seconds on
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE_SCHEMA = (
    "run string, seq long, url_key string, capture_date string, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, offset long, intact boolean"
)


def records(pages: DataFrame) -> DataFrame:
    """(record) texts of rows (page_id, url, html, capture_ts)."""
    date = F.date_format(F.to_utc_timestamp("capture_ts", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        date.alias("date"),
    )
    base = base.withColumns({"bytes": F.octet_length("html"), "sha": F.sha1(F.encode("html", "UTF-8"))})
    # Only payloads that occur under several ids are joined.
    first = base.filter(F.col("bytes") >= SHARED).groupBy("sha").agg(
        F.max("page_id").alias("first"), F.min("page_id").alias("other"), F.count_if(F.col("page_id").isNull()).alias("without")
    )
    first = first.filter("first <> other OR first IS NOT NULL AND without > 0").select("sha", "first")
    base = base.join(first, "sha", "left")
    revisit = (F.col("bytes") >= SHARED) & F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\n"),
        line("WARC-Record-ID", uri("page_id")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.col("date")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha"))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", uri("first")), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
    )
    base = base.withColumns({"revisit": revisit, "http": http})
    return base.select(F.concat(head, F.col("http"), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html"))).alias("record"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Archive files of at most FILE_RECORDS records, and fewer where the largest payload makes records long."""
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    most = max(1, min(FILE_RECORDS, FILE_BYTES // (largest + 4096)))
    records(pages).write.option("lineSep", END).option("maxRecordsPerFile", most).option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], dict[str, str], bytes]]:
    """(offset, WARC headers, HTTP headers, payload) of each record of an archive."""
    at, end = 0, END.encode()
    while at < len(data):
        cut = data.index(end, at)
        head = dict(x.split(": ", 1) for x in data[at:cut].decode("utf-8").split("\r\n")[1:])
        body = cut + len(end)
        stop = body + int(head["Content-Length"])
        http_end = data.index(end, body)
        http = dict(x.split(": ", 1) for x in data[body:http_end].decode("utf-8").split("\r\n")[1:])
        yield at, head, http, data[http_end + len(end) : stop]
        at = stop + len(end)


def url_key(url: str) -> str:
    """Sort key of a URL: host parts from the last to the first, then the rest, without fragment."""
    _, mark, rest = url.partition("://")
    if not mark:
        return url
    rest = rest.partition("#")[0]
    at = min((i for i in (rest.find(c) for c in "/?") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:at].lower().split("."))) + ")" + rest[at:]


def sort_key(url_key: str, date: str | None, page_id: int | None) -> tuple:
    """Order of captures; what is null comes first."""
    return url_key, date or "", page_id is not None, page_id or 0


def _page(urn: str | None) -> int | None:
    return int(urn.removeprefix("<urn:page:").removesuffix(">")) if urn else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives, a sorted run for each file; digests are those of the payloads read."""
    schema = pa.schema([
        ("run", pa.string()), ("seq", pa.int64()), ("url_key", pa.string()), ("capture_date", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("offset", pa.int64()), ("intact", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for at, head, http, payload in parse(gzip.decompress(content.as_buffer())):
                    stated = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    full = head["WARC-Type"] == "response"
                    digest = hashlib.sha1(payload).hexdigest() if full else stated
                    size = len(payload) if full else int(http["Content-Length"])
                    rows.append((
                        url_key(head.get("WARC-Target-URI", "")), head.get("WARC-Date"), _page(head.get("WARC-Record-ID")), size, digest,
                        head["WARC-Type"], _page(head.get("WARC-Refers-To")), at, digest == stated,
                    ))
                rows.sort(key=lambda r: (*sort_key(*r[:3]), r[7]))
                out = Batches(schema, max_rows=FILE_RECORDS)
                for i, r in enumerate(rows):
                    if (full_batch := out.add((name, i, *r))) is not None:
                        yield full_batch
                if (rest := out.flush()) is not None:
                    yield rest

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, CAPTURE_SCHEMA)


class LoserTree:
    """Merges sorted runs: each inner node holds the loser of its two sides, the winner moves up."""

    def __init__(self, runs: list[list]):
        self.runs, self.k = runs, max(1, len(runs))
        self.at = [0] * len(runs)
        self.losers = [0] * self.k
        self.winner = self._build(1) if runs else 0

    def _less(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return y is None or (x is not None and (x, a) < (y, b))

    def _head(self, r: int):
        return self.runs[r][self.at[r]] if self.at[r] < len(self.runs[r]) else None

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self._less(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, position) in merged order; equal heads by the run's number."""
        while self.runs and self._head(self.winner) is not None:
            r = self.winner
            yield r, self.at[r]
            self.at[r] += 1
            node = (r + self.k) // 2
            while node:
                if self._less(self.losers[node], r):
                    self.losers[node], r = r, self.losers[node]
                node //= 2
            self.winner = r


def merged(captures: DataFrame) -> DataFrame:
    """Captures with `place`, their place from 0 on in the order of (url_key, capture_date, page_id) over all archives."""
    spark = captures.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // RANGE_ROWS))
    dealt = captures.repartitionByRange(ranges, "url_key", "capture_date", "page_id").sortWithinPartitions("run", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)  # index rows of one range, without payloads
        keys = [sort_key(*k) for k in zip(*(rows.column(c).to_pylist() for c in ("url_key", "capture_date", "page_id")), strict=True)]
        runs: list[list] = []
        starts: list[int] = []
        last = None
        for i, name in enumerate(rows.column("run").to_pylist()):
            if name != last:
                runs.append([])
                starts.append(i)
                last = name
            runs[-1].append(keys[i])
        order = pa.array([starts[r] + i for r, i in LoserTree(runs)], pa.int64())
        rows = rows.take(order).append_column("pos", pa.array(range(len(order)), pa.int64()))
        yield from rows.to_batches(max_chunksize=10_000)

    index = written(dealt.mapInArrow(run, CAPTURE_SCHEMA + ", pos long").withColumn("part", F.spark_partition_id()), "warc-index")
    sizes = index.groupBy("part").agg(F.count("*").alias("size"))  # one row for each range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    return index.join(F.broadcast(firsts), "part").withColumn("place", F.col("first") + F.col("pos")).drop("part", "pos", "first")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes rows (page_id, url, html, capture_ts) as archives and returns their merged index."""
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path)
    return merged(written(read_archives(spark, path), "warc-runs"))


def q_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    stamped = pages.withColumn("capture_ts", F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.col("page_id").cast("long"), F.lit(0))))
    return round_trip(stamped).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture_date", "place")


SQL = f"""WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p),
u AS (SELECT *, payload_bytes >= {SHARED} AND last IS NOT NULL AND page_id IS DISTINCT FROM last AS again,
             split_part(substr(url, strpos(url, '://') + 3), '#', 1) AS rest FROM f),
h AS (SELECT *, regexp_extract(rest, '^[^/?]*') AS host FROM u),
r AS (SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN last END AS refers_to,
       CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN coalesce(url, '')
            ELSE array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')' || substr(rest, length(host) + 1) END AS url_key,
       strftime(make_timestamp(({EPOCH} + coalesce(page_id, 0)) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS capture_date
 FROM h)
SELECT *, row_number() OVER (ORDER BY url_key, capture_date, page_id NULLS FIRST) - 1 AS place FROM r"""
