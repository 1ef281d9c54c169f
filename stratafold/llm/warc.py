"""WARC archives (op 5): captures written as gzip members, indexed by locally sorted runs that a loser tree merges into
globally ordered capture histories.

Archives go to the session's shared folder (spark.checkpoint.dir), which Python workers reach through pyarrow's file systems
(file, hdfs, s3, gs). A task names its archive anew on every attempt, and only archives that the committed index names
count, so a lost executor leaves at most an unused file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.common import fresh_path, materialise, tidy

#: Payloads of at least this many bytes are stored once; bytes per archive file; first capture time where none is given.
LEAST_REVISIT, ARCHIVE_BYTES, EPOCH = 100, 1 << 28, datetime(2024, 1, 1, tzinfo=timezone.utc)
_INDEX = "run long, seq long, url_key string, captured string, page_id long, record_type string, refers_to long, payload_digest string, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query; scheme, leading www and fragment left out."""
    try:
        u = urlsplit((url or "").strip())
        host = (u.hostname or "").lower()
        port = f":{u.port}" if u.port and u.port not in (80, 443) else ""
    except ValueError:
        return (url or "").lower()
    labels = host.removeprefix("www.").split(".")
    return f"{','.join(reversed(labels))}{port}){u.path or '/'}{'?' + u.query if u.query else ''}"


def record(page_id: int | None, url: str | None, captured: str, kind: str, refers_to: int | None, digest: str, payload: bytes) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head, which tells the payload's length, and leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {captured}", f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    return " ".join((url or "").split())


def parse_record(raw: bytes) -> dict:
    """Fields of a record and of the HTTP head in it, and the payload (None in a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    n = int(fields["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[16:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    number = lambda key: int(x) if (x := fields.get(key, "")[10:-1]) else None
    return {"page_id": number("warc-record-id"), "record_type": fields["warc-type"], "refers_to": number("warc-refers-to"), "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"), "payload_bytes": length, "payload": payload if fields["warc-type"] == "response" else None}


class LoserTree:
    """Merges sorted lists of (key, item): the losers of the matches stay in the inner nodes, so that the next smallest
    head costs one match per level."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        k = len(runs)
        self.heads = [next(r, None) for r in runs]
        self.tree = [-1] * max(k, 1)
        for leaf in range(k):
            self._play(leaf, building=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x[0], a) <= (y[0], b))

    def _play(self, leaf: int, building: bool = False) -> None:
        winner = leaf
        node = (leaf + len(self.runs)) // 2
        while node:
            if building and self.tree[node] < 0:
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.tree[0]] is not None:
            top = self.tree[0]
            yield self.heads[top]
            self.heads[top] = next(self.runs[top], None)
            self._play(top)


def _with_scheme(spark, folder: str) -> str:
    """The folder as a URI with the scheme of the session's file system, for workers that have no Hadoop settings."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows: list[tuple] = []
                for i in range(batch.num_rows):
                    x = {c: batch.column(c)[i].as_py() for c in ("page_id", "url", "html", "payload_digest", "refers_to")}
                    if out is None or at > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    captured = (EPOCH + timedelta(seconds=(x["page_id"] or 0) % 10**9)).strftime("%Y-%m-%dT%H:%M:%SZ")
                    kind = "response" if x["refers_to"] is None else "revisit"
                    raw = record(x["page_id"], x["url"], captured, kind, x["refers_to"], x["payload_digest"], (x["html"] or "").encode("utf-8", "surrogatepass"))
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    rows.append((url_key(x["url"]), captured, x["page_id"], kind, x["refers_to"], x["payload_digest"], name, at, len(member)))
                    at += len(member)
                if rows:
                    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["url_key", "captured", "page_id", "record_type", "refers_to", "payload_digest", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return run


def with_revisits(pages: DataFrame) -> DataFrame:
    """Pages with payload_digest, and refers_to: the smallest page_id with an equal payload of at least LEAST_REVISIT bytes,
    null for that page itself and for small payloads. Repeated rows of that page are responses again."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).alias("n"))
    again = slim.where(f"n >= {LEAST_REVISIT}").groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return slim.join(again, "payload_digest", "left").select("page_id", "url", "html", "payload_digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages to archives under `folder` and return the index runs, committed to the shared folder: a run is the
    index of one task, sorted by URL key, capture time and page, with run and seq."""
    made = with_revisits(pages).mapInArrow(tidy(_writer(_with_scheme(pages.sparkSession, folder))), _INDEX.removeprefix("run long, seq long, "))
    runs = made.sortWithinPartitions("url_key", "captured", "page_id").withColumn("run", F.spark_partition_id().cast("long")).withColumn("seq", F.monotonically_increasing_id())
    return materialise(runs.select("run", "seq", "url_key", "captured", "page_id", "record_type", "refers_to", "payload_digest", "file", "offset", "length"), "capture-runs")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices of all runs that fall into one range, merged. They come run by run, each in order; their columns stay in
    Arrow, and only the heads of the runs are laid out as keys."""
    from pyspark import TaskContext

    held = list(batches)
    if not sum(b.num_rows for b in held):
        return
    whole = pa.Table.from_batches(held).combine_chunks()
    run = whole.column("run").to_numpy()
    edges = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]
    url, captured, page = (whole.column(c).chunk(0) for c in ("url_key", "captured", "page_id"))

    def slice_of(lo: int, hi: int) -> Iterator[tuple]:
        for i in range(lo, hi):
            p = page[i].as_py()
            yield (url[i].as_py(), captured[i].as_py(), p is not None, p or 0), i

    tree = LoserTree([slice_of(lo, hi) for lo, hi in zip(edges, edges[1:])])
    range_no = TaskContext.get().partitionId()
    at = 0
    order = np.fromiter((i for _, i in tree), np.int64, len(run))
    for low in range(0, len(order), 65536):
        part = whole.take(pa.array(order[low : low + 65536]))
        n = part.num_rows
        part = part.append_column("range_no", pa.array(np.full(n, range_no, np.int64))).append_column("place", pa.array(np.arange(at, at + n)))
        at += n
        yield from part.combine_chunks().to_batches()


#: Index rows of a range, about; a row takes some 300 bytes of the task that merges it.
RANGE_ROWS = 50_000


def merge_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The runs merged into one order by URL key, capture time and page: range_no and place put all rows in that order.

    Ranges of the key are cut from samples, about range_rows rows each, so that a task's memory does not grow with the
    input; Spark's range exchange brings a range the slices of all runs, in the order of the runs, and the task merges them
    with a loser tree. The key of the ranges ends in file and offset, so one URL, host or repeated page with many captures
    spreads over ranges; where a page repeats within one capture time its rows stand in any order."""
    n = max(1, -(-runs.count() // range_rows))
    ranged = runs.repartitionByRange(n, "url_key", "captured", "page_id", "file", "offset").sortWithinPartitions("run", "seq")
    return materialise(ranged.mapInArrow(tidy(_merge), _INDEX + ", range_no long, place long"), "capture-index")


def read_archives(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Read every record that the index names: page_id, payload_bytes, payload_digest, record_type, refers_to, and the
    payload of responses if wanted. Bytes and digest of a stored payload are worked out from what is read."""

    uri = _with_scheme(index.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        files, root = _file_system(uri)
        name, src = None, None
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), *([pa.binary()] if payloads else [])]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]
        table = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    if src is not None:
                        src.close()
                    name, src = file, files.open_input_file(f"{root}/{file}")
                x = parse_record(zlib.decompress(src.read_at(length, offset), 31))
                if x["payload"] is not None and (len(x["payload"]) != x["payload_bytes"] or hashlib.sha256(x["payload"]).hexdigest() != x["payload_digest"]):
                    raise ValueError(f"record at {offset} of {file} does not match its digest")
                out.append((x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"], *([x["payload"]] if payloads else [])))
                held += len(x["payload"] or b"") * payloads
                if held > 8_000_000:
                    yield table(out)
                    out, held = [], 0
            if out:
                yield table(out)
        if src is not None:
            src.close()

    slim = index.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return slim.mapInArrow(tidy(run), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads)


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages(page_id, url, html) to archives, merge their index and read the archives back: a row per page. Null html
    is an empty payload, a null URL has an empty key, a null page_id is kept and never referred to. Repeated rows are archived
    as often as they occur; long payloads are kept whole. Other columns are not read, whatever their names; an empty table
    gives an empty table."""
    folder = folder or fresh_path(pages.sparkSession, "archives")
    return read_archives(merge_index(write_archives(pages, folder)), folder)


def oracle() -> str:
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::bigint AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""
