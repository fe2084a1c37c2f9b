"""WARC archives with a two-level capture index.

Writing: every page is a record. Of records with equal payloads (the html in
UTF-8) of at least REVISIT_BYTES bytes, that with the largest page_id is a
response and the others revisit it: they carry its digest, id and URL key,
and no payload. Records are gzip members, about ARCHIVE_BYTES of payload to a
file; a file's name holds the task attempt that wrote it, and only the
attempts that succeeded are listed, so lost and repeated tasks do no harm.

Index: captures are sorted by the URL with its host reversed
(``org,example,www)/path``), the page_id and the place in the archive, and
written as compressed blocks of BLOCK_LINES lines, many to a part file, one
part for each range of keys. Level one is the part's directory, a line
for each block with its first key and place, at the end of the part file; level
two is one row for each part with its first key and its directory's place.

Reading: ``lookup`` finds URL keys by binary search over the parts, then over
the part's directory, and range reads of the block and of the records alone.
``read_captures`` replays the whole index: records are range-read from the
archives in the index's order; a revisit's payload is looked up through the
index by the key and id that it names.

Files are opened by their URI (local or any store pyarrow knows), under the
folder in spark.checkpoint.dir; pages are read by Spark alone.

Defined cases: null html is an empty payload, null url an empty key; pages
with a null page_id are written and read like others (a null id is the
smallest; among equal ids of equal payloads one row is the response, the rest
revisit it); repeated rows are records each; an empty table gives no rows;
columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import posixpath
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import saved, scratch

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
BLOCK_LINES = 300
KEPT_BLOCKS, KEPT_PAYLOADS = 64, 16
DATE = "2024-01-01T00:00:00Z"


def surt(url: Column) -> Column:
    """The sort key of a URL: host labels reversed, then port, path and query, all in lower case for the host."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#:]*)", 1))
    tail = F.regexp_replace(F.regexp_replace(rest, r"^[^/?#:]*", ""), r"#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)


def planned(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, key, payload, digest, top): top holds the id and key
    of the response that a revisit names. The best of a group of equal payloads
    is a partial aggregate, so copies are not gathered; the pages join it on
    their digest, a join that Spark can split where a digest is frequent.

    The response is known by its content, not by a row number, which two scans
    need not agree on. If rows are equal to it throughout, one of them is the
    response and the others, all alike, are counted and made revisits."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    p = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", surt(F.col("url")).alias("key"), "payload", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
    first = (p.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size", "page_id", "url", "key").agg(F.count(F.lit(1)).alias("rows"))
             .groupBy("digest", "size").agg(F.sum("rows").alias("n"), F.max(F.struct(F.col("page_id").alias("id"), "url", "key", "rows")).alias("top"))
             .where("n > 1").select(F.col("digest").alias("d"), F.col("size").alias("s"), "top"))
    first = saved(first, "op8-first")
    named = F.struct(F.col("top.id").alias("id"), F.col("top.key").alias("key"))
    same = (p["digest"] == F.col("d")) & (p["size"] == F.col("s"))
    is_top = F.col("page_id").eqNullSafe(F.col("top.id")) & F.col("url").eqNullSafe(F.col("top.url"))
    joined = p.join(first, same, "left")
    alone = (joined.where(F.col("d").isNull() | ~is_top | (F.col("top.rows") == 1))
             .select("page_id", "url", "key", "payload", "digest", F.when(F.col("d").isNotNull() & ~is_top, named).alias("top")))
    # rows equal to the response: equal payloads, so the greatest is any of them
    equal = (p.join(first.where("top.rows > 1"), same & is_top).groupBy("digest", "size", "top")
             .agg(F.max("payload").alias("payload")).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("top.rows"))).alias("i")))
    equal = equal.select(F.col("top.id").alias("page_id"), F.col("top.url").alias("url"), F.col("top.key").alias("key"),
                         F.when(F.col("i") == 1, F.col("payload")).otherwise(F.lit("").cast("binary")).alias("payload"),
                         "digest", F.when(F.col("i") > 1, named).alias("top"))
    return alone.unionByName(equal)


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


def _header(fields: dict[str, str], length: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode("ascii")


def _id(page_id: int | None) -> str:
    return "" if page_id is None else str(page_id)


def record(page_id, url, key, payload: bytes, digest: str, top) -> tuple[bytes, bool]:
    """(record, is a revisit)."""
    revisit = top is not None
    fields = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:page:{_id(page_id)}>",
              "WARC-Date": DATE, "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;="), "WARC-Payload-Digest": f"sha1:{digest}"}
    if revisit:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   "WARC-Refers-To": f"<urn:page:{_id(top['id'])}>", "X-Refers-To-Key": quote(top["key"], safe="")}
        payload = b""
    return _header(fields, len(payload)) + payload + b"\r\n\r\n", revisit


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, payload) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("ascii").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than it says")
    return fields, rest[:n]


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns the captures: rows (key, page_id, type,
    digest, path, at, size), saved."""
    plan = planned(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        ctx = TaskContext.get()
        out, path, n_files, held, at = None, "", 0, 0, 0
        try:
            for b in batches:
                rows = []
                for r in b.to_pylist():
                    if out is None or held >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        path = f"pages-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{n_files:04d}.warc.gz"
                        out, n_files, held, at = fs.open_output_stream(posixpath.join(root, path), compression=None), n_files + 1, 0, 0
                        info = gzip.compress(_header({"WARC-Type": "warcinfo", "WARC-Date": DATE, "WARC-Record-ID": f"<urn:file:{path}>"}, 0) + b"\r\n\r\n", 6, mtime=0)
                        out.write(info)
                        at = len(info)
                    data, revisit = record(r["page_id"], r["url"], r["key"], r["payload"], r["digest"], r["top"])
                    member = gzip.compress(data, 6, mtime=0)
                    out.write(member)
                    rows.append((r["key"], r["page_id"], "revisit" if revisit else "response", r["digest"], path, at, len(member)))
                    at += len(member)
                    held += len(data)
                cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
                types = [pa.string(), b.schema.field("page_id").type, pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["key", "page_id", "type", "digest", "path", "at", "size"])
        finally:
            if out is not None:
                out.close()
    kind = pages.schema["page_id"].dataType.simpleString()
    return saved(plan.mapInArrow(run, f"key string, page_id {kind}, type string, digest string, path string, at long, size long"), "op8-captures")


Place = tuple[bytes, bool, int]


def _place(key: str, page: int | None) -> Place:
    """A capture's place in the order of the index: Spark's order of strings, null ids first."""
    return key.encode(), page is not None, page or 0


def write_index(captures: DataFrame, folder: str) -> list[tuple[Place, str, int, int]]:
    """Writes the sorted blocks and returns level two: (first capture, part,
    its directory's place and size) for each part. A part holds what one task of a
    range partitioning holds, so the list grows with the tasks, not the pages."""
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal keys are told apart by the id and the place, so that no key is one range
    order = ["key", "page_id", "path", "at"]
    ranged = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        ctx = TaskContext.get()
        lines, directory, at, out, name = [], [], 0, None, ""

        def block() -> None:
            nonlocal at
            data = gzip.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode(), 6, mtime=0)
            out.write(data)
            directory.append([*lines[0][:2], at, len(data)])
            at += len(data)
            lines.clear()
        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"index-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.cdx.gz"
                    out = fs.open_output_stream(posixpath.join(root, name), compression=None)
                lines.append([r["key"], r["page_id"], r["type"], r["digest"], r["path"], r["at"], r["size"]])
                if len(lines) == BLOCK_LINES:
                    block()
        if out is not None:
            if lines:
                block()
            data = gzip.compress(json.dumps(directory, ensure_ascii=False).encode(), 6, mtime=0)
            out.write(data)
            out.close()
            key, page = directory[0][:2]
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([page], pa.int64()), pa.array([name]), pa.array([at]), pa.array([len(data)])],
                                             ["key", "page", "part", "at", "size"])
    made = saved(ranged.mapInArrow(run, "key string, page long, part string, at long, size long"), "op8-parts")
    return sorted((_place(r["key"], r["page"]), r["part"], r["at"], r["size"]) for r in made.collect())  # a row for each part


class _Cached(OrderedDict):
    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def get_or(self, key, make):
        if key in self:
            self.move_to_end(key)
        else:
            self[key] = make()
            if len(self) > self.most:
                self.popitem(last=False)
        return self[key]


class Archive:
    """Reads the index and the archives by range."""

    def __init__(self, folder: str, parts: list[tuple[Place, str, int, int]]):
        self.fs, self.root = _open(folder)
        self.parts, self.firsts = parts, [p[0] for p in parts]
        self.files, self.blocks = _Cached(64), _Cached(KEPT_BLOCKS)
        self.directories, self.payloads = _Cached(KEPT_BLOCKS), _Cached(KEPT_PAYLOADS)

    def read(self, name: str, at: int, size: int) -> bytes:
        f = self.files.get_or(name, lambda: self.fs.open_input_file(posixpath.join(self.root, name)))
        return f.read_at(size, at)

    def directory(self, i: int) -> tuple[list[Place], list[list]]:
        """(the blocks' first captures, their places in the part file)."""
        _, part, at, size = self.parts[i]

        def load():
            rows = json.loads(gzip.decompress(self.read(part, at, size)))
            return [_place(*r[:2]) for r in rows], [r[2:] for r in rows]
        return self.directories.get_or(i, load)

    def block(self, i: int, j: int) -> list[list]:
        at, size = self.directory(i)[1][j]
        return self.blocks.get_or((i, j), lambda: [json.loads(x) for x in gzip.decompress(self.read(self.parts[i][1], at, size)).decode().split("\n")])

    def find(self, key: str, *page: int | None) -> Iterator[list]:
        """The captures of a key, or of a key and page: binary search in the
        parts, then in a part's directory."""
        low = _place(key, *page) if page else (key.encode(), False, 0)
        high = low if page else (key.encode(), True, 1 << 63)
        # captures from low on may begin in the block before the first that starts there
        i = max(0, bisect.bisect_left(self.firsts, low) - 1)
        while i < len(self.parts) and self.firsts[i] <= high:
            firsts, _ = self.directory(i)
            j = max(0, bisect.bisect_left(firsts, low) - 1)
            while j < len(firsts) and firsts[j] <= high:
                for line in self.block(i, j):
                    if low <= _place(*line[:2]) <= high:
                        yield line
                j += 1
            i += 1

    def record(self, path: str, at: int, size: int) -> tuple[dict[str, str], bytes]:
        return parse(gzip.decompress(self.read(path, at, size)))

    def original(self, key: str, page: int | None, digest: str) -> tuple[str, bytes]:
        """(digest, payload) of the response that a revisit names."""
        def load():
            for line in self.find(key, page):
                if line[2] == "response" and line[3] == digest:
                    _, payload = self.record(*line[4:7])
                    return hashlib.sha1(payload).hexdigest(), payload
            raise LookupError(f"no response {page} at {key}")
        return self.payloads.get_or((key, page, digest), load)


def _named(fields: dict[str, str]) -> int | None:
    """The page that a revisit names."""
    n = fields["WARC-Refers-To"][len("<urn:page:"):-1]
    return int(n) if n else None


def read_captures(spark: SparkSession, folder: str, parts: list[tuple[Place, str, int, int]], id_type: str) -> DataFrame:
    """Rows (page_id, url, payload, payload_digest, record_type, refers_to):
    every capture of the index, its payload read back in full."""
    todo = spark.range(0, len(parts), 1, max(1, len(parts)))
    kept = spark.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Archive(folder, kept.value)
        kind = pa.int32() if id_type == "int" else pa.int64()
        for b in batches:
            for i in b.column(0).to_pylist():
                for j in range(len(a.directory(i)[0])):
                    rows = []
                    for _, page, what, digest, path, at, size in a.block(i, j):
                        fields, payload = a.record(path, at, size)
                        got, refers = hashlib.sha1(payload).hexdigest(), None
                        if fields["WARC-Type"] == "revisit":
                            refers = _named(fields)
                            got, payload = a.original(unquote(fields["X-Refers-To-Key"]), refers, digest)
                        if fields["WARC-Payload-Digest"] != f"sha1:{got}" or fields["WARC-Type"] != what:
                            raise ValueError(f"record {page} does not agree with its header or the index")
                        rows.append((page, unquote(fields["WARC-Target-URI"]), payload, got, what, refers))
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, (kind, pa.string(), pa.binary(), pa.string(), pa.string(), kind))],
                        ["page_id", "url", "payload", "payload_digest", "record_type", "refers_to"])
    schema = f"page_id {id_type}, url string, payload binary, payload_digest string, record_type string, refers_to {id_type}"
    return todo.mapInArrow(run, schema)


def lookup(spark: SparkSession, folder: str, parts: list[tuple[Place, str, int, int]], urls: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Rows (url, page_id, record_type, payload): the captures of the given URLs (column url)."""
    kept = spark.sparkContext.broadcast(parts)

    def run(batches):
        a = Archive(folder, kept.value)
        for b in batches:
            for url, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for _, page, what, digest, path, at, size in a.find(key):
                    fields, payload = a.record(path, at, size)
                    if what == "revisit":
                        payload = a.original(unquote(fields["X-Refers-To-Key"]), _named(fields), digest)[1]
                    yield pa.RecordBatch.from_pylist([{"url": url, "page_id": page, "record_type": what, "payload": payload}],
                                                     pa.schema([("url", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload", pa.binary())]))
    return urls.select("url", surt(F.col("url")).alias("key")).mapInArrow(run, f"url string, page_id {id_type}, record_type string, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages, indexes them, and reads all captures back."""
    spark = pages.sparkSession
    folder = scratch(spark, "op8-warc")
    parts = write_index(write_archives(pages, folder), folder)
    return read_captures(spark, folder, parts, pages.schema["page_id"].dataType.simpleString())


def digest(read: DataFrame) -> DataFrame:
    return read.select("page_id", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d FROM p),
g AS (SELECT d, n, max(page_id) AS top, count(*) AS k FROM q WHERE n >= {REVISIT_BYTES} GROUP BY d, n)
SELECT q.page_id, CAST(q.n AS BIGINT) AS payload_bytes, q.d AS payload_digest,
       CASE WHEN g.k > 1 AND q.page_id <> g.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.k > 1 AND q.page_id <> g.top THEN g.top END AS refers_to
FROM q LEFT JOIN g USING (d, n)
"""
