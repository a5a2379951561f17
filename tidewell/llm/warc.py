"""WARC archives: a writer that dedupes payloads, and a splittable reader.

Archives are gzip files with one member a record. The reader plans byte ranges
of a fixed size over all files. A task looks for the gzip magic in its range,
accepts a candidate if the member decodes and begins with a WARC header, and
owns the records whose members start inside its range; a record that runs past
the end is read on from the bytes behind it. From an accepted member on, the
next one must begin where it ends, so scanning is only needed at the start of
a range and after damage.

A payload that itself holds a stored (not compressed) WARC member can start a
range wrongly; the writer's archives have none, since it deflates all payloads.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.store import qualified

MAGIC = b"\x1f\x8b\x08"
#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 1000
SPLIT_BYTES = 8 << 20
#: More tasks than this share splits.
MAX_TASKS = 20_000
READ = 1 << 20
URN = "urn:page:"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def open_store(path: str):
    """(file system, path) of a path or URI; archives may lie wherever pyarrow reaches."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def assign(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``digest``, ``size``, ``record_type`` and ``refers_to``.

    Of equal payloads of REVISIT_BYTES or more the row of the largest page_id
    is the response. Only digests that occur twice meet the rows again, spread
    over SALTS parts, so a payload of a third of all pages is no hot key.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    salts = 16
    large = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
    twice = large.where("n > 1 AND first IS NOT NULL").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    joined = salted.join(twice, ["digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & (F.col("size") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", "size", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, kind: str, refers_to: int | None) -> bytes:
    """One WARC record, not compressed. A revisit has HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    name = f"{URN}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    target = "".join(c if " " < c < "\x7f" else f"%{c.encode('utf-8', 'replace').hex()}" for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        *([f"WARC-Target-URI: {target}"] if target else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{refers_to}>"] if kind == "revisit" else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write a record for every row of ``pages``, one archive a task, and return the list of archives (path, bytes, records).

    A task writes under a name of its own attempt. The list names the attempts
    that ended well and is itself a table in ``folder``, so what a lost or
    repeated attempt left is never read. Null html is an empty payload; a row
    without page_id is written with a name made from its digest. Repeated rows
    are written each; those of the largest page_id of a payload are all
    responses. Other columns than page_id, url and html are ignored. ``folder``
    is resolved as Spark does, so archives and their list lie in one store. An empty table gives no archives.
    """

    folder = qualified(pages.sparkSession, folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, written, records = TaskContext.get(), None, 0, 0
        path = f"{folder}/archives/part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                page_id, url, payload, digest, size, kind, refers_to = row
                if out is None:
                    store, local = open_store(path)
                    store.create_dir(local.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(local, compression=None)
                gzip = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = gzip.compress(record(page_id, url, payload, digest, size, kind, refers_to)) + gzip.flush()
                out.write(member)
                written, records = written + len(member), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [written], "records": [records]})

    assign(pages).mapInArrow(work, "path string, bytes long, records long").write.parquet(f"{folder}/list")
    return pages.sparkSession.read.parquet(f"{folder}/list")


def listed(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, bytes) of the archives that ``pattern`` matches, by Spark's own listing; no content is read."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("bytes"))


def header_fields(head: bytes) -> dict[str, str]:
    """Fields of a block of ``name: value`` lines by lower-case name; the first of equal names counts."""
    fields: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return fields


class Blocks:
    """Blocks of an open file, of which the last two read are kept."""

    def __init__(self, source):
        self.source, self.held = source, {}

    def at(self, offset: int) -> bytes:
        """The bytes from ``offset`` to the end of its block; none at the end of the file."""
        block = offset // READ
        if block not in self.held:
            for old in [k for k in self.held if k != block - 1]:
                del self.held[old]
            self.source.seek(block * READ)
            self.held[block] = self.source.read(READ)
        return self.held[block][offset - block * READ :]


def member(blocks: Blocks, offset: int) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member at ``offset``, if it decodes whole and begins like a WARC record."""
    gzip, content, at, waiting = zlib.decompressobj(31), bytearray(), offset, b""
    try:
        while not gzip.eof:
            if not waiting:
                waiting = blocks.at(at)
                at += len(waiting)
            if not waiting and not (rest := gzip.decompress(b"", READ)):
                return None
            if not waiting:
                content += rest
                continue
            # A little at first, so that what is no record is not inflated.
            content += gzip.decompress(waiting, READ if content else 64)
            waiting = gzip.unconsumed_tail
            if len(content) >= 5 and not content.startswith(b"WARC/"):
                return None
    except zlib.error:
        return None
    return (bytes(content), at - len(gzip.unused_data)) if len(content) >= 5 else None


def next_magic(blocks: Blocks, at: int, end: int) -> int | None:
    """The first offset from ``at`` on, below ``end``, at which the gzip magic stands."""
    while at < end:
        data = blocks.at(at)
        if not data:
            return None
        # The magic may straddle two blocks.
        found = (data + blocks.at(at + len(data))[: len(MAGIC) - 1]).find(MAGIC)
        if found >= 0:
            return at + found if at + found < end else None
        at += len(data)
    return None


def read_range(source, start: int, end: int) -> Iterator[bytes]:
    """The records whose members start in [start, end)."""
    blocks, at = Blocks(source), start
    while (at := next_magic(blocks, at, end)) is not None:
        decoded = member(blocks, at)
        if decoded is None:
            at += 1
        else:
            yield decoded[0]
            at = decoded[1]


def parse(content: bytes) -> tuple:
    """(page_id, payload bytes, payload digest, type, refers_to, payload) of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = header_fields(head)
    block = rest[: int(fields.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type", "")
    own, other = (fields.get(k, "").strip("<>") for k in ("warc-record-id", "warc-refers-to"))
    number = lambda urn: int(urn[len(URN) :]) if urn.startswith(URN) else None
    if kind == "revisit":
        size = int(header_fields(http).get("content-length", 0))
        digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return number(own), size, digest, kind, number(other), payload


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = False) -> DataFrame:
    """The records of ``archives`` (path, bytes), with the payload if ``payloads`` (null for revisits).

    Digests of responses are made from what was read; a revisit states those of
    the payload it stands for.
    """
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0).cast("long")), F.lit(split_bytes).cast("long")))
    splits = archives.where("bytes > 0").select("path", "bytes", start.alias("start"))
    tasks = max(1, min(MAX_TASKS, splits.count()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        schema = pa.schema(fields + [("payload", pa.binary())] * payloads)
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for b in batches:
            for path, size, first in zip(*[c.to_pylist() for c in b.columns], strict=True):
                store, local = open_store(path)
                with store.open_input_file(local) as source:
                    for content in read_range(source, first, min(size, first + split_bytes)):
                        *row, payload = parse(content)
                        rows.append((*row, payload if row[3] != "revisit" else None))
                        held += len(payload) if payloads else 100
                        if held > 1 << 23:
                            yield batch()
                            rows, held = [], 0
        yield batch()

    return splits.repartition(tasks).mapInArrow(work, RECORDS + (", payload binary" if payloads else ""))
