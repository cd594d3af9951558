"""WARC archives: segmented, chunked, gzipped records; and their reassembly.

The writer puts each record in a gzip member of its own. Blocks longer than a
segment continue in ``continuation`` records that name their origin; the last
one states the total length. HTTP bodies use chunked transfer framing. The
reader groups continuations by origin, orders them by segment number, checks
numbers and length, and decodes the framing.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm.memory import sliced
from concordat.operators.joins import hot_counts, keyed_join
from concordat.storage import AtomicWriter, bounded_batches, materialize, open_input, scratch, ship

SPACE = uuid.UUID("8c5e3a52-6c0b-4a43-9d6f-0f3a1c6b7e11")
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
FILE_BYTES = 64 << 20
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "record_id string, kind string, origin string, segment long, total long, refers string, page_id long, digest string, uri string, block binary, error string"
PAYLOADS = "record_id string, kind string, refers string, page_id long, uri string, payload binary, error string"


def record_name(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, key)}>"


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for i in range(0, len(body), size):
        piece = body[i : i + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    parts.append(b"0\r\n\r\n")
    return b"".join(parts)


def dechunk(data: bytes) -> bytes:
    """Undo chunked transfer framing; extensions and trailers are dropped."""
    parts, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk's size line does not end")
        size = int(data[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if at + size + 2 > len(data) or data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        parts.append(data[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message, without transfer framing."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of HTTP headers")
    fields = [x.partition(b":") for x in head.split(b"\r\n")[1:]]
    coded = any(k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower() for k, _, v in fields)
    return dechunk(body) if coded else body


def one_line(text: str) -> str:
    return " ".join(text.split()) if text else ""


def member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def records_of(key: str, page_id: int | None, uri: str | None, payload: bytes, digest: str, refers: str | None, segment_bytes: int = SEGMENT_BYTES):
    """The gzip members of one page: a response with its continuations, or a revisit."""
    name, revisit = record_name(key), refers is not None
    base = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if uri is not None:
        base.append(("WARC-Target-URI", one_line(uri)))
    if page_id is not None:
        base.append(("WARC-Page-Number", str(page_id)))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        yield member([*base, ("WARC-Refers-To", record_name(refers)), ("WARC-Profile", PROFILE)], http + b"\r\n")
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield member(base, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for n, at in enumerate(cuts, 1):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(cuts) else []
        if n == 1:
            yield member([*base, ("WARC-Segment-Number", "1")], block[:segment_bytes])
        else:
            own = f"<urn:uuid:{uuid.uuid5(SPACE, f'{key}/{n}')}>"
            yield member([("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(n)), *last], block[at : at + segment_bytes])


def write_archives(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); returns (path).

    Null html is an empty payload, null url leaves the target out. Of equal
    payloads of at least ``REVISIT_BYTES`` the row with the greatest page_id is
    the response and all rows with other ids (null too) revisit it; a repeated
    row of that same id is a response of its own. Other columns are not read.

    A record that others may revisit is named by its payload's digest and page,
    all others by their place in the files, so names do not depend on how the
    input's rows are dealt. Only large payloads are shuffled, common ones over
    all partitions.
    """
    spark = pages.sparkSession
    ship(spark)
    bounded_batches(spark)
    root = root or scratch(spark, "warc")
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary").alias("body")
    ).withColumn("digest", F.sha1("body"))
    is_large = F.octet_length("body") >= REVISIT_BYTES
    large = rows.where(is_large)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    groups = materialize(groups, "warc-groups")
    # Repeated rows hash alike, so one task numbers them.
    joined = keyed_join(large, groups.drop("n"), ["digest"], "page_id, url", "left", hot_counts(groups, ["digest"])).unionByName(rows.where(~is_large).withColumn("first", F.lit(None).cast("long")))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    plan = joined.select("page_id", "url", "digest", "first", F.when(~revisit, F.col("body")).alias("body"))

    def write(batches):
        from pyspark import TaskContext

        shard, part, out, paths = TaskContext.get().partitionId(), 0, None, []
        named, n = set(), 0
        try:
            for batch in batches:
                for page_id, url, digest, first, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    common = None if first is None else f"{digest}/{first}"
                    refers = common if page_id != first else None
                    key = common if common and not refers and common not in named else f"{shard}:{n}"
                    n += 1
                    if key == common:
                        named.add(key)
                    if out is None:
                        out = AtomicWriter(f"{root}/part-{shard:06d}-{part:05d}.warc.gz")
                        out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(SPACE, f'info/{shard}/{part}')}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    for data in records_of(key, page_id, url, body or b"", digest, refers):
                        out.write(data)
                    if out.size >= FILE_BYTES:
                        done, out = out, None
                        done.__exit__(None)
                        paths.append(f"{root}/part-{shard:06d}-{part:05d}.warc.gz")
                        part += 1
        except BaseException:
            if out is not None:
                out.__exit__(Exception)
            raise
        if out is not None:
            out.__exit__(None)
            paths.append(f"{root}/part-{shard:06d}-{part:05d}.warc.gz")
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths)], names=["path"])

    return materialize(plan.mapInArrow(sliced(4, write), "path string"), "warc-paths")


def members(path: str):
    """Yield the unpacked gzip members of a file, reading it piece by piece."""
    with open_input(path) as f:
        z, parts, data = zlib.decompressobj(31), [], f.read(1 << 20)
        while data:
            parts.append(z.decompress(data))
            if z.eof:
                yield b"".join(parts)
                data = z.unused_data or f.read(1 << 20)
                z, parts = zlib.decompressobj(31), []
            else:
                data = f.read(1 << 20)
        if any(parts):
            raise ValueError(f"{path} ends within a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) < n:
        raise ValueError("a block is shorter than its Content-Length")
    return fields, rest[:n]


def read_records(paths: DataFrame) -> DataFrame:
    """Records of the files in ``paths`` (path) as they lie there."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for data in members(path):
                    f, block = parse(data)
                    if f.get("warc-type") not in ("response", "resource", "revisit", "continuation"):
                        continue
                    number = lambda k, f=f: int(f[k]) if k in f else None
                    digest = f.get("warc-payload-digest", "")
                    digest = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None
                    rows.append((f.get("warc-record-id"), f["warc-type"], f.get("warc-segment-origin-id"), number("warc-segment-number"), number("warc-segment-total-length"), f.get("warc-refers-to"), number("warc-page-number"), digest, f.get("warc-target-uri"), block, None))
                    held += len(block)
                    if held > 8 << 20:
                        yield batch_of(rows, RECORDS)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows, RECORDS)

    many = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.select("path").repartition(many, "path").mapInArrow(run, RECORDS)


KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def join_segments(parts: list[dict]) -> tuple[bytes, str | None]:
    """The block of one origin; an error if a number lacks, differs twice, or the length is not the total."""
    by: dict[int, bytes] = {}
    total = None
    for p in parts:
        if p["segment"] in by and by[p["segment"]] != p["block"]:
            return b"", f"segment {p['segment']} occurs twice"
        by[p["segment"]] = p["block"]
        total = p["total"] if p["total"] is not None else total
    if sorted(by) != list(range(1, len(by) + 1)):
        return b"", "a segment is missing"
    block = b"".join(by[i] for i in sorted(by))
    if total is None or total != len(block):
        return b"", f"{len(block)} bytes, not {total}"
    return block, None


def reassemble(records: DataFrame) -> DataFrame:
    """(record_id, kind, refers, page_id, uri, payload, error), one row per response or revisit.

    Only segmented records are shuffled, grouped by origin; a group is one
    record's content. A record that is broken keeps its row, with ``error``
    and a null payload. A revisit's payload is null here.
    """

    def whole(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload, error = None, None
                if r["kind"] != "revisit":
                    try:
                        payload = payload_of(r["block"])
                    except ValueError as e:
                        error = str(e)
                rows.append((r["record_id"], r["kind"], r["refers"], r["page_id"], r["uri"], payload, error))
            if rows:
                yield batch_of(rows, PAYLOADS)

    def grouped(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                block, error = join_segments(r["parts"])
                payload, head = None, r["head"]
                if head is None:
                    head, error = {"kind": "response", "page_id": None, "uri": None}, error or "the origin is missing"
                if not error:
                    try:
                        payload = payload_of(block)
                    except ValueError as e:
                        error = str(e)
                rows.append((r["origin"], head["kind"], None, head["page_id"], head["uri"], payload, error))
            if rows:
                yield batch_of(rows, PAYLOADS)

    single = records.where("segment is null").mapInArrow(whole, PAYLOADS)
    head = F.max(F.when(F.col("kind") != "continuation", F.struct("kind", "page_id", "uri"))).alias("head")
    groups = records.where("segment is not null").withColumn("origin", F.coalesce("origin", "record_id")).groupBy("origin").agg(head, F.collect_list(F.struct("segment", "total", "block")).alias("parts"))
    return single.unionByName(groups.mapInArrow(grouped, PAYLOADS))


def read_archives(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """Pages of the archives, with revisits resolved through the record that they refer to.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to, uri, error).
    """
    ship(spark)
    bounded_batches(spark)
    pages = reassemble(read_records(paths)).select("record_id", "kind", "refers", "page_id", "uri", "error", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest"))
    pages = materialize(pages, "warc-pages")
    named = pages.where("kind = 'revisit'").select("refers").distinct()
    known = pages.where("kind <> 'revisit'").select(F.col("record_id").alias("refers"), F.col("page_id").alias("to_page"), F.col("n").alias("to_n"), F.col("digest").alias("to_digest")).join(named, "refers", "left_semi").dropDuplicates(["refers"])
    # Only revisits look for another record; all of them may look for one.
    resolved = keyed_join(pages.where("kind = 'revisit'"), known, ["refers"], "record_id", "left").unionByName(pages.where("kind <> 'revisit'"), allowMissingColumns=True)
    missing = (F.col("kind") == "revisit") & F.col("to_n").isNull()
    return resolved.select(
        "page_id",
        F.coalesce("n", "to_n").alias("payload_bytes"),
        F.coalesce("digest", "to_digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("to_page").alias("refers_to"),
        "uri",
        F.when(missing, F.lit("the record referred to is missing")).otherwise(F.col("error")).alias("error"),
    )
