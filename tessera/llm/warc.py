"""Deterministic sharded WARC writer, and the reader that takes the archives apart again.

Shards are ranges of page_id. Their bounds come from a histogram of payload
bytes over a fixed number of id ranges, not from a sample, so the same pages
give the same files, byte for byte, however the input is split. A task sorts
its shards, regenerates every header and digest from the page, writes one gzip
member for each record and starts a new file when the compressed size is
reached. Files are written under a temporary name with the attempt's own tag
and renamed when complete: an attempt that dies leaves nothing under a final
name, and a second one puts the same bytes in place. The manifest (a Parquet
table, committed by Spark) names the files that count; the reader opens only
these and checks each one's size and digest.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import shared_path, with_group

#: Ranges of page_id whose bytes are counted before shards are drawn: all that reaches the driver.
BINS = 4096
MANIFEST = "file string, shard long, records long, bytes long, sha256 string, first_page string, last_page string"
PAGE = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile("[\x00-\x20\x7f]")


# ------------------------------------------------------------------ records
def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, digest: str) -> str:
    """The same page and payload always have the same id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without a time or name
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def page_member(page_id, url, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One record: a response, or a revisit of the response of page ``refers_to``."""
    digest = sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                    ("X-Refers-To-Page-Id", str(refers_to))]
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
                ("Content-Type", "application/http; msgtype=response")]
    return _member(headers, block)


def info_member(file: str, date: str = DATE) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, file)}>"),
                    ("WARC-Date", date), ("WARC-Filename", file), ("Content-Type", "application/warc-fields")], block)


# ------------------------------------------------------------------ shards
def shard_bounds(pages: DataFrame, low: int, width: int, shard_bytes: int) -> DataFrame:
    """At most BINS + 1 rows (bin, width, low, shard, parts): where each id range goes.

    A range heavier than a shard is split evenly by id into ``parts``; one that
    is a single id (or the null id) is split by the payload's digest.
    """
    spark = pages.sparkSession
    counted = pages.groupBy(_bin(low, width).alias("bin")).agg(F.sum(F.octet_length(F.coalesce("html", F.lit(""))) + 200)).collect()
    rows, shard, held = [], 0, 0
    for b, size in sorted((b, s) for b, s in counted):
        parts = max(1, -(-size // shard_bytes)) if size > shard_bytes else 1
        if held and (parts > 1 or held + size > shard_bytes):
            shard, held = shard + 1, 0
        rows.append((b, width if b >= 0 else 1, low + b * width, shard, parts))
        if parts > 1:
            shard += parts
        else:
            held += size
    return spark.createDataFrame(rows, "bin long, width long, low long, shard long, parts long")


def _bin(low, width):
    return F.coalesce(F.floor((F.col("page_id") - F.lit(low).cast("long")) / F.lit(width)).cast("long"), F.lit(-1).cast("long"))


def _in_shards(rows: DataFrame, bounds: DataFrame, low: int, width: int) -> DataFrame:
    by_id = F.floor((F.col("page_id") - F.col("low")) * F.col("parts") / F.col("width"))
    part = F.when(F.col("parts") == 1, 0).when(F.col("width") == 1, F.pmod(F.xxhash64("_d"), F.col("parts"))).otherwise(by_id)
    return rows.withColumn("bin", _bin(low, width)).join(F.broadcast(bounds), "bin") \
        .withColumn("_shard", F.col("shard") + part.cast("long")).drop("bin", "width", "low", "shard", "parts")


# ------------------------------------------------------------------ writer
def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Files:
    """The files of one shard in turn; yields a manifest row for each that is complete."""

    def __init__(self, base: str, shard: int, size: int):
        self.base, self.shard, self.size, self.k, self.out = base, shard, size, 0, None

    def add(self, page_id, data: bytes):
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.k:05d}.warc.gz"
            fs, root = _open(self.base)
            fs.create_dir(root, recursive=True)
            self.fs, self.path = fs, f"{root}/{self.name}"
            self.tmp = f"{root}/.{self.name}.{uuid.uuid4().hex}.tmp"
            self.out, self.hash, self.n, self.records = fs.open_output_stream(self.tmp), hashlib.sha256(), 0, 0
            self.first, self.k = page_id, self.k + 1
            self.put(info_member(self.name))
        self.put(data)
        self.records, self.last = self.records + 1, page_id
        return [self.close()] if self.n >= self.size else []

    def put(self, data):
        self.out.write(data)
        self.hash.update(data)
        self.n += len(data)

    def close(self):
        self.out.close()
        self.fs.move(self.tmp, self.path)  # over an equal file of an earlier attempt, if there is one
        self.out = None
        return self.name, self.shard, self.records, self.n, self.hash.hexdigest(), self.first, self.last


def _write(base: str, file_bytes: int):
    names = [c.split()[0] for c in MANIFEST.split(", ")]

    def run(batches):
        files, at, refers = None, None, None
        for b in batches:
            done = []
            for shard, page, d, kind, url, html, ref in zip(b["_shard"], b.page_id, b["_d"], b["_kind"], b.url, b.html, b.refers):
                if kind == 0:  # the decision for the pages that follow with this id and digest
                    at, refers = (page, d), int(ref)
                    continue
                if files is None or files.shard != shard:
                    if files is not None and files.out is not None:
                        done.append(files.close())
                    files = _Files(base, shard, file_bytes)
                done += files.add(page, page_member(page, url, (html or "").encode("utf-8", "surrogatepass"),
                                                    refers if at == (page, d) else None))
            if done:
                yield pd.DataFrame(done, columns=names)
        if files is not None and files.out is not None:
            yield pd.DataFrame([files.close()], columns=names)
    return run


def write_warc(pages: DataFrame, base: str, shard_bytes: int = 1 << 30, file_bytes: int = 1 << 28,
               min_revisit: int = 0) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) to archives below ``base``; returns the manifest.

    Of records with equal payloads of at least ``min_revisit`` bytes the one
    with the smallest page_id is a response, the others revisit it. Defined
    cases: null html is an empty payload; a null url gives a record without a
    target; records with a null page_id are never the first of their group, and
    all are responses if no other is there; rows that repeat the first page are
    responses too; rows that repeat a page with the same payload each get a
    record. Other columns are not read. No pages give an empty manifest.
    """
    p = pages.select(F.col("page_id").cast("long"), "url", "html",
                     F.sha2(F.coalesce("html", F.lit("")), 256).alias("_d"))
    low, high = p.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = low or 0, high or 0
    width = max(1, -(-(high - low + 1) // BINS))
    bounds = shard_bounds(p, low, width, shard_bytes)
    small = p.select("page_id", "_d", F.octet_length(F.coalesce("html", F.lit(""))).alias("_n")).where(F.col("_n") >= min_revisit)
    same = with_group(small, ["_d"], "page_id", {"m": F.min("page_id"), "c": F.count(F.lit(1))},
                      {"first": F.min("m"), "c": F.sum("c")}, keep=lambda g: g.where("c > 1").drop("c"))
    refer = same.where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))) \
        .select("page_id", "_d", F.col("first").cast("string").alias("refers")).distinct()
    null = F.lit(None).cast("string")
    rows = p.select("page_id", "_d", F.lit(1).alias("_kind"), "url", "html", null.alias("refers")) \
        .unionByName(refer.select("page_id", "_d", F.lit(0).alias("_kind"), null.alias("url"), null.alias("html"), "refers"))
    placed = _in_shards(rows, bounds, low, width)
    shards = max((r[0] for r in bounds.select(F.max(F.col("shard") + F.col("parts"))).collect() if r[0]), default=1)
    # a shard is a task; nothing is sampled, so every run deals the same rows to it
    ordered = placed.repartitionById(shards, F.col("_shard").cast("int")).sortWithinPartitions("_shard", "page_id", "_d", "_kind", "url", "html")
    found = ordered.withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(
        _write(base, file_bytes), MANIFEST)
    path = f"{base}/_manifest"
    found.write.parquet(path)
    return pages.sparkSession.read.schema(MANIFEST).parquet(path)


# ------------------------------------------------------------------ reader
def records(stream, size: int = 1 << 18):
    """(headers, block) of every record of a gzip stream, one member in memory at a time."""
    raw, rest = io.BytesIO(), b""
    z = zlib.decompressobj(31)
    while True:
        data = rest or stream.read(size)
        rest = b""
        if not data:
            break
        raw.write(z.decompress(data))
        if z.eof:
            rest, z = z.unused_data, zlib.decompressobj(31)
            member = raw.getvalue()
            raw = io.BytesIO()
            head, _, body = member.partition(b"\r\n\r\n")
            headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield headers, body[:int(headers["Content-Length"])]


class _Hashed:
    def __init__(self, stream):
        self.stream, self.hash = stream, hashlib.sha256()

    def read(self, n):
        data = self.stream.read(n)
        self.hash.update(data)
        return data


def read_warc(spark: SparkSession, base: str) -> DataFrame:
    """The pages in the archives that the manifest of ``base`` names.

    Every file's digest, every block's digest and every response's payload
    digest are checked. A revisit has no payload; its size and digest are those
    of the full payload.
    """
    names = [c.split()[0] for c in PAGE.split(", ")]

    def run(batches):
        for b in batches:
            for file, sha in zip(b.file, b.sha256):
                fs, root = _open(base)
                out, held = [], 0
                with fs.open_input_stream(f"{root}/{file}", compression=None) as f:
                    hashed = _Hashed(f)
                    for h, block in records(hashed):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = h["WARC-Payload-Digest"].partition(":")[2]
                        full = h["WARC-Type"] == "response"
                        if h["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}" or full and digest != sha1_base32(payload):
                            raise ValueError(f"{file}: a record does not match its digest")
                        n = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        out.append((h.get("X-Page-Id"), h.get("WARC-Target-URI"), n, digest, h["WARC-Type"],
                                    h.get("X-Refers-To-Page-Id"), payload if full else None))
                        held += len(payload)
                        if held >= 1 << 23:
                            yield pd.DataFrame(out, columns=names)
                            out, held = [], 0
                if hashed.hash.hexdigest() != sha:
                    raise ValueError(f"{file} does not match the manifest")
                if out:
                    yield pd.DataFrame(out, columns=names)

    manifest = spark.read.schema(MANIFEST).parquet(f"{base}/_manifest")
    schema = PAGE.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string")
    n = max(spark.sparkContext.defaultParallelism, 1)
    got = manifest.select("file", "sha256").repartition(n, "file").mapInPandas(run, schema)
    return got.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def warc_round_trip(pages: DataFrame, base: str | None = None, **kw) -> DataFrame:
    """Write the archives, read them back."""
    base = base or shared_path(pages.sparkSession, "warc")
    write_warc(pages, base, **kw)
    return read_warc(pages.sparkSession, base)
