import gzip
import hashlib
import base64
import os

import pytest
from pyspark.sql import types as T

from tessera.llm.warc import read_warc, warc_round_trip, write_warc

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType())])
ROWS = [(5, "http://a/ b\r\nX: y", "same"), (3, None, "same"), (9, "u", "same"), (4, "u", None), (6, "u", ""),
        (None, "n", "same"), (None, "n", "other"), (None, "n", "other"), (7, "u", "é" * 5000), (7, "u", "é" * 5000),
        (8, "u", "WARC/1.1\r\n\r\n"), (1 << 60, "u", "far"), (10, "u", "é" * 5000)]


def brute(rows, least=0):
    first = {}
    for p, _, h in rows:
        if p is not None:
            h = h or ""
            first[h] = min(p, first.get(h, p))
    out = []
    for p, _, h in rows:
        h = h or ""
        data = h.encode()
        f = first.get(h)
        revisit = f is not None and f != p and len(data) >= least
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"shard_bytes": 300, "file_bytes": 200}, {"min_revisit": 5}])
def test_round_trip(spark, clash, tmp_path, kw):
    pages = clash(spark.createDataFrame(ROWS, SCHEMA))
    df = warc_round_trip(pages, f"file://{tmp_path}/w", **kw)
    assert got(df) == brute(ROWS, kw.get("min_revisit", 0))
    texts = sorted(r.payload.decode() for r in df.collect() if r.record_type == "response")
    assert len(set(texts)) == len({h or "" for _, _, h in ROWS})


def test_the_same_pages_give_the_same_files(spark, tmp_path):
    files = []
    for k, parts in enumerate((1, 7)):
        base = f"file://{tmp_path}/{k}"
        write_warc(spark.createDataFrame(ROWS * 3, SCHEMA).repartition(parts), base, shard_bytes=4000, file_bytes=1000)
        root = tmp_path / str(k)
        files.append({f: (root / f).read_bytes() for f in os.listdir(root) if f.endswith(".gz")})
        assert not [f for f in os.listdir(root) if f.endswith(".tmp")]
    assert files[0] == files[1] and len(files[0]) > 2
    body = b"".join(gzip.decompress(x) for x in files[0].values())
    assert body.count(b"WARC/1.1\r\nWARC-Type: response") + body.count(b"WARC/1.1\r\nWARC-Type: revisit") == 3 * len(ROWS)


def test_only_the_manifest_counts_and_damage_is_seen(spark, tmp_path):
    base = f"file://{tmp_path}/w"
    n = write_warc(spark.createDataFrame(ROWS, SCHEMA), base).count()
    (tmp_path / "w" / "pages-999999-00000.warc.gz").write_bytes(b"left by a lost attempt")
    assert n == 1 and read_warc(spark, base).count() == len(ROWS)
    f = tmp_path / "w" / "pages-000000-00000.warc.gz"
    f.write_bytes(f.read_bytes() + gzip.compress(b""))
    with pytest.raises(Exception):
        read_warc(spark, base).collect()


def test_no_pages(spark, tmp_path):
    assert warc_round_trip(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/w").collect() == []


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert got(warc_round_trip(pages, shard_bytes=100_000, file_bytes=10_000)) == brute(rows)
