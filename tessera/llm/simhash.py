"""SimHash near-duplicates by multi-index hashing.

Fingerprints are made of word shingles in the tasks that read the texts; equal
fingerprints fall together before any comparison. The distinct fingerprints are
stored in one table for each of ``bits + 1 over 2`` rounded-up segments, so
that two fingerprints at most ``bits`` apart differ by at most one bit in some
segment. A fingerprint fetches the table rows whose segment lies in the Hamming
ball of radius one round its own, and the complete distance is verified.

Of two values one bit apart exactly one has a zero there, so only the bits that
are zero are flipped: each pair is fetched from one side. A fingerprint has at
most sum(C(64, 0..bits)) others within ``bits``, whatever the number of
documents, so the links of a group of copies stay bounded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, with_group, written

#: Shingles hashed at a time: bounds memory for texts of any length.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the shingles' hashes."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and the six ASCII separators
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, BLOCK):
        part = words[lo:min(lo + BLOCK, n) + shingle - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        k = min(BLOCK, n - lo)
        starts = [0, *ends[:k - 1].tolist()]
        stops = (ends[min(shingle, len(part)) - 1:][:k] - 1).tolist()
        hashes = np.array([digest(joined[a:z], 42) for a, z in zip(starts, stops)], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.text], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b.doc_id, "fp": fp})

    d = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    return d.mapInPandas(run, "doc_id string, fp long").select(F.col("doc_id").cast("long"), "fp")


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """All pairs (a, b) of distinct fingerprints (column fp) at 1 to ``bits`` differing bits."""
    parts = bits // 2 + 1  # some segment differs by at most one bit
    edges = [64 * i // parts for i in range(parts + 1)]
    rows = F.array(*[F.struct(F.lit(i).alias("seg"), F.shiftright("fp", lo).bitwiseAND(F.lit((1 << hi - lo) - 1 if hi - lo < 64 else -1)).alias("v"))
                     for i, (lo, hi) in enumerate(zip(edges, edges[1:]))])
    tables = fps.select("fp", F.explode(rows).alias("t")).select("fp", "t.seg", "t.v")
    width = F.element_at(F.array(*[F.lit(hi - lo) for lo, hi in zip(edges, edges[1:])]), F.col("seg") + 1)
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    ball = F.transform(F.filter(F.sequence(F.lit(0), width - 1), lambda i: F.col("v").bitwiseAND(one(i)) == 0),
                       lambda i: F.col("v").bitwiseOR(one(i)))
    probes = tables.select("seg", F.col("fp").alias("a"), F.col("v").alias("own"),
                           F.explode(F.concat(F.array("v"), ball)).alias("v"))
    found = probes.join(tables.withColumnRenamed("fp", "b"), ["seg", "v"])
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # at equal segments both sides fetch each other: one of them is enough
    return found.where((F.col("own") != F.col("v")) | (F.col("a") < F.col("b"))) \
        .where((F.col("a") != F.col("b")) & (apart <= bits)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints at ``bits`` or fewer differing bits link; component_id is the
    smallest doc_id reachable. Defined cases: null and empty texts have the
    fingerprint zero and link like any other; rows with a null doc_id take part
    in links, and a component of only such rows has a null component_id;
    repeated rows are in one component; other columns are not read.
    """
    own = written(fingerprints(docs, shingle), "fingerprints")
    # fingerprints are signed longs: any of them may serve as a node id
    distinct = written(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    comp = components(links(distinct.select("fp"), bits))
    grouped = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = written(grouped.join(least, "component").select("fp", "component_id"), "by_fp")
    # back to the documents by fingerprint and salt: one fingerprint may have a third of them
    rows = with_group(own, ["fp"], "doc_id", {"_one": F.count(F.lit(1))}, {"_n": F.sum("_one")},
                      keep=lambda g: g.join(by_fp, "fp"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
