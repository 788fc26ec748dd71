import collections

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm.common import components
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.simhash import links, simhash_groups

from .conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_dedup(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOW)].append(r[0])
    out = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), keep is None or i == keep) for i in ids]
    return sorted(out, key=str)


def got_dedup(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("digest", [None, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_dedup_is_exact_even_when_digests_collide(spark, odd, documents, clash, digest):
    kw = {"digest": digest} if digest else {}
    assert got_dedup(exact_dedup(clash(odd), **kw)) == brute_dedup(ODD)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got_dedup(exact_dedup(documents, **kw)) == brute_dedup(rows)


def test_dedup_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(
        F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup(df).where("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(2997, 1000)} and sum(r.kept for r in got) == 1


def test_empty_tables(empty):
    assert exact_dedup(empty).collect() == [] and simhash_groups(empty).collect() == []


def brute_fingerprint(text, k=3):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "").translate(LOW)).split(" ") if w]
    sh = [" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_groups(rows, bits=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_simhash_equals_brute_force(odd, documents, clash):
    for df in (clash(odd), documents):
        want = brute_groups([(r.doc_id, r.text) for r in df.collect()])
        assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_groups(df).collect()), key=str) == want


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_links_within_small_distances(spark, bits):
    import random
    rnd = random.Random(bits)
    fps = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(8):
            y = x
            for _ in range(rnd.randrange(0, 6)):
                y ^= 1 << rnd.randrange(64)
            fps.add(y - (1 << 64) if y >> 63 else y)
    want = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= bits}
    got = {tuple(r) for r in links(spark.createDataFrame([(x,) for x in fps], "fp long"), bits).collect()}
    assert got == want and want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
