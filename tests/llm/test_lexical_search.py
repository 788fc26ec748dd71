import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import lexical_search
from tessera.llm.lexical_search import search, term_counts

from .conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k=10):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    bags = [(i, c, c.total()) for i, c in bags if c]
    big_n, big_l = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        asked = terms(text)
        scored = []
        for i, c, n in bags:
            m = 25 + 75 * n * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in asked if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(scored[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_table_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    assert rows(search(docs.repartition(3), items)) == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_odd_rows_small_shards_and_bundles(spark, odd, clash, monkeypatch):
    """Shards of 4 rows, bundles of 2 items: ties, repeats, nulls and clashing names."""
    monkeypatch.setattr(lexical_search, "SHARD", 4)
    monkeypatch.setattr(lexical_search, "BUNDLE", 2)
    items = [(1, "A b c word"), (1, "A b c word"), (2, None), (3, ""), (4, "x x y X"), (None, "text 中文 É é"), (5, "nowhere"), (6, "f f e")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r[0], r[1]) for r in ODD]
    bench = bench.withColumn("uid", F.lit("clash")).withColumn("terms", F.lit("clash"))
    assert rows(search(clash(odd).drop("item_id").repartition(3), bench)) == brute(docs, items)


def test_many_equal_documents_and_a_very_frequent_word(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD", 64)
    rng = random.Random(2)
    docs = [(i, "the same text of all" if i % 3 else " ".join(rng.choices(["the", "of", "rare", "b1", "c2"], k=rng.randint(1, 9)))) for i in range(900)]
    rng.shuffle(docs)
    items = [(1, "the text"), (2, "rare of b1"), (3, "the the the"), (4, "same text of all")]
    out = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(out) == brute(docs, items)


def test_a_full_mask_lets_terms_pass_and_the_join_removes_them(spark, monkeypatch):
    """With 64 bits for all terms most pass by chance; the result is the same."""
    monkeypatch.setattr(lexical_search, "MASK", 64)
    docs = [(i, " ".join(f"w{(i * k) % 37}" for k in range(1, 9))) for i in range(200)]
    items = [(k, f"w{k} w{k + 5} zz") for k in range(12)]
    out = search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(out) == brute(docs, items)
    terms = spark.createDataFrame([("é",), ("w1",)], "term string")
    mask = lexical_search.term_mask(terms)
    import zlib
    assert [i for i in range(64) if mask[i]] == sorted({zlib.crc32(x.encode()) % 64 for x in ("é", "w1")})


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(empty, some).collect() == search(empty, none).collect() == []
    docs = spark.createDataFrame([(1, None), (2, " .")], "doc_id long, text string")
    assert search(docs, some).collect() == search(docs.withColumn("text", F.lit("a")), none).collect() == []


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_terms_of_long_texts_in_chunks(monkeypatch, chunk):
    monkeypatch.setattr(lexical_search, "CHUNK", chunk)
    for text in [None, "", "Aé-B_b É\x00é 1\n" * 500, "x" * 5000 + " y", "-" * 3000, "中" * 300]:
        assert term_counts(text) == collections.Counter(t.encode() for t in terms(text))
