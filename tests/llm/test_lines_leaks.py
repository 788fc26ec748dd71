import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import decontaminate as D
from tessera.llm.line_dedup import Earlier, line_dedup, patience, recursive_patience


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=25), st.lists(st.integers(0, 12), max_size=25))
def test_patience_blocks_are_common_and_increasing(a, b):
    ai = bi = 0
    for i, j, n in patience(a, b):
        assert n > 0 and i >= ai and j >= bi and a[i:i + n] == b[j:j + n]
        ai, bi = i + n, j + n
    if a and a == b and len(set(a)) == len(a):
        assert patience(a, b) == [(0, 0, len(a))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25))
def test_alignment_finds_every_common_block(a, b):
    """Line 0 is blank, line k has k words; blocks of five words, against all pairs of substrings."""
    found = recursive_patience(a, b)
    assert all(a[i:i + n] == b[j:j + n] for i, j, n in found)
    assert sum(n for *_, n in found) == len({i + k for i, _, n in found for k in range(n)}) == len({j + k for _, j, n in found for k in range(n)})
    want = set()
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] > 0:
                n += 1
            if sum(a[i:i + n]) >= 5:
                want |= set(range(i, i + n))
    assert Earlier(b, b, 5).common(a, a) == want


def whole(rows, min_words=5):
    """Each document without its common substrings of lines, of ``min_words`` words at least, with any earlier document."""
    out, where = {}, {}
    for d, t in sorted({r for r in rows if None not in r}):
        a, gone = t.split("\n"), set()
        for i, x in enumerate(a):
            for b, j in where.get(x, ()):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and a[i + n].strip():
                    n += 1
                if sum(len(y.split()) for y in a[i:i + n]) >= min_words:
                    gone |= set(range(i, i + n))
        for j, x in enumerate(a):
            where.setdefault(x, []).append((a, j))
        out[d] = "\n".join(x for i, x in enumerate(a) if i not in gone)
    return out


def made(seed, n=60):
    rnd = random.Random(seed)
    passage = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(20)]
    rows = []
    for d in range(n):
        ls = [" ".join(rnd.choice("abcdefgh") * 3 for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 6))]
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(18)
            at = rnd.randint(0, len(ls))
            ls[at:at] = passage[k:k + rnd.randint(1, 3)]
        rows.append((d, "\n".join(ls)))
    return rows


@pytest.mark.parametrize("rare", [64, 3])
def test_line_dedup_equals_brute_force(spark, rare):
    rows = made(rare)
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), rare=rare)
    assert {r.doc_id: r.text for r in got.collect()} == whole(rows)


def test_line_dedup_keeps_the_first_holder_and_clean_rows(spark, documents, odd, clash, empty):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r for r in line_dedup(documents).collect()}
    assert {d: r.text for d, r in got.items()} == whole(rows)
    assert got[rows[0][0]] is not None and len(got) == len(rows)
    left = set()
    for d, t in sorted(rows):
        for i, x in enumerate(t.split("\n")):
            if i in got[d].removed_lines:
                assert x in left          # every deleted line stays in an earlier document
            else:
                left.add(x)
    same = line_dedup(clash(odd))
    assert same.count() == odd.count() and "score" in same.columns
    assert line_dedup(empty).collect() == []


def test_line_dedup_of_repeated_rows(spark):
    rows = made(5, 30)
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    got = line_dedup(df).collect()
    want = whole(rows)
    assert len(got) == 2 * len(rows) and all(r.text == want[r.doc_id] for r in got)


def test_line_dedup_hot_line(spark):
    hot = " ".join(f"w{i}" for i in range(60))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), F.col("id").cast("string"), F.when(
        F.col("id") % 3 == 0, F.lit("\n" + hot)).otherwise("")).alias("text"))
    got = line_dedup(df).where(F.contains("text", F.lit(hot))).collect()
    assert [r.doc_id for r in got] == [0]


def distance(item, text):
    """Least edits of an occurrence of the whole item in the text, by the full table."""
    row = [0] * (len(text) + 1)
    for c in item:
        new = [row[0] + 1]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def leak_rows(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, say(rnd.randint(12, 50))) for i in range(12)] + [(12, None), (13, ""), (14, "short"), (0, say(9))]
    docs = []
    for d in range(40):
        i, t = rnd.choice(items[:12])
        t = D.normalised(t)
        e = D.edits(len(t))
        y = list(t)
        for _ in range(rnd.choice([0, 1, e // 2, e, e + 6, len(t) // 2])):
            p = rnd.randrange(len(y))
            y[p:p + rnd.randint(0, 1)] = rnd.choice(["", "q", "qz"])
        docs.append((d, say(20) + " " + "".join(y).upper() + "\n " + say(20) if d % 3 else say(60)))
    return items, docs + [(None, items[0][1]), (80, None), (81, ""), (82, " \n"), (3, docs[3][1])]


def test_leaks_equal_brute_force(spark, clash):
    items, docs = leak_rows(4)
    want = set()
    for d, t in docs:
        for i, x in items:
            if x and t is not None:
                n = distance(D.normalised(x), D.normalised(t))
                if n <= D.edits(len(D.normalised(x))):
                    want.add((d, i, n))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(clash(spark.createDataFrame(docs, "doc_id long, text string")), b)
    best = {}
    for d, i, n in want:
        best[d, i] = min(n, best.get((d, i), n))
    assert {(r.doc_id, r.item_id): r.edits for r in got.collect()} == best and len(best) > 10


def test_short_items_are_sought_as_they_are(spark):
    items = [(1, "Ab c"), (2, "x"), (3, "ab c"), (4, None), (5, " "), (6, "中文"), (7, "ab cdefgh")]
    docs = [(1, "zab  C"), (2, "nothing"), (3, "中文ab\ncdefgh"), (4, None), (5, "")]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.edits, r.start_char, r.end_char) for r in got.collect()) == [
        (1, 1, 0, 1, 5), (1, 3, 0, 1, 5), (3, 1, 0, 2, 6), (3, 3, 0, 2, 6), (3, 6, 0, 0, 2), (3, 7, 0, 2, 11)]
    none = spark.createDataFrame([(1, None), (2, None)], "item_id long, text string")
    assert D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), none).collect() == []


@pytest.mark.parametrize("hits", [1, 50, 1 << 22])
def test_shared_phrases_are_counted_in_bounded_parts(monkeypatch, hits):
    """Many items with one phrase and texts that repeat it: the same occurrences however few hits are laid out at a time."""
    rnd = random.Random(hits)
    phrase = "which of the following statements is true about"
    items = [(str(k), f"{phrase} {''.join(rnd.choice('abcdefgh') for _ in range(20))} {k}") for k in range(40)] + [("40", "ab" * 60)]
    text = " ".join([phrase] * 30 + [items[7][1], phrase, items[31][1], phrase * 3, "ab" * 200])
    index = D.build(items)
    want = {(w, a, z, e) for w, a, z, e in D.search(index, D._codes(text))}
    monkeypatch.setattr(D, "HITS", hits)
    got = set(D.search(D.build(items), D._codes(text)))
    assert {w for w, *_ in got} == {w for w, *_ in want} == {7, 31, 40}
    assert {min(x[3] for x in got if x[0] == w) for w in (7, 31, 40)} == {0}


def test_long_texts_items_and_blocks(spark, empty, monkeypatch):
    rnd = np.random.default_rng(3)
    long_item = " ".join("".join(rnd.choice(list("abcdefghij"), 6)) for _ in range(300))
    text = " ".join("".join(rnd.choice(list("klmnopqrst"), 6)) for _ in range(4000))
    cut = D.normalised(long_item)[700:1500]
    docs = spark.createDataFrame([(1, text), (2, text[:9000] + " " + cut + " " + text[9000:])], "doc_id long, text string")
    b = spark.createDataFrame([(7, long_item), (8, "nothing like it in any of the texts")], "item_id long, text string")
    monkeypatch.setattr(D, "CHARS", 5000)
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    assert [(r.doc_id, r.item_id, r.edits) for r in D.contaminated(docs, b).collect()] == [(2, 7, 0)]
    assert D.contaminated(empty, b).collect() == [] and D.contaminated(docs, b.where("false")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=12), st.text("ab", max_size=20), st.integers(0, 4))
def test_banded_alignment(item, region, limit):
    pad = len(item)
    codes = np.concatenate([np.zeros(pad, np.uint32), D._codes(region)])
    got = D.banded(D._codes(item), codes, len(codes) + 1, limit)
    want = distance(item, region)
    assert (got[0] if got else None) == (want if want <= limit else None)
    if got:
        assert distance(item, region[max(0, got[1] - pad):max(0, got[2] - pad)]) == got[0]
