"""Line deduplication: passages that an earlier document holds are deleted from the later one.

A passage is a block of consecutive lines of at least ``min_words`` words (see
``words``), none of them blank (nothing but Unicode white space). Two documents
share it if both hold its lines in this order without others between; the later
one (the larger doc_id) loses it, wherever, in whatever order and however often
it holds it, and however many copies there are. So every deleted line stays in
some earlier document.

1. Each document becomes its sequence of line hashes. For each line the shortest
   block of ``min_words`` words that begins with it, and the one that ends with
   it, get a digest of 128 bits; a line of that many words is a block by itself.
2. Pairs: documents that share a rare digest (at most ``rare`` holders) overlap;
   each later holder is paired with the first one.
3. Each pair is aligned by patience diff over the region of the later document
   that the shared digests span, recursing into the gaps; what is left of it is
   aligned again until nothing new is found. The lines of the common blocks go.
4. A digest that is not rare, and of which no line has gone yet, pairs its later
   holder with its first one too, and these pairs are aligned in the same way.
   So a line that a million documents hold gives each of them one pair at most,
   and none if the rare lines beside it have already dealt with it.

A holder met by many later ones is sent once for each ``CHUNK`` of them, and a
task aligns one chunk at a time: no group grows with the number of copies.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import with_group, written

MIN_WORDS = 5
#: Letters of scripts without spaces between words.
_PAIRS = re.compile("[\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_FOURS = re.compile("[\u0e01-\u0e4e\u0e81-\u0ece\u1000-\u109f\u1780-\u17d3]")
#: A digest with at most so many holders is rare: its pairs are aligned first.
RARE = 16
#: Later documents that one copy of an earlier document's lines serves.
CHUNK = 512
#: Blocks after which a batch of documents is passed on.
ROWS = 1 << 15


def patience(a: list, b: list) -> list[tuple[int, int, int]]:
    """Common blocks (start in a, start in b, length), increasing in both.

    Anchors are items unique in both lists; of these the longest increasing
    run; each block is then extended over equal neighbours.
    """
    ca, cb = Counter(a), Counter(b)
    where = {x: j for j, x in enumerate(b) if cb[x] == 1}
    pairs = [(i, where[x]) for i, x in enumerate(a) if ca[x] == 1 and x in where]
    tops, piles, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[k], piles[k] = j, n
    run, n = [], piles[-1] if piles else -1
    while n >= 0:
        run.append(pairs[n])
        n = back[n]
    out, ai, bi = [], 0, 0
    run.reverse()
    for i, j in run:
        if i < ai:
            continue  # inside the block before
        i0, j0 = i, j
        while i0 > ai and j0 > bi and a[i0 - 1] == b[j0 - 1]:
            i0, j0 = i0 - 1, j0 - 1
        i1, j1 = i + 1, j + 1
        while i1 < len(a) and j1 < len(b) and a[i1] == b[j1]:  # at the next anchor both arrive together
            i1, j1 = i1 + 1, j1 + 1
        out.append((i0, j0, i1 - i0))
        ai, bi = i1, j1
    return out


def words(line: str) -> int:
    """Words of a line, 0 for a blank one.

    Runs between Unicode white space; in scripts that put none between words, two
    letters of Chinese or Japanese or four of Thai, Lao, Burmese or Khmer count as one.
    """
    if line.isascii() or not (_PAIRS.search(line) or _FOURS.search(line)):
        return len(line.split())
    rest, pairs = _PAIRS.subn(" ", line)
    rest, fours = _FOURS.subn(" ", rest)
    return max(1, (pairs + 1) // 2 + (fours + 3) // 4 + sum(any(map(str.isalnum, x)) for x in rest.split()))


def blocks(n: list[int], min_words: int) -> set[tuple[int, int]]:
    """(first line, line after the last) of the shortest blocks that begin or end with each line; ``n`` has the lines' words."""
    out = set()
    for at in range(len(n)):
        for step in (1, -1):
            k, total = at, 0
            while 0 <= k < len(n) and n[k]:
                total += n[k]
                if total >= min_words:
                    out.add((min(at, k), max(at, k) + 1))
                    break
                k += step
    return out


def recursive_patience(a: list, b: list) -> list[tuple[int, int, int]]:
    """Patience blocks of a and b, of the gaps between them, of the gaps in those, and so on."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        found = patience(a[a0:a1], b[b0:b1])
        at, bt = a0, b0
        for i, j, n in found:
            out.append((a0 + i, b0 + j, n))
            todo.append((at, a0 + i, bt, b0 + j))
            at, bt = a0 + i + n, b0 + j + n
        if found:
            todo.append((at, a1, bt, b1))
    return out


class Earlier:
    """The lines of an earlier document, ready to be aligned with many later ones."""

    def __init__(self, hashes: list[int], n: list[int], min_words: int):
        self.min_words = min_words
        # a blank line equals no other
        self.lines = [h if w else (0, i) for i, (h, w) in enumerate(zip(hashes, n))]
        self.blocks = {tuple(hashes[lo:hi]) for lo, hi in blocks(n, min_words)}

    def common(self, hashes: list[int], n: list[int]) -> set[int]:
        """The line numbers of a later document in all blocks of ``min_words`` words that it has in common with this one."""
        gone, left = set(), [h if w else (1, i) for i, (h, w) in enumerate(zip(hashes, n))]
        while True:
            new = set()
            for i, _, k in recursive_patience(left, self.lines):
                if sum(n[i:i + k]) >= self.min_words:
                    new |= set(range(i, i + k))
            if not new:
                break
            gone |= new
            left = [(1, i) if i in new else x for i, x in enumerate(left)]
        # without a line unique in both, or cut by a deletion: the shortest common blocks are aligned one by one
        for lo, hi in blocks(n, self.min_words):
            if not gone.issuperset(range(lo, hi)) and tuple(hashes[lo:hi]) in self.blocks:
                gone |= set(range(lo, hi))
        return gone


def ranges(numbers: set[int]) -> list[tuple[int, int]]:
    """Sorted (first, after the last) of runs of numbers."""
    out = []
    for k in sorted(numbers):
        if out and out[-1][1] == k:
            out[-1] = (out[-1][0], k + 1)
        else:
            out.append((k, k + 1))
    return out


def sequences(docs: DataFrame, min_words: int) -> DataFrame:
    """A written table: doc_id, line hashes and words, and the blocks with their digests (two longs)."""
    def lists(rows, kind):
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.array([x for r in rows for x in r], kind))

    def run(batches):
        def digest(x: bytes, size: int) -> list[int]:
            return np.frombuffer(blake2b(x, digest_size=size).digest(), "<i8").tolist()

        for b in batches:
            ids, held, out = [], 0, {c: [] for c in ("hashes", "n", "lo", "hi", "h", "g")}
            for i in range(b.num_rows):
                lines = b.column("text")[i].as_py().split("\n")
                n = [words(x) for x in lines]
                raw = [x.encode("utf-8", "surrogatepass") for x in lines]
                at = sorted(blocks(n, min_words))
                both = [digest(b"\n".join(raw[lo:hi]), 16) for lo, hi in at]
                row = ([digest(x, 8)[0] for x in raw], n, [x for x, _ in at], [x for _, x in at], [x for x, _ in both], [x for _, x in both])
                for c, v in zip(out, row):
                    out[c].append(v)
                ids.append(b.column("doc_id")[i].as_py())
                held += len(at) + len(lines)
                if held >= ROWS or i == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), *(lists(v, pa.int64() if c in ("hashes", "h", "g") else pa.int32()) for c, v in out.items())],
                        names=["doc_id", *out])
                    ids, held, out = [], 0, {c: [] for c in out}

    rows = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return written(rows.mapInArrow(run, "doc_id long, hashes array<bigint>, n array<int>, lo array<int>, hi array<int>, "
                                        "h array<bigint>, g array<bigint>"), "line-blocks")


def align(pairs: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, lo, hi): lines that go, for pairs (doc_id, first, from, to: the region of doc_id to align).

    ``lines`` has doc_id, hashes and n, one row for each document of the pairs.
    """
    sized = with_group(pairs, ["first"], "doc_id", {"_n": F.count(F.lit(1))}, {"_n": F.sum("_n")})
    chunks = F.ceil(F.col("_n") / CHUNK)
    dealt = sized.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), chunks))
    later = dealt.join(lines, "doc_id").select("first", "chunk", "doc_id", "from", *[
        F.slice(c, F.col("from") + 1, F.col("to") - F.col("from")).alias(c) for c in ("hashes", "n")])
    earlier = dealt.select(F.col("first").alias("e"), F.col("chunk").alias("c")).distinct()         .join(lines.select(F.col("doc_id").alias("e"), F.col("hashes").alias("eh"), F.col("n").alias("en")), "e")

    def run(key, late: pa.Table, early: pa.Table) -> pa.Table:
        out = []
        if late.num_rows and early.num_rows:
            base = Earlier(early.column("eh")[0].as_py(), early.column("en")[0].as_py(), min_words)
            for i in range(late.num_rows):
                at = late.column("from")[i].as_py()
                gone = base.common(late.column("hashes")[i].as_py(), late.column("n")[i].as_py())
                out += [(late.column("doc_id")[i].as_py(), at + lo, at + hi) for lo, hi in ranges(gone)]
        d, lo, hi = zip(*out) if out else ((), (), ())
        return pa.table({"doc_id": pa.array(d, pa.int64()), "lo": pa.array(lo, pa.int32()), "hi": pa.array(hi, pa.int32())})

    return later.groupBy("first", "chunk").cogroup(earlier.groupBy("e", "c")).applyInArrow(run, "doc_id long, lo int, hi int")


def merged(parts: DataFrame) -> DataFrame:
    """(doc_id, gone): the disjoint sorted ranges that the ranges (doc_id, lo, hi) cover."""
    kind = "array<struct<lo:int,hi:int>>"

    def add(acc: Column, r: Column) -> Column:
        end = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(end.lo.alias("lo"), F.greatest(end.hi, r.hi).alias("hi"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1).hi >= r.lo), joined).otherwise(F.concat(acc, F.array(r)))
    return parts.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("r")) \
        .select("doc_id", F.aggregate("r", F.array().cast(kind), add).alias("gone"))


def deletions(docs: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """(doc_id, gone): for each document that loses lines, their ranges of numbers from 0."""
    own = sequences(docs, min_words)
    held = own.select("doc_id", F.explode(F.arrays_zip("lo", "hi", "h", "g")).alias("b")).select("doc_id", "b.*")
    shared = written(with_group(
        held, ["h", "g"], "doc_id", {"least": F.min("doc_id"), "most": F.max("doc_id"), "n": F.count(F.lit(1))},
        {"first": F.min("least"), "last": F.max("most"), "holders": F.sum("n")},
        keep=lambda x: x.where("first < last").drop("last"))
        .where("doc_id > first").select("doc_id", "lo", "hi", "first", "holders"), "shared-blocks")
    # rows that repeat a document count as one
    lines = own.select("doc_id", "hashes", "n").dropDuplicates(["doc_id"])

    def pairs(of: DataFrame) -> DataFrame:
        return written(of.groupBy("doc_id", "first").agg(F.min("lo").alias("from"), F.max("hi").alias("to")), "line-pairs")

    by_rare = written(align(pairs(shared.where(F.col("holders") <= rare)), lines, min_words), "line-ranges")
    done = merged(by_rare).withColumnRenamed("doc_id", "d")
    frequent = shared.where(F.col("holders") > rare)
    covered = F.exists("gone", lambda r: (r.lo <= F.col("lo")) & (F.col("hi") <= r.hi))
    left = frequent.join(done, F.col("doc_id") == F.col("d"), "left").where(~F.coalesce(covered, F.lit(False)))
    return merged(by_rare.unionByName(align(pairs(left), lines, min_words)))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """``docs`` with lines of earlier documents deleted from ``text``, and removed_lines (their numbers).

    Every row stays; all other columns come along. ``rare`` sets which pairs are
    aligned first; the result does not depend on it. Defined cases: rows with a
    null text or doc_id are left as they are (removed_lines is empty); blank
    lines link nothing, end a block and stay; a text all of whose lines are
    deleted becomes empty; rows that repeat a doc_id are cleaned alike, each by
    its own lines, if their texts are equal (rows of one doc_id with different
    texts are outside the data model: the id is the document); a column named
    removed_lines is replaced.
    """
    d = docs.drop("removed_lines")
    gone = deletions(d, min_words, rare).withColumnsRenamed({"doc_id": "_gone_id", "gone": "_gone"})
    text = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.exists("_gone", lambda r: (r.lo <= i) & (i < r.hi))), "\n")
    out = d.join(gone, F.col("doc_id") == F.col("_gone_id"), "left")
    cleaned = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(text)
    removed = F.flatten(F.transform("_gone", lambda r: F.sequence(r.lo, r.hi - 1)))
    return out.select(*[cleaned.alias("text") if c == "text" else F.col(f"`{c}`") for c in d.columns],
                      F.coalesce(removed, F.array().cast("array<int>")).alias("removed_lines"))
