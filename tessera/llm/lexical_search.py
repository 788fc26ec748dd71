"""Ranked lexical search by pipelined term partitioning.

The index is split two ways: by term, among ``owners`` stages, and by document,
in shards of ``SHARD`` consecutive rows. Items travel in bundles. A bundle goes
to each shard that holds any of its terms and there through the owners one
after another: each stage cogroups the bundle's items (their terms with
weights, and the sparse accumulators gained so far) with the postings that the
owner has of the bundle's terms in this shard, adds their integer contributions,
and sends the items on. The last stage sends only each item's best documents of
the shard, from which the best of all are chosen.

Documents' terms that no item has are left out where they are counted, by a
bitmap of ``MASK`` bits over the CRC of the items' terms: it has this size
whatever the number of terms, and what passes it by chance finds no match in
the vocabulary.

A group holds the accumulators of at most ``BUNDLE`` items over ``SHARD``
documents, whatever the size of the corpus or the frequency of a term; a term
that all documents hold is spread over all shards. Every posting is counted.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import salted, written

#: Documents of a shard and items of a bundle: powers of two, as they are the low bits of a row's number.
SHARD, BUNDLE = 1 << 12, 1 << 8
OWNERS = 4
#: Texts are matched by about so many bytes at a time, and results yielded by so many terms.
CHUNK, YIELD = 1 << 20, 1 << 15
#: A term: ASCII letters and digits and everything beyond ASCII (in UTF-8: all bytes from 0x80 on).
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
TERM_SALTS = 16
MASK = 1 << 20


def term_counts(text: str | None) -> Counter:
    """The terms of a whole text, A-Z lower-cased, with their occurrences."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    out, at = Counter(), 0
    while at < len(data):
        gap = GAP.search(data, at + CHUNK)  # a chunk ends at a gap, so it splits no term
        end = gap.start() if gap else len(data)
        out.update(TERM.findall(data, at, end))
        at = end
    return out


def term_mask(terms: DataFrame) -> bytes:
    """A byte for each of ``MASK`` remainders of CRC-32: 1 where some term (column term) has it."""
    at = F.crc32("term") % MASK
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    words = np.zeros(MASK // 64, np.uint64)
    for r in terms.groupBy(F.floor(at / 64).cast("int").alias("word")).agg(F.bit_or(one).alias("bits")).collect():
        words[r.word] = r.bits & (1 << 64) - 1  # at most MASK / 64 rows
    return np.unpackbits(words.view(np.uint8), bitorder="little").tobytes()


def _term_rows(rows: DataFrame, key: str, name: str, mask: bytes = b"\1" * MASK) -> DataFrame:
    """A written table of one row per row: uid, key, n (all terms), and the terms that pass ``mask`` with their counts.

    Within a task, uids follow the key (nulls last): the order by uid inside a
    shard is the order by key.
    """
    kind = rows.schema[key].dataType

    def run(batches):
        for b in batches:
            lo, n, ends, terms, counts = 0, [], [0], [], []
            for i, text in enumerate(b.column("text")):
                found = term_counts(text.as_py())
                n.append(found.total())
                own = [t for t in found if mask[zlib.crc32(t) % MASK]]
                terms += own
                counts += [found[t] for t in own]
                ends.append(len(terms))
                if len(terms) >= YIELD or i == b.num_rows - 1:
                    at = pa.array(ends, pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        b.column("key").slice(lo, len(n)), pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(at, pa.array(terms, pa.binary()).cast(pa.string())),
                        pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], names=["key", "n", "terms", "counts"])
                    lo, n, ends, terms, counts = i + 1, [], [0], [], []

    schema = T.StructType([T.StructField("key", kind), T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    counted = rows.select(F.col(key).alias("key"), "text").mapInArrow(run, schema)
    counted = counted.sortWithinPartitions(F.asc_nulls_last("key"))
    return written(counted.withColumn("uid", F.monotonically_increasing_id()), name)


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    col = table.column(name).combine_chunks()
    col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    return np.concatenate([[0], np.cumsum(np.asarray(col.value_lengths()))]).astype(np.int64), np.asarray(col.flatten())


def _stage(k: int, last: bool):
    """One term owner: adds the postings of its terms to the accumulators of a bundle's items in one shard."""
    def add(key, items: pa.Table, postings: pa.Table) -> pa.Table:
        order = np.argsort(postings.column("tid").to_numpy(), kind="stable")
        tid = postings.column("tid").to_numpy()[order]
        doc, share = postings.column("doc").to_numpy()[order], postings.column("share").to_numpy()[order].astype(np.int64)
        owned, first = np.unique(tid, return_index=True)
        ends = dict(zip(owned.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(tid)])))
        t_at, t_id = _lists(items, "tids")
        _, t_weight = _lists(items, "weights")
        a_at, a_doc = _lists(items, "docs")
        _, a_sum = _lists(items, "sums")
        docs, sums = [], []
        for i in range(items.num_rows):
            acc = np.zeros(SHARD, np.int64)
            acc[a_doc[a_at[i]:a_at[i + 1]]] = a_sum[a_at[i]:a_at[i + 1]]
            for t, w in zip(t_id[t_at[i]:t_at[i + 1]].tolist(), t_weight[t_at[i]:t_at[i + 1]].tolist()):
                if t in ends:
                    lo, hi = ends[t]
                    acc[doc[lo:hi]] += w * share[lo:hi]  # a document is once in a term's postings
            held = np.flatnonzero(acc)
            if last and len(held) > k:
                held = held[acc[held] >= np.partition(acc[held], -k)[-k]]
                held = np.sort(held[np.lexsort((held, -acc[held]))[:k]])
            docs.append(held.astype(np.int16))
            sums.append(acc[held])
        at = np.cumsum([0, *map(len, docs)]).astype(np.int32)
        doc, total = pa.array(np.concatenate(docs)), pa.array(np.concatenate(sums))
        if last:
            shard = key[1].as_py() * SHARD
            item = np.repeat(items.column("item").to_numpy(), np.diff(at))
            return pa.table({"item": item, "uid": shard + np.asarray(doc).astype(np.int64), "score": total})
        out = items.select(["bundle", "shard", "item", "tids", "weights"]).combine_chunks()
        return out.append_column("docs", pa.ListArray.from_arrays(at, doc)).append_column("sums", pa.ListArray.from_arrays(at, total))
    return add


def search(docs: DataFrame, items: DataFrame, k: int = 10, k1: int = 8, b: int = 75, owners: int = OWNERS) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    A document's score adds, over the item's terms with repeats, the term's
    weight floor(1000 ln((2N+2)/(2df+1))) times (10^9 tf) div (1000 tf + k1 m),
    where m = 100 - b + (b n N) div L; in 64-bit integers. Only scores above 0
    count; equal scores rank by ascending doc_id.

    Defined cases: null and empty texts have no terms: such a document is never
    found, such an item has no rows. A row is a document or an item of its own:
    a repeated document may take several ranks, a repeated item has its rows
    each time. A null doc_id ranks after all others of its score. Columns
    other than doc_id, item_id and text are not read. Empty tables give no rows.
    """
    asked = _term_rows(items, "item_id", "item-terms").withColumn("bundle", F.shiftright("uid", BUNDLE.bit_length() - 1))
    vocabulary = written(asked.select("bundle", F.explode("terms").alias("term")).groupBy("term")
                         .agg(F.collect_set("bundle").alias("bundles"))
                         .withColumn("tid", F.monotonically_increasing_id())
                         .withColumn("owner", F.pmod(F.xxhash64("term"), F.lit(owners)).cast("int")), "vocabulary")
    own = _term_rows(docs, "doc_id", "doc-terms", term_mask(vocabulary))
    n_docs, n_terms = own.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    # a frequent term has a row in very many documents: its postings meet the vocabulary in TERM_SALTS places
    flat = salted(own.select("uid", "n", F.explode(F.arrays_zip("terms", "counts")).alias("t")), "uid", TERM_SALTS)
    many = vocabulary.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(TERM_SALTS - 1))))
    found = flat.select("uid", "n", "_salt", F.col("t.terms").alias("term"), F.col("t.counts").alias("tf")).join(many, ["term", "_salt"])
    m = F.expr(f"{100 - b} + ({b} * n * {n_docs or 0}L) div {n_terms or 1}L")
    postings = written(found.select(
        "tid", "owner", "uid", F.explode("bundles").alias("bundle"),
        F.expr("1000000000L * tf").alias("_a"), (1000 * F.col("tf") + k1 * m).alias("_b"))
        .select("tid", "owner", "bundle", F.shiftright("uid", SHARD.bit_length() - 1).alias("shard"),
                F.col("uid").bitwiseAND(SHARD - 1).cast("short").alias("doc"), F.expr("_a div _b").cast("int").alias("share")), "postings", by=["owner"])
    # each document once per term, and each term in one bundle at least: df is the count within any one of them
    df = postings.groupBy("tid", "bundle").count().groupBy("tid").agg(F.max("count").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * (n_docs or 0) + 2) / (2 * F.col("df") + 1)))
    weights = vocabulary.join(df, "tid").select("term", "tid", weight.alias("w"))

    each = asked.select("bundle", F.col("uid").alias("item"), F.explode(F.arrays_zip("terms", "counts")).alias("t")) \
        .select("bundle", "item", F.col("t.terms").alias("term"), F.col("t.counts").alias("repeats")).join(weights, "term")
    bundles = written(each.groupBy("bundle", "item").agg(
        F.collect_list(F.struct("tid", (F.col("w") * F.col("repeats")).alias("weight"))).alias("t"))
        .select("bundle", "item", F.col("t.tid").alias("tids"), F.col("t.weight").alias("weights")), "bundles")

    carried = postings.select("bundle", "shard").distinct().join(bundles, "bundle").select(
        "bundle", "shard", "item", "tids", "weights", F.array().cast("array<short>").alias("docs"),
        F.array().cast("array<bigint>").alias("sums"))
    for s in range(owners):
        mine = postings.where(F.col("owner") == s).select(
            F.col("bundle").alias("for"), F.col("shard").alias("at"), "tid", "doc", "share")
        last = s == owners - 1
        carried = carried.groupBy("bundle", "shard").cogroup(mine.groupBy("for", "at")).applyInArrow(
            _stage(k, last), "item long, uid long, score long" if last else carried.schema)
    best = Window.partitionBy("item").orderBy(F.desc("score"))
    # ties stay until doc_id decides; each shard has sent k rows of an item at most
    near = written(carried.where("score > 0").withColumn("_r", F.rank().over(best)).where(F.col("_r") <= k).drop("_r"), "near")
    named = near.join(own.select("uid", F.col("key").alias("doc_id")), "uid")
    full = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid"))
    top = named.withColumn("rank", F.row_number().over(full)).where(F.col("rank") <= k)
    return top.join(asked.select(F.col("uid").alias("item"), F.col("key").alias("item_id")), "item") \
        .select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id,
  unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT count(*)::BIGINT AS big_n, sum(len(t))::BIGINT AS big_l FROM d WHERE len(t) > 0),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
v AS (SELECT term, floor(1000 * ln((2 * c.big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM p, c WHERE term IN (SELECT term FROM q) GROUP BY term, c.big_n),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * len(t)::BIGINT * big_n) // big_l) AS m FROM d, c WHERE len(t) > 0),
s AS (SELECT q.i, q.item_id, p.r, m.doc_id, sum(v.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m)))::BIGINT AS score
      FROM q JOIN v USING (term) JOIN p USING (term) JOIN m ON p.r = m.r GROUP BY q.i, q.item_id, p.r, m.doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM s WHERE score > 0) WHERE rank <= 10
"""
