"""Exact deduplication by skew-safe combining (built-in functions only).

1. *Local*: rows are grouped by (digest, salt, whole normalised text); the
   partial aggregate collapses copies inside each task before the shuffle.
2. *Salt groups*: the same aggregate, merged over all tasks, leaves one winner
   for each text and salt, so a text that a third of all rows share meets in
   ``SALTS`` places, not in one.
3. *Global*: the at most ``SALTS`` winners of a text are combined by
   (digest, whole text).

The grouping keys hold the full text at every stage: two texts fall together
only if they are equal. Decisions go back to the rows by (digest, salt) without
the text; rows of a digest that different texts share (none, for SHA-256) go
back by (digest, salt, text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import per_salt, salt_mask, salted, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: str | Column) -> Column:
    """Null counts as empty; only A-Z are lower-cased."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = lambda t: F.sha2(t, 256)) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (what ``digest`` gives).

    Of equal texts (equal after lower-casing A-Z) the row with the largest
    doc_id stays. Defined cases: a null text equals the empty one; a null
    doc_id is smaller than any other, and a group of only null ids has a null
    keep_id and keeps them all; rows that repeat the kept doc_id with the same
    text are all marked kept; group_size counts rows. Other columns of ``docs``
    are not read, whatever their names. An empty table gives an empty result.
    """
    rows = salted(docs.select("doc_id", normalised("text").alias("_t")).withColumn("_d", digest(F.col("_t"))), "doc_id")
    won = rows.groupBy("_d", "_salt", "_t").agg(F.max("doc_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    texts = won.repartition("_d").groupBy("_d", "_t").agg(
        F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"), salt_mask().alias("_mask"))
    # same partitioning: no further shuffle; only digests leave this stage
    digests = written(texts.groupBy("_d").agg(
        F.count(F.lit(1)).alias("_texts"), F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"), F.bit_or("_mask").alias("_mask")), "dedup")

    ids = rows.select("doc_id", "_d", "_salt")
    out = ids.join(per_salt(digests.where("_texts = 1").drop("_texts")), ["_d", "_salt"])
    shared = digests.where("_texts > 1").select("_d")
    if not shared.isEmpty():
        part = rows.join(shared, "_d")
        again = per_salt(texts.join(shared, "_d"))
        out = out.unionByName(part.join(again, ["_d", "_salt", "_t"]).select(out.columns))
    return out.select("doc_id", "keep_id", "group_size",
                      F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
                      F.col("_d").alias("text_sha256"))


SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
