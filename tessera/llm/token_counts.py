"""Token counts; huge documents are encoded in overlapping chunks and resynchronised.

A document of more than ``chunk`` characters is cut into chunks that overlap.
The chunks become rows of their own (spread over all tasks) and are encoded
with offsets. Two neighbours are spliced at a place in their overlap where both
have a token start, both give the same tokens for the word that follows, and
the characters prove that the place is stable: white space before it, a letter
or digit at it, which no match of the pre-tokenizer spans, whatever stands
further left or right. Documents in which some overlap has no such place are
cut again with an overlap four times as wide, at last as a single chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.tokens import WordCounter, library, shared

CHUNK, OVERLAP = 1 << 16, 1 << 10


def _cuts(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str, bool]]:
    """(start, piece, is last) of the chunks: each ends ``overlap`` beyond the next one's start."""
    step = max(chunk, 2 * overlap)
    start = 0
    while True:
        last = start + step + overlap >= len(text)
        yield start, text[start:start + step + overlap], last
        if last:
            return
        start += step


def _rows(keys, docs, sizes, texts, chunk, overlap):
    for key, doc, n_bytes, text in zip(keys, docs, sizes, texts):
        for i, (start, piece, last) in enumerate(_cuts(text, chunk, overlap)):
            yield key, doc, n_bytes, overlap, i, start, piece, last


_CHUNK = "key string, doc_id string, n_bytes long, overlap long, i long, start long, piece string, last boolean"
_NAMES = [c.split()[0] for c in _CHUNK.split(", ")]


def _batches(rows, size: int = 1 << 22):
    """Pandas frames of about ``size`` characters."""
    out, held = [], 0
    for r in rows:
        out.append(r)
        held += len(r[6])
        if held >= size:
            yield pd.DataFrame(out, columns=_NAMES)
            out, held = [], 0
    if out:
        yield pd.DataFrame(out, columns=_NAMES)


def _encode(path: str):
    def run(batches):
        lib = library(path)
        for b in batches:
            out = []
            for key, i, start, piece, last, overlap in zip(b.key, b.i, b.start, b.piece, b["last"], b.overlap):
                e = lib.encode(piece, add_special_tokens=False)
                n, offs, ids = len(e.ids), e.offsets, e.ids
                head, tail = [], []
                zones = ([(head, 0, overlap)] if i else []) + \
                        ([] if last else [(tail, len(piece) - overlap, len(piece))])
                at = {a: k for k, (a, z) in reversed(list(enumerate(offs)))} if zones else {}
                for side, lo, hi in zones:
                    for p in range(max(lo, 1), hi):
                        k = at.get(p)
                        if k is None or piece[p - 1] not in " \n" or not piece[p].isalnum():
                            continue
                        end = next((q for q in range(p, hi) if piece[q] in " \n"), None)
                        if end is None:
                            break
                        word, j = [], k
                        while j < n and offs[j][0] < end:
                            word += [ids[j], offs[j][0] - p, offs[j][1] - p]
                            j += 1
                        side.append({"p": start + p, "word": str(word), "n": k if side is head else n - k})
                out.append((key, i, n, head, tail))
            yield pd.DataFrame(out, columns=["key", "i", "n", "head", "tail"])
    return run


def _wider(chunk: int):
    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("i")
        r = b.iloc[0]
        ends = [*b.start[1:], b.start.iloc[-1] + len(b.piece.iloc[-1])]
        text = "".join(p[:z - s] for p, s, z in zip(b.piece, b.start, ends))
        overlap = min(4 * r.overlap, len(text))
        return pd.DataFrame(list(_rows([r.key], [r.doc_id], [r.n_bytes], [text], chunk, overlap)), columns=_NAMES)
    return run


def long_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id string), by overlapping chunks."""
    def cut(batches):
        for b in batches:
            yield from _batches(_rows([uuid.uuid4().hex for _ in b.index], b.doc_id, b.n_bytes, b.text, chunk, overlap))

    # the keys are random, so everything that follows reads the written table
    left = written(docs.select("doc_id", "n_bytes", "text").mapInPandas(cut, _CHUNK), "chunks")
    done = None
    side = "array<struct<p: long, word: string, n: long>>"
    while True:
        enc = written(left.repartition(F.col("key"), F.col("i")).mapInPandas(
            _encode(path), f"key string, i long, n long, head {side}, tail {side}"), "encoded")
        tails = enc.select("key", "i", F.explode("tail").alias("t")).select("key", "i", "t.p", "t.word", F.col("t.n").alias("a"))
        heads = enc.select("key", (F.col("i") - 1).alias("i"), F.explode("head").alias("t")) \
            .select("key", "i", "t.p", "t.word", F.col("t.n").alias("b"))
        cut_at = tails.join(heads, ["key", "i", "p", "word"]).groupBy("key", "i") \
            .agg(F.min_by(F.col("a") + F.col("b"), "p").alias("twice"))
        sums = enc.groupBy("key").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) - 1).alias("joints")) \
            .join(cut_at.groupBy("key").agg(F.sum("twice").alias("twice"), F.count(F.lit(1)).alias("joined")), "key", "left")
        ok = F.col("joints") == F.coalesce("joined", F.lit(0))
        sums = written(sums.select("key", ok.alias("ok"), (F.col("n") - F.coalesce("twice", F.lit(0))).alias("n_tokens")), "spliced")
        got = left.where("i = 0").select("key", "doc_id", "n_bytes").join(sums.where("ok"), "key") \
            .select("doc_id", "n_bytes", "n_tokens")
        done = got if done is None else done.unionByName(got)
        failed = sums.where("not ok").select("key")
        if failed.isEmpty():
            return done
        left = written(left.join(failed, "key").groupBy("key").applyInPandas(_wider(chunk), _CHUNK), "chunks")


def token_counts(docs: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``path``: a file of the tokenizers library that lower-cases and drops white
    space, readable by every worker. Defined cases: a null text is empty and has
    no tokens; repeated rows and null doc_ids each give their own row; other
    columns are not read; an empty table gives an empty result. A document
    without any white space is encoded in one chunk in the end.
    """
    # doc_id travels as text: pandas would turn a column of longs with a null into doubles
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.col("doc_id").cast("string"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))

    def count(batches):
        counter = shared(WordCounter, path)
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "n_bytes": b.n_bytes, "n_tokens": [counter.count(t) for t in b.text]})

    short = d.where(F.length("text") <= chunk + overlap).mapInPandas(count, "doc_id string, n_bytes long, n_tokens long")
    long_ = long_counts(d.where(F.length("text") > chunk + overlap), path, chunk, overlap)
    return short.unionByName(long_).select(F.col("doc_id").cast("long"), "n_bytes", "n_tokens",
                                           (F.col("n_tokens") > limit).alias("over_limit"))
