"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Only confirmed toxic rows count as labelled; a sample of all texts, toxic ones
among them, is the unlabelled text. Each classifier is a numpy linear model over
the presence of words and word beginnings with the sigmoid loss l and minimises

    prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])

by gradient steps; where the corrected negative part falls below zero, the step
goes the other way, as the non-negative estimator asks. Several classifiers see
all positives and different unlabelled rows; their mean logit is the score.

Fitting uses at most about ``positives`` confirmed rows and ``unlabelled`` rows
of all kinds, chosen by a hash of id or text (equal texts count once), and the
``FEATURES`` of them that separate the two samples most. Only these and their
weights reach the driver. The class prior is the share of toxic rows
among the learnable labels, unless it is given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

POSITIVES, UNLABELLED, FEATURES, BAGS = 5_000, 20_000, 4_096, 4
#: A word or beginning is a feature if its share among positives exceeds that among unlabelled rows by so many deviations.
LEAST_Z = 4.0
#: Features after which a batch of rows is passed on, and rows of the samples for each task.
HELD, TASK_ROWS = 1 << 15, 1_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    """The distinct lower-cased words (runs of letters) of a whole text."""
    return set(_WORD.findall(text.lower()))


def features(text: str) -> set[str]:
    """Words, marked by ``=``, and their beginnings of 3 to 7 letters: insults take endings."""
    own = words(text)
    return {"=" + w for w in own} | {w[:k] for w in own for k in range(3, min(7, len(w)) + 1)}


def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, p, u, bag of each row with the sorted features of its text.

    A batch ends when its rows have ``HELD`` features, so it holds that many and
    those of one text more, whatever the number and the length of the texts.
    """
    for b in batches:
        lo, ends, found = 0, [0], []
        for i in range(b.num_rows):
            found += sorted(features(b.column("text")[i].as_py()))
            ends.append(len(found))
            if len(found) >= HELD or i == b.num_rows - 1:
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.string()))
                cols = [b.column(c).slice(lo, i + 1 - lo) for c in ("row", "p", "u", "bag")]
                yield pa.RecordBatch.from_arrays([*cols, lists], names=["row", "p", "u", "bag", "words"])
                lo, ends, found = i + 1, [0], []


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self.heads = {w.lstrip("=")[:3] for w in self.weights}

    def score(self, text: str | None) -> float:
        """Probability of toxic, 0 to 1; an empty text has the bias alone."""
        near = " ".join(w for w in words(text or "") if w[:3] in self.heads)
        z = self.bias + sum(self.weights.get(f, 0.0) for f in features(near))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def nnpu(p: list[np.ndarray], u: list[np.ndarray], dim: int, prior: float, steps: int = 400, rate: float = 0.2,
         l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier; rows are lists of feature numbers."""
    def flat(rows):
        return (np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)] or [[]]).astype(np.int64),
                np.concatenate([*rows, []]).astype(np.int64), len(rows))

    w, b = np.zeros(dim), float(np.log(prior / (1 - prior)))
    (pr, pc, np_), (ur, uc, nu) = flat(p), flat(u)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    m, v = np.zeros(dim + 1), np.zeros(dim + 1)
    for t in range(1, steps + 1):
        sp = sig(b + np.bincount(pr, w[pc], np_))
        su = sig(b + np.bincount(ur, w[uc], nu))
        negative = su.mean() - prior * sp.mean()            # E_U[l(-)] - prior * E_P[l(-)]
        slope_p, slope_u = prior * sp * (1 - sp) / np_, su * (1 - su) / nu
        if negative < 0:                                    # overfitted: undo the negative part, leave the rest
            dp, du = slope_p, -slope_u
        else:                                               # prior * E_P[l(+)] and the negative part
            dp, du = -2 * slope_p, slope_u
        g = np.append(np.bincount(pc, dp[pr], dim) + np.bincount(uc, du[ur], dim) + l2 * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, prior: float | None = None, positives: int = POSITIVES,
        unlabelled: int = UNLABELLED, bags: int = BAGS) -> Model:
    """Learn from texts and the confirmed toxic labels of the rows for which ``learn`` (over doc_id) holds.

    A document with several labels is confirmed toxic if one says so. Without a
    confirmed row or any text, every score is the prior.
    """
    lab = labels.where(F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL")
    n_pos, n_all = lab.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_pos = int(n_pos or 0)
    if prior is None:
        prior = min(0.99, max(1e-3, n_pos / n_all)) if n_all else 0.5
    texts = docs.where(F.col("doc_id").isNotNull() & learn & F.col("text").isNotNull()).select("doc_id", "text")
    n_texts = texts.count()
    if not n_pos or not n_texts:
        return Model({}, float(np.log(prior / (1 - prior))))
    # the confirmed ids are drawn first: about ``positives`` of them, whatever the number of labels, so
    # they may be broadcast, and no text is shuffled that is not in a sample
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 30)) / float(1 << 30)
    ids = lab.where("toxic = 1").where(part("doc_id") < min(1.0, positives / n_pos)).select("doc_id")
    drawn = texts.join(F.broadcast(ids), "doc_id", "left_semi").withColumns({"p": F.lit(1), "u": F.lit(0)}) \
        .unionByName(texts.where(part("text") < min(1.0, unlabelled / n_texts)).withColumns({"p": F.lit(0), "u": F.lit(1)}))

    # a fixed number of rows for a task: a shuffle's own number may fold into one
    parts = max(1, int(min(positives, n_pos) + min(unlabelled, n_texts)) // TASK_ROWS)
    rows = drawn.select(F.xxhash64("text").cast("string").alias("row"), "p", "u", "text") \
        .groupBy("row").agg(F.max("p").alias("p"), F.max("u").alias("u"), F.any_value("text").alias("text")).repartition(parts, "row") \
        .withColumn("bag", F.pmod(F.hash("row"), F.lit(bags)))
    sample = written(rows.mapInArrow(tokens, "row string, p int, u int, bag int, words array<string>"), "toxic-sample")
    k = sample.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).first()
    if not k.p or not k.u:
        return Model({}, float(np.log(prior / (1 - prior))))
    seen = sample.select("p", "u", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("p").alias("np"), F.sum("u").alias("nu"))
    a, b = (F.col("np") + 0.5) / (k.p + 1), (F.col("nu") + 0.5) / (k.u + 1)
    z = (a - b) / F.sqrt(a * (1 - a) / k.p + b * (1 - b) / k.u)
    vocab = sorted(r.word for r in seen.withColumn("z", z).where((F.col("np") >= 3) & (F.col("z") >= LEAST_Z))
                   .orderBy(F.desc("z"), "word").limit(FEATURES).select("word").collect())
    number = {w: i for i, w in enumerate(vocab)}

    def train(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("row")
        x = [np.array([number[w] for w in ws], np.int64) for ws in b.words]
        p = [r for r, q in zip(x, b.p) if q]
        u = [r for r, q in zip(x, b.u) if q]
        if not p or not u:
            return pd.DataFrame({"w": [], "bias": []})
        w, bias = nnpu(p, u, len(number), prior)
        return pd.DataFrame({"w": [w.tobytes()], "bias": [bias]})

    # every classifier sees all positives and its own share of the unlabelled rows
    every = sample.where("p = 1").withColumns({"bag": F.explode(F.sequence(F.lit(0), F.lit(bags - 1))), "own": F.col("bag")})
    every = every.withColumn("u", F.when(F.col("bag") == F.col("own"), F.col("u")).otherwise(0)).select(sample.columns)
    # only the chosen features travel to the classifiers
    own = F.array_intersect("words", F.lit(vocab)) if vocab else F.array().cast("array<string>")
    dealt = sample.where("p = 0").unionByName(every).withColumn("words", own)
    got = dealt.groupBy("bag").applyInPandas(train, "w binary, bias double").collect()
    if not got:
        return Model({}, float(np.log(prior / (1 - prior))))
    w = np.mean([np.frombuffer(r.w) for r in got], axis=0) if vocab else np.zeros(0)
    return Model(dict(zip(vocab, map(float, w))), float(np.mean([r.bias for r in got])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on); reads nothing but text.

    Defined cases: a null text scores as an empty one; repeated rows each get
    their own; columns of these two names are replaced.
    """
    def run(col: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in col], dtype="float64")

    out = docs.drop("score", "predicted").withColumn("score", F.pandas_udf(run, "double")(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
