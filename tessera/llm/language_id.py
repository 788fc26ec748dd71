"""Language identification by nearest centroid over TF-IDF n-gram vectors.

A text is lower-cased; everything that is no letter becomes a single space. Its
character n-grams of one to three letters are hashed to ``DIM`` counts, weighted
by inverse document frequency and normalised to length one. Each language has
several centroids, found by spherical k-means in a task of its own. A text gets
the language of the centroid with the largest cosine, of equal ones the first
language by name. It is rejected when it is farther from that centroid than
texts of this language and length are, or when the best centroid of another
language is nearer, in proportion, than it is to them: a language that was not
learned lies between those that were.

How far and how near those are is measured over all rows that may be learned
from, not over the sample, where the nearest centroid is of the row's own
language: the ``LOW``/2 quantile of their cosines and the 1 - ``LOW``/2 quantile of
the second language's share of it, for each language and band of length (powers
of two of the number of n-grams, as short texts have low cosines; one band for
those of about one word). With n rows the bounds count for n / (n + ``TRUST``)
and n / (n + ``TRUST_NEAR``), so that a few rows reject little. A band in which a language has fewer than
``ENOUGH`` rows takes those of all languages, and, as long as these are too few,
those of shorter bands, down to one word.

Fitting uses a sample of about ``per_lang`` rows of each language, chosen by a
hash of doc_id; whole texts are read, and every language with a row that may be
learned from is learned. Only counts by language, the document frequencies, the
centroids (48 KB for a language) and two quantiles for each language and band
reach the driver: they grow with the languages, not with the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

DIM = 4096
PER_LANG, CENTROIDS = 1000, 3
#: Share of rows beyond the bounds , half beyond each; rows at which half of each counts; rows that do for a band.
LOW, TRUST, TRUST_NEAR, ENOUGH = 0.001, 20, 50, 50
#: Share of the way from 1 to the quantile at which the second language is too near.
SOFT = 0.85
#: Bands of length; texts of fewer than 2^SHORT n-grams (about 15 letters) are one band.
BANDS, SHORT = 40, 6
_BLOCK = 1 << 20
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or 0 for no letter; built once in a process."""
    if not _TABLE:
        t = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
        _TABLE.append(t)
    return _TABLE[0]


def _buckets(codes: np.ndarray) -> list[np.ndarray]:
    """Hash buckets of the 1-, 2- and 3-grams; -1 where one would be only spaces or join two texts."""
    c = codes.astype(np.uint64)
    out = []
    h = c * np.uint64(0x9E3779B97F4A7C15)
    for n in (1, 2, 3):
        if n > 1:
            h = (h[:-1] * np.uint64(0x100000001B3)) ^ (c[n - 1:] * np.uint64(0x9E3779B97F4A7C15))
        m = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append((m >> np.uint64(52)).astype(np.int64))
    return out


def counts(text: str) -> np.ndarray | None:
    """n-gram counts of a whole text; None if it has no letter."""
    total = np.zeros(DIM, np.float32)
    table, any_letter = _letters(), False
    last = np.zeros(1, np.uint32)
    for lo in range(0, len(text), _BLOCK):
        codes = table[np.frombuffer(text[lo:lo + _BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        any_letter = any_letter or bool(codes.any())
        codes = np.concatenate([last, codes])
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]  # runs of others are one space
        grams = _buckets(codes)
        for n, g in zip((1, 2, 3), grams):
            skip = max(0, len(last) - n + 1) if lo else 0  # counted with the block before
            ok = g[skip:]
            if n == 1:
                ok = ok[codes[skip:] != 0]
            total += np.bincount(ok, minlength=DIM)
        last = codes[-2:]
    return total if any_letter else None


def vector(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = count * idf
    return v / max(float(np.linalg.norm(v)), 1e-12)


def band(count: np.ndarray) -> int:
    """Band of length of a text with these counts."""
    return min(BANDS - 1, max(SHORT, int(np.log2(max(1.0, float(count.sum(dtype=np.float64)))))) - SHORT)


@dataclass
class Model:
    langs: list[str]          # of each centroid
    centroids: np.ndarray     # rows of length one
    floor: np.ndarray         # by centroid and band: the cosine below which its language is rejected
    near: np.ndarray          # likewise: the share of the second language above which it is
    idf: np.ndarray

    def __post_init__(self):
        # centroids are ordered by language
        self.starts = [i for i, x in enumerate(self.langs) if not i or x != self.langs[i - 1]]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected); ``und`` without a letter."""
        c = counts(text) if text else None
        if c is None or not self.langs:
            return "und", 0.0, True
        k, s, second = nearest(self.centroids @ vector(c, self.idf), self.starts)
        at = band(c)
        return self.langs[k], s, bool(s < self.floor[k, at] or second > self.near[k, at])


def nearest(sims: np.ndarray, starts: list[int]) -> tuple[int, float, float]:
    """The nearest centroid, its cosine (0 to 1), and the share of it that the best of another language has."""
    k = int(np.argmax(sims))
    s = float(min(1.0, max(0.0, sims[k])))
    best = np.sort(np.maximum.reduceat(sims, starts))
    return k, s, min(1.0, max(0.0, float(best[-2])) / s) if len(starts) > 1 and s else 0.0


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centres are far apart, so the result depends on the rows alone."""
    centres = [x.mean(axis=0)]
    while len(centres) < min(k, len(x)):
        near = np.max(np.stack([x @ (c / max(np.linalg.norm(c), 1e-12)) for c in centres]), axis=0)
        centres.append(x[int(np.argmin(near))])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _group(k: int, idf: np.ndarray):
    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["doc_id", "counts"])
        x = np.stack([vector(np.frombuffer(c, np.float32), idf) for c in b["counts"]])
        c = _kmeans(x, k)
        return pd.DataFrame({"lang": b.lang.iloc[0], "centroid": [r.astype(np.float32).tobytes() for r in c]})
    return run


def _bounds(rows: DataFrame, langs: list[str], centroids: np.ndarray, idf: np.ndarray, low: float) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each language its floors and second shares by band, from all ``rows`` that are told right."""
    starts = Model(langs, centroids, None, None, idf).starts

    def cosines(batches):
        for b in batches:
            got = []
            for lang, t in zip(b.lang, b.text):
                if (c := counts(t)) is not None:
                    k, s, second = nearest(centroids @ vector(c, idf), starts)
                    if langs[k] == lang:
                        got.append((lang, band(c), s, second))
            yield pd.DataFrame(got, columns=["lang", "band", "cosine", "second"])

    found = rows.select("lang", "text").mapInPandas(cosines, "lang string, band int, cosine double, second double") \
        .rollup("band", "lang").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("cosine", low / 2, 10000).alias("q"),
                                    F.percentile_approx("second", 1 - low / 2, 10000).alias("r")) \
        .where("band IS NOT NULL").collect()
    at = {(r.lang, r.band): (r.n, r.q, r.r) for r in found}  # of all languages where lang is null
    out = {}
    for x in set(langs):
        floor, near = np.zeros(BANDS), np.ones(BANDS)
        for k in range(BANDS):
            n, q, r, j = 0, 1.0, 0.0, k
            while n < ENOUGH and j >= 0:
                one = at.get((x, j), (0, 1.0, 0.0))
                m, least, most = one if one[0] >= ENOUGH else at.get((None, j), (0, 1.0, 0.0))
                n, q, r, j = n + m, min(q, least), max(r, most), j - 1
            floor[k], near[k] = q * n / (n + TRUST), 1 - (1 - r) * SOFT * n / (n + TRUST_NEAR)
        out[x] = floor, near
    return out


def fit(docs: DataFrame, learn: Column, per_lang: int = PER_LANG, centroids: int = CENTROIDS, low: float = LOW) -> Model:
    """Learn from text and non-null lang of the rows for which ``learn`` holds."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    n = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    none = np.zeros((0, BANDS))
    if not n:
        return Model([], np.zeros((0, DIM), np.float32), none, none, np.ones(DIM))
    share = F.element_at(F.create_map(*[F.lit(v) for lang, k in sorted(n.items()) for v in (lang, min(1.0, per_lang / k))]), F.col("lang"))
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share * (1 << 30))

    def count(batches):
        for b in batches:
            got = [(d, lang, c.tobytes()) for d, lang, t in zip(b.doc_id, b.lang, b.text) if (c := counts(t)) is not None]
            yield pd.DataFrame(got, columns=["doc_id", "lang", "counts"])

    sample = written(drawn.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        count, "doc_id string, lang string, counts binary"), "langsample")

    def presence(batches):
        total, k = np.zeros(DIM), 0
        for b in batches:
            for c in b["counts"]:
                total += np.frombuffer(c, np.float32) > 0
                k += 1
        yield pd.DataFrame({"n": [k], "df": [total.tobytes()]})

    parts = sample.select("counts").coalesce(16).mapInPandas(presence, "n long, df binary").collect()
    seen = sum(p.n for p in parts)
    df = sum((np.frombuffer(p.df) for p in parts), np.zeros(DIM))
    idf = (np.log((1 + seen) / (1 + df)) + 1).astype(np.float32)
    got = sorted(sample.groupBy("lang").applyInPandas(_group(centroids, idf), "lang string, centroid binary")
                 .collect(), key=lambda r: (r.lang, bytes(r.centroid)))
    c = np.stack([np.frombuffer(r.centroid, np.float32) for r in got]) if got else np.zeros((0, DIM), np.float32)
    langs = [r.lang for r in got]
    if not langs:
        return Model([], c, none, none, idf)
    bounds = _bounds(rows, langs, c, idf, low)
    return Model(langs, c, np.array([bounds[x][0] for x in langs]), np.array([bounds[x][1] for x in langs]), idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected; reads nothing but text.

    Defined cases: lang_pred is ``und``, the score 0 and rejected true for a
    null text, one without a letter, and if nothing could be learned; repeated
    rows each get their own; columns of these three names are replaced.
    """
    text = docs.drop("lang_pred", "score", "rejected")
    names = [f.name for f in text.schema.fields]
    kind = "struct<lang_pred: string, score: double, rejected: boolean>"

    def run(col: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in col], columns=["lang_pred", "score", "rejected"])

    out = text.withColumn("_lang", F.pandas_udf(run, kind)(F.col("text")))
    return out.select(*[F.col(f"`{n}`") for n in names], "_lang.lang_pred", "_lang.score", "_lang.rejected")
