"""URL filters by a Bloom filter cascade (built-in functions only).

A rule is a host, a path prefix and a verdict; its key is ``host`` followed by
``path``. A url's candidate keys are its host's suffixes of whole labels, each
followed by a prefix of its path, in the (labels, length) shapes that occur
among the rules. The rules of each verdict are one list, kept as a cascade:

* level 0 is a Bloom filter of the listed keys;
* level 1 holds the keys of the corpus that pass level 0 though they are not
  listed, level 2 the listed keys that pass level 1, and so on in turn, until
  no key of the other kind passes.

All candidate keys of the corpus go through level 0, so the first level that a
key fails tells without error whether it is listed. The filters enter the plan
as literals: a url is judged in its own row, with no join and no shuffle. A
list too long for one literal is split by a hash of the key; the parts' filters
are then tested one after another, each pass over the table that the last wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits of a filter for each key that it holds, and hashes of a key.
BITS_PER_KEY, HASHES = 12, 7
#: Bits of one literal filter (4 MB); longer lists are split into parts.
PART_BITS = 1 << 25
VERDICTS = ("block", "allow")


def url_parts(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


def _positions(key: Column, level: int, bits: int) -> Column:
    """The bit positions of a key in a filter of ``bits`` bits; each level has hashes of its own."""
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)),
                       lambda j: F.pmod(F.xxhash64(key, F.lit(level), j), F.lit(bits).cast("long")))


class BloomFilter:
    """A Bloom filter made by one aggregate, as an array literal of 64-bit words."""

    def __init__(self, keys: DataFrame, count: int, level: int):
        self.level, self.bits = level, max(64, -(-BITS_PER_KEY * count // 64) * 64)
        at = keys.select(F.explode(_positions(F.col("key"), level, self.bits)).alias("at"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))
        word = F.floor(F.col("at") / 64).cast("int").alias("word")
        words = ["0"] * (self.bits // 64)  # at most PART_BITS / 64 of them
        for r in at.groupBy(word).agg(F.bit_or(one).alias("set")).toLocalIterator():
            words[r.word] = str(r["set"])
        self.words = ",".join(words)

    def passes(self, key: Column) -> Column:
        # a foldable expression: the optimizer turns the text into one array literal
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")

        def is_set(at: Column) -> Column:
            word = F.get(words, F.call_function("div", at, F.lit(64).cast("long")).cast("int"))
            return F.call_function("shiftright", word, F.pmod(at, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
        return F.forall(_positions(key, self.level, self.bits), is_set)


def _member(levels: list[BloomFilter]) -> Callable[[Column], Column]:
    """Exact membership: even levels hold listed keys, odd ones the false positives of the level before."""
    def test(key: Column) -> Column:
        out = F.lit(len(levels) % 2 == 1)
        for i in reversed(range(len(levels))):
            out = F.when(levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
        return out
    return test


def _level(keys: DataFrame, level: int) -> BloomFilter | None:
    count = keys.count()
    return BloomFilter(keys, count, level) if count else None


def _cascade(first: BloomFilter, keys: DataFrame) -> Callable[[Column], Column]:
    """The further levels over ``keys`` (key, listed): all listed keys, and all others that pass ``first``."""
    levels, encode = [first], keys.where("NOT listed")
    other = keys.where("listed")
    while nxt := _level(encode, len(levels)):
        levels.append(nxt)
        encode, other = other.where(nxt.passes(F.col("key"))), encode
    return _member(levels)


def url_filter(pages: DataFrame, rules: DataFrame, unlisted: str = "allow") -> DataFrame:
    """Judge every url of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (``block`` or ``allow``). A rule fits
    its host and all subdomains where the url's path starts with the rule's.
    Of the rules that fit, the longest (in characters of host and path, then of
    the host) decides; ``rule`` is its host and path. Where none fits, no
    cascade holds a key of the url: ``rule`` is null and the verdict ``unlisted``.

    Defined cases: a null url, or one without ``://``, has an empty host and
    path; user names and ports belong to the host; a url without a path has an
    empty one, which starts with an empty rule path only. Null rule hosts and
    paths count as empty; rules with another verdict or none raise ValueError;
    of equal rules with both verdicts, block holds. Rows that repeat are judged
    each for itself; other columns of either table are not read. Without rules
    every url has the verdict ``unlisted``.

    The driver holds the rules' shapes (distinct pairs of label count and path
    length) and one part of a filter (at most ``PART_BITS`` bits) at a time.
    """
    bad = ~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))
    if not rules.where(bad).isEmpty():
        raise ValueError(f"a rule's verdict is one of {VERDICTS}")
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, UPPER.lower())
    path = F.coalesce("path", F.lit(""))
    listed = written(rules.select(host.alias("host"), path.alias("path"), (F.col("verdict") == "block").alias("block"))
                     .groupBy("host", "path").agg(F.max("block").alias("block"))
                     .select(F.concat("host", "path").alias("key"), _labels(F.col("host")).alias("labels"),
                             F.length("path").alias("length"), "block"), "rules")
    shapes = [(r.labels, r.length) for r in listed.select("labels", "length").distinct().collect()]

    h, p = url_parts("url")
    rows = pages.select("page_id", h.alias("host"), p.alias("path"))
    shape = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(k).alias("k")) for n, k in sorted(shapes)]) if shapes \
        else F.array().cast("array<struct<n:int,k:int>>")
    of = F.filter(shape, lambda s: (s.n <= _labels(F.col("host"))) & (s.k <= F.length("path")))
    keys = F.array_distinct(F.transform(of, lambda s: F.concat(
        F.call_function("substring_index", F.col("host"), F.lit("."), -s.n),
        F.call_function("substring", F.col("path"), F.lit(1), s.k))))
    rows = rows.withColumn("_keys", keys).withColumn("_hits", F.array().cast("array<struct<long:int,host:int,key:string,block:boolean>>"))

    total = listed.count()
    parts = max(1, -(-BITS_PER_KEY * total // PART_BITS))
    for i in range(parts):
        mine = (lambda k, i=i: F.pmod(F.xxhash64(k), F.lit(parts).cast("long")) == i) if parts > 1 else (lambda k: F.lit(True))
        own = listed.where(mine(F.col("key")))
        first = {b: _level(own.where("block" if b else "NOT block"), 0) for b in (True, False)}
        if not any(first.values()):
            continue
        # the complete key universe: every candidate key of every row that passes a first level
        may = F.filter("_keys", lambda k: mine(k) & reduce(or_, [f.passes(k) for f in first.values() if f]))
        universe = rows.select(F.explode(may).alias("key"), F.lit(None).cast("boolean").alias("block")).distinct()
        known = written(universe.unionByName(own.select("key", "block")).groupBy("key").agg(F.max("block").alias("block")), "universe")
        member = {}
        for b, f in first.items():
            if f:
                is_b = F.coalesce(F.col("block") == b, F.lit(False))
                member[b] = _cascade(f, known.where(f.passes(F.col("key"))).select("key", is_b.alias("listed")))
        block = member.get(True, lambda k: F.lit(False))
        allow = member.get(False, lambda k: F.lit(False))
        hits = F.transform(F.filter("_keys", lambda k: mine(k) & (block(k) | allow(k))), lambda k: F.struct(
            F.length(k).alias("long"), F.regexp_instr(F.concat(k, F.lit("/")), F.lit("/")).alias("host"), k.alias("key"),
            block(k).alias("block")))
        rows = rows.withColumn("_hits", F.concat("_hits", hits))
        if parts > 1:
            rows = written(rows, "url_part")
    best = rows.withColumn("_best", F.array_max("_hits"))
    return best.select("page_id", "host", "path", F.col("_best.key").alias("rule"),
                       F.when(F.col("_best").isNull(), unlisted).when(F.col("_best.block"), "block").otherwise("allow").alias("verdict"))


#: The rules of the registered query: host, path, verdict.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

SQL = """
WITH r(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
u AS (SELECT page_id, row_number() OVER () AS i, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
f AS (SELECT u.i, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY u.i ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
      FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN f ON u.i = f.i AND f.k = 1
"""
