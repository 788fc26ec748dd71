"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalised (lower case, white space runs as one
space). An occurrence of an item of m characters with at most e edits shares at
least m - q + 1 - q * e of the item's q-grams with the document, all within
e diagonals of each other. So the shared q-grams are counted in overlapping
diagonal bands; only bands that reach the bound, inside a stretch as long as the
item, are verified, by a banded edit-distance alignment of the whole item.

e is ``rate`` times m, lowered where the bound would be too small to filter. Items of
more than ``WINDOW`` characters are sought as overlapping windows, so a long
item is also found in part. Items shorter than q characters say nothing and are
not sought. The items go to the tasks in blocks of at most ``BLOCK_CHARS``
characters: a block's index is bounded whatever the size of the benchmark, and
every document meets every block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q, RATE, WINDOW = 9, 0.09, 400
BLOCK_CHARS = 1 << 21
#: Characters of documents that are searched together, and of one long text at a time.
CHARS = 1 << 19
#: Shared q-grams laid out at a time.
HITS = 1 << 20
_BITS = 22
_INDEX: dict = {}


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def edits(m: int, q: int = Q, rate: float = RATE) -> int:
    """The edit budget: the q-gram bound m - q + 1 - q * e stays at a tenth of m (four at least)."""
    return max(0, min(int(rate * m), (m - q + 1 - max(4, m // 10)) // q))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    base, h, have = np.uint64(0x9E3779B97F4A7C15), codes.astype(np.uint64), 1
    powers = {1: base}
    out, done, span, part = None, 0, 1, h
    while span <= q:  # binary powers of the span, joined as q asks
        if q & span:
            n = len(codes) - q + 1
            piece = part[done:done + n]
            out = piece.copy() if out is None else out * powers[span] + piece
            done += span
        if 2 * span <= q:
            part = part[:-span] * powers[span] + part[span:]
            powers[2 * span] = np.uint64(int(powers[span]) ** 2 & 0xFFFFFFFFFFFFFFFF)
        span *= 2
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)  # the top bits depend on all


@dataclass
class Index:
    """The q-grams of a block of items, sorted, with the places where they stand."""
    ids: list            # item of each window
    texts: list[str]
    grams: np.ndarray    # sorted hashes
    item: np.ndarray     # window of each
    pos: np.ndarray
    low: np.ndarray      # bit table over the top bits of a hash
    q: int
    rate: float
    parts: tuple | None = None

    def halves(self) -> tuple:
        """This index as two, the first and the second half of its windows; made once."""
        if self.parts is None:
            mid, out = len(self.ids) // 2, []
            for ids, texts, own, shift in ((self.ids[:mid], self.texts[:mid], self.item < mid, 0), (self.ids[mid:], self.texts[mid:], self.item >= mid, mid)):
                out.append(Index(ids, texts, self.grams[own], self.item[own] - shift, self.pos[own], self.low, self.q, self.rate))
            self.parts = tuple(out)
        return self.parts


def build(items: list[tuple], q: int = Q, rate: float = RATE) -> Index:
    """items: (item_id, normalised window)."""
    g, it, ps = [], [], []
    for k, (_, t) in enumerate(items):
        h = _grams(_codes(t), q)
        g.append(h)
        it.append(np.full(len(h), k))
        ps.append(np.arange(len(h)))
    grams = np.concatenate(g) if g else np.zeros(0, np.uint64)
    order = np.argsort(grams, kind="stable")
    low = np.zeros(1 << _BITS, bool)
    low[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return Index([i for i, _ in items], [t for _, t in items], grams[order],
                 np.concatenate(it)[order] if it else np.zeros(0, np.int64),
                 np.concatenate(ps)[order] if ps else np.zeros(0, np.int64), low, q, rate)


def banded(item: np.ndarray, region: np.ndarray, width: int, limit: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence of the whole item in the region, if within ``limit``.

    The path stays on the region's first ``width`` diagonals; it may start on
    any of them and end anywhere. The item's characters may not outrun the
    region's, so a caller puts as much before a region as may be missing there.
    """
    m, n = len(item), len(region)
    inf = 1 << 20
    steps = np.arange(width)
    # column k of row i stands for i + k region characters
    cost = np.where(steps <= n, 0, inf).astype(np.int64)
    start = steps.copy()
    for i in range(1, m + 1):
        at = i + steps
        inside = at <= n
        ch = region[np.minimum(at, n) - 1] if n else np.zeros(width, np.uint32)
        diag = cost + (ch != item[i - 1])
        up = np.append(cost[1:] + 1, inf)                     # the item's character has no partner
        best, frm = np.minimum(diag, up), np.where(up < diag, np.append(start[1:], 0), start)
        best[~inside] = inf
        # region characters without a partner: the cheapest column to the left, the nearest of equals
        run = np.minimum.accumulate((best - steps) * (width + 1) + (width - steps))
        src = width - run % (width + 1)
        cost, start = best[src] + steps - src, frm[src]
        cost[~inside] = inf
        if cost.min() > limit:
            return None
    k = int(np.argmin(cost))
    return int(cost[k]), int(start[k]), m + k


def search(index: Index, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(window, start, end, edits) of verified occurrences in the codes of one or more joined texts."""
    q = index.q
    h = _grams(codes, q)
    near = np.flatnonzero(index.low[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
    lo = np.searchsorted(index.grams, h[near], "left")
    n = np.searchsorted(index.grams, h[near], "right") - lo
    near, lo, n = near[n > 0], lo[n > 0], n[n > 0]
    total = int(n.sum())
    if not total:
        return []
    if total > HITS:
        if len(index.ids) > 1:
            (a, b), mid = index.halves(), len(index.ids) // 2
            return search(a, codes) + [(mid + w, *rest) for w, *rest in search(b, codes)]
        size = 4 * len(index.texts[0])  # longer than any occurrence
        if len(codes) > 4 * size:  # stretches that overlap by that much hold each of them whole
            return [(w, a + at, z + at, e) for at in range(0, len(codes), 2 * size) for w, a, z, e in search(index, codes[at:at + 3 * size])]
    k = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
    win, pos = index.item[k], index.pos[k]
    sizes = np.array([len(t) for t in index.texts])
    budget = np.array([edits(s, q, index.rate) for s in sizes])
    bound = sizes - q + 1 - q * budget
    # the diagonals of an occurrence lie within e of each other, so bands of 2 * (e + 1)
    # diagonals, one beginning every e + 1, hold each occurrence whole in one of them
    step, off = budget[win] + 1, int(sizes.max())
    diag = np.repeat(near, n) - pos + off
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for shift in (0, 1):
        band = (diag + shift * step) // (2 * step)
        key = win * (len(codes) + 2 * off + 2) + band
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        lows, highs = np.concatenate([[0], cuts]), np.concatenate([cuts, [total]])
        w = win[order[lows]]
        for u in np.flatnonzero(highs - lows >= bound[w]):
            rows = order[lows[u]:highs[u]]
            i = int(w[u])
            if len(np.unique(pos[rows])) < bound[i]:  # a gram of the item counts once
                continue
            e, m = int(budget[i]), int(sizes[i])
            base = int(band[rows[0]]) * 2 * (e + 1) - shift * (e + 1) - off
            if any(out.get((i, s), (1,))[0] == 0 for s in range(base, base + 2 * e + 2)):
                continue
            item = _codes(index.texts[i])
            d = int(np.bincount(diag[rows] - diag[rows].min()).argmax()) + int(diag[rows].min()) - off
            if d >= 0 and np.array_equal(codes[d:d + m], item):
                out[i, d] = (0, d + m)
                continue
            region = codes[max(0, base):max(0, base + 2 * (e + 1) + m + e)]
            before = np.zeros(max(0, -base), np.uint32)  # an item cut off at the text's start: nothing there matches
            got = banded(item, np.concatenate([before, region]), 2 * (e + 1), e)
            if got:
                start = max(0, base + got[1])
                out[i, start] = min(out.get((i, start), (m, 0)), (got[0], base + got[2]))
    return [(i, s, z, e) for (i, s), (e, z) in out.items()]


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, edits, start_char, end_char): each document and item with an occurrence, the best one.

    Places are in the normalised text. Defined cases: null and empty texts, and
    items that are null or empty, match nothing; an item of fewer than ``q``
    characters matches where it stands unchanged, also inside a word; rows
    that repeat a document or an item fall together; rows with a null doc_id
    are searched and come back with a null; other columns are not read. Whole
    texts are searched, long ones in overlapping stretches.
    """
    out = None
    for block in _blocks(benchmark, q, window):
        key = hash(tuple(block))
        got = docs.select(F.col("doc_id").cast("string"), "text").where(F.col("text").isNotNull()).mapInPandas(
            _finder(block, key, q, rate), "doc_id string, item_id string, edits int, start_char long, end_char long")
        out = got if out is None else out.unionByName(got)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "doc_id string, item_id string, edits int, start_char long, end_char long")
    best = F.min(F.struct("edits", "start_char", "end_char")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select(
        F.col("doc_id").cast("long"), F.col("item_id").cast("long"), "b.edits", "b.start_char", "b.end_char")


def _blocks(benchmark: DataFrame, q: int, window: int):
    """The items' windows, a bounded number of characters at a time; the driver holds one block."""
    block, held = [], 0
    items = benchmark.select(F.col("item_id").cast("string"), "text").where(F.col("text").isNotNull()).distinct()
    for r in items.toLocalIterator():
        t = normalised(r.text)
        last = max(0, len(t) - window)
        for a in sorted({*range(0, last, window // 2), last} if t else ()):
            block.append((r.item_id, t[a:a + window]))
            held += min(len(t), window)
        if held >= BLOCK_CHARS:
            yield sorted(block, key=str)
            block, held = [], 0
    if block:
        yield sorted(block, key=str)


def _short(items: list[tuple]):
    """An automaton over items that are too short for a q-gram; None without any."""
    import ahocorasick
    found = ahocorasick.Automaton()
    for i, t in items:
        if t not in found:
            found.add_word(t, (len(t), []))
        found.get(t)[1].append(i)
    found.make_automaton()
    return found if len(found) else None


def _finder(block: list[tuple], key: int, q: int, rate: float):
    def run(batches):
        held_index = _INDEX.get(key)
        if held_index is None:
            _INDEX.clear()  # one block at a time
            held_index = _INDEX[key] = build([x for x in block if len(x[1]) >= q], q, rate), _short([x for x in block if len(x[1]) < q])
        index, short = held_index
        size = max((len(t) for t in index.texts), default=q)
        for b in batches:
            out = []
            ids, texts, held = [], [], 0

            def flush():
                # normalised texts and items have no line ends: nothing matches across two texts
                joined = _codes("\n".join(texts))
                starts = np.cumsum([0] + [len(t) + 1 for t in texts])
                for w, a, z, e in search(index, joined) if index.ids else ():
                    d = int(np.searchsorted(starts, a, "right")) - 1
                    out.append((ids[d][0], index.ids[w], e, ids[d][1] + a - int(starts[d]), ids[d][1] + z - int(starts[d])))

            for doc, text in zip(b.doc_id, b.text):
                t = normalised(text)
                if short is not None:
                    first = {}
                    for z, (m, own) in short.iter(t):
                        for i in own:
                            first.setdefault(i, (z + 1 - m, z + 1))
                    out += [(doc, i, 0, a, z) for i, (a, z) in first.items()]
                for lo in range(0, max(len(t), 1), CHARS):
                    part = t[max(0, lo - 2 * size):lo + CHARS]
                    ids.append((doc, max(0, lo - 2 * size)))
                    texts.append(part)
                    held += len(part)
                    if held >= CHARS:
                        flush()
                        ids, texts, held = [], [], 0
            if texts:
                flush()
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "edits", "start_char", "end_char"])
    return run
