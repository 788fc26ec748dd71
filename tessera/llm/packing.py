"""Best-fit packing of token pieces, improved by swap-based local search.

Pieces are dealt at random to groups of bounded size. Each group is packed
best-fit decreasing; then underfull bins exchange one piece for one, two for
one, or hand a piece over, whenever that raises the sum of squared fills: the
fuller bin of the two gains, the emptier one loses until nothing is left in it.
A group's search ends when no exchange raises the sum any more. The bins that
stay underfull are taken apart, their pieces dealt to fewer groups and packed
again, until one group holds all that is left or a turn has emptied less than
``LEAST_GAIN`` of them. Only lengths and ids move; no group or round sees token
ids or texts.
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.tokens import ByteIds, shared

LIMIT = 2048
#: Pieces a group has on average: bounds a task's memory and time, whatever the input.
GROUP = 20_000
#: Share of the underfull bins that dealing anew must empty for another turn.
LEAST_GAIN = 0.005


# ------------------------------------------------------------------ token pieces
def token_pieces(docs: DataFrame, path: str, ranks: str | None = None, limit: int = LIMIT, end_id: int = 0,
                 keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32 (and ids).

    A document is its ids and ``end_id``. One of more than ``limit`` ids is cut
    into pieces of ``limit``; what is over stands in the first piece.
    """
    def cut(batches):
        ids_of = shared(ByteIds, path, ranks)
        for b in batches:
            out = []
            for doc, text in zip(b.doc_id, b.text):
                ids = ids_of.ids(text) + end_id.to_bytes(4, "little")
                n, start, k = len(ids) // 4, 0, 0
                size = n % limit or limit
                while start < n:
                    part = ids[4 * start:4 * (start + size)]
                    out.append((doc, k, start, size, zlib.crc32(part)) + ((part,) if keep_ids else ()))
                    start, k, size = start + size, k + 1, limit
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    d = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    got = d.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)
    return got.withColumn("doc_id", F.col("doc_id").cast("long"))


# ------------------------------------------------------------------ one group
def best_fit(sizes: list[int], limit: int = LIMIT) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of positions in ``sizes``."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(limit + 1)]  # bins by room
    rooms = 0  # bit r: some bin has room r
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = rooms >> sizes[k]
        if fit:
            room = sizes[k] + (fit & -fit).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            b, room = len(bins), limit
            bins.append([])
        bins[b].append(k)
        room -= sizes[k]
        if room:
            if not free[room]:
                rooms |= 1 << room
            free[room].append(b)
    return bins


class _Underfull:
    """The underfull bins of a group, and which of them hold a piece of a given size."""

    def __init__(self, sizes, bins, limit):
        self.sizes, self.bins, self.limit = sizes, bins, limit
        self.fill = [sum(sizes[k] for k in b) for b in bins]
        self.open = {i for i, f in enumerate(self.fill) if 0 < f < limit}
        self.at: list[set] = [set() for _ in range(limit + 1)]
        self.present = 0
        self.pairs: dict[int, int] = {}  # bit s: the bin has two pieces of s together
        self.any_pair = 0                # of all bins, those now full too until the next pass
        for i in self.open:
            self.index(i)

    def index(self, i):
        seen = sums = 0
        for k in self.bins[i]:
            s = self.sizes[k]
            self.at[s].add(i)
            self.present |= 1 << s
            sums |= seen << s
            seen |= 1 << s
        self.pairs[i] = sums
        self.any_pair |= sums

    def unindex(self, i):
        self.pairs.pop(i, None)
        for k in self.bins[i]:
            s = self.sizes[k]
            self.at[s].discard(i)
            if not self.at[s]:
                self.present &= ~(1 << s)

    def exchange(self, t, give, d, take):
        """Bin t gets pieces ``take`` of bin d for its pieces ``give``."""
        self.unindex(t)
        self.unindex(d)
        for k in give:
            self.bins[t].remove(k)
        for k in take:
            self.bins[d].remove(k)
        self.bins[t] += take
        self.bins[d] += give
        gain = sum(self.sizes[k] for k in take) - sum(self.sizes[k] for k in give)
        self.fill[t] += gain
        self.fill[d] -= gain
        for i in (t, d):
            if 0 < self.fill[i] < self.limit:
                self.index(i)
            else:
                self.open.discard(i)

    def donor(self, size, t, gain):
        """The emptiest other bin with a piece of ``size``, if giving it up raises the squared fill."""
        d = min((i for i in self.at[size] if i != t), key=lambda i: (self.fill[i], i), default=None)
        return d if d is not None and self.fill[t] + gain > self.fill[d] else None

    def one(self, t) -> bool:
        """Move a piece into t, or exchange one for one, with the largest gain."""
        room, best = self.limit - self.fill[t], None
        for k in [None, *self.bins[t]]:
            low = self.sizes[k] if k is not None else 0
            mask = self.present & ((1 << (low + room + 1)) - 1)
            while mask:
                size = mask.bit_length() - 1
                if size <= low or best and size - low <= best[0]:
                    break
                d = self.donor(size, t, size - low)
                if d is not None:
                    best = (size - low, k, d, size)
                    break
                mask ^= 1 << size
        if best is None:
            return False
        _, k, d, size = best
        self.exchange(t, [] if k is None else [k], d, [next(j for j in self.bins[d] if self.sizes[j] == size)])
        return True

    def two(self, t, donors) -> bool:
        """Two pieces of a bin that is no fuller for one of t; ``donors`` has all bins by fill."""
        room, wanted = self.limit - self.fill[t], 0
        for k in self.bins[t]:
            low = self.sizes[k]
            wanted |= (1 << (low + room + 1)) - (1 << (low + 1))
        if not wanted & self.any_pair:
            return False
        for d in donors:
            if d == t or d not in self.pairs or self.fill[d] > self.fill[t] or not wanted & self.pairs[d]:
                continue
            have = sorted((self.sizes[k], k) for k in self.bins[d])
            for k in self.bins[t]:
                low = self.sizes[k]
                i, j, best = 0, len(have) - 1, None
                while i < j:
                    s = have[i][0] + have[j][0]
                    if s > low + room:
                        j -= 1
                    else:
                        if s > low and (best is None or s > best[0]):
                            best = (s, have[i][1], have[j][1])
                        i += 1
                if best:
                    self.exchange(t, [k], d, [best[1], best[2]])
                    return True
        return False


def improve(sizes: list[int], bins: list[list[int]], limit: int = LIMIT) -> list[list[int]]:
    """Local search on the underfull bins, until a pass over all of them changes nothing.

    Every step raises the sum of squared fills, which is bounded, so it ends.
    """
    u = _Underfull(sizes, bins, limit)
    changed = True
    while changed:
        changed, u.any_pair = False, 0
        for sums in u.pairs.values():
            u.any_pair |= sums
        donors = sorted(u.open, key=lambda i: (u.fill[i], i))
        for t in reversed(donors):
            while t in u.open and (u.one(t) or u.two(t, donors)):
                changed = True
    return [b for b in u.bins if b]


def _pack(limit: int):
    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True]).reset_index(drop=True)
        sizes = b.length.tolist()
        bins = improve(sizes, best_fit(sizes, limit), limit)
        seq, offset, fill = [0] * len(b), [0] * len(b), [0] * len(b)
        for i, members in enumerate(bins):
            at = 0
            for k in sorted(members):
                seq[k], offset[k] = i, at
                at += sizes[k]
            for k in members:
                fill[k] = at
        return b.assign(bin=seq, offset=offset, fill=fill)
    return run


# ------------------------------------------------------------------ all groups
def pack(pieces: DataFrame, limit: int = LIMIT, group: int = GROUP, least_gain: float = LEAST_GAIN) -> DataFrame:
    """Add sequence_id and offset to pieces of 1 to ``limit`` tokens.

    ``pieces`` has doc_id, piece, start, length; further columns come along.
    Every piece is placed, gapless from 0 in its sequence. The ids of ``pieces``
    come from the rank file of the same vocabulary where ``token_pieces`` is
    given one; tests hold them equal to the library's. Equal pieces and
    repeated rows are packed one by one; an empty table gives an empty result.
    """
    rest = written(pieces, "pieces")
    full = rest.where(F.col("length") >= limit)
    # numbered by place in the written table: stable whenever it is read again
    done = full.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}) \
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    # doc_id travels as text: pandas would turn a column of longs with a null into doubles
    rest = rest.where(F.col("length") < limit).withColumn("doc_id", F.col("doc_id").cast("string"))
    names, schema = pieces.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    n, turn, before = rest.count(), 1, None
    while n:
        groups = -(-n // group)
        dealt = rest.withColumn("_g", F.pmod(F.xxhash64("doc_id", "piece", "start", F.lit(turn)), F.lit(groups)))
        got = written(dealt.groupBy("_g").applyInPandas(
            _pack(limit), f"{schema}, _g long, bin long, offset long, fill long"), "packed")
        bins = got.where("offset = 0").agg(F.count(F.lit(1)), F.count_if(F.col("fill") < limit)).first()
        # the last turn: one group held everything, or dealing anew has emptied too few bins
        last = groups == 1 or before is not None and bins[0] > (1 - least_gain) * before
        ready = got if last else got.where(F.col("fill") == limit)
        number = F.lit(turn << 56) + F.col("_g") * F.lit(1 << 24) + F.col("bin")
        done = done.unionByName(ready.withColumns({"doc_id": F.col("doc_id").cast("long"), "sequence_id": number})
                                .select(*names, "sequence_id", "offset"))
        if last:
            break
        before, rest, turn = bins[1], got.where(F.col("fill") < limit).select(names), turn + 1
        n = rest.count()
    return done


def pack_documents(docs: DataFrame, path: str, ranks: str | None = None, limit: int = LIMIT,
                   keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``limit`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (and ids). Defined cases: a null or empty text is its
    end id alone; null doc_ids and repeated rows are packed like any other;
    other columns are not read.
    """
    return pack(token_pieces(docs, path, ranks, limit, keep_ids=keep_ids), limit)
