"""Quotation linking: whom a message answers, from the passages it quotes.

Lines that start with ``>`` are quotations; their nesting depth is the number of
marks. Each maximal run of one depth is a passage. Passages, their paragraphs
and their lines are normalised and hashed, and joined by (conversation, hash)
to the same units of what messages say themselves (depth 0). A whole quoted
passage counts at any length; only its paragraphs and lines of fewer than
``LEAST`` characters do not count by themselves. A message answers
the earlier message whose own words it quotes at the least depth, by the
largest number of characters. Without such a link it answers the message before
it. Depth and root of each message follow from pointer doubling, and so does its
place in the reply order: a message, then each reply to it in the order of
turns, with all that follows from it. ``ordered`` gives the conversations so.

What messages say is hashed only in conversations with a quotation. No
conversation is gathered anywhere: joins are by hash or (conversation, turn),
salted where many messages answer one, and neighbours in the order of turns are
found in range slices.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import with_group, written

_MARK = re.compile(r"^(?:[ \t]?>)+[ \t]?")
_ATTRIBUTION = re.compile(r"^.{0,200}\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.I)
_NOISE = re.compile(r"[\W_]+")
#: Parts of a quoted passage of fewer characters are too common to identify an original.
LEAST = 12
#: Turns of a block in which the message before is looked up.
BLOCK = 4096


def normalised(text: str) -> str:
    """Only letters and digits, lower-cased, single spaces: survives new line breaks and marks."""
    return _NOISE.sub(" ", text.lower()).strip()


def parse(text: str) -> list[tuple[int, str]]:
    """(depth, passage) runs of a message in order; depth 0 is its own words."""
    runs: list[tuple[int, list[str]]] = []
    lines = text.splitlines()
    for n, line in enumerate(lines):
        mark = _MARK.match(line)
        depth = mark[0].count(">") if mark else 0
        after = next((x for x in lines[n + 1:n + 4] if x.strip()), "")
        body = line[mark.end():] if mark else line
        if _ATTRIBUTION.match(body) and (m := _MARK.match(after)) and m[0].count(">") > depth:
            continue  # "... wrote:" above the quotation it announces
        if runs and runs[-1][0] == depth:
            runs[-1][1].append(body)
        elif body.strip() or depth:
            runs.append((depth, [body]))
    return [(d, "\n".join(x).strip("\n")) for d, x in runs if any(y.strip() for y in x)]


def own_text(runs: list[tuple[int, str]]) -> str:
    return "\n".join(p for d, p in runs if d == 0).strip()


def units(passage: str, least: int = LEAST) -> set[str]:
    """The passage at any length, and its paragraphs and lines from ``least`` characters on, normalised.

    A passage without letters or digits ("👍", "?!") stands for itself, lower-cased, with single spaces.
    """
    parts = {*re.split(r"\n\s*\n", passage), *passage.split("\n")}
    whole = normalised(passage) or " ".join(passage.lower().split())
    return {u for u in map(normalised, parts) if len(u) >= max(1, least)} | ({whole} if whole else set())


def said_units(runs: list[tuple[int, str]]) -> set[str]:
    """What a message says itself: units of its whole own text and of each own passage, at any length."""
    return {*units(own_text(runs), 1), *(u for d, p in runs if d == 0 for u in units(p, 1))}


def quoted_units(runs: list[tuple[int, str]]) -> dict[str, int]:
    """The units that a message quotes, each with its least depth."""
    out: dict[str, int] = {}
    for d, p in runs:
        if d:
            for u in units(p):
                out[u] = min(d, out.get(u, d))
    return out


def _parsed(batches):
    for b in batches:
        out = []
        for conv, turn, role, text in zip(b.conv_id, b.turn, b.role, b.text):
            runs = parse(text or "")
            out.append((conv, turn, role, own_text(runs), sum(1 for d, _ in runs if d), max((d for d, _ in runs), default=0),
                        [{"u": u, "depth": d} for u, d in sorted(quoted_units(runs).items())]))
        yield pd.DataFrame(out, columns=["conv_id", "turn", "role", "text", "n_quotes", "max_depth", "quoted"])


def _said(batches):
    for b in batches:
        yield pd.DataFrame({"conv_id": b.conv_id, "turn": b.turn, "said": [sorted(said_units(parse(t or ""))) for t in b.text]})


def _before(keys: DataFrame, by: list[str]) -> DataFrame:
    """(by, turn, prev): the next smaller turn of the same ``by`` (no nulls; distinct rows), null for the first.

    Rows are written in range slices of (by, turn). Inside a slice the row
    before is a window's; of each slice only the last row meets the next slice.
    """
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = written(keys.select(*by, "turn").repartitionByRange(n, *by, "turn").withColumn("_p", F.spark_partition_id()), "slices")
    inner = slices.withColumn("prev", F.lag("turn").over(Window.partitionBy("_p", *by).orderBy("turn")))
    ends = slices.groupBy("_p").agg(F.max(F.struct(*by, "turn")).alias("end"))  # one row for each slice
    ends = ends.withColumn("end", F.lag("end").over(Window.orderBy("_p")))
    same = F.lit(True)
    for c in by:
        same = same & (F.col(c) == F.col(f"end.{c}"))
    return inner.join(F.broadcast(ends), "_p").select(*by, "turn", F.coalesce("prev", F.when(same, F.col("end.turn"))).alias("prev"))


def _after(keys: DataFrame, by: list[str]) -> DataFrame:
    """(by, turn, next): the next larger turn of the same ``by``, null for the last."""
    back = _before(keys.withColumn("turn", -F.col("turn")), by)
    return back.select(*by, (-F.col("turn")).alias("turn"), (-F.col("prev")).alias("next"))


def _places(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth, position) of messages (conv_id, turn, reply_to), each once.

    Pointer doubling twice: after k rounds a pointer has made 2^k steps, and only
    those that have not arrived go on. First up to the root, with the nearest
    message on the way that has a later sibling; then along the reply order,
    whose next message is the first reply or else that sibling.
    """
    replies = parents.where("reply_to IS NOT NULL")
    first = replies.groupBy("conv_id", F.col("reply_to").alias("turn")).agg(F.min("turn").alias("child"))
    sibling = _after(replies, ["conv_id", "reply_to"]).select("conv_id", "turn", F.col("next").alias("later"))
    root = F.col("reply_to").isNull()
    at = written(parents.join(sibling, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.coalesce("reply_to", "turn").alias("up"), (~root).cast("long").alias("depth"), "later", root.alias("done")), "up")
    while not at.where("NOT done").isEmpty():
        there = at.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"),
                          F.col("later").alias("later2"), F.col("done").alias("there"))
        # very many messages may answer one: they meet it by salt
        met = with_group(at.where("NOT done"), ["conv_id", "up"], "turn", {"_n": F.count(F.lit(1))}, {"_n": F.sum("_n")},
                         keep=lambda g, there=there: g.join(there, ["conv_id", "up"]))
        stepped = met.select("conv_id", "turn", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                             F.coalesce("later", "later2").alias("later"), F.col("there").alias("done"))
        at = written(at.where("done").unionByName(stepped), "up")
    roots = at.select("conv_id", "turn", F.col("up").alias("root_turn"), "depth")

    succ = F.coalesce("child", "later")
    run = written(at.join(first, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", succ.alias("to"), succ.isNotNull().cast("long").alias("left"), succ.isNull().alias("done")), "order")
    while not run.where("NOT done").isEmpty():
        there = run.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("to2"), F.col("left").alias("more"), F.col("done").alias("there"))
        stepped = run.where("NOT done").join(there, ["conv_id", "to"]).select(  # each message follows one at most
            "conv_id", "turn", F.col("to2").alias("to"), (F.col("left") + F.col("more")).alias("left"), F.col("there").alias("done"))
        run = written(run.where("done").unionByName(stepped), "order")
    counted = with_group(run.select("conv_id", "turn", "left"), ["conv_id"], "turn", {"_n": F.count(F.lit(1))}, {"_n": F.sum("_n")})
    return roots.join(counted.select("conv_id", "turn", (F.col("_n") - 1 - F.col("left")).alias("position")), ["conv_id", "turn"])


def ordered(linked: DataFrame) -> DataFrame:
    """The messages of ``link_quotes`` as conversations in reply order, without quotations.

    Sorted by (conv_id, position) in range partitions; messages without a place
    come last.
    """
    return linked.orderBy(F.asc_nulls_last("conv_id"), F.asc_nulls_last("position"))


def _last_said(said: DataFrame, quoted: DataFrame) -> DataFrame:
    """Quotations with orig: the last turn before the reply that says the passage.

    One sorted pass over each block of turns; blocks hand on only their last turn,
    so a passage that a huge conversation repeats is not sorted in one task.
    """
    null = F.lit(None).cast("int")
    marks = said.select("conv_id", "h", F.col("turn").alias("t"), F.lit(1).alias("is_said"), null.alias("qd"), null.alias("chars")) \
        .unionByName(quoted.select("conv_id", "h", F.col("reply").alias("t"), F.lit(0).alias("is_said"), "qd", "chars")) \
        .withColumn("_b", F.floor(F.col("t") / BLOCK))
    said_at = F.when(F.col("is_said") == 1, F.col("t"))
    inside = Window.partitionBy("conv_id", "h", "_b").orderBy("t", "is_said").rowsBetween(Window.unboundedPreceding, -1)
    inner = marks.withColumn("orig", F.last(said_at, ignorenulls=True).over(inside)).where("is_said = 0")
    blocks = marks.groupBy("conv_id", "h", "_b").agg(F.max(said_at).alias("end"))
    earlier = Window.partitionBy("conv_id", "h").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "h", "_b", F.max("end").over(earlier).alias("end"))
    return inner.join(blocks, ["conv_id", "h", "_b"]).withColumn("orig", F.coalesce("orig", "end")).where("orig < t")


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message (conv_id, turn): role, text without quotations, n_quotes, quote_depth,
    reply_to (a turn, null for a first message), linked (by a quotation), quoted_chars, root_turn, depth,
    and position (from 0 in the conversation's reply order, see ``ordered``).

    Defined cases: a null text is empty; rows with a null conv_id or turn come
    back parsed, unlinked, with a null root and position; rows that repeat (conv_id, turn)
    each come back with the same position, their words and quotations count together; a short passage
    may be a whole message or one line or paragraph of it; of originals
    quoted at the same depth and length the latest is answered; a message links
    only to earlier turns, so there are no cycles; other columns are not read.
    """
    m = messages.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.col("role").cast("string"), "text")
    kind = ("conv_id string, turn string, role string, text string, n_quotes int, max_depth int, "
            "quoted array<struct<u: string, depth: int>>")
    long = {c: F.col(c).cast("long") for c in ("conv_id", "turn")}
    # hashes replace the passages before anything is stored or shuffled
    q = F.transform("quoted", lambda x: F.struct(F.xxhash64(x["u"]).alias("h"), F.length(x["u"]).alias("chars"), x["depth"].alias("depth")))
    parsed = written(m.mapInPandas(_parsed, kind).withColumns({**long, "quoted": q}), "messages")
    known = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    keys = known.select("conv_id", "turn").distinct()

    # only conversations with a quotation have their messages hashed; written, so that the planner knows how many they are
    quoting = written(known.where(F.size("quoted") > 0).select(F.col("conv_id").cast("string")).distinct(), "quoting")
    own = m.join(quoting, "conv_id", "left_semi").select("conv_id", "turn", "text").where("turn IS NOT NULL")
    saying = written(own.mapInPandas(_said, "conv_id string, turn string, said array<string>").withColumns(
        {**long, "said": F.transform("said", lambda u: F.xxhash64(u))}), "said")

    # a quotation meets only passages that are quoted somewhere in the conversation, once for each turn
    quoted = known.select("conv_id", F.col("turn").alias("reply"), F.explode("quoted").alias("q")) \
        .groupBy("conv_id", "reply", F.col("q.h").alias("h")).agg(F.min("q.depth").alias("qd"), F.max("q.chars").alias("chars"))
    wanted = quoted.select("conv_id", "h").distinct()
    said = saying.select("conv_id", "turn", F.explode("said").alias("h")).distinct().join(wanted, ["conv_id", "h"])
    hits = _last_said(said, quoted)
    votes = hits.groupBy("conv_id", F.col("t").alias("turn"), "orig").agg(F.min("qd").alias("qd"), F.max("chars").alias("chars"))
    link = votes.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("qd"), "chars", "orig")).alias("b")) \
        .select("conv_id", "turn", F.col("b.orig").alias("orig"), F.col("b.chars").alias("chars"))
    parents = _before(keys, ["conv_id"]).join(link, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.coalesce("orig", "prev").alias("reply_to"), F.col("orig").isNotNull().alias("linked"),
        F.coalesce("chars", F.lit(0)).alias("quoted_chars"))
    parents = written(parents, "parents")

    links = parents.join(_places(parents.select("conv_id", "turn", "reply_to")), ["conv_id", "turn"])
    return parsed.join(links, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text", "n_quotes", F.col("max_depth").alias("quote_depth"), "reply_to",
        F.coalesce("linked", F.lit(False)).alias("linked"), F.coalesce("quoted_chars", F.lit(0)).alias("quoted_chars"),
        "root_turn", "depth", "position")
