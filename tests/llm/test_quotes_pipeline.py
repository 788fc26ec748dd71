import random

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm.queries import QUERIES, tokenizer_file
from tessera.llm.quotes import link_quotes, ordered, parse, quoted_units, said_units

from .test_dedup_simhash import brute_fingerprint, brute_groups
from .test_lines_leaks import whole

A, B, C = "The first question is about the gardens of Lyon.", "Nobody waters the gardens after midnight.", "So the gardens dry out entirely."


def test_nested_passages():
    text = f"Intro\nOn Monday, Ann wrote:\n> {B}\n>> {A[:20]}\n> > {A[20:]}\n>\n> more\n\nReply"
    assert parse(text) == [(0, "Intro"), (1, B), (2, f"{A[:20]}\n{A[20:]}"), (1, "\nmore".strip("\n")), (0, "Reply")]


def links(spark, rows):
    got = link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    return {(r.conv_id, r.turn): r for r in got}


def test_links_follow_quotations(spark):
    rows = [(1, 0, "user", A), (1, 1, "assistant", B), (1, 2, "user", "Unrelated words that say nothing of it."),
            (1, 3, "assistant", f"> {B}\n>> {A}\nI disagree with this."),
            (1, 4, "user", f"> THE FIRST question is\n> about the gardens of Lyon\nWell?"),
            (1, 6, "user", f"> I disagree with this.\nFine."), (2, 5, "user", f"> {A}\nother conversation"),
            (2, 9, None, None), (None, 1, "user", f"> {A}"), (3, None, "user", "x"), (1, 7, "user", f"> {B}\nagain"),
            (1, 8, "user", B), (1, 9, "user", f"> {B}\nlast one counts")]
    got = links(spark, rows)
    assert {k[1]: (r.reply_to, r.linked, r.root_turn, r.depth) for k, r in got.items() if k[0] == 1} == {
        0: (None, False, 0, 0), 1: (0, False, 0, 1), 2: (1, False, 0, 2), 3: (1, True, 0, 2), 4: (0, True, 0, 1),
        6: (3, True, 0, 3), 7: (1, True, 0, 2), 8: (7, False, 0, 3), 9: (8, True, 0, 4)}
    assert got[1, 3].text == "I disagree with this." and got[1, 3].quote_depth == 2 and got[1, 3].n_quotes == 2
    assert got[2, 5].reply_to is None and got[2, 9].reply_to == 5 and got[None, 1].root_turn is None
    assert got[2, 9].text == "" and len(got) == len(rows)


def brute_links(rows):
    """Links, depths and the reply order by loops over all earlier messages."""
    out = {}
    for conv in {c for c, *_ in rows}:
        runs = {t: parse(x or "") for c, t, _, x in rows if c == conv}
        up, turns = {}, sorted(runs)
        for t in turns:
            votes = {}
            for u, d in quoted_units(runs[t]).items():
                origs = [e for e in turns if e < t and u in said_units(runs[e])]
                if origs:
                    qd, n = votes.get(max(origs), (d, 0))
                    votes[max(origs)] = min(d, qd), max(len(u), n)
            best = max(((-d, n, e) for e, (d, n) in votes.items()), default=None)
            before = [e for e in turns if e < t]
            up[t] = (best[2] if best else max(before, default=None), best is not None)
        order = []

        def walk(t, depth):
            order.append((t, depth))
            for x in turns:
                if up[x][0] == t:
                    walk(x, depth + 1)
        walk(turns[0], 0)
        out |= {(conv, t): (*up[t], depth, k) for k, (t, depth) in enumerate(order)}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_threads_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    say = lambda: " ".join(rnd.choice("red green blue lake stone river wind".split()) for _ in range(rnd.randint(1, 5)))
    rows = []
    for conv in range(12):
        said, turn = [], 0
        for _ in range(rnd.randint(1, 25)):
            turn += rnd.choice([1, 2, 10**9])  # dense turns and time stamps
            text = say() if rnd.random() < 0.8 else f"{say()}\n{say()}"
            if said and conv % 3 and rnd.random() < 0.6:
                q = rnd.choice(said).split("\n")
                text = "\n".join([f"{'>' * rnd.choice([1, 1, 2])} {x}" for x in q] + [text])
            said.append("\n".join(x for x in text.split("\n") if not x.startswith(">")))
            rows.append((conv, turn, "user", text))
    want = brute_links(rows)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, reply_to string")
    got = link_quotes(df)
    assert {(r.conv_id, r.turn): (r.reply_to, r.linked, r.depth, r.position) for r in got.collect()} == want
    seq = [(r.conv_id, r.position) for r in ordered(got).collect()]
    assert seq == sorted(seq) and len(seq) == len(rows)


def test_many_replies_to_one_message_and_a_very_long_text(spark):
    long = " ".join(f"w{k}" for k in range(200_000))
    rows = [(1, 0, "user", A)] + [(1, t, "user", f"> {A}\nreply {t}") for t in range(1, 400)] + [(2, 0, "user", long), (2, 1, "user", f"> {long}\nwell")]
    got = links(spark, rows)
    assert all((got[1, t].reply_to, got[1, t].depth, got[1, t].position) == (0, 1, t) for t in range(1, 400))
    assert got[2, 1].linked and got[2, 1].quoted_chars == len(long)


def test_short_messages_are_linked(spark):
    rows = [(1, 0, "user", "Yes, sure"), (1, 1, "assistant", A), (1, 2, "user", "> Yes, sure\nThen do it."),
            (2, 0, "user", "请问花园在哪里呢？"), (2, 1, "assistant", B), (2, 2, "user", "> 请问花园在哪里呢？\n里昂"),
            (3, 0, "user", f"No.\n{A}"), (3, 1, "assistant", B), (3, 2, "user", "> No.\nWhy not?"),
            (4, 0, "user", "\U0001f44d"), (4, 1, "assistant", B), (4, 2, "user", "> \U0001f44d\nGreat."),
            (5, 0, "user", f"ok\n{A}"), (5, 1, "assistant", C), (5, 2, "user", f"ok\n{B}"), (5, 3, "user", f"> ok\n> {A}\nWell")]
    got = links(spark, rows)
    assert {k: (r.reply_to, r.linked) for k, r in got.items() if k[1] == 2 and k[0] < 5} == {(c, 2): (0, True) for c in (1, 2, 3, 4)}
    assert got[5, 3].reply_to == 0 and got[1, 2].quoted_chars == 8 and got[4, 2].quoted_chars == 1


def test_a_long_conversation_and_repeats(spark, monkeypatch):
    import tessera.llm.quotes as Q
    monkeypatch.setattr(Q, "BLOCK", 8)
    rows = [(1, t, "user", f"{A}\nturn number {t} speaks its words") for t in range(0, 90, 3)]
    rows += [(1, 91, "user", f"> {A}\nquoting all"), (1, 92, "user", "> turn number 30 speaks its words\nthe middle"),
             (1, 92, "user", "the same turn twice")]
    got = links(spark, rows)
    assert got[1, 91].reply_to == 87 and got[1, 92].reply_to == 30 and got[1, 87].depth == 29
    assert link_quotes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_links_equal_brute_force_on_the_table(spark):
    """No message of the table quotes: each answers the one before it."""
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = sorted((r.conv_id, r.turn, r.text) for r in df.collect())
    got = {(r.conv_id, r.turn): r for r in link_quotes(df).collect()}
    last = {}
    for c, t, text in rows:
        assert (got[c, t].reply_to, got[c, t].text) == (last.get(c), text.strip()) and not got[c, t].linked
        last[c] = t


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), {}
    sf = "/root/testdata/sf0.001"
    for name, f in corpus_pipeline.STAGES:
        before = docs
        from tessera.llm.common import written
        docs = written(f(spark, docs, sf), name)
        out[name] = (before.collect(), docs.collect(), docs.columns)
    return out


def test_every_stage_equals_its_brute_force(spark, stages):
    """Each stage on its own input; language rejects nothing that has letters and is like the sample."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name in ("language", "line_dedup", "near_dedup", "decontaminate"):
        assert stages[name][2] == columns
    before, after, _ = stages["language"]
    assert len(after) >= 0.98 * len(before) and {r.doc_id for r in after} <= {r.doc_id for r in before}
    before, after, _ = stages["line_dedup"]
    assert {r.doc_id: r.text for r in after} == whole([(r.doc_id, r.text) for r in before])
    assert all(r.n_chars == len(r.text) for r in after)
    before, after, _ = stages["near_dedup"]
    comp = brute_groups([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {d for d, _, c in comp if d == c} and brute_fingerprint("") == 0
    before, after, _ = stages["decontaminate"]
    import tessera.llm.decontaminate as D
    items = [D.normalised(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before if any(i in D.normalised(r.text) for i in items)}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} >= leaks
    assert len(before) - len(after) <= len(leaks) + 2
    before, after, _ = stages["pack"]
    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    assert sum(r.length for r in after) == sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in before)
    fills = {}
    for r in after:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert max(fills.values()) <= 2048 and len(fills) <= np.ceil(sum(fills.values()) / 2048) * 1.1 + 1


def test_run_and_registry(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 50 and "sequence_id" in got.columns
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_with_nulls_repeats_and_clashing_names(spark, odd, empty, clash):
    """Rows without an id: contaminated ones go, clean ones stay; an empty table passes through every stage."""
    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("text IS NOT NULL").first().text
    rows = [(None, f"before {item} after", "en", "s", 1), (None, "clean words of nobody", None, None, None), (900, item, "en", "s", 1),
            (900, item, "en", "s", 1), (901, "clean as well", "en", "s", 1), (902, None, None, None, None)]
    docs = clash(odd.unionByName(spark.createDataFrame(rows, odd.schema)))
    left = corpus_pipeline.decontaminate(spark, docs, sf)
    kept = [(r.doc_id, r.text) for r in left.collect()]
    want = [(r.doc_id, r.text) for r in docs.collect() if not (r.text and item in r.text)]
    assert sorted(kept, key=str) == sorted(want, key=str) and left.columns == list(corpus_pipeline.COLUMNS)
    near = corpus_pipeline.near_dedup(spark, docs, sf).collect()
    assert sum(r.doc_id is None for r in near) == sum(r.doc_id is None for r in docs.collect())
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, now, sf).collect() == []
