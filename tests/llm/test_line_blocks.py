"""Every block of lines that an earlier document holds goes, by loops over all earlier documents."""

import random

import pytest

from tessera.llm.line_dedup import line_dedup, words

from .test_lines_leaks import made, whole


def cleaned(spark, rows, **more):
    return {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect()}


@pytest.mark.parametrize("copies", [60, 70, 5000])
def test_a_passage_of_short_lines_goes_at_any_number_of_copies(spark, copies):
    lines = [f"left{k} right{k}" for k in range(30)]
    rows = [(k, f"{x}\nalone {k}") for k, x in enumerate(lines)]  # each line occurs earlier elsewhere
    rows += [(100 + k, "\n".join([f"own {k}", *lines, f"end {k}"])) for k in range(copies)]
    got = cleaned(spark, rows)
    assert got[100] == rows[30][1] and all(got[k] == t for k, t in rows[:30])
    assert all(got[100 + k] == f"own {k}\nend {k}" for k in range(1, copies))


def blocks_made(seed):
    """Short lines, passages that documents hold twice and in other orders."""
    rnd = random.Random(seed)
    short = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 3))) for _ in range(12)]
    passages = [[rnd.choice(short) for _ in range(rnd.randint(2, 6))] for _ in range(6)]
    rows = []
    for d in range(40):
        ls = [f"own {d}"]
        for _ in range(rnd.randint(1, 4)):
            ls += rnd.choice(passages) if rnd.random() < 0.7 else [rnd.choice(short), f"own {d} {len(ls)}"]
        rows.append((d, "\n".join(ls)))
    return rows


def test_all_blocks_of_all_earlier_documents_go(spark):
    long = " ".join(f"w{k}" for k in range(50))
    twice = [(0, f"one two three four five six\n{long}"), (1, f"{long}\nmine\n{long}"), (2, f"{long}\n{long}"),
             (3, f"{long}\none two three four five six")]
    assert cleaned(spark, twice) == {0: twice[0][1], 1: "mine", 2: "", 3: ""} == whole(twice)
    for rows in (made(64), made(7), *map(blocks_made, range(4))):
        assert cleaned(spark, rows) == whole(rows)


def test_a_holder_of_many_later_ones_is_met_in_chunks(spark, monkeypatch):
    from tessera.llm import line_dedup as module
    monkeypatch.setattr(module, "CHUNK", 8)
    rows = [(d, "\n".join([f"own line {d}", "one two three four five", "six seven", "eight nine ten", f"end {d}"][:3 + d % 3])) for d in range(300)]
    for rare in (1, 16, 1000):
        assert cleaned(spark, rows, rare=rare) == whole(rows)


def test_words_of_scripts_without_spaces_and_of_other_white_space(spark):
    assert [words(x) for x in ("", " \t\r", "\u3000", "a  b ", "a\tb\xa0c\u3000d", "- x", "é ü", "。")] == [0, 0, 0, 2, 4, 2, 2, 1]
    lines = ["这是一个关于里昂花园的问题，没有人浇水。", "これは庭についての質問です。", "นี่คือคำถามเกี่ยวกับสวนในเมือง", "one\ttwo\tthree\tfour\tfive",
             "one\xa0two\xa0three\xa0four\xa0five"]
    for x in lines:
        assert words(x) >= 5 and cleaned(spark, [(1, f"first\n{x}"), (2, f"{x}\nsecond")]) == {1: f"first\n{x}", 2: "second"}
    for x in ("你好。", "one      two", "one two three four", "\t\t\t\t\t\tone"):  # fewer than five words
        assert cleaned(spark, [(1, x), (2, f"{x}\nsecond")])[2] == f"{x}\nsecond"
