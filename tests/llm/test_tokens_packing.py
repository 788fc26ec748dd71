import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm.packing import best_fit, improve, pack_documents
from tessera.llm.token_counts import long_counts, token_counts
from tessera.llm.tokens import ByteIds, WordCounter

WORD = str(public_tokenizers.path("word_bpe_49k.json"))
BYTE = str(public_tokenizers.path("byte_bpe_50k.json"))
RANKS = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
counter, ids_of, ids_lib = WordCounter(WORD), ByteIds(BYTE, RANKS), ByteIds(BYTE)

TEXT = st.text(st.one_of(st.sampled_from(list(" \n\t\r'st,.<|>AéßÀİ1²\x85\xa0 ́\x1c中Σ")), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_cached_tokens_equal_the_library(text):
    assert counter.count(text) == len(word.encode(text, add_special_tokens=False).ids)
    want = byte.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids_of.ids(text), "<u4").tolist() == want
    assert np.frombuffer(ids_lib.ids(text), "<u4").tolist() == want


def test_counts(odd, documents, clash, empty):
    for df, kw in ((clash(odd), {}), (documents, {}), (documents, {"chunk": 200, "overlap": 30}), (odd, {"chunk": 16, "overlap": 4})):
        rows = df.collect()
        want = sorted(((r.doc_id, len((r.text or "").encode()), len(word.encode(r.text or "", add_special_tokens=False).ids))
                       for r in rows), key=str)
        got = token_counts(df, WORD, 2048, **kw).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts(empty, WORD).collect() == []


def test_resynchronised_text_without_spaces(spark):
    text = "a" * 500 + "<|endoftext|>" + "é1" * 400 + " x " + "b" * 700
    df = spark.createDataFrame([("1", len(text.encode()), text)], "doc_id string, n_bytes long, text string")
    assert long_counts(df, WORD, 100, 10).first().n_tokens == len(word.encode(text, add_special_tokens=False).ids)


def test_search_never_worsens_and_empties_bins():
    rnd = random.Random(1)
    for n, lo, hi in ((3000, 1, 2047), (2000, 600, 1100), (500, 1, 60), (800, 300, 700)):
        sizes = [rnd.randint(lo, hi) for _ in range(n)]
        first = best_fit(sizes)
        k = len(first)
        bins = improve(sizes, first)
        assert sorted(i for b in bins for i in b) == list(range(n))
        assert all(sum(sizes[i] for i in b) <= 2048 for b in bins) and len(bins) <= k
        assert len(bins) >= -(-sum(sizes) // 2048)
    # two bins of three that one exchange of one piece for one makes two
    assert len(improve([6, 3, 5, 4, 2], [[0, 1], [2, 4], [3]], 10)) == 2


@pytest.mark.parametrize("group", [20_000, 40])
def test_packing_is_whole(documents, odd, clash, empty, monkeypatch, group):
    import tessera.llm.packing as P
    for df in (documents, clash(odd)):
        pieces = P.token_pieces(df, BYTE, RANKS)
        got = P.pack(pieces, group=group).collect() if group != 20_000 else pack_documents(df, BYTE, RANKS).collect()
        want = []
        for r in df.collect():
            ids = byte.encode(r.text or "", add_special_tokens=False).ids + [0]
            cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
            want += [(r.doc_id, i, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes()))
                     for i, (a, z) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
        seqs = {}
        for r in got:
            seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for s in seqs.values():
            at = 0
            for offset, length in sorted(s):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(seqs) <= len(best_fit([r.length for r in got])) + (2 if group == 40 else 0)
    assert pack_documents(empty, BYTE, RANKS).collect() == []
