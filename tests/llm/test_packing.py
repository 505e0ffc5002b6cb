import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import packing
from millrace.llm.queries import tokenizer_path
from tests.llm.helpers import AWKWARD, docs

TEXTS = AWKWARD + [(300 + i, "hello <|endoftext|> world " * (i % 37) + "é" * i) for i in range(80)]


@pytest.mark.parametrize("window,most", [(2048, 200_000), (64, 0)])
def test_round_trip(spark, window, most, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "BROADCAST_ROWS", most)
    tk = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs(spark, TEXTS), tokenizer_path(), window).collect()
    ids = {(i, t): np.array(tk.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in TEXTS}
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for (i, _), a in ids.items():
        n = sum(1 for d, _ in TEXTS if d == i)
        pieces = Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[i])
        total = sum(p.length for p in by_doc[i])
        assert total == n * len(a)
        for start, length, crc, tokens in pieces:
            assert tokens == len(a)
            assert zlib.crc32(a[start : start + length].tobytes()) == crc
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at
    assert padding < window
    assert sorted(used) == list(range(len(used)))


def test_every_id_once_per_document(spark):
    texts = [(i, f"some words number {i} " * (i % 90)) for i in range(120)]
    got = packing.pack(docs(spark, texts), tokenizer_path(), 128).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for spans in by_doc.values():
        at = 0
        for start, length, _ in sorted(spans):
            assert start == at
            at += length
        assert at == spans[0][2]


def test_plan_never_takes_more_than_there_is():
    rng = np.random.default_rng(1)
    for _ in range(5):
        hist = rng.integers(0, 30, 256)
        hist[0] = 0
        p = packing.plan(hist, 256)
        assert (p.taken <= hist).all()
        assert ((p.hi - p.lo) > 0).all()
        filled = np.zeros(p.sequences, int)
        for length, lo, hi, first in zip(p.length, p.lo, p.hi, p.first, strict=True):
            filled[first : first + hi - lo] += length
        assert (filled == 256).all()


def test_empty_table(spark):
    assert packing.pack(docs(spark, []), tokenizer_path()).count() == 0


def test_added_tokens_take_the_librarys_ids():
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer_path())
    code = packing.coder(tokenizer_path(), 1)
    for text in ("<|endoftext|>", "a <|endoftext|> b", "<|ENDOFTEXT|>", "<|endoftext", ""):
        assert np.frombuffer(code.encoded(text), "<u4").tolist() == [*tk.encode(text, add_special_tokens=False).ids, 1]
    assert np.frombuffer(code.encoded("<|endoftext|>"), "<u4").tolist() == [50256, 1]


def test_greedy_fills_windows_exactly():
    rng = np.random.default_rng(3)
    for _ in range(5):
        left = rng.integers(0, 4, 128)
        used = np.zeros(128, int)
        for own, n in packing.greedy(left, 128):
            assert sum(own) == 128 and n > 0 and own[1:] == sorted(own[1:], reverse=True)
            np.add.at(used, own, n)
        assert (used <= left).all() and used.any()
    assert packing.greedy(np.array([5, 0, 0, 0]), 4) == []


def test_repeated_rows_are_ranked_apart(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", 16)
    texts = [(7, "the same text")] * 200 + [(None, None)] * 100
    got = packing.pack(docs(spark, texts), tokenizer_path(), 64).collect()
    places = [(r.sequence_id, r.offset + i) for r in got for i in range(r.length)]
    assert len(places) == len(set(places)) == sum(r.doc_tokens for r in got if r.start == 0)
    assert len(set(s for s, _ in places)) == -(-len(places) // 64)
