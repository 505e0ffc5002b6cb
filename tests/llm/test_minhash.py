import random
import re

import pytest

from millrace.llm import minhash
from millrace.llm.graph import connected_components
from tests.llm.helpers import AWKWARD, docs


def shingle_set(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den):
    s = [(i, shingle_set(t, k)) for i, t in rows if i is not None]
    up = {i: i for i, _ in s}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, (i, a) in enumerate(s):
        for j, b in s[:x]:
            both = len(a & b)
            if a and b and den * both >= num * (len(a) + len(b) - both):
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return {i: root(i) for i in up}


def near_copies(seed=3, groups=6, size=9):
    rng = random.Random(seed)
    out, n = [], 1000
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(40, 160))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            out.append((n, " ".join(own)))
            n += 7
    return out


@pytest.mark.parametrize("k,num,block,table_rows,lot", [(3, 85, 1000, 2000, 500), (5, 80, 4, 3, 2)])
def test_components_match_brute_force(spark, k, num, block, table_rows, lot, monkeypatch):
    monkeypatch.setattr(minhash, "LOT", lot)
    rows = [r for r in AWKWARD if r[0] != 8] + near_copies() + [(5000, "the of and"), (5001, "One")]
    got = minhash.near_duplicates(docs(spark, rows), k=k, num=num, den=100, block=block, table_rows=table_rows).collect()
    want = brute(rows, k, num, 100)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
            continue
        assert r.component_id == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)
    sizes = {i: len(shingle_set(t, k)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got)


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    rows = near_copies()
    df = docs(spark, rows)
    got = minhash.drop_near_duplicates(df, k=3, num=85)
    assert got.columns == df.columns
    want = brute(rows, 3, 85, 100)
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(want.values()))


def test_empty_table(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_tables_are_pairs_of_half_keys():
    import numpy as np

    sig = minhash.signatures([minhash.shingles("a b c d e f g", 3)], 36)[0]
    keys = minhash.table_keys(sig, 6, 3)
    assert len(set(keys.tolist())) == 36
    other = sig.copy()
    other[:3] += 1  # the first half-key of the first collection changes its six tables only
    assert (minhash.table_keys(other, 6, 3) == keys).sum() == 30
    assert np.array_equal(minhash.table_keys(sig, 6, 3), keys)


def test_connected_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_null_id_stays_alone_whatever_its_text(spark):
    rows = [(3, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f"), (None, "other")]
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs(spark, rows), k=3, num=85).collect()}
    assert got == {(3, 3, True), (9, 3, False), (None, None, True)}
    assert minhash.drop_near_duplicates(docs(spark, rows), k=3, num=85).count() == 3


def chained(n=60, length=50, seed=5):
    """Texts that each are like the ones beside them, and less and less like those further on."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for i in range(n):
        out.append((2000 + i, " ".join(words)))
        words[rng.randrange(length)] = f"y{rng.randrange(10**6)}"
    return out


def test_chains_of_copies_match_brute_force_in_cut_tables_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LOT", 3)
    rows = chained() + [(9000 + i, f"{t} and one more") for i, (_, t) in enumerate(chained(12))]
    rows += [(3000 + i, t) for i, (_, t) in enumerate(chained(30, 20, 6))] + [(4000 + 2 * i, t) for i, (_, t) in enumerate(chained(30, 44, 7)[::2])]
    want = brute(rows, 3, 85, 100)
    assert 1 < len(set(want.values())) < len(want)
    for block, table_rows in ((6, 5), (300, 2000)):
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(spark, rows), k=3, num=85, block=block, table_rows=table_rows).collect()}
        assert got == want
