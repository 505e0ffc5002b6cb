import numpy as np

from millrace.llm import pq

SCHEMA = "vec_id long, embedding array<float>, label int, mult string"


def make(seed=1, n=400, dim=64):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    near = x[:60] + rng.normal(size=(60, dim)) * rng.uniform(0.05, 0.6, (60, 1))
    return np.concatenate([x, near, x[:20], 3 * x[20:30]]).astype(np.float32)


def brute(ids, x, at=0.9):
    y = x.astype(float)
    y = y / np.linalg.norm(y, axis=1, keepdims=True)
    link = y @ y.T >= at
    np.fill_diagonal(link, False)
    comp = ids.copy()
    for _ in range(len(ids)):
        new = np.array([min(comp[i], comp[link[i]].min(initial=comp[i])) for i in range(len(ids))])
        if (new == comp).all():
            break
        comp = new
    return link.sum(1), comp


def test_links_and_components(spark):
    x = make()
    ids = np.arange(len(x)) * 3 + 5
    odd = [(1, None), (2, [0.0] * 64), (3, [1.0] * 63 + [None]), (4, [float("nan")] * 64), (None, x[0].tolist()), (10**6, [1.0, 2.0]), (10**6 + 1, [float("inf")] * 64)]
    rows = [(int(i), v.tolist(), 0, "m") for i, v in zip(ids, x, strict=True)] + [(i, v, 0, "m") for i, v in odd]
    got = pq.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), per_list=40, probes=6, block=100).collect()
    assert len(got) == len(rows)
    n, comp = brute(ids, x)
    found = {r.vec_id: r for r in got}
    total = sum(found[int(i)].n_links for i in ids)
    assert total >= 0.9 * n.sum()
    assert all(found[int(i)].n_links <= k for i, k in zip(ids, n, strict=True))
    assert np.mean([found[int(i)].component_id == c for i, c in zip(ids, comp, strict=True)]) > 0.97
    for i, _ in odd:
        assert found[i].n_links == 0 and found[i].component_id == i


def test_repeated_and_empty(spark):
    rows = [(i, [1.0, 0.0, 0.5], 0, "m") for i in (4, 4, 9)]
    got = pq.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.n_links for r in got] == [2, 2, 2] and {r.component_id for r in got} == {4}
    assert pq.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_codes_bound_the_distance():
    x = make(2)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(float)
    ix = pq.fit(x, 8, subspaces=16, codes=16)
    lists, codes, left = ix.coded(x, 3)
    approx = x @ ix.decoded(lists[:, 0], codes).T
    assert (np.abs(x @ x.T - approx) <= left[None, :] + 1e-9).all()


def test_no_link_is_lost_in_a_large_group(spark):
    """A third of the rows in one near-copy group, over far more lists than any fixed number of probes."""
    rng = np.random.default_rng(4)
    group = rng.normal(size=64) + rng.normal(size=(700, 64)) * 0.3
    x = np.concatenate([group, rng.normal(size=(1400, 64))]).astype(np.float32)
    ids = rng.permutation(len(x))
    rows = [(int(i), v.tolist(), 0, "m") for i, v in zip(ids, x, strict=True)]
    got = {r.vec_id: r for r in pq.near_vectors(spark.createDataFrame(rows, SCHEMA), per_list=20, block=150).collect()}
    n, comp = brute(ids, x)
    assert n.sum() > 300_000
    assert [got[int(i)].n_links for i in ids] == n.tolist() and [got[int(i)].component_id for i in ids] == comp.tolist()
