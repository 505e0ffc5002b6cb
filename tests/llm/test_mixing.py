from collections import defaultdict
from dataclasses import replace

from hypothesis import given
from hypothesis import strategies as st

from millrace.llm import mixing
from tests.llm.helpers import AWKWARD, docs

MIX = mixing.Mixture(domains={"a": ("src0", "src1"), "b": ("src2",)}, domain_weights={"a": 0.5, "b": 0.4, "other": 0.1}, lang_weights={"en": 0.7, "": 0.3}, share=0.5)
TEXTS = AWKWARD + [(100 + i, "w " * (1 + i * 7 % 40)) for i in range(400)]


@given(st.lists(st.tuples(st.floats(0.1, 5), st.floats(0, 100)), min_size=1, max_size=8), st.floats(0, 300))
def test_spread(nodes, budget):
    weights, most = [w for w, _ in nodes], [m for _, m in nodes]
    out = mixing.spread(budget, weights, most)
    assert all(o <= m + 1e-6 for o, m in zip(out, most, strict=True))
    assert abs(sum(out) - min(budget, sum(most))) < 1e-6 * max(1, budget)
    # Those that are not full have the same share of their weight, and no one that is full has more.
    open_ = [o / w for o, w, m in zip(out, weights, most, strict=True) if o < m - 1e-6]
    if open_:
        assert max(open_) - min(open_) < 1e-6 * max(1, max(open_))
        assert all(o / w <= max(open_) + 1e-6 for o, w in zip(out, weights, strict=True))


def test_shortage_goes_to_siblings_first():
    leaves = {("a", "en", "x"): 10, ("a", "en", "y"): 1000, ("b", "en", "z"): 1000}
    mix = mixing.Mixture({}, {"a": 1, "b": 1}, {"en": 1}, share=1000 / 2010)
    assert mixing.quotas(leaves, mix) == {("a", "en", "x"): 10, ("a", "en", "y"): 490, ("b", "en", "z"): 500}


def brute(df, mix):
    """Prefixes by the same hash, leaf by leaf, in plain Python."""
    hashed = mixing._placed(df, mix).select("*", *[mixing._order(mixing.F.col("doc_id"), mixing.F.lit(e).cast("long"), mix.seed).alias(f"u{e}") for e in range(1, mix.epochs + 2)]).collect()
    leaves = defaultdict(list)
    for r in hashed:
        leaves[r.domain, r.language, r.origin].append(r)
    supply = {k: sum(r.tokens for r in v) for k, v in leaves.items()}
    out = defaultdict(int)
    for k, quota in mixing.quotas(supply, mix).items():
        whole = min(mix.epochs, quota // supply[k]) if supply[k] else 1
        rest = quota - whole * supply[k] if supply[k] and whole < mix.epochs else 0
        used = 0
        for r in sorted(leaves[k], key=lambda r: r[f"u{whole + 1}"]):
            n = whole + (used < rest)
            used += r.tokens
            if n:
                out[r.doc_id] = n
    return dict(out)


def test_matches_brute_force(spark, monkeypatch):
    rows = [r for r in TEXTS if r[0] != 8]
    for epochs, bits in ((1, 10), (3, 1)):
        monkeypatch.setattr(mixing, "BITS", bits)
        monkeypatch.setattr(mixing, "INTERVAL_ROWS", 20)
        mix = replace(MIX, epochs=epochs, share=0.5 * epochs)
        got = {r.doc_id: r.epochs_read for r in mixing.mixed(docs(spark, rows), mix).collect()}
        assert got == brute(docs(spark, rows), mix)


def test_take_keeps_columns_and_repeats(spark):
    df = docs(spark, TEXTS)
    assert mixing.take(df, MIX).columns == df.columns
    mix = replace(MIX, epochs=2, share=2.0)
    assert mixing.take(df, mix).count() > len(TEXTS)
    assert mixing.take(docs(spark, []), MIX).count() == 0


def plain_quotas(supply, mix):
    """Quotas by water level: the level at which a node's children hold its budget, found by halving."""

    def fill(nodes, budget):
        lo, hi = 0.0, 1e12
        for _ in range(300):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(m, w * mid) for w, m in nodes) < budget else (lo, mid)
        return [min(m, w * hi) for w, m in nodes]

    def go(leaves, depth, budget):
        if depth == 3:
            return {next(iter(leaves)): budget}
        kids = defaultdict(dict)
        for k, n in leaves.items():
            kids[k[depth]][k] = n
        weight = (mix.domain_weights, mix.lang_weights, mix.source_weights)[depth]
        nodes = [(weight.get(k, mix.default), mix.epochs * sum(v.values())) for k, v in kids.items()]
        return {k: b for v, b in zip(kids.values(), fill(nodes, min(budget, sum(m for _, m in nodes))), strict=True) for k, b in go(v, depth + 1, b).items()}

    return go(supply, 0, mix.share * sum(supply.values()))


def test_registered_query_matches_a_version_without_the_modules_own_functions(spark, sf_dir):
    """Leaves, tokens, quotas and prefixes told anew; only the order hash is Spark's."""
    from millrace.llm.queries import QUERIES

    mix = replace(mixing.PRODUCTION, epochs=2)
    docs_ = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "xxhash64(42, 1L, doc_id) u1", "xxhash64(42, 2L, doc_id) u2", "xxhash64(42, 3L, doc_id) u3").collect()
    domain = {s: d for d, members in mix.domains.items() for s in members}
    leaves = defaultdict(list)
    for r in docs_:
        leaves[domain.get(r.source or "", "other"), r.lang or "", r.source or ""].append((r, len((r.text or "").split())))
    supply = {k: sum(n for _, n in v) for k, v in leaves.items()}
    want = {}
    for k, quota in plain_quotas(supply, mix).items():
        quota = round(quota, 6)
        whole = min(2, int(quota // supply[k])) if supply[k] else 1
        rest = int(quota) - whole * supply[k] if supply[k] and whole < 2 else 0
        used = 0
        for r, n in sorted(leaves[k], key=lambda x: x[0][f"u{whole + 1}"]):
            if whole + (used < rest):
                want[r.doc_id] = (k[0], k[1], k[2], n, whole + (used < rest))
            used += n
    got = {r.doc_id: (r.domain, r.lang, r.source, r.tokens, r.epochs_read) for r in QUERIES["op7_mixing"](spark, sf_dir).collect()}
    assert got == want
