"""Near-duplicate vectors and whitening against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.llm import near_vectors as N
from tillroll.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_links(rows, bar=0.95):
    """{id: (links, least id reachable)} of (id, vector) rows with unique ids."""
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    m = np.array([v / np.sqrt((v * v).sum()) for _, v in good])
    near = m @ m.T >= bar
    np.fill_diagonal(near, False)
    root = list(range(len(good)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(*np.nonzero(near), strict=True):
        x, y = sorted((find(a), find(b)), key=lambda k: good[k][0])
        root[y] = x
    out = {i: (0, i) for i, _ in rows}
    return out | {good[k][0]: (int(near[k].sum()), good[find(k)][0]) for k in range(len(good))}


def _cloud(seed, n, spread, d=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=d)
    return [(centre / np.linalg.norm(centre) + spread * rng.normal(size=d)).tolist() for _ in range(n)]


def _rows():
    rng = np.random.default_rng(9)
    vectors = [rng.normal(size=8).tolist() for _ in range(150)]
    for seed, n, spread in ((1, 60, 0.03), (2, 60, 0.09), (3, 40, 0.15), (4, 2, 0.01)):   # whole, fringed and loose groups
        vectors += _cloud(seed, n, spread)
    vectors += [vectors[3]] * 25 + [vectors[160]] * 10 + [[-x for x in vectors[3]]] + [[5 * x for x in vectors[4]]]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0] * 7 + [float("inf")], [None] * 8, [1.0, 2.0]]
    order = np.random.default_rng(1).permutation(len(vectors) + len(odd))
    every = vectors + odd
    return [(int(k) * 3 + 1, every[j]) for k, j in enumerate(order)]


@pytest.mark.parametrize("crowded,slots", [(256, 8192), (8, 8192), (8, 5)])
def test_links_equal_brute_force(spark, monkeypatch, crowded, slots):
    """Plainly, with balls in all but the smallest buckets, and with these buckets dealt to slots."""
    monkeypatch.setattr(N, "CROWDED", crowded)
    monkeypatch.setattr(N, "SLOT_ROWS", slots)
    rows = _rows()
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumn("node", F.lit("clash")).withColumn("h", F.lit(1))
    got = {r.id: (r.n_links, r.component) for r in N.links(df).collect()}
    assert got == brute_links(rows)


def test_balls_settle_most_meetings_as_a_whole(spark, monkeypatch):
    """A dense group is found as balls, and no pairs are made of its members."""
    monkeypatch.setattr(N, "CROWDED", 16)
    met = []
    real = N._meetings
    monkeypatch.setattr(N, "_meetings", lambda *a: met.append(real(*a)) or met[-1])
    rows = [(i, v) for i, v in enumerate(_cloud(5, 400, 0.02))]
    got = N.links(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert {r.n_links for r in got} == {399} and {r.component for r in got} == {0}
    assert met[0].count() < 400


def test_repeated_keys_empty_tables_and_query(spark, tmp_path):
    v = [1.0, 0.0, 0.0]
    df = spark.createDataFrame([(1, v, 0), (1, v, 0), (2, [0.0, 1.0, 0.0], 0), (None, v, 0)], SCHEMA)
    assert sorted((r.id, r.n_links, r.component) for r in N.links(df).where("id IS NOT NULL").collect()) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]
    assert N.links(df.limit(0)).collect() == []
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    out = E.queries()["op11_near_vectors"](spark, str(tmp_path))
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in out.collect()) == [
        (0, 0, 0, False), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_estimates_are_unbiased_and_the_bound_holds():
    rng = np.random.default_rng(3)
    d, off, worst = 64, [], 0.0
    for _ in range(60):
        codes = N.Codes(np.linalg.qr(rng.normal(size=(d, d)))[0], np.zeros((1, 1, d)), 0, 0)
        o = rng.normal(size=(1, d))
        o /= np.linalg.norm(o)
        e = rng.normal(size=(200, d))
        e -= (e @ o.T) * o
        q = 0.95 * o + np.sqrt(1 - 0.95 ** 2) * e / np.linalg.norm(e, axis=1)[:, None]
        r = o @ codes.rotation.T
        factor = np.abs(r).sum(axis=1) / np.sqrt(d)
        got = N.estimates(np.where(r > 0, 1.0, -1.0), factor, q @ codes.rotation.T)[:, 0]
        off.append(got.mean() - 0.95)
        worst = max(worst, float((np.abs(got - 0.95) / N.error_bound(factor, np.array([0.95]), d)).max()))
    assert abs(np.mean(off)) < 0.005 and worst < 1


def test_missed_pairs_have_the_stated_odds():
    """At the threshold one table meets a pair as often as the margin limit says, whatever the vectors."""
    rng = np.random.default_rng(4)
    codes = N.Codes.fit(16, 64 << 8, 0.95)
    need = 1 - N.MISS ** (1 / N.TABLES)
    hits = 0
    for _ in range(1500):
        u = rng.normal(size=16)
        u /= np.linalg.norm(u)
        e = rng.normal(size=16)
        e -= (e @ u) * u
        v = 0.95 * u + np.sqrt(1 - 0.95 ** 2) * e / np.linalg.norm(e)
        both = np.stack([u, v])
        home = codes.homes(0, both)
        row, key = codes.visits(0, codes.margins(both, 0), np.full(2, codes.limit))
        hits += home[1] in key[row == 0] or home[0] in key[row == 1]
    assert hits / 1500 > need - 0.05


# -- whitening --------------------------------------------------------------

def _white(spark, rows, **kw):
    return W.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("id", F.lit("clash")), **kw)


def test_whitening_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 3
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(900, None), (901, [float("nan")] * 12), (902, [1.0] * 11 + [None]), (903, [1.0]), (904, [1e300] * 12)]
    got = _white(spark, rows).collect()
    assert len(got) == 300 * 8 and {r.component for r in got} == set(range(1, 9)) and {r.n for r in got} == {300}
    x = np.floor(1024 * m).astype(np.int64) + 100_000
    v = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = (x - x.mean(axis=0)) @ vectors[:, :8] / np.sqrt(values[:8])
    have = np.zeros((300, 8))
    for r in got:
        have[r.id, r.component - 1] = r.whitened
    assert np.abs(have * np.sign((have * want).sum(axis=0)) - want).max() < 1e-8
    assert {(r.component, round(r.explained, 10)) for r in got} == {(k + 1, round(values[k] / values.sum(), 10)) for k in range(8)}
    exact = ((300 * x.astype(object) - x.sum(axis=0)) ** 2).sum(axis=1)
    assert all(int(r.deviation) == exact[r.id] for r in got) and all(r.identity_error < 1e-9 for r in got)


def test_fewer_dimensions_or_lower_rank_give_fewer_components(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 2))
    flat = [(i, [a, b, a, 2.0, b, a, b, 0.0, 1.0]) for i, (a, b) in enumerate(base.tolist())]    # rank 2 in nine dimensions
    got = _white(spark, flat).collect()
    assert {r.component for r in got} == {1, 2} and abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-9
    assert {r.component for r in _white(spark, [(i, [a]) for i, (a, _) in enumerate(base.tolist())]).collect()} == {1}
    assert _white(spark, [(1, [1.0, 2.0])] * 5).collect() == [] and _white(spark, [(1, None)]).collect() == []


def test_exact_deviation_beyond_a_long(spark):
    rows = [(i, [float(2 ** 40) * (1 if i % 2 else -1), float(i)]) for i in range(1001)]
    got = {r.id: int(r.deviation) for r in _white(spark, rows).where("component = 1").collect()}
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert got == {i: sum((1001 * c - t) ** 2 for c, t in zip(r, s, strict=True)) for (i, _), r in zip(rows, x, strict=True)}
    assert max(got.values()) > 2 ** 63


@pytest.mark.parametrize("d,rank", [(1, 1), (5, 5), (30, 30), (30, 7)])
def test_pivoted_cholesky_and_jacobi(d, rank):
    rng = np.random.default_rng(d + rank)
    half = rng.normal(size=(d, rank)) * np.logspace(0, -4, rank)
    a = half @ half.T
    order, factor = W.pivoted_cholesky(a)
    assert np.abs(factor @ factor.T - a[order][:, order]).max() < 1e-13 * np.abs(a).max() * d
    assert np.allclose(np.triu(factor, 1), 0) and factor.shape[1] >= rank
    values, vectors = W.components(a)
    assert np.allclose(values[:rank], np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9, atol=1e-14 * d * values[0])
    assert np.abs(vectors[:rank] @ vectors[:rank].T - np.eye(rank)).max() < 1e-9
    assert sum(len(p) for p, _ in W._rounds(7)) == 21
