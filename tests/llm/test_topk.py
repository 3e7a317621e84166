import math

import numpy as np
from pyspark.sql import functions as F

from dayflow.llm import topk


def brute(rows, k=10, step=100):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % step:
            continue
        got = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(got)]
    return sorted(out)


def search(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = topk.top_k(df, F.pmod("vec_id", F.lit(100)) == 0, **kw)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect())


def vectors(n, d, seed, common=0):
    g = np.random.default_rng(seed)
    base = g.standard_normal((5, d))
    x = base[g.integers(0, 5, n)] + 0.3 * g.standard_normal((n, d))
    x *= g.gamma(2, 1, n)[:, None]
    x[:common] = x[0]
    return [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]


def test_against_brute_force(spark):
    rows = vectors(900, 16, 1, common=200)
    assert search(spark, rows) == brute(rows)


def test_many_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "SEED_VECTORS", 20)
    rows = vectors(500, 8, 2)
    assert search(spark, rows, cell_vectors=60, cell_queries=2) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (100, [0.0, -1.0]), (1, [1.0, 2.0]), (2, None), (None, [5.0, 5.0]),
            (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, [3.0]), (7, []),
            (200, [1e-9, -1e-9])]
    want = brute([(i, v + [0.0] * (2 - len(v)) if v else ([0.0, 0.0] if v == [] else v))
                  for i, v in rows])
    assert search(spark, rows) == want
    assert search(spark, rows[:1]) == []
    assert search(spark, [(1, [1.0])]) == [] and search(spark, [(None, None)]) == []


def test_strips_prune_without_loss():
    r = np.random.default_rng(4)
    c = np.floor(r.standard_normal((6000, 12)) * np.linspace(300, 1, 12) * r.gamma(1, 2, (6000, 1)))
    q = np.floor(r.standard_normal((7, 12)) * np.linspace(300, 1, 12))
    ids = r.permutation(6000)
    rot = np.linalg.eigh(c.T @ c)[1][:, ::-1]
    ask, rows = topk.Vectors.dense(q), topk.Vectors.dense(c)
    floor = topk.first_floor(ask, np.arange(7) + 10000, topk.Vectors.dense(c[:50]), ids[:50], 10)
    got = topk.search_cell(ask, np.arange(7) + 10000, rows, ids, floor, rot, 10)
    s = (q @ c.T).astype(int)
    for k in range(7):
        want = sorted((-s[k, j], ids[j]) for j in range(6000))[:10]
        mine = [(-x, i) for n, i, x in zip(*got) if n == k]
        assert sorted(mine)[:10] == want


def test_one_very_long_vector(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.integers(-9, 9, 6)]) for i in range(150)]
    rows[100] = (100, [float(x) for x in r.integers(-9, 9, 100_000)])
    rows[7] = (7, [float(x) for x in r.integers(-9, 9, 1500)])
    got = search(spark, rows)
    wide = max(len(v) for _, v in rows)
    v = np.zeros((len(rows), wide))
    for i, x in rows:
        v[i, :len(x)] = np.array(x) * 1024
    for q in (0, 100):
        s = (v @ v[q]).astype(np.int64)
        want = sorted((-s[j], j) for j in range(150) if j != q)[:10]
        assert [(-x, i) for a, _, i, x in got if a == q] == want


def test_tails_are_multiplied_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROTATED", 5)
    monkeypatch.setattr(topk, "TAIL", 3)
    rows = [(i, v[:1 + i % 16]) for i, v in vectors(400, 16, 6)]
    want = brute([(i, v + [0.0] * (16 - len(v))) for i, v in rows])
    assert search(spark, rows) == want
    monkeypatch.setattr(topk, "CELL_COMPONENTS", 700)
    assert search(spark, rows, cell_vectors=50, cell_queries=1) == want


def clustered(n, d, groups, seed):
    g = np.random.default_rng(seed)
    centres = g.standard_normal((groups, d))
    x = centres[g.integers(0, groups, n)] + 0.05 * g.standard_normal((n, d))
    return np.floor(1024 * x / np.sqrt((x * x).sum(1))[:, None])


def sectors_of(x, count):
    rows = topk.Vectors.dense(x)
    pivots = topk.fit_pivots(x[:500], count)
    bands = np.unique(np.quantile(rows.norm2, topk.BANDS))
    code, along, beside = topk.place(rows, pivots, bands)
    codes, at = np.unique(code, return_inverse=True)
    stat = lambda f, v: np.array([f(v[at == i]) for i in range(len(codes))])
    return at, topk.Sectors(codes, stat(np.min, along), stat(np.max, along),
                            stat(np.max, beside), stat(np.max, rows.norm2),
                            np.ones(len(codes), np.int64), pivots)


def test_bounds_of_sectors_hold():
    r = np.random.default_rng(7)
    for x in (clustered(2000, 12, 5, 8), np.floor(r.standard_normal((2000, 12)) * 400),
              np.vstack([np.zeros((3, 12)), clustered(50, 12, 1, 9) * 1000])):
        at, sectors = sectors_of(x, 6)
        q = topk.Vectors.dense(np.vstack([x[:40], -x[:5], np.zeros((1, 12))]))
        bounds = sectors.bounds(q)
        assert (q.head @ x.T <= bounds[:, at]).all()


def test_queries_skip_sectors_of_equal_length_clusters():
    x = clustered(6000, 32, 20, 10)
    at, sectors = sectors_of(x, 40)
    q = topk.Vectors.dense(x[::100])
    s = x[::100] @ x.T
    sent = sectors.reached(q, np.partition(s, -10, axis=1)[:, -10])
    best = np.argsort(-s, axis=1)[:, :10]
    assert all(sent[i, at[best[i]]].all() for i in range(len(s)))
    shipped = sent @ np.bincount(at)
    assert shipped.mean() < 0.35 * len(x)


def test_candidates_out_of_reach_are_not_shipped(spark):
    x = clustered(3000, 16, 3, 11) / 1024
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    rows = [(i * 100 if i < 5 else i * 100 + 1, v) for i, v in rows]
    assert search(spark, rows, cell_vectors=200, cell_queries=2) == brute(rows)


def test_rows_of_one_id_and_copies(spark):
    rows = vectors(200, 8, 12) + [(0, [1.0] * 8), (100, [2.0] * 8)] + [(5, [9.0] * 8)] * 30
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df.withColumn("row", F.lit("x")).withColumn("sector", F.lit(1)),
                     F.col("vec_id") % 100 == 0, k=4).collect()
    want = []
    v = [(i, [math.floor(1024 * x) for x in a]) for i, a in rows]
    for q, a in v:
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in v if i != q)[:4]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
