import math

import numpy as np
import pytest

from conftest import SF001
from dayflow.llm import whitening
from dayflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=16):
    """``{row number: (deviation, whitened)}``, n, explained; signs by the largest entry."""
    ok = [(i, v) for i, v in enumerate(rows) if v is not None
          and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in ok), default=0)
    x = {i: tuple(math.floor(64 * c) + 1_000_000 for c in v) + (1_000_000,) * (width - len(v))
         for i, v in ok}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    dev = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    centre = lambda v: np.array([(n * a - s) / n for a, s in zip(v, sums)])
    y = np.array([centre(v) for v in fit])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-e) if e[k] > 1e-9 * max(e)][:components]
    e, u = e[order], u[:, order]
    u = u * np.sign(u[np.abs(u).argmax(0), range(len(e))])
    return ({i: (dev[i], centre(v) @ u / np.sqrt(e)) for i, v in x.items()}, n,
            e / np.trace(cov))


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], SCHEMA)
    out, model, error = whitening.whiten(df, **kw)
    return {r.vec_id: (int(r.whitening.deviation), r.whitening["values"]) for r in out.collect()}, \
        model, error


def check(got, want):
    (rows, model, error), (expected, n, explained) = got, want
    assert model.n == n and set(rows) == set(expected)
    assert error <= 1e-4
    assert np.allclose(model.explained, explained, rtol=1e-9)
    for i, (dev, white) in expected.items():
        assert rows[i][0] == dev
        assert np.allclose(rows[i][1], white, atol=1e-6)


def sample(n, d, seed):
    g = np.random.default_rng(seed)
    x = g.standard_normal((n, d)) * np.geomspace(9, 1, d) + 5
    return [[float(np.float32(c)) for c in r] for r in x]


def test_against_brute_force_with_copies(spark):
    rows = sample(300, 20, 1)
    rows += [rows[0]] * 150 + [rows[1]] * 3        # a third of all rows is one vector
    check(run(spark, rows), brute(rows))


def test_many_blocks_and_panels(spark):
    rows = sample(257, 6, 2)
    check(run(spark, rows, block_rows=16, panel_rows=64, components=4), brute(rows, 4))


def test_odd_rows(spark):
    rows = [[1.0, 2.0, 0.5], [3.0, 1.0, 0.25], None, [None, 1.0, 2.0], [float("nan"), 1.0, 1.0],
            [float("inf"), 0.0, 0.0], [2.0], [], [5.0, -1.0, 2.0], [2.0, 0.0, 0.0]]
    got = run(spark, rows)
    check(got, brute(rows))
    assert got[0][6] == got[0][9]                  # padded with zeros


@pytest.mark.parametrize("rows", [[], [None], [[1.0, 2.0]] * 4, [[]]])
def test_nothing_to_whiten(spark, rows):
    got, model, error = run(spark, rows)
    assert error == 0.0 and model.explained == []
    assert all(dev == 0 and white == [] for dev, white in got.values())
    assert len(got) == len([r for r in rows if r is not None])


def test_vectors_of_less_rank(spark):
    rows = [[float(a), float(2 * a), 7.0] for a in range(9)]
    got, model, error = run(spark, rows)
    assert len(model.explained) == 1 and model.explained[0] == pytest.approx(1.0)
    assert error <= 1e-9 and all(len(w) == 1 for _, w in got.values())


def test_callers_columns_stay(spark):
    df = spark.createDataFrame(
        [(None, [1.0, 2.0], 5, "k"), (4, [2.0, 2.5], 6, "l"), (4, [0.0, 9.0], 6, "l")],
        "at long, embedding array<double>, x int, key string").withColumn("row", df_row())
    out, _, _ = whitening.whiten(df)
    assert out.columns == [*df.columns, "whitening"]
    assert sorted((r.at or 0, r.x, r.key) for r in out.collect()) == [
        (0, 5, "k"), (4, 6, "l"), (4, 6, "l")]


def df_row():
    from pyspark.sql import functions as F
    return F.lit("mine")


def test_query_against_numpy(spark):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF001}/embeddings.parquet").to_pydict()
    want, n, explained = brute(t["embedding"])
    out = QUERIES["op13_embedding_whitening"](spark, SF001).collect()
    assert len(out) == 16 * len(want)
    row_of = {i: k for k, i in enumerate(t["vec_id"])}
    for r in out:
        dev, white = want[row_of[r.vec_id]]
        assert (r.n, r.deviation) == (n, dev) and r.identity_error <= 1e-4
        assert r.whitened == pytest.approx(white[r.component - 1], abs=1e-6)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-8)
