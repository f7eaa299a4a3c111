"""Whitening against numpy, and its eigenvectors on clustered matrices."""

import os

import numpy as np
import pytest

from marketlens.llm import whitening as W

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n long, component string, x binary"


def frame(spark, vectors, parts=3):
    df = spark.createDataFrame([(i, v, -1, "c", b"x") for i, v in vectors], SCHEMA)
    return df.repartition(parts) if vectors else df


def run(spark, tmp_path, vectors, name="t"):
    frame(spark, vectors).write.parquet(str(tmp_path / name / "embeddings.parquet"))
    return W.op11_whitening(spark, str(tmp_path / name))


def plain(vectors, k=4):
    """(vec_id, component) -> n, deviation, whitened, explained of the sound vectors."""
    good = [(i, np.floor(256 * np.array(v, float))) for i, v in vectors
            if v and all(c is not None and np.isfinite(c) for c in v)]
    dims = [len(x) for x in {x.tobytes(): x for _, x in good}.values()]
    dim = max(set(dims), key=lambda d: (dims.count(d), d))
    good = [(i, x) for i, x in good if len(x) == dim]
    fit = np.unique(np.array([x for _, x in good]), axis=0)
    value, vec = np.linalg.eigh(np.atleast_2d(np.cov(fit.T, bias=True)))
    value, vec = value[::-1], vec[:, ::-1]
    total = [int(s) for s in fit.sum(0)]
    out = []
    for i, x in good:
        dev = sum((len(fit) * int(c) - s) ** 2 for c, s in zip(x, total))
        w = (x - fit.mean(0)) @ vec[:, :k] / np.sqrt(value[:k])
        out += [(i, c + 1, len(fit), dev, w[c], value[c] / value.sum()) for c in range(min(k, dim))]
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    sign = {}
    for g, w in zip(got, want):
        sign.setdefault(g[1], 1 if g[4] * w[4] >= 0 else -1)
        assert abs(g[4] * sign[g[1]] - w[4]) < 1e-8 and abs(g[5] - w[5]) < 1e-10


def made(n=60, dim=8):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(n, dim)) * np.arange(1, dim + 1) * 0.1 + 3).astype(np.float32).tolist()
    return list(enumerate(v)) + [(100 + i, v[i % 3]) for i in range(30)]


def test_matches_numpy(spark, tmp_path):
    out = run(spark, tmp_path, made())
    rows = out.collect()
    same(rows, plain(made()))
    assert {r.n for r in rows} == {60} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-12
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_odd_rows(spark, tmp_path):
    bad = [(1000, None), (1001, []), (1002, [None] * 8), (1003, [float("nan")] + [0.0] * 7), (1004, [float("inf")] * 8),
           (1005, [1.0, 2.0]), (None, [0.5] * 8), (7, [0.25] * 8), (7, [0.25] * 8)]
    same(run(spark, tmp_path, made() + bad).collect(), plain(made() + bad))


def test_few_dimensions_and_no_variance(spark, tmp_path):
    same(run(spark, tmp_path, [(i, [float(i), float(i * i)]) for i in range(9)], "two").collect(),
         plain([(i, [float(i), float(i * i)]) for i in range(9)]))
    one = run(spark, tmp_path, [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0])], "one").collect()
    assert len(one) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None
                                 and r.identity_error is None for r in one)
    flat = run(spark, tmp_path, [(i, [float(i), 5.0, float(i % 2)]) for i in range(8)], "flat").collect()
    last = [r for r in flat if r.component == 3]
    assert all(r.whitened is None and r.explained == 0 for r in last) and flat[0].identity_error < 1e-12
    assert run(spark, tmp_path, [], "none").collect() == []


def test_large_entries_stay_exact(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(c) for c in rng.integers(-2**24, 2**24, 3)]) for i in range(40)]
    got = {(r.vec_id, r.component): r for r in run(spark, tmp_path, vectors).collect()}
    for i, c, n, dev, w, share in plain(vectors):
        r = got[i, c]
        assert r.deviation == (dev if dev < 2**63 else None) and abs(abs(r.whitened) - abs(w)) < 1e-8
    assert any(r.deviation is None for r in got.values())
    big = rng.integers(-2**40, 2**40, (7, 3))
    assert (W.exact_product(big) == big.astype(object).T @ big.astype(object)).all()


@pytest.mark.parametrize("values", [
    [5] * 10 + [3] * 10 + list(range(10)), [1 + 1e-9 * i for i in range(30)], [2] * 30, [7, 7 + 1e-7, 7 + 2e-7] + [1] * 27,
    list(np.logspace(0, -12, 30)), list(range(30))])
def test_clustered_eigenvalues(values):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    a = (q * np.array(values, float)) @ q.T
    a = ((a + a.T) / 2).astype(np.longdouble)
    value, x = W.eigen(a)
    assert (np.diff(value) <= 0).all()
    assert np.abs(a @ x - x * value).max() < 1e-15 * max(values)
    assert np.abs(x.T @ x - np.eye(30)).max() < 1e-15


def test_steps_mend_float32(monkeypatch):
    """The float32 start alone is far from double precision."""
    rng = np.random.default_rng(4)
    m = rng.normal(size=(40, 60))
    a = (m @ m.T).astype(np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    start = np.abs(a @ x - x * (x * (a @ x)).sum(0)).max()
    value, x = W.eigen(a)
    assert np.abs(a @ x - x * value).max() < start * 1e-8


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    same(W.op11_whitening(spark, SF).collect(), plain([(r.vec_id, r.embedding) for r in rows]))
