import numpy as np
import pytest

from hourglass.llm import whitening as W


def plain(rows):
    """(x vectors of usable rows, fit list, covariance by numpy)."""
    x = np.array([np.floor(256 * np.array(v, np.float64)).astype(np.int64) for v in rows])
    fit = np.unique(x, axis=0)
    y = fit - fit.mean(0)
    return x, fit, y.T @ y / len(fit)


def check(got, vectors, k=4):
    x, fit, v = plain(list(vectors.values()))
    n, s = len(fit), fit.sum(0)
    e = np.linalg.eigvalsh(v)[::-1]
    ids = list(vectors)
    z = {}
    for r in got:
        z[r.vec_id, r.component] = r.whitened
        assert r.n == n and abs(r.explained - e[r.component - 1] / np.trace(v)) <= 1e-9 and r.identity_error < 1e-9
        row = x[ids.index(r.vec_id)]
        assert r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))
    assert len(z) == len(ids) * k
    w, u = np.linalg.eigh(v)
    for c in range(1, k + 1):
        mine = np.array([z[i, c] for i in ids])
        true = (x - s / n) @ u[:, -c] / np.sqrt(w[-c])
        assert min(np.abs(mine - true).max(), np.abs(mine + true).max()) < 1e-8


def test_whole_table_against_eigh(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = {r.vec_id: list(r.embedding) for r in df.select("vec_id", "embedding").collect() if r.embedding is not None}
    check(W.whiten(df).collect(), vectors)


def test_copies_weigh_nothing_and_bad_rows_take_no_part(spark):
    rng = np.random.default_rng(1)
    vectors = {i: (rng.standard_normal(6) * [9, 5, 3, 2, 1, 1]).tolist() for i in range(50)}
    copies = {100 + i: vectors[3] for i in range(40)}
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (203, [float("nan")] * 6), (204, [float("inf")] * 6),
           (205, [1.0, 2.0])]
    rows = [(i, v, "x") for i, v in {**vectors, **copies}.items()] + [(i, v, "x") for i, v in bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    check(W.whiten(df).collect(), {**vectors, **copies})


@pytest.mark.parametrize("rows, expected", [([], 0), ([[1.0, 2.0]], 2), ([[1.0, 2.0]] * 3, 6), ([[0.5]], 1)])
def test_tables_without_variance(spark, rows, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = W.whiten(df).collect()
    assert len(got) == expected
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in got)


def test_extreme_entries_and_null_ids(spark):
    rows = [(None, [1e300, -1e300]), (1, [-0.001, 0.0]), (1, [-0.001, 0.0]), (2, [3e9, 7.0]), (3, [-0.0, 1e12])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 10 and sum(r.vec_id is None for r in got) == 2
    assert all(r.deviation is None for r in got if r.vec_id is None)
    assert all(r.n == 4 for r in got)


@pytest.mark.parametrize("m", [1, 2, 3, 7, 40, 130])
@pytest.mark.parametrize("kind", ["random", "two values", "one rank", "same", "decay"])
def test_leading_components(m, kind):
    rng = np.random.default_rng(m)
    a = rng.standard_normal((m, m))
    q = np.linalg.qr(a)[0]
    values = {"random": None, "two values": np.where(np.arange(m) < m // 2, 3.0, 1.0), "one rank": np.eye(m)[0],
              "same": np.full(m, 5.0), "decay": 10.0 ** -np.arange(m).clip(0, 20)}[kind]
    v = a @ a.T if values is None else q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, u = W.leading_components(v, 4)
    top = np.abs(v).max()
    assert np.abs(e - np.linalg.eigvalsh(v)[::-1][:4]).max() < 1e-12 * top * m
    assert np.abs(v @ u - u * e).max() < 1e-12 * top * m
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12


def test_polar_factor():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    w, q = np.linalg.eigh(a)
    assert np.abs(W.polar_factor(a) - q @ np.diag(np.sign(w)) @ q.T).max() < 1e-12


def test_packing_is_one_to_one():
    x = np.array([[0, 1], [-32768, 32767], [-32769, 0], [1 << 31, 5], [-(1 << 62), 1 << 62]])
    import pyarrow as pa
    raw = W.pack(x)
    assert [r[0] for r in raw] == [2, 2, 4, 8, 8]
    assert (W.unpack(pa.array(raw, pa.binary()), 2) == x).all()
