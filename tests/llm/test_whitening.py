import numpy as np
import pytest

from lumenreg.llm import whitening as W

RNG = np.random.default_rng(5)


def spread(values):
    q, _ = np.linalg.qr(RNG.standard_normal((len(values), len(values))))
    a = (q * np.array(values, float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [[3.0], [5.0] * 6 + [1.0] * 6, [2.0] * 9, [0.0] * 4, [1e6] + [1.0] * 8 + [0.0],
                                    list(range(40)), [10.0 ** -i for i in range(12)]])
def test_spectral_equals_the_library(values):
    a = spread(values)
    found, u = W.spectral(a)
    scale = max(np.linalg.norm(a), 1e-300)
    assert found == pytest.approx(np.linalg.eigvalsh(a)[::-1], abs=1e-13 * scale)
    assert np.abs(u.T @ u - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ u - u * found).max() <= 1e-13 * scale


def test_polar_factor():
    a = spread([4.0, 2.0, -1.0, -1e-7])
    values, vectors = np.linalg.eigh(a)
    assert W.polar(a) == pytest.approx((vectors * np.sign(values)) @ vectors.T, abs=1e-8)


def plain(rows, components=16):
    """By the contract, with whole numbers and the library's eigenvectors."""
    kept = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = np.array((fit * n - sums) / n, float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return kept, n, sums, values, vectors, np.trace(centred.T @ centred / n)


def test_rows_equal_a_plain_computation(spark):
    base = RNG.standard_normal((200, 20)) * np.linspace(1, 4, 20)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(500 + i, rows[0][1]) for i in range(90)]  # copies count once in the fit list
    rows += [(700, None), (701, [None] + [1.0] * 19), (702, [float("nan")] + [1.0] * 19),
             (703, [float("inf")] + [1.0] * 19), (704, [1.0, 2.0]), (None, rows[1][1]), (3, rows[2][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = W.whiten(df).collect()
    good = [r for r in rows if r[0] != 704]
    kept, n, sums, values, vectors, trace = plain(good)
    assert len(got) == 16 * len(kept) and {r["n"] for r in got} == {n} and n == 200
    assert {r["identity_error"] for r in got}.pop() < 1e-10
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    first = {}
    for i, x in kept:
        far = sum((n * int(c) - int(s)) ** 2 for c, s in zip(x, sums))
        centred = np.array([(n * c - s) / n for c, s in zip(x, sums)], float)
        for k in range(16):
            r = by[i][k + 1]
            assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-10)
            want = centred @ vectors[:, k] / np.sqrt(values[k])
            sign = first.setdefault(k, 1 if abs(want - r["whitened"]) < abs(want + r["whitened"]) else -1)
            if i != 3:  # a repeated id
                assert r["deviation"] == far and int(r["deviation_wide"]) == far
                assert r["whitened"] == pytest.approx(sign * want, abs=1e-9)


def test_low_rank_and_single_vectors(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    df = spark.createDataFrame(line, "vec_id long, embedding array<float>")
    got = W.whiten(df).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1.0)
    one = spark.createDataFrame([(1, [0.5, 0.25])] * 4, "vec_id long, embedding array<float>")
    assert W.whiten(one).collect() == []
    assert W.whiten(df.limit(0)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, []), (2, None)], df.schema)).collect() == []


def test_wide_deviation_is_exact_or_null(spark):
    rows = [(i, [float((-1) ** i * 2.0 ** 40), float(i)]) for i in range(64)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    kept, n, sums, *_ = plain(rows)
    want = {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(x, sums)) for i, x in kept}
    assert all(r["deviation"] is None and int(r["deviation_wide"]) == want[r["vec_id"]] for r in got)


def test_extra_columns_and_names(spark):
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 3)], "x", 1) for i in range(50)],
                               "id string, e array<float>, component string, n int")
    got = W.whiten(df, "id", "e").collect()
    assert len(got) == 100 and set(got[0].asDict()) >= {"id", "component", "whitened"}
