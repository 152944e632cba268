from fractions import Fraction

import numpy as np
import pytest

from paperloom.llm import storage
from paperloom.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors):
    """(n, sums, values, vectors, trace) by plain numpy over the distinct integer vectors."""
    x = np.array(sorted({tuple(int(np.floor(np.float64(c) * 256)) for c in v) for v in vectors}), dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    v = c.T @ c / n
    values, u = np.linalg.eigh(v)
    return n, s, values[::-1], u[:, ::-1], np.trace(v)


def check(rows, kept, k=4):
    n, s, values, u, trace = brute([v for _, v in kept])
    by = {}
    for r in rows:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert len(rows) == k * len(kept)
    signs = {}
    for vec_id, v in kept:
        x = np.floor(np.array(v, np.float64) * 256)
        for i in range(k):
            for r in by[vec_id, i + 1]:
                assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s))
                want = (x - s / n) @ u[:, i] / np.sqrt(values[i])
                if abs(want) > 1e-3:
                    signs.setdefault(i, np.sign(want * r.whitened))
                    assert abs(want * signs[i] - r.whitened) < 1e-7
                assert abs(r.explained / (values[i] / trace) - 1) < 1e-9 and r.identity_error < 1e-9


def test_query_agrees_with_numpy(spark):
    sf = "/root/testdata/sf0.001"
    vectors = [(r.vec_id, r.embedding) for r in storage.documents(spark, sf, "embeddings").collect()]
    got = w.query(spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), vectors)


@pytest.mark.parametrize("gap", [True, False])
def test_stops_at_a_gap_and_expands_without_one(spark, frame, gap):
    rng = np.random.default_rng(1)
    sizes = np.r_[8.0, 6.5, 5.0, 4.0, np.full(28, 0.01 if gap else 3.8)]
    vectors = [(i, [float(v) for v in row]) for i, row in enumerate((rng.standard_normal((900, 32)) * sizes).astype(np.float32))]
    vectors += [(5000 + i, vectors[0][1]) for i in range(300)]
    rows, d = w.usable(frame(vectors, SCHEMA))
    model = w.fit(rows, d)
    assert d == 32 and model.expanded is (not gap) and (model.passes <= w.PASSES) is gap
    _, _, values, u, trace = brute([v for _, v in vectors])
    assert np.allclose(np.abs(np.sum(model.components * u[:, :4], axis=0)), 1, atol=1e-12) and np.allclose(model.variances, values[:4], rtol=1e-10)
    assert np.isclose(model.trace, trace, rtol=1e-12) and model.identity_error < 1e-9


def test_rows_that_are_dropped_and_repeated(spark, frame, tables):
    rng = np.random.default_rng(2)
    kept = [(i, [float(np.float32(v)) for v in rng.standard_normal(6)]) for i in range(40)]
    kept += [(7, kept[7][1]), (7, kept[3][1]), (41, [-0.0, 0.0, -1 / 512, 1 / 512, 1.0, -1.0])]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (103, [float("nan")] * 6), (104, [float("inf")] * 6), (105, [1.0] * 5), (106, [3e38] * 6)]
    df = frame(kept + odd, SCHEMA).selectExpr("*", "1 AS n", "2 AS whitened", "3 AS x")
    rows = w.query(spark, tables(embeddings=df)).collect()
    assert {r.vec_id for r in rows} == {i for i, _ in kept}
    n, s, *_ = brute([v for _, v in kept])
    assert n == 41 and {r.n for r in rows} == {41}
    assert sorted(r.deviation for r in rows if r.vec_id == 7 and r.component == 1) == sorted(sum((n * int(np.floor(a * 256)) - int(b)) ** 2 for a, b in zip(v, s)) for i, v in kept if i == 7)
    usable, d = w.usable(df.selectExpr("*", "9 AS `a.b`"))
    out = w.whitened(usable, w.fit(usable, d))
    assert {"a.b", "x", "n", *w.FIELDS} <= set(out.columns) and out.count() == len(kept)


def test_few_dimensions_no_variance_and_empty(spark, frame, tables):
    rows, d = w.usable(frame([(i, [float(i), 2.0]) for i in range(9)], SCHEMA))
    model = w.fit(rows, d)
    got = w.whitened(rows, model).collect()
    assert model.identity_error < 1e-12 and all(r.whitened[1] is None and r.whitened[0] is not None for r in got)
    assert model.explained == pytest.approx([1, 0])
    alone, d = w.usable(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA))
    model = w.fit(alone, d)
    assert (model.n, model.explained) == (1, [0.0, 0.0]) and {tuple(r.whitened) for r in w.whitened(alone, model).collect()} == {(None, None)}
    empty = w.query(spark, tables(embeddings=frame([], SCHEMA)))
    assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "component", "n"]


def test_numbers_beyond_longs_are_exact():
    x = np.array([[1 << 50, 5], [-(1 << 50), 7], [3, 1 << 40]], np.int64)
    sums = [int(v) for v in x.astype(object).sum(axis=0)]
    n = 1 << 20
    want = [sum((n * int(a) - b) ** 2 for a, b in zip(row, sums)) for row in x]
    assert w.squared_deviations(x, n, sums) == [v if v < 1 << 63 else None for v in want]
    assert [float(v) for v in w.centred(x, n, sums)[0]] == [float(Fraction(n * int(a) - b, n)) for a, b in zip(x[0], sums)]
    edge = np.array([[3_000_000_000, 0], [3_037_000_499, 0]], np.int64)
    assert w.squared_deviations(edge, 1, [0, 0]) == [9 * 10**18, 3_037_000_499**2]
