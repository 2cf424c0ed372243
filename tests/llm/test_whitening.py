"""Jacobi-Davidson and whitening against dense eigenvectors and Python's integers."""

import math

import numpy as np
import pytest

from kinestream.llm import jacobi, queries, whitening


@pytest.mark.parametrize("size,kind", [(1, "full"), (2, "low"), (9, "full"), (40, "low"), (64, "flat"), (64, "full"), (200, "twelve"), (150, "steep"), (120, "close")])
def test_pairs_are_the_dense_ones(size, kind):
    rng = np.random.default_rng(size)
    turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
    spectrum = {
        "full": rng.random(size),
        "low": np.r_[rng.random(size // 2), np.zeros(size - size // 2)],
        "flat": np.full(size, 3.0),
        "twelve": np.r_[np.full(12, 5.0), np.linspace(1, 0.1, size - 12)] if size > 12 else None,
        "steep": np.exp(-np.arange(float(size))),
        "close": 1 + 1e-3 * rng.random(size),
    }[kind]
    matrix = (turn * spectrum) @ turn.T
    values, vectors = jacobi.leading(lambda w: matrix @ w, size, 8)
    want = np.sort(spectrum)[::-1][:8]
    assert np.allclose(values, want, rtol=0, atol=1e-13 * want[0]) and (np.diff(values) <= 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() <= 8 * size * 2.0**-50 * want[0]


def test_minres_solves_indefinite_systems_in_step():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    right = np.hstack([rng.normal(size=(30, 3)), np.zeros((30, 1))])
    found = jacobi.minres(lambda w: a @ w, right, 1e-12, 200)
    assert np.abs(a @ found - right).max() < 1e-8 and not found[:, 3].any()
    few = jacobi.minres(lambda w: a @ w, right, 1e-12, 5)
    krylov = [right[:, 0]]
    for _ in range(4):
        krylov.append(a @ krylov[-1])
    best = np.linalg.lstsq(a @ np.array(krylov).T, right[:, 0], rcond=None)[0]
    assert math.isclose(np.linalg.norm(a @ few[:, 0] - right[:, 0]), np.linalg.norm(a @ np.array(krylov).T @ best - right[:, 0]), rel_tol=1e-6)


def test_query_is_the_dense_solution(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    x = {r.vec_id: np.floor(1024 * np.array(r.embedding, dtype=float)) + 100000 for r in table}
    full = np.array([*x.values()])
    centre = full - full.mean(0)
    values, vectors = np.linalg.eigh(centre.T @ centre / len(full))
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    rows = queries.op13_embedding_whitening(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 8 * len(full) and len({(r.vec_id, r.component) for r in rows}) == len(rows)
    got, want = np.zeros((len(full), 8)), np.zeros((len(full), 8))
    sums = [int(v) for v in full.sum(0)]
    for r in rows:
        at = r.component - 1
        got[r.vec_id, at] = r.whitened
        want[r.vec_id, at] = (x[r.vec_id] - full.mean(0)) @ vectors[:, at] / np.sqrt(values[at])
        assert r.n == len(full) and abs(r.explained / (values[at] / np.trace(centre.T @ centre / len(full))) - 1) < 1e-10 and r.identity_error < 1e-10
        if not at:
            assert r.deviation == sum((len(full) * int(v) - s) ** 2 for v, s in zip(x[r.vec_id], sums, strict=True))
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-8
    assert np.abs(got.T @ got / len(full) - np.eye(8)).max() < 1e-10


def test_edges(spark):
    """Null vectors and entries, entries that are not finite, other lengths, null and repeated ids, equal rows, clashing columns."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -1.0]), (2, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (None, [-0.4, 0.0, 2.0]), (5, None), (6, [None, 1.0, 1.0]), (7, [nan, 0.0, 0.0]), (8, [inf, 0.0, 0.0]), (9, []), (10, [1.0]), (11, [3.0, 4.0, -0.0001])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, x int")
    model = whitening.fit(df)
    used = [v for _, v in rows if v is not None and len(v) == 3 and all(e is not None and math.isfinite(e) for e in v)]
    x = [[math.floor(1024 * float(np.float32(e))) + 100000 for e in v] for v in used]
    assert model.n == 5 and model.sums == [sum(c) for c in zip(*x, strict=True)] and len(model.values) == 3
    out = whitening.whitened(df, model).collect()
    assert len(out) == 15 and {r.vec_id for r in out} == {1, 2, None, 11}
    assert sorted({r.deviation for r in out}) == sorted({sum((5 * e - s) ** 2 for e, s in zip(v, model.sums, strict=True)) for v in x})
    for empty in (df.limit(0), df.where("vec_id in (5, 9)"), df.where("vec_id = 2")):
        assert whitening.whitened(empty, whitening.fit(empty)).collect() == []


def test_sums_and_deviations_are_exact_beyond_64_bits(spark):
    """Very large entries are held to 2**52; a deviation that a long can't hold is null."""
    df = spark.createDataFrame([(i, [1e300 if i % 2 else -1e300, float(i)]) for i in range(2001)], "vec_id int, embedding array<double>")
    model = whitening.fit(df)
    assert model.n == 2001 and model.sums == [-(1 << 52) + 2001 * 100000, sum(1024 * i + 100000 for i in range(2001))]
    assert all(r.deviation is None for r in whitening.whitened(df, model).collect())
    near = spark.createDataFrame([(i, [i * 1e6]) for i in range(40)], "vec_id int, embedding array<double>")
    model = whitening.fit(near)
    for r in whitening.whitened(near, model).collect():
        assert r.deviation == (lambda v: v if v < 1 << 63 else None)((40 * (r.vec_id * 1024 * 10**6 + 100000) - model.sums[0]) ** 2)


def test_partial_sums_of_many_tasks_meet_in_steps(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0 * i]) for i in range(60)], "vec_id int, embedding array<double>")
    want = whitening.fit(df)
    monkeypatch.setattr(whitening, "FAN", 0)
    got = whitening.fit(df)
    assert np.allclose(got.values, want.values, rtol=1e-12) and got.sums == want.sums
