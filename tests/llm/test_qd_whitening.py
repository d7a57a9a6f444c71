import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import qd, qd_whitening

SCHEMA = "vec_id long, label int, n double, embedding array<float>"


def brute(vectors: np.ndarray):
    """(n x - S squared and summed, eigenvalues, eigenvectors, x - mean)."""
    x = np.floor(vectors.astype(float) * 1024).astype(int) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, s)) for row in x]
    y = x - s / n
    e, v = np.linalg.eigh(y.T @ y / n)
    return deviation, e[::-1], v[:, ::-1], y


def check(rows, vectors, ids):
    deviation, e, v, y = brute(vectors)
    k = min(8, int((e > 1e-9 * e[0]).sum()))
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == len(ids) * k
    for c in range(1, k + 1):
        want = y @ v[:, c - 1] / math.sqrt(e[c - 1])
        have = np.array([got[i, c]["whitened"] for i in ids])
        if have @ want < 0:
            have = -have
        assert np.abs(have - want).max() < 1e-8 * max(1, np.abs(want).max())
        for i, d in zip(ids, deviation, strict=True):
            r = got[i, c]
            assert (r["n"], r["deviation"]) == (len(ids), d)
            assert abs(r["explained"] - e[c - 1] / e.sum()) < 1e-10
            assert r["identity_error"] < 1e-9


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, 1, 2.0, v) for i, v in zip(ids, vectors)], SCHEMA)


def test_equals_dense_eigenvectors(spark):
    from quayside.llm.queries import QUERIES, table
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op11_embedding_whitening"](spark, sf).collect()
    data = table(spark, sf, "embeddings").collect()
    check(rows, np.array([r["embedding"] for r in data], np.float32), [r["vec_id"] for r in data])


def test_many_blocks_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(qd_whitening, "FAN_IN", 3)
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((900, 12)) * np.arange(1, 13) / 40 - 5).astype(np.float32)
    df = frame(spark, vectors.tolist()).repartition(23)
    check(qd_whitening.components(df).collect(), vectors, list(range(900)))


def test_nulls_and_bad_entries_are_dropped(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((40, 5)).astype(np.float32)
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [1.0, float("nan"), 2.0, 3.0, 4.0],
           [float("inf"), 0.0, 0.0, 0.0, 0.0], [0.0, -float("inf"), 0.0, 0.0, 0.0]]
    df = frame(spark, [*good.tolist(), *bad])
    check(qd_whitening.components(df).collect(), good, list(range(40)))


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((10, 3)).astype(np.float32).tolist()
    rows = qd_whitening.components(frame(spark, [*v, *v], [None] * 10 + [7] * 10)).collect()
    assert len(rows) == 60 and {r["vec_id"] for r in rows} == {None, 7}
    assert {r["n"] for r in rows} == {20}


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]])
def test_no_variance_no_rows(spark, vectors):
    out = qd_whitening.components(frame(spark, vectors))
    assert out.collect() == []
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]


def test_rank_below_eight(spark):
    rng = np.random.default_rng(6)
    base = np.round(rng.standard_normal((50, 2)), 2) * 64
    vectors = np.hstack([base, base, base]).astype(np.float32)
    rows = qd_whitening.components(frame(spark, vectors.tolist())).collect()
    assert {r["component"] for r in rows} == {1, 2}
    assert max(r["identity_error"] for r in rows) < 1e-9


def test_tied_directions(spark):
    vectors = [[s * (i == j) for j in range(6)] for i in range(6) for s in (1.0, -1.0)]
    rows = qd_whitening.components(frame(spark, vectors)).collect()
    assert {r["component"] for r in rows} == set(range(1, 7))
    assert all(abs(r["explained"] - 1 / 6) < 1e-12 and r["identity_error"] < 1e-12 for r in rows)


def test_lengths_must_agree(spark):
    with pytest.raises(ValueError, match="lengths"):
        qd_whitening.components(frame(spark, [[1.0, 2.0], [1.0]]))


def test_deviation_is_exact_or_null():
    n, sums = 3_000_000, (300_000_000_000, 300_000_000_123)
    x = np.array([[100_000, 100_000], [101_011, 99_000], [90_000, 1_200], [2**50, 0]])
    _, square = qd_whitening.offsets(x, n, sums)
    true = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert square.tolist() == [t if t < 2**63 else None for t in true]
    assert true[2] > 2**63


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 2**32 - 1), st.sampled_from(
    ["random", "ties", "graded", "low rank", "whole"]))
def test_solver_against_svd(d, seed, kind):
    rng = np.random.default_rng(seed)
    u, v = (np.linalg.qr(rng.standard_normal((d, d)))[0] for _ in range(2))
    s = {"random": rng.random(d), "ties": rng.integers(1, 3, d).astype(float),
         "graded": 10.0 ** -rng.integers(0, 12, d), "low rank": rng.integers(0, 2, d) * 1.0,
         "whole": np.ones(d)}[kind]
    a = u * s @ v
    if kind == "whole":
        a = rng.integers(-2, 3, (d, d)).astype(float)
    true = np.linalg.svd(a, compute_uv=False)
    diagonal, above, _ = qd.bidiagonal(a)
    every = qd.singular_values(diagonal, above)
    assert np.abs(every - true).max() <= 1e-13 * max(true[0], 1e-300)
    values, z = qd.leading(a, d)
    assert np.abs(z.T @ z - np.eye(len(values))).max(initial=0) < 1e-10
    assert np.abs(a.T @ (a @ z) - z * values ** 2).max(initial=0) <= 1e-12 * max(true[0], 1e-300) ** 2


def test_small_values_keep_their_digits():
    diagonal, above = 10.0 ** -np.arange(0, 20.0), 10.0 ** -np.arange(0.5, 19.5)
    values = qd.singular_values(diagonal, above)
    # The product of the values is the determinant, to every factor's precision.
    assert abs(np.log(values).sum() - np.log(diagonal).sum()) < 1e-12
