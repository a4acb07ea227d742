import math

import numpy as np
import pytest

from siftworks.llm import whitening as w
from tests.llm.rows import given

ROW = "vec_id long, embedding array<float>, label int, x string, whitened string, n long"


def frame(spark, vectors, schema=ROW):
    rows = [(i, v, 0, "x", "w", 1) for i, v in vectors]
    return spark.createDataFrame(rows, schema)


def brute(vectors, k=8):
    """The contract in Python integers and one dense decomposition."""
    fine = [
        (i, [math.floor(1024 * float(c)) + 100_000 for c in v])
        for i, v in vectors
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    n = len(fine)
    sums = [sum(c) for c in zip(*(x for _, x in fine), strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in fine])
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for _, x in fine]
    return fine, deviations, centred @ turn / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(spark, vectors, out):
    fine, deviations, coordinates, shares = brute(vectors)
    k = len(shares)
    got = sorted(out.collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert len(got) == len(fine) * k
    order = sorted(range(len(fine)), key=lambda i: fine[i][0])
    sign = np.sign([coordinates[order[0], c] * got[c]["whitened"] for c in range(k)])
    for j, r in enumerate(got):
        i, c = order[j // k], j % k
        assert (r["vec_id"], r["component"], r["n"]) == (fine[i][0], c + 1, len(fine))
        assert r["deviation"] == deviations[i] == r["deviation_wide"]
        assert r["whitened"] * sign[c] == pytest.approx(coordinates[i, c], abs=1e-8)
        assert r["explained"] == pytest.approx(shares[c], rel=1e-10)
        assert r["identity_error"] < 1e-10


def test_given_embeddings(spark):
    table = given(spark, "embeddings")
    vectors = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check(spark, vectors, w.whitening_digest(table))


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [math.nan] * 5), (103, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    out = w.whitening_digest(frame(spark, vectors + bad + [(104, [1.0, 2.0]), (105, [])]).repartition(7))
    # Fewer dimensions than components: as many components as dimensions.
    check(spark, vectors + bad, out)


def test_nothing_or_nothing_to_tell_apart(spark):
    assert w.whitening_digest(frame(spark, [])).count() == 0
    assert w.whitening_digest(frame(spark, [(1, None)])).count() == 0
    assert w.whitening_digest(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert w.whitening_digest(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])])).count() == 0
    line = w.whitening_digest(frame(spark, [(None, [1.0, 2.0]), (1, [2.0, 4.0]), (1, [2.0, 4.0])])).collect()
    assert sorted((r["vec_id"] is None, r["component"]) for r in line) == [(False, 1), (False, 1), (True, 1)]


def test_equal_and_close_eigenvalues(spark):
    """64 dimensions, most of one variance: the filter has hardly anything to hold on to."""
    d = 64
    vectors = []
    for i in range(d):
        for sign in (1, -1):
            v = [0.0] * d
            v[i] = sign * (4.0 if i < 3 else 1.0 + 1e-3 * (i == 3))
            vectors.append((2 * i + (sign < 0), v))
    fine = w.usable(frame(spark, vectors, ROW.replace("float", "double")))
    model = w.fit(fine)
    assert model.residuals.max() / model.eigenvalues[0] < 1e-11
    q = model.components
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-12
    assert w.identity_error(fine, model) < 1e-9


def test_deviations_beyond_a_long(spark):
    vectors = [(i, [float(2.0**30 * (-1) ** i), float(i)]) for i in range(3000)]
    out = w.whitening_digest(frame(spark, vectors, ROW.replace("float", "double"))).filter("component = 1")
    got = {r["vec_id"]: r for r in out.collect()}
    _, deviations, _, _ = brute(vectors)
    assert max(deviations) > 2**63
    for i, r in got.items():
        assert int(r["deviation_wide"]) == deviations[i]
        assert r["deviation"] == (deviations[i] if deviations[i] < 2**63 else None)


def test_sums_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(w, "FAN_IN", 2)
    table = given(spark, "embeddings").limit(200).repartition(9)
    vectors = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check(spark, vectors, w.whitening_digest(spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(9)))


def test_too_large_to_scale(spark):
    with pytest.raises(Exception, match="too large"):
        w.whitening_digest(frame(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0])])).collect()
