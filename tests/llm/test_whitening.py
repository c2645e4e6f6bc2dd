"""Whitening against a dense symmetric eigensolver, exact whole-number sums, edge cases."""

from fractions import Fraction

import numpy as np
import pytest

from conftest import SF_SMALL
from logstream.llm.queries import QUERIES
from logstream.llm.whitening import Spectrum, leading, whiten


def spectrum_of(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize("values", [
    list(range(40, 0, -1)), [5.0], [3, 2], [1e8, 1, 1e-3] + [1e-7] * 5,
    [10 - 1e-9 * i for i in range(30)], [7, 7, 7, 2, 2, 1], [1e-9, 1e-10, 1e-11]])
def test_eigenpairs_and_their_numbers(values):
    v = spectrum_of(values)
    v = (v + v.T) / 2
    e, x = leading(v, 16)
    want = np.sort(np.linalg.eigvalsh(v))[::-1][:len(e)]
    assert np.abs(e - want).max() <= 1e-13 * want[0]
    assert len(e) == min(16, sum(w > 1e-12 * sum(values) for w in values))
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-6 and np.abs(
        np.linalg.norm(x, axis=0) - 1).max() < 1e-14
    assert np.abs(v @ x - x * e).max() < 1e-12 * want[0]


def test_inertia_counts():
    values = [9.0, 4.0, 4.0, 1.0, 0.0, -2.0]
    s = Spectrum(spectrum_of(values, 3))
    for shift in (-3, -1, 0.5, 2, 5, 10):
        assert s.at_least(shift) == sum(x >= shift for x in values)
    low, high, alone = s.enclose(1)
    assert alone and low <= 9 <= high
    assert not s.enclose(2)[2]


def brute(rows):
    """Whole numbers, fit list and covariance, in exact arithmetic as far as it goes."""
    x = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(v, sums)] for v in fit])
    return x, n, sums, c, c.T @ c / n


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "e") for i, v in rows],
                                 "vec_id long, embedding array<float>, __x string")


def test_rows_against_brute_force(spark):
    rng = np.random.default_rng(4)
    good = [(i, (rng.normal(size=24) * np.linspace(3, 0.2, 24)).astype(np.float32).tolist())
            for i in range(300)]
    good += [(7, good[7][1]), (None, good[9][1]), (1000, [0.0] * 24), (1001, [1e-9] * 24)]
    bad = [(2000, None), (2001, []), (2002, [None] + [1.0] * 23), (2003, [float("nan")] * 24),
           (2004, [float("inf")] + [0.0] * 23), (2005, [1.0] * 23)]
    got = whiten(frame(spark, good + bad)).collect()
    x, n, sums, c, v = brute(good)
    assert sorted((r["__id"] is None, r["__id"] or 0) for r in got) == sorted(
        (i is None, i or 0) for i, _ in good)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    by_id = {i: w for i, w in x}
    z = {i: (np.array([float(Fraction(n * a - b, n)) for a, b in zip(w, sums)]) @ u) / np.sqrt(e)
         for i, w in x}
    sign = None
    for r in got:
        assert r["__n"] == n
        assert r["__deviation"] == sum((n * a - b) ** 2 for a, b in zip(by_id[r["__id"]], sums))
        assert np.allclose(r["__explained"], e / np.trace(v), rtol=1e-9)
        assert r["__identity_error"] < 1e-9
        own = np.array(r["__whitened"])
        if sign is None and np.abs(z[r["__id"]]).min() > 1e-3:
            sign = np.sign(own * z[r["__id"]])
    for r in got:
        assert np.allclose(np.array(r["__whitened"]) * sign, z[r["__id"]], atol=1e-8)


def test_fewer_dimensions_than_components(spark):
    rows = [(i, [float(i), float(2 * i), 0.0]) for i in range(10)]
    got = whiten(frame(spark, rows)).collect()
    assert {len(r["__whitened"]) for r in got} == {1} and len(got) == 10
    assert abs(np.var([r["__whitened"][0] for r in got]) - 1) < 1e-12


def test_tables_without_a_spread(spark):
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None)])).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_query_over_the_table(spark):
    rows = QUERIES["op13_whitening"](spark, SF_SMALL).collect()
    ids = {r["vec_id"] for r in rows}
    assert len(rows) == 16 * spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    assert {r["component"] for r in rows} == set(range(1, 17)) and len(ids) * 16 == len(rows)
    assert max(r["identity_error"] for r in rows) <= 1e-4
    share = {r["component"]: r["explained"] for r in rows}
    assert all(share[i] >= share[i + 1] for i in range(1, 16)) and sum(share.values()) <= 1
