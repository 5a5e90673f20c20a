"""Whitening against a plain eigendecomposition in one place."""

import math
from collections import defaultdict

import numpy as np
import pytest

from veristream.llm import whitening as wh

DDL = "vec_id long, embedding array<float>, label int, d int, x string, n long, component string"


def brute(data, components=16):
    """(vec_id, component) -> n, deviation, |whitened|, explained; rows of one length."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, *_ in data
            if v and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, total = len(fit), fit.sum(0)
    centred = np.array((fit * n - total) / n, dtype=float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = defaultdict(list)
    for i, x in kept:
        gap = [n * a - int(s) for a, s in zip(x, total)]
        y = np.array(gap, float) / n @ vectors
        for k in range(min(components, len(x))):
            some = values[k] > wh.NONE * values.sum()
            out[i, k + 1].append((n, sum(g * g for g in gap), abs(y[k] / math.sqrt(values[k])) if some else 0.0, values[k] / values.sum() if some else 0.0))
    return out


def check(df, data, components=16, tolerance=1e-7):
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = defaultdict(list)
    for r in df.collect():
        got[r["vec_id"], r["component"]].append((r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
        assert 0 <= r["identity_error"] <= 1e-9
    want = brute(data, components)
    assert got.keys() == want.keys()
    for key in want:
        for a, b in zip(sorted(got[key]), sorted(want[key]), strict=True):
            assert a[:2] == b[:2], key
            assert a[2] == pytest.approx(b[2], rel=tolerance, abs=tolerance) and a[3] == pytest.approx(b[3], rel=1e-9, abs=1e-12), key


def vectors(n, d, seed=1):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, d)) * np.exp(-np.arange(d) / 6) @ np.linalg.qr(r.standard_normal((d, d)))[0]
    return [(i, [float(c) for c in v], 1, 2, "x", 3, "c") for i, v in enumerate(x)]


AWKWARD = [(1000, None), (1001, []), (1002, [float("nan")] * 24), (1003, [float("inf")] * 24), (1004, [None] + [1.0] * 23), (None, [0.5] * 24), (1005, [0.0] * 24)]


def test_whiten(spark):
    data = vectors(700, 24) + [(i, v, 1, 2, "x", 3, "c") for i, v in AWKWARD]
    data += [(5, v, 0, 0, "y", 0, "c") for _, v, *_ in data[:3]] + [data[8]] * 400
    check(wh.whiten(spark.createDataFrame(data, DDL).repartition(5)), data)


@pytest.mark.parametrize("n,d", [(1, 5), (2, 5), (4, 20), (50, 1), (40, 3)])
def test_few(spark, n, d):
    data = vectors(n, d, seed=n)
    df = wh.whiten(spark.createDataFrame(data, DDL))
    if n == 1:
        assert {(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in df.collect()} == {(0.0, 0.0, 0, 0.0)}
    else:
        check(df, data, tolerance=1e-6)


def test_lengths_apart_and_none(spark):
    short, long = vectors(60, 4), [(i + 500, *x) for i, *x in vectors(80, 9, seed=3)]
    df = wh.whiten(spark.createDataFrame(short + long, DDL))
    check(df.where("vec_id < 500"), short)
    check(df.where("vec_id >= 500"), long)
    assert wh.whiten(spark.createDataFrame([], DDL)).collect() == []
    assert wh.whiten(spark.createDataFrame([(1, None, 1, 1, "", 1, "")], DDL)).collect() == []


@pytest.mark.parametrize("kind", ["plain", "whole", "constant", "repeated", "scaled", "diagonal"])
@pytest.mark.parametrize("d", [1, 2, 7, 33])
def test_updates_and_merges(kind, d):
    r = np.random.default_rng(d)
    x = r.standard_normal((90, d))
    x = {"plain": x, "whole": np.floor(3 * x) + 1e6, "constant": x * (np.arange(d) > d // 2), "repeated": np.repeat(x[:4], 9, 0),
         "scaled": x * 10.0 ** -np.arange(d).clip(0, 9), "diagonal": np.concatenate([np.eye(d)] * 3)}[kind]
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    parts = [wh.Spectrum.empty(d) for _ in range(4)]
    for k, v in enumerate(x):
        parts[0].add(v)
        parts[1 + k % 3].add(v)
    parts[1].merge(parts[2])
    parts[1].merge(parts[3])
    for s in parts[:2]:
        near = lambda a, b: np.abs(a - b).max() <= 1e-9 * max(1.0, np.abs(want).max())
        assert s.n == len(x) and near(s.mean, x.mean(0)) and near(s.basis @ np.diag(s.values) @ s.basis.T, want)
        assert np.abs(s.basis.T @ s.basis - np.eye(d)).max() < 1e-11 and (np.diff(s.values) >= 0).all()


def test_secular_roots_interlace():
    r = np.random.default_rng(6)
    for _ in range(200):
        k = int(r.integers(1, 30))
        d, z = np.sort(r.random(k)) + 1e-6 * np.arange(k), r.standard_normal(k) * 10.0 ** r.integers(-5, 2, k)
        z[z == 0] = 1
        rho = float(10.0 ** r.integers(-3, 4))
        z /= np.linalg.norm(z)
        origin, shift = wh.secular(d, z * z, rho)
        roots = d[origin] + shift
        assert (roots >= d).all() and (roots[:-1] <= d[1:]).all() and roots[-1] <= d[-1] + rho * (1 + 1e-12)
        assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z)), rtol=1e-11, atol=1e-11 * max(rho, 1))


def test_deviations_are_exact_or_null():
    for n, scale in ((3, 10), (10**9, 100), (10**10, 40), (10**12, 10**4), (7, 2**40)):
        x = np.random.default_rng(n % 97).integers(-scale, scale, (50, 6))
        total = [int(v) * (n // 50) for v in x.sum(0)]
        got = wh.deviations(x, n, np.array(total, np.int64 if max(map(abs, total)) < 2**62 else object))
        for row, g in zip(x, got):
            exact = sum((n * int(a) - t) ** 2 for a, t in zip(row, total))
            assert g == (exact if exact < 2**63 else None)
