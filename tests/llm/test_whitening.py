"""Whitening against numpy on the same vectors, and the cases its docstring names."""

import numpy as np
import pytest

from tidewell.llm.queries import op11_embedding_whitening
from tidewell.llm.whitening import whiten

SF = "/root/testdata/sf0.01"


def brute(vectors):
    """{component: (unit vector, eigenvalue, share)}, sums and n of the distinct whole vectors."""
    fit = sorted({tuple(int(np.floor(256 * float(c))) for c in v) for v in vectors})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    rows = np.array(fit, float) - np.array(sums) / n
    values, units = np.linalg.eigh(rows.T @ rows / n)
    order = np.argsort(-values)
    return n, sums, values[order], units[:, order].T, float((rows * rows).sum() / n)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, x string, whitened double, n int")


def check(got, rows, k):
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, sums, values, units, total = brute([v for _, v in usable])
    assert len(got) == k * len(usable)
    expected = {}
    for i, v in usable:
        x = [int(np.floor(256 * float(c))) for c in v]
        far = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        expected.setdefault(i, []).append((far, (units[:k] @ (np.array(x) - np.array(sums) / n)) / np.sqrt(values[:k])))
    signs = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained - values[r.component - 1] / total) <= 1e-9 * r.explained
        near = [w[r.component - 1] for far, w in expected[r.vec_id] if far == r.deviation]
        assert near and min(abs(abs(a) - abs(r.whitened)) for a in near) < 1e-8
        if len(near) == 1 and abs(near[0]) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(near[0] * r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(op11_embedding_whitening(spark, SF).collect(), rows, 4)


def test_unusable_repeated_and_tied_rows(spark):
    pick = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in pick.normal(0, 0.3, 6)]) for i in range(40)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (50, None), (51, [1.0, None, *[0.0] * 4]), (52, [float("nan")] * 6), (53, [float("inf")] + [0.0] * 5), (54, rows[0][1])]
    check(whiten(table(spark, rows)).collect(), rows, 4)


@pytest.mark.parametrize(("rows", "components"), [([], 0), ([(1, None)], 0), ([(1, [1.0, 2.0])] * 3, 0), ([(1, [1.0, 2.0]), (2, [3.0, 4.0])], 1), ([(1, []), (2, [])], 0)])
def test_too_little_variance(spark, rows, components):
    got = whiten(table(spark, rows)).collect()
    assert len(got) == components * len(rows)
    assert all(abs(abs(r.whitened) - 1) < 1e-9 and abs(r.explained - 1) < 1e-9 for r in got)


def test_lengths_differ_and_numbers_are_large(spark):
    got = whiten(table(spark, [(1, [1.0]), (2, [1.0, 1.0]), (3, [])]), 2).collect()
    assert {(r.vec_id, r.component) for r in got} == {(i, c) for i in (1, 2, 3) for c in (1, 2)}
    got = whiten(table(spark, [(1, [1e12, 0.0]), (2, [-1e12, 1.0])])).collect()
    assert len(got) == 2 and all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-9 for r in got)
