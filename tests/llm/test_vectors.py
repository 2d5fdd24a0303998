"""Whitening against plain numpy, hard negatives against comparing everything."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartulary.llm import negatives, whitening

ODD = [
    (None, [1.0, 2.0, 3.0], 1), (7, None, 1), (8, [1.0, None, 2.0], 1), (9, [1.0, math.nan, 2.0], 1), (10, [math.inf, 0.0, 0.0], 1),
    (11, [], 1), (12, [1.0, 2.0], 1), (13, [0.0, 0.0, 0.0], 2), (13, [0.0, 0.0, 0.0], 2), (14, [0.5, -0.5, 0.25], None),
]


def vectors(seed, many, width):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(many, width)) * np.linspace(1, 3, width) + draw.normal(size=(many, 1))).round(4)


def table_of(spark, rows, columns="vec_id long, embedding array<double>, label int"):
    return spark.createDataFrame(rows, columns).repartition(3)


def whitened_plainly(rows, components):
    """The contract in numpy: rows of (id, vector)."""
    x = np.floor(64 * np.array([v for _, v in rows])).astype(object) + 1_000_000
    n, sums = len(x), x.sum(0)
    gap = n * x - sums
    centred = gap.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, len(values))
    return (gap**2).sum(1), centred @ axes[:, :kept], values[:kept], values / values.sum()


@pytest.mark.parametrize("numbers", [1 << 18, 60])
def test_whitening_equals_numpy(spark, monkeypatch, numbers):
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", numbers)  # few rows a block, so that there are many
    rows = [(k, v.tolist()) for k, v in enumerate(vectors(1, 150, 6))]
    found = whitening.whiten(spark, table_of(spark, [(*r, 1) for r in rows]), components=4).collect()
    assert len(found) == 4 * len(rows)
    deviation, projected, values, shares = whitened_plainly(rows, 4)
    for k in range(4):
        own = {r.vec_id: r for r in found if r.component == k + 1}
        ours = np.array([own[i].whitened for i, _ in rows])
        plain = projected[:, k] / np.sqrt(values[k])
        assert np.allclose(ours * np.sign(ours @ plain), plain, atol=1e-9)
        assert all(math.isclose(r.explained, shares[k], rel_tol=1e-9) and r.n == 150 and r.identity_error < 1e-9 for r in own.values())
        assert [own[i].deviation for i, _ in rows] == deviation.tolist()


def test_whitening_of_awkward_rows(spark):
    rows = [(100 + k, v.tolist(), 1) for k, v in enumerate(vectors(2, 20, 3))] + ODD
    table = table_of(spark, [(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label int, n string, index int")
    found = whitening.whiten(spark, table).collect()
    # A null id, zero vectors and repeated rows take part, each row for itself.
    part = [(i, v) for i, v, _ in rows if v is not None and len(v) == 3 and all(c is not None and math.isfinite(c) for c in v)]
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in found if r.component == 1) == sorted((i is None, i or 0) for i, _ in part)
    assert {r.n for r in found} == {len(part)} and {r.component for r in found} == {1, 2, 3}
    deviation, *_ = whitened_plainly(part, 3)
    assert sorted(r.deviation for r in found if r.component == 2) == sorted(deviation.tolist())
    assert max(r.identity_error for r in found) < 1e-9


def test_whitening_without_variance(spark):
    same = whitening.whiten(spark, table_of(spark, [(k, [1.0, 2.0], 1) for k in range(4)])).collect()
    assert len(same) == 8 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)
    flat = whitening.whiten(spark, table_of(spark, [(k, [float(k), 2.0], 1) for k in range(4)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and max(r.identity_error for r in flat) < 1e-9
    huge = whitening.whiten(spark, table_of(spark, [(k, [k * 2.0**40, 1.0], 1) for k in range(3)])).collect()
    assert {r.deviation for r in huge if r.vec_id != 1} == {None}
    assert {r.deviation_exact for r in huge if r.vec_id == 2} == {(3 * 2**46) ** 2}


def test_whitening_of_nothing(spark):
    assert whitening.whiten(spark, table_of(spark, [(1, None, 1)])).count() == 0
    assert whitening.whiten(spark, table_of(spark, [(1, [1.0], 1)]).limit(0)).count() == 0


def mined_plainly(rows, positives=5, negatives_=10):
    known = {(i, tuple(math.floor(256 * c) for c in v), l) for i, v, l in rows
             if i is not None and l is not None and v and all(c is not None and math.isfinite(c) for c in v)}
    found = []
    for anchor, a, label in known:
        if anchor % 10:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(a, x, strict=True)), i, l) for i, x, l in known if i != anchor and len(x) == len(a)
        )
        for high, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 30 * -high <= 100 * -s[0] <= 90 * -high]
            found += [(anchor, positive, rank + 1, i, -high, -s) for rank, (s, i, _) in enumerate(inside[:negatives_])]
    return found


def mined(spark, rows, **parameters):
    table = table_of(spark, [(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label int, square string, score int")
    found = negatives.mine(spark, table, F.col("vec_id") % 10 == 0, **parameters)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("parameters", [{}, {"block": 30, "share": 7, "sample": 40}, {"block": 50, "sample": 0}])
def test_negatives_equal_comparing_everything(spark, parameters):
    draw = np.random.default_rng(5)
    near = np.repeat(vectors(3, 40, 5), 6, axis=0) + draw.normal(0, 0.05, (240, 5))
    near[::9] *= 4  # several buckets of lengths
    near[7::31] = near[7]  # ties
    rows = [(k, v.round(3).tolist(), k // 12 % 3) for k, v in enumerate(near)] + [(300 + k, [1.0, float(k)], k % 2) for k in range(30)]
    expected = sorted(mined_plainly(rows))
    assert len(expected) > 200 and mined(spark, rows, **parameters) == expected


def test_negatives_of_awkward_rows(spark):
    rows = ODD + [(20, [1.0, 1.0, 0.5], 1), (21, [0.5, 0.5, 0.0], 2), (22, [1.0, 0.9, 0.5], 1), (20, [1.0, 1.0, 0.5], 1), (30, [0.0, 0.0, 0.0], 2),
                  (40, [-1.0, 0.2, 0.0], 2), (20, [0.4, 0.4, 0.4], 3), (50, [0.3, 0.3, 0.3], 9)]
    assert mined(spark, rows) == sorted(mined_plainly(rows))
    assert mined(spark, [(20, [1e300, 1.0], 1), (21, [1.0, 1.0], 2)]) == mined(spark, [(1, None, None)]) == []
    assert negatives.mine(spark, table_of(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_coordinate_ranges_lose_nothing_and_prune():
    draw = np.random.default_rng(8)
    x = draw.normal(size=(3000, 6))
    x = np.floor(1000 * x / np.sqrt((x**2).sum(1))[:, None]).astype(np.int32)  # lengths of one bucket
    block = negatives.Block(np.arange(3000), np.zeros(3000, np.int64), x)
    looked = 0
    for anchor in x[:40]:
        score = x.astype(np.int64) @ anchor.astype(np.int64)
        for least in (int(np.sort(score)[-5]), int(np.sort(score)[-300]), 0, int(score.min())):
            rows = block.candidates(anchor, least)
            every = np.arange(3000) if rows is None else rows
            assert np.isin(np.flatnonzero(score >= least), every).all()
            assert (block.scores(anchor, rows) == score[every]).all()
            looked += len(every) if least == int(np.sort(score)[-5]) else 0
    assert looked < 0.2 * 40 * 3000
