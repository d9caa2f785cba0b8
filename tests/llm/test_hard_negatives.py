import numpy as np
import pytest

from turnout.llm import hard_negatives as module
from turnout.llm.hard_negatives import (
    Bounds,
    angles,
    best_in_windows,
    coded,
    hard_negatives,
    matrix_of,
    norms,
    parts_of,
    references,
    whole_scores,
)

MOST = (1 << 63) - 1


def whole(x):
    numerator, denominator = float(x).as_integer_ratio()
    return 256 * numerator // denominator


def brute(rows, every=100, positives=5, negatives=10):
    used = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        used.append((i, [whole(x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for n, (i, a, label) in enumerate(used):
        if i % every:
            continue
        scored = []
        for m, (j, b, other) in enumerate(used):
            score = sum(x * y for x, y in zip(a, b))
            scored.append((-max(-MOST - 1, min(MOST, score)), j, other, m))
        scored.sort(key=lambda s: s[:2])
        same = [s for s in scored if s[2] == label and s[3] != n][:positives]
        for p, j, _, _ in same:
            fit = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            for rank, (s, m, _, _) in enumerate(fit[:negatives], 1):
                out.append((i, j, rank, m, -p, -s))
    return sorted(out)


def got(spark, rows, element="float", **options):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{element}>, label int")
    frame = frame.selectExpr("*", "1 as id", "2 as class", "3 as score", "4 as block", "5 as code")
    return sorted(tuple(r) for r in hard_negatives(frame, **options).collect())


def single(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]


def random_rows(seed, count, dimensions=8):
    rng = np.random.default_rng(seed)
    center = rng.standard_normal((6, dimensions))
    kind = rng.integers(0, 6, count)
    v = center[kind] + 0.6 * rng.standard_normal((count, dimensions))
    label = (kind + (rng.random(count) < 0.3)) % 10
    return single([(i, x, int(y)) for i, (x, y) in enumerate(zip(v.tolist(), label))])


@pytest.mark.parametrize("block", [1 << 13, 20])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK", block)
    rows = random_rows(block, 400)
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(60)]  # equal vectors, anchors among them
    rows += [(1100 + i, rows[3][1], 9) for i in range(30)]
    rows += [(1200, [0.0] * 8, 3), (1201, [0.0] * 8, 3), (1202, [-0.0] * 8, 4), (1300, [], 3), (1301, [1.0], 3)]
    rows += [(1400, [1.0] * 11, 2), (None, rows[0][1], 1), (1500, None, 1), (1600, rows[1][1], None)]
    rows += [(1700, [None] + [1.0] * 7, 1), (1800, [float("nan")] * 8, 1), (1900, [float("inf")] * 8, 1)]
    rows += [rows[0], rows[0], (0, rows[5][1], rows[0][2]), (100, rows[9][1], 7)]  # repeated rows and ids
    rows += [(-100, rows[2][1], -13), (-7, rows[4][1], -3)]
    rows = single(rows)
    expected = [r for r in brute([(i, v, None if y is None else y) for i, v, y in rows if y is None or y >= 0])]
    assert got(spark, [r for r in rows if r[2] is None or r[2] >= 0]) == expected
    assert len(expected) > 100
    assert got(spark, rows, every=10, positives=3, negatives=4)


def test_large_and_tiny_components(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(60):
        scale = [1e-300, 1e-3, 1.0, 1e7, 1e12, 1e160, 1e300][i % 7]
        rows.append((i, (rng.standard_normal(4) * scale).tolist(), i % 2))
    rows.append((60, [float(np.finfo(float).max), 1.0, -5e-324, 0.0], 1))
    assert got(spark, rows, "double", every=5) == brute(rows, every=5)


def test_few_rows_and_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 1)]) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.5, 1.0], 1)]
    assert got(spark, rows) == brute(rows) == []  # id 0 takes the label 2
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (2, [0.5, 0.0], 4), (3, [0.3, 1.0], 3)]
    assert got(spark, rows) == brute(rows) == [(0, 1, 1, 2, 65536, 32768)]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(3)
    for dimensions in (1, 2, 5, 64):
        v = np.floor(256 * rng.standard_normal((300, dimensions))) / 256
        v[:5] = v[10:15]
        v[5] = -v[15]
        v[6] = 0
        directions = references(v[:50], module.REFERENCES)
        bounds = Bounds(norms(v), angles(v, directions))
        low, high = bounds.between(bounds)
        score = np.array([whole_scores(x, v) for x in v])
        assert (low <= score).all() and (score <= high).all()
    # Directions of the data's own clusters rule many pairs out.
    center = np.eye(16)[rng.integers(0, 4, 400)]
    v = np.floor(256 * (center + 0.01 * rng.standard_normal((400, 16)))) / 256
    bounds = Bounds(norms(v), angles(v, references(v[:100], module.REFERENCES)))
    low, high = bounds.between(bounds)
    assert (high < 30000).mean() > 0.7


def test_only_overlapping_rows_are_scored(monkeypatch):
    rng = np.random.default_rng(5)
    center = np.eye(16)[rng.integers(0, 8, 2000)]
    v = np.floor(256 * (center + 0.01 * rng.standard_normal((2000, 16)))) / 256
    bounds = Bounds(norms(v), angles(v, references(v[:200], module.REFERENCES)))
    low, high = bounds.between(Bounds(bounds.norm[:1], bounds.angle[:1]))
    scored = []
    real = whole_scores
    monkeypatch.setattr(module, "whole_scores", lambda a, m: scored.append(len(m)) or real(a, m))
    found = best_in_windows(
        v[0], v, np.arange(2000), low[:, 0], high[:, 0], np.ones(2000, bool), [(40000, None), (-9, 9)], 6
    )
    score = real(v[0], v)
    order = np.lexsort((np.arange(2000), -score))
    for (lo, hi), best in zip([(40000, MOST), (-9, 9)], found):
        assert best == [(int(score[i]), int(i)) for i in order if lo <= score[i] <= hi][:6]
    assert sum(scored) < 2000


def test_codes_are_exact():
    v = np.array([0.1, -0.1, 127.9, -127.0, 0.0, -0.0])
    assert coded(v)[:1] == b"\x02" and len(coded(v)) == 13
    large = np.array([1e300, -3.7, 2.0**44, 1e-300, -1e-300])
    assert [whole(x) for x in parts_of(coded(large))] == [whole(x) for x in large]
    assert matrix_of([coded(v), b"\x02"]).shape == (2, 6)
    assert matrix_of([]).shape == (0, 0)
