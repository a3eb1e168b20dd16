import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycard.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, weights int, number string, wide int, v int"


def made(spark, rows):
    """(vec_id, label, vector); the other columns clash with the operator's own names."""
    return spark.createDataFrame([(i, v, label, "x", 1, "y", 2, 3) for i, label, v in rows], SCHEMA)


def cut(number):
    return min(max(number, -(2**63)), 2**63 - 1)


def brute(rows, positives=5, count=5, low=80, high=100):
    usable = [
        (i, label, tuple(cut(math.floor(256 * x)) for x in v))
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in {row for row in usable if row[0] % 100 == 0}:
        scored = sorted(
            (-cut(sum(a * b for a, b in zip(v, w))), j, other == label) for j, other, w in usable if j != i
        )
        for score, j, _ in [row for row in scored if row[2]][:positives]:
            within = [row for row in scored if not row[2] and low * -score <= 100 * -row[0] <= high * -score]
            out += [(i, j, rank, k, -score, -s) for rank, (s, k, _) in enumerate(within[:count], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    usable = negatives.quantised(made(spark, rows))
    found = negatives.hard_negatives(usable.where(F.col("id") % 100 == 0), usable, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def random_rows(count, seed, width=24):
    rng = np.random.default_rng(seed)
    vectors = np.round(rng.normal(size=(count, width)) + 1, 1)
    return [(int(i), int(rng.integers(3)), v.tolist()) for i, v in enumerate(vectors)]


EDGES = [
    (0, 1, [0.5, -0.25, 1.0]), (100, 1, [0.5, 0.5, 0.5]), (100, 1, [0.5, 0.5, 0.5]), (100, 2, [0.5, 0.5, 0.5]),
    (1, 1, [0.1, 0.2, 0.3]), (2, 2, [0.1, 0.2, 0.3]), (3, 2, [0.1, 0.2, 0.3]), (4, 2, []), (5, 2, [2.0]), (6, 2, None),
    (7, 1, [1.0, None, 1.0]), (8, 2, [float("nan"), 1.0, 1.0]), (9, 2, [float("inf"), 1.0, 1.0]), (None, 2, [1.0] * 3),
    (10, None, [1.0] * 3), (200, 3, [0.0] * 3), (11, 2, [0.25, 0.5, -0.125, 4.0]), (12, 1, [0.1, 0.2, 0.3]),
    (12, 1, [0.1, 0.2, 0.3]), (3, 2, [0.1, 0.2, 0.3]), (300, 1, [1e300, -1e300]), (13, 2, [0.45, 0.5, 0.5]),
]


@pytest.mark.parametrize("options", [{}, {"anchor_block": 1, "row_block": 3}])
def test_equals_brute_force(spark, options):
    for rows in (EDGES, random_rows(450, 1)):
        expected = brute(rows)
        assert expected and mined(spark, rows, **options) == expected


def test_tiles_of_many_sizes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_TILE", 2)
    monkeypatch.setattr(negatives, "CANDIDATE_TILE", 37)
    monkeypatch.setattr(negatives, "LEAF", 1)
    rows = random_rows(301, 2, width=7)
    assert mined(spark, rows, positives=3, negatives=7, low=50, high=90) == brute(rows, 3, 7, 50, 90)


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 33, 65), (100, 64, 70), (128, 64, 256), (31, 5, 200)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(0)
    rows, inner, columns = shape
    left = rng.integers(-(2**28), 2**28, size=(rows, inner))
    right = rng.integers(-(2**28), 2**28, size=(inner, columns))
    assert np.array_equal(negatives.strassen(left, right), left @ right)
    large = left.astype(object) * 2**40
    assert np.array_equal(negatives.strassen(large, right.astype(object)), large @ right.astype(object))


def test_scores_beyond_64_bits(spark):
    rows = [(0, 1, [1e15, 1e15]), (1, 1, [1e15, -1e15]), (2, 1, [1e18, 1e18]), (3, 2, [1e18, 1e17]), (4, 2, [-1e18, 0.0])]
    assert mined(spark, rows) == brute(rows)


def test_heaps_merge_like_one():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 9, 200), np.sort(rng.integers(0, 90, 200))
    heap = negatives.BestRows(5)
    for part in np.array_split(np.arange(200), 13):
        heap.merge(scores[part], ids[part])
    assert heap.rows() == sorted(zip(scores.tolist(), ids.tolist()), key=lambda row: (-row[0], row[1]))[:5]


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0])]) == []
