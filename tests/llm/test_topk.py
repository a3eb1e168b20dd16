import math

import pytest
from pyspark.sql import functions as F

from tallycard.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, terms int, score string"


def made(spark, rows):
    """(vec_id, vector); the other columns clash with the operator's own names."""
    return spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], SCHEMA)


def brute(rows, k, scale=1024):
    usable = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, v in {(i, tuple(v)) for i, v in usable if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i)[:k]
        out += [(i, rank, j, -score) for rank, (score, j) in enumerate(scored, 1)]
    return sorted(out)


def search(spark, rows, k, **blocks):
    vectors = topk.quantised(made(spark, rows))
    found = topk.top_k(vectors.where(F.col("id") % 100 == 0), vectors, k, **blocks)
    return sorted(map(tuple, found.collect()))


ROWS = [
    (0, [0.5, -0.25, 1.0]), (100, [0.5, 0.5, 0.5]), (100, [0.5, 0.5, 0.5]), (1, [0.1, 0.2, 0.3]),
    (2, [0.1, 0.2, 0.3]), (3, [0.1, 0.2, 0.3]), (4, []), (5, [2.0]), (6, None), (7, [1.0, None, 1.0]),
    (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
    (10, [-3.0, 0.0, 0.0]), (200, [0.0, 0.0, 0.0]), (11, [0.25, 0.5, -0.125, 4.0]),
]


@pytest.mark.parametrize("k, blocks", [(3, {}), (3, {"query_block": 1, "candidate_block": 2}), (50, {})])
def test_equals_brute_force(spark, k, blocks):
    found = search(spark, ROWS, k, **blocks)
    assert found == brute(ROWS, k)


def test_sums_beyond_64_bits_are_exact_and_cut_off(spark):
    rows = [(0, [1e15, 1e15]), (1, [1e15, -1e15]), (2, [1e18, 1e18]), (3, [-1e18, -1e18])]
    found = search(spark, rows, 3)
    assert [row[2] for row in found] == [2, 1, 3]
    assert [row[3] for row in found] == [2**63 - 1, 0, -(2**63)]


def test_empty_tables(spark):
    assert search(spark, [], 3) == []
    assert search(spark, [(0, [1.0])], 3) == []
