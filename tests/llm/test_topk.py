"""Bounds, floors and wide numbers of the top-k search."""

from __future__ import annotations

import numpy as np
import pytest

from disclosure_spark.llm import topk

G = np.random.default_rng(10)


def made(n, dims, spread=600):
    data = G.integers(-spread, spread, (n, dims))
    one = np.ones(n, np.int64)
    return topk.Block(np.arange(n), one * dims, one, data, topk.cuts_of(data))


@pytest.mark.parametrize("floor", ["none", "reached", "above"])
def test_candidates_hold_the_best(floor):
    block, q = made(900, 12), G.integers(-600, 600, (50, 12)).astype(float)
    scores = q @ block.data.T
    tenth = np.sort(scores, axis=1)[:, -10]
    floors = {"none": np.full(50, -np.inf), "reached": tenth, "above": scores.max(1) + 1}[floor]
    left = topk.candidates(block, q, np.zeros((50, 900), bool), floors, 10, list(topk._read(block)))
    best = scores >= np.maximum(tenth, floors)[:, None]
    assert (left | ~best).all()
    assert left.mean() < 0.2  # reading stops before all are resolved
    if floor == "above":
        far = topk.candidates(block, q, np.zeros((50, 900), bool), np.full(50, 1e12), 10, list(topk._read(block)))
        assert not far.any()


def brute(vectors, k=10):
    whole = [(i, [int(np.floor(1024 * float(c))) for c in v]) for i, v in vectors]
    out = []
    for i, q in whole:
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in whole if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 3e5, 1e6])
def test_blocks_with_floors(spark, scale):
    """Scores of a million and more do not fit into doubles; those of the last scale hardly into longs."""
    vectors = [(i, (G.uniform(-1, 1, 8) * scale).tolist()) for i in range(700)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = topk.top_k(df, block=60, queries=3).collect()
    assert sorted(map(tuple, got)) == brute(vectors)


def test_scores_that_are_no_longs(spark):
    rows = [(0, [3e12, 3e12]), (1, [3e12, 3e12]), (2, [1.0, 1.0])]
    with pytest.raises(Exception, match="too large for a long"):
        topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    with pytest.raises(Exception, match="too large for a long"):
        topk.top_k(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")).collect()
    # Large ones that do not come into a result do no harm.
    rows = [(i, [2e6 + i, 2e6 + i]) for i in range(10, 21)] + [(100, [1e6, 1e6]), (7, [-4e9, -4e9])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == brute(rows)
