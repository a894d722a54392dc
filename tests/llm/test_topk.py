import numpy as np
import pytest
from pyspark.sql import functions as F

from microlake.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    from math import floor, isfinite

    kept = sorted({(i, tuple(floor(256 * float(np.float32(x))) for x in v)) for i, v, _ in rows if i is not None and v and all(x is not None and isfinite(x) for x in v)})
    out = []
    for q, v in kept:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in kept if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, **more):
    return sorted(tuple(r) for r in K.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, **more).collect())


@pytest.mark.parametrize("rows_a_shard", [70, 10_000])
def test_against_brute_force(spark, monkeypatch, rows_a_shard):
    monkeypatch.setattr(K, "LEAF", 8)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 8))
    rows = [(i, (centres[i % 6] + 0.2 * rng.standard_normal(8)).astype(np.float32).tolist(), 0) for i in range(320)]
    rows += [(400 + i, rows[0][1], 1) for i in range(9)] + [rows[7], (None, rows[1][1], 0), (600, None, 0), (601, [1.0, None] * 4, 0), (602, [float("nan")] * 8, 0), (603, [float("inf")] * 8, 0)]
    rows += [(604, [], 0), (650, [1.0, 2.0], 0), (651, [0.5, -2.0], 0), (700, [0.0] * 8, 0)]
    assert run(spark, rows, rows_a_shard=rows_a_shard) == brute(rows)


def test_few_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 0)]) == []
    rows = [(0, [1.0, -1.0], 0), (1, [2.0, 1.0], 0), (50, [-3.0, 1.0], 0)]
    assert run(spark, rows) == brute(rows)


def test_branch_and_bound_leaves_nodes_out():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * (10 * rng.standard_normal((40, 1, 4)) + 0.01 * rng.standard_normal((40, 100, 4)))).astype(np.int64).reshape(-1, 4)
    tree, seen = K.BallTree(np.arange(len(rows)), rows), []
    true = K._dot
    try:
        K._dot = lambda a, b: (seen.append(len(b)), true(a, b))[1]
        ids, scores = tree.search(np.array([-5]), rows[:1], 5, np.array([np.iinfo(np.int64).min]))
    finally:
        K._dot = true
    assert sum(seen) < len(rows) / 4
    want = sorted((-int(s), i) for i, s in enumerate(rows @ rows[0]))[:5]
    assert [(-int(s), int(i)) for i, s in zip(ids[0], scores[0], strict=True)] == want


def test_far_shards_are_never_sent(spark, monkeypatch):
    monkeypatch.setattr(K, "QUERIES_A_BLOCK", 4)
    rng = np.random.default_rng(5)
    centres = 20 * rng.standard_normal((12, 6))
    rows = [(i, (centres[i % 12] + 0.05 * rng.standard_normal(6)).astype(np.float32).tolist(), 0) for i in range(1200)]
    counts = {}
    assert run(spark, rows, rows_a_shard=40, counts=counts) == brute(rows)
    assert counts["searched"] < counts["pairs"] / 3


def test_sums_beyond_64_bits_are_an_error():
    big = np.full((1, 4), 2**31, np.int64)
    with pytest.raises(OverflowError):
        K._dot(big, big)
    assert K._dot(big[:, :1], big[:, :1])[0, 0] == 2**62


def test_components_of_any_size(spark):
    """Among usual vectors, ones whose products are beyond 64 bits, or cancel out there."""
    from math import floor, isfinite

    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    rows += [(50, [1e38, 1e38, 0.0]), (51, [-1e38, 2e38, 5.0]), (52, [1e17, 0.0, 1.0]), (53, [1e17, -1e17, 1e17]), (100, [1e17, 1e17, 0.0]), (101, [9e6, 9e6, 9e6]), (150, [-1e38, -1e38, -1e38])]
    rows += [(54, [1e38, 1e38, 0.0]), (55, [1e38, 1.0, 0.0]), (56, [1e300, -1e300, 0.0]), (57, [1e307, 0.0, 0.0]), (200, [1.0, 0.0, 0.0])]
    got = K.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    kept = [(i, [int(floor(256 * x)) for x in v]) for i, v in rows if all(isfinite(256 * x) for x in v)]
    expected = []
    for q, v in kept:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in kept if i != q)[:5]
            expected += [(q, n + 1, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_wide_scores_are_in_order():
    values = [-(10**90), -(2**63) - 1, -(2**63), -5, 0, 7, 2**63 - 2, 2**63 - 1, 2**63, 10**80]
    assert sorted(reversed(values), key=K.wide) == values
