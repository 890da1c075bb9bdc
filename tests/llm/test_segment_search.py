import math

import numpy as np
import pytest

from sunset_engine.llm import segment_search as S

SCHEMA = "vec_id long, embedding array<double>, label int, g int, ids string"


def brute(rows, asked, k):
    good = [(i, np.floor(256 * np.array(v))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in asked if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}:
        q = np.floor(256 * np.array(q))
        scores = sorted((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(4096, 1024, 512), (16, 4, 8)])
def test_matches_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("VECTOR_BLOCK", "QUERY_BLOCK", "SLICE"), sizes):
        monkeypatch.setattr(S, name, value)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=24) * 0.3).round(1).tolist()) for i in range(300)]                    # many ties
    rows += [(1000 + i, rows[5][1]) for i in range(9)] + [(5, rows[5][1])]
    nan = float("nan")
    rows += [(2000, None), (2050, []), (2100, [nan] * 24), (2150, [None] * 24), (None, rows[1][1]), (2200, [1.0, 2.0]), (2201, [0.5, -1.0]), (2250, [1e9] * 24), (2300, [-1e-9] * 24)]
    asked = [r for r in rows if r[0] is not None and r[0] % 50 == 0] + [rows[50]]
    frame = lambda rs: spark.createDataFrame([(*r, 1, 2, "i") for r in rs], SCHEMA)
    got = S.top_k(frame(rows), frame(asked), 5)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, asked, 5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_bounds_hold_at_every_resolution():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 30)).round(2) * 100, rng.normal(size=(60, 30)) * 100
    exact, before = x @ y.T, None
    for segments in S.SEGMENTS:
        upper = S.segment_features(x, segments) @ S.segment_features(y, segments).T
        assert (upper >= exact - 1e-6).all()
        assert before is None or upper.sum() <= before
        before = upper.sum()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert S.top_k(none, none).collect() == []


def test_scores_beyond_a_long_fail(spark):
    for big in (1e300, 1e9):
        v = spark.createDataFrame([(i, [big] * 24) for i in range(3)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="fit into a long"):
            S.top_k(v, v).collect()


def test_one_query_block_is_held_at_a_time(spark, monkeypatch):
    """Blocks of few queries and vectors, in several groups: the same results, whatever comes first."""
    monkeypatch.setattr(S, "QUERY_BLOCK", 3)
    monkeypatch.setattr(S, "VECTOR_BLOCK", 5)
    monkeypatch.setattr(S, "GROUP_BLOCKS", 2)
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(-20, 20, 6).astype(float).tolist()) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in S.top_k(v, v, 4).collect())
    want = []
    for q, x in rows:
        best = sorted((-int(np.dot(np.floor(256 * np.array(x)), np.floor(256 * np.array(y)))), i) for i, y in rows if i != q)[:4]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    plan = S.top_k(v, v)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
