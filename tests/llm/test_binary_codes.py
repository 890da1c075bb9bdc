import math

import numpy as np
import pytest

from sunset_engine.llm import binary_codes as B

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, t int, key int"


def brute(rows):
    """Links, component and kept of rows (id, vector, label)."""
    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(x for x in v)

    ok = [i for i, (k, v, label) in enumerate(rows) if k is not None and label is not None and good(v)]
    parent, links = {r[0]: r[0] for r in rows if r[0] is not None}, [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, i in enumerate(ok):
        for j in ok[:n]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    a, b = find(rows[i][0]), find(rows[j][0])
                    parent[max(a, b)] = min(a, b)
    return sorted((str(r[0]), links[i], str(find(r[0]) if r[0] is not None else None)) for i, r in enumerate(rows))


def rows_of(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 16))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(size=16) * rng.choice([0.02, 0.12, 0.2, 2.0])
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(3))))
    rows += [(n + i, rows[7][1], rows[7][2]) for i in range(40)]                 # copies
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [nan] * 16, 1), (904, [None] * 16, 1), (905, [inf] * 16, 1), (906, rows[7][1], None),
             (None, rows[7][1], rows[7][2]), (907, [1.0], 1), (908, [2.0], 1), (909, [1e-30] * 16, 1), (910, [3e38] * 16, 1), (7, rows[7][1], rows[7][2])]
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_matches_brute_force(spark, block):
    rows = rows_of(3, 260)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = B.near_duplicates(df, 0.98, block=block).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_empty_table(spark):
    assert B.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_estimate_stays_within_its_bound():
    rng = np.random.default_rng(0)
    u, v = B.unit(rng.normal(size=(4000, 64))), rng.normal(size=(4000, 64))
    v = B.unit(v - (v * u).sum(1, keepdims=True) * u)
    q = 0.98 * u + math.sqrt(1 - 0.98 ** 2) * v                                   # cosine of 0.98 with u
    y = u @ B.rotation(64, 0)
    f = np.abs(y).sum(1) / 8
    estimate = (np.sign(y) * (q @ B.rotation(64, 0))).sum(1) / 8 / f
    assert abs(estimate.mean() - 0.98) < 0.001                                     # unbiased
    bound = math.sqrt(1 - 0.98 ** 2) * np.sqrt(1 - f * f) / f * B.EPSILON / math.sqrt(63)
    assert (estimate >= 0.98 - bound).all()


def test_tables_reach_the_recall_asked_for():
    for n in (10, 10_000, 10_000_000):
        bits, tables = B.plan(n, 0.98)
        assert 1 - (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** tables >= B.RECALL
