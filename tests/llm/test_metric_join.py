import math
import random

import numpy as np
import pytest

from noticeworks.llm import metric_join as M

SCHEMA = "vec_id long, embedding array<double>, class long, X string"


def brute(rows, cosine):
    good = []
    for k, (i, v, *_) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            top = max(map(abs, v))
            w = [x / top for x in v]
            good.append((k, w, math.sqrt(math.fsum(x * x for x in w))))
    root, degree = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, (i, v, n) in enumerate(good):
        for j, w, m in good[:a]:
            if math.fsum(x * y for x, y in zip(v, w)) / (n * m) >= cosine:
                degree[i] += 1
                degree[j] += 1
                root[find(i)] = find(j)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(r[0], least.get(find(k), r[0]))
    return sorted(((r[0], degree[k], least.get(find(k)), r[0] == least.get(find(k))) for k, r in enumerate(rows)), key=str)


def ours(spark, rows, cosine=0.95, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in M.near_vectors(df, cosine=cosine, **more).collect()), key=str)


def clustered(rng, n, dims, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    out = []
    for i in range(n):
        c = rng.choice(centres) if rng.random() < 0.8 else [rng.gauss(0, 1) for _ in range(dims)]
        size = 10 ** rng.uniform(-3, 3)
        out.append((i, [size * (x + rng.gauss(0, spread)) for x in c], 1, "x"))
    return out


@pytest.mark.parametrize("dims,spread,cosine", [(3, 0.2, 0.95), (24, 0.3, 0.9)])
def test_all_links_for_any_pivots_and_blocks(spark, dims, spread, cosine):
    rows = clustered(random.Random(dims), 250, dims, spread)
    rows += [(1000 + i, rows[0][1], 2, None) for i in range(5)]
    want = brute(rows, cosine)
    assert sum(r[1] for r in want) > 100
    assert ours(spark, rows, cosine, **({"cell_rows": 12, "block_rows": 9} if dims == 3 else {"cell_rows": 4, "block_rows": 60})) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1, "x"), (2, [], 1, "x"), (3, [0.0, 0.0], 1, "x"), (4, [1.0, None], 1, "x"), (5, [nan, 1.0], 1, "x"), (6, [inf, 1.0], 1, "x")]
    rows += [(7, [1e300, 1e300], 1, "x"), (8, [1e-300, 1e-300], 1, "x"), (9, [1.0, 1.0, 0.0], 1, "x"), (10, [1.0, 1.0, 0.1], 1, "x"), (11, [-1.0, -1.0], 1, "x")]
    rows += [(None, [1.0, -1.0], 1, "x"), (None, [1.0, -1.0], 1, "x"), (12, [0.0, 5.0], 1, "x"), (12, [5.0, -0.0], 1, "x"), (13, [5.0, 0.0], 1, "x"), (None, [3.0, 0.1], 1, None)]
    assert ours(spark, rows, cell_rows=1, block_rows=1) == brute(rows, 0.95)
    assert ours(spark, []) == [] and ours(spark, rows[:6]) == brute(rows[:6], 0.95)


def test_cosines_at_the_threshold(spark):
    # 3-4-5 triangles: the cosine of (1, 0) and (4, 3) is exactly 0.8
    rows = [(1, [1.0, 0.0], 1, "x"), (2, [4.0, 3.0], 1, "x"), (3, [4.0, -3.0], 1, "x"), (4, [4.0, 3.0000001], 1, "x")]
    got = {r[0]: r for r in ours(spark, rows, 0.8)}
    assert (got[1][1], got[2][1], got[3][1], got[4][1]) == (2, 2, 1, 1)


def test_a_forest_connects_what_links_connect():
    rng = np.random.default_rng(4)
    for _ in range(200):
        links = rng.random((rng.integers(1, 12), rng.integers(1, 12))) < 0.2

        def groups(edges):
            label = {}
            for i, j in edges:
                x, y = (label.get(e, frozenset([e])) for e in (("row", i), ("column", j)))
                label |= dict.fromkeys(x | y, x | y)
            return set(label.values())

        forest = M._forest(links)
        assert len(forest) < sum(links.shape) and all(links[i, j] for i, j in forest)
        assert groups(forest) == groups(map(tuple, np.argwhere(links).tolist()))
