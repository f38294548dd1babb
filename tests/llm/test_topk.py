import math
import random

from noticeworks.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def hold(x):
    return max(min(x, 2**63 - 1), -(2**63))


def brute(rows, queries, k):
    good = []
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [hold(math.floor(1024 * x)) for x in v]))
    out = []
    for q, v in good:
        if q in queries:
            scored = sorted((-hold(sum(a * b for a, b in zip(v, w))), c) for c, w in good if c != q)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored)]
    return sorted(out)


def ours(spark, rows, queries, k=10, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()
    out = topk.top_k(df.where(df.vec_id.isin(queries)), df, k, **more)
    return sorted(tuple(r) for r in out.collect())


def test_blocks_ties_and_bad_vectors(spark):
    rng = random.Random(4)
    as_float = lambda x: float(__import__("numpy").float32(x))
    rows = [(i, [as_float(rng.choice([0, 0, 0.5, -0.25, rng.gauss(0, 1)])) for _ in range(8)], "s") for i in range(120)]
    rows += [(200 + i, [0.5] * 8, "s") for i in range(40)]  # ties
    rows += [(300, None, "s"), (301, [None] * 8, "s"), (302, [float("nan")] * 8, "s"), (303, [float("inf")] * 8, "s"), (None, [1.0] * 8, "s"), (304, [], "s"), (305, [1.0, 2.0], "s")]
    queries = [0, 50, 200, 239, 300, 302, 304]
    want = brute(rows, queries, 10)
    assert ours(spark, rows, queries) == want
    assert ours(spark, rows, queries, query_block=2, candidate_block=30) == want
    assert ours(spark, rows, queries, k=1000) == brute(rows, queries, 1000)


def test_huge_components_are_exact(spark):
    rows = [(0, [1e9, 3.0], "s"), (1, [1e9, 1.0], "s"), (2, [1e9, 2.0], "s"), (3, [-1e9, 0.0], "s"), (4, [3e38, 1.0], "s")]
    assert ours(spark, rows, [0, 4]) == brute(rows, [0, 4], 10)


def test_empty(spark):
    assert ours(spark, [], [0]) == []
    assert ours(spark, [(0, [1.0], "s")], [0]) == []
