import collections
import itertools
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeworks.llm import sharding, source_mix

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, source string, size string"


def water_fill(sizes, weights, total, most=3):
    """Targets that share `total` by weight but stop at `most` times the size, the excess reshared by weight."""
    limits = [Fraction(most * s) for s in sizes]
    targets, free, rest = [Fraction(0)] * len(sizes), set(range(len(sizes))), Fraction(total)
    while free:
        whole = sum(Fraction(weights[i]) for i in free)
        share = {i: rest * Fraction(weights[i]) / whole for i in free}
        over = [i for i in free if share[i] > limits[i]]
        if not over:
            for i in free:
                targets[i] = share[i]
            break
        for i in over:
            targets[i] = limits[i]
            rest -= limits[i]
            free.discard(i)
    return targets


def test_water_fill():
    assert water_fill([10, 100, 100], [5, 2, 1], 210) == [30, 120, 60]
    assert water_fill([1, 1], [1, 1], 100) == [3, 3]
    assert water_fill([], [], 0) == [] and water_fill([0, 4], [5, 2], 4) == [0, Fraction(4)]


def test_landing_is_the_best_of_all_combinations():
    rng = np.random.default_rng(5)
    for n in (1, 3, 9, 12):
        size, pi = rng.integers(1, 4000, n).astype(float), rng.random(n)
        words, docs = float(pi @ size), float(pi.sum())
        out = source_mix._land(pi, size, words, docs)
        every = [np.array(x) for x in itertools.product((0, 1), repeat=n)]
        step = max(0.5, words / 1000)
        rank = lambda x: (abs(x @ size - words) // step, abs(x.sum() - docs))
        assert rank(out) == min(map(rank, every))


def test_plan_is_water_fill_for_any_number_of_sources(spark, monkeypatch):
    import random

    rng = random.Random(3)
    monkeypatch.setattr(source_mix, "BROADCAST_SOURCES", 10)
    for k in (1, 7, 400):
        sizes = [rng.choice([1, 5, 50, 3000]) * rng.randrange(1, 9) for _ in range(k)]
        names = [f"s{i:04d}" for i in range(k - 1)] + [None]
        units = spark.createDataFrame(list(zip(names, sizes)), "s string, size long").repartition(5)
        want = water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(k)], sum(sizes))
        got = {r["no"]: r for r in source_mix.plan_sources(units, (5, 2, 1), 3, 1.0).collect()}
        assert [got[i]["source"] for i in range(k)] == names
        assert all(abs(got[i]["target"] - float(t)) < 1e-6 * float(t) + 1e-9 for i, t in enumerate(want))
    docs = spark.createDataFrame([(i, "a b c " * (1 + i % 5), "en", f"s{i % 40}", "x") for i in range(400)], SCHEMA)
    out = source_mix.mix_sources(docs).collect()
    assert len(out) == 400 and abs(sum(r["size"] * r["times"] for r in out) - sum(r["size"] for r in out)) < 40 * 15


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_mix_meets_its_targets_and_agrees_with_itself(spark, sf):
    """Every source within half a percent of its target, or within half of its smallest document."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "source")
    source = {r[0]: r[1] for r in docs.collect()}
    one, two = (sorted(map(tuple, source_mix.op8_source_mix(spark, f"/root/testdata/{sf}").collect())) for _ in range(2))
    assert one == two
    per = collections.defaultdict(lambda: [0, 0.0, 10**9])
    for i, size, _, target, taken in one:
        assert taken <= 3 * size and (size == 0 or taken % size == 0)
        s = per[source[i]]
        s[0], s[1], s[2] = s[0] + taken, target, min(s[2], size or 10**9)
    assert len(per) > 10
    for taken, target, smallest in per.values():
        assert abs(taken - target) <= max(0.005 * target, smallest / 2)


def test_mix_in_several_rounds_stays_balanced(spark):
    rows = [(i, "w " * (1 + i % 37), "en", "a" if i % 3 else None, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = source_mix.mix_sources(df, block_rows=100).groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("t"), F.max("target").alias("target"), F.sum("times").alias("n"), F.count("*").alias("rows"), F.max("source_size").alias("s")).collect()
    for r in out:
        assert abs(r["t"] - r["target"]) <= 20 and abs(r["n"] - r["rows"] * r["target"] / r["s"]) <= 4


def test_mix_edges(spark):
    rows = [(1, None, "en", None, "x"), (1, None, "en", None, "x"), (2, "", "en", "", "x"), (3, "a b c", "en", "s", "x"), (3, "a b c", "en", "s", "x"), (None, "d e", None, "s", "x"), (4, "w " * 20000, "en", "t", "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"ratio": F.lit("r"), "source_no": F.lit("n"), "pi": F.lit("p"), "target": F.lit("t"), "h": F.lit(1), "row": F.lit(2), "_size": F.lit(3), "s": F.lit(4)})
    out = source_mix.mix_sources(df).collect()
    assert all((r["ratio"], r["source_no"], r["pi"], r["h"], r["row"], r["_size"], r["s"]) == ("r", "n", "p", 1, 2, 3, 4) and isinstance(r["target"], float) for r in out)
    assert len(out) == len(rows) and all(r["times"] == 0 for r in out if r["size"] == 0)
    same = {r["times"] for r in out if r["doc_id"] == 3}
    assert len(same) == 1
    assert source_mix.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def check_shards(rows, out, shards):
    assert len(out) == len(rows)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


def test_shards_are_near_equal_and_keep_copies_together(spark):
    out = sharding.op9_kd_shards(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_shards(docs, out, 24)
    load = collections.Counter()
    for r in out:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        load[r["shard"]] += r["size"]
    mean = sum(load.values()) / 24
    assert max(load.values()) < 1.02 * mean and min(load.values()) > 0.98 * mean
    assert sorted(map(tuple, sharding.op9_kd_shards(spark, SF).collect()), key=str) == sorted(map(tuple, out), key=str)


def shards_of_groups(out):
    of, load = collections.defaultdict(set), collections.Counter()
    for r in out:
        of[r["text_crc32"], r["size"]].add(r["shard"])
        load[r["shard"]] += r["size"]
    return of, load


def test_equal_texts_share_a_shard_in_the_query(spark):
    of, _ = shards_of_groups(sharding.op9_kd_shards(spark, SF).collect())
    assert all(len(s) == 1 for s in of.values())


def test_shards_split_a_group_only_if_it_outweighs_one(spark, monkeypatch):
    # a hot group of two shards, groups of a third and of a tenth of a shard, pairs; languages and sources differ within all of them
    rows = [(i, "hot text " * 50, "en", f"s{i % 3}", "x") for i in range(600)] + [(1000 + i, f"text {i // 2} " * 50, "en", f"s{i % 7}", "x") for i in range(900)]
    for k, n in ((0, 100), (1, 100), (2, 100), (3, 30), (4, 30)):
        rows += [(3000 + 200 * k + i, f"group {k} " * 50, f"l{i % 5}", f"s{i % 11}", "x") for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    for keep, bound in ((True, 200_000), (False, 0)):
        # beyond the bound, groups are joined by shuffle
        monkeypatch.setattr(sharding, "BROADCAST_GROUPS", bound)
        out = sharding.shard_by_kd_tree(df, 6, tolerance=0.01, keep_text=keep).collect()
        check_shards(rows, out, 6)
        of, load = shards_of_groups(out)
        assert max(load.values()) < 1.06 * min(load.values())
        hot = "hot text " * 50
        assert [k for k, s in of.items() if len(s) > 1] == [(zlib.crc32(hot.encode()), len(hot) + 8)]


def test_shards_are_cells_of_the_widest_dimension(spark):
    # sizes only: shards are runs of sizes, cut where the bytes are
    rows = [(i, f"{i} " + "x" * (10 + i * i % 700), "en", "s", "x") for i in range(2000)]
    out = sharding.shard_by_kd_tree(spark.createDataFrame(rows, SCHEMA), 8, dim_cols=()).collect()
    sizes = [[r["size"] for r in out if r["shard"] == k] for k in range(8)]
    assert all(max(a) <= min(b) for a, b in zip(sizes, sizes[1:])) and max(map(sum, sizes)) < 1.02 * min(map(sum, sizes))
    # equal sizes: the four languages are as wide as the corpus, and each becomes a shard, the heaviest first
    rows = [(i, f"{i:06d}" + "x" * 50, "abcd"[i % 4], "s", "x") for i in range(1200)]
    of = collections.defaultdict(set)
    for r in sharding.shard_by_kd_tree(spark.createDataFrame(rows, SCHEMA), 4).collect():
        of[r["lang"]].add(r["shard"])
    assert sorted(min(s) for s in of.values()) == [0, 1, 2, 3] and all(len(s) == 1 for s in of.values())


def test_shard_edges(spark):
    rows = [(None, None, None, None, "x"), (None, None, None, None, "x"), (1, "", "en", "s", "x"), (2, "y" * 100000, "en", "s", "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit("n"), "dims": F.lit("d"), "crc": F.lit("c"), "shard": F.lit("s"), "id": F.lit(1), "row": F.lit(2), "_node": F.lit(3)})
    out = sharding.shard_by_kd_tree(df, 4).collect()
    assert all((r["node"], r["dims"], r["crc"], r["id"], r["row"], r["_node"]) == ("n", "d", "c", 1, 2, 3) and isinstance(r["shard"], int) for r in out)
    check_shards(rows, out, 4)
    assert sorted(r["size"] for r in out) == [8, 8, 8, 100008]
    assert sharding.shard_by_kd_tree(spark.createDataFrame([], SCHEMA), 4).collect() == []
    assert {r["shard"] for r in sharding.shard_by_kd_tree(spark.createDataFrame(rows, SCHEMA), 1).collect()} == {0}
