import collections

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline as pipeline

    from noticeworks.llm.shared import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = [docs]
    for name, stage in pipeline.STAGES:
        made.append(written(stage(spark, made[-1], SF), name))
    return [[r.asDict() for r in df.collect()] for df in made]


def test_each_stage_on_what_the_one_before_kept(spark, stages):
    docs, good, single, mixed, encoded = stages
    columns = {"doc_id", "text", "lang", "source", "n_chars"}
    assert all(set(r) == columns for s in (good, single, mixed) for r in s)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    from test_quality_rules import brute as statistics

    for r in docs:
        n, _, _, _, repeated = statistics(r["text"])
        if n < 50 or 100 * repeated > 50 * n:
            assert r["doc_id"] not in kept
        elif labels.get(r["doc_id"]) == 1:
            assert r["doc_id"] in kept

    from test_ngram_join import brute as components

    expected = {i for i, _, c in components([(r["doc_id"], r["text"]) for r in good]) if i == c}
    assert {r["doc_id"] for r in single} == expected and len(single) == len(expected)

    sizes, taken = collections.Counter(), collections.Counter()
    for r in single:
        sizes[r["source"]] += len(r["text"].split())
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    assert max(collections.Counter(r["doc_id"] for r in mixed).values()) <= 3
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in single}
    longest = max(len(r["text"].split()) for r in single)
    assert abs(sum(taken.values()) - sum(sizes.values())) <= 20 * longest

    assert len(encoded) == len(mixed) and all(r["round_trip"] for r in encoded)
    assert collections.Counter(r["doc_id"] for r in encoded) == collections.Counter(r["doc_id"] for r in mixed)


def test_near_duplicate_stage_with_repeated_and_null_ids(spark):
    import corpus_pipeline as pipeline

    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, a), (1, b), (2, a), (2, b), (None, ""), (None, None), (3, a + " end"), (4, "one two"), (5, "One two")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = sorted(((r["doc_id"], r["text"]) for r in pipeline.near_duplicates(spark, df, SF).collect()), key=str)
    assert out == sorted([(1, a), (1, b), (None, ""), (None, None), (4, "one two")], key=str)


def test_run_gives_the_last_stage(spark, stages):
    import corpus_pipeline as pipeline

    out = pipeline.run(spark, SF)
    assert out.count() == len(stages[-1]) and out.where(~F.col("round_trip")).count() == 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_mix_and_encode_stages_on_odd_rows(spark):
    import corpus_pipeline as pipeline

    rows = [(1, None, None, None, None), (1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, "", "en", "s", 0), (None, "x " * 3000, None, None, None), (3, "é 🙂\n\n ", "en", "t", 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    mixed = pipeline.mix(spark, df, SF).collect()
    taken = collections.Counter((r["doc_id"], r["text"]) for r in mixed)
    assert all(r["text"] and r["text"].strip() for r in mixed) and set(taken) <= {(r[0], r[1]) for r in rows}
    # the two equal rows are taken equally often
    assert taken[1, "a b c"] % 2 == 0 and max(taken[None, "x " * 3000], taken[3, "é 🙂\n\n "]) <= 3
    out = pipeline.encode(spark, df, SF).collect()
    assert len(out) == len(rows) and all(r["round_trip"] for r in out)
    assert sorted(r["n_tokens"] for r in out)[:2] == [0, 0] and all(len(r["ids"]) == 4 * r["n_tokens"] for r in out)


def test_an_empty_table_and_one_of_junk_go_through(spark, tmp_path):
    import corpus_pipeline as pipeline

    for k, rows in enumerate([[], [(1, None, None, None, None), (2, "too short", "en", "s", 9)]]):
        spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / str(k) / "documents.parquet"))
        out = pipeline.run(spark, str(tmp_path / str(k)))
        assert out.columns == ["doc_id", "source", "n_tokens", "ids", "round_trip"] and out.count() == 0
