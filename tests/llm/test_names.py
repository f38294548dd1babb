"""Every operator with extra columns that are named, but for case, like what it makes or works with, and with null, empty and repeated rows."""

import public_tokenizers as P
import pytest

from noticeworks.llm import bpe, html_text, license_scan, metric_join, ngram_join, periodic_runs, quality_rules, sharding, source_mix, token_align, token_counts, topk, url_filter

RANKS, BYTES, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
RULES = [("com", "/x", "block"), ("com", "/x/y", "warn"), ("com", "/x/z", None)]
LONG = "one two three four five six seven " * 12
DOCS = [(1, LONG, "en", "a"), (1, LONG, "en", "a"), (2, None, None, None), (None, "", "en", ""), (3, "a b c", "de", "a")]
#: Operator by name: what runs it on documents (or pages), the columns that it makes, and whether it keeps the text.
OPERATORS = {
    "url_filter": (lambda df: url_filter.filter_urls(df, df.sparkSession.createDataFrame(RULES, url_filter.RULES_SCHEMA), url_col="text"), ["host", "path", "rule", "verdict"], True),
    "license_scan": (license_scan.scan_licenses, ["sentence_ids", "licenses", "license", "n_licenses"], True),
    "token_counts": (lambda df: token_counts.count_tokens(df, BYTES), ["n_tokens"], True),
    "encode": (lambda df: bpe.encode(df, RANKS, P.PATTERN), ["ids"], False),
    "round_trip": (lambda df: bpe.round_trip(df, RANKS, P.PATTERN), ["ids", "decoded"], False),
    "quality_rules": (quality_rules.quality_rules, list(quality_rules.MADE), True),
    "html_text": (lambda df: html_text.extract_text(df.withColumnRenamed("text", "html"), url_col="lang"), ["text"], False),
    "source_mix": (source_mix.mix_sources, ["size", "source_size", "target", "times"], True),
    "sharding": (lambda df: sharding.shard_by_kd_tree(df, 3), ["size", "text_crc32", "shard", "slot"], True),
    "with_class": (ngram_join.with_class, ["class_id"], True),
    "token_align": (lambda df: token_align.align(df, BYTES, PIECES).documents, ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"], False),
    "periodic_runs": (periodic_runs.periodic_runs, ["runs", "collapsed"], False),
}
WORKING = ["ROW", "Read", "H", "Chunk", "Hash", "E", "Z_symbols", "Pi", "Block", "Idh", "Templates", "_Best", "Made0", "Key"]


@pytest.mark.parametrize("name", OPERATORS)
def test_names_that_differ_by_case_alone(spark, name):
    run, made, keeps = OPERATORS[name]
    extra = [c.upper() if c != "text" else "TEXT_" for c in made] + WORKING
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` int" for c in extra)
    df = spark.createDataFrame([(*d, *range(100, 100 + len(extra))) for d in DOCS], schema)
    out = run(df)
    lower = [c.lower() for c in out.columns]
    assert len(set(lower)) == len(lower) and set(made) <= set(out.columns) and ("text" in lower) == (keeps or name == "html_text")
    rows = out.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "2", "3", "None"]
    for r in rows:  # the caller's columns that aren't replaced keep their values
        for c in WORKING:
            assert r[c] == 100 + extra.index(c)
    same = [tuple(r[c] for c in made if c != "slot") for r in rows if r["doc_id"] == 1]
    assert same[0] == same[1]
    assert run(df.limit(0)).collect() == []


def test_operators_that_read_columns_alone(spark):
    schema = "doc_id long, text string, N_SHINGLES int, CLASS_ID int, Least int"
    got = ngram_join.ngram_components(spark.createDataFrame([(2, LONG, 1, 1, 1), (1, LONG, 1, 1, 1), (None, None, 1, 1, 1)], schema)).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=str) == [(1, 1), (2, 1), (None, None)]
    vectors = spark.createDataFrame([(1, [1.0, 0.0], 5), (1, [1.0, 0.0], 5), (2, [1.0, 0.1], 5), (3, None, 5)], "vec_id long, embedding array<double>, N_LINKS int")
    assert sorted(tuple(r) for r in metric_join.near_vectors(vectors).collect()) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    # a query that stands twice is one query; of other vectors with its id, each has its own list
    twice = [tuple(r) for r in topk.top_k(vectors.where("vec_id = 1"), vectors, 2).orderBy("rank").collect()]
    assert twice == [(1, 1, 2, 1048576)]
    ids = spark.createDataFrame([(1, [1.0, 0.0], 5), (1, [0.0, 1.0], 5)], vectors.schema)
    assert sorted(tuple(r) for r in topk.top_k(ids, vectors, 1).collect()) == [(1, 1, 2, 104448), (1, 1, 2, 1048576)]


def test_rules_of_other_verdicts_fit_nothing_either_way(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(["http://a.com/x/y", "http://a.com/x/z", "http://com/q", None])], "page_id long, url string")
    rules = spark.createDataFrame(RULES, url_filter.RULES_SCHEMA)
    want = [(0, "com/x", "block"), (1, "com/x", "block"), (2, None, "allow"), (3, None, "allow")]
    for bits in (1 << 24, 0):
        assert sorted((r["page_id"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, rules, max_filter_bits=bits).collect()) == want
