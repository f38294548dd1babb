import re

from noticeworks.llm import url_filter as U

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"), ("deep.a.org", "", "allow"), (None, "/x", "block"), ("com", "/en/", "block")]
URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/71?x", "https://a.Example.COM/en/8#y", "http://com/en/", "http://xcom/en/", "ftp://b.net/de/8", "http://q.example.net/de/88/",
    "http://example.net?/de/8", "http://a.org/es", "http://a.org/es/", "http://z.deep.a.org/q", "x://y://com/en/", "http://a..org/es/", "http://com./en/", "http://É.com/en/" + "p" * 50000, "http://a.org/es/\n?",
]


def brute(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def ours(spark, urls, rules, **more):
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string").repartition(3)
    table = spark.createDataFrame(rules, U.RULES_SCHEMA)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.filter_urls(pages, table, **more).collect()}


def test_rules_against_brute_force_by_cascade_and_by_join(spark):
    want = {i: brute(u, RULES) for i, u in enumerate(URLS)}
    assert ours(spark, URLS, RULES) == want
    assert ours(spark, URLS, RULES, max_filter_bits=1) == want


def test_many_keys_at_a_poor_filter_need_many_levels_and_stay_exact(spark):
    rules = [(f"h{i}.example", "/", "block" if i % 2 else "allow") for i in range(0, 400, 3)]
    urls = [f"http://h{i}.example/p" for i in range(400)] * 2
    want = {i: brute(u, rules) for i, u in enumerate(urls)}
    assert ours(spark, urls, rules, bits_per_key=2) == want
    listed = spark.createDataFrame([(f"k{i}",) for i in range(200)], "k string")
    universe = spark.createDataFrame([(f"k{i}",) for i in range(3000)] + [(None,)], "k string")
    cascade = U.BloomCascade(listed, universe, bits_per_key=2)
    assert len(cascade.levels) > 2
    got = universe.select("k", cascade.contains(universe["k"]).alias("m")).collect()
    assert all(r["m"] == (r["k"] is not None and int(r["k"][1:]) < 200) for r in got)


def test_listed_keys_that_hit_over_several_words(spark):
    # a list of 2,000 rules, each third of which some page has
    rules = [(f"h{i}.example", "/", "block") for i in range(2000)]
    urls = [f"http://h{i}.example/p" for i in range(0, 4000, 3)]
    assert ours(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}
    df = spark.createDataFrame([("http://com/en/", 1)], "url string, _best int")
    assert U.filter_urls(df, spark.createDataFrame(RULES, U.RULES_SCHEMA)).first()["_best"] == 1


def test_empty(spark):
    assert ours(spark, ["http://com/en/"], []) == {0: ("com", "/en/", None, "allow")}
    assert ours(spark, [], RULES) == {}
