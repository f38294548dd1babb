from pyspark.sql import functions as F

from noticeworks.llm import html_text as H

SF = "/root/testdata/sf0.01"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body>{body}</body></html>"


def blocks(body):
    return H.Page(page(body)).blocks()


def test_parts_left_out():
    assert blocks("<nav>n</nav><header>h</header><main><article><h1>A &amp; B</h1><p>x <b>y</b>z<p>two\n  lines<br>more</article></main><footer>f</footer><aside>s</aside>") == ["A & B", "x yz", "two lines", "more"]
    assert blocks("<div class='ad box'>x</div><div id=cookie-notice>c</div><p>a<form>f</form><div class='comments'><p>no</div><p>b<!-- > <p>hidden</p> --><style>p{}</style>") == ["a", "b"]
    assert blocks("<p class='header-less'>gone</p><div role=navigation>n</div><ul><li>f<li>g</ul><table><tr><td>1<td>2</table>tail") == ["f", "g", "1", "2", "tail"]
    assert blocks("<p>&lt;tag&gt; &#233; &nbsp; &unknown; caf&eacute;</p>") == ["<tag> é &unknown; café"]
    assert blocks("<article class='comment'>c</article><article><p>a</article>") == ["a"]


def test_odd_pages():
    for source in ("", "<", "<p", "</p></div>", "<!-- never closed", "<script>open", "plain text", "<p title=\"a>b\">x</p>", "<p title='x>y", "<" * 3000, "<b>" * 3000 + "x"):
        H.Page(source).blocks()
    assert H.Page("plain text").blocks() == ["plain text"] and H.Page('<p title="a>b">x</p>').blocks() == ["x"]


def test_templates_go_and_copies_stay(spark):
    rows = [(i, f"http://a.org/{i}", page(f"<div><p>Follow us</p><ul><li>one</ul></div><div><p>Story number {i} with many words</p></div>")) for i in range(12)]
    rows += [(100 + i, f"http://b.org/{i}", page("<div><p>One story copied</p></div>")) for i in range(30)]
    rows += [(200 + i, f"http://c.org/{i}", page(f"<div><p>Follow us</p></div><p>Story {i}</p>")) for i in range(3)]
    rows += [(300 + i, f"http://d.org/{i}", page(f"<article><p>Shared passage</p><div><p>Share this</p></div><p>Own words number {i}</p></article>")) for i in range(12)]
    rows += [(400, None, None), (400, None, None), (401, "x", ""), (402, "http://A.org/z", page("<div><p>Follow us</p><ul><li>one</ul></div>end of a story"))]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string").repartition(4)
    got = {r["page_id"]: r["text"] for r in H.extract_text(df).collect()}
    assert all(got[i] == f"Story number {i} with many words" for i in range(12))
    assert all(got[100 + i] == "One story copied" for i in range(30))
    assert got[200] == "Follow us Story 0"
    assert got[300] == "Shared passage Own words number 0"
    assert got[400] == "" and got[401] == "" and got[402] == "end of a story"
    assert H.extract_text(df.limit(0)).collect() == []


def test_templates_are_those_that_brute_force_counts(spark):
    import random
    from collections import defaultdict

    rng, rows = random.Random(4), []
    for host in range(6):
        pool = [f"<section><h3>Box {k} of {host}</h3><p>Text of box {k}</p></section>" for k in range(8)]
        for i in range((40, 40, 30, 25, 12, 5)[host]):
            boxes = [x for k, x in enumerate(pool) if rng.random() < (0.9, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02, 0)[k]]
            own = f"<div><h1>Story {rng.randrange(60)}</h1><p>" + "words " * rng.randrange(1, 30) + f"</p>{rng.choice(pool)}</div>"
            body = boxes + [own]
            rng.shuffle(body)
            rows.append((len(rows), f"http://h{host}.org/{i}", page("".join(body))))
    parsed = [(f"h{u[8]}.org", H.Page(h)) for _, u, h in rows]

    def often(pairs):  # (host, item, beside)
        beside, all_ = defaultdict(set), defaultdict(set)
        for host, item, what in pairs:
            all_[host].add(what)
            if item is not None:
                beside[host, item].add(what)
        return {k for k, v in beside.items() if len(v) >= 10 and len(v) >= 0.1 * len(all_[k[0]])}

    texts = [tuple(p.blocks()) for _, p in parsed]
    shared = often([(h, x, t) for (h, _), t in zip(parsed, texts) for x in (None, *t)])
    contents = [max((x for x in t if (h, x) not in shared), key=len, default=None) for (h, _), t in zip(parsed, texts)]
    want = often([(h, x, c) for (h, p), c in zip(parsed, contents) for x in (None, *{p.hashes[i] for i in p.candidates()})])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {tuple(r) for r in H.site_templates(df, "html", F.regexp_extract("url", "://([^/]*)", 1), 10, 0.1).collect()}
    assert found == want and len(want) > 10
    by_count = {r["page_id"]: r["text"] for r in H.extract_text(df).collect()}
    by_rule = {r["page_id"]: r["text"] for r in H.extract_text(df, by_templates=False).collect()}
    assert all(by_count[i] == " ".join(p.blocks({x for g, x in want if g == h})) for i, (h, p) in enumerate(parsed))
    assert sum(by_count[i] != by_rule[i] for i in by_rule) > 80 and not any("Box 0 of 0" in by_count[i] for i in range(40))


def test_templates_decide_before_the_rules(spark):
    # a menu that outweighs the text holds "the bulk" of the page until it is counted; the text's wrapper is named like a sidebar
    menu = "<div>" + "".join(f"<p>Section {k} of this very large site</p>" for k in range(20)) + "</div>"
    rows = [(i, f"http://a.org/{i}", page(f"{menu}<h1>No {i}</h1><div class=widget><p>Story {i} in few words</p></div>")) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract_text(df).collect()}
    assert all(got[i] == f"No {i} Story {i} in few words" for i in range(20))
    assert "Story" not in H.extract_text(df, by_templates=False).first()["text"]


def test_long_hostile_pages_take_time_in_proportion():
    import time

    for source in ("<b>" * 300_000 + "x", "<p>" + "<b>" * 300_000, "<p title='x\">" * 80_000, "<b " * 300_000, "<b \">\" " * 120_000, "<b>" * 100_000 + "</i>" * 150_000, "<script>" + "</script " * 120_000 + ">"):
        began = time.process_time()
        H.Page(source).blocks()
        assert time.process_time() - began < 30


def test_columns_with_working_names_stay(spark):
    df = spark.createDataFrame([(1, "http://a.org/", page("<p>x</p>"), 1, 2, 3, 4, 5)], "page_id long, url string, html string, _host int, _html int, _templates int, _OF int, host int")
    assert H.extract_text(df).collect() == [(1, "http://a.org/", 1, 2, 3, 4, 5, "x")]


def test_query_takes_the_article_and_nothing_else(spark):
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in H.op7_html_extraction(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        import html as h

        want = " ".join(h.unescape(re.sub(r"<(?:p|/p|h1|/h1|br)>", " ", inner).replace("<b>", "")).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_flowing_text_of_pages_without_article_stays(spark):
    def body(i):
        return f"<h2>Introduction</h2><p>In <a>Paris</a> they did <b>not</b> see number {i} of these</p><p>Shared passage</p><ul><li>item {i}<li>shared item</ul><table><tr><td>shared cell<td>{i}</table><div>Share this</div>"

    rows = [(i, f"http://a.org/{i}", page(body(i))) for i in range(20)]
    # beside 12 of 400 contents: too few of the host for a template
    rows += [(1000 + i, f"http://b.org/{i}", page(("<div>Errata of some</div>" if i < 12 else "") + f"<p>Story number {i} of many</p>")) for i in range(400)]
    got = {r["page_id"]: r["text"] for r in H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Introduction In Paris they did not see number {i} of these Shared passage item {i} shared item shared cell {i}" for i in range(20))
    assert got[1000] == "Errata of some Story number 0 of many" and got[1399] == "Story number 399 of many"


def test_boilerplate_longer_than_the_pages_own_blocks_goes(spark):
    legal = "<div>" + "All texts of this site are given without any warranty. " * 5 + "</div>"
    rows = [(i, f"http://a.org/{i}", page(f"<div>Follow us</div><p>Note {i}</p>{legal}")) for i in range(20)]
    # copies of one story among others, each with a line of its own, are no template
    rows += [(100 + i, f"http://b.org/{i}", page(f"<div>One story copied often</div><p>No {i}</p>" if i < 12 else f"<div>Own story {i} of this host</div>")) for i in range(200)]
    got = {r["page_id"]: r["text"] for r in H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Note {i}" for i in range(20))
    assert got[100] == "One story copied often No 0" and got[299] == "Own story 199 of this host"


def test_wrappers_and_compound_names_stay():
    for name in ("layout has-sidebar", "no-comments", "with-header", "article-header", "search-results", "related-work"):
        assert blocks(f"<div class='ad-box'>ad</div><div class='{name}'><p>kept</p></div><p>A longer text of this page</p>") == ["kept", "A longer text of this page"]
    # an element that holds the article, the main element or the bulk of the text
    assert blocks("<nav>n</nav><div class='page sidebar'><article><p>a</p><div class=share>s</div></article></div>") == ["a"]
    assert blocks("<form><main><p>m</p></main></form>") == ["m"]
    assert blocks("<div class=sidebar><p>The text of the page</p><div class=comments>c</div></div><p>end</p>") == ["The text of the page", "end"]
    # teasers and comments in articles of their own
    assert blocks("<article><p>The story</p></article><aside><article>tease</article></aside><div class=comments><article class=comment-body>A long comment on it</article></div>") == ["The story"]
    for name in ("site-header", "comments-area", "cookie_banner", "main-nav"):
        assert blocks(f"<p>The text</p><div class='{name}'>x</div>") == ["The text"]
