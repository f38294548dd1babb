import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from noticeworks.operators import classify, extract, identity, lexicon, match, profile
from noticeworks.plans import registry


def one(spark, column, *values, schema="x string"):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], schema + ", i int").orderBy("i")
    return [r[0] for r in df.select(column).collect()]


CASCADE = [
    ("ab", "", "", "Review", "bad_title", None),
    ("Redesign of the web site", "", "", "Technology", "tech_title_regex", "web_work"),
    ("Redesign of web pages and uniforms", "", "", "Technology", "tech_dominant", "web_work"),
    ("Smoke detectors with software", "", "", "Non-Tech", "nontech_override", "smoke detectors"),
    ("Software for catering", "", "", "Technology", "tech_dominant", "software"),
    ("Databases and uniforms", "", "", "Review", "title_conflict", "TECH=databases | NONTECH=uniforms"),
    ("Cleaning services for offices", "", "", "Non-Tech", "nontech_title_rule", "cleaning"),
    ("Renewal of a data warehouse", "", "", "Technology", "tech_title_rule", "data warehouse"),
    ("Renewals of subscriptions", "", "", "Technology", "tech_title_regex", "licence_term"),
    ("Purchase of stools", "", "om_source_01", "Technology", "source_it_category", "خدمات تقنية المعلومات"),
    ("Purchase of stools", "Software", "", "Review", "tech_context_review", "Technology evidence exists only in context: software"),
    ("Supply of network cabinets", "", "", "Review", "weak_tech_title_review", "Possible Technology signal: network"),
    ("Purchase of stools", "", "", "Non-Tech", "no_tech_evidence", "No Technology evidence detected"),
    (None, None, None, "Review", "bad_title", None),
]


def test_cascade(spark):
    rows = [(i, t, c, s, "x خدمات تقنية المعلومات y") for i, (t, c, s, *_) in enumerate(CASCADE)] * 2
    df = spark.createDataFrame(rows, "i int, title string, context string, source string, category string")
    out = classify.classify(spark, df, "source", "title", "context", "category").collect()
    assert len(out) == len(rows)
    for r in out:
        *_, cls, method, reason = CASCADE[r["i"]]
        assert (r["classification"], r["method"]) == (cls, method) and reason in (None, r["reason"])


def test_phrases_against_patterns(spark):
    words = ["نظام", "دعم", "فني", "والنظام", "للنظام", "بالشبكة", "net", "netx", "data", "base", "data-base", "x_net", "(net)", "ونظام", "لنظام", "النظام"]
    lists = {"tech": ["نظام", "data base", "net", "دعم فني"], "weak": ["نظام", "شبكة", "base"]}
    rng = random.Random(6)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    from noticeworks.functions.text import norm_match

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("n", norm_match("t"))
    norms = {r["i"]: r["n"] for r in df.collect()}
    got = {r["i"]: (r["tech"], r["weak"]) for r in lexicon.first_phrases(df, "i", "n", lexicon.compile_phrases(spark, lists), ["tech", "weak"]).collect()}

    def first(text, phrases, wide):
        # the normal forms of these phrases differ in one letter only
        for p in sorted(phrases, key=len, reverse=True):
            n = p.replace("ة", "ه")
            if re.search("[؀-ۿ]", n):
                prefix = "(?:و)?(?:[فبكل])?(?:ال)?" if wide else "(?:و)?(?:ال)?"
                hit = re.search(rf"(?<!\S){prefix}{n}(?!\S)", text)
            else:
                hit = re.search(rf"(?<!\w){n}(?!\w)", text)
            if hit:
                return p
        return None

    for i, n in norms.items():
        assert got.get(i, (None, None)) == (first(n, lists["tech"], True), first(n, lists["weak"], False)), n


def test_records_and_labels(spark):
    text = "Menu XY-RFQ-1409   Supply of pipes\nRFQ Active 01-Sep-2026 9:10 AM 02-Sep-2026 9:10 AM 13-Sep-2026 9:10 AM  wxyz-itt-23.77/A Other ITT Under Review 01-Sep-2026 9:10 AM 02-Sep-2026 9:10 AM 14-sep-2026 9:10 pm"
    out = extract.records_from_text(spark.createDataFrame([(1, text)], "page int, text string"), "text").orderBy("pos").collect()
    assert [(r["number"], r["title"], r["type"], r["status"]) for r in out] == [("XY-RFQ-1409", "Supply of pipes", "RFQ", "Active"), ("wxyz-itt-23.77/A", "Other", "ITT", "Under Review")] and out[1]["closes"] == "14-sep-2026 9:10 pm"
    lines = extract.lines_of(F.col("x"))
    page = "Number\nT-1\nTitle\nStatus\nOpen\nDeadline: 5 Sep\nPrice: 10:30"
    assert one(spark, extract.label_value_pairs(lines, ["Number", "Title", "Status"]), page) == [{"Number": "T-1", "Title": "", "Status": "Open"}]
    assert one(spark, extract.inline_pairs(lines, ["Price", "None"]), page) == [{"Price": "10:30"}]
    merged = extract.with_inline_fallback(extract.label_value_pairs(lines, ["Number", "Title"]), extract.inline_pairs(lines, ["Number", "Title"]), ["Number", "Title"])
    assert one(spark, merged, "Title: A b\nNumber: 7", "Number\n7\nTitle\nA") == [{"Title": "A b", "Number": "7"}, {"Number": "7", "Title": "A"}]
    assert one(spark, extract.deadline_value(lines), page, "x\nClosing date\n7 Sep 2026", "none") == ["5 Sep", "7 Sep 2026", None]
    assert one(spark, extract.deadline_value(lines), *[f"x\n{a}خر موعد للعطاء{rest}" for a, rest in zip("اأإآ", [": 5/9/2026", "\n6/9/2026", " 7/9/2026", ":\n8/9/2026"])]) == ["5/9/2026", "6/9/2026", "7/9/2026", "8/9/2026"]


def test_dates_and_rows(spark):
    assert one(spark, extract.to_dmy(F.col("x")), "2026-9-1", "1/9/2026", "x") == ["01-09-2026", "01-09-2026", None]
    both = extract.labelled_dates(F.col("x"), "sales end", "bid close")
    assert one(spark, both, "Sales end 1-9-2026 bid close: 2026/9/5", "1-9-2026 then 2-9-2026", "only 3/9/2026", "none") == [("01-09-2026", "05-09-2026"), ("01-09-2026", "02-09-2026"), (None, "03-09-2026"), (None, None)]
    parts = extract.split_row_at_type(F.split("x", r"\|"), F.lit(""))
    assert one(spark, parts, "1 Sep 2026|Pipes|2 Sep 2026|External|3 Sep 2026|Ministry", "no type here") == [("External", "Ministry", "Pipes"), (None, None, None)]
    assert one(spark, extract.title_before_date(F.col("x")), "Supply of pipes Qatar 1 Sep 2026 more", "No date") == ["Supply of pipes", "No date"]
    assert one(spark, extract.id_from_url(F.col("x")), "http://x/?id=Tender%20%28A-1%29&b=2", "http://x/") == ["A-1", None]
    assert one(spark, extract.strip_number_prefix(F.col("x"), F.lit("7/26")), "7/26 - Pipes", "Pipes") == ["Pipes", "Pipes"]
    stale = spark.createDataFrame([(1, "2026-09-23"), (1, "2026-09-22"), (2, "2026-09-23"), (2, "2026-09-24"), (3, "2026-09-23"), (3, None)], "p int, d string")
    out = extract.page_is_stale(stale, "p", F.col("d").cast("date"), F.lit("2026-09-24").cast("date"))
    assert {r["p"]: r["stale"] for r in out.collect()} == {1: True, 2: False, 3: False}


def test_cards_cells_and_payloads(spark):
    card = '<div><span class="card-label">No &amp; id</span><b class="card-value">7</b><span class="card-label">Title</span><b class="card-value">A <i>b</i></b></div>'
    assert one(spark, extract.card_fields(F.col("x"), "card-label", "card-value"), card) == [{"No & id": "7", "Title": "A b"}]
    cells = spark.createDataFrame([(1, 0, 0, "Name"), (1, 0, 1, "Pipes"), (1, 1, 0, "City: Doha"), (1, 2, 0, "Fee"), (1, 3, 0, "10"), (1, 4, 0, "Name"), (1, 4, 1, "Late")], "page int, row int, col int, text string")
    got = {r["label"]: r["value"] for r in extract.cell_label_values(cells, ["Name", "City", "Fee"]).collect()}
    assert got == {"Name": "Pipes", "City": "Doha", "Fee": "10"}
    payload = '{"id": 5, "title": "T", "valueRange": {"min": 1.5, "nameEn": "low"}, "categories": [{"name": {"en": "IT"}}, {"name": {}}], "type": {"key": "k"}}'
    df = spark.createDataFrame([(payload,), ('{"title": "no id"}',)], "x string").select(F.parse_json("x").alias("v"))
    (row,) = extract.flatten_payload(df, "v").collect()
    assert (row["id"], row["value_min"], row["value_label"], row["categories"], row["type"], row["url"][-2:]) == ("5", "1.5", "low", ["IT"], "k", "/5")
    assert one(spark, extract.block_page_marker(F.col("x")), "Please solve the CAPTCHA", "fine", None) == ["captcha", None, None]


def test_pages(spark):
    rows = [("s", p, i, k) for p, keys in enumerate([["a", "b"], ["c", ""], ["a", "b"], ["b", "d"]]) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "s string, p int, i int, k string")
    out = {r["p"]: r["repeated"] for r in extract.repeated_pages(df, "s", "p", "i", F.col("k"), F.col("k")).collect()}
    assert out == {0: False, 1: False, 2: True, 3: False}
    hot = df.unionByName(spark.createDataFrame([("s", p, 10 + i, None) for p in (0, 9) for i in range(50)], df.schema))
    more = {r["p"]: (r["rows"], r["new_keys"], r["duplicate_keys"]) for r in extract.page_novelty(hot, "s", "p", "i", F.col("k")).collect()}
    assert more == {0: (52, 2, 0), 1: (2, 1, 0), 2: (2, 0, 2), 3: (2, 1, 1), 9: (50, 0, 0)}
    new = {r["p"]: (r["rows"], r["new_keys"], r["duplicate_keys"]) for r in extract.page_novelty(df, "s", "p", "i", F.col("k")).collect()}
    assert new == {0: (2, 2, 0), 1: (2, 1, 0), 2: (2, 0, 2), 3: (2, 1, 1)}


def test_keys_and_look_alikes(spark):
    key = identity.business_key(F.lit("qa_source_01"), F.col("x"), F.lit("2026-09-01").cast("date"), F.lit(None).cast("date"), F.lit(None), F.lit("T"))
    assert one(spark, key, "4722/2026", None) == ["qasource01|source_id=47222026|published=2026-09-01", "qasource01|title=t|published=2026-09-01|closing=|url="]
    base = [f"word{i}" for i in range(10)]
    rows = [("a", "s1", "q", base, date(2026, 9, 1)), ("b", "s2", "q", base[:9], date(2026, 9, 8)), ("c", "s2", "q", base, date(2026, 9, 9)), ("d", "s1", "q", base, None), ("e", "s2", "q", base, None), ("f", "s1", "r", base, None), ("g", "s2", "", base, None)]
    df = spark.createDataFrame(rows, "id string, s string, g string, t array<string>, c date")
    assert {(r["a"], r["b"]) for r in match.similar_pairs(df, "id", "s", "g", "t", "c").collect()} == {("a", "b"), ("d", "e")}
    assert match.candidate_pairs(df, "id", "s", "g", "t", cap=3).count() == 0


def test_prefixes_lose_no_similar_pair(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 12))] for _ in range(60)]
    rows = []
    for i in range(300):
        words = set(rng.choice(base)) | ({f"w{rng.randrange(60)}"} if i % 2 else set())
        rows.append((i, f"s{i % 3}", "q", sorted(words), date(2026, 9, 1)))
    df = spark.createDataFrame(rows, "id int, s string, g string, t array<string>, c date")
    for cap in (20, 400):
        plain = df.select(F.col("id").alias("a"), F.col("t").alias("ta")), df.select(F.col("id").alias("b"), F.col("t").alias("tb"))
        all_ = match.candidate_pairs(df, "id", "s", "g", "t", cap).join(plain[0], "a").join(plain[1], "b")
        want = {(r["a"], r["b"]) for r in all_.where(match.jaccard(F.col("ta"), F.col("tb")) >= 0.82).collect()}
        assert {(r["a"], r["b"]) for r in match.similar_pairs(df, "id", "s", "g", "t", "c", cap=cap).collect()} == want and want


def test_candidates_are_bounded_before_their_tokens_are_read(spark):
    """Long titles that share one rare token aren't candidates; similar ones with a word more or less and close dates are."""
    base = [[f"x{i}_{j}" for j in range(60)] for i in range(20)]
    rows = [(2 * i + k, f"s{k}", "q", [*x[k:], "odd"], date(2026, 9, 1 + (i % 3 == 0 and 20 * k))) for i, x in enumerate(base) for k in (0, 1)]
    df = spark.createDataFrame(rows, "id int, s string, g string, t array<string>, c date")
    near = {(2 * i, 2 * i + 1) for i in range(20) if i % 3}
    for closing, want in (("c", near), (None, {(2 * i, 2 * i + 1) for i in range(20)})):
        assert {tuple(r) for r in match.candidate_pairs(df, "id", "s", "g", "t", threshold=0.82, closing=closing).collect()} == want
    assert {(r["a"], r["b"]) for r in match.similar_pairs(df, "id", "s", "g", "t", "c").collect()} == near
    # few tokens and hardly any in common: each shares its first token with many others
    short = spark.createDataFrame([(i, f"s{i % 2}", "q", ["a", f"b{i}", f"c{i}"], None) for i in range(100)], "id int, s string, g string, t array<string>, c date")
    assert match.candidate_pairs(short, "id", "s", "g", "t", threshold=0.3, closing="c").count() == 0


def test_copies_are_compared_once_and_reasons_count_every_partner(spark):
    """Each text comes often, from many sources and dates, with and without date: the work on sets doesn't grow with the copies."""
    words = [f"w{i}" for i in range(8)]
    sets = [words, words[:7], words[::-1], words[:4], ["z"], []]
    rows = [(i, (None, "s0", "s1", "s2")[i % 4] if i % 9 else None, "q" if i % 11 else None, sets[i % 6], None if i % 5 == 0 else date(2026, 9, 1 + i % 17)) for i in range(300)]
    seen = []
    for n in (150, 300):
        df = spark.createDataFrame(rows[:n], "id int, s string, g string, t array<string>, c date")
        _, classes = match._classes(df, "id", "s", "g", "t", "c", 400)
        seen.append((classes.count(), match._similar_classes(classes, 0.82, 400, 7, True).count()))
    assert seen[0] == seen[1]

    def alike(a, b):
        near = a[4] is None and b[4] is None or a[4] and b[4] and abs((a[4] - b[4]).days) <= 7
        both = len({*a[3]} & {*b[3]}) / (len({*a[3]} | {*b[3]}) or 1)
        return both if a[1] and b[1] and a[1] != b[1] and a[2] and b[2] and near and both >= 0.82 else None

    want = {(a[0], b[0]): x for a in rows for b in rows if a[0] < b[0] and (x := alike(a, b))}
    pairs = match.similar_pairs(df, "id", "s", "g", "t", "c").collect()
    assert {(r["a"], r["b"]): r["similarity"] for r in pairs} == want and len(pairs) == len(want) > 1000
    told = {i: "|".join(sorted(f"high_title_similarity:{x:.2f}" for ab, x in want.items() if i in ab)) for i in {i for ab in want for i in ab}}
    assert {r["id"]: r["reasons"] for r in match.similarity_reasons(df, "id", "s", "g", "t", "c").collect()} == told
    # a class of more titles than the cap has no token of so few
    assert match.similarity_reasons(df, "id", "s", "g", "t", "c", cap=40).count() == 0


def common_titles(n=450, seed=5):
    """Every token is in more than 400 titles: many titles of one set, and others that differ by a token."""
    rng = random.Random(seed)
    sets = [[f"w{i}" for i in range(12)], [f"w{i}" for i in range(13)], [f"w{i}" for i in range(1, 13)], [f"w{i}" for i in range(3, 13)]]
    rows = [(i, f"s{i % 3}", "q", sets[0 if i % 3 == 2 else rng.randrange(4)], None if i % 7 == 0 else date(2026, 9, 1 + rng.randrange(28))) for i in range(2 * n)]
    near = lambda a, b: a[4] is None and b[4] is None or a[4] and b[4] and abs((a[4] - b[4]).days) <= 7
    share = {(i, j): len({*x} & {*y}) / len({*x} | {*y}) for i, x in enumerate(sets) for j, y in enumerate(sets)}
    which = [sets.index(r[3]) for r in rows]
    want = {(a[0], b[0]): x for a in rows for b in rows if a[0] < b[0] and a[1] != b[1] and (x := share[which[a[0]], which[b[0]]]) >= 0.82 and near(a, b)}
    return rows, want


SCHEMA = "id int, s string, g string, t array<string>, c date"


def test_pairs_of_common_tokens_are_whole(spark):
    """No bound of titles for a token, in the query and in its SQL; any number of blocks gives each pair once."""
    rows, want = common_titles()
    df = spark.createDataFrame(rows, SCHEMA)
    for block in (500, 70):
        pairs = match.similar_pairs(df, "id", "s", "g", "t", "c", block=block).collect()
        assert {(r["a"], r["b"]): r["similarity"] for r in pairs} == want and len(pairs) == len(want) > 50_000
    assert "between 2 and" not in registry.oracle_sql()["title_similarity_pairs"]


def test_reasons_of_common_tokens_name_every_partner(spark):
    """More partners of a title than any bound, of sources and dates of either sign; one reason for each."""
    rows, want = common_titles()
    rows, seen = [(*r[:4], r[4] and date.fromordinal(r[4].toordinal() - date(2026, 9, 14).toordinal() + date(1970, 1, 1).toordinal())) for r in rows], {}
    for ab, x in want.items():
        for i in ab:
            seen.setdefault(i, []).append(f"high_title_similarity:{x:.2f}")
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r["reasons"] for r in match.similarity_reasons(df, "id", "s", "g", "t", "c").collect()}
    assert got == {i: "|".join(sorted(x)) for i, x in seen.items()} and len(got) > 400
    assert "between 2 and" not in registry.oracle_sql()["look_alike_reasons"]


def test_flags_of_common_titles(spark, tmp_path):
    """The query itself, on documents whose titles are all of tokens that over 400 others have."""
    docs = [(i, "north gate water pump works\nbody", "en", f"src{i % 2}") for i in range(500)] + [(500, "north gate\nbody", "en", "src0")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["possible_cross_source_duplicate"] for r in registry.queries()["similarity_flags"](spark, str(tmp_path)).collect()}
    assert got == {i: i < 500 for i in range(501)}
    assert "between 2 and" not in registry.oracle_sql()["similarity_flags"]


def test_sketches_differ_in_no_more_bits_than_sets(spark):
    rng = random.Random(3)
    rows = [([f"w{rng.randrange(n)}" for _ in range(m)], [f"w{rng.randrange(n)}" for _ in range(m)]) for n, m in ((5, 3), (40, 30), (3000, 900)) for _ in range(40)]
    df = spark.createDataFrame([(sorted(set(a)), sorted(set(b))) for a, b in rows], "a array<string>, b array<string>")
    bits = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(match._sketch(F.col("a"), 4), match._sketch(F.col("b"), 4))), F.lit(0))
    apart = F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))
    got = [tuple(r) for r in df.select(bits, apart).collect()]
    assert all(b <= d for b, d in got) and sum(b > 0 for b, _ in got) > 70


def test_first_duplicates_are_those_of_rank_one(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice("abc"), rng.choice([None, "2026-01-01", "2026-01-02"]), f"d{rng.randrange(2)}", f"r{rng.randrange(2)}", "o", i) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, f string, scraped string, run_date string, run_id string, object_name string, pos int")
    ranked = {r["i"]: r["duplicate_rank"] for r in identity.rank_exact_duplicates(df, "f", "scraped").collect()}
    assert {r["i"]: r["duplicate_rank"] for r in identity.first_exact_duplicates(df, "f", "scraped").collect()} == {i: min(n, 2) for i, n in ranked.items()}


def test_profile(spark):
    df = spark.createDataFrame([("s", "t", None, "2026-01-01T00:00:00Z", "f"), ("s", "t", None, "2026-01-01T00:00:00Z", "f"), ("s", " ", "x", "bad", "g")], "source string, title string, other string, ts string, path string")
    (r,) = profile.profile_4v(df, "source", "ts", "path", ["title"]).collect()
    assert (r["rows"], r["exact_duplicates"], r["missing_cells"], r["missing_percent"], r["files"], r["missing_titles"], r["span_hours"]) == (3, 1, 3, 25.0, 2, 1, 0.0)


@pytest.mark.parametrize("missing", [[], ["x"]])
def test_title_column(missing):
    class Frame:
        columns = ["b", "a"]

    assert profile.title_column(Frame, [*missing, "a", "b"]) == "a"


def test_phrases_are_found_by_one_pattern(spark):
    """Overlapping phrases, phrases that begin others, prefixed ones, ones with signs; no word is looked up among all phrases."""
    phrases = lexicon.compile_phrases(spark, {"tech": ["data", "data base", "base of sets", "c#", "س ص", "بالس"], "weak": ["of", "data base of"]})
    df = spark.createDataFrame([(1, "data base of sets"), (2, "database"), (3, "x c# y"), (4, "a-c#-b"), (5, "x data-base"), (6, "وبالس ص"), (7, "data"), (8, "")], "id int, norm string")
    out = lexicon.first_phrases(df, "id", "norm", phrases, ["tech", "weak"])
    assert {r["id"]: (r["tech"], r["weak"]) for r in out.collect()} == {1: ("base of sets", "data base of"), 3: ("c#", None), 5: ("data base", None), 6: ("بالس", None), 7: ("data", None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and "slice(" not in plan


def test_similarity_is_printed_by_its_exact_value(spark):
    shares = sorted({a / b for b in range(1, 201) for a in range(b + 1)})
    df = spark.createDataFrame([(x,) for x in shares], "x double")
    assert [r[0] for r in df.select(match.two_places(F.col("x"))).collect()] == [f"{x:.2f}" for x in shares]
    assert [r[0] for r in df.where("x in (0.975, 0.925, 0.875)").select(match.two_places(F.col("x"))).collect()] == ["0.88", "0.93", "0.97"]
