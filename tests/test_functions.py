from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from noticeworks.functions import dates, money, text
from noticeworks.operators import gold, upsert


def run(spark, f, *values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x string, i int").orderBy("i")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_money(spark):
    got = run(spark, money.parse_money, "1000.000 د.ك", "23,000.000 د.ك", "1,000.00", "(500)", "١٢٣٫٥", "1.000.000", "abc", "", None, "-7")
    assert [None if x is None else float(x) for x in got] == [1000, 23000, 1000, -500, 123.5, 1, None, None, None, -7]
    assert run(spark, lambda c: money.normalize_currency(c, F.lit("BHD")), "Qatari Riyal", "usd", None, "omr") == ["QAR", "BHD", "BHD", "OMR"]
    got = run(spark, lambda c: money.to_base_currency(F.lit(100), c), "KWD", "SAR", None)
    assert [None if x is None else float(x) for x in got] == [1225.17, 100.0, None]
    assert run(spark, money.canonical_country, "UAE", "Peru", None) == ["United Arab Emirates", "Peru", None]


def test_text(spark):
    assert run(spark, text.clean_text, "  N/A ", "a   b", "--", None) == [None, "a b", None, None]
    assert run(spark, text.display_token, "4722/2026", "XY-RFQ-1409", " / ", None) == ["4722-2026", "XY-RFQ-1409", "", ""]
    assert run(spark, text.compact_key, "qa_source_01", "AB-12 ة", None) == ["qasource01", "ab12ه", ""]
    assert run(spark, text.norm_match, "3D Mapping_v2", "Straße  أحمد", "ﬁne-é") == ["3 d mapping v2", "strasse احمد", "fine e"]
    assert run(spark, text.external_refs, "Renewal AB/12/2026 of X", "and/or/else", None) == [["AB/12/2026"], [], []]
    assert run(spark, text.title_tokens, "The Supply of IT إلى قطر") == [["supply", "الي"]]
    assert run(spark, lambda c: text.leaf_texts(F.parse_json(c)), '{"a":["x",{"b":" y "}],"c":3,"d":null,"e":"q\\"r"}') == [["x", "y", "3", 'q"r']]
    assert run(spark, lambda c: text.build_url("http://x/", c, F.lit(None)), "a b", None) == ["http://x/a%20b", None]
    assert run(spark, lambda c: text.pipe_field(c, "Type"), "a | b | type | Open | x", "none") == ["Open", None]


@pytest.mark.parametrize(
    ("source", "shown", "want"),
    [
        ("bh_source_01", "13, Sep,2026", date(2026, 9, 13)), ("kw_source_01", "سبتمبر 5, 2026", date(2026, 9, 5)), ("sa_source_01", "2026-09-23 2026-09-23 09:59 09:59", date(2026, 9, 23)),
        ("qa_source_02", "13-Sep-2026 9:10 AM", date(2026, 9, 13)), ("ae_source_01", "20/09/2026 01:02:03 PM", date(2026, 9, 20)), ("om_source_01", "19-10-2026", date(2026, 10, 19)),
        ("other", "/Date(1758585540000)/", date(2025, 9, 23)), ("other", "04/10/2026", date(2026, 10, 4)), ("other", "2026-13-45", None), ("other", "n/a", None),
    ],
)
def test_source_dates(spark, source, shown, want):
    assert run(spark, lambda c: F.to_date(dates.parse_source_date(F.lit(source), c)), shown) == [want]


def test_free_dates_and_zones(spark):
    assert run(spark, dates.parse_any_date, "25 Sep 2026", "17, Sep,2026", "أكتوبر 20, 2026", "05/06/2026", "x", None) == [date(2026, 9, 25), date(2026, 9, 17), date(2026, 10, 20), date(2026, 6, 5), None, None]
    assert run(spark, dates.parse_utc_timestamp, "2026-01-02T03:04:05+03:00", "2026-01-02 03:04:05", "x") == [datetime(2026, 1, 2, 0, 4, 5), datetime(2026, 1, 2, 3, 4, 5), None]
    assert run(spark, lambda c: dates.target_date(c.cast("timestamp")), "2026-09-25 22:00:00") == [date(2026, 9, 25)]


def test_status(spark):
    as_of = F.lit("2026-09-25").cast("date")
    assert run(spark, lambda c: gold.open_closed(c.cast("date"), as_of), "2026-09-25", "2026-09-24", None) == ["Open", "Closed", "Open"]
    assert run(spark, lambda c: gold.open_closed(c.cast("date"), as_of, "Unknown"), None) == ["Unknown"]
    assert run(spark, upsert.clean_source_status, "Open", "Amended", None, "Draft", "(Blanks)") == ["active", "amended", "unknown", "draft", "unknown"]


def test_folding_shows_python_single_characters(spark):
    """Whole texts never go to Python, and every character folds as its decomposition does."""
    import unicodedata

    def fold(x):
        kept = "".join(ch for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch) and unicodedata.category(ch) != "Cf").casefold()
        return kept.translate({ord(a): text.ARABIC_TO[i : i + 1] for i, a in enumerate(text.ARABIC_FROM)})

    chars = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["A" + "b".join(chars[i : i + 512]) for i in range(0, len(chars), 512)]
    df = spark.createDataFrame([(x,) for x in texts], "t string").repartition(1)
    assert [r[0] for r in df.select(text._folded(F.col("t"))).collect()] == [fold(r["t"]) for r in df.collect()]
    plan = df.select(text.norm_match("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_changes(array_join(array_distinct(" in plan


def test_texts_without_net_dates_are_never_cast(spark):
    """A failed cast is an exception for each row."""
    assert run(spark, lambda c: dates.dotnet_date(c).cast("string"), "5 Jan 2026", "/Date(x)/", "/Date(0)/", None) == [None, None, "1970-01-01 03:00:00", None]
    plan = spark.range(1).select(dates.dotnet_date(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "contains(" in plan


def test_orders_of_the_chain_are_dealt_to_all_cores(spark):
    from noticeworks.plans import registry

    for f in (registry._priced, registry._as_bronze):
        plan = f(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition " in plan


def test_long_and_short_months_are_read_by_their_formats_alone(spark):
    from noticeworks.functions import dates

    texts = ["May 5, 2026", "MAY 5, 2026", "Mar 5, 2026", "march 5, 2026", "September 5, 2026", "Sep 5, 2026", "Marc 5, 2026", "5 August 2026", "5-Aug-2026", "5-August-2026", "مارس 5, 2026"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").orderBy("i")
    formats = ["MMMM d, yyyy", "MMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy"]
    tried = F.coalesce(*[F.try_to_timestamp("x", F.lit(f)) for f in formats])
    got = [tuple(map(str, r)) for r in df.select(dates.try_formats(F.col("x"), formats), tried).collect()]
    assert [a for a, _ in got] == [b for _, b in got] and sum(a != "None" for a, _ in got) == 8
    plan = df.select(dates.try_formats(F.col("x"), formats))._jdf.queryExecution().analyzed().toString()
    assert plan.count("RLIKE") >= len(formats)  # readings that can't succeed aren't tried


def test_reports_of_cleaning_write_only_what_they_read(spark, tmp_path):
    from noticeworks.operators import mapping, quality

    rows = [("kw_source_01", f'{{"Tender Number": "K-{i}", "Title": " T {i} ", "Open Date": "Mar {1 + i % 28}, 2026", "Close Date": "{d}", "Link": null, "Document Price": "5"}}') for i, d in enumerate(["no date", "مارس 3, 2026", "May 3, 2026", "March 3, 2026"] * 3)]
    recs = spark.createDataFrame(rows, "source string, r string").select("source", F.lit("2026-01-01").alias("run_date"), F.lit("r").alias("run_id"), F.lit("p").alias("file_path"), F.lit("o").alias("object_name"), F.parse_json("r").alias("rec"))
    whole = mapping.standardise(recs).drop("rec")
    report = lambda d: {r["metric"]: r["value"] for r in quality.cleaning_report(quality.with_quality(d)).collect()}
    full = report(quality.clean(whole))
    assert report(quality.clean(whole.select(*quality.CLEANED_FROM)).select(*quality.FLAGGED_FROM)) == full
    assert (full["rows"], full["closing_date_parse_failed"], full["missing_source_url"], full["missing_published_date"]) == (12, 3, 12, 0)


def test_mapping_does_not_grow_with_its_sources(spark):
    """A record is taken apart once, so that what Spark compiles for it stays as long; names with marks, nested values and nulls as before."""
    from noticeworks.operators import mapping

    recs = ['{"A. q\'s": " x ", "B": {"z": 1, "a": [2]}, "C": null}', '{"B": 3.50, "A": ""}', '["A"]', '"A"', None]
    df = spark.createDataFrame([(s, r) for r in recs for s in ("s0", "s1", "other", None)], "source string, r string").withColumn("rec", F.try_parse_json("r"))
    two = {"s0": {"title": ["A. q's"], "authority": ["B"], "tender_number": ["C", "B"]}, "s1": {"title": ["A"], "tender_number": ["B"]}}
    many = {**two, **{f"t{i}": two["s0"] for i in range(40)}}
    plans = [mapping.map_columns(df, mapping=m)._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get") for m in (two, many)]
    assert plans[0] == plans[1]
    found = mapping.map_columns(df, mapping=many)
    for t in ("title", "authority", "tender_number"):
        want = F.lit(None).cast("string")
        for s, fields in two.items():
            if t in fields:
                want = F.when(F.col("source") == s, F.coalesce(*[mapping.field(F.col("rec"), f) for f in fields[t]])).otherwise(want)
        assert found.where(~F.col(t).eqNullSafe(want)).count() == 0
    assert found.where("title is not null").count() == 1 and found.where("tender_number is not null").count() == 4


def test_dates_are_cleaned_and_read_as_one_by_one(spark):
    from noticeworks.operators import quality

    texts = ["2026-01-05 2026-01-05", "2026-01-05  2026-01-05 2026-01-05", "2026-01-05 2026-01-05 2026-01-05 2026-01-05", " 5\t Jan 2026 ", "5 يناير 2026", "5\u00a0يناير  2026", "n/a", " ", None, "5/1/2026 3:04:05 3:04:05 PM", "2026-01-05 03:04 03:04", "May 5, 2026", "/Date(1767571200000)/", "5 1 2026", "no date"]
    rows = [(s, t, t) for t in texts for s in [*dates.SOURCE_FORMATS, None]]
    df = spark.createDataFrame(rows, "source string, published_date_raw string, was string").withColumns({c: F.lit(None).cast("string") for c in quality.CLEANED_FROM if c not in ("source", "published_date_raw")})
    repaired = dates.repair_date_text(F.col("was"))
    bad = quality.clean(df).where(~F.col("published_date_raw").eqNullSafe(repaired) | ~F.col("published_date").eqNullSafe(dates.to_business_date(dates.parse_source_date(F.col("source"), repaired))))
    assert [tuple(r) for r in bad.select("source", "was", "published_date_raw").collect()] == [] and quality.clean(df).where("published_date is not null").count() > 60


def test_staged_steps_run_in_methods_that_the_jvm_compiles(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from noticeworks import staging

    key, seen, write = staging.LONGEST_METHOD[0], [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(key)), write(self, *a, **b))[1])
    before = spark.conf.get(key)
    assert staging.staged(spark.range(3), "x").count() == 3 and seen == ["8000"] and spark.conf.get(key) == before
