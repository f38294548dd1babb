import json

import pytest
from pyspark.sql import functions as F

from noticeworks.plans import medallion
from noticeworks.plans.run import run_gold, run_silver
from noticeworks.sources import bronze, sinks
from noticeworks.sources.table import Table

SOURCES = ["qa_source_03", "ae_source_02"]


def put(root, source, date, run, records):
    path = root / source / date
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{run}.json").write_text(records if isinstance(records, str) else json.dumps(records))


def notice(i, at, **more):
    return {"Item ID": f"T-{i}", "Title": f"Supply of item {i}", "Published Date": "01 Sep 2026", "Closing Date": "20 Sep 2026", "Detail URL": f"http://x/{i}", "_page": 1, "_extracted_at": at, **more}


def run_of(n):
    return medallion.Run(f"s{n}", f"2026-09-0{n}")


def content(table):
    cols = ["tender_id", "title", "scraped_at", "classification", "bronze_blob_name"]
    return sorted(map(tuple, table.read().select(*cols).collect()), key=str)


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "bronze"
    put(root, "qa_source_03", "2026-09-01", "run1", [notice(1, "2026-09-01T00:00:00Z"), notice(2, "2026-09-01T00:00:00Z"), {**notice(3, "2026-09-01T00:00:00Z"), "Published Date": "gibberish"}])
    put(root, "ae_source_02", "2026-09-01", "run1", [notice(7, "2026-09-01T00:00:00Z")])
    return root


def test_rebuild_incremental_and_explicit_agree(spark, tree, tmp_path):
    stepwise, audit = Table(spark, str(tmp_path / "stepwise")), str(tmp_path / "audit")
    first = run_silver(spark, str(tree), stepwise, run_of(1), sources=SOURCES, audit=audit, csv_copy=str(tmp_path / "copy"))
    assert (first["mode"], first["operation"], first["version"], first["csv_rows"]) == ("rebuild", "overwrite", 1, 3)
    assert first["rows"] == {"input": 4, "rejected": 1, "duplicate": 0, "superseded": 0, "accepted": 3, "reconciled": True}
    assert first["bronze"] == {"objects": 2, "runs": 1, "first_date": "2026-09-01", "last_date": "2026-09-01"} and first["batch"]["rows"] == 3 and first["batch"]["sources"] == 2
    nothing = run_silver(spark, str(tree), stepwise, run_of(2), sources=SOURCES)
    assert (nothing["mode"], nothing["operation"], nothing["version"]) == ("incremental", "none", 1)

    put(tree, "qa_source_03", "2026-09-03", "run3", [notice(1, "2026-08-01T00:00:00Z", Title="late and old"), notice(2, "2026-09-03T00:00:00Z", Title="Supply of software 2"), notice(4, "2026-09-03T00:00:00Z")])
    put(tree, "qa_source_03/deeper", "2026-09-03", "run3", [])
    dry = run_silver(spark, str(tree), stepwise, run_of(3), sources=SOURCES, dry_run=True)
    assert dry["operation"] == "none" and dry["upsert"] == {"inserted": 1, "matched": 2, "updated": 1, "kept_existing_newer": 1} and stepwise.versions() == [1]
    again = run_silver(spark, str(tree), stepwise, run_of(3), sources=SOURCES, audit=audit)
    assert (again["mode"], again["operation"], again["upsert"], again["unexpected_objects"]) == ("incremental", "upsert", dry["upsert"], 1)
    assert content(stepwise)[0:0] == [] and {r[0] for r in stepwise.processed().collect()} == {"qa_source_03/2026-09-01/run1.json", "ae_source_02/2026-09-01/run1.json", "qa_source_03/2026-09-03/run3.json"}

    rebuilt = Table(spark, str(tmp_path / "rebuilt"))
    assert run_silver(spark, str(tree), rebuilt, run_of(4), mode="rebuild", sources=SOURCES)["operation"] == "overwrite"
    assert content(rebuilt) == content(stepwise)
    by_run = Table(spark, str(tmp_path / "by_run"))
    with pytest.raises(ValueError, match="run3"):
        run_silver(spark, str(tree), by_run, run_of(5), explicit_run="run3", sources=SOURCES)  # it lacks a source
    explicit = run_silver(spark, str(tree), by_run, run_of(5), explicit_run="run1", sources=SOURCES)
    assert explicit["mode"] == "explicit" and by_run.read().count() == 3 and by_run.processed().count() == 0

    # the reports of both runs, and the summary that was returned
    lines = {r["run_id"]: json.loads(r["summary"]) for r in sinks.read_audit(spark, audit, "run_summary").collect()}
    assert lines["s1"] == json.loads(json.dumps(first, default=str)) and lines["s3"]["upsert"] == again["upsert"]
    rejected = sinks.read_audit(spark, audit, "rejected_rows").where("run_id = 's1'")
    assert rejected.count() == 1 and "source_record_json" not in rejected.columns
    profile = sinks.read_audit(spark, audit, "profile_4v").where("run_id = 's1' and source = 'qa_source_03'").first()
    assert (profile["rows"], profile["columns"], profile["missing_cells"]) == (3, 7, 0)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.write_audit({"run_summary": spark.range(1)}, audit, "2026-09-01", "s1")


def test_a_run_that_ends_in_between_is_repeated(spark, tree, tmp_path):
    table, audit = Table(spark, str(tmp_path / "t")), str(tmp_path / "audit")

    def end_at(step):
        def on_step(now):
            if now == step:
                raise OSError("executors and driver are gone")

        return on_step

    for step in ("read", "commit"):
        with pytest.raises(OSError):
            run_silver(spark, str(tree), table, run_of(1), sources=SOURCES, on_step=end_at(step))
        assert table.read() is None and table.processed().count() == 0
    with pytest.raises(OSError):
        run_silver(spark, str(tree), table, run_of(1), sources=SOURCES, on_step=end_at("copies"))
    once = content(table)
    assert len(once) == 3 and run_silver(spark, str(tree), table, run_of(1), sources=SOURCES, audit=audit)["operation"] == "none" and content(table) == once


def test_gates_on_bronze_stop_a_run(spark, tree, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="1 missing sources, such as om_source_01"):
        run_silver(spark, str(tree), table, run_of(1), sources=[*SOURCES, "om_source_01"])
    put(tree, "ae_source_02", "2026-09-02", "run1", [notice(7, "2026-09-02T00:00:00Z")])
    with pytest.raises(ValueError, match="1 runs under several paths, such as ae_source_02/run1"):
        run_silver(spark, str(tree), table, run_of(1), sources=SOURCES)
    (tree / "ae_source_02" / "2026-09-02" / "run1.json").rename(tree / "ae_source_02" / "2026-09-02" / "run2.json")
    put(tree, "ae_source_02", "2026-09-03", "run3", "{broken")
    with pytest.raises(ValueError, match=r"malformed_objects \(1\)"):
        run_silver(spark, str(tree), table, run_of(1), sources=SOURCES)
    with pytest.raises(ValueError, match="mode"):
        run_silver(spark, str(tree), table, run_of(1), mode="other", sources=SOURCES)
    assert table.read() is None


def test_objects_are_read_alone(spark, tree):
    recs = spark.createDataFrame([("qa source+1", '{"Item ID": "B"}'), ("qa source+1", '{"Item ID": "C"}')], "source string, j string")
    bronze.land_bronze(recs.select("source", F.parse_json("j").alias("rec")), str(tree), "2026-09-07T01:02:03")
    files = bronze.list_objects(spark, str(tree))
    some = files.where("run_date = '2026-09-07' or source = 'ae_source_02'")
    assert {(r["source"], r["n"]) for r in bronze.read_bronze(spark, str(tree), objects=some).groupBy("source").agg(F.count("*").alias("n")).collect()} == {("qa source+1", 2), ("ae_source_02", 1)}
    assert bronze.read_bronze(spark, str(tree), objects=files.limit(0)).count() == 0


def test_gold_run(spark, tree, tmp_path):
    silver, gold = Table(spark, str(tmp_path / "s")), Table(spark, str(tmp_path / "g"))
    with pytest.raises(ValueError, match="no rows"):
        run_gold(silver, gold)
    run_silver(spark, str(tree), silver, run_of(1), sources=SOURCES)
    out = run_gold(silver, gold, "2026-09-21", name="gold_notices", csv_copy=str(tmp_path / "copy"))
    assert out["rows"] == out["csv_rows"] == 3 and {r["status"] for r in spark.table("gold_notices").collect()} == {"Closed"}
    run_gold(silver, gold, "2026-09-20")
    assert {r["status"] for r in spark.table("gold_notices").collect()} == {"Open"}
