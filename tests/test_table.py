import pytest
from pyspark.sql import functions as F

from noticeworks.operators import quality
from noticeworks.operators.upsert import newest_rows
from noticeworks.sources import sinks
from noticeworks.sources.table import Files, Table

SCHEMA = "tender_id string, scraped_at string, bronze_run_date string, v int"


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, SCHEMA + more)


def row(k, day, v, *more):
    return (k, day, day, v, *more)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_readers_find_the_current_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert Table(spark, path).read() is None and Table(spark, path).processed().count() == 0
    three = spark.range(3).select(F.col("id").cast("string").alias("k"))
    five = spark.range(5).select(F.col("id").cast("string").alias("k"))
    assert sinks.write_table_overwrite(three, path, "k") == 1
    sinks.register_table(spark, "notices", path)
    assert spark.table("notices").count() == 3
    now = spark.table("notices")
    assert sinks.write_table_overwrite(five, path, "k") == 3  # registering was a commit, too
    assert sinks.read_silver(spark, path).count() == 5 and spark.table("notices").count() == 5 and now.count() == 3
    # a table may be made from itself
    assert sinks.write_table_overwrite(sinks.read_silver(spark, path).where("k <> '4'"), path, "k") == 4
    assert spark.sql("select count(*) from notices").first()[0] == 4
    table = Table(spark, path, "k")
    table.rollback(1)
    assert table.read().count() == 3 and table.read(3).count() == 5 and spark.table("notices").count() == 3
    assert [(r["version"], r["operation"]) for r in table.history().orderBy("version").collect()] == [(1, "overwrite"), (2, "register"), (3, "overwrite"), (4, "overwrite"), (5, "rollback")]
    assert table.vacuum(keep=1) == 2 and table.read().count() == 3 and table.versions() == [5]


def test_a_crash_before_the_commit_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = Table(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, [row("a", "1", 0)]), objects=spark.createDataFrame([("o1",)], "object_name string"))

    def crash(self, name, text):
        raise OSError("gone")

    batch, objects = frame(spark, [row("b", "1", 1)]), spark.createDataFrame([("o2",)], "object_name string")
    with monkeypatch.context() as m:
        m.setattr(Files, "publish", crash)
        for write in (table.overwrite, table.upsert):
            with pytest.raises(OSError):
                write(batch, objects=objects)
    assert content(table.read()) == [row("a", "1", 0)] and content(table.processed()) == [("o1",)]
    table.upsert(batch, objects=objects)
    table.upsert(batch, objects=objects)
    assert content(table.read()) == [row("a", "1", 0), row("b", "1", 1)] and content(table.processed().distinct()) == [("o1",), ("o2",)]
    assert table.vacuum(keep=1) > 0 and content(table.read()) == [row("a", "1", 0), row("b", "1", 1)]


def test_gates_fail_before_the_commit(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, [row("a", "1", 0)]))
    with pytest.raises(ValueError, match=r"not committed, gates failed: not_null:v \(1\), unique:v \(1\)"):
        table.upsert(frame(spark, [row("b", "1", 1), row("c", "1", 1), row("d", "1", None)]).where("v is null or v = 1"), [quality.not_null("v"), quality.unique("v"), quality.non_blank("tender_id")])
    with pytest.raises(ValueError, match="key"):
        table.overwrite(frame(spark, [row("b", "1", 1), row("b", "2", 1)]))
    with pytest.raises(ValueError, match="other types than before: v"):
        table.upsert(frame(spark, [row("b", "1", 1)]).withColumn("v", F.col("v").cast("string")))
    assert content(table.read()) == [row("a", "1", 0)] and table.versions() == [1]
    assert table.upsert(frame(spark, []), [quality.not_null("v")]) == 2 and content(table.read()) == [row("a", "1", 0)]


def test_two_writers_make_one_commit(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, [row("a", "1", 0)]))
    with pytest.raises(RuntimeError, match="another writer"):
        table.files.publish("commits/00000000000000000001.json", "{}")
    assert content(table.read()) == [row("a", "1", 0)] and not [n for n in table.files.names("commits") if not n.endswith(".json") and not n.endswith(".crc")]


def test_upserts_write_their_batch_alone_and_equal_a_rebuild(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), compact_at=0.2)
    table.upsert(frame(spark, [row(f"k{i:05}", "2026-01-02", i) for i in range(20_000)]))
    base = table.files.bytes(table.state()["base"])
    batches = [
        frame(spark, [row(f"k{i:05}", "2026-01-03", -i, "x") for i in range(0, 20_000, 100)], ", extra string"),
        frame(spark, [row("k00100", "2026-01-01", 1), row("k00101", "2026-01-02", 2), row("k00100", "2026-01-03", 3), row("new", None, 4), row("new", "2026-01-01", 5)]),
        frame(spark, [row("new", "2026-01-01", 6), row("k00102", None, 7)]),
    ]
    rebuilt = table.read()
    for b in batches:
        before = set(table.files.names("data"))
        table.upsert(b)
        (added,) = set(table.files.names("data")) - before
        assert table.files.bytes(f"data/{added}") < 0.05 * base
        rebuilt = newest_rows(rebuilt.withColumn("n", F.lit(0)).unionByName(b.withColumn("n", F.lit(1)), allowMissingColumns=True), "tender_id", [F.col("scraped_at"), F.col("bronze_run_date"), F.col("n")]).drop("n")
        assert content(table.read()) == content(rebuilt)
    got = {r["tender_id"]: (r["v"], r["extra"]) for r in table.read().where("tender_id in ('k00100', 'k00101', 'k00102', 'k00200', 'new')").collect()}
    assert got == {"k00100": (3, None), "k00101": (2, None), "k00102": (102, None), "k00200": (-200, "x"), "new": (6, None)}
    assert len(table.state()["deltas"]) == 3
    table.compact()
    assert table.state()["deltas"] == [] and content(table.read()) == content(rebuilt)
    # deltas of over a fifth of the base are compacted at once
    table.upsert(frame(spark, [row(f"k{i:05}", "2026-02-01", 0) for i in range(15_000)]))
    assert table.state()["operation"] == "compact" and table.read().where("v = 0").count() == 15_000


def test_newest_rows_needs_no_window(spark):
    df = frame(spark, [row("hot", f"2026-01-{i % 28 + 1:02}", i) for i in range(300)] + [row(None, "1", 1), row(None, "1", 2), row("one", None, 1)])
    out = newest_rows(df, "tender_id", [F.col("scraped_at")])
    assert "Window" not in out._jdf.queryExecution().toString()
    got = content(out)
    assert [r for r in got if r[0] is None] == [row(None, "1", 1), row(None, "1", 2)] and ("one", None, None, 1) in got
    (hot,) = [r for r in got if r[0] == "hot"]
    assert hot[1] == "2026-01-28" and content(newest_rows(df.repartition(7), "tender_id", [F.col("scraped_at")])) == got
    assert content(newest_rows(df.select("tender_id", F.col("scraped_at").alias("_TOP")), "tender_id", [F.col("_TOP")]).where("tender_id = 'hot'")) == [("hot", "2026-01-28")]
