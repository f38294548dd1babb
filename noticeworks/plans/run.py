"""A run from end to end: choose bronze objects, gate them, build silver, commit it, write audit reports, summary and copies; and gold."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.operators import classify, gold, identity, mapping, match, profile, quality, upsert
from noticeworks.plans import medallion
from noticeworks.sources import bronze, sinks
from noticeworks.sources.table import Table
from noticeworks.staging import drop_staged, staged, staged_count

MODES = ("auto", "rebuild", "incremental", "explicit")


def bronze_gates(files: DataFrame, sources: list[str]) -> None:
    """A run has one file under one path, and every expected source has been seen; else the run stops here, with their names."""
    known = files.where(F.col("source").isin(sources))
    twice = bronze.duplicate_runs(known).select(F.concat_ws("/", "source", "run_id").alias("name"), F.lit("runs under several paths").alias("what"))
    expected = files.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    unseen = bronze.missing_sources(known, expected).select(F.col("source").alias("name"), F.lit("missing sources").alias("what"))
    found = twice.unionByName(unseen).groupBy("what").agg(F.count("*").alias("n"), F.min("name").alias("first")).collect()
    if found:
        raise ValueError("bronze: " + "; ".join(sorted(f"{r['n']} {r['what']}, such as {r['first']}" for r in found)))


def selected(files: DataFrame, table: Table, mode: str, run_id: str | None, sources: list[str]) -> tuple[str, DataFrame]:
    """The mode that `auto` stands for (explicit for a named run; incremental if the table has rows and knows what it has
    processed; else rebuild), and the objects of the run."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    if mode == "auto":
        state = table.state()
        mode = "explicit" if run_id else "incremental" if state and state["objects"] else "rebuild"
    known = files.where(F.col("source").isin(sources))
    if mode == "explicit":
        if not run_id:
            raise ValueError("an explicit run needs its run_id")
        return mode, bronze.select_explicit_run(known, run_id, files.sparkSession.createDataFrame([(s,) for s in sources], "source string"))
    return mode, bronze.select_incremental(known, table.processed()) if mode == "incremental" else bronze.select_rebuild(known)


def reports(records: DataFrame, rows: DataFrame) -> dict[str, DataFrame]:
    """The audit reports of a run: profile of the records, and of the disposed rows what was classified, standardised, cleaned,
    removed and flagged."""
    kind = lambda x: rows.where(F.col("disposition") == x)
    named = rows.withColumnsRenamed({"classification_method": "method"})
    return {
        "profile_4v": profile.profile_records(records, "source", ["_extracted_at"], mapping.TITLE_FIELDS, "object_name"),
        "classification_summary": classify.class_summary(rows, "source"),
        "classification_methods": classify.method_summary(named, "source"),
        "standardization_report": mapping.standardization_report(rows),
        "source_standardization_report": mapping.standardization_report(rows, "source"),
        "cleaning_report": quality.cleaning_report(rows),
        "source_cleaning_report": quality.cleaning_report(rows, "source"),
        "reconciliation_report": identity.reconcile(rows),
        "final_quality_report": match.final_quality_report(rows),
        "id_collisions": identity.id_collisions(rows),
        "possible_cross_source_duplicates": match.possible_duplicates(kind("accepted")),
        "duplicates_removed": upsert.drop_working_columns(kind("duplicate")),
        "superseded_snapshots": upsert.drop_working_columns(kind("superseded")),
        "rejected_rows": upsert.drop_working_columns(quality.issue_rows(kind("rejected"))),
    }


def run_silver(
    spark: SparkSession, root: str, table: Table, run: medallion.Run, mode: str = "auto", explicit_run: str | None = None, sources: list[str] | None = None,
    dry_run: bool = False, audit: str | None = None, csv_copy: str | None = None, lexicon: dict | None = None, on_step: Callable[[str], None] = lambda step: None,
) -> dict:
    """One run over a bronze tree; returns its summary (which is an audit report as well).

    rebuild takes all history and replaces the table; incremental takes the objects that the table hasn't processed and upserts;
    explicit upserts one complete run, and doesn't count as processed. A dry run does all but commit and write. The rows, what they were
    made from and what was measured as they were written are one commit: gates that fail, or a crash, leave the old version current,
    and a run that is repeated after either gives the same table. Nothing to do is a summary with operation `none`.
    on_step is told of each step as it begins."""
    begun = staged_count(spark)
    sources = sources or list(mapping.FIELDS)
    on_step("select")
    files = staged(bronze.list_objects(spark, root), "files")
    bronze_gates(files.where("parts = 3"), sources)
    mode, objects = selected(files.where("parts = 3"), table, mode, explicit_run, sources)
    objects = staged(objects.select("object_name", "source", "run_date", "run_id"), "objects")
    span = objects.agg(F.count("*").alias("objects"), F.count_distinct("run_id").alias("runs"), F.min("run_date").alias("first_date"), F.max("run_date").alias("last_date")).first().asDict()
    summary = {"run_id": run.run_id, "run_date": run.run_date, "mode": mode, "dry_run": dry_run, "bronze": span, "unexpected_objects": bronze.unexpected_objects(files).count(), "operation": "none"}
    if not span["objects"]:
        drop_staged(spark, begun)
        return summary | {"version": (table.state() or {}).get("version")}

    on_step("read")
    records = staged(bronze.read_bronze(spark, root, sources, objects), "records")
    quality.run_gates(records, [quality.Gate("malformed_objects", F.count_if("malformed"))])
    rows = staged(medallion.silver_rows(spark, records, run, lexicon), "silver")
    parts = identity.reconcile(rows).first().asDict()
    if not parts["reconciled"]:
        raise ValueError(f"rows lost or made: {parts}")
    summary |= {"rows": parts}
    quality.run_gates(rows, [*upsert.lineage_gates(), quality.Gate("collisions", F.count_distinct("tender_id", "business_key") - F.count_distinct("tender_id"), True)])

    batch = medallion.accepted(rows)
    before = None if mode == "rebuild" else table.read()
    if before is not None:
        summary |= {"upsert": upsert.upsert_stats(before, batch).first().asDict()}
    on_step("commit")
    done = None if mode == "explicit" else objects
    if not dry_run:
        write = table.overwrite if mode == "rebuild" else table.upsert
        version = write(batch, medallion.silver_gates(), done, upsert.run_metrics())
        summary |= {"operation": "overwrite" if mode == "rebuild" else "upsert", "version": version, "batch": table.state(version)["metrics"]}
        on_step("copies")
        if csv_copy:
            summary |= {"csv_rows": sinks.write_csv_copy(table.read(), csv_copy)}
        if audit:
            line = spark.createDataFrame([(json.dumps(summary, ensure_ascii=False, default=str),)], "summary string")
            sinks.write_audit(reports(records, rows) | {"run_summary": line}, audit, run.run_date, run.run_id)
    drop_staged(spark, begun)
    return summary


def run_gold(silver: Table, target: Table, as_of: str | None = None, missing: str = "Open", name: str | None = None, csv_copy: str | None = None, zone: str = "Asia/Riyadh") -> dict:
    """The dashboard table from the current silver: gates on what goes in, every row kept, committed, copied and shown by name."""
    rows = silver.read()
    if rows is None or not rows.limit(1).count():
        raise ValueError("silver has no rows")
    # older runs have another word for a pass
    rows = rows.withColumn("quality_status", quality.modern_status(F.col("quality_status")))
    quality.run_gates(rows, [quality.allowed("quality_status", ["PASS"]), quality.unique("tender_id")])
    day = gold.as_of_date(zone=zone, override=as_of)
    version = target.overwrite(gold.build_gold(rows, day, missing), gold.gold_gates(rows.count()))
    out = target.read(version)
    summary = {"version": version, "rows": target.state(version)["metrics"]["rows"], "counts": [r.asDict() for r in gold.gold_summary(out).collect()]}  # a row for each source, status and class
    if csv_copy:
        summary |= {"csv_rows": sinks.write_csv_copy(out, csv_copy)}
    if name:
        target.register(name)
    return summary
