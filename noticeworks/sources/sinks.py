"""Sinks and the tables' readers: tables with a current version, CSV copies, audit reports. Rows written are compared with rows read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from noticeworks.operators.quality import Gate
from noticeworks.sources.table import Table


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df, and the number of its rows once it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _same(path: str, written: int | None, back: int) -> None:
    if (written or 0) != back:
        raise ValueError(f"{path}: {written} rows written, {back} read back")


def write_table_overwrite(df: DataFrame, path: str, key: str | None = None, gates: Sequence[Gate] = ()) -> int:
    """df becomes the table's current version, once its rows, its key and the gates are checked; returns the version. The table may
    be read and replaced: readers keep the old version until the new one is committed, and a failure leaves it current."""
    return Table(df.sparkSession, path, key).overwrite(df, gates)


def read_silver(spark: SparkSession, path: str, csv_path: str | None = None, schema: str | None = None) -> DataFrame:
    """The current version of a table, or the Parquet files of a plain folder; its CSV copy where there is neither."""
    now = Table(spark, path).read()
    if now is not None:
        return now
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        if not csv_path:
            raise
        reader = spark.read.option("header", "true").option("nullValue", "").option("multiLine", "true").option("escape", '"')
        return (reader.schema(schema) if schema else reader).csv(csv_path)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """The table by name: its current version, now and after each later commit."""
    Table(spark, path).register(name)


def write_csv_copy(df: DataFrame, path: str) -> int:
    """A CSV copy: dates yyyy-MM-dd, timestamps ISO in UTC, nulls blank; its rows are read back and checked. Returns their number."""
    rows, seen = _observed(df)
    writer = rows.write.mode("overwrite").option("header", "true").option("dateFormat", "yyyy-MM-dd").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    writer.option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)
    back = df.sparkSession.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    found = back.count()
    _same(path, seen.get["rows"], found)
    return found


def write_audit(reports: dict[str, DataFrame], root: str, run_date: str, run_id: str) -> None:
    """Every report under its own folder, partitioned by run; a run's reports are never replaced."""
    for name, df in reports.items():
        df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{name}/run_date={run_date}/run_id={run_id}")


def read_audit(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A report of all runs, with run_date and run_id."""
    return spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/{name}")
