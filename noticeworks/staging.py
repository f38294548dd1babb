"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The JVM compiles no method of more bytes of code than this and interprets it ever after, which takes many times as long. Spark's own limit
#: is eight times as high; with this one, a step whose code would be longer runs operator by operator, in methods that are compiled.
LONGEST_METHOD = ("spark.sql.codegen.hugeMethodLimit", 8000)

_LOCAL: dict[str, str] = {}  # application id -> its folder, of local sessions without a shared one
_STAGED: dict[str, list[str]] = {}  # application id -> what it has staged and not dropped


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. A local session without one gets a temporary folder of its own; on a
    cluster, where that would be another folder on each machine, it is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="noticeworks-")
    return _LOCAL[context.applicationId]


def staged(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage, keeps plans small and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _write(df, path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def _write(df: DataFrame, path: str) -> None:
    conf, (key, most) = df.sparkSession.conf, LONGEST_METHOD
    before = conf.get(key)
    conf.set(key, str(min(most, int(before))))
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Deletes the table behind what staged() returned, once everything that reads it is itself staged."""
    spark, path = df.sparkSession, df._staged_at
    _delete(spark, path)
    _STAGED[spark.sparkContext.applicationId].remove(path)


def drop_staged(spark: SparkSession, keep: int = 0) -> int:
    """Deletes what this application has staged beyond its first `keep` tables; returns their number. Call it when the
    results that read them are written: a DataFrame that reads a dropped table can't be run again."""
    mine = _STAGED.get(spark.sparkContext.applicationId, [])
    gone = mine[keep:]
    for path in gone:
        _delete(spark, path)
    del mine[keep:]
    return len(gone)


def staged_count(spark: SparkSession) -> int:
    """How many tables there are now: drop_staged(spark, staged_count(spark)) later drops what came after."""
    return len(_STAGED.get(spark.sparkContext.applicationId, []))
