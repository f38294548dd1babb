"""The incremental path as a stream: new bronze files in micro-batches, upserted newest-wins into a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from noticeworks.operators.quality import Gate
from noticeworks.sources.bronze import FILES, object_columns, parse_objects, whole_files
from noticeworks.sources.table import Table
from noticeworks.staging import drop_staged, staged, staged_count


def stream_bronze(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Records of files not seen before (the checkpoint remembers them); the root's layout is read recursively."""
    raw = spark.readStream.schema("value string").option("recursiveFileLookup", "true").option("pathGlobFilter", FILES).option("maxFilesPerTrigger", files_per_batch).text(root, wholetext=True)
    return parse_objects(object_columns(whole_files(raw, root)).where("parts = 3").drop("parts"))


def stream_upsert(stream: DataFrame, target: Table, checkpoint: str, shape: Callable[[DataFrame], DataFrame], gates: Sequence[Gate] = ()):
    """Runs over all files there are: each micro-batch is shaped and upserted, in one commit with the names of its objects;
    the checkpoint moves on after it. A batch that comes again because the run ended in between, or by a new checkpoint, is known by
    its objects and changes nothing. What a batch has staged goes with it."""

    def each(batch: DataFrame, batch_id: int) -> None:
        before = staged_count(batch.sparkSession)
        fresh = batch.join(target.processed(), "object_name", "left_anti")
        objects = staged(fresh.select("object_name").distinct(), "objects")
        if objects.limit(1).count():
            target.upsert(staged(shape(fresh), "batch"), gates, objects)
        drop_staged(batch.sparkSession, before)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
