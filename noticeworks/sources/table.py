"""A table with a current version. A commit is one small JSON file that names the folders which hold the rows, the objects
that they came from and what was measured as they were written. Data folders are written first and never changed;
the file appears by one rename, so a reader sees all of a commit or nothing of it, and a crash before the rename leaves
the old version. Rows and the list of processed objects move together, as one commit names both.

An upsert writes its batch alone, as a delta that readers merge; once deltas weigh more than a share of the base they
are compacted into a new one, whose files have a bounded size. One writer at a time: a second one that commits the same number fails.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeworks.naming import unused
from noticeworks.operators.quality import Gate, gates_report
from noticeworks.operators.upsert import newest_rows


class Files:
    """The file system of a path, through Spark's own client."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.jvm = spark, root.rstrip("/"), spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The file appears as a whole, and not if there is one of this name."""
        draft = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        no_options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self.context.rename(self._path(draft), self._path(name), no_options)
        except Exception as e:
            self.delete(draft)
            raise RuntimeError(f"{self.root}: {name} was committed by another writer") from e

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def bytes(self, name: str) -> int:
        return self.fs.getContentSummary(self._path(name)).getLength()


class Table:
    """Rows with a unique key (or without any, if key is None: then rows are only overwritten)."""

    def __init__(self, spark: SparkSession, path: str, key: str | None = "tender_id", order: Sequence[str] = ("scraped_at", "bronze_run_date"), compact_at: float = 0.25, most_deltas: int = 50, file_bytes: int = 256 << 20):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, tuple(order)
        self.compact_at, self.most_deltas, self.file_bytes = compact_at, most_deltas, file_bytes
        self.files = Files(spark, path)

    # -- versions

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names("commits") if n.endswith(".json") and not n.startswith(".")]

    def state(self, version: int | None = None) -> dict[str, Any] | None:
        """What a commit says; the newest one's if not told otherwise, None of a table without commits."""
        known = self.versions()
        if version is None and not known:
            return None
        return json.loads(self.files.read(_commit(known[-1] if version is None else version)))

    def history(self) -> DataFrame:
        """version, operation, base, deltas and metrics (JSON) of every commit."""
        rows = [(s["version"], s["operation"], s["base"], s["deltas"], json.dumps(s["metrics"])) for s in map(self.state, self.versions())]
        return self.spark.createDataFrame(rows, "version long, operation string, base string, deltas array<string>, metrics string")

    def _commit(self, before: dict | None, operation: str, base: str | None, deltas: list[str], schema: T.StructType, objects: list[str], metrics: dict, names: list[str] | None = None) -> int:
        version = 1 + (before["version"] if before else 0)
        now = {"version": version, "operation": operation, "base": base, "deltas": deltas, "objects": objects, "schema": json.loads(schema.json()), "metrics": metrics, "names": names if names is not None else (before or {}).get("names", [])}
        self.files.publish(_commit(version), json.dumps(now, ensure_ascii=False, default=str))
        for name in now["names"]:
            self._show(name, now)
        return version

    # -- reading

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version (the newest); None of a table without commits."""
        state = self.state(version)
        return None if state is None else self._rows(state)

    def _folder(self, name: str, schema: T.StructType) -> DataFrame:
        """A column that the folder lacks is null."""
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _rows(self, state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        base = self._folder(state["base"], schema) if state["base"] else self.spark.createDataFrame([], schema)
        if not state["deltas"]:
            return base
        (place,) = unused(base, "place")
        deltas = functools.reduce(DataFrame.unionByName, [self._folder(d, schema).withColumn(place, F.lit(k)) for k, d in enumerate(state["deltas"])])
        newest = newest_rows(deltas, self.key, [*_late(self.order), F.col(place)]).drop(place)
        # which side wins where both have a key; of the base only the key and the order are read for that
        both = base.select(F.col(self.key).alias("k"), F.struct(*_late(self.order)).alias("b")).join(newest.select(F.col(self.key).alias("k"), F.struct(*_late(self.order)).alias("d")), "k")
        older = both.where("b <= d").select(F.col("k").alias(self.key))
        kept = both.where("b > d").select(F.col("k").alias(self.key))
        return base.join(older, self.key, "left_anti").unionByName(newest.join(kept, self.key, "left_anti")).select(*schema.names)

    def processed(self, version: int | None = None) -> DataFrame:
        """The names of the objects whose records are in the table."""
        state = self.state(version)
        folders = [f"{self.path}/{f}" for f in state["objects"]] if state else []
        read = self.spark.read.schema("object_name string")
        return read.parquet(*folders) if folders else self.spark.createDataFrame([], "object_name string")

    # -- writing

    def _written(self, rows: DataFrame, gates: Sequence[Gate], metrics: dict[str, Column]) -> tuple[str, dict]:
        """A new folder with the rows, checked: gates and metrics are observed as the rows are written, and the number of rows and
        what needs all rows at once (unique values) from what is read back. Nothing is committed yet."""
        seen, name = Observation(), f"data/{uuid.uuid4().hex}"
        passing = [g for g in gates if not g.needs_all]
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[g.offences.cast("long").alias(f"gate {g.name}") for g in passing], *[c.alias(f"metric {k}") for k, c in metrics.items()]).write.parquet(f"{self.path}/{name}")
        found = seen.get
        if found["rows"] is None:  # no task had a row
            found = {"rows": 0}
        back = self._folder(name, rows.schema)
        keyed = [Gate("key", F.count("*") - F.count_distinct(self.key) if self.key else F.lit(0), True), Gate("rows", F.abs(F.count("*") - F.lit(found["rows"])))]
        offences = {g.name: found.get(f"gate {g.name}") or 0 for g in passing}
        offences |= {r["gate"]: r["offences"] for r in gates_report(back, [*keyed, *(g for g in gates if g.needs_all)]).collect()}
        failed = sorted(f"{k} ({n})" for k, n in offences.items() if n)
        if failed:
            self.files.delete(name)
            raise ValueError(f"{self.path}: not committed, gates failed: {', '.join(failed)}")
        return name, {"rows": found["rows"]} | {k: found.get(f"metric {k}") for k in metrics}

    def _objects(self, before: dict | None, objects: DataFrame | None, anew: bool) -> list[str]:
        old = [] if anew or not before else before["objects"]
        if objects is None:
            return old
        name = f"objects/{uuid.uuid4().hex}"
        objects.select(F.col("object_name").cast("string")).distinct().write.parquet(f"{self.path}/{name}")
        return [*old, name]

    def overwrite(self, rows: DataFrame, gates: Sequence[Gate] = (), objects: DataFrame | None = None, metrics: dict[str, Column] | None = None) -> int:
        """The rows become the table, and the objects (if given) those that are processed. Returns the version."""
        before = self.state()
        name, found = self._written(rows, gates, metrics or {})
        return self._commit(before, "overwrite", name, [], rows.schema, self._objects(before, objects, True), found)

    def upsert(self, batch: DataFrame, gates: Sequence[Gate] = (), objects: DataFrame | None = None, metrics: dict[str, Column] | None = None) -> int:
        """Newest wins: of the rows of a key the one that is last by the order columns, then that of the later commit. Columns are
        united; old rows lack new ones. The objects are added to those processed. Returns the version."""
        before = self.state()
        if before is None:
            return self.overwrite(newest_rows(batch, self.key, _late(self.order)), gates, objects, metrics)
        old = T.StructType.fromJson(before["schema"])
        kinds = {f.name: f.dataType for f in old}
        changed = [f.name for f in batch.schema if f.name in kinds and kinds[f.name] != f.dataType]
        if changed:
            raise ValueError(f"{self.path}: other types than before: {', '.join(changed)}")
        name, found = self._written(newest_rows(batch, self.key, _late(self.order)), gates, metrics or {})
        schema = T.StructType([*old, *[f for f in batch.schema if f.name not in kinds]])
        deltas = [*before["deltas"], *([name] if found["rows"] else [])]
        version = self._commit(before, "upsert", before["base"], deltas, schema, self._objects(before, objects, False), found)
        weight = sum(map(self.files.bytes, deltas))
        if len(deltas) > self.most_deltas or weight > self.compact_at * (self.files.bytes(before["base"]) if before["base"] else 0):
            version = self.compact()
        return version

    def compact(self) -> int:
        """The same rows as one folder, in files of about file_bytes by a hash of the key."""
        before = self.state()
        weight = sum(map(self.files.bytes, [before["base"], *before["deltas"]] if before["base"] else before["deltas"]))
        rows = self._rows(before)
        spread = rows.repartition(max(1, -(-weight // self.file_bytes)), self.key) if self.key else rows
        name, found = self._written(spread, (), {})
        return self._commit(before, "compact", name, [], rows.schema, self._merged(before), before["metrics"] | found)

    def _merged(self, before: dict) -> list[str]:
        """The processed objects as one folder."""
        return self._objects(None, self.processed(before["version"]), True) if len(before["objects"]) > 1 else before["objects"]

    def rollback(self, version: int) -> int:
        """An old version, with the objects that it had processed, becomes the newest."""
        old, before = self.state(version), self.state()
        return self._commit(before, "rollback", old["base"], old["deltas"], T.StructType.fromJson(old["schema"]), old["objects"], old["metrics"] | {"rolled_back_to": version})

    def vacuum(self, keep: int = 10) -> int:
        """Deletes what only versions before the last `keep` hold, and what no commit names (left by a crash); returns the number of
        folders deleted. Not beside a writer: a folder is written before its commit."""
        known = self.versions()
        states = [self.state(v) for v in known[-keep:]]
        used = {f for s in states for f in [s["base"], *s["deltas"], *s["objects"]]}
        gone = [f"{kind}/{n}" for kind in ("data", "objects") for n in self.files.names(kind) if f"{kind}/{n}" not in used]
        for name in [*gone, *map(_commit, known[:-keep])]:
            self.files.delete(name)
        return len(gone)

    # -- by name

    def register(self, name: str) -> None:
        """A view of this name in the session's catalogue shows the newest version, now and after each later commit."""
        before = self.state()
        if name not in before["names"]:
            self._commit(before, "register", before["base"], before["deltas"], T.StructType.fromJson(before["schema"]), before["objects"], before["metrics"], [*before["names"], name])
        else:
            self._show(name, before)

    def _show(self, name: str, state: dict) -> None:
        self._rows(state).createOrReplaceTempView(name)


def _commit(version: int) -> str:
    return f"commits/{version:020}.json"


def _late(order: Sequence[str]) -> list[Column]:
    """Later is greater; null is least."""
    return [F.col(c) for c in order]
