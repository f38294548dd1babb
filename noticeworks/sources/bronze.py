"""Bronze: JSON snapshots laid out as <source>/<run date>/<run id>.json, read as rows of variants.

What land_bronze writes is read, too: a run there is a folder source=.../run_date=.../run_id=... of files with a record
a line, so that no task writes a whole run. Its object name is that of the plain layout, and a record's place counts the
files before its own."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """(object_name, source, run_date, run_id, parts) of every .json file under root, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", FILES).load(root).select("path")
    return object_columns(files.withColumn("object_name", _below(F.col("path"), root))).drop("path").distinct()


def _below(path: Column, root: str) -> Column:
    """The path below root; schemes may be written differently, so the root's last folder names the cut."""
    tail = root.rstrip("/").rsplit("/", 1)[-1]
    below = F.url_decode(F.replace(F.substring_index(path, f"/{tail}/", -1), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(below, LANDED, "$1/$2/$3.json")


#: Names of files that are read, and the place of a file of a landed run.
FILES = "{*.json,part-*.txt}"
LANDED = r"^source=([^/]+)/run_date=([^/]+)/run_id=([^/]+)/part-[^/]*$"


def whole_files(raw: DataFrame, root: str) -> DataFrame:
    """Whole files as rows for parse_objects; before: the place of a landed file's first record."""
    path = F.col("_metadata.file_path")
    files = raw.select("value", path.alias("file_path"))
    part = F.regexp_extract("file_path", r"/run_id=[^/]+/part-(\d+)-[^/]*$", 1)
    landed = F.when(part != "", F.shiftleft(part.cast("long"), 32))
    return files.withColumns({"object_name": _below(F.col("file_path"), root), "before": landed})


def object_columns(files: DataFrame) -> DataFrame:
    part = F.split("object_name", "/")
    three = F.size(part) == 3
    return files.withColumns({
        "parts": F.size(part),
        "source": F.when(three, F.get(part, F.lit(0))),
        "run_date": F.when(three, F.get(part, F.lit(1))),
        "run_id": F.when(three, F.regexp_replace(F.get(part, F.lit(2)), r"\.json$", "")),
    })


#: JSON may repeat a key, and the last value stays. Spark reads this setting as rows are parsed, so it holds for the session.
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def parse_objects(files: DataFrame) -> DataFrame:
    """Rows (file_path, object_name, value) to one row for each record: pos and rec (variant). A single object
    counts as a list of one; a list element that isn't an object becomes {"value": element}; a key that is repeated has its last
    value. Lists are parsed element by element, so none needs to fit one variant. Text (of landed files: a line) that isn't JSON keeps one row with
    a null rec and malformed = true, for a gate to see."""
    if "before" not in files.columns:
        files = files.withColumn("before", F.lit(None).cast("long"))
    text, lines = F.col("value"), F.col("before").isNotNull()
    kept = [c for c in files.columns if c not in ("value", "before")]
    files.sparkSession.conf.set(REPEATED_KEYS, "true")
    by_line = F.transform(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), F.try_parse_json)
    is_list = F.regexp_like(text, F.lit(r"^\s*\["))
    listed = F.coalesce(F.from_json(text, "array<variant>"), F.array(F.lit(None).cast("variant")))
    elements = F.when(lines, by_line).when(is_list, listed).otherwise(F.array(F.try_parse_json(text)))
    rows = files.select(*kept, "before", F.posexplode(elements).alias("at", "element"))
    loose = F.try_parse_json(F.concat(F.lit('{"value":'), F.coalesce(F.to_json("element"), F.lit("null")), F.lit("}")))
    is_object = F.schema_of_variant("element").startswith("OBJECT")
    rec = F.when(F.col("element").isNull(), F.lit(None).cast("variant")).when(is_object, F.col("element")).otherwise(loose)
    return rows.select(*kept, F.col("element").isNull().alias("malformed"), (F.coalesce("before", F.lit(0).cast("long")) + F.col("at")).alias("pos"), rec.alias("rec"))


def read_bronze(spark: SparkSession, root: str, sources: list[str] | None = None, objects: DataFrame | None = None) -> DataFrame:
    """source, run_date, run_id, object_name, file_path, pos, rec (variant) and malformed of every record of the known sources; of
    these objects alone, if given: no other file is opened."""
    reader = spark.read.option("pathGlobFilter", FILES)
    if objects is None:
        raw = reader.option("recursiveFileLookup", "true").text(root, wholetext=True)
    else:
        # a path for each object: the driver lists as many, as for any read
        names = [r[0] for r in objects.select("object_name").distinct().collect()]
        paths = [p for n in names for p in _places(spark, root.rstrip("/"), n)]
        raw = reader.text(paths, wholetext=True) if paths else spark.createDataFrame([], "value string, _metadata struct<file_path: string>")
    known = object_columns(whole_files(raw, root)).where("parts = 3").drop("parts")
    return parse_objects(known.where(F.col("source").isin(sources)) if sources else known)


def _places(spark: SparkSession, root: str, name: str) -> list[str]:
    """Where an object is: the file of its name, or the folder of a landed run."""
    source, run_date, run_id = name.removesuffix(".json").split("/")
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    found = [f"{root}/{name}", f"{root}/source={escape(source)}/run_date={escape(run_date)}/run_id={escape(run_id)}"]
    return [p for p in found if fs.exists(path(p))]


def bronze_manifest(records: DataFrame, files: DataFrame) -> DataFrame:
    """Rows for each source, object and run; files without records count 0."""
    counts = records.where(~F.col("malformed")).groupBy("object_name").agg(F.count("*").alias("n"))
    return files.where("parts = 3").join(counts, "object_name", "left").select("source", "object_name", "run_id", F.coalesce("n", F.lit(0)).alias("rows"))


def unexpected_objects(files: DataFrame) -> DataFrame:
    return files.where(F.size(F.split("object_name", "/")) != 3).select("object_name")


def duplicate_runs(files: DataFrame) -> DataFrame:
    """Runs of one source under several paths."""
    return files.groupBy("source", "run_id").agg(F.count("*").alias("paths"), F.min("object_name").alias("first_object")).where("paths > 1")


def missing_sources(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected sources (one column `source`) that were never seen."""
    return expected.select("source").distinct().join(files.select("source").distinct(), "source", "left_anti")


def select_rebuild(files: DataFrame) -> DataFrame:
    """All history; arrival is the tie-break order of what is read from it."""
    return files.withColumn("arrival", F.struct("run_date", "run_id", "object_name"))


def select_incremental(files: DataFrame, processed: DataFrame) -> DataFrame:
    return files.join(processed.select("object_name").distinct(), "object_name", "left_anti")


def select_explicit_run(files: DataFrame, run_id: str, expected: DataFrame) -> DataFrame:
    """The objects of one run; an error unless it has every expected source and a single date."""
    run = files.where(F.col("run_id") == run_id)
    lack = missing_sources(run, expected).agg(F.count("*").alias("lack"))
    dates = run.agg(F.count_distinct("run_date").alias("dates"))
    found = dates.crossJoin(lack).first()  # one row beside one row
    if found["dates"] != 1 or found["lack"]:
        raise ValueError(f"run {run_id} has {found['dates']} dates and lacks {found['lack']} sources")
    return run


def latest_object_per_source(files: DataFrame) -> DataFrame:
    return files.groupBy("source").agg(F.max("object_name").alias("object_name"))


def snapshot_hash(records: DataFrame) -> DataFrame:
    """A hash of each source's records and their places; keys within a record are sorted. Row hashes are combined by sums
    (two of 64 bits, and the number of rows), so that nothing is gathered."""
    row = lambda seed: F.xxhash64(F.lit(seed), "pos", F.to_json("rec")).cast("decimal(38,0)")
    sums = records.groupBy("source").agg(F.count("*").alias("n"), F.sum(row(1)).alias("a"), F.sum(row(2)).alias("b"))
    return sums.select("source", F.sha2(F.concat_ws("|", "n", "a", "b"), 256).alias("content_hash"))


def changed_since_latest(new: DataFrame, old: DataFrame) -> DataFrame:
    """Records of `new` from sources whose snapshot differs from that of `old`."""
    same = snapshot_hash(new).join(snapshot_hash(old), ["source", "content_hash"]).select("source")
    return new.join(same, "source", "left_anti")


def land_bronze(records: DataFrame, root: str, run_ts: str) -> None:
    """Adds one snapshot of each source (columns source and rec) for read_bronze: a folder for each source, date and run, with
    a record a line; empty sources write nothing. The same run can't be landed twice for a source."""
    run_id = run_ts.replace(":", "-").replace(".", "-")
    spark = records.sparkSession
    try:
        old = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root.rstrip('/')}/source=*/run_date={run_ts[:10]}/run_id={run_id}").select("path")
    except AnalysisException:  # no such run yet
        old = None
    if old is not None and old.select(F.url_decode(F.regexp_extract("path", r"/source=([^/]+)/", 1)).alias("source")).join(records.select("source").distinct(), "source").limit(1).count():
        raise ValueError(f"run {run_id} is there already")
    stamped = records.select("source", F.lit(run_ts[:10]).alias("run_date"), F.lit(run_id).alias("run_id"), F.to_json("rec").alias("value"))
    stamped.write.partitionBy("source", "run_date", "run_id").mode("append").option("maxRecordsPerFile", 100_000).option("compression", "none").format("text").save(root)


def arrival_order() -> list[Column]:
    return [F.col(c) for c in ("run_date", "run_id", "object_name", "pos")]
