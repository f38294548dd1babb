"""Profiling: volume, velocity, variety and veracity, one row for each source from one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def volume(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"))


def velocity_columns(ts: Column) -> list[Column]:
    """Earliest and latest extraction and the hours between; what isn't a timestamp doesn't count."""
    at = ts.try_cast("timestamp")
    hours = F.round((F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / 3_600_000_000, 2)
    return [F.min(at).alias("first_extracted"), F.max(at).alias("last_extracted"), hours.alias("span_hours")]


def velocity(df: DataFrame, by: str, ts: str) -> DataFrame:
    return df.groupBy(by).agg(*velocity_columns(F.col(ts)))


def file_count(df: DataFrame, by: str, path: str) -> DataFrame:
    return df.groupBy(by).agg(F.count_distinct(path).alias("files"))


def variety(records: DataFrame, by: str, rec: str = "rec") -> DataFrame:
    """The keys that each source's records (variants) have."""
    keys = records.select(by, F.explode(F.json_object_keys(F.to_json(rec))).alias("key")).distinct()
    return keys.groupBy(by).agg(F.array_sort(F.collect_list("key")).alias("columns"))


def missing_columns(cols: list[str]) -> list[Column]:
    """Cells that are null or blank, and their share in percent."""
    cells = reduce(lambda a, b: a + b, [F.count_if(missing(F.col(c))) for c in cols])
    return [cells.alias("missing_cells"), F.round(100.0 * cells / (F.count("*") * len(cols)), 2).alias("missing_percent")]


def missing_cells(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    return df.groupBy(by).agg(*missing_columns(cols))


def row_hash(cols: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def exact_duplicates(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Rows beyond the first of their kind; equal rows are counted together before anything is gathered."""
    kinds = df.groupBy(by, row_hash(cols).alias("_h")).agg(F.count("*").alias("_n"))
    return kinds.groupBy(by).agg((F.sum("_n") - F.count("*")).alias("exact_duplicates"))


def title_column(df: DataFrame, candidates: list[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def missing_titles(df: DataFrame, by: str, candidates: list[str]) -> DataFrame:
    found = title_column(df, candidates)
    count = F.count_if(missing(F.col(found))) if found else F.count("*")
    return df.groupBy(by).agg(count.alias("missing_titles"))


def profile_4v(df: DataFrame, by: str, ts: str, path: str, titles: list[str], cols: list[str] | None = None) -> DataFrame:
    """All of the above, one row for each value of `by`. Equal rows are first counted together; every figure follows from those counts."""
    cols = cols or [c for c in df.columns if c != by]
    title = title_column(df, titles)
    kinds = df.groupBy(by, row_hash(list(dict.fromkeys([*cols, ts, path]))).alias("_h")).agg(
        F.count("*").alias("_n"),
        F.first(ts).alias("_ts"),
        F.first(path).alias("_path"),
        F.first(reduce(lambda a, b: a + b, [missing(F.col(c)).cast("int") for c in cols])).alias("_missing"),
        F.first(missing(F.col(title)) if title else F.lit(True)).alias("_untitled"),
    )
    rows, cells = F.sum("_n"), F.sum(F.col("_n") * F.col("_missing"))
    return kinds.groupBy(by).agg(
        rows.alias("rows"),
        F.lit(len(cols)).cast("long").alias("columns"),
        *velocity_columns(F.col("_ts")),
        F.count_distinct("_path").alias("files"),
        cells.alias("missing_cells"),
        F.round(100.0 * cells / (rows * len(cols)), 2).alias("missing_percent"),
        (rows - F.count("*")).alias("exact_duplicates"),
        F.sum(F.when(F.col("_untitled"), F.col("_n")).otherwise(0)).alias("missing_titles"),
    )


def profile_records(records: DataFrame, by: str, ts_keys: list[str], titles: list[str], path: str, rec: str = "rec") -> DataFrame:
    """profile_4v over records (variants), one row for each value of `by`: a source's columns are the keys that any of its records has,
    and a record that lacks one misses that cell. Extraction times are of the first of ts_keys that a record has; titles those of
    the first of `titles` that the source has (without any, every record misses its title).

    Records are exploded to their keys once; what goes into the shuffle is a count for each source and key."""
    value = lambda k: F.try_variant_get(rec, '$["' + k + '"]', "string")
    at = F.coalesce(*[value(k).try_cast("timestamp") for k in ts_keys])
    text = F.to_json(rec)  # keys are sorted
    kinds = records.select(F.col(by).alias("s"), F.col(path).alias("path"), at.alias("at"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))
    equal = kinds.groupBy("s", "h1", "h2").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    rows = equal.groupBy("s").agg(F.sum("n").alias("rows"), F.min("first").alias("first_extracted"), F.max("last").alias("last_extracted"), (F.sum("n") - F.count("*")).alias("exact_duplicates"))
    files = kinds.groupBy("s", "path").agg(F.lit(1).alias("one")).groupBy("s").agg(F.count("path").alias("files"))
    cells = kinds.select("s", F.explode(F.from_json("text", "map<string,string>")).alias("key", "value"))
    present = cells.groupBy("s", "key").agg(F.count_if(~missing(F.col("value"))).alias("present"))
    rank = F.array_position(F.array(*map(F.lit, titles)).cast("array<string>"), F.col("key"))
    title = F.when(rank > 0, F.struct(rank.alias("rank"), F.col("present").alias("present")))
    keys = present.groupBy("s").agg(F.count("*").alias("columns"), F.array_sort(F.collect_list("key")).alias("keys"), F.sum("present").alias("present"), F.min(title).alias("title"))  # a row for each key of the source
    same = lambda a, b: F.col(f"{a}.s").eqNullSafe(F.col(f"{b}.s"))
    out = rows.alias("r").join(files.alias("f"), same("r", "f"), "left").join(keys.alias("k"), same("r", "k"), "left")
    columns = F.coalesce("columns", F.lit(0).cast("long"))
    lacking = F.col("rows") * columns - F.coalesce("present", F.lit(0))
    hours = F.round((F.unix_micros("last_extracted") - F.unix_micros("first_extracted")) / 3_600_000_000, 2)
    return out.select(
        F.col("r.s").alias(by), "rows", columns.alias("columns"), F.coalesce("keys", F.array().cast("array<string>")).alias("keys"), "first_extracted", "last_extracted", hours.alias("span_hours"), F.coalesce("files", F.lit(0)).alias("files"),
        lacking.alias("missing_cells"), F.round(F.when(columns > 0, 100.0 * lacking / (F.col("rows") * columns)).otherwise(0.0), 2).alias("missing_percent"), "exact_duplicates", (F.col("rows") - F.coalesce("title.present", F.lit(0))).alias("missing_titles"),
    )
