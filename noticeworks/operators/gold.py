"""The dashboard table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.operators.quality import Gate, allowed, non_blank, row_count, unique

INPUTS = ["tender_id", "tender_code", "title", "published_date", "closing_date", "country", "source", "source_url", "classification"]
OUTPUTS = ["tender_id", "tender_code", "title", "published_date", "closing_date", "country", "source_name", "source_url", "classification", "status"]
CLASSES, STATUSES = ["Technology", "Review", "Non-Tech"], ["Open", "Closed", "Unknown"]


def gold_contract(df: DataFrame) -> DataFrame:
    lack = [c for c in INPUTS if c not in df.columns]
    if lack:
        raise ValueError(f"missing columns: {', '.join(lack)}")
    return df.select(*INPUTS).withColumnRenamed("source", "source_name")


def open_closed(closing: Column, as_of: Column, missing: str = "Open") -> Column:
    """Open up to and on the closing date; `missing` without one."""
    return F.when(closing.isNull(), missing).when(closing >= as_of, "Open").otherwise("Closed")


def as_of_date(now: Column | None = None, zone: str = "Asia/Riyadh", override: str | None = None) -> Column:
    return F.lit(override).cast("date") if override else F.to_date(F.from_utc_timestamp(F.current_timestamp() if now is None else now, zone))


def date_only(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 10).try_cast("date")


def build_gold(silver: DataFrame, as_of: Column, missing: str = "Open") -> DataFrame:
    df = gold_contract(silver).withColumns({c: date_only(F.col(c)) for c in ("published_date", "closing_date")})
    return df.withColumn("status", open_closed(F.col("closing_date"), as_of, missing)).select(*OUTPUTS)


def gold_gates(rows: int | None = None) -> list[Gate]:
    gates = [unique("tender_id"), unique("tender_code"), non_blank("tender_code"), allowed("classification", CLASSES), allowed("status", STATUSES)]
    return gates + ([row_count(rows)] if rows is not None else [])


def gold_summary(df: DataFrame, closing: str = "closing_date") -> DataFrame:
    """Counts by source, status and class, and open for lack of a date by source; one pass by grouping sets."""
    names = F.struct("source_name", "status", "classification")
    grouped = df.withColumn("open_missing", F.col(closing).isNull() & (F.col("status") == "Open")).groupingSets([["source_name"], ["status"], ["classification"]], "source_name", "status", "classification")
    out = grouped.agg(F.count("*").alias("n"), F.count_if("open_missing").alias("open_missing"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 3, "source").when(F.col("g") == 5, "status").otherwise("classification")
    return out.select(kind.alias("kind"), F.coalesce(names["source_name"], names["status"], names["classification"]).alias("value"), "n", F.when(F.col("g") == 3, F.col("open_missing")).alias("open_missing"))
