"""A corpus pipeline of four stages; each one's result is written as Parquet and read as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import bpe, ngram_join, quality_rules, source_mix
from noticeworks.llm.shared import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_rules(docs).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id. Documents without words
    are in no group and stay. Of rows that share a doc_id, one for each shingle set is judged by itself."""
    found = ngram_join.ngram_components(docs).withColumn("stays", (F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id")))
    found = written(found, "found").select(F.col("doc_id").alias("_id"), F.col("class_id").alias("_class"), "stays")
    ids = found.groupBy("_id").agg(F.count("*").alias("_rows"), F.max("stays").alias("_stays"))
    joined = docs.join(ids.where("_stays"), docs["doc_id"].eqNullSafe(ids["_id"]))
    once = joined.where("_rows = 1").select(*COLUMNS)
    many = ngram_join.with_class(joined.where("_rows > 1").select(*COLUMNS), "text", "_own")
    pairs = found.where("stays").select("_id", "_class").distinct()
    many = many.join(pairs, many["doc_id"].eqNullSafe(pairs["_id"]) & many["_own"].eqNullSafe(pairs["_class"]))
    one = many.where("_own is not null").dropDuplicates(["doc_id", "_own"])
    return once.unionByName(one.select(*COLUMNS)).unionByName(many.where("_own is null").select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    mixed = source_mix.mix_sources(docs).where("times > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document (packed, little-endian unsigned 32-bit) and whether they decode to its text."""
    import public_tokenizers

    ready = docs.select("doc_id", "source", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha"))
    both = bpe.round_trip(ready, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select("doc_id", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("_sha")).alias("round_trip"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mix", mix), ("encode", encode)]

#: The estimates and the sampling have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
