"""Mixing sources to target weights by the cube method.

A source whose target is t times its size takes each of its documents floor(t) times, and once more
with probability t - floor(t). The extra copies are drawn by balanced sampling: the vector of
inclusion probabilities moves through the null space of the constraints (total words and number of
documents), each move settling a document as in or out, until only as many documents as constraints
are left. Constraints add up, so blocks of a source's documents are settled side by side and only the
few left of each block, and some that were held back, go on to the next round. The landing of a source decides what its last flight
has left together with up to LANDING documents of all sizes: of all their combinations the one nearest to the source's words, and
then to its documents. Blocks are of bounded size, so a source that holds a third of all rows
is many blocks. Random moves come from a hash of the block and the seed: reruns agree.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.shared import others, words, written

#: Weights of the sources by code point, null last; they repeat.
WEIGHTS = (5, 2, 1)
#: A source is taken at most so many times.
MOST = 3
EDGE = 1e-9
#: Documents that a landing decides together (all combinations are tried), and how many of a block, of all sizes, are held back for it.
LANDING, HELD_BACK = 16, 8


def _flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Settles all but two or so of the probabilities: three at a time move along the null space of (pi-free) words and documents."""
    pi = pi.copy()
    held: list[int] = []
    for i in range(len(pi)):
        if EDGE < pi[i] < 1 - EDGE:
            held.append(i)
        while len(held) == 3:
            a, b, c = size[held]
            # u is orthogonal to (1, 1, 1) and to the sizes; equal sizes leave a plane, of which (1, -1, 0) is one direction
            u = np.array([b - c, c - a, a - b], float)
            if not u.any():
                u = np.array([1.0, -1.0, 0.0])
            u /= np.abs(u).max()
            now = pi[held]
            with np.errstate(divide="ignore", invalid="ignore"):
                up = np.min(np.where(u > 0, (1 - now) / u, np.where(u < 0, -now / u, np.inf)))
                down = np.min(np.where(u > 0, now / u, np.where(u < 0, (now - 1) / u, np.inf)))
            step = up if rng.random() * (up + down) < down else -down
            pi[held] = np.clip(now + step * u, 0, 1)
            held = [j for j in held if EDGE < pi[j] < 1 - EDGE]
    return pi


def _spread(size: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the positions `among`, evenly through their sizes from the smallest on."""
    ordered = among[np.argsort(size[among], kind="stable")]
    return ordered[np.unique(np.linspace(0, len(ordered) - 1, min(n, len(ordered))).round().astype(int))] if len(ordered) else ordered


def _land(pi: np.ndarray, size: np.ndarray, words: float, docs: float) -> np.ndarray:
    """All settled, as near as may be to so many words (within a thousandth all are as near) and then to so many documents.
    What is open and, up to LANDING in all, settled documents of all sizes are decided anew; the first best combination counts."""
    open_ = np.flatnonzero((pi > EDGE) & (pi < 1 - EDGE))
    settled = np.setdiff1d(np.arange(len(pi)), open_)
    free = np.concatenate([open_, _spread(size, settled, max(0, LANDING - len(open_)))]).astype(int)
    out = np.round(pi)
    out[free] = 0
    sums, counts = np.array([float(out @ size)]), np.array([out.sum()])
    for i in free:
        sums, counts = np.concatenate([sums, sums + size[i]]), np.concatenate([counts, counts + 1])
    away = np.abs(sums - words)
    best = np.lexsort((away, np.abs(counts - docs), np.floor(away / max(0.5, words / 1000))))[0]
    out[free] = int(best) >> np.arange(len(free)) & 1
    return out


def _settle(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """A block after its flight, large documents first; a source of one block lands."""
    rows = rows.sort_values(["size", "h", "h2"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    rng = np.random.default_rng(xxhash.xxh3_64_intdigest(f"{seed} {rows['source_no'][0]} {rows['block'][0]} {len(rows)} {rows['h'][0]}".encode()))
    size, pi = rows["size"].to_numpy(float), rows["pi"].to_numpy()
    if rows["blocks"][0] > 1:
        back = _spread(size, np.arange(len(pi)), HELD_BACK)
        moved = np.ones(len(pi), bool)
        moved[back] = False
        now = pi.copy()
        now[moved] = _flight(pi[moved], size[moved], rng)
        return rows.assign(pi=now)
    now = _flight(pi, size, rng)
    # more than a landing decides are only open where a flight could do nothing with them
    return rows.assign(pi=_land(now, size, float(pi @ size), float(pi.sum())))


def _settler(seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        return _settle(rows, seed)

    return settle


UNIT = "source_no int, h long, h2 long, size double, pi double, block int, blocks int"


def cube_sample(units: DataFrame, seed: int = 1, block_rows: int = 20_000) -> DataFrame:
    """units (source_no, h, h2, size, pi) with pi settled to 0 or 1, balanced within each source_no."""
    now, round_, done = units, 0, []
    while True:
        per = now.groupBy("source_no").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        last = (per.agg(F.max("blocks")).first()[0] or 0) <= 1
        block = F.pmod(F.xxhash64("h", F.lit(round_)), F.col("blocks")).cast("int")
        blocked = now.drop("block", "blocks").join(_bounded(per), "source_no").select("source_no", "h", "h2", "size", "pi", block.alias("block"), "blocks")
        moved = blocked.groupBy("source_no", "block").applyInPandas(_settler(seed + round_), UNIT)
        if last:
            return functools.reduce(DataFrame.unionByName, [*done, moved])
        moved = written(moved, "cube")
        # a source of one block has landed
        open_ = (F.col("blocks") > 1) & (F.col("pi") > EDGE) & (F.col("pi") < 1 - EDGE)
        done.append(moved.where(~open_))
        now, round_ = moved.where(open_), round_ + 1


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, most: int = MOST, share: float = 1.0, seed: int = 1, block_rows: int = 20_000, keep_text: bool = True) -> DataFrame:
    """One row for each row of docs: its columns (without the text if keep_text is False), size (words),
    source_size, target and times (how often the mix takes the document: 0 to `most`); columns of these
    names are replaced, others stay, whatever their names.

    Sources are ordered by code point, null last; an empty string is a source of its own. A document
    without words (or with null text) is never taken. Rows of the same id, source and text are one unit:
    all are taken equally often. An empty table gives no rows. There may be any number of sources.
    """
    made = ("size", "source_size", "target", "times")
    own = others(docs, *made, *([] if keep_text else [text_col]))
    # the caller's columns travel in one column, so that none meets a working name
    hashes = F.xxhash64(F.col(id_col), F.col(text_col), F.col(source_col), F.lit(seed)).alias("h"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("h2")
    sized = docs.select(F.struct(*own).alias("row"), F.size(words(F.col(text_col))).cast("long").alias("size"), F.col(source_col).alias("s"), *hashes)
    if not keep_text:
        sized = written(sized, "sizes")
    units = written(sized.groupBy("s", "h", "h2").agg(F.sum("size").alias("size")), "units")
    plan = _bounded(written(plan_sources(units, weights, most, share), "plan"))
    part = F.col("ratio") - F.floor("ratio")
    same = lambda df: df["s"].eqNullSafe(plan["source"])
    planned = units.where("size > 0").join(plan, same(units)).withColumn("pi", part)
    open_ = planned.where(part > EDGE).select(F.col("no").alias("source_no"), "h", "h2", F.col("size").cast("double").alias("size"), "pi")
    settled = cube_sample(open_, seed, block_rows)
    extra = settled.where("pi > 0.5").select(F.col("source_no").alias("no"), "h", "h2", F.lit(1).alias("extra"))
    placed = sized.join(plan, same(sized)).join(extra, ["no", "h", "h2"], "left")
    times = F.when(F.col("size") > 0, F.floor("ratio") + F.coalesce("extra", F.lit(0))).otherwise(0).cast("long")
    return placed.select(*[F.col("row").getField(c).alias(c) for c in own], "size", F.col("n").alias("source_size"), "target", times.alias("times"))


#: Tables of up to so many sources (about 100 bytes each) are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 100_000


def _bounded(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_SOURCES else table


def plan_sources(units: DataFrame, weights: tuple, most: int, share: float) -> DataFrame:
    """source, no (its place by code point, null last), n (its size), target and ratio (target / size); one row for each source.

    Targets are level * weight, at most `most` times the size: what filling up by weight gives. The level is found by sums over
    all sources: those above their limit are set to it and the rest is shared anew, until none is above."""
    per = units.groupBy(F.col("s").alias("source")).agg(F.sum("size").alias("n"))
    ordered = written(per.orderBy(F.col("source").isNull(), "source").withColumn("p", F.spark_partition_id()), "sources")
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy("p").count()  # a row for each partition of the sorted table
    shifts = counts.select("p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    within = F.row_number().over(Window.partitionBy("p").orderBy(F.col("source").isNull(), "source"))
    numbered = ordered.withColumn("i", within).join(F.broadcast(shifts), "p").withColumn("no", (F.col("shift") + F.col("i") - 1).cast("int"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("no", F.lit(len(weights))).cast("int"))
    numbered = written(numbered.select("source", "no", "n", weight.alias("weight")), "sources")
    all_ = numbered.agg(F.sum("n").alias("n"), F.sum("weight").alias("w")).first()
    total, level, held = share * (all_["n"] or 0), 0.0, -1
    capped = F.lit(False)
    while all_["w"]:
        over = numbered.where(capped).agg(F.count("*").alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).first()
        if over["k"] == held:
            break
        held = over["k"]
        level = (total - most * over["n"]) / (all_["w"] - over["w"]) if all_["w"] > over["w"] else float("inf")
        capped = F.lit(level) * F.col("weight") > most * F.col("n")
    target = F.least(F.lit(level) * F.col("weight"), (most * F.col("n")).cast("double"))
    ratio = F.when(F.col("n") > 0, target / F.col("n")).otherwise(0.0)
    return numbered.select("source", "no", "n", target.alias("target"), ratio.alias("ratio"))


def op8_source_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = mix_sources(docs, keep_text=False)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))
