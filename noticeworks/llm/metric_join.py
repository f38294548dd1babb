"""Embedding near-dedup: an exact metric range join.

Vectors of length 1 whose cosine is at least c lie within r = sqrt(2 - 2c) of each other. A bounded number of
pivots (vectors of the table, least hashes first) cut the space into cells: a vector is at home in the cell of its
nearest pivot. A vector w at home in another cell is copied to the cell of pivot p, whose home vectors have
distances between `near` and `far` from p, unless one of these shows that nothing there is within r:

* the triangle inequality with p: near - r <= d(w, p) <= far + r;
* the triangle inequality with both pivots: d(w, p) <= d(w, q) + 2r, where q is w's own pivot;
* its sharper form for the plane between both pivots: d(w, p)^2 - d(w, q)^2 <= 2 r d(p, q).

Of two cells only the one with the smaller number gets the other's copies, so each pair is met once. Cells join
independently: a cell is cut into units of bounded size (a block of home vectors against a block of home vectors or
of copies), so a cell that holds a third of all rows is many units. A unit sends no pairs: it gives each vector's number
of links, and links that connect what all its links connect.

Which vectors are pivots changes the work and never the result. How many copies there are depends on the data: where
all distances are alike (random vectors of many dimensions) most vectors are near most cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.components import components
from noticeworks.llm.shared import written

COSINE = 0.95
#: Vectors of a cell on average, of a block, and the most pivots (they go to the driver and to every task).
CELL_ROWS, BLOCK_ROWS, MOST_PIVOTS = 4096, 4096, 1024
#: Added to distances before something is left out, and the width of the band about the threshold that is computed again.
SLACK, BAND = 1e-6, 1e-9


def usable(vector: Column) -> Column:
    """The vector as doubles without negative zeros; null for vectors that are null, zero or hold null or non-finite components."""
    wide = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(whole & F.exists(vector, lambda x: x != 0), wide)


def _unit_vectors(batch: pa.RecordBatch, name: str, dims: int) -> np.ndarray:
    """Rows of length 1, with zeros for the dimensions that a vector lacks."""
    column = batch.column(name)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes] or [[]]).astype(int)] = column.flatten().to_numpy()
    out /= np.abs(out).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _at_home(classes: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """classes (class, k, v) with their cells, their distances from the pivots of these, and their vectors of length 1, packed."""
    sent = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                x = _unit_vectors(b, "v", dims)
                d = _distances(x, sent.value)
                cell = d.argmin(axis=1)
                packed = pa.array([row.tobytes() for row in x], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("class"), b.column("k"), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell]), packed], names=["class", "k", "cell", "d", "x"])

    return classes.mapInArrow(run, "class long, k long, cell int, d double, x binary")


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


def _copies(home: DataFrame, pivots: np.ndarray, rings: dict[int, tuple[float, float]], r: float) -> DataFrame:
    """A row for each vector and each cell of a smaller number that may hold something within r of it."""
    n = len(pivots)
    # an empty cell has no distances, so nothing comes near them
    near, far = (np.array([rings.get(c, (math.inf, -math.inf))[k] for c in range(n)]) for k in (0, 1))
    between = _distances(pivots, pivots)
    sent = home.sparkSession.sparkContext.broadcast((pivots, near, far, between))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, near, far, between = sent.value
        for b in it:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column("x").to_pylist())).reshape(b.num_rows, -1)
            own, d = b.column("cell").to_numpy(), _distances(x, pivots)
            mine = d[np.arange(len(d)), own][:, None]
            reach = (np.arange(n) < own[:, None]) & (d >= near - r - SLACK) & (d <= far + r + SLACK) & (d <= mine + 2 * r + SLACK)
            reach &= d * d - mine * mine <= 2 * r * between[own] + SLACK
            row, cell = np.nonzero(reach)
            yield pa.RecordBatch.from_arrays([b.column("class").take(row), b.column("k").take(row), pa.array(cell, pa.int32()), b.column("x").take(row)], names=["class", "k", "cell", "x"])

    return home.select("class", "k", "cell", "x").mapInArrow(run, "class long, k long, cell int, x binary")


def _linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of a link with which of b; cosines in the band about the threshold are summed without rounding."""
    g = a @ b.T
    out = g >= cosine
    for i, j in np.argwhere(np.abs(g - cosine) < BAND):
        out[i, j] = math.fsum(a[i] * b[j]) / math.sqrt(math.fsum(a[i] * a[i]) * math.fsum(b[j] * b[j])) >= cosine
    return out


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Of the links of rows with columns, enough to connect whatever they connect."""
    out: list[tuple[int, int]] = []
    open_rows, open_cols = links.any(axis=1), links.any(axis=0)
    for start in np.flatnonzero(open_rows):
        if not open_rows[start]:
            continue
        open_rows[start] = False
        rows = [start]
        while rows:
            row = rows.pop()
            cols = np.flatnonzero(links[row] & open_cols)
            open_cols[cols] = False
            out += [(row, c) for c in cols.tolist()]
            for c in cols:
                found = np.flatnonzero(links[:, c] & open_rows)
                open_rows[found] = False
                out += [(x, c) for x in found.tolist()]
                rows += found.tolist()
    return out


def _joiner(cosine: float):
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        """(class, links, other): links is what the unit adds to a class's number of links, other a linked class or null."""
        left, right = rows[rows["left"]], rows[~rows["left"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"class": [], "links": [], "other": []}).astype({"class": "int64", "links": "int64", "other": "Int64"})
        a, b = (np.frombuffer(b"".join(side["x"])).reshape(len(side), -1) for side in (left, right))
        names, others = left["class"].to_numpy(), right["class"].to_numpy()
        links = _linked(a, b, cosine)
        links &= names[:, None] != others
        if left["i"].iloc[0] == left["j"].iloc[0]:  # the same block on both sides: each pair once
            links &= names[:, None] < others
        counted = [pd.DataFrame({"class": n, "links": c}) for n, c in ((names, links @ right["k"].to_numpy(np.int64)), (others, left["k"].to_numpy(np.int64) @ links))]
        edges = np.array(_forest(links), np.int64).reshape(-1, 2)
        tied = pd.DataFrame({"class": names[edges[:, 0]], "links": 0, "other": others[edges[:, 1]]})
        counted = pd.concat(counted).groupby("class", as_index=False)["links"].sum()
        return pd.concat([counted[counted["links"] > 0], tied]).astype({"class": "int64", "links": "int64", "other": "Int64"})

    return join


def _cell_links(home: DataFrame, copies: DataFrame, cosine: float, block_rows: int) -> DataFrame:
    """What the units of all cells give."""
    hashed = lambda blocks, seed: F.pmod(F.xxhash64("class", F.lit(seed)), F.col(blocks)).cast("int")
    blocks = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name))
    # a row for each cell: as many as pivots
    sizes = F.broadcast(written(blocks(home, "h").join(blocks(copies, "c"), "cell", "left").select("cell", "h", F.coalesce("c", F.lit(0)).alias("c")), "cells"))
    home = home.join(sizes, "cell").withColumn("b", hashed("h", 1)).select("class", "k", "cell", "x", "b", "h", "c")
    copies = copies.join(sizes, "cell").withColumn("b", hashed("c", 2)).select("class", "k", "cell", "x", "b", "h")
    # unit (i, j): block i of the home vectors with their block j >= i, or with block -j - 1 of the copies
    with_home = F.sequence(F.col("b"), F.col("h") - 1)
    with_copies = F.when(F.col("c") > 0, F.sequence(F.lit(-1), -F.greatest("c", F.lit(1)))).otherwise(F.array().cast("array<int>"))
    side = lambda df, i, j, left: df.select("class", "k", "x", "cell", i.alias("i"), j.alias("j"), F.lit(left).alias("left"))
    left = side(home.withColumn("other", F.explode(F.concat(with_home, with_copies))), F.col("b"), F.col("other"), True)
    right = side(home.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b")))), F.col("other"), F.col("b"), False)
    beside = side(copies.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("h") - 1))), F.col("other"), -F.col("b") - 1, False)
    return left.unionByName(right).unionByName(beside).groupBy("cell", "i", "j").applyInPandas(_joiner(cosine), "class long, links long, other long")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """One row for each row of df: id, n_links (other rows with a cosine of at least `cosine`, which must be positive), component_id (the
    smallest id reachable by links, its own included) and kept (id = component_id).

    Vectors that are null, zero or hold null or non-finite components link with nothing. Vectors may differ in length: missing
    dimensions are 0. Equal vectors are one class throughout, so copies cost nothing, and link with each other. Ids may be null (a null
    is never the id of a component that has another) or repeated (each row counts as another vector; all rows of a kept id are kept). Other
    columns are ignored; an empty table gives no rows.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be above 0 and at most 1")
    r = math.sqrt(max(0.0, 2 - 2 * cosine))
    rows = df.select(F.col(id_col).cast("long").alias("id"), usable(F.col(vector_col)).alias("v"))
    rows = rows.withColumns({"h1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "h2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v"))})
    # equal vectors meet by 128 bits of hash
    per = rows.where("v is not null").groupBy("h1", "h2").agg(F.min("id").alias("least"), F.count("*").alias("k"), F.first("v").alias("v"))
    classes = written(per.select(F.monotonically_increasing_id().alias("class"), "*"), "vectors")
    size = classes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    n_pivots = max(1, min(most_pivots, size["n"] // cell_rows))
    chosen = classes.orderBy("h1", "h2").limit(n_pivots).select("class", "k", "v").toArrow() if size["n"] else None
    if not chosen:
        scored = rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    else:
        pivots = np.concatenate([_unit_vectors(b, "v", size["dims"]) for b in chosen.to_batches() if b.num_rows])
        home = written(_at_home(classes.select("class", "k", "v"), pivots, size["dims"]), "home")
        rings = {x["cell"]: (x["near"], x["far"]) for x in home.groupBy("cell").agg(F.min("d").alias("near"), F.max("d").alias("far")).collect()}  # a row for each pivot
        copies = written(_copies(home, pivots, rings, r), "copies")
        found = written(_cell_links(home, copies, cosine, block_rows), "links")
        counts = found.groupBy("class").agg(F.sum("links").alias("links"))
        tied = components(found.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "class")
        known = classes.select("class", "h1", "h2", "least", "k").join(counts, "class", "left").join(tied, "class", "left").withColumn("root", F.coalesce("root", "class"))
        known = written(known, "known")
        least = known.groupBy("root").agg(F.min("least").alias("component_id"))
        known = known.join(least, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("k") - 1).alias("links"), "component_id")
        joined = rows.select("id", "h1", "h2").join(known, ["h1", "h2"], "left")
        scored = joined.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return scored.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op12_metric_dedup(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


OP12_SQL = """
with recursive good as (
    select row_number() over () as n, vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (select a.n as a, b.n as b, a.vec_id as x, b.vec_id as y from good a join good b on a.n <> b.n and list_cosine_similarity(a.v, b.v) >= 0.95
), degrees as (select x as vec_id, count(*) as n_links from pairs group by 1
), ways as (select distinct x, y from pairs
), reach(vec_id, seen) as (select vec_id, vec_id from embeddings union select reach.vec_id, ways.y from reach join ways on reach.seen = ways.x)
select e.vec_id, coalesce(d.n_links, 0) as n_links, min(seen) as component_id, min(seen) = e.vec_id as kept
from embeddings e left join degrees d using (vec_id) join reach r on r.vec_id = e.vec_id group by e.vec_id, d.n_links
"""
