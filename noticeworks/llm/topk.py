"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of (dimension, integer weight) terms. Candidates lie in blocks of bounded size
as postings by dimension; query rows lie in blocks too. A unit of work is one block of queries against
one block of candidates: term by term, each query scatters its weight times the postings' weights into
its dense score array, and a partition selection keeps the k best. Units are spread over the cluster,
and their lists of k are merged by Spark. Every pair is scored, so the result is exact.

A candidate row is sent once for each block of queries, a query row once for each block of candidates;
with blocks of `query_block` and `candidate_block` rows, that is rows * queries / query_block and
queries * rows / candidate_block. Ties at the k-th score are kept until the ids decide.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Products and their sums stay exact in a double below this.
EXACT = 2.0**53
LONG = (-(2**63), 2**63 - 1)


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as double; null for null vectors and for those that hold null or non-finite components."""
    wide = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(whole, wide)


def _unit(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of the candidates, and all that tie with the k-th, for each query."""
    empty = pd.DataFrame({"query_id": [], "q": [], "vec_id": [], "score": []}, dtype="int64")
    if not len(queries) or not len(candidates):
        return empty
    ids = candidates["id"].to_numpy(np.int64)
    own = candidates["row"].to_numpy()
    sizes = np.array([len(v) for v in candidates["v"]])
    flat = np.concatenate([*candidates["v"], np.zeros(0)])
    term = np.concatenate([np.arange(n) for n in sizes])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    here = flat != 0
    order = np.argsort(term[here], kind="stable")
    doc, weight, term = doc[here][order], flat[here][order], term[here][order]
    starts = np.searchsorted(term, np.arange((term[-1] if len(term) else 0) + 2))
    most = np.bincount(doc, np.abs(weight), len(sizes)).max(initial=0)
    out = []
    for q_id, mark, q_row, q in zip(queries["id"], queries["q"], queries["row"], queries["v"], strict=True):
        q = np.asarray(q)
        exact = most * np.abs(q).max(initial=0) < EXACT
        scores = np.zeros(len(ids), np.float64 if exact else object)
        for t in np.flatnonzero(q[: len(starts) - 1]):
            part = slice(starts[t], starts[t + 1])
            if exact:
                scores[doc[part]] += q[t] * weight[part]
            else:
                scores[doc[part]] += int(q[t]) * np.array([int(x) for x in weight[part]], object)
        scores = scores.astype(np.int64) if exact else np.array([min(max(s, LONG[0]), LONG[1]) for s in scores], np.int64)
        others = np.flatnonzero(own != q_row)
        if len(others) > k:
            s = scores[others]
            edge = np.partition(s, len(s) - k)[len(s) - k]
            sure, ties = others[s > edge], others[s == edge]
            if len(ties) > k:
                ties = ties[np.argpartition(ids[ties], k - 1)[:k]]
            others = np.concatenate([sure, ties])
        out.append((np.full(len(others), q_id), np.full(len(others), mark), ids[others], scores[others]))
    return pd.DataFrame({n: np.concatenate(c) for n, c in zip(("query_id", "q", "vec_id", "score"), zip(*out, strict=True), strict=True)})


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, query_block: int = 4096, candidate_block: int = 16384) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query row's k highest integer inner products over all
    candidate rows but itself; ties go to smaller ids.

    Rows with null ids, and vectors that are null or hold null or non-finite components, take no part.
    Vectors may differ in length: missing dimensions are 0. A query row is known among the candidates by its
    id and vector; repeated rows of one id are one another's self. Components and scores beyond a long are held
    at its ends, and scores held there tie. Query rows of one id and vector are one query; of one id with other vectors, each has a list
    of its own. Other columns are ignored; an empty table gives no rows.
    """
    slim = lambda df: df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v")).where("id is not null and v is not null").withColumn("row", F.col("id"))
    qs, cs = slim(queries).distinct().withColumn("q", F.xxhash64("id", "v")), slim(candidates).withColumn("q", F.lit(0).cast("long"))
    n_q, n_c = qs.count(), cs.count()
    q_blocks, c_blocks = max(1, -(-n_q // query_block)), max(1, -(-n_c // candidate_block))
    block = lambda n, seed: F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")
    q_units = qs.withColumns({"qb": block(q_blocks, 1), "cb": F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))})
    c_units = cs.withColumns({"cb": block(c_blocks, 2), "qb": F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))})
    lists = q_units.groupBy("qb", "cb").cogroup(c_units.groupBy("qb", "cb")).applyInPandas(lambda q, c: _unit(q, c, k), "query_id long, q long, vec_id long, score long")
    w = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_exact_topk(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors.where("vec_id % 100 = 0"), vectors)


OP6_SQL = """
with good as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from good q join good c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10
"""
