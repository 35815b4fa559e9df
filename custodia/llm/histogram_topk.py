"""Exact top-k search: score histograms, refined until they show each query's k-th score.

Every query meets every vector in blocks: queries are copied to the blocks of vectors, not vectors
to queries, and blocks of queries and vectors are multiplied whole. A pass counts scores in the bins
of a query's current range; the bin that holds the k-th score is the next range. When ranges are one
score wide, a last pass keeps scores at or above the k-th; of ties a block keeps the k smallest ids,
which is all that can be chosen, so no tie group grows beyond k for each block.

Nulls, empties, ties: vectors that are null, empty, or hold null or non-finite components take no
part, nor do rows without vec_id. Vectors of different lengths do not meet. A query never meets rows
of its own id. Of rows that share a query's id the least vector is the query; as candidates all rows
count. A query without candidates has no rows. Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import staged

BINS = 512
QUERY_BLOCK = 512
VECTOR_BLOCK = 4096


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return v.isNotNull() & (F.size(v) > 0) & ~bad


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, v: components floor(256 x) as longs."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("v")).where("vec_id is not null")
    return rows.where(usable(F.col("v"))).select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda x: F.floor(256 * x).cast("long")).alias("v"))


def packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of at most about `size` vectors of one length: name, dim, ids, v (flat).

    Rows fall into blocks by a hash of all they hold and, for rows that repeat, of chance.
    """
    counts = rows.groupBy("dim").agg(F.count("*").alias("__n"))
    block = F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id() % 1024), F.ceil(F.col("__n") / size))
    return (
        rows.join(counts, "dim").withColumn(name, block).groupBy("dim", name)
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("__rows"))
        .select("dim", name, F.col("__rows.vec_id").alias("ids"), F.flatten("__rows.v").alias("v"))
    )


def product(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where these are exact."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if bound < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def scores(p: dict, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, vector ids, their scores, and which pairs count (not a query's own)."""
    dim = int(p["dim"][i])
    qid, vid = np.asarray(p["qids"][i]), np.asarray(p["ids"][i])
    s = product(np.asarray(p["q"][i]).reshape(-1, dim), np.asarray(p["v"][i]).reshape(-1, dim))
    return qid, vid, s, qid[:, None] != vid[None, :]


def counted(pairs: DataFrame, span: int) -> DataFrame:
    """(query_id, bin, n): scores in the bins of each query's range [lo, lo + span)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for i in range(len(p)):
                qid, _, s, counts = scores(p, i)
                lo, width = np.asarray(p["lo"][i]), np.asarray(p["width"][i])
                b = (s - lo[:, None]) // width[:, None]
                b[~counts] = -1
                k, inside = np.arange(len(qid))[:, None], (b >= 0) & (s < lo[:, None] + span)
                n = np.bincount((k * BINS + b)[inside], minlength=len(qid) * BINS)
                hit = np.flatnonzero(n)
                yield pd.DataFrame({"query_id": qid[hit // BINS], "bin": hit % BINS, "n": n[hit]})

    return pairs.mapInPandas(run, "query_id long, bin long, n long")


def chosen(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) at or above the k-th score; at most k of a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for i in range(len(p)):
                qid, vid, s, counts = scores(p, i)
                hit = counts & (s >= np.asarray(p["lo"][i])[:, None])
                for j in np.flatnonzero(hit.any(axis=1)):
                    own = np.flatnonzero(hit[j])
                    own = own[np.lexsort((vid[own], -s[j, own]))[:k]]
                    yield pd.DataFrame({"query_id": qid[j], "vec_id": vid[own], "score": s[j, own]})

    return pairs.mapInPandas(run, "query_id long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest inner products of each query."""
    spark = vectors.sparkSession
    rows = staged(quantized(vectors), "vectors")
    blocks = staged(packed(rows, VECTOR_BLOCK, "vb"), "blocks")
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("__q")).select("vec_id", "__q.dim", "__q.v")
    queries = packed(queries, QUERY_BLOCK, "qb").select("dim", "qb", F.col("ids").alias("qids"), F.col("v").alias("q"))
    # A score is at most the product of the largest components, added up over the length.
    top = rows.select("dim", F.array_max(F.transform("v", F.abs)).alias("m")).groupBy("dim").agg(F.max("m").alias("m"))
    reach = [(r["dim"], r["m"]) for r in top.collect()]  # one row for each length of vectors
    if not reach:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bound = max(d * m * m for d, m in reach) + 1
    queries = staged(queries, "queries")
    ranges = queries.select(F.explode("qids").alias("query_id"), F.lit(-bound).cast("long").alias("lo"), F.lit(k).cast("long").alias("need"))
    width = 2 * bound + 1

    def met(ranges: DataFrame, width: int) -> DataFrame:
        """Pairs of blocks, with the ranges of the queries in the order of the query block."""
        own = queries.select("dim", "qb", "q", F.posexplode("qids").alias("at", "query_id")).drop("q").join(ranges, "query_id")
        own = own.groupBy("dim", "qb").agg(F.array_sort(F.collect_list(F.struct("at", "query_id", "lo"))).alias("__r"))
        own = own.join(queries.select("dim", "qb", "q"), ["dim", "qb"])
        # Queries without a range (no candidates) leave their place in the block.
        dim = F.col("dim")
        kept = F.flatten(F.transform("__r", lambda r: F.slice("q", r["at"] * dim + 1, dim)))
        own = own.select("dim", kept.alias("q"), F.col("__r.query_id").alias("qids"), F.col("__r.lo").alias("lo"))
        own = own.withColumn("width", F.transform("lo", lambda x: F.lit(width).cast("long")))
        places = blocks.select("dim", "vb").join(own, "dim")  # block by block
        return blocks.join(places, ["dim", "vb"])

    while width > 1:
        span, width = width, -(-width // BINS)
        bins = counted(met(ranges, width), span).groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        bins = bins.withColumn("__above", F.coalesce(F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        bins = bins.join(ranges, "query_id")
        # The bin of the k-th score, or the lowest one where there are fewer than k.
        bins = bins.where("__above < need").groupBy("query_id").agg(F.min_by(F.struct("lo", "need", "__above", "bin"), "bin").alias("__b"))
        ranges = staged(bins.select("query_id", (F.col("__b.lo") + F.col("__b.bin") * width).alias("lo"), (F.col("__b.need") - F.col("__b.__above")).alias("need")), "ranges")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = chosen(met(ranges, 1), k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def search_sql(k: int = 5, step: int = 50) -> str:
    return f"""
with e as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) score
  from e q join e c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % {step} = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank from s
)
select query_id, rank, vec_id, score from r where rank <= {k}
"""
