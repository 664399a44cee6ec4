"""Exact top-k inner products by a three-phase uniform threshold.

A vector's dimensions are dealt over ``LISTS`` lists (the "nodes"); a score is
the sum of its partial scores in the lists.

1. Each list gives its ``LOCAL`` best partial scores per query; their full
   scores are looked up, and the k-th best of them, tau, is a safe cutoff.
2. Whoever reaches tau has a partial score of tau / LISTS or more in some list:
   tau goes out with the query blocks and all such entries are collected.
3. The parts that an entry lacks are resolved exactly, and the best k stay.

Rows are dealt in blocks: query blocks against candidate blocks, each pair one
bounded matrix product in one task, which sends its best k + 1 only.  Equal
vectors are scored once: of each distinct vector the k + 1 smallest ids stay (a
query needs k besides itself), picked before the shuffle, so a vector that a
third of the rows share is no hot key.

Null vectors, vectors with null, NaN or infinite components, and null ids take
no part; vectors of other lengths than the query's are not comparable with it
and are not returned for it.  Repeated rows (same id and vector) count as they
are among the candidates, once among the queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurewright.llm.common import staged, table_parts

K, LISTS, LOCAL, SCALE, QUERY_BLOCK, CANDIDATE_BLOCK = 5, 2, 32, 256, 512, 8192


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(v, lambda x: F.floor(x * scale))
    return vectors.select(F.col(id_col).alias("vec_id"), F.when(ok, ints).alias("v")).filter("v IS NOT NULL AND vec_id IS NOT NULL")


def _partials(q: np.ndarray, c: np.ndarray, lists: int) -> np.ndarray:
    """(list, query, candidate) partial inner products, exact."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < 2.0**53:  # sums are exact in doubles, which multiply faster
        q, c = q.astype(np.float64), c.astype(np.float64)
    cuts = np.linspace(0, q.shape[1], lists + 1).astype(int)
    return np.stack([q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts, cuts[1:])])


def _matrix(col: pd.Series) -> np.ndarray:
    return np.array(col.tolist(), np.int64).reshape(len(col), -1)


def _best(query_id, cid: np.ndarray, picked: np.ndarray, score: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of the picked candidates by exact score, ties to the smaller id."""
    at = np.flatnonzero(picked)
    top = at[np.lexsort((cid[at], -score[at]))[:k]]
    return pd.DataFrame({"query_id": query_id, "c": cid[top], "score": score[top].astype("int64")})


def top_k(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, scale: int = SCALE
) -> DataFrame:
    """query_id, rank, vec_id, score; both frames have id and vector, a query's own id is no candidate of it."""
    ids = quantised(vectors, id_col, vec_col, scale)
    w = Window.partitionBy("v").orderBy("vec_id")
    few = ids.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k + 1).drop("n")
    # one candidate per distinct vector, named by its smallest id
    cand = staged(few.groupBy("v").agg(F.min("vec_id").alias("c"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    q = staged(quantised(queries, id_col, vec_col, scale).dropDuplicates(["vec_id", "v"]).withColumnRenamed("vec_id", "query_id"))
    n_cand, n_q = cand.count(), q.count()
    cb, qb = -(-n_cand // CANDIDATE_BLOCK) or 1, -(-n_q // QUERY_BLOCK) or 1
    size = F.size("v").alias("dims")
    cands = cand.select("c", "v", size, F.pmod(F.xxhash64("c"), F.lit(cb)).alias("cb"))
    qs = q.select("query_id", "v", size, F.pmod(F.xxhash64("query_id"), F.lit(qb)).alias("qb"))
    cands = cands.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)).cast("array<bigint>")))

    def paired(fn, queries_df: DataFrame, schema: str) -> DataFrame:
        both = queries_df.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cb - 1)).cast("array<bigint>")))
        key = ["dims", "qb", "cb"]
        n = table_parts(queries_df.sparkSession)
        return both.repartition(n, *key).groupBy(*key).cogroup(cands.repartition(n, *key).groupBy(*key)).applyInPandas(fn, schema)

    def blockwise(pick):
        """Per query of the block the best k + 1 of the candidates that ``pick`` takes from the partial scores."""
        def run(ql: pd.DataFrame, cl: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame({x: pd.Series(dtype="int64") for x in ("query_id", "c", "score")})]
            if len(ql) and len(cl):
                q_, c_, qid, cid = _matrix(ql.v), _matrix(cl.v), ql.query_id.to_numpy(), cl.c.to_numpy()
                for a in range(0, len(q_), 64):
                    p = _partials(q_[a:a + 64], c_, LISTS)
                    picked, score = pick(p, ql.iloc[a:a + 64]), p.sum(axis=0)
                    out.extend(_best(qid[a + r], cid, picked[r], score[r], k + 1) for r in range(len(score)))
            return pd.concat(out)

        return run

    def local_best(p: np.ndarray, _) -> np.ndarray:
        n = min(LOCAL, p.shape[2])
        picked = np.zeros(p.shape[1:], bool)
        for part in p:
            np.put_along_axis(picked, np.argpartition(-part, n - 1, axis=1)[:, :n], True, axis=1)
        return picked

    def enough(p: np.ndarray, ql: pd.DataFrame) -> np.ndarray:
        tau = ql.tau.to_numpy(dtype="float64")[:, None]  # NaN: fewer than k are known, all are needed
        return (p * LISTS >= tau).any(axis=0) | np.isnan(tau)

    schema = "query_id bigint, c bigint, score bigint"
    members = cand.select("c", F.explode("ids").alias("vec_id"))

    def ranked(entries: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        every = entries.join(members, "c").filter("vec_id <> query_id")
        return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    # tau is handed on as a double: below 2^53 exactly, else rounded, and then one step lower stays safe
    tau = ranked(paired(blockwise(local_best), qs, schema)).filter(F.col("rank") == k).select(
        "query_id", F.when(F.abs("score") < 2**53, F.col("score").cast("double")).otherwise(F.col("score") * (1 - F.signum("score") * 1e-15)).alias("tau")
    )
    with_tau = staged(qs.join(tau, "query_id", "left"))
    return ranked(paired(blockwise(enough), with_tau, schema)).select("query_id", "rank", "vec_id", "score")


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
