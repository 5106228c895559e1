"""Exact top-k inner products by vector-approximation files: quantised cells bound every score, few vectors are read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import table

K, CELLS = 10, 256
#: A task compares one group of vectors with one group of queries; both have about so many rows.
GROUP_ROWS, QUERY_ROWS = 16_384, 1_024
#: Factor of the integer components.
SCALE = 1024
MOST = 2**63 - 1


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of every component (a byte), and the lower edges and widths of the cells of each dimension."""
    low = x.min(axis=0).astype(np.float64)
    width = np.maximum((x.max(axis=0) - low) / CELLS, 1e-9)
    return np.clip(np.floor((x - low) / width), 0, CELLS - 1).astype(np.uint8), low, width


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; those beyond 64 bits become the nearest 64-bit number."""
    if x.dtype != object:
        return x @ q
    return np.array([max(-MOST, min(MOST, s)) for s in x @ q.astype(object)], np.int64)


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[list, list, list]:
    """The ``k`` best (query, id, score) of a group, ties to smaller ids, a query's own id left out.

    The cells give a middle value and the same half-width of score for all vectors, so the bounds of all pairs are one
    product of matrices over the byte codes. Exact vectors are then read by descending upper bound, some at a time, until
    no unread one can reach the kth exact score.
    """
    codes, low, width = quantise(x)
    middle = q @ (low + 0.5 * width)
    about = (codes.astype(np.float32) @ (q * width).T.astype(np.float32)).T.astype(np.float64) + middle[:, None]
    half = np.abs(q) @ (0.5 * width)
    # room for float32 sums of up to 255 * |q * width| per dimension
    upper = about + half[:, None] * 1.001 + 1e-5 * (np.abs(q * width).sum(axis=1) * CELLS)[:, None] + 1.0
    # and for float64 sums where the cells are narrow and far from zero
    upper += 1e-12 * (np.abs(q) @ np.abs(low))[:, None]
    reach = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    exact = x if reach < 2**62 else x.astype(object)  # Python's integers where a sum may pass 64 bits
    out: tuple[list, list, list] = ([], [], [])
    step = max(4 * k, 32)
    for j in range(len(q)):
        bound = np.where(ids == query_ids[j], -np.inf, upper[j])
        best_s, best_i, done = np.empty(0, np.int64), np.empty(0, np.int64), 0
        ranked = np.argsort(-bound, kind="stable")[: int(np.isfinite(bound).sum())]
        while done < len(ranked):
            order = ranked[done : done + step]
            if len(best_s) == k and bound[order[0]] < best_s[-1]:
                break
            s, i = np.concatenate([best_s, _products(exact[order], q[j])]), np.concatenate([best_i, ids[order]])
            top = np.lexsort((i, -s))[:k]
            best_s, best_i, done = s[top], i[top], done + step
        for column, values in zip(out, ([query_ids[j]] * len(best_s), best_i, best_s)):
            column.extend(values)
    return out


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer components; of rows with the same id the largest vector counts."""
    t = t.combine_chunks()
    ids = t.column("vec_id").to_numpy()
    flat = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(len(ids), -1).astype(np.int64)
    order = np.lexsort((*x.T[::-1], ids))
    last = np.ones(len(ids), bool)
    last[:-1] = ids[order][1:] != ids[order][:-1]
    return ids[order][last], x[order][last]


def top_k(
    vectors: DataFrame, k: int = K, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", group_rows: int = GROUP_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """The ``k`` best rows for every row whose id is divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Components become floor(1024 * x) in double precision and scores are integer inner products, so results are exact.
    Vectors are dealt over groups by a hash of the id, queries over groups of their own; each task searches one pair of
    groups, and only its ``k`` best per query leave it. Both groups have a bounded size, whatever the table's.

    Components are 64-bit integers (beyond, the nearest of them). Sums of products that may pass 64 bits are added as
    Python's integers; a score beyond 64 bits is the nearest 64-bit integer, and ties among such go to smaller ids.

    Null vectors and vectors with null or non-finite components, and rows with a null id, take no part, nor do vectors
    of another length than the most frequent one. Rows with the same id are one candidate (the largest vector). Fewer
    than ``k`` candidates give all of them. An empty table gives no rows; other columns are ignored.
    """
    x = F.col(vector_col)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    usable = vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, finite))
    rows = usable.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    n, dimensions = (sizes["count"], sizes["d"]) if sizes else (0, 1)
    rows = rows.where(F.size("x") == dimensions)
    parts, query_parts = max(1, -(-n // group_rows)), max(1, -(-n // (every * query_rows)))
    data = rows.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(parts))).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    asked = rows.where(F.col("vec_id") % every == 0)
    asked = asked.withColumn("q", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_parts)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: tuple = ([], [], [])
        if left.num_rows and right.num_rows:
            columns = search(*_matrix(left), *_matrix(right), k)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    found = data.groupBy("g", "q").cogroup(asked.groupBy("g", "q")).applyInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH usable AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= {K}
"""

QUERIES = {"op6_vector_top_k": query}
ORACLE = {"op6_vector_top_k": SQL}
