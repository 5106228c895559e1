"""Packing: length buckets of least padding by dynamic programming, token-budget batches inside each bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import materialize, running_total, seeded_order, table
from fleetgauge.llm.mixing import n_tokens

BUCKETS, TOKEN_BUDGET, SEED = 8, 32_768, 11


def bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` length ranges with the least padding: every range is padded to its largest length.

    ``lengths`` ascend. The cost of a range is its largest length times its rows (their own tokens are the same for any
    choice), so the best end of the range before grows with the end looked at, and each layer is solved by divide and
    conquer in O(n log n).
    """
    n = len(lengths)
    if not n:
        return []
    upto = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    best = np.concatenate([[0.0], lengths * upto[1:]])
    back = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(buckets, n)):
        now, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        now[0] = 0.0
        stack = [(1, n, 0, n - 1)]
        while stack:
            low, high, a, b = stack.pop()
            if low > high:
                continue
            mid = (low + high) // 2
            last = min(b, mid - 1)
            cost = best[a : last + 1] + lengths[mid - 1] * (upto[mid] - upto[a : last + 1])
            k = int(np.argmin(cost))
            now[mid], choice[mid] = cost[k], a + k
            stack += [(low, mid - 1, a, a + k), (mid + 1, high, a + k, b)]
        best = now
        back.append(choice)
    ends, at = [], n
    for choice in reversed(back):
        if at:
            ends.append(int(lengths[at - 1]))
            at = int(choice[at])
    return ends[::-1]


def pack(
    docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Bucket, batch and padding of every row of ``docs``.

    Columns ``doc_id``, ``n_tokens`` (words and one end mark), ``bucket`` (from 0, by length), ``bucket_length`` (the
    length its rows are padded to), ``padding``, ``batch`` (from 0 in its bucket) and ``slot`` (place in the batch).
    Bucket ends minimise the padding over the exact histogram of all lengths: D distinct lengths take D * D / 2 tokens at
    least, so the driver holds at most the square root of twice the tokens (100,000 for 5 billion). A batch holds as many rows as fit into
    ``token_budget`` padded tokens, one at least. Rows of a bucket are dealt in the order of an MD5 of seed and id; a
    bucket is cut into many ordered ranges, so it is never one task.

    Null and blank texts have the end mark only. Rows with the same or a null id are separate rows; which of them takes
    which slot is open where their lengths are equal too. An empty table gives no rows; other columns are ignored.
    """
    sized = materialize(docs.select(F.col(id_col).alias("doc_id"), (n_tokens(F.col(text_col)) + 1).alias("n_tokens")), "lengths")
    cells = sized.groupBy("n_tokens").agg(F.count("*").alias("rows")).orderBy("n_tokens").toPandas()  # distinct lengths
    ends = bounds(cells["n_tokens"].to_numpy(np.float64), cells["rows"].to_numpy(np.float64), buckets)
    if not ends:
        ends = [1]
    number, length = F.lit(len(ends) - 1), F.lit(ends[-1])
    for i in range(len(ends) - 2, -1, -1):
        inside = F.col("n_tokens") <= ends[i]
        number, length = F.when(inside, i).otherwise(number), F.when(inside, ends[i]).otherwise(length)
    order = seeded_order(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = sized.select("doc_id", "n_tokens", number.cast("int").alias("bucket"), length.cast("long").alias("bucket_length"), order.alias("__order"), F.lit(1).alias("__one"))
    ranked = running_total(rows, ["bucket"], "__order", "n_tokens", "__one", "__rank", int(cells["rows"].sum()))
    per_batch = F.greatest(F.floor(F.lit(token_budget) / F.col("bucket_length")), F.lit(1)).cast("long")
    return ranked.select(
        "doc_id", "n_tokens", "bucket", "bucket_length", (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
        F.floor(F.col("__rank") / per_batch).cast("long").alias("batch"), (F.col("__rank") % per_batch).cast("long").alias("slot"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op2_length_packing": query}
ORACLE: dict[str, str] = {}
