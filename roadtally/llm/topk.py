"""Exact top-k by inner product over a vector-approximation file."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadtally.session import cut_lineage

BLOCK_ROWS = 16_384  # rows that one task scans for one block of queries
BLOCK_QUERIES = 4_096
CELL_BITS = 4
# Scores of whole numbers below this bound are exact in doubles for up to 2**13 components.
EXACT_BOUND = 2**20
TOO_LARGE = 2.0**63  # whole numbers from here on are no longs


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``vec_id, vec``: components times ``scale``, rounded down.

    Rows whose id or vector is null, or whose vector holds null or non-finite components, take no
    part. A scaled component that is no long is an error. A repeated id counts once, with its
    smallest vector.
    """
    usable = F.col("vec_id").isNotNull() & F.forall(
        "vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))  # also false for NaN
    )

    def whole_number(x: Column) -> Column:
        x = x * F.lit(scale)
        return F.when(F.abs(x) < TOO_LARGE, F.floor(x)).otherwise(F.raise_error(F.lit("a scaled component is no long")))

    given = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    whole = given.where(usable).select("vec_id", F.transform("vec", whole_number).alias("vec"))
    return whole.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _ranked(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; exact ones beyond that range by their place in order."""
    if scores.dtype == object and len(scores):
        return np.unique(scores, return_inverse=True)[1].astype(np.int64)
    return scores.astype(np.int64)


def _scan(rows_id, rows, query_id, queries, k):
    """Best ``k`` rows of a block for each query: (query, row, score), exact.

    Components are quantised to cells that hold about equally many values. Two products with the
    cells' borders bound every score. Exact vectors are then read from the highest upper bound
    down, until the k-th best score is above all bounds that are left.
    """
    dims = rows.shape[1]
    big = max(np.abs(rows).max(initial=0), np.abs(queries).max(initial=0)) >= EXACT_BOUND
    steps = 2**CELL_BITS
    edges = np.quantile(rows, np.linspace(0, 1, steps + 1), axis=0, method="nearest") if dims else np.zeros((steps + 1, 0))
    codes = np.empty(rows.shape, np.uint8)
    for d in range(dims):
        codes[:, d] = np.clip(np.searchsorted(edges[:, d], rows[:, d], side="right") - 1, 0, steps - 1)
    at = np.arange(dims)
    low, high = edges[codes, at].astype(float), edges[codes + 1, at].astype(float)
    plus, minus = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    room = 1e-9 * (np.abs(plus).sum(1) - minus.sum(1))[:, None] * np.abs(rows).max(initial=0)
    exact_rows = rows.astype(object) if big else rows.astype(float)
    exact_queries = queries.astype(object) if big else queries.astype(float)
    found = []
    for a in range(0, len(queries), 64):
        upper = plus[a : a + 64] @ high.T + minus[a : a + 64] @ low.T + room[a : a + 64]
        for q in range(len(upper)):
            own = upper[q]
            own[rows_id == query_id[a + q]] = -np.inf
            read = min(4 * k, len(own))
            chosen = np.zeros(0, np.int64)
            while True:
                first = np.argpartition(-own, read - 1)[:read] if read < len(own) else np.arange(len(own))
                fresh = first[own[first] > -np.inf]
                scores = exact_rows[fresh] @ exact_queries[a + q] if dims else np.zeros(len(fresh))
                order = np.lexsort((rows_id[fresh], -_ranked(scores)))[:k]
                chosen, best = fresh[order], scores[order]
                if read == len(own):
                    break
                rest = np.ones(len(own), bool)
                rest[first] = False
                # A tie may still go to a smaller id, so the bounds left have to be below.
                if len(best) == k and own[rest].max() < best[-1]:
                    break
                read = min(4 * read, len(own))
            found += [(query_id[a + q], rows_id[i], int(s)) for i, s in zip(chosen, best)]
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The ``k`` highest inner products of each query with all other vectors of its length.

    ``vectors`` is ``vec_id, vec`` of :func:`whole_vectors`; queries are its rows for which
    ``is_query`` of ``vec_id`` holds. Returns ``query_id, rank, vec_id, score``, ties to the
    smaller vec_id, fewer than ``k`` where there are fewer vectors; a score among them that is no
    long is an error. Rows are dealt into blocks, and
    each block of rows meets each block of queries in a task of its own, which returns ``k`` rows
    for a query. Without vectors there are no rows.
    """
    vectors = cut_lineage(vectors)
    total = vectors.count()
    parts = max(1, -(-total // BLOCK_ROWS))
    asked = vectors.where(is_query)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    dims = F.size("vec").alias("dims")
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    rows = vectors.select("vec_id", "vec", dims, part, every_block)
    queries = asked.select("vec_id", "vec", dims, block, every_part)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=names)
        found = _scan(
            left["vec_id"].to_numpy(),
            np.stack(left["vec"].to_list()),
            right["vec_id"].to_numpy(),
            np.stack(right["vec"].to_list()),
            k,
        )
        return pd.DataFrame(found, columns=names)

    keys = ["part", "block", "dims"]
    best = rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        meet, "query_id long, vec_id long, score long"
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
