"""Exact top-k inner products by MaxScore over sharded postings.

Vectors are rounded to integers and dealt to blocks. A block's dimensions are
its terms: a term's postings are the vectors whose product with the query is
positive there, its bound the largest such product. Terms are ordered by bound.
Those whose bounds add up to less than the k-th best score so far are
non-essential: a vector that only they favour can't get in. Essential postings
are traversed, the other terms probed while a candidate can still compete, and
the blocks' lists are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
#: Vectors, and queries, in a block. A task holds one block of each.
BLOCK = 4096
QUERY_BLOCK = 512


def best_of_block(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best of one block for one query, ties to smaller ids; ids ascend in the block."""
    weights = np.flatnonzero(query)
    bound = np.maximum(0, np.where(query > 0, query * high, query * low))
    terms = weights[np.argsort(-bound[weights], kind="stable")]
    rest = np.concatenate((np.cumsum(bound[terms][::-1])[::-1], [0]))  # what terms from each on can add at most
    # A first threshold: vectors that do best on the heaviest terms, scored in full.
    head = vectors[:, terms[:6]] @ query[terms[:6]]
    first = np.argpartition(-head, min(4 * k, len(ids)) - 1)[: 4 * k] if len(ids) else np.zeros(0, int)
    first = first[ids[first] != query_id]
    seen = np.sort(vectors[first] @ query)[::-1]
    floor = seen[k - 1] if len(seen) >= k else None
    essential = len(terms) if floor is None else int(np.count_nonzero(rest[:-1] >= floor))
    if floor is None or floor < 0 or rest[-1] >= floor:
        candidates = np.arange(len(ids))  # no vector can be ruled out by having no postings
    else:
        chosen = terms[:essential]
        candidates = np.flatnonzero(((vectors[:, chosen] * np.sign(query[chosen])) > 0).any(axis=1))
    candidates = candidates[ids[candidates] != query_id]
    score = np.zeros(len(candidates), np.int64)
    for start in range(0, len(terms), 4):
        some = terms[start : start + 4]
        score += vectors[np.ix_(candidates, some)] @ query[some] if len(candidates) < len(ids) // 2 else (vectors[:, some] @ query[some])[candidates]
        if floor is not None:
            able = score + rest[min(start + 4, len(terms))] >= floor
            if not able.all():
                candidates, score = candidates[able], score[able]
    order = np.lexsort((ids[candidates], -score))[:k]
    return ids[candidates[order]], score[order]


def _blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows dealt to blocks of about ``size`` by a hash, and how many blocks there are."""
    count = max(1, -(-rows.count() // size))
    return rows.withColumn(name, F.expr(f"pmod(xxhash64(vec_id), {count}L)")), count


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` its ``k`` best other rows of ``vectors``.

    Both have ``vec_id`` and ``embedding``. Components are rounded down to
    1/1024. Rows with a null id, a null vector or a component that is null or
    not finite take no part. Rows of one id are one another's own: a query
    never finds its id, and rows repeated whole count once. Of rows that
    share an id with different vectors each counts, and vectors of different
    lengths agree on the shorter. Fewer than ``k`` others: all of them.
    """
    if k < 1:
        raise ValueError("k must be positive")

    def rounded(rows: DataFrame) -> DataFrame:
        known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
            "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        )
        return known.select("vec_id", F.expr(f"transform(embedding, x -> CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT))").alias("v")).distinct()

    found, n_found = _blocks(rounded(vectors), BLOCK, "found_block")
    asked, n_asked = _blocks(rounded(queries), QUERY_BLOCK, "asked_block")
    # Every block of vectors meets every block of queries, under the key of both.
    found = found.withColumn("asked_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_asked - 1).cast("long"))))
    asked = asked.withColumn("found_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_found - 1).cast("long"))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(left) and len(right):
            width = max(max(map(len, left["v"])), max(map(len, right["v"])))
            left = left.sort_values("vec_id", ignore_index=True)
            ids, rows = left["vec_id"].to_numpy(), _matrix(left["v"], width)
            high, low = rows.max(axis=0, initial=0), rows.min(axis=0, initial=0)
            for query_id, query in zip(right["vec_id"].tolist(), _matrix(right["v"], width), strict=True):
                best, score = best_of_block(ids, rows, query_id, query, k, high, low)
                out += [(query_id, int(i), int(s)) for i, s in zip(best, score, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["found_block", "asked_block"]
    met = found.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    ranked = met.distinct().withColumn("rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def search_every(vectors: DataFrame, step: int = 100, k: int = 10) -> DataFrame:
    """Top-k of the rows whose id is divisible by ``step``, against all rows."""
    return top_k(vectors, vectors.where(F.col("vec_id") % step == 0), k)
