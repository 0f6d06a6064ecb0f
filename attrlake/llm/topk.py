"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become integers floor(scale * x).  Rows and queries are dealt into
blocks by a hash of their id, and every query block meets every row block
once.  For a pair of blocks, each term (dimension) in turn scatters the
products of its queries and of its posting list (the rows with a non-zero
weight there) into a dense score array; a partition selection keeps the k
best of each block, and the blocks' winners are merged.

Edge cases: vectors that are null or hold a null or non-finite component take
no part, nor do null ids; rows that repeat an id each take part, as queries and as
candidates of one another; vectors of unequal length share the terms they both have; an
empty vector scores 0 with all.  Sums of products that could pass 63 bits are
taken in Python integers; an integer or a winner's score beyond 63 bits is
refused.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
SCALE = 64
ROW_BLOCK = 8192
QUERY_BLOCK = 1024
#: Queries and rows of a dense score array: one that stays in a core's cache.
TILE = (64, 2048)
FOUND = ("query_row", "query_id", "vec_id", "score")


def integer_vectors(vectors: DataFrame, scale: int = SCALE, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(row, vec_id, w): each row whose vector is whole and finite; ``row``
    tells rows of one id apart."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x"))
    whole = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    refused = F.raise_error(F.lit("a vector's component does not fit into 63 bits")).cast("long")
    ints = F.transform("x", lambda v: F.when(F.abs(v * scale) < float(2 ** 63), F.floor(v * scale)).otherwise(refused))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(whole)
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", ints.alias("w")))


class _Postings:
    """Sparse block: for each term, the rows that hold it and their weights.

    A list that holds a quarter of the rows or more is kept as the block's
    whole column, zeros included, which is scattered without an index.
    """

    def __init__(self, vectors: list):
        length = np.fromiter(map(len, vectors), np.int64, len(vectors))
        flat = np.concatenate([*vectors, np.zeros(0, np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(len(vectors)), length)
        term = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
        order = np.argsort(term, kind="stable")
        order = order[flat[order] != 0]
        start = np.searchsorted(term[order], np.arange(int(length.max(initial=0)) + 1))
        self.most = int(np.abs(flat).max(initial=0))
        self.lists: list[tuple[slice | np.ndarray, np.ndarray]] = []
        for a, b in zip(start, start[1:]):
            at, weight = row[order[a:b]], flat[order[a:b]]
            if len(at) * 4 >= len(vectors):
                column = np.zeros(len(vectors), np.int64)
                column[at] = weight
                at, weight = slice(None), column
            self.lists.append((at, weight))


def _scores(queries: _Postings, rows: _Postings, shape: tuple[int, int]) -> np.ndarray:
    """Term by term, the products of a query list and a posting list."""
    terms = min(len(queries.lists), len(rows.lists))
    most = queries.most * rows.most * max(terms, 1)
    kind = np.int32 if most < 2 ** 31 else np.int64 if most < 2 ** 63 else object
    score, product = np.zeros(shape, kind), np.empty(shape, kind)
    for (q, wq), (r, wr) in zip(queries.lists, rows.lists):
        if isinstance(q, slice) and isinstance(r, slice):
            np.multiply(wq.astype(kind)[:, None], wr.astype(kind), out=product)
            score += product
        elif len(wq) and len(wr):
            at = np.arange(shape[0])[q], np.arange(shape[1])[r]
            score[np.ix_(*at)] += wq.astype(kind)[:, None] * wr.astype(kind)
    return score


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    tiles = [(part.row.to_numpy(), part.vec_id.to_numpy(), _Postings(part.w.to_list()))
             for b in range(0, len(rows), TILE[1]) for part in [rows.iloc[b:b + TILE[1]]]]
    for a in range(0, len(queries), TILE[0]):
        part = queries.iloc[a:a + TILE[0]]
        ids, names, own = part.row.to_numpy(), part.vec_id.to_numpy(), _Postings(part.w.to_list())
        parts = []
        for others, vec_ids, postings in tiles:
            score = _scores(own, postings, (len(ids), len(others)))
            # A query's own row must not win; one more is taken in its place.
            take = min(k + 1, len(others))
            # The take-th best score of a query, and all that reach it, so ties go on whole to the order by id.
            floor = np.partition(score, len(others) - take, axis=1)[:, len(others) - take]
            qi, ri = np.nonzero((score >= floor[:, None]) & (ids[:, None] != others))
            parts.append(pd.DataFrame({"query_row": ids[qi], "query_id": names[qi], "vec_id": vec_ids[ri],
                                       "score": score[qi, ri].astype(np.int64)}))
        found = pd.concat(parts).sort_values(["query_row", "score", "vec_id"], ascending=[True, False, True])
        yield found.groupby("query_row", sort=False).head(k)


def top_k(queries: DataFrame, rows: DataFrame, k: int = K, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of each query but
    itself, ties to the smaller id; both inputs are (row, vec_id, w), the queries
    being some of the rows."""
    n_rows = max(1, -(-rows.count() // row_block))
    n_queries = max(1, -(-queries.count() // query_block))

    def dealt(df: DataFrame, mine: str, n: int, other: str, m: int, query: bool) -> DataFrame:
        return df.select(F.pmod(F.xxhash64("vec_id", "row"), F.lit(n)).cast("int").alias(mine),
                         F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other), F.lit(query).alias("query"), "row", "vec_id", "w")

    both = dealt(rows, "row_block", n_rows, "query_block", n_queries, False).unionByName(
        dealt(queries, "query_block", n_queries, "row_block", n_rows, True))

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        q, r = pdf[pdf["query"]], pdf[~pdf["query"]]
        parts = [] if q.empty or r.empty else list(_best(q, r, k))
        return pd.concat(parts) if parts else pd.DataFrame({c: np.zeros(0, np.int64) for c in FOUND})

    found = both.groupBy("row_block", "query_block").applyInPandas(pair, ", ".join(f"{c} bigint" for c in FOUND))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
