"""Exact top-k search by MaxScore over integer vectors.

A vector is a document whose terms are its dimensions; a query term's weight is the query's
component. Rows are dealt to shards; a shard keeps one posting list per dimension with its
largest and smallest value, which bound what a term can add to a query's score. The terms that reach furthest are
essential and their lists are traversed, for some queries at a time, until the terms left can lift only a few rows over the
k-th best score that is certain by then. Those terms are looked up for the competitive rows alone, and rows that
fall behind are dropped on the way. Shards return their best k rows, which are merged.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor
do rows with a null id; shorter vectors are filled up with zeros; rows that repeat an id are candidates each, are never their own
query's candidates, and one query is made of every distinct vector of an id; ties go to the smaller id;
other columns are ignored; a score beyond 64 bits is an error; no rows or no queries give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 1024
# Terms looked at before rows are judged anew, and queries that share a traversal.
STEP = 16
TOGETHER = 64
# Share of rows that are still competitive from which on terms are looked up row by row.
FEW = 0.05
EXACT = 2**52

RESULT = "query_id long, query_key long, vec_id long, score long"


def quantized(vectors: DataFrame, factor: int = 64) -> DataFrame:
    """vec_id and terms: every component x as floor(factor * x), of the vectors that take part."""
    whole = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    sound = whole.where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return sound.select("vec_id", F.transform("e", lambda x: F.floor(F.lit(factor) * x).cast("long")).alias("terms"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


class Shard:
    """Postings by term of a bounded number of rows, in the order of their ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.high, self.low = self.rows.max(axis=0, initial=0), self.rows.min(axis=0, initial=0)
        self.reach = int(np.abs(self.rows).max(initial=0))
        self.lists = np.ascontiguousarray(self.rows.T.astype(np.float64))

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the best k rows of each query, exact."""
        if self.reach * int(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) >= EXACT:
            whole = [(self.rows.astype(object) @ q.astype(object)).astype(np.int64) for q in queries]
            return [self._best(others, scores[others], k) for others, scores in zip((np.flatnonzero(self.ids != i) for i in query_ids), whole)]
        q = queries.astype(np.float64)
        most, least = np.maximum(q * self.high, q * self.low), np.minimum(q * self.high, q * self.low)
        # Terms whose lists reach furthest for these queries come first.
        order = np.argsort(-np.maximum(most, -least).sum(axis=0), kind="stable")
        # What the terms from the i-th on can add and take away at most.
        add, take = (np.concatenate([np.cumsum(x[:, order][:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1))], axis=1) for x in (most, least))
        own = query_ids[:, None] == self.ids[None, :]
        partial = np.where(own, -np.inf, 0.0)
        bar = np.full(len(q), -np.inf)
        at, alive = 0, ~own
        while at < len(order):
            # Essential terms: all rows are traversed.
            terms = order[at : at + STEP]
            partial += q[:, terms] @ self.lists[terms]
            at += len(terms)
            if partial.shape[1] > k:
                # k rows reach this for certain, whatever the terms left take away.
                kth = np.partition(partial, partial.shape[1] - k, axis=1)[:, partial.shape[1] - k]
                bar = np.maximum(bar, kth + take[:, at])
            alive = partial + add[:, at, None] >= np.maximum(bar, -1e300)[:, None]
            if alive.mean() < FEW:
                break
        return [self._probe(np.flatnonzero(alive[i]), partial[i], q[i], order[at:], add[i, at:], take[i, at:], bar[i], k) for i in range(len(q))]

    def _probe(self, rows, partial, query, terms, add, take, bar, k):
        """Look the terms left up for the rows that are still competitive, the furthest reaching first."""
        partial = partial[rows]
        for at in range(0, len(terms), STEP):
            some = terms[at : at + STEP]
            partial = partial + self.rows[rows][:, some] @ query[some]
            after = min(at + STEP, len(terms))
            if len(rows) > k:
                bar = max(bar, float(np.partition(partial, len(rows) - k)[len(rows) - k] + take[after]))
                keep = partial + add[after] >= bar
                rows, partial = rows[keep], partial[keep]
        return self._best(rows, partial.astype(np.int64), k)

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        take = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[take]], scores[take]


def _search(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "query_key": [], "vec_id": [], "score": []}, dtype="int64")
        width = max(queries["terms"].map(len).max(), rows["terms"].map(len).max())
        shard = Shard(rows["vec_id"].to_numpy(), _matrix(rows["terms"], width))
        found = []
        names, keys, terms = queries["vec_id"].to_numpy(), queries["query_key"].to_numpy(), _matrix(queries["terms"], width)
        for at in range(0, len(names), TOGETHER):
            part = slice(at, at + TOGETHER)
            for query_id, key, (ids, scores) in zip(names[part], keys[part], shard.top(names[part], terms[part], k)):
                found.append((np.full(len(ids), query_id), np.full(len(ids), key), ids, scores))
        return pd.DataFrame(dict(zip(("query_id", "query_key", "vec_id", "score"), (np.concatenate(c).astype("int64") for c in zip(*found)))))

    return search


def _upto(n: int):
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def search(queries: DataFrame, rows: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k best rows of ``rows`` for every row of ``queries`` (both vec_id, terms), by integer inner product.

    Queries and rows meet in blocks: every shard of rows sees every block of queries once, in a task that holds one
    of each. Both block sizes are fixed; their numbers follow the input.
    """
    queries = queries.distinct().withColumn("query_key", F.xxhash64("terms"))
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    left = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "query_key", F.lit(7)), F.lit(blocks))).withColumn("shard", F.explode(_upto(shards)))
    right = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "terms"), F.lit(shards))).withColumn("block", F.explode(_upto(blocks)))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(_search(k), RESULT)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
