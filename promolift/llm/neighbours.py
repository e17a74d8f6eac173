"""Approximate nearest neighbours by multi-index hashing.

Binary codes come from learned rotations (iterative quantisation, fitted on a bounded
sample) and are cut into byte substrings.  Rows are dealt by a hash to blocks of bounded
size; a block's task indexes every substring of its codes.  A query probes, substring by
substring, all values within a growing distance: when every substring has been probed to
distance d, each code within m * (d + 1) - 1 bits has been met (pigeonhole).  Once
``pool`` codes lie within such a radius, all codes as near as the pool's last are
reranked by exact distances of the original vectors, and the block's best are merged per
query.

Each query meets each block: a stated query set against all rows, in blocks, with a few
rows out per query and block.  On vectors without any structure the pool's radius is so
wide that the probes meet most codes; on clustered ones they meet few.

Defined cases: vectors that are null, zero or hold a null or non-finite component take no
part, nor do rows without an id; rows that share an id count once, with the smallest
vector; only vectors of a query's own dimension are its candidates; ties go to the
smaller id; fewer candidates than k give fewer rows; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drawn, ship

BITS = 256
#: Rows to fit the rotations on, rows and queries of a block, codes to rerank per block.
SAMPLE, BLOCK_ROWS, BLOCK_QUERIES, POOL = 4096, 4096, 4096, 256
_MASKS = [np.array([x for x in range(256) if bin(x).count("1") == d], np.int64) for d in range(9)]


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def learn(sample: np.ndarray, bits: int = BITS, rounds: int = 25, seed: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection to ``bits`` columns), by iterative quantisation of the sample."""
    rng = np.random.default_rng(seed)
    d, mean = sample.shape[1], sample.mean(0)
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, : min(d, bits)]
    v, parts = x @ axes, []
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
            r = (u @ w).T
        parts.append(axes @ r)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def encode(vectors: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Codes as bytes, one row of substrings for each vector."""
    return np.packbits((vectors - model[0]) @ model[1] > 0, axis=1)


class Index:
    """All substrings of a block's codes, each sorted by value."""

    def __init__(self, codes: np.ndarray):
        self.codes, (self.n, self.m) = codes, codes.shape
        self.wide = np.ascontiguousarray(codes).view(np.uint64)
        self.order = np.argsort(codes, axis=0, kind="stable").T.reshape(-1)
        at = [np.searchsorted(np.sort(codes[:, j]), np.arange(257)) + j * self.n for j in range(self.m)]
        self.start = np.stack(at)

    def near(self, code: np.ndarray, pool: int) -> np.ndarray:
        """Rows of every code within the smallest radius that holds ``pool`` codes."""
        unseen, distance = np.ones(self.n, bool), np.full(self.n, 10_000)
        wide, lanes = np.ascontiguousarray(code).view(np.uint64), np.arange(self.m)[:, None]
        for d, masks in enumerate(_MASKS):
            values = code.astype(np.int64)[:, None] ^ masks[None, :]
            begin, n = self.start[lanes, values].reshape(-1), (self.start[lanes, values + 1] - self.start[lanes, values]).reshape(-1)
            ends = np.cumsum(n)
            rows = self.order[np.repeat(begin - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
            fresh = np.zeros(self.n, bool)
            fresh[rows] = True
            fresh = np.flatnonzero(fresh & unseen)
            unseen[fresh] = False
            distance[fresh] = np.bitwise_count(self.wide[fresh] ^ wide).sum(1)
            sure = distance[distance <= self.m * (d + 1) - 1]
            if len(sure) >= pool:
                return np.flatnonzero(distance <= np.partition(sure, pool - 1)[pool - 1])
        return np.arange(self.n)


def block_search(rows: pd.DataFrame, queries: pd.DataFrame, model, k: int, pool: int) -> pd.DataFrame:
    """The k best rows of a block for each query: query_id, vec_id, score."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(rows) and len(queries):
        x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        q = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        ids, index, codes = rows["vec_id"].to_numpy(np.int64), Index(encode(x, model)), encode(q, model)
        for query_id, vector, code in zip(queries["vec_id"].tolist(), q, codes):
            at = index.near(code, pool)
            at = at[ids[at] != query_id]
            score = np.sqrt(((x[at] - vector) ** 2).sum(1))
            best = np.lexsort((ids[at], score))[:k]
            out["query_id"] += [query_id] * len(best)
            out["vec_id"] += ids[at][best].tolist()
            out["score"] += score[best].tolist()
    return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(df: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", vec_id: str = "vec_id", pool: int = POOL, block_rows: int = BLOCK_ROWS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row."""
    ship(df.sparkSession)
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    some = rows.where(drawn(F.xxhash64("vec_id", F.lit(3)), sample / max(1, count["n"]))).select("vec_id", "vector").toPandas().sort_values("vec_id")["vector"]
    models = {}
    for d in sorted({len(v) for v in some}):
        models[d] = learn(np.stack([v for v in some if len(v) == d]).astype(np.float64))
    blocks, sides = max(1, -(-count["n"] // block_rows)), max(1, -(-count["q"] // BLOCK_QUERIES))
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("vec_id", "vector", "dim", deal(blocks, 1).alias("block"), every(sides).alias("side"))
    right = rows.where(is_query).select("vec_id", "vector", "dim", deal(sides, 2).alias("side"), every(blocks).alias("block"))

    def best(key, a, b):
        model = models.get(int(key[0]))
        if model is None:  # a dimension that the sample lacks
            model = learn(np.random.default_rng(0).normal(size=(256, int(key[0]))))
        return block_search(a, b, model, k, pool)

    keys = ["dim", "block", "side"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
