"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector cut into segments of m components is described by each segment's mean and standard
deviation. The squared distance of two vectors is at least the sum over segments of
m ((mean difference)^2 + (deviation difference)^2); with the norms known, that lower bound on
the distance is an upper bound on the inner product: sum of m (mean mean + deviation
deviation). Bounds are taken from one segment to many, each level only for what the level
before left; pairs that still could enter a query's best k are computed exactly.

All queries meet all vectors in blocks: vectors are packed into blocks that are dealt to
groups, the blocks of queries are copied to every group, and a task takes one block of queries at a time through
its group's vectors, keeping the best k of each query, which also raises the bar for the vectors that follow.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunset_engine.llm.common import lean, table
from sunset_engine.operators.joins import materialize

VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024
# Blocks of vectors in one group: a group is one task's share.
GROUP_BLOCKS = 64
SEGMENTS = (1, 4, 16)
SLICE = 512


def _packed(size: int) -> Callable:
    """Rows (vec_id, dim, vector) to rows (dim, ids, values) of at most ``size`` vectors."""
    def run(batches):
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                                               "type": pa.array([narrow(values).dtype.str]), "values": pa.array([narrow(values).tobytes()], pa.binary())})

        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                ids, values = part.column("vec_id").to_numpy(), np.floor(256 * part.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dim)
                for at in range(0, len(ids), size):
                    held.setdefault(dim, []).append((ids[at:at + size], values[at:at + size]))
                    if sum(len(x) for x, _ in held[dim]) >= size:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)
    return run


def narrow(values: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds all values."""
    most = np.abs(values).max(initial=0)
    if most >= 2 ** 63:
        raise ValueError("a component times 256 does not fit into a long")
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most < np.iinfo(t).max or t is np.int64))


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment, mean and deviation, each times the root of its length: their inner product is the bound."""
    bounds = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)[:-1]
    length = np.diff(np.append(bounds, x.shape[1]))
    mean = np.add.reduceat(x, bounds, axis=1) / length
    rest = x - np.repeat(mean, length, axis=1)
    return np.concatenate([mean * np.sqrt(length), np.sqrt(np.add.reduceat(rest * rest, bounds, axis=1))], axis=1)


class Best:
    """The best k of each query of a block so far: higher score first, then smaller id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, keys: np.ndarray, k: int):
        self.ids, self.x, self.keys, self.k = ids, x, keys, k
        self.whole = float(np.abs(x).max(initial=0))
        if self.whole >= 2.0 ** 63:
            raise ValueError("a component times 256 does not fit into a long")
        self.features = [segment_features(x, s) for s in SEGMENTS]
        self.bar = np.full(len(ids), -math.inf)
        self.rows = (np.zeros(0, np.int64),) * 3

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, score, ids = (np.concatenate(x) for x in zip(self.rows, (q, score, ids), strict=True))
        by = np.lexsort((ids, -score, q))
        q, score, ids = q[by], score[by], ids[by]
        first = np.searchsorted(q, np.arange(len(self.ids)))
        keep = np.arange(len(q)) - first[q] < self.k
        self.rows = q[keep], score[keep], ids[keep]
        at = np.arange(len(q)) - first[q] == self.k - 1
        self.bar[q[at]] = score[at]

    def meet(self, ids: np.ndarray, x: np.ndarray, features: list[np.ndarray]) -> None:
        exact = self.whole * np.abs(x).max(initial=0) * max(1, x.shape[1]) < 2 ** 53
        cols = np.arange(len(ids))
        alive = None
        for own, other in zip(self.features, features, strict=True):
            upper = own @ other[cols].T
            alive = upper + 0.5 + 1e-9 * np.abs(upper) >= self.bar[:, None]
            some = alive.any(axis=0)
            cols, alive = cols[some], alive[:, some]
            if not len(cols):
                return
        q, v = np.nonzero(alive)
        if exact and len(q) * 8 > alive.size:
            score = (self.x @ x[cols].T)[q, v].astype(np.int64)
        else:
            score = np.concatenate([np.einsum("ij,ij->i", self.x[q[s:s + 65536]].astype(np.int64), x[cols[v[s:s + 65536]]].astype(np.int64)) for s in range(0, len(q), 65536)] or [np.zeros(0, np.int64)])
        found = ids[cols[v]]
        if not exact:                          # sums in longs are right if their true value fits, whatever wrapped on the way
            about = np.concatenate([np.einsum("ij,ij->i", self.x[q[s:s + 65536]], x[cols[v[s:s + 65536]]]) for s in range(0, len(q), 65536)] or [np.zeros(0)])
            if (np.abs(about[found != self.ids[q]]) >= 2.0 ** 63 * (1 - 1e-9)).any():
                raise ValueError("a score does not fit into a long")
        fits = (found != self.ids[q]) & (score >= self.bar[q])
        self.add(q[fits], score[fits], found[fits])


def _searched(k: int) -> Callable:
    """Rows of a query block and a block of vectors to the best k of each query: one query block is held at a time.

    A query block's rows come one after another. If one came back later, its best would be taken anew and
    given out again; the ranking that follows takes the best of both.
    """
    def found(best: Best) -> pa.RecordBatch:
        q, score, ids = best.rows
        return pa.RecordBatch.from_pydict({"query_id": pa.array(best.ids[q]), "key": pa.array(best.keys[q]), "vec_id": pa.array(ids), "score": pa.array(score)})

    def run(batches):
        name, best = None, None
        for batch in batches:
            names, dims, ids_, types, values = (batch.column(c).to_pylist() for c in ("qblock", "dim", "ids", "type", "values"))
            for i, dim in enumerate(dims):
                if names[i] != name:
                    if best is not None:
                        yield found(best)
                    own = lambda c, i=i: batch.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
                    name, best = names[i], Best(own("qids"), own("qvalues").reshape(-1, dim), own("qkeys"), k)
                ids, x = np.frombuffer(ids_[i], np.int64), np.frombuffer(values[i], types[i]).reshape(-1, dim).astype(np.float64)
                features = [segment_features(x, s) for s in SEGMENTS]
                for at in range(0, len(ids), SLICE):
                    to = slice(at, at + SLICE)
                    best.meet(ids[to], x[to], [f[to] for f in features])
        if best is not None:
            yield found(best)
    return lean(run)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", embedding_col: str = "embedding") -> DataFrame:
    """Each query's ``k`` best vectors: rows (query_id, rank from 1, vec_id, score).

    Scores are inner products of floor(256 * component) as integers; all candidates, if there
    are fewer than ``k``; ties go to the smaller id. A vector under the query's own id is no
    candidate. Vectors without an id, null, empty or holding null or non-finite components
    take no part on either side, and a query meets only vectors of its own length. Where a component or
    the score of a pair that counts leaves the range of a long, the search fails. Equal query
    rows are answered once; vectors that repeat under one id are candidates once for every row.
    Other columns are not read; empty tables give no rows.
    """
    spark = vectors.sparkSession

    def fit(df: DataFrame) -> DataFrame:
        e = F.col("embedding")
        return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(embedding_col).alias("embedding"))
                .where(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)
                       & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
                .withColumn("dim", F.size(e)))

    asked = fit(queries).distinct()
    count = asked.count()
    numbers = max(1, math.ceil(count / QUERY_BLOCK))
    blocks = materialize(fit(vectors).select("vec_id", "dim", "embedding").mapInArrow(_packed(VECTOR_BLOCK), "dim int, ids binary, type string, values binary"), "search-blocks")
    groups = max(spark.sparkContext.defaultParallelism, math.ceil(blocks.count() / GROUP_BLOCKS))
    held = (asked.withColumn("part", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(numbers)))
            .groupBy("dim", "part").agg(F.collect_list(F.struct("vec_id", F.xxhash64("embedding").alias("key"), F.transform("embedding", lambda v: F.floor(256 * v.cast("double")).cast("double")).alias("x"))).alias("q"))
            .select("dim", F.concat_ws("-", "dim", "part").alias("qblock"), F.col("q.vec_id").alias("qids"), F.col("q.key").alias("qkeys"), F.flatten("q.x").alias("qvalues"))
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    # A merge join goes through its left side row by row: all vectors of the group for one query block, then the next block.
    met = held.hint("merge").join(blocks.withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")), ["g", "dim"])
    best = met.select("dim", "ids", "type", "values", "qblock", "qids", "qkeys", "qvalues").mapInArrow(_searched(k), "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_segment_search(spark, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 50 against all vectors, the best five."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
