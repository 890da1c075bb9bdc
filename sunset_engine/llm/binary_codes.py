"""Embedding near-duplicates by randomised-rotation binary codes.

A unit vector o is rotated by random orthogonal matrices. The signs of the first rotation
are its code; with the stored factor f = <code, o> (the code scaled to unit length), the
inner product of the code and another rotated vector q, divided by f, is an unbiased
estimate of <o, q>. Its error is confined to sqrt(1 - <o, q>^2) sqrt(1 - f^2) / f times a
value of spread 1 / sqrt(dim - 1) (Gao and Long, "RaBitQ"). Since a link has <o, q> of at
least the threshold, an estimate below the threshold by more than that bound settles a
pair; all others are computed exactly in double precision.

Candidates come from the same sign bits: groups of them (of further rotations where one
has too few) are the buckets of several tables. Two vectors at the threshold share a bit
with probability 1 - angle / pi, so the number of tables follows from the recall asked
for; the number of bits a bucket follows from the number of vectors, which keeps the
expected bucket size constant. A pair is counted in the first table it shares only.

Equal vectors are one class. Buckets beyond the block size are dealt out as pairs of
blocks, and blocks answer with link counts and a spanning forest, never with all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunset_engine.llm.common import connected_components, table
from sunset_engine.operators.joins import materialize

# Expected vectors in a bucket, as a power of two.
BUCKET_BITS = 10
# Vectors in one block of a bucket: two of them meet in one task's memory.
BLOCK = 2048
SLICE = 256
# Chance of finding a pair that is exactly at the threshold; higher above it.
RECALL = 0.999
# Width of the confidence bound, in spreads of the estimate.
EPSILON = 5.0
SEED = 1729


def plan(vectors: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a bucket key and number of tables."""
    bits = max(1, math.ceil(math.log2(max(2, vectors))) - BUCKET_BITS)
    share = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - share))) if share < 1 else 1


def rotation(dim: int, number: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _coded(bits: int, tables: int) -> Callable:
    def run(batches):
        turned: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            sizes = np.array(batch.column("dim").to_pylist(), np.int64)
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                if dim not in turned:
                    turned[dim] = [rotation(dim, i) for i in range(math.ceil(bits * tables / dim))]
                u = unit(matrix(part.column("embedding"), dim))
                y = [u @ r for r in turned[dim]]
                signs = np.concatenate([v >= 0 for v in y], axis=1)
                keys = signs[:, :bits * tables].reshape(-1, tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
                codes = np.packbits(signs[:, :dim], axis=1)
                factor = np.abs(y[0]).sum(axis=1) / math.sqrt(dim)
                yield pa.RecordBatch.from_arrays([
                    part.column("label"), part.column("dim"), part.column("rep"), part.column("copies"), part.column("embedding"),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * tables, pa.int32()), pa.array(keys.ravel()))],
                    names=["label", "dim", "rep", "copies", "embedding", "code", "factor", "keys"])
    return run


def _compared(threshold: float) -> Callable:
    spread = math.sqrt(max(0.0, 1 - threshold * threshold))

    def run(key: tuple, group: pa.Table) -> pa.Table:
        dim, t, i, j = (key[x].as_py() for x in (1, 2, 4, 5))
        group = group.sort_by("rep").combine_chunks()
        rep = group.column("rep").to_numpy()
        copies = group.column("copies").to_numpy()
        block = group.column("block").to_numpy()
        flat = lambda c: group.column(c).combine_chunks()
        x = matrix(flat("embedding"), dim)
        u = unit(x)
        keys = flat("keys").flatten().to_numpy(zero_copy_only=False).reshape(len(rep), -1)
        codes = np.frombuffer(b"".join(group.column("code").to_pylist()), np.uint8).reshape(len(rep), -1)
        signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
        f = group.column("factor").to_numpy()
        width = EPSILON / math.sqrt(dim - 1) if dim > 1 else math.inf
        cut = (threshold - spread * np.sqrt(np.maximum(0, 1 - f * f)) / f * width - 1e-5 if dim > 1 else np.full(len(f), -math.inf)).astype(np.float32)
        y = (u @ rotation(dim, 0)).astype(np.float32)
        links = np.zeros(len(rep), np.int64)
        root = np.arange(len(rep))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        for at in range(0, len(left), SLICE):
            rows = left[at:at + SLICE]
            estimate = signs[rows] @ y[right].T / (math.sqrt(dim) * f[rows, None]).astype(np.float32)
            a, b = np.nonzero(estimate >= cut[rows, None])
            a, b = rows[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            for s in range(0, len(a), 1 << 16):
                p, q = a[s:s + (1 << 16)], b[s:s + (1 << 16)]
                near = np.einsum("ij,ij->i", u[p], u[q]) >= threshold
                p, q = p[near], q[near]
                own = ~(keys[p, :t] == keys[q, :t]).any(axis=1)
                p, q = p[own], q[own]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                while True:                   # hook the larger root to the smaller, then shorten
                    m, n = root[p], root[q]
                    if (m == n).all():
                        break
                    low = np.minimum(m, n)
                    np.minimum.at(root, m, low)
                    np.minimum.at(root, n, low)
                    while (root[root] != root).any():
                        root = root[root]
        some = links > 0
        return pa.table({"rep": pa.array(rep[some]), "root": pa.array(rep[root[some]]), "links": pa.array(links[some])})
    return run


def usable(embedding: Column) -> Column:
    """Not null, not empty, all components there and finite, and not all zero."""
    size = lambda v: F.abs(v)
    return (embedding.isNotNull() & (F.size(embedding) > 0)
            & F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (size(v) < float("inf")))
            & F.exists(embedding, lambda v: v != 0))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", embedding_col: str = "embedding",
                    label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per vector.

    Vectors link when their labels are equal and their cosine, in double precision, is at
    least ``threshold``; ``n_links`` counts the other rows linked directly, ``component_id``
    is the smallest id reachable, and ``kept`` marks the rows that carry it. Null labels, and
    vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, and neither do vectors of different length. Rows that repeat a vector count
    each; different vectors under one id count as one vertex. A row without an id links with
    nothing and is kept. Other columns are not read; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(embedding_col).alias("embedding"), F.col(label_col).alias("label"))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    classes = materialize(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
                          .withColumn("dim", F.size("embedding")), "codes-classes")
    bits, tables = plan(classes.count(), threshold)
    kind = classes.schema["embedding"].dataType.simpleString()
    coded = classes.select("label", "dim", "rep", "copies", "embedding").mapInArrow(
        _coded(bits, tables), f"label {classes.schema['label'].dataType.simpleString()}, dim int, rep long, copies long, embedding {kind}, code binary, factor double, keys array<long>")
    coded = materialize(coded, "codes")
    bucket = ["label", "dim", "t", "key"]
    crowded = (coded.select("label", "dim", F.posexplode("keys").alias("t", "key")).groupBy(*bucket).count()
               .where(F.col("count") > block).select(*bucket, F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    dealt = (coded.select("*", F.posexplode("keys").alias("t", "key")).join(crowded, bucket, "left")
             .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .select(*bucket, "i", "j", "rep", "copies", "block", "embedding", "code", "factor", "keys"))
    parts = materialize(dealt.groupBy(*bucket, "i", "j").applyInArrow(_compared(threshold), "rep long, root long, links long"), "codes-links")
    links = parts.groupBy("rep").agg(F.sum("links").alias("links"))
    found = connected_components(parts.select(F.col("rep").alias("a"), F.col("root").alias("b")), "codes-components")
    of_class = (classes.join(links, "rep", "left").join(found.withColumnRenamed("id", "rep"), "rep", "left")
                .select("label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")))
    return (rows.join(of_class, ["label", "embedding"], "left")
            .select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op1_binary_codes(spark, sf_dir: str) -> DataFrame:
    """All embeddings, cosine of 0.98 or more within a label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a, a AS b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN counts ON vec_id = counts.a
"""
