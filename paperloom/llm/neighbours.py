"""Nearest neighbours by inner product, from randomly rotated one-bit codes.

Every distinct vector is rotated into more dimensions and kept as the signs of its coordinates,
with its length and the correction of the estimate (RaBitQ, Gao and Long 2024). A block of
queries meets each block of the index once: estimates come from the bits, their error bounds say
which vectors can be among the nearest, and only those are compared exactly. What leaves a pair
of blocks is k rows a query. Of equal vectors only the smallest k + 1 ids can matter, so a vector
that a third of all rows repeat is one entry.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import column, ship, written

CODE_BITS = 512  # per vector, at least; a multiple of 8
INDEX_BLOCK, QUERY_BLOCK = 8192, 512
# Standard errors of an estimate that its bound allows: it fails for one vector in 700.
EPSILON = 3.0
SEED = 20


def rotation(dim: int, bits: int = CODE_BITS) -> np.ndarray:
    """Columns of a random orthogonal matrix, which turn a vector padded with zeros."""
    random = np.random.default_rng([SEED, dim, bits])
    q, _ = np.linalg.qr(random.standard_normal((bits, dim)))
    return q.astype(np.float32)


def code_bits(dim: int) -> int:
    return max(CODE_BITS, -(-dim // 8) * 8)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs and two scalars by vector: length / correction, and the error per unit."""
    norms = np.linalg.norm(x, axis=1)
    turned = (x / norms[:, None]).astype(np.float32) @ turn.T
    bits = turned > 0
    agreement = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])
    error = norms * np.sqrt(np.maximum(0, 1 - agreement**2)) / agreement
    error /= np.sqrt(turn.shape[0] - 1)
    return np.packbits(bits, axis=1), np.column_stack([norms / agreement, error])


def estimate(codes: np.ndarray, scalars: np.ndarray, queries: np.ndarray, turn: np.ndarray):
    """Estimated inner products and their standard errors: queries by vectors."""
    signs = np.unpackbits(codes, axis=1, count=turn.shape[0]).astype(np.float32)
    turned = queries.astype(np.float32) @ turn.T
    # (2 * signs - 1) @ turned, over the square root of the number of bits
    sums = 2 * (turned @ signs.T) - turned.sum(axis=1, keepdims=True)
    found = sums / np.sqrt(turn.shape[0]) * scalars[:, 0]
    return found, np.linalg.norm(queries, axis=1)[:, None] * scalars[:, 1]


def search_block(
    codes, scalars, vectors, queries, k: int, turn, epsilon: float = EPSILON
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the vectors of the block that may be its nearest k, with exact scores."""
    found, error = estimate(codes, scalars, queries, turn)
    exact_of = vectors.astype(np.float64)
    n = len(vectors)
    out = []
    for q, query in enumerate(queries.astype(np.float64)):
        row, bound = found[q], found[q] + epsilon * error[q]
        if n > k:
            # k exact scores give a floor that the true k-th nearest reaches at least.
            first = np.argpartition(-row, min(n - 1, 2 * k))[: 2 * k]
            floor = np.partition(exact_of[first] @ query, -k)[-k]
            chosen = np.union1d(first, np.flatnonzero(bound >= floor))
        else:
            chosen = np.arange(n)
        out.append((chosen, exact_of[chosen] @ query))
    return out


def _valid(name: str):
    c = column(name)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return c.isNotNull() & fine & F.exists(c, lambda x: x != 0)


_BLOCK = "dim int, block int, n int, ids array<array<bigint>>, vectors binary, codes binary, scalars binary"
_QUERIES = "dim int, queries int, query_ids array<bigint>, query_vectors binary"
_FOUND = "query_id long, vec_id long, score double"


def _matrix(values: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.flatten().to_numpy(False).astype(np.float32).reshape(-1, dim)


def _pack_index(group: pa.Table) -> pa.Table:
    dim, block = group.column("dim")[0].as_py(), group.column("block")[0].as_py()
    x = _matrix(group.column("vector"), dim)
    codes, scalars = encode(x, rotation(dim, code_bits(dim)))
    return pa.table(
        {
            "dim": pa.array([dim], pa.int32()),
            "block": pa.array([block], pa.int32()),
            "n": pa.array([len(x)], pa.int32()),
            "ids": pa.array([group.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([x.tobytes()]),
            "codes": pa.array([codes.tobytes()]),
            "scalars": pa.array([scalars.astype(np.float64).tobytes()]),
        }
    )


def _pack_queries(group: pa.Table) -> pa.Table:
    dim = group.column("dim")[0].as_py()
    return pa.table(
        {
            "dim": pa.array([dim], pa.int32()),
            "queries": group.column("queries").slice(0, 1),
            "query_ids": pa.array([group.column("id").to_pylist()], pa.list_(pa.int64())),
            "query_vectors": pa.array([_matrix(group.column("vector"), dim).tobytes()]),
        }
    )


def _search(k: int):
    """The nearest k of each pair of a query block and an index block."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                dim, n = row["dim"].as_py(), row["n"].as_py()
                turn = rotation(dim, code_bits(dim))
                queries = np.frombuffer(row["query_vectors"].as_buffer(), np.float32)
                hits = search_block(
                    np.frombuffer(row["codes"].as_buffer(), np.uint8).reshape(n, -1),
                    np.frombuffer(row["scalars"].as_buffer(), np.float64).reshape(n, 2),
                    np.frombuffer(row["vectors"].as_buffer(), np.float32).reshape(n, dim),
                    queries.reshape(-1, dim),
                    k + 1,
                    turn,
                )
                ids = row["ids"].as_py()
                rows = []
                for query, (chosen, scores) in zip(row["query_ids"].as_py(), hits, strict=True):
                    near = []
                    for c in np.lexsort((chosen, -scores)):
                        # Vectors of a lower score are of no use once k ids are there.
                        if len(near) >= k and scores[c] < near[-1][0]:
                            break
                        near.extend(
                            (scores[c], vec) for vec in ids[chosen[c]] if vec != query
                        )
                        near.sort(key=lambda x: (-x[0], x[1]))
                        del near[k:]
                    rows.extend((query, vec, score) for score, vec in near)
                a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    return run


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k rows with the largest inner products with each query: query_id, rank, vec_id, score.

    Queries are the rows for which the column `is_query` holds; candidates are all other rows,
    that is those with another id. Scores are inner products in double precision; equal ones are
    ranked by vec_id. With fewer candidates than k all are returned. Vectors that are null,
    zero, or hold null or non-finite components take no part, neither do rows without an id; an
    exact repetition of a row counts once. Vectors are compared with those of their own
    dimension. The estimates' bounds hold with high probability, so a neighbour may be missed,
    but a score is never wrong.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        column(vec_id).cast("long").alias("id"),
        column(embedding).cast("array<float>").alias("vector"),
        is_query.alias("is_query"),
    ).filter(F.col("id").isNotNull() & _valid("vector"))
    rows = rows.withColumn("dim", F.size("vector").cast("int"))
    by_vector = Window.partitionBy("vector").orderBy("id")
    smallest = (
        rows.select("id", "vector", "dim")
        .withColumn("place", F.dense_rank().over(by_vector))
        .filter(F.col("place") <= k + 1)
    )
    entries = written(
        smallest.groupBy("dim", "vector").agg(F.array_sort(F.collect_set("id")).alias("ids")),
        "ann-vectors",
    )
    n_blocks = max(1, -(-entries.count() // INDEX_BLOCK))
    queries = rows.filter("is_query").select("id", "vector", "dim").distinct()
    n_queries = max(1, -(-queries.count() // QUERY_BLOCK))
    index = (
        entries.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(n_blocks)).cast("int"))
        .groupBy("dim", "block")
        .applyInArrow(_pack_index, _BLOCK)
    )
    packed = (
        queries.withColumn("queries", F.pmod(F.xxhash64("id"), F.lit(n_queries)).cast("int"))
        .groupBy("dim", "queries")
        .applyInArrow(_pack_queries, _QUERIES)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )
    pairs = packed.join(index, ["dim", "block"]).repartition(
        n_blocks * n_queries, "block", "queries"
    )
    found = pairs.mapInArrow(_search(k), _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
