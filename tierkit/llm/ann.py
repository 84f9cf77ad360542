"""Approximate nearest neighbours by an inverted multi-index.

Each vector is cut into two halves, each half quantised with its own
centroids; a pair of centroids is a cell.  A query scores both sets of
centroids, walks the cells by falling summed score with a heap until the cells
hold enough rows, and reranks every row of those cells exactly.

Centroids and the share of rows to visit come from a bounded sample of
``sample_rows`` vectors; every row is indexed.  Rows and queries meet in
blocks of bounded size per first centroid, so neither a full cell nor a
popular one lands in a single task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.scratch import keep
from tierkit.operators._names import q

CENTROIDS = 32
SAMPLE_ROWS = 8192
TARGET = 0.96
ROUNDS = 15
VECTOR_BLOCK, QUERY_BLOCK = 4096, 1024


class Index(NamedTuple):
    """Centroids of either half and the share of all rows that a query visits."""

    first: np.ndarray
    second: np.ndarray
    share: float


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1) - 2 * x @ centroids.T, axis=1)


def _centroids(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from ``k`` sample rows; empty clusters keep their place."""
    rng = np.random.default_rng(seed)
    found = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        owner = _nearest(x, found)
        sums = np.zeros_like(found)
        np.add.at(sums, owner, x)
        sizes = np.bincount(owner, minlength=len(found))
        found[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return found


def fit(sample: np.ndarray, k: int, rows: int, centroids: int = CENTROIDS, target: float = TARGET) -> Index:
    """Centroids of the sample and the share of rows at which a query finds
    ``target`` of its neighbours, measured on the sample by brute force.

    The sample's ``k * len(sample) / rows`` nearest stand for the ``k`` nearest
    of all rows, since they lie about as far away."""
    half = sample.shape[1] // 2
    first, second = _centroids(sample[:, :half], centroids, 1), _centroids(sample[:, half:], centroids, 2)
    cell = _nearest(sample[:, :half], first) * len(second) + _nearest(sample[:, half:], second)
    sizes = np.bincount(cell, minlength=len(first) * len(second))
    queries = sample[:512]
    score = queries @ sample.T
    score[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    near = min(k, max(1, round(k * len(sample) / max(rows, 1))), len(sample) - 1)
    if near < 1:
        return Index(first, second, 1.0)
    wanted = np.argpartition(-score, near - 1, axis=1)[:, :near]
    summed = ((queries[:, :half] @ first.T)[:, :, None] + (queries[:, half:] @ second.T)[:, None, :]).reshape(len(queries), -1)
    order = np.argsort(-summed, axis=1)
    visited = np.empty_like(order)
    np.put_along_axis(visited, order, np.cumsum(sizes[order], axis=1), axis=1)
    needed = np.take_along_axis(visited, cell[wanted], axis=1) / len(sample)
    return Index(first, second, float(np.quantile(needed, target)))


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: float) -> Iterator[tuple[int, int]]:
    """Cells by falling sum of the two scores until they hold ``enough`` rows."""
    by_first, by_second = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[by_first].tolist(), second[by_second].tolist()
    i_of, j_of = by_first.tolist(), by_second.tolist()
    counts = sizes[by_first][:, by_second].tolist()
    heap, seen, found = [(-(a[0] + b[0]), 0, 0)], set(), 0
    while heap and found < enough:
        _, i, j = heapq.heappop(heap)
        seen.add((i, j))
        found += counts[i][j]
        if counts[i][j]:
            yield i_of[i], j_of[j]
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in seen):
            heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in seen):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list<double> column of one width, without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _assigner(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = index.first.shape[1]
        for batch in batches:
            x = _matrix(batch.column(1))
            cells = [
                pa.array((_nearest(x[:, :half], index.first) if len(x) else np.zeros(0)).astype(np.int32)),
                pa.array((_nearest(x[:, half:], index.second) if len(x) else np.zeros(0)).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cells], names=["vec_id", "vector", "i", "j"])

    return run


def _prober(index: Index, sizes: np.ndarray, enough: float):
    """Per query and first centroid: which second centroids to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = index.first.shape[1]
        for batch in batches:
            x = _matrix(batch.column(1))
            row, group, masks = [], [], []
            for r, v in enumerate(x):
                visits: dict[int, np.ndarray] = {}
                for i, j in walk(index.first @ v[:half], index.second @ v[half:], sizes, enough):
                    visits.setdefault(i, np.zeros(len(index.second), np.uint8))[j] = 1
                for i, mask in visits.items():
                    row.append(r)
                    group.append(i)
                    masks.append(mask.tobytes())
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(group, pa.int32()), pa.array(masks, pa.binary())],
                names=["query_id", "vector", "i", "visit"],
            )

    return run


def top(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` largest finite scores; of equal ones the
    first columns."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        rows, columns = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
    else:
        rows, columns = np.nonzero(np.isfinite(scores))
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


def _reranker(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        vectors = vectors.sort_by("vec_id")
        ids, x = vectors["vec_id"].to_numpy(), _matrix(vectors["vector"])
        asked, y = queries["query_id"].to_numpy(), _matrix(queries["vector"])
        scores = np.full((len(asked), len(ids)), -np.inf)
        if len(asked) and len(ids):
            cells = vectors["j"].to_numpy()
            visit = np.frombuffer(b"".join(queries["visit"].to_pylist()), np.uint8).reshape(len(asked), -1)
            for j in np.unique(cells).tolist():
                rows, columns = np.flatnonzero(visit[:, j]), np.flatnonzero(cells == j)
                # One product and one sum per coordinate, in order: equal
                # vectors get equal scores wherever they stand.
                part = np.zeros((len(rows), len(columns)))
                for d in range(x.shape[1]):
                    part += y[rows, d][:, None] * x[columns, d][None, :]
                scores[np.ix_(rows, columns)] = part
            scores[asked[:, None] == ids[None, :]] = -np.inf
        rows, columns = top(scores, k)
        return pa.table({"query_id": asked[rows], "vec_id": ids[columns], "score": scores[rows, columns]})

    return run


def usable(vector: Column) -> Column:
    """No null, no non-finite component, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    sample_rows: int = SAMPLE_ROWS,
    target: float = TARGET,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` largest inner products
    found per query row, its own id excluded; equal scores by smaller id.

    ``is_query`` is a condition on the id column.  Rows with a null id, and
    null, empty or zero vectors or such with null or non-finite components,
    take no part; nor do vectors of another length than the most common one.
    A row that repeats an id and vector counts once.  Of equal vectors only
    the ``k + 1`` smallest ids are indexed, since no other can be among a
    query's nearest; that is exact.  Other columns are ignored, and a table
    without usable vectors gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(q(id_col).cast("long").alias("vec_id"), q(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    common = widths.orderBy(F.desc("n"), "width").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = keep(rows.where(F.size("vector") == common["width"]).distinct(), "vectors")
    alike = Window.partitionBy("hash", "vector").orderBy("vec_id")
    first = rows.withColumn("hash", F.xxhash64("vector")).withColumn("copy", F.row_number().over(alike))
    wide = common["width"] % 2  # an odd width gets a zero coordinate, which changes no product
    padded = F.concat("vector", F.array(F.lit(0.0))) if wide else F.col("vector")
    indexed = keep(first.where(F.col("copy") <= k + 1).select("vec_id", padded.alias("vector")), "indexed")
    count = indexed.count()
    sample = indexed.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows)
    index = fit(np.array([r["vector"] for r in sample.collect()], dtype=np.float64), k, count, centroids, target)
    cells = keep(indexed.mapInArrow(_assigner(index), "vec_id long, vector array<double>, i int, j int"), "cells")
    sizes = np.zeros((len(index.first), len(index.second)), np.int64)
    for r in cells.groupBy("i", "j").count().collect():
        sizes[r["i"], r["j"]] = r["count"]

    asked = rows.where(is_query).select("vec_id", padded.alias("vector"))
    enough = max(index.share * count, 4.0 * (k + 1))
    probes = keep(
        asked.mapInArrow(_prober(index, sizes, enough), "query_id long, vector array<double>, i int, visit binary"), "probes"
    )
    per_group = dict(probes.groupBy("i").count().collect())
    v_blocks = [max(1, -(-int(n) // VECTOR_BLOCK)) for n in sizes.sum(axis=1)]
    q_blocks = [max(1, -(-per_group.get(i, 0) // QUERY_BLOCK)) for i in range(len(index.first))]

    def blocks(counts: list[int]) -> Column:
        return F.array(*[F.lit(n) for n in counts])[F.col("i")]

    def all_of(counts: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(counts) - 1))

    left = cells.where(F.col("i").isin(list(per_group))).withColumn("v", F.pmod(F.xxhash64("vec_id"), blocks(v_blocks)).cast("int")).withColumn("w", all_of(q_blocks))
    right = probes.withColumn("w", F.pmod(F.xxhash64("query_id"), blocks(q_blocks)).cast("int")).withColumn("v", all_of(v_blocks))
    found = (
        left.groupBy("i", "v", "w")
        .cogroup(right.groupBy("i", "v", "w"))
        .applyInArrow(_reranker(k), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
