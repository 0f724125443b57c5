"""Exact top-k by inner product over a pivot-distance index.

Vectors get one more component so that all have the same length; the largest inner product is then
the smallest distance, and the triangle inequality holds. Rows are kept by nearest pivot and
sorted by their distance to it. Blocks of these annuli are the unit of search: a query first scores
the block it lies in, which gives a lower bound for its k-th score, and then only the blocks whose
annulus can hold something as near.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import kept

PIVOTS = 32
PIVOT_SAMPLE = 4096
BLOCK_ROWS = 1024
CHUNK_ROWS = 512
BLOCKS_PER_KEY = 4
EXACT = 1 << 52
BLOCK = "pivot int, low double, high double, ids array<long>, vectors binary"


def usable(embeddings: DataFrame, scale: int, id: str, vector: str) -> DataFrame:
    """id and vector of whole numbers floor(scale * x); rows without id, vector or with a null or non-finite component go."""
    x = F.col("v")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & x.isNotNull() & finite).select("id", F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("v"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from one another, each the farthest from those chosen before it."""
    chosen = [0]
    nearest = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        far = int(nearest.argmax())
        if nearest[far] == 0:
            break
        chosen.append(far)
    return sample[chosen]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length; shorter vectors are filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return out


def _distances(rows: np.ndarray, longest: float, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, both with the added component that makes all squared lengths `longest`."""
    own, theirs = (rows**2).sum(axis=1), (pivots**2).sum(axis=1)
    added = np.sqrt(np.maximum(longest - own, 0))[:, None] * np.sqrt(np.maximum(longest - theirs, 0))[None, :]
    return np.sqrt(np.maximum(2 * longest - 2 * (rows @ pivots.T + added), 0))


def top_k(
    embeddings: DataFrame, k: int, every: int, scale: int = 64, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest inner product for each row whose id `every` divides.

    Candidates are all rows but those with the query's own id; ties go to the smaller id; fewer
    candidates give fewer rows. Rows with null id, null vector, or a null or non-finite component
    take no part. Vectors of unequal length count as filled with zeros. Scores are exact while
    squared lengths stay below 2**52. Empty tables give no rows; further columns are not read.
    Pivots come from a sample of PIVOT_SAMPLE rows; they only decide how much is skipped.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings, scale, id, vector)
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    shape = rows.agg(F.max(square).alias("longest"), F.max(F.size("v")).alias("dim")).first()
    longest, dim = float(shape.longest or 0), int(shape.dim or 0)
    if longest >= EXACT:
        raise ValueError("components are too large for exact scores")
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("v").collect()
    sample = np.zeros((max(1, len(drawn)), dim))
    for at, row in enumerate(drawn):
        sample[at, : len(row.v)] = row.v
    pivots = choose_pivots(sample, PIVOTS)
    slack = 1e-6 * (1 + np.sqrt(longest))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _distances(_matrix(batch.column(1), dim), longest, pivots)
                nearest = found.argmin(axis=1)
                columns = [batch.column(0), batch.column(1), pa.array(nearest, pa.int32()), pa.array(found[np.arange(len(found)), nearest])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "pivot", "distance"])

    def blocks(most: int):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                pivot = batch.column(2).to_numpy()
                far = batch.column(3).to_numpy()
                matrix = _matrix(batch.column(1), dim)
                ids = batch.column(0).to_numpy()
                edges = np.flatnonzero(np.diff(pivot)) + 1
                starts = [s for a, b in zip([0, *edges], [*edges, len(pivot)]) for s in range(a, b, most)]
                for a, b in zip(starts, [*starts[1:], len(pivot)]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([pivot[a]], pa.int32()),
                            pa.array([far[a:b].min()]),
                            pa.array([far[a:b].max()]),
                            pa.array([ids[a:b]], pa.list_(pa.int64())),
                            pa.array([matrix[a:b].tobytes()], pa.binary()),
                        ],
                        ["pivot", "low", "high", "ids", "vectors"],
                    )

        return cut

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("id", F.col("id").cast("long")).mapInArrow(place, "id long, v array<double>, pivot int, distance double")
    ordered = placed.repartitionByRange(parts, "pivot", "distance", "id").sortWithinPartitions("pivot", "distance", "id")
    index = kept(ordered.mapInArrow(blocks(BLOCK_ROWS), BLOCK), "annuli")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries of each block, with the k-th score that the block itself gives."""
        for batch in batches:
            for row in batch.to_pylist():
                ids, matrix = np.array(row["ids"], np.int64), np.frombuffer(row["vectors"]).reshape(len(row["ids"]), dim)
                own = np.flatnonzero(ids % every == 0)
                if not len(own):
                    continue
                scores = matrix[own] @ matrix.T
                scores[ids[own][:, None] == ids[None, :]] = -np.inf
                least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) >= k else np.full(len(own), -np.inf)
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[own]),
                        pa.array([row["pivot"]] * n, pa.int32()),
                        pa.array([row["low"]] * n),
                        pa.array(least),
                        pa.array([m.tobytes() for m in matrix[own]], pa.binary()),
                    ],
                    ["id", "pivot", "low", "least", "v"],
                )

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of near queries, and for each pivot the range of distances in which they may find something."""
        for batch in batches:
            for first in range(0, batch.num_rows, CHUNK_ROWS):
                some = batch.slice(first, CHUNK_ROWS)
                matrix = np.frombuffer(b"".join(some.column(4).to_pylist())).reshape(some.num_rows, dim)
                least = some.column(3).to_numpy()
                far = _distances(matrix, longest, pivots)
                radius = np.sqrt(np.maximum((matrix**2).sum(axis=1) + longest - 2 * least, 0))[:, None]
                own = np.sqrt(np.maximum(longest - (matrix**2).sum(axis=1), 0))[:, None] * np.sqrt(np.maximum(longest - (pivots**2).sum(axis=1), 0))[None, :]
                far = np.sqrt(far**2 + 2 * own + (matrix**2).sum(axis=1)[:, None] - longest)  # the query's added component is 0
                n = len(pivots)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(n), pa.int32()),
                        pa.array((far - radius).min(axis=0) - slack),
                        pa.array((far + radius).max(axis=0) + slack),
                        pa.array([some.column(0).to_pylist()] * n, pa.list_(pa.int64())),
                        pa.array([matrix.tobytes()] * n, pa.binary()),
                        pa.array([least] * n, pa.list_(pa.float64())),
                    ],
                    ["pivot", "near", "far", "query_ids", "queries", "least"],
                )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked, ids = np.array(row["query_ids"], np.int64), np.array(row["ids"], np.int64)
                queries = np.frombuffer(row["queries"]).reshape(len(asked), dim)
                scores = queries @ np.frombuffer(row["vectors"]).reshape(len(ids), dim).T
                scores[asked[:, None] == ids[None, :]] = -np.inf
                good = (scores >= np.array(row["least"])[:, None]) & (scores > -np.inf)
                q, c = np.nonzero(good)
                order = np.lexsort((ids[c], -scores[q, c], q))
                q, c = q[order], c[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, c = q[place < k], c[place < k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[q]), pa.array(ids[c]), pa.array(scores[q, c].astype(np.int64))], ["query_id", "vec_id", "score"]
                )

    keys = max(1, -(-index.count() // (PIVOTS * BLOCKS_PER_KEY)))
    queries = index.mapInArrow(bound, "id long, pivot int, low double, least double, v binary")
    near = queries.repartitionByRange(parts, "pivot", "low", "id").sortWithinPartitions("pivot", "low", "id")
    chunks = near.mapInArrow(reach, "pivot int, near double, far double, query_ids array<long>, queries binary, least array<double>")
    spread = chunks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(keys - 1))))
    dealt = index.withColumn("part", F.pmod(F.xxhash64("low", "ids"), F.lit(keys)).cast("int"))
    pairs = spread.join(dealt, ["pivot", "part"]).where((F.col("high") >= F.col("near")) & (F.col("low") <= F.col("far")))
    found = pairs.select("query_ids", "queries", "least", "ids", "vectors").mapInArrow(score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
