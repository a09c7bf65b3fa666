"""Integer k-means whose assignments are filtered along rotated axes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import table
from tidewatch.llm.vectors import packed_vectors

#: Components below this stay exact in 64-bit sums of squared differences; larger ones go through whole numbers of
#: any size, one vector at a time.
SMALL = 1 << 24
#: The rotation is fitted on at most so many vectors, those of the smallest hash. It sets the bounds' sharpness,
#: never the result.
SAMPLE = 4096
#: Leading rotated coordinates that are stored beside the residual norm.
LEADING = 12
#: Partial sums of a cluster meet in so many groups first, then in one.
SLOTS = 32
LONG = (1 << 63) - 1


@dataclass
class Rotation:
    """A mean and the leading principal axes, one per column."""

    mean: np.ndarray
    axes: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, leading: int) -> Rotation:
        if not len(sample):
            return cls(np.zeros(sample.shape[1]), np.eye(sample.shape[1])[:, :leading])
        mean = sample.mean(axis=0)
        values = sample - mean
        return cls(mean, np.ascontiguousarray(np.linalg.eigh(values.T @ values)[1][:, ::-1][:, :leading]))

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Leading coordinates and, as the last column, the norm of what they leave."""
        values = rows - self.mean
        lead = values @ self.axes
        rest = values - lead @ self.axes.T
        return np.hstack([lead, np.sqrt((rest * rest).sum(axis=1))[:, None]])


def floored(rows: np.ndarray, scale: int) -> np.ndarray | None:
    """``floor(scale * x)`` as 64-bit integers, or None when one is not small."""
    out = np.floor(rows * scale)
    return out.astype(np.int64) if (np.abs(out) < SMALL).all() else None


def exact_floor(x: float, scale: int) -> int:
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def vector_of(packed: bytes, large: str | None) -> list[int]:
    return [int(x) for x in large.split(",")] if large else np.frombuffer(packed, np.int64).tolist()


def to_integers(embeddings: DataFrame, id_column: str, vector_column: str, width: int, scale: int) -> DataFrame:
    """``id``, ``v`` (64-bit integers) or, for a vector with a large component, ``large`` (decimal numbers by comma)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small, large = [], []
            for packed in batch.column("v").to_pylist():
                row = np.frombuffer(packed, np.float64)
                whole = floored(row, scale)
                small.append(None if whole is None else whole.tobytes())
                large.append(",".join(str(exact_floor(x, scale)) for x in row.tolist()) if whole is None else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(small, pa.binary()), pa.array(large, pa.string())], ["id", "v", "large"])

    rows = packed_vectors(embeddings, id_column, vector_column).where(F.octet_length("v") == 8 * width)
    id_type = embeddings.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, v binary, large string")


def with_coordinates(vectors: DataFrame, rotation: Rotation, width: int) -> DataFrame:
    """Adds ``y``: the leading rotated coordinates and the residual norm of a small vector."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("v").to_pylist()
            at = [i for i, v in enumerate(packed) if v is not None]
            out: list[bytes | None] = [None] * len(packed)
            if at:
                rows = np.frombuffer(b"".join(packed[i] for i in at), np.int64).reshape(-1, width)
                for i, y in zip(at, rotation.project(rows.astype(np.float64))):
                    out[i] = y.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "y"])

    return vectors.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in vectors.schema)}, y binary")


class Nearest:
    """Nearest centroids of a block of vectors, exact and with ties to the smaller number."""

    def __init__(self, centroids: list[list[int]], rotation: Rotation) -> None:
        self.whole = centroids
        self.small = all(abs(x) < SMALL for c in centroids for x in c)
        if self.small:
            self.rows = np.array(centroids, np.int64)
            self.y = rotation.project(self.rows.astype(np.float64))

    def distances(self, rows: np.ndarray, number: np.ndarray) -> np.ndarray:
        gap = rows - self.rows[number]
        return (gap * gap).sum(axis=1)

    def block(self, rows: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Cluster and squared distance of small vectors, and how many distances were computed.

        The squared distance in the leading axes plus the squared difference of the residual norms is at most the
        squared distance. The centroid of the smallest bound gives a first distance; only centroids whose bound,
        less what rounding may add, does not exceed it are computed, in order of their numbers.
        """
        gap = y[:, None, :] - self.y[None, :, :]
        bounds = (gap * gap).sum(axis=2)
        size = (y * y).sum(axis=1)[:, None] + (self.y * self.y).sum(axis=1)[None, :]
        bounds -= 1e-9 * (size + 1)
        best = bounds.argmin(axis=1)
        least = self.distances(rows, best)
        computed = len(rows)
        for number in range(len(self.rows)):
            left = np.flatnonzero((bounds[:, number] <= least) & (best != number))
            if len(left):
                computed += len(left)
                other = self.distances(rows[left], np.full(len(left), number))
                closer = (other < least[left]) | ((other == least[left]) & (number < best[left]))
                best[left[closer]], least[left[closer]] = number, other[closer]
        return best, least, computed

    def one(self, row: list[int]) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(row, c)), n) for n, c in enumerate(self.whole))[::-1]

    def assign(self, batch: pa.RecordBatch, width: int) -> tuple[list[int], list[int]]:
        packed, large, y = (batch.column(c).to_pylist() for c in ("v", "large", "y"))
        clusters, distances = [0] * len(packed), [0] * len(packed)
        at = [i for i, v in enumerate(packed) if v is not None and self.small]
        if at:
            rows = np.frombuffer(b"".join(packed[i] for i in at), np.int64).reshape(-1, width)
            best, least, _ = self.block(rows, np.frombuffer(b"".join(y[i] for i in at), np.float64).reshape(len(at), -1))
            for i, number, distance in zip(at, best.tolist(), least.tolist()):
                clusters[i], distances[i] = number, distance
        for i, v in enumerate(packed):
            if v is None or not self.small:
                clusters[i], distances[i] = self.one(vector_of(v, large[i]))
        return clusters, distances


def moved(vectors: DataFrame, centroids: list[list[int]], rotation: Rotation, width: int) -> list[list[int]]:
    """The centroids after one round: the floored mean of each one's vectors, or the centroid itself if it has none.

    Every task adds up its own vectors, so at most one row per task and cluster is shuffled, and one row per cluster
    reaches the driver.
    """
    nearest = Nearest(centroids, rotation)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [0] * len(centroids)
        sums = [[0] * width for _ in centroids]
        for batch in batches:
            clusters, _ = nearest.assign(batch, width)
            packed, large = batch.column("v").to_pylist(), batch.column("large").to_pylist()
            members: dict[int, list[bytes]] = {}
            for cluster, v, text in zip(clusters, packed, large):
                counts[cluster] += 1
                if v is None:
                    sums[cluster] = [a + b for a, b in zip(sums[cluster], vector_of(v, text))]
                else:
                    members.setdefault(cluster, []).append(v)
            for cluster, rows in members.items():
                # A batch's sums of small components fit 64 bits.
                total = np.frombuffer(b"".join(rows), np.int64).reshape(-1, width).sum(axis=0).tolist()
                sums[cluster] = [a + b for a, b in zip(sums[cluster], total)]
        used = [c for c, n in enumerate(counts) if n]
        if used:
            yield rows_of([(c, counts[c], sums[c]) for c in used])

    def rows_of(found: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"cluster": pa.array([c for c, _, _ in found], pa.int32()), "n": pa.array([n for _, n, _ in found], pa.int64()),
             "sums": pa.array([",".join(map(str, s)) for _, _, s in found], pa.string())}
        )

    def added(found: pa.Table) -> pa.Table:
        sums = [0] * width
        for text in found.column("sums").to_pylist():
            sums = [a + int(b) for a, b in zip(sums, text.split(","))]
        batch = rows_of([(found.column("cluster")[0].as_py(), sum(found.column("n").to_pylist()), sums)])
        return pa.Table.from_batches([batch])

    schema = "cluster int, n bigint, sums string"
    parts = vectors.mapInArrow(partial, schema)
    # Two steps, so that no task meets all tasks' sums of a cluster.
    for keys in (["cluster", F.spark_partition_id() % SLOTS], ["cluster"]):
        parts = parts.groupBy(*keys).applyInArrow(added, schema)
    out = [list(c) for c in centroids]
    for row in parts.collect():
        out[row.cluster] = [int(s) // row.n for s in row.sums.split(",")]
    return out


def assigned(vectors: DataFrame, centroids: list[list[int]], rotation: Rotation, width: int) -> DataFrame:
    """``id``, ``cluster`` and the squared ``distance`` to its centroid."""
    nearest = Nearest(centroids, rotation)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters, distances = nearest.assign(batch, width)
            fitting = [d if d <= LONG else None for d in distances]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(clusters, pa.int32()), pa.array(fitting, pa.int64())], ["id", "cluster", "distance"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {id_type}, cluster int, distance bigint")


def cluster(
    embeddings: DataFrame, clusters: int = 16, rounds: int = 3, scale: int = 64, width: int = 64, seed: int = 1,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """Clusters vectors by ``rounds`` rounds of k-means in whole numbers, then assigns them once more.

    One row per vector of ``width`` components, none null or non-finite: its id under ``id_column``, ``cluster``,
    ``distance`` (squared, to its centroid, in units of 1/``scale``), ``cluster_inertia`` and ``inertia`` (distance
    summed over its cluster and over all), ``centroid`` (array of decimal numbers as text). A component x counts as
    ``floor(scale * x)``. The starting centroids are the vectors with the smallest SHA-256 of ``seed:id``; equal
    distances go to the smaller number, means are floored componentwise, and an empty centroid stays.

    Vectors that are null, of another width, or hold a null or non-finite component are left out. One with a null id
    takes part but is no starting centroid; without any there are no rows. Rows of a repeated id each count; among the first centroids equal hashes
    are ordered by the components. With fewer vectors than ``clusters`` there are fewer centroids; no vectors give no
    rows. Components of any size are exact; a distance or a sum beyond a 64-bit integer is null. Other columns are not
    read.

    The vectors are written once, with their leading rotated coordinates and residual norm. A round is one reading of
    that table: each task filters its vectors' centroids by the bound, verifies the rest in whole numbers and adds up
    its clusters. The driver holds the centroids and the bounded sample that fits the rotation.
    """
    vectors = to_integers(embeddings, id_column, vector_column, width, scale)
    first: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    head = (
        vectors.withColumn("h", first).where("h IS NOT NULL").orderBy("h", "v", "large").limit(max(SAMPLE, clusters)).select("v", "large").collect()
    )
    centroids = [vector_of(r.v, r.large) for r in head[:clusters]]
    small = [np.frombuffer(r.v, np.int64) for r in head if r.v is not None]
    rotation = Rotation.fit(np.array(small, np.float64).reshape(len(small), width), min(LEADING, width))
    result = f"{id_column} {embeddings.schema[id_column].dataType.simpleString()}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<string>"
    if not centroids:
        return embeddings.sparkSession.createDataFrame([], result)
    stored = table(with_coordinates(vectors, rotation, width), "centroid-vectors")
    for _ in range(rounds):
        centroids = moved(stored, centroids, rotation, width)
    final = table(assigned(stored, centroids, rotation, width), "centroid-clusters")
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    # A cluster with a distance beyond a long has no inertia.
    complete = F.count("*") == F.count("distance")
    per_cluster = {r.cluster: r.s if r.complete else None for r in final.groupBy("cluster").agg(whole.alias("s"), complete.alias("complete")).collect()}
    total = None if None in per_cluster.values() else sum(per_cluster.values())

    def long(x: int | None) -> Column:
        return F.lit(int(x) if x is not None and x <= LONG else None).cast("bigint")

    def by_cluster(values: dict[int, Column]) -> Column:
        return F.create_map(*[c for n, v in values.items() for c in (F.lit(n), v)])[F.col("cluster")]

    return final.select(
        F.col("id").alias(id_column), "cluster", "distance",
        by_cluster({n: long(s) for n, s in per_cluster.items()}).alias("cluster_inertia"),
        long(total).alias("inertia"),
        by_cluster({n: F.array(*[F.lit(str(x)) for x in centroids[n]]) for n in per_cluster}).alias("centroid"),
    )

