"""Exact top-k by inner product over a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.llm.common import drop_table, table
from tidewatch.llm.vectors import matrix, packed_vectors

SCALE = 1024
#: Vectors of a cell, and queries, that meet in one task at a time.
CHUNK = 4096
#: Annuli per pivot, and pivots: one per PER_PIVOT vectors within these bounds. Pivots come from at most SAMPLE
#: vectors, those of the smallest hash; they set the work, never the result.
ANNULI = 4
PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 4096, 4, 256
SAMPLE = 4096
#: A query's first round reads its nearest cells until they hold so many vectors.
FIRST_ROUND = 1000
SLACK = 1e-6


@dataclass
class Pivots:
    """Pivots in the space where the largest inner product is the nearest neighbour: a vector x gets one more
    coordinate sqrt(M - |x|^2), with M the largest squared norm, and a query gets zero; then
    |q - x|^2 = |q|^2 + M - 2 <q, x>. Bounded by MOST_PIVOTS."""

    rows: np.ndarray
    extra: np.ndarray
    most: float

    def distances(self, rows: np.ndarray, extra: np.ndarray | float) -> np.ndarray:
        """Of each row from each pivot."""
        squared = (rows * rows).sum(1) + np.square(extra)
        own = (self.rows * self.rows).sum(1) + np.square(self.extra)
        product = rows @ self.rows.T + np.multiply.outer(np.broadcast_to(extra, len(rows)), self.extra)
        return np.sqrt(np.maximum(squared[:, None] + own - 2 * product, 0))

    def extras(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.most - (rows * rows).sum(1), 0))


@dataclass
class Cells:
    """Of each (pivot, annulus): its smallest and largest distance and how many chunks hold its vectors."""

    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray
    chunks: np.ndarray


def quantised(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``v``: floor(1024 x) of every component as packed doubles, which hold them exactly."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.floor(np.frombuffer(v, np.float64) * SCALE) + 0.0 for v in batch.column("v").to_pylist()]
            if any((np.abs(r) >= 2**31).any() for r in rows):
                raise ValueError("a component is too large for exact integer scores")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "v"])

    usable = packed_vectors(embeddings, id_column, vector_column, empty=True).where(F.col("v").isNotNull() & F.col("id").isNotNull())
    return usable.mapInArrow(run, f"id {usable.schema['id'].dataType.simpleString()}, v binary")


def choose_pivots(points: DataFrame, width: int, most: float, count: int) -> Pivots | None:
    """Pivots far from each other: from the sample, again and again the vector farthest from those taken."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate([matrix(b.column(0).to_pylist(), width) for b in batches] or [np.zeros((0, width))])
        if not len(rows):
            return
        extra = np.sqrt(np.maximum(most - (rows * rows).sum(1), 0))
        taken = [0]
        nearest = np.full(len(rows), np.inf)
        while len(taken) < count:
            last = taken[-1]
            apart = ((rows - rows[last]) ** 2).sum(1) + (extra - extra[last]) ** 2
            nearest = np.minimum(nearest, apart)
            far = int(nearest.argmax())
            if nearest[far] <= 0:
                break
            taken.append(far)
        yield pa.RecordBatch.from_pydict({"rows": [rows[taken].tobytes()], "extra": [extra[taken].tobytes()]})

    sample = points.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").coalesce(1)
    found = sample.mapInArrow(run, "rows binary, extra binary").first()
    if found is None:
        return None
    return Pivots(np.frombuffer(found.rows, np.float64).reshape(-1, width), np.frombuffer(found.extra, np.float64), most)


def keyed_by_pivot(points: DataFrame, pivots: Broadcast, width: int) -> DataFrame:
    """``points`` with ``pivot`` (the nearest) and ``distance`` from it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column("v").to_pylist(), width)
                apart = pivots.value.distances(rows, pivots.value.extras(rows))
                near = apart.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(near.astype(np.int32)), pa.array(apart[np.arange(len(near)), near])], [*batch.schema.names, "pivot", "distance"]
                )

    return points.mapInArrow(run, f"id {points.schema['id'].dataType.simpleString()}, v binary, pivot int, distance double")


def least_possible(cells: Cells, apart: np.ndarray) -> np.ndarray:
    """By the triangle inequality, the least distance of a query from any vector of each cell."""
    own = apart[:, cells.pivot]
    return np.maximum(np.maximum(cells.low - own, own - cells.high), 0)


def visits(queries: DataFrame, pivots: Broadcast, cells: Broadcast, width: int, first: bool) -> DataFrame:
    """A row per query and cell chunk to read. In the first round each query takes its nearest cells until they hold
    enough vectors; in the second, those left whose bound its ``worst`` score does not rule out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Cells = cells.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = matrix(part.column("v").to_pylist(), width)
                apart = pivots.value.distances(rows, 0.0)
                bound = least_possible(c, apart)
                order = np.argsort(bound, axis=1, kind="stable")
                before = np.cumsum(c.count[order], axis=1) - c.count[order]
                early = np.zeros(bound.shape, bool)
                np.put_along_axis(early, order, before < FIRST_ROUND, axis=1)
                if first:
                    chosen = early
                else:
                    worst = np.array([np.nan if w is None else float(w) for w in part.column("worst").to_pylist()])
                    reach = np.sqrt(np.maximum((rows * rows).sum(1) + pivots.value.most - 2 * worst, 0)) * (1 + SLACK) + SLACK
                    chosen = ~early & (np.isnan(worst)[:, None] | (bound <= reach[:, None]))
                q, cell = np.nonzero(chosen)
                times = c.chunks[cell]
                q, cell = np.repeat(q, times), np.repeat(cell, times)
                chunk = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
                own = part.take(pa.array(q))
                yield pa.RecordBatch.from_arrays(
                    [own.column("query"), own.column("v"), own.column("worst"), pa.array(cell.astype(np.int32)), pa.array(chunk.astype(np.int32))],
                    ["query", "v", "worst", "cell", "chunk"],
                )

    id_type = queries.schema["query"].dataType.simpleString()
    return queries.mapInArrow(run, f"query {id_type}, v binary, worst bigint, cell int, chunk int")


def best_of_chunks(
    index: DataFrame, visits_: DataFrame, pivots: Broadcast, cells: Broadcast, width: int, k: int, parts: int,
) -> DataFrame:
    """The ``k`` best of each visited chunk for each query: ``query``, ``id``, ``score``. Queries are dealt into
    ``parts``, each with its own copy of the chunks that they visit, so that both sides of a group are bounded.

    A chunk is sorted by distance from its pivot. A query with a worst score reads only the stretch around its
    own distance that the triangle inequality leaves. Products are of whole numbers below 2**53, so they are exact.
    """
    id_type = index.schema["id"].dataType.simpleString()

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        out = {"query": [], "id": [], "score": []}
        if asked.num_rows and held.num_rows:
            held = held.sort_by("distance")
            rows, apart = matrix(held["v"].to_pylist(), width), held["distance"].to_numpy()
            ids = held["id"].to_numpy()
            pivot = cells.value.pivot[key[0].as_py()]
            for at in range(0, asked.num_rows, 256):
                part = asked.slice(at, 256)
                queries = matrix(part["v"].to_pylist(), width)
                own = pivots.value.distances(queries, 0.0)[:, pivot]
                worst = np.array([np.nan if w is None else float(w) for w in part["worst"].to_pylist()])
                reach = np.sqrt(np.maximum((queries * queries).sum(1) + pivots.value.most - 2 * worst, 0)) * (1 + SLACK) + SLACK
                reach = np.where(np.isnan(reach), np.inf, reach)
                lo = np.searchsorted(apart, own - reach, "left")
                hi = np.searchsorted(apart, own + reach, "right")
                low, high = int(lo.min()), int(hi.max())
                scores = exact_products(queries, rows[low:high])
                for i, query in enumerate(part["query"].to_pylist()):
                    s, names = scores[i, lo[i] - low : max(lo[i], hi[i]) - low], ids[lo[i] : max(lo[i], hi[i])]
                    other = names != query
                    s, names = s[other], names[other]
                    if len(s) > k:
                        edge = np.partition(s, -k)[-k]
                        top = np.flatnonzero(s >= edge)
                        s, names = s[top], names[top]
                    best = np.lexsort((names, -s))[:k]
                    out["query"] += [query] * len(best)
                    out["id"] += names[best].tolist()
                    out["score"] += s[best].tolist()
        kind = asked.schema.field("query").type if asked.num_columns else pa.int64()
        return pa.table({"query": pa.array(out["query"], kind), "id": pa.array(out["id"], kind), "score": pa.array(out["score"], pa.int64())})

    blocks = visits_.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
    keys = ["cell", "chunk", "block"]
    # A table between, so that the join has two plain sides.
    spread = index.join(table(blocks.select(*keys).distinct(), "topk-visited"), ["cell", "chunk"])
    return blocks.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(run, f"query {id_type}, id {id_type}, score bigint")


def exact_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    largest = np.sqrt((queries * queries).sum(1).max(initial=0)) * np.sqrt((rows * rows).sum(1).max(initial=0))
    if largest < 2**52:
        return (queries @ rows.T).astype(np.int64)
    if largest >= 2**62:
        raise ValueError("a score is too large for 64 bits")
    return queries.astype(np.int64) @ rows.astype(np.int64).T


def top_k(
    embeddings: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of the highest integer inner product for every query row: ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score``.

    Every component becomes floor(1024 x). Candidates are all rows but those of the query's own id; equal scores
    go to the smaller id. A vector that is null or holds a null or non-finite component, and a row without
    an id, take no part. A shorter vector, also an empty one, counts as filled up with zeros. A query id whose rows hold several
    vectors asks with the smallest one. A component of 2**21 or more in size is an error, as scores would
    not be exact. Fewer candidates than ``k`` give fewer rows.

    1. Of equal vectors only those of the k + 1 smallest distinct ids, and k rows of each, can be among a query's best,
       so the rest leave here: rows of one id and vector are counted with map-side combine, ids have a limit on the map side.
    2. Vectors are keyed by nearest pivot and distance, cut into annuli and chunks of bounded size.
    3. Each query reads its nearest annuli until they hold enough vectors, which gives it a k-th best score.
    4. It then reads the annuli, and in them the stretch of distances, that by the triangle inequality can still
       hold a better or equal one. Results are exact.
    """
    spark = embeddings.sparkSession
    rows = table(quantised(embeddings, id_column, vector_column), "topk-rows")
    copies = Window.partitionBy("v").orderBy("id")
    held = rows.groupBy("id", "v").agg(F.count("*").alias("_times")).withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1)
    points = held.select("id", "v", F.explode(F.sequence(F.lit(1), F.least("_times", F.lit(k)).cast("int")))).drop("col")
    shape = rows.agg(F.max(F.octet_length("v")).alias("w"), F.count("*").alias("n")).first()
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not shape.n:
        return spark.createDataFrame([], result)
    width = max(1, shape.w // 8)

    def squares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = (matrix(batch.column(0).to_pylist(), width) ** 2).sum(1)
            yield pa.RecordBatch.from_pydict({"s": [float(got.max(initial=0))]})

    most = rows.select("v").mapInArrow(squares, "s double").agg(F.max("s")).first()[0]
    count = min(MOST_PIVOTS, max(LEAST_PIVOTS, shape.n // PER_PIVOT))
    pivots = spark.sparkContext.broadcast(choose_pivots(rows, width, most, count))
    keyed = table(keyed_by_pivot(points, pivots, width), "topk-keyed")
    # Annuli of equal width between a pivot's nearest and farthest vector; one row per annulus reaches the driver.
    rings = keyed.groupBy("pivot").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"))
    ring = F.least(F.floor((F.col("distance") - F.col("lo")) * ANNULI / (F.col("hi") - F.col("lo") + 1e-9)), F.lit(ANNULI - 1))
    celled = keyed.join(F.broadcast(rings), "pivot").withColumn("cell", (F.col("pivot") * ANNULI + ring).cast("int")).drop("lo", "hi")
    held = celled.groupBy("cell").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"), F.count("*").alias("n")).collect()
    size = len(pivots.value.rows) * ANNULI
    c = Cells(np.arange(size) // ANNULI, np.full(size, np.inf), np.full(size, np.inf), np.zeros(size, np.int64), np.zeros(size, np.int64))
    for row in held:
        c.low[row.cell], c.high[row.cell], c.count[row.cell], c.chunks[row.cell] = row.lo, row.hi, row.n, -(-row.n // CHUNK)
    cells = spark.sparkContext.broadcast(c)
    chunks = F.create_map(*[F.lit(int(x)) for i in np.flatnonzero(c.count) for x in (i, c.chunks[i])])
    index = celled.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks[F.col("cell")]).cast("int")).select("id", "v", "distance", "cell", "chunk")

    queries = rows.where(is_query).groupBy(F.col("id").alias("query")).agg(F.min("v").alias("v"))
    asked = table(queries.withColumn("worst", F.lit(None).cast("bigint")), "topk-queries")
    drop_table(rows)
    parts = max(1, -(-asked.count() // CHUNK))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    early = table(ranked(best_of_chunks(index, visits(asked, pivots, cells, width, True), pivots, cells, width, k, parts)), "topk-first")
    kth = early.where(F.col("rank") == k).select("query", F.col("score").alias("worst"))
    again = asked.drop("worst").join(kth, "query", "left")
    late = best_of_chunks(index, visits(again, pivots, cells, width, False), pivots, cells, width, k, parts)
    both = ranked(early.drop("rank").unionByName(late))
    return both.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
