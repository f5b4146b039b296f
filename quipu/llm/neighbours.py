"""Nearest neighbours by inner product: multiprobe p-stable hashing and exact reranking.

Inner products become distances by one more component: with M the largest norm, x stands
as (x / M, sqrt(1 - |x / M|^2)) and a query as (q / |q|, 0), so a nearer point has the larger
inner product. Each table cuts a few Gaussian projections into slots of width W; the slots
of a point are its bucket. Between a query and a neighbour at distance r each projection
differs by a normal variable of deviation r, so the chance that the neighbour lies in a
perturbed bucket is a product of normal masses. Buckets are visited in the order of that
chance, until what they add up to, over all tables, reaches ``SUCCESS``. Candidates of all
tables are ranked by the exact inner product in double precision.

Every query has a radius of its own. The first buckets are those for the fitted ``r``; the
last of the wanted candidates in them is no nearer than the last true neighbour, so a query
whose last candidate lies beyond ``r`` visits the buckets for that distance too, and one with
too few candidates visits all.

``r`` and ``W`` are fitted on a bounded sample; every row is indexed. A query goes to the
buckets, never to a driver, and a bucket is cut into chunks of at most ``CHUNK`` rows or so,
so no task holds more at once. The queries that visit one chunk are dealt out as well, with
a copy of the chunk for every ``ASKS`` of them. Equal vectors are one point, whose smallest ids suffice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.storage import broadcast_if_short, stage

SAMPLE = 2_000  # vectors that r and W are fitted on, at most
SUCCESS = 0.96
TABLES, HASHES = 2, 3
CHUNK = 4096
ASKS = 1024  # queries that meet a chunk in one task, about
_BUCKET_ROWS = 4096  # rows of a bucket that W aims at
_CHOICES, _VISITS = 1 << 20, 20_000  # slots weighed for one query, and buckets named; beyond that it visits all
_FARTHEST = 2.0  # between two points
_SHARES = 16  # of the buckets, for queries that visit all
_SLOT_BITS = 16
_EXACT = 0.5 * np.vectorize(math.erf)(np.linspace(-8, 8, 16_001) / math.sqrt(2)) + 0.5


def _normal(z: np.ndarray) -> np.ndarray:
    return np.interp(z, np.linspace(-8, 8, 16_001), _EXACT)


@dataclass(frozen=True)
class Index:
    """Projections (dimension + 1 by hashes) and offsets per table, slot width, distance and largest norm."""

    projections: tuple[np.ndarray, ...]
    offsets: tuple[np.ndarray, ...]
    width: float
    distance: float
    norm: float

    def places(self, table: int, points: np.ndarray) -> np.ndarray:
        return (points @ self.projections[table] + self.offsets[table]) / self.width

    def codes(self, slots: np.ndarray) -> np.ndarray:
        limit = 1 << (_SLOT_BITS - 1)
        code = np.zeros(slots.shape[0], np.int64)
        for column in np.clip(slots, -limit, limit - 1).astype(np.int64).T:
            code = (code << _SLOT_BITS) + column + limit
        return code

    def probes(self, table: int, place: np.ndarray, success: float, distance: float | None = None) -> np.ndarray | None:
        """Buckets for one query, most promising first, until the chance of success is reached; None for all there are.

        The chance is that of a neighbour at ``distance``, else at the fitted distance.
        """
        distance = distance or self.distance
        reach = math.ceil(4 * distance / self.width)
        step = np.arange(-reach, reach + 1)
        if len(step) ** len(place) > _CHOICES:
            return None
        home = np.floor(place)
        low = (step[None, :] - (place - home)[:, None]) * self.width / distance
        mass = _normal(low + self.width / distance) - _normal(low)
        chance, slots = np.ones(1), np.zeros((1, 0))
        for i in range(len(place)):
            chance = (chance[:, None] * mass[i][None, :]).ravel()
            slots = np.column_stack((np.repeat(slots, len(step), axis=0), np.tile(home[i] + step, len(slots))))
        best = np.argsort(-chance, kind="stable")
        n = int(np.searchsorted(np.cumsum(chance[best]), success)) + 1
        return self.codes(slots[best[:n]]) if n <= _VISITS else None


def as_points(vectors: np.ndarray, norm: float) -> np.ndarray:
    scaled = vectors / norm
    return np.column_stack((scaled, np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))))


def as_queries(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack((vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros(len(vectors))))


def fit(sample: np.ndarray, rows: int, norm: float, nearest: int, tables: int = TABLES, hashes: int = HASHES, seed: int = 5) -> Index:
    """Distance of the wanted neighbours and slot width, from sampled vectors out of ``rows``."""
    points = as_points(sample, norm)
    asked = as_queries(sample[:200])
    gaps = np.sqrt(np.maximum((asked**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None, :] - 2 * asked @ points.T, 0))
    gaps[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    rank = min(max(math.ceil(nearest * len(sample) / rows), 1), max(len(sample) - 1, 1))
    near = np.sort(gaps, axis=1)[:, rank - 1]
    near = near[np.isfinite(near)]
    distance = max(float(np.quantile(near, 0.75)) if len(near) else 1.0, 1e-3)
    rng = np.random.default_rng(seed)
    projections = tuple(rng.normal(size=(points.shape[1], hashes)) for _ in range(tables))
    shifts = [rng.uniform(size=hashes) for _ in range(tables)]
    index = None
    for times in (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0):
        width = times * distance
        index = Index(projections, tuple(s * width for s in shifts), width, distance, norm)
        used = len(np.unique(index.codes(np.floor(index.places(0, points)))))
        if used <= max(16, rows // _BUCKET_ROWS):
            break
    return index


def _vectors(batch: pa.Array) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)


def _bucketed(rows: DataFrame, index: Index) -> DataFrame:
    """Rows (id, vector) with each one's own bucket per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = as_points(_vectors(batch.column(1)), index.norm)
            for table in range(len(index.projections)):
                codes = index.codes(np.floor(index.places(table, points)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([table] * len(codes), pa.int32()), pa.array(codes, pa.int64())],
                    names=["id", "vector", "table", "bucket"],
                )

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(run, f"id long, vector {kind}, table int, bucket long")


def _visits(rows: DataFrame, index: Index, success: float, sizes: DataFrame) -> DataFrame:
    """Rows (id, vector) with the chunks they visit; with a column ``radius``, those that it adds to the first ones."""
    each = 1 - (1 - success) ** (1 / len(index.projections))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = as_queries(_vectors(batch.column(1)))
            radius = batch.column(2).to_numpy() if batch.num_columns > 2 else None
            for table in range(len(index.projections)):
                codes = []
                for i, place in enumerate(index.places(table, points)):
                    found = index.probes(table, place, each)
                    if radius is not None:
                        more = index.probes(table, place, each, radius[i]) if found is not None else np.zeros(0, np.int64)
                        found = more if found is None or more is None else np.setdiff1d(more, found)
                    codes.append(None if found is None else found.tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([table] * len(codes), pa.int32()), pa.array(codes, pa.list_(pa.int64()))],
                    names=["id", "vector", "table", "buckets"],
                )

    kind = rows.schema["vector"].dataType.simpleString()
    made = stage(rows.mapInArrow(run, f"id long, vector {kind}, table int, buckets array<long>"), "visits")
    named = made.withColumn("bucket", F.explode("buckets")).drop("buckets").join(sizes, ["table", "bucket"])
    # A query that visits all buckets meets them in shares, as all rows have one table.
    shares = made.filter("buckets is null").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1)))).drop("buckets")
    everywhere = shares.join(sizes.withColumn("share", F.pmod(F.xxhash64("bucket"), F.lit(_SHARES)).cast("int")), ["table", "share"]).drop("share")
    found = named.unionByName(everywhere)
    chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    return found.select("table", "bucket", chunk, F.lit(1).alias("asks"), "id", "vector")


def _ranked(keep: int):
    """Sorted rows (table, bucket, chunk, deal, asks, id, vector): per asking row and chunk, its best ``keep`` points."""

    def best(ids, points, asking, vectors):
        scores = vectors @ points.T
        n = min(keep, len(ids))
        out = []
        for q, row in zip(asking, scores):
            edge = np.partition(row, len(row) - n)[len(row) - n]
            chosen = np.flatnonzero(row >= edge)  # ties at the edge included
            chosen = chosen[np.lexsort((ids[chosen], -row[chosen]))][:n]
            out.append((np.full(len(chosen), q), ids[chosen], row[chosen]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], names=["query", "found", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, points = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            vectors = _vectors(batch.column(6))
            marks = np.column_stack(columns[:5]).astype(np.int64)
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for start, end in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(marks)]))):
                mark = tuple(marks[start, :4])
                if mark != key:
                    key, ids, points = mark, [], []
                if not marks[start, 4]:  # points come before the rows that ask
                    ids.append(columns[5][start:end])
                    points.append(vectors[start:end])
                elif ids:
                    ids, points = [np.concatenate(ids)], [np.concatenate(points)]
                    for at in range(start, end, 256):
                        to = min(at + 256, end)
                        yield best(ids[0], points[0], columns[5][at:to], vectors[at:to])

    return run


def _taking_part(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, vector) that can be compared: finite, not zero, with an id, of the commonest length; repeated rows once."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit_rows = rows.filter(F.col(id_col).isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0))
    fit_rows = fit_rows.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector"))
    length = fit_rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fit_rows.filter(F.size("vector") == (length["n"] if length else 0)).distinct()


def search(
    rows: DataFrame,
    asks: Column,
    nearest: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    success: float = SUCCESS,
    chunk: int = CHUNK,
    tables: int = TABLES,
    asks_at_once: int = ASKS,
) -> DataFrame:
    """For each row whose id meets ``asks`` (a condition on ``id``): its ``nearest`` others.

    Rows (query_id, rank from 1, vec_id, score), by falling inner product and, for equal
    ones, rising id. A query's own id is never found; fewer others give fewer rows. Null,
    zero or non-finite vectors, vectors of another length than the commonest and rows
    without an id take no part; repeated rows count once.
    """
    known = stage(_taking_part(rows, id_col, vector_col), "vectors")
    salted = Window.partitionBy("vector", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = known.withColumn("_n", F.row_number().over(salted)).filter(F.col("_n") <= nearest + 1).drop("_n")
    few = few.withColumn("_n", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).filter(F.col("_n") <= nearest + 1)
    points = few.groupBy("vector").agg(F.min("id").alias("point"), F.array_sort(F.collect_list("id")).alias("ids"))  # at most nearest + 1
    points = stage(points, "points")
    norms = points.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("norm"))
    state = norms.first()
    asking = known.filter(asks).select(F.col("id").alias("query_id"), F.col("vector").alias("_vector"))
    asking = asking.join(points.select("vector", "point"), F.col("_vector") == F.col("vector")).select("query_id", "point")
    asking = stage(asking, "queries")
    if not state["n"]:
        return asking.select("query_id", F.lit(1).alias("rank"), F.col("point").alias("vec_id"), F.lit(0.0).alias("score"))
    drawn = points.select("point", "vector").orderBy(F.xxhash64("point"), "point").limit(SAMPLE).collect()
    index = fit(np.array([r["vector"] for r in drawn], float), state["n"], state["norm"], nearest, tables)

    placed = stage(_bucketed(points.select(F.col("point").alias("id"), "vector"), index), "buckets")
    sizes = placed.groupBy("table", "bucket").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    sizes = broadcast_if_short(stage(sizes, "bucket_sizes"))
    stored = placed.join(sizes, ["table", "bucket"]).select(
        "table", "bucket", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("asks"), "id", "vector"
    )
    wanted = asking.select("point").distinct().join(points.select("point", "vector"), "point").withColumnRenamed("point", "id")

    def met(visits: DataFrame) -> DataFrame:
        visits = stage(visits, "asks")
        place = ["table", "bucket", "chunk"]
        deals = visits.groupBy(*place).agg(F.ceil(F.count("*") / asks_at_once).cast("int").alias("deals"))
        deals = broadcast_if_short(stage(deals, "deals"))
        copies = stored.join(deals, place).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
        dealt = visits.join(deals, place).withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals")).cast("int")).drop("deals")
        columns = [*place, "deal", "asks", "id", "vector"]
        rows = copies.select(columns).unionByName(dealt.select(columns))
        rows = rows.repartition(*place, "deal").sortWithinPartitions(*place, "deal", "asks", "id")
        return rows.mapInArrow(_ranked(nearest + 1), "query long, found long, score double")

    def best(partial: DataFrame) -> DataFrame:
        partial = partial.groupBy("query", "found").agg(F.max("score").alias("score"))  # tables and rounds may find the same point
        order = Window.partitionBy("query").orderBy(F.desc("score"), "found")
        return partial.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= nearest + 1).select("query", "found", "score")

    wanted = stage(wanted, "wanted")
    top = stage(best(met(_visits(wanted, index, success, sizes))), "first")
    # One more than wanted, as the query itself may be among them.
    last = top.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score") / (length * F.lit(float(state["norm"])))))
    radius = F.when(F.col("n") > nearest, apart).otherwise(F.lit(_FARTHEST))
    far = wanted.join(last, wanted["id"] == last["query"], "left").select("id", "vector", radius.alias("radius"))
    far = stage(far.filter(F.col("radius") > index.distance), "far")
    if not far.isEmpty():
        top = best(top.unionByName(met(_visits(far, index, success, sizes))))
    top = top.join(points.select(F.col("point").alias("found"), "ids"), "found").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = top.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= nearest + 1).select("query", "score", "vec_id")
    lists = stage(top.groupBy("query").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id")).alias("hits")), "hits")
    mine = asking.join(lists, asking["point"] == lists["query"])
    own = F.array_sort(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")))
    ranked = mine.select("query_id", F.posexplode(F.slice(own, 1, nearest)).alias("_rank", "hit"))
    return ranked.select("query_id", (F.col("_rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score"))
