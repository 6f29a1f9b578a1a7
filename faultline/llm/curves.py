"""Approximate nearest neighbours on shifted Hilbert curves.

Vectors are rotated, a few coordinates of each rotation are shifted and laid on a grid, and
the cells are numbered along a Hilbert curve. Spark range-partitions the rows of all curves by
these numbers, which gives every vector a rank on every curve. A query looks at the vectors
whose rank on a curve differs by at most a window; the windows of all curves are merged
and reranked by exact distance.

The window is not guessed: the true neighbours of a bounded sample of queries are
found by comparing these with all vectors, and the window is set so that the wanted share of
them lies within it on at least one curve. On data without structure this makes the
window a share of the table, as it must be for that recall.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.shipping import send_code
from faultline.llm.vectors import answers, distinct_vectors, finite, matrix, most_common_length

CURVES, AXES, BITS = 32, 8, 3
#: Share of the sample's true neighbours that the windows have to hold.
WANTED = 0.95
#: Queries in the sample that sets the window, at most about.
SAMPLE = 256
#: Ranks per task group of the search; a query visits every group its window touches.
GROUP = 2048


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of grid cells (rows of coordinates below 2^bits) along the Hilbert curve."""
    x = [c.astype(np.int64) for c in cells.T]
    axes = len(x)
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(axes):
            high = (x[i] & step) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        step >>= 1
    for i in range(1, axes):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    step = 1 << (bits - 1)
    while step > 1:
        turn = np.where((x[axes - 1] & step) != 0, turn ^ (step - 1), turn)
        step >>= 1
    number = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            number = (number << 1) | (((x[i] ^ turn) >> bit) & 1)
    return number


@dataclass(frozen=True)
class Curves:
    """Rotations, shifts and scales of all curves for vectors of one length."""

    mean: np.ndarray
    axes: list[np.ndarray]
    scale: list[np.ndarray]
    shift: list[np.ndarray]
    bits: int

    def numbers(self, x: np.ndarray) -> np.ndarray:
        """Curve number of every vector on every curve."""
        x = x - self.mean
        out = np.empty((len(x), len(self.axes)), np.int64)
        for c, (axes, scale, shift) in enumerate(zip(self.axes, self.scale, self.shift, strict=True)):
            # Six standard deviations span the grid; the shift moves its lines.
            place = (x @ axes) / scale / 6 + 0.5 + shift
            cells = np.clip(place * (1 << self.bits), 0, (1 << self.bits) - 1).astype(np.int64)
            out[:, c] = hilbert(cells, self.bits)
        return out


def _moments(points: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance over all vectors, summed on the executors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimensions + 1, dimensions + 1))
        for batch in batches:
            x = matrix(batch.column(0), dimensions)
            x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            total += x.T @ x
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat))), pa.array(flat)], names=["i", "x"])

    sums = points.select("vector").mapInArrow(partial, "i long, x double").groupBy("i").agg(F.sum("x"))
    cells = sums.toPandas().sort_values("i").iloc[:, 1].to_numpy()
    if not len(cells):  # no vector at all
        return np.zeros(dimensions), np.eye(dimensions)
    cells = cells.reshape(dimensions + 1, dimensions + 1)
    n = max(cells[-1, -1], 1.0)
    mean = cells[-1, :-1] / n
    return mean, cells[:-1, :-1] / n - np.outer(mean, mean)


def fit(points: DataFrame, dimensions: int, curves: int, axes: int, bits: int, seed: int) -> Curves:
    mean, spread = _moments(points, dimensions)
    draw = np.random.default_rng(seed)
    axes = min(axes, dimensions)
    turns, scales, shifts = [], [], []
    rotation, used = None, dimensions
    for _ in range(curves):
        if used + axes > dimensions:  # each rotation serves as many curves as it has axes for
            rotation, used = np.linalg.qr(draw.normal(size=(dimensions, dimensions)))[0], 0
        own = rotation[:, used : used + axes]
        used += axes
        turns.append(own)
        scales.append(np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", own, spread, own), 1e-24)))
        shifts.append(draw.uniform(-0.5, 0.5, axes) / (1 << bits))
    return Curves(mean, turns, scales, shifts, bits)


def _ranks(points: DataFrame, model: Curves, dimensions: int) -> DataFrame:
    """(curve, rank, rep, asked, vector) for every vector on every curve; ranks from 0."""
    count = len(model.axes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.numbers(matrix(batch.column(1), dimensions))
            for c in range(count):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(batch.num_rows, c)),
                        pa.array(found[:, c]),
                        batch.column(0),
                        batch.column(2),
                        batch.column(1),
                    ],
                    names=["curve", "number", "rep", "asked", "vector"],
                )

    kind = points.schema["vector"].dataType.simpleString()
    numbered = points.select("rep", "vector", "asked").mapInArrow(
        number, f"curve long, number long, rep long, asked boolean, vector {kind}"
    )
    # Position in a range partition, then the rows of the curve in partitions before it.
    placed = settle(
        numbered.repartitionByRange("curve", "number", "rep")
        .sortWithinPartitions("curve", "number", "rep")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    parts = placed.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("curve").orderBy("part")) - F.col("n")
    # One row per partition and curve that starts or ends in it.
    begins = parts.select("curve", "part", (before - F.col("first")).alias("begin"))
    return placed.join(F.broadcast(begins), ["curve", "part"]).select(
        "curve", (F.col("at") + F.col("begin")).alias("rank"), "rep", "asked", "vector"
    )


def _true_neighbours(points: DataFrame, sample: pd.DataFrame, dimensions: int, k: int) -> DataFrame:
    """(q, rep) of the k nearest vectors of each sampled query, by comparison with all vectors."""
    asked = np.array(sample["vector"].tolist(), dtype=np.float64).reshape(-1, dimensions)
    reps = sample["rep"].to_numpy()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(reps), k), np.inf)
        who = np.full((len(reps), k), -1, np.int64)
        for batch in batches:
            x = matrix(batch.column(1), dimensions)
            own = batch.column(0).to_numpy()
            for at in range(0, len(x), 4096):
                part, ids = x[at : at + 4096], own[at : at + 4096]
                far = (asked**2).sum(axis=1)[:, None] - 2 * asked @ part.T + (part**2).sum(axis=1)
                far[reps[:, None] == ids[None, :]] = np.inf
                far = np.concatenate([best, far], axis=1)
                all_ids = np.concatenate([who, np.broadcast_to(ids, (len(reps), len(ids)))], axis=1)
                order = np.argpartition(far, k - 1, axis=1)[:, :k]
                best = np.take_along_axis(far, order, axis=1)
                who = np.take_along_axis(all_ids, order, axis=1)
        q = np.repeat(reps, k)
        some = np.isfinite(best.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(q[some]), pa.array(who.ravel()[some]), pa.array(best.ravel()[some])],
            names=["q", "rep", "far"],
        )

    found = points.select("rep", "vector").mapInArrow(compare, "q long, rep long, far double")
    place = F.row_number().over(Window.partitionBy("q").orderBy("far", "rep"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("q", "rep")


def _window(ranked: DataFrame, near: DataFrame, wanted: float) -> int:
    """The window that holds the wanted share of true neighbours on one curve at least."""
    slim = ranked.select("curve", "rank", "rep")
    needed = near.select("q").union(near.select("rep")).distinct().withColumnRenamed("q", "rep")
    slim = settle(slim.join(needed, "rep", "left_semi"))
    of_q = slim.select("curve", F.col("rep").alias("q"), F.col("rank").alias("rank_q"))
    apart = (
        near.join(slim, "rep")
        .join(of_q, ["curve", "q"])
        .groupBy("q", "rep")
        .agg(F.min(F.abs(F.col("rank") - F.col("rank_q"))).alias("apart"))
    )
    found = apart.select(F.expr(f"percentile_disc({wanted}) WITHIN GROUP (ORDER BY apart)")).first()
    return int(found[0] or 0)


def nearest(
    vectors: DataFrame,
    queries: str,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    k: int = 10,
    curves: int = CURVES,
    axes: int = AXES,
    bits: int = BITS,
    wanted: float = WANTED,
    sample: int = SAMPLE,
    seed: int = 29,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where `queries` holds.

    Score is the Euclidean distance in double precision; ties go to the smaller key; a query
    is not its own neighbour. Null and zero vectors, those with null or non-finite
    components, those of another length than most, and null keys take no part. Repeated
    rows count once; equal vectors under other keys are all found. Columns other than key,
    vector and those of the condition `queries` are not read.
    """
    send_code(vectors.sparkSession)
    rows = vectors.select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).alias("vector"),
        F.coalesce(F.expr(queries), F.lit(False)).alias("asked"),
    ).where(F.col("id").isNotNull() & finite("vector") & F.exists("vector", lambda x: x != 0))
    dimensions = max(most_common_length(rows), 1)
    rows = rows.where(F.size("vector") == dimensions)
    points, members = distinct_vectors(rows, k + 1)
    model = fit(points, dimensions, curves, axes, bits, seed)
    ranked = settle(_ranks(points, model, dimensions))

    asked = points.where("asked")
    count = asked.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), "rep"), F.lit(1 << 30))
    limit = int((1 << 30) * min(1.0, sample / max(count, 1)))
    chosen = asked.where(draw < limit).select("rep", "vector").toPandas()  # about `sample` rows
    window = _window(ranked, settle(_true_neighbours(points, chosen, dimensions, k)), wanted)

    group = F.floor(F.col("rank") / GROUP)
    visits = F.explode(
        F.sequence(
            F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / GROUP),
            F.floor((F.col("rank") + window) / GROUP),
        )
    )
    held = ranked.select("curve", group.alias("part"), F.lit(False).alias("ask"), "rep", "vector")
    visiting = ranked.where("asked").select("curve", visits.alias("part"), F.lit(True).alias("ask"), "rep", "vector")

    def search(table: pd.DataFrame) -> pd.DataFrame:
        ask = table["ask"].to_numpy()
        reps = table["rep"].to_numpy()
        x = np.array(table["vector"].tolist(), dtype=np.float64).reshape(-1, dimensions)
        own, ids = x[~ask], reps[~ask]
        out = []
        for q, point in zip(reps[ask], x[ask], strict=True):
            if not len(own):
                break
            far = ((own - point) ** 2).sum(axis=1)
            # The query's own vector is found too: it may have other keys.
            best = np.lexsort((ids, far))[: k + 1] if len(far) <= k + 1 else _smallest(far, ids, k + 1)
            out.append(pd.DataFrame({"q": q, "rep": ids[best], "score": np.sqrt(far[best])}))
        if not out:
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "rep": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pd.concat(out)

    found = (
        held.unionByName(visiting)
        .groupBy("curve", "part")
        .applyInPandas(search, "q long, rep long, score double")
        .groupBy("q", "rep")
        .agg(F.min("score").alias("score"))
    )
    place = F.row_number().over(Window.partitionBy("q").orderBy("score", "rep"))
    best = settle(found.withColumn("place", place).where(F.col("place") <= k + 1).drop("place"))
    query_rows = rows.where("asked").select("id", "vector").distinct()
    named = query_rows.join(
        points.where("asked").select("vector", F.col("rep").alias("q")), "vector"
    ).select("id", "q")
    return answers(named, best, members, k, ascending=True)


def _smallest(far: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest distances, ties to smaller ids."""
    limit = np.partition(far, k - 1)[k - 1]
    some = np.flatnonzero(far <= limit)
    return some[np.lexsort((ids[some], far[some]))][:k]
