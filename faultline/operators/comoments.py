"""Centred second moments of all pairs of columns, each over rows where both are present.

Blocks of rows become matrices of counts, means and centred products, by matrix products;
the matrices of two blocks merge exactly (Chan, Golub and LeVeque). So one scan serves any
number of columns, and a large common mean costs no digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts in which what the scan's tasks found of one column is merged first.
MERGES = 64
#: Sums that cancel below this share of their terms are computed again around their own mean.
CANCELLED = 1e-6
FIELDS = ("n", "endless", "mean_x", "mean_y", "m_xx", "m_yy", "m_xy")


def co_moments(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """(x, y, n, endless, mean_x, mean_y, m_xx, m_yy, m_xy) per ordered pair of `values`.

    x and y are places in `values`, which are doubles; NULL and NaN are missing. n rows have
    both, `endless` of them with an infinity; if there are any, the other figures say nothing.
    Centred sums of a constant are exactly 0. An empty table has no rows.
    """
    size = len(values)
    # All that the workers run is inside this function, so they need not have the package.
    cancelled, kinds = CANCELLED, len(FIELDS)

    def measured(x: np.ndarray) -> np.ndarray:
        """The figures of a block of rows, kinds x size x size."""
        present, finite = ~np.isnan(x), np.isfinite(x)
        low = np.where(finite, x, np.inf).min(axis=0)
        high = np.where(finite, x, -np.inf).max(axis=0)
        known = np.where(finite, x, 0.0)
        centre = np.where(low == high, low, known.sum(axis=0) / np.maximum(finite.sum(axis=0), 1))
        away = np.where(finite, known - centre, 0.0)
        there = present.astype(float)
        n = there.T @ there
        some = np.maximum(n, 1)
        sums, squares = away.T @ there, (away * away).T @ there
        infinite = (present & ~finite).astype(float)
        endless = infinite.T @ there
        endless = endless + endless.T - infinite.T @ infinite
        m_xx = squares - sums * sums / some
        mean = centre[:, None] + sums / some
        m_xy = away.T @ away - sums * sums.T / some
        again = (squares > 0) & (m_xx <= cancelled * squares)
        for a, b in zip(*np.nonzero(np.triu(again | again.T)), strict=True):
            both = finite[:, a] & finite[:, b]
            if both.any():
                own = [x[both, i] for i in (a, b)]
                means = [v[0] if v.min() == v.max() else v.mean() for v in own]
                left, right = (v - m for v, m in zip(own, means, strict=True))
                mean[a, b], mean[b, a] = means
                m_xx[a, b], m_xx[b, a] = left @ left, right @ right
                m_xy[a, b] = m_xy[b, a] = left @ right
        return np.stack([n, endless, mean, mean.T, m_xx, m_xx.T, m_xy])

    def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        n = one[0] + other[0]
        share = other[0] / np.maximum(n, 1)
        dx, dy = other[2] - one[2], other[3] - one[3]
        weight = one[0] * share
        return np.stack(
            [
                n,
                one[1] + other[1],
                one[2] + dx * share,
                one[3] + dy * share,
                one[4] + other[4] + dx * dx * weight,
                one[5] + other[5] + dy * dy * weight,
                one[6] + other[6] + dx * dy * weight,
            ]
        )

    def rows(figures: dict[int, np.ndarray], task: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(figures), pa.int32()),
                pa.array([task] * len(figures), pa.int32()),
                pa.array([f.tobytes() for f in figures.values()], pa.binary()),
            ],
            names=["x", "task", "figures"],
        )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        with np.errstate(all="ignore"):
            for batch in batches:
                if batch.num_rows:
                    block = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
                    found = measured(np.column_stack(block))
                    total = found if total is None else merge(total, found)
        if total is not None:
            own = {i: np.ascontiguousarray(total[:, i]) for i in range(size)}
            yield rows(own, TaskContext.get().partitionId())

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        with np.errstate(all="ignore"):
            for batch in batches:
                columns = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "figures"))
                for x, raw in zip(*(c.to_pylist() for c in columns), strict=True):
                    found = np.frombuffer(raw).reshape(kinds, size)
                    held[x] = merge(held[x], found) if x in held else found
        if held:
            yield rows(held, 0)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merged(batches):
            for x, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = np.frombuffer(raw).reshape(kinds, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x] * size, pa.int32()),
                        pa.array(range(size), pa.int32()),
                        *(pa.array(f.astype(np.int64)) for f in found[:2]),
                        *(pa.array(np.ascontiguousarray(f)) for f in found[2:]),
                    ],
                    names=names,
                )

    names = ["x", "y", *FIELDS]
    passed = "x int, task int, figures binary"
    plain = df.select(*[v.cast("double").alias(f"_v{i}") for i, v in enumerate(values)])
    found = plain.mapInArrow(scanned, passed)
    # What many tasks found of one column is merged in MERGES parts, then as a whole.
    parts = found.repartition("x", F.col("task") % MERGES).mapInArrow(merged, passed)
    kinds_of = [f"{f} long" for f in FIELDS[:2]] + [f"{f} double" for f in FIELDS[2:]]
    return parts.repartition("x").mapInArrow(told, ", ".join(["x int", "y int", *kinds_of]))
