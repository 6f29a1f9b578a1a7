"""Compression of vectors to codes by exact ball k-means on integer parts.

Vectors become integers and are cut into parts; each part position has its own codebook. An
entry and its parts are a ball, whose radius grows at most by the distance its entry moves.
Only entries nearer than twice that radius are its neighbours. A part nearer to its entry than half
the way to the nearest neighbour is in the stable core and is not compared at all; any other
part lies in a ring that names the neighbours it may belong to, in the order of their
distance, and is compared exactly with these. All comparisons are of integers, so ties
are exact and go to the lower index.

The vectors lie in packed blocks in one checkpoint; a round writes only the codes of the blocks,
which the next one joins to them, and adds up one table per task: count, largest
distance and sums of each entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.shipping import send_code
from faultline.llm.vectors import finite, matrix, most_common_length

ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
#: Vectors of a block, at most.
BLOCK = 16_384
#: Integer components stay below this, so that squared distances are exact in doubles.
LARGEST = 1 << 21
#: Rows of one label are spread over so many tasks when its total comes back to them.
SALTS = 16


def cuts(dimensions: int, parts: int) -> list[tuple[int, int]]:
    """Limits of `parts` consecutive parts, equal if the length allows it."""
    return [(dimensions * p // parts, dimensions * (p + 1) // parts) for p in range(parts)]


def nearest_of_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry, the lower index for ties."""
    square = (x**2).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries**2).sum(axis=1)
    best = square.argmin(axis=1)
    return best, square[np.arange(len(x)), best]


class Balls:
    """One codebook with the neighbours of each entry, nearest first."""

    def __init__(self, entries: np.ndarray, radii: np.ndarray):
        self.entries = entries
        norms = (entries**2).sum(axis=1)
        apart = norms[:, None] - 2 * (entries @ entries.T) + norms
        np.fill_diagonal(apart, -1.0)
        self.order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        # Entries farther than twice the radius cannot be nearer to anything in the ball.
        reach = (2 * radii * (1 + 1e-9) + 1e-6) ** 2
        self.neighbours = (self.apart <= reach[:, None]).sum(axis=1)
        self.compared = 0

    def assign(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of parts that had the entries `own`."""
        far = ((x - self.entries[own]) ** 2).sum(axis=1)
        best = own.copy()
        order = np.argsort(own, kind="stable")
        limits = np.searchsorted(own[order], np.arange(len(self.entries) + 1))
        for entry in np.flatnonzero(np.diff(limits)).tolist():
            members = order[limits[entry] : limits[entry + 1]]
            rings = self.apart[entry, : self.neighbours[entry]]
            # The ring of a part: neighbours j with d(entry, j) <= 2 d(part, entry), ties included.
            ring = np.searchsorted(rings, 4 * far[members], side="right")
            width = 1
            while width // 2 < len(rings):
                some = members[(ring > width // 2) & (ring <= width)] if width > 1 else members[ring == 1]
                width, asked = 2 * width, min(width, len(rings))
                if not len(some):
                    continue
                others = self.order[entry, :asked]
                points = self.entries[others]
                square = (x[some] ** 2).sum(axis=1)[:, None] - 2 * (x[some] @ points.T) + (points**2).sum(axis=1)
                self.compared += square.size
                # Integers: the distance first, then the index.
                key = square.astype(np.int64) * len(self.entries) + others
                least = key.min(axis=1)
                key_own = far[some].astype(np.int64) * len(self.entries) + entry
                least = np.minimum(least, key_own)
                best[some] = least % len(self.entries)
                far[some] = least // len(self.entries)
        return best, far


def packed(x: np.ndarray) -> bytes:
    """Integer vectors as 2 or 4 bytes a component, after a byte that says which."""
    size = 2 if np.abs(x).max() < 1 << 15 else 4
    return bytes([size]) + x.astype(f"<i{size}").tobytes()


def unpacked(held: bytes, dimensions: int) -> np.ndarray:
    return np.frombuffer(held, f"<i{held[0]}", offset=1).reshape(-1, dimensions).astype(np.float64)


def _pack(x: np.ndarray, ids, labels, batch: int):
    for at in range(0, len(x), BLOCK):
        part = slice(at, at + BLOCK)
        number = (TaskContext.get().partitionId() << 33) + batch + at // BLOCK
        yield number, packed(x[part]), ids[part], labels[part]


_BLOCKS = pa.schema(
    [("block", pa.int64()), ("x", pa.binary()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64()))]
)


def _blocks(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            if not len(batch):
                continue
            x = np.floor(matrix(batch.column(1), dimensions) * SCALE)
            if np.abs(x).max() >= LARGEST:
                raise ValueError(f"a component of {SCALE} * x is not below {LARGEST}")
            for number, held, ids, labels in _pack(x, batch.column(0), batch.column(2), made):
                made += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([held], pa.binary()),
                        pa.array([ids.to_pylist()], _BLOCKS.field(2).type),
                        pa.array([labels.to_pylist()], _BLOCKS.field(3).type),
                    ],
                    schema=_BLOCKS,
                )

    return run


def _assigner(books: list[np.ndarray], radii: np.ndarray | None, limits, dimensions: int, last: bool):
    """Assigns the blocks; rows with block >= 0 hold codes, one with block -1 the sums of the task."""
    entries = len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = None if radii is None else [Balls(b, r) for b, r in zip(books, radii, strict=True)]
        sums = [np.zeros((entries, 2 + b - a), np.int64) for a, b in limits]
        for batch in batches:
            out_codes, out_far = [], []
            codes = batch.column(2).to_pylist() if balls else [None] * len(batch)
            for vectors, held in zip(batch.column(1).to_pylist(), codes, strict=True):
                x = unpacked(vectors, dimensions)
                known = np.frombuffer(held, np.uint8).reshape(-1, len(limits)) if held is not None else None
                found = np.zeros((len(x), len(limits)), np.uint8)
                error = np.zeros(len(x), np.int64)
                for p, (a, b) in enumerate(limits):
                    part = np.ascontiguousarray(x[:, a:b])
                    if balls is None:
                        best, far = nearest_of_all(part, books[p])
                    else:
                        best, far = balls[p].assign(part, known[:, p].astype(np.int64))
                    found[:, p] = best
                    error += far.astype(np.int64)
                    if not last:
                        sums[p][:, 0] += np.bincount(best, minlength=entries)
                        np.maximum.at(sums[p][:, 1], best, far.astype(np.int64))
                        for j in range(b - a):
                            moved = np.bincount(best, weights=part[:, j], minlength=entries)
                            sums[p][:, 2 + j] += np.rint(moved).astype(np.int64)
                out_codes.append(found.tobytes())
                out_far.append(error.tobytes() if last else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(out_codes, pa.binary()),
                    pa.array(out_far, pa.binary()),
                ],
                names=["block", "codes", "extra"],
            )
        if not last:
            whole = b"".join(s.tobytes() for s in sums)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([-1], pa.int64()),
                    "codes": pa.array([b""], pa.binary()),
                    "extra": pa.array([whole], pa.binary()),
                }
            )

    return run


_SUMS = pa.schema([("part", pa.int64()), ("sums", pa.binary())])


def _added(widths: list[int]):
    """Adds the packed tables of tasks by part; each input row is let go once it is added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                table = np.frombuffer(own, np.int64).reshape(-1, widths[part])
                if part not in total:
                    total[part] = table.copy()
                    continue
                held = total[part]
                held[:, 1] = np.maximum(held[:, 1], table[:, 1])
                held[:, 0] += table[:, 0]
                held[:, 2:] += table[:, 2:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
            schema=_SUMS,
        )

    return run


def _totals(done: DataFrame, limits, entries: int) -> list[np.ndarray]:
    """Sums of all tasks per part: entries * width numbers each, added in two steps."""
    widths = [2 + b - a for a, b in limits]
    sizes = [8 * entries * w for w in widths]
    starts = np.cumsum([0, *sizes[:-1]]).tolist()
    cells = F.array(
        *[
            F.struct(F.lit(p).cast("long").alias("part"), F.expr(f"substring(extra, {at + 1}, {size})").alias("sums"))
            for p, (at, size) in enumerate(zip(starts, sizes, strict=True))
        ]
    )
    add = _added(widths)
    rows = done.where("block = -1").select(F.inline(cells))
    tasks = done.rdd.getNumPartitions()
    if tasks > 64:
        rows = rows.repartition(int(tasks**0.5)).mapInArrow(add, "part long, sums binary")
    found = rows.repartition(1).mapInArrow(add, "part long, sums binary").collect()
    by_part = {r["part"]: np.frombuffer(bytes(r["sums"]), np.int64).reshape(entries, -1) for r in found}
    return [by_part[p] for p in range(len(limits))]


def written(books: list[np.ndarray]) -> str:
    """All integer components by part, entry and place, comma-joined."""
    return ",".join(str(int(v)) for book in books for v in book.ravel())


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """((id, label, code, error) of every vector that takes part, the codebooks).

    code has two hex digits per part, error is the sum of squared integer distances. Vectors that are
    null or empty, hold null or non-finite components, or have another length than most, take no
    part. Part p of d components runs from d * p / 4, rounded down. The codebooks start with
    the vectors of the 256 smallest ids (all, if fewer; null ids last; vectors of the same id in
    the order of their components). Repeated rows count as often as they stand there. An
    unused entry stays. Without a vector the result is empty and the codebooks are.
    Components of 1024 * x have to be below 2^21 in size, else an error is raised. Other
    columns are not read.
    """
    send_code(vectors.sparkSession)
    rows = vectors.select(
        F.col(key).cast("long").alias("id"),
        F.transform(F.col(vector), lambda v: v.cast("double")).alias("vector"),
        F.col(label).cast("long").alias("label"),
    ).where(finite("vector"))
    dimensions = most_common_length(rows)
    kept = rows.where(F.size("vector") == dimensions)
    # Bounded by the number of entries.
    start = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    empty = kept.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    if not start or not dimensions:
        return empty, []
    limits = cuts(dimensions, PARTS)
    seeds = np.floor(np.array([r["vector"] for r in start], np.float64) * SCALE)
    books = [np.ascontiguousarray(seeds[:, a:b]) for a, b in limits]
    made = kept.mapInArrow(
        _blocks(dimensions), "block long, x binary, ids array<long>, labels array<long>"
    )
    blocks = settle(made)
    inputs = blocks.select("block", "x", F.lit(None).cast("binary").alias("codes"))
    radii = None
    codes = None
    for step in range(ROUNDS + 1):
        last = step == ROUNDS
        run = _assigner(books, radii, limits, dimensions, last)
        if codes is not None:
            inputs = blocks.join(codes, "block").select("block", "x", "codes")
        done = settle(inputs.mapInArrow(run, "block long, codes binary, extra binary"))
        codes = done.where("block >= 0").select("block", "codes")
        if last:
            break
        totals = _totals(done, limits, len(seeds))
        following, radii = [], np.zeros((PARTS, len(seeds)))
        for p, table in enumerate(totals):
            n, far, added = table[:, 0], table[:, 1], table[:, 2:]
            means = np.where(n[:, None] > 0, added // np.maximum(n, 1)[:, None], books[p]).astype(np.float64)
            moved = np.sqrt(((means - books[p]) ** 2).sum(axis=1))
            radii[p] = np.where(n > 0, np.sqrt(far.astype(np.float64)) + moved, 0.0)
            following.append(means)
        books = following
    return blocks.select("block", "ids", "labels").join(done, "block").mapInArrow(
        _coded, "id long, label long, code string, error long"
    ), books


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        for ids, labels, codes, extra in zip(
            *[batch.column(names.index(c)).to_pylist() for c in ("ids", "labels", "codes", "extra")], strict=True
        ):
            digits = codes.hex()
            width = 2 * PARTS
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(labels, pa.int64()),
                    pa.array([digits[i : i + width] for i in range(0, len(digits), width)], pa.string()),
                    pa.array(np.frombuffer(extra, np.int64)),
                ],
                names=["id", "label", "code", "error"],
            )


def code_report(vectors: DataFrame, key: str = "vec_id") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every vector that takes part."""
    found, books = compress(vectors, key)
    found = settle(found)
    digest = hashlib.sha256(written(books).encode()).hexdigest()
    # A label may hold a third of all rows: they are added up first, and meet the sum in SALTS tasks.
    named = [F.col("label").isNull().alias("none"), F.coalesce("label", F.lit(0)).alias("name")]
    salt = F.pmod(F.xxhash64("id", "code"), F.lit(SALTS))
    sums = found.groupBy(*named).agg(F.sum("error").alias("label_error"))
    spread = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    rows = found.select(F.col("id").alias(key), "code", "error", *named, salt.alias("salt"))
    return rows.join(spread, ["none", "name", "salt"]).select(
        key, "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
