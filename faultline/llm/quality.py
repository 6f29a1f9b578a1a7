"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a vector of document statistics. Random Fourier features of the
standardised vector stand for a Gaussian kernel; the ridge solution comes from normal
equations that every partition sums on its own. Isotonic regression over bounded bins of the
raw scores then turns a score into the share of good documents among its like.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.shipping import send_code
from faultline.llm.text import ALNUM, LOWER, SPACES, blocks, word_hashes, word_limits

#: Random features, kernel width in standard deviations, ridge penalty per row.
FEATURES, WIDTH, PENALTY = 256, 4.0, 1e-3
#: Bins of raw scores that the calibration is fitted on; a bound of the model's size.
BINS = 1000
#: Labelled rows the model is fitted on, at most about; fewer are used whole.
TRAIN_ROWS = 50_000
#: Rows of statistics that one task sums into the normal equations, at least.
ROWS_PER_TASK = 10_000
#: Bytes at whose multiples a long text is cut for the compression ratio.
ZIP_BYTES = 1 << 16

_CLASSES = np.zeros(256, dtype=np.int64)
for _number, _bytes in enumerate(
    (range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), [0x20], [0x0A], range(0x80, 0x100)), 1
):
    _CLASSES[list(_bytes)] = _number
for _number, _letter in enumerate(".,!?|%$#&*<>/:@_-", 7):
    _CLASSES[ord(_letter)] = _number
KINDS = 24
STATISTICS = KINDS + 12


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS numbers per text, over whole texts; zeros without a byte."""
    rows = []
    for _, raw, limits in blocks(column):
        sizes = np.diff(limits)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        kinds = np.bincount(owner * KINDS + _CLASSES[raw], minlength=len(sizes) * KINDS)
        out = np.zeros((len(sizes), STATISTICS))
        part = np.maximum(sizes, 1)[:, None]
        out[:, :KINDS] = np.sqrt(kinds.reshape(-1, KINDS) / part)
        data = LOWER[raw]
        starts, ends, cut = word_limits(~SPACES[data], limits)
        words = word_hashes(data, starts, ends)
        lengths = (ends - starts).astype(float)
        begins, stops, lines = word_limits(raw != 0x0A, limits)
        line_hashes = word_hashes(raw, begins, stops)
        alnum, _, cut_alnum = word_limits(ALNUM[data], limits)
        capital = np.add.reduceat(
            np.concatenate([(raw >= 0x41) & (raw < 0x5B), [False]]).astype(np.int64),
            np.concatenate([starts, [len(raw)]]),
        )[: len(starts)] if len(starts) else np.zeros(0, np.int64)
        for i in range(len(sizes)):
            own = words[cut[i] : cut[i + 1]]
            if not len(own):
                continue
            long = lengths[cut[i] : cut[i + 1]]
            line = line_hashes[lines[i] : lines[i + 1]]
            text = raw[limits[i] : limits[i + 1]].tobytes()
            packed = sum(
                len(zlib.compress(text[at : at + ZIP_BYTES], 1))
                for at in range(0, len(text), ZIP_BYTES)
            )
            pairs = own[1:] * np.uint64(3) + own[:-1]
            out[i, KINDS:] = (
                np.log1p(len(own)),
                np.log1p(len(text)),
                long.mean(),
                long.std(),
                np.log1p(long.max()),
                len(np.unique(own)) / len(own) ** 0.8,
                len(np.unique(line)) / max(len(line), 1),
                np.log1p(len(line)),
                len(np.unique(pairs)) / max(len(pairs), 1),
                packed / len(text),
                (capital[cut[i] : cut[i + 1]] >= np.maximum(long - 4, 2)).mean(),
                (cut_alnum[i + 1] - cut_alnum[i]) / len(own),
            )
        rows.append(out)
    return np.concatenate(rows) if rows else np.zeros((0, STATISTICS))


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    features: int
    width: float
    seed: int

    def raw(self, stats: np.ndarray) -> np.ndarray:
        z = fourier((stats - self.mean) / self.scale, self.features, self.width, self.seed)
        return z @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def fourier(x: np.ndarray, features: int, width: float, seed: int) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, with a constant and the values themselves."""
    draw = np.random.default_rng(seed)
    w = draw.normal(size=(x.shape[1], features)) / width / np.sqrt(x.shape[1])
    shift = draw.uniform(0, 2 * np.pi, features)
    x = np.clip(x, -6.0, 6.0)
    return np.concatenate(
        [np.sqrt(2 / features) * np.cos(x @ w + shift), x / 10, np.ones((len(x), 1))], axis=1
    )


def _summed(rows: DataFrame, cells) -> np.ndarray:
    """Sum over all rows of the vectors that cells(batch) gives, one row per partition."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = cells(batch)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total))), pa.array(total)], names=["i", "x"]
            )

    sums = rows.mapInArrow(partial, "i long, x double").groupBy("i").agg(F.sum("x").alias("x"))
    found = sums.toPandas().sort_values("i")  # as long as the model, whatever the rows
    return found["x"].to_numpy(dtype=float)


def isotonic(order: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing values fitted to bins by pooling adjacent violators."""
    pools: list[list[float]] = []
    for x, g, n in zip(order, good, count, strict=True):
        pools.append([x * n, g, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    table = np.array(pools)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    *,
    train_rows: int = TRAIN_ROWS,
    features: int = FEATURES,
    width: float = WIDTH,
    penalty: float = PENALTY,
    seed: int = 13,
) -> QualityModel | None:
    """Fits on the rows of `docs` with a 0/1 label; None without any labelled row.

    Beyond `train_rows` labelled keys a hash sample of about that many is used. A key that
    `labels` repeats has the mean of its labels; other labels than 0 and 1 do not count.
    """
    send_code(docs.sparkSession)
    wanted = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).cast("double").alias("y")
    )
    wanted = settle(wanted.groupBy("key").agg(F.avg("y").alias("y")))
    total = wanted.count()
    if total > train_rows:
        draw = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30))
        wanted = wanted.where(draw < F.lit(int((1 << 30) * train_rows / total)))
    # About `train_rows` keys at most, so the texts need not be shuffled.
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    joined = texts.join(F.broadcast(wanted), "key")

    def measure(batches):
        for batch in batches:
            stats = statistics(batch.column(0))
            values = pa.array(list(stats), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column(1)], names=["x", "y"])

    rows = settle(joined.select("text", "y").mapInArrow(measure, "x array<double>, y double"))
    rows = rows.coalesce(max(1, -(-min(total, train_rows) // ROWS_PER_TASK)))

    def table(batch):
        x = batch.column(0).flatten().to_numpy().reshape(-1, STATISTICS)
        return x, batch.column(1).to_numpy()

    def moments(batch):
        x, y = table(batch)
        return np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)])

    found = _summed(rows, moments)
    if not len(found) or not found[0]:
        return None
    count = found[0]
    mean = found[1 : 1 + STATISTICS] / count
    scale = np.sqrt(np.maximum(found[1 + STATISTICS :] / count - mean**2, 0))
    scale[scale < 1e-9] = 1.0

    def equations(batch):
        x, y = table(batch)
        z = fourier((x - mean) / scale, features, width, seed)
        return np.concatenate([(z.T @ z)[upper], z.T @ y])

    size = features + STATISTICS + 1
    upper = np.triu_indices(size)
    found = _summed(rows, equations)
    normal = np.zeros((size, size))
    normal[upper] = found[: len(upper[0])]
    normal = np.triu(normal) + np.triu(normal, 1).T + penalty * count * np.eye(size) / features
    weights = np.linalg.solve(normal, found[len(upper[0]) :])
    model = QualityModel(
        mean, scale, weights, np.zeros(1), np.zeros(1), features, width, seed
    )

    def binned(batch):
        x, y = table(batch)
        place = np.clip((model.raw(x) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        return np.concatenate(
            [np.bincount(place, minlength=BINS), np.bincount(place, weights=y, minlength=BINS)]
        )

    found = _summed(rows, binned)
    held = np.flatnonzero(found[:BINS])
    middles = (held + 0.5) / BINS * 2 - 0.5
    knots, values = isotonic(middles, found[BINS:][held], found[:BINS][held])
    return QualityModel(mean, scale, weights, knots, values, features, width, seed)


def score(
    docs: DataFrame, model: QualityModel | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score) of every row from its whole text; null and empty texts have zeros as statistics.

    Without a model every score is 0.5. Repeated rows are scored one by one; columns other
    than key and text are not read.
    """

    send_code(docs.sparkSession)
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                found = model.score(statistics(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], names=["key", "score"]
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(rate, f"key {kind}, score double").withColumnRenamed("key", key)
