"""Lists of distinct scores with their counts: packed rows for exact ranks of very many scores.

A list holds the distinct scores of some rows of a group, from high to low, with positives and
negatives of each, as bytes. All functions here run in the tasks.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

#: Rows that a task gathers before it packs them.
LISTED_ROWS = 1_000_000


def counted(scores: np.ndarray, positives: np.ndarray, negatives: np.ndarray):
    """Each score once, falling, with its sums."""
    order = np.argsort(-scores)
    scores = scores[order]
    first = np.flatnonzero(np.concatenate([[True], scores[1:] != scores[:-1]])[: len(scores)])
    return scores[first], np.add.reduceat(positives[order], first), np.add.reduceat(negatives[order], first)


def _bytes(numbers: np.ndarray) -> bytes:
    """The numbers in the narrowest of two types, which the length tells apart."""
    return numbers.astype(np.uint8 if numbers.max() < 256 else np.int64).tobytes()


def _unpacked(scores: bytes, *counts: bytes) -> list[np.ndarray]:
    held = np.frombuffer(scores)
    return [held, *[np.frombuffer(c, np.uint8 if len(c) == len(held) else np.int64).astype(np.int64) for c in counts]]


def _rows(batch: pa.RecordBatch, keys: int):
    """(key, scores, positives, negatives) of each list."""
    for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
        yield row[:keys], *_unpacked(*row[-3:])


def _batch(rows: list[tuple], types: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])


def _named(batch: pa.RecordBatch, keys: int, *names: str) -> pa.RecordBatch:
    return batch.rename_columns([f"_g{i}" for i in range(keys)] + list(names))


def listed(batches, keys: int):
    """Lists of the rows of a task; columns are the keys, score and label."""
    held: dict[tuple, list] = {}
    types, size = [], 0

    def lists():
        rows = []
        for key, parts in held.items():
            p, y = (np.concatenate(one) for one in zip(*parts, strict=True))
            found = counted(p, y, 1 - y)
            rows.append((*key, found[0].tobytes(), _bytes(found[1]), _bytes(found[2])))
        return _named(_batch(rows, [*types, *[pa.binary()] * 3]), keys, "scores", "positives", "negatives")

    for batch in batches:
        if not batch.num_rows:
            continue
        types = [c.type for c in batch.columns[:keys]]
        group, values = np.zeros(batch.num_rows, np.int64), []
        for column in batch.columns[:keys]:
            coded = column.dictionary_encode(null_encoding="encode")
            values.append(coded.dictionary.to_pylist())
            group = group * len(values[-1]) + coded.indices.to_numpy(zero_copy_only=False)
        # -0.0 and 0.0 are one score.
        p = batch.column(keys).to_numpy(zero_copy_only=False) + 0.0
        y = batch.column(keys + 1).to_numpy(zero_copy_only=False)
        order = np.argsort(group, kind="stable")
        group = group[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        for start, end in zip(starts, [*starts[1:], len(group)], strict=True):
            key, code = [], int(group[start])
            for one in reversed(values):
                code, place = divmod(code, len(one))
                key.append(one[place])
            rows = order[start:end]
            held.setdefault(tuple(reversed(key)), []).append((p[rows], y[rows]))
        size += batch.num_rows
        if size >= LISTED_ROWS:
            yield lists()
            held, size = {}, 0
    if held:
        yield lists()


def sampled(batches, keys: int, steps: dict[tuple, int]):
    """Every so manieth score of each list, and how many it stands for."""
    for batch in batches:
        types = [*[c.type for c in batch.columns[:keys]], pa.float64(), pa.int64()]
        rows = []
        for key, scores, _, _ in _rows(batch, keys):
            step = steps[key]
            for start in range(0, len(scores), step):
                part = scores[start : start + step]
                rows.append((*key, float(part[len(part) // 2]), len(part)))
        yield _named(_batch(rows, types), keys, "_score", "_n")


def _cuts(scores: np.ndarray, bounds: list[float]) -> np.ndarray:
    """The first place of each range, from the highest range down; the scores are falling."""
    return len(scores) - np.searchsorted(scores[::-1], bounds[::-1], side="left")


def _ranges(scores: np.ndarray, bounds: list[float]):
    """(range, slice): range k holds scores from bound k on, below bound k + 1."""
    ends = [0, *_cuts(scores, bounds).tolist(), len(scores)]
    for i, (start, end) in enumerate(zip(ends, ends[1:], strict=False)):
        if end > start:
            yield len(bounds) - i, slice(start, end)


def range_sizes(batches, keys: int, bounds: dict[tuple, list[float]]):
    for batch in batches:
        types = [*[c.type for c in batch.columns[:keys]], *[pa.int64()] * 3]
        rows = [
            (*key, place, int(positives[part].sum()), int(negatives[part].sum()))
            for key, scores, positives, negatives in _rows(batch, keys)
            for place, part in _ranges(scores, bounds.get(key, []))
        ]
        yield _named(_batch(rows, types), keys, "_range", "_positives", "_negatives")


def pieces(batches, keys: int, bounds: dict[tuple, list[float]]):
    for batch in batches:
        types = [*[c.type for c in batch.columns[:keys]], pa.int64(), *[pa.binary()] * 3]
        rows = [
            (*key, place, scores[part].tobytes(), _bytes(positives[part]), _bytes(negatives[part]))
            for key, scores, positives, negatives in _rows(batch, keys)
            for place, part in _ranges(scores, bounds.get(key, []))
        ]
        yield _named(_batch(rows, types), keys, "_range", "scores", "positives", "negatives")


def ranked(key: tuple, table: pa.Table, keys: int, before: dict[tuple, tuple[int, int]]) -> pa.Table:
    """The sums over one range from which AUC and average precision are made."""
    values = tuple(k.as_py() for k in key)
    parts = [row for batch in table.select(["scores", "positives", "negatives"]).to_batches() for row in _rows(batch, 0)]
    _, *held = zip(*parts, strict=True)
    _, p, n = counted(*[np.concatenate(one) for one in held])
    p_before, n_before = before[values]
    tp, fp = p_before + p.cumsum(), n_before + n.cumsum()
    pairs, steps = float((n * (tp - p + p / 2)).sum()), float((p * (tp / (tp + fp))).sum())
    types = [*[k.type for k in key[:keys]], pa.float64(), pa.float64()]
    return pa.Table.from_batches([_named(_batch([(*values[:keys], pairs, steps)], types), keys, "_pairs", "_steps")])


# Workers need not have this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
