"""Permutation importance: what average precision loses when one feature is shuffled.

Rows are numbered 0 to n - 1 by a hash of their key: ranks inside hash ranges of bounded
size, plus the sizes of the ranges before. For every (feature, repeat) a keyed Feistel
network with cycle walking is a bijection of these numbers: row ``i`` gives its feature to row
``f(i)``, wherever in the table that is. A task packs what its rows give into one row per block
of receivers, 4 bytes and the value for each gift; a block meets its gifts in one task, which
makes all copies of all features and repeats.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from faultline.functions.arguments import at_least_one
from faultline.functions.columns import col
from faultline.functions.settle import settle
from faultline.operators.metrics import counted_scores, ranking_of_counts
from faultline.spec import SEED

REPEATS = 10
# Rows of one hash range, about, and hex digits of the finest ranges (16^5 sizes of 16 bytes).
RANGE_ROWS, RANGE_DIGITS = 50_000, 5
# Rows of all copies of a block, about, and gifts that a task packs at a time.
COPIED_ROWS, GIFTS = 2**18, 2**19
# The mixing function of a round: two multiplications modulo a prime.
ROUNDS, PRIME, FIRST, SECOND = 6, 2**31 - 1, 1_103_515_245, 1_664_525


def round_keys(feature: str, repeat: int, seed: int) -> list[int]:
    """One key per round, below 2^28."""
    named = (f"{feature}:{seed}:{repeat}:{r}" for r in range(ROUNDS))
    return [int(hashlib.md5(name.encode()).hexdigest()[:7], 16) for name in named]


def sides(n: int) -> tuple[int, int]:
    """The rectangle a x b that holds n numbers, with less than one row of it to spare."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def receivers(ranks: np.ndarray, keys: Sequence[int], n: int) -> np.ndarray:
    """Where each rank's value goes: a bijection of 0 to n - 1 chosen by the keys.

    A number is a cell of the rectangle; each round shifts one coordinate by a mix of the other,
    so a pass is a bijection of the cells. Numbers that leave 0 to n - 1 walk on until they are
    back, which keeps it a bijection of the smaller range.
    """
    a, b = sides(n)

    def passed(x):
        left, right = x // b, x % b
        for r, k in enumerate(keys):
            t = ((right if r % 2 == 0 else left) + k) % PRIME * FIRST % PRIME
            t = (t ^ (t >> 15)) * SECOND % PRIME
            if r % 2 == 0:
                left = (left + t) % a
            else:
                right = (right + t) % b
        return left * b + right

    out = passed(ranks.astype(np.int64))
    while (outside := np.flatnonzero(out >= n)).size:
        out[outside] = passed(out[outside])
    return out


def numbered(df: DataFrame, key: str, n: int) -> DataFrame:
    """The rows with ``_rank``, 0 to n - 1 in order of their keys' hashes; keys are unique."""
    digits = min(RANGE_DIGITS, max(1, math.ceil(math.log(max(n / RANGE_ROWS, 1), 16))))
    hashed = df.withColumn("_hash", F.md5(col(key).cast("string")))
    hashed = hashed.withColumn("_range", F.substring("_hash", 1, digits))
    # At most 16^RANGE_DIGITS rows, whatever the table holds.
    sizes = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_hash", col(key)))
    return (
        hashed.withColumn("_place", inside)
        .join(F.broadcast(starts), "_range")
        .withColumn("_rank", F.col("_start") + F.col("_place") - 1)
        .drop("_hash", "_range", "_place", "_start")
    )


def permuted_copies(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    repeats: int = REPEATS,
    seed: int = SEED,
    keep: Sequence[str] = ("label",),
) -> DataFrame:
    """(key, keep..., feature, repeat, features...) with one feature permuted per copy.

    The untouched rows come along as feature NULL, repeat 0.
    """
    at_least_one(repeats, "repeats")
    at_least_one(len(features), "number of features")
    base = df.select(col(key), *[col(k) for k in keep], *[col(f) for f in features])
    n = df.count()
    keys = [[round_keys(f, r, seed) for r in range(1, repeats + 1)] for f in features]
    copies = len(features) * repeats + 1
    size, batch_rows = max(1, COPIED_ROWS // copies), max(1, GIFTS // copies)
    ranked = numbered(base, key, n).withColumn("_block", F.expr(f"CAST(_rank DIV {size} AS BIGINT)"))
    places = [base.columns.index(f) for f in features]
    types = [base.schema[f].dataType for f in features]
    packed = StructType([StructField("_block", LongType())])
    for i, kind in enumerate(types):
        packed.add(f"t{i}", ArrayType(IntegerType())).add(f"v{i}", ArrayType(kind))

    def give(batches):
        """Per block of receivers, for each feature: (repeat, place in the block) and value of each gift."""
        for table in _gathered(batches, batch_rows):
            ranks = table.column("_rank").to_numpy()
            out, some = [], np.zeros(-(-n // size), bool)
            for i, own in enumerate(keys):
                to = np.concatenate([receivers(ranks, k, n) for k in own])
                block = to // size
                order = np.argsort(block.astype(np.uint16) if len(some) < 2**16 else block, kind="stable")
                counts = np.bincount(block, minlength=len(some))
                some |= counts > 0
                ends = pa.array(np.concatenate([[0], counts.cumsum()]), pa.int32())
                repeat, giver = np.divmod(order, len(ranks))
                place = (repeat * size + to[order] % size).astype(np.int32)
                value = table.column(f"v{i}").combine_chunks().take(pa.array(giver))
                out += [pa.ListArray.from_arrays(ends, pa.array(place)), pa.ListArray.from_arrays(ends, value)]
            names = ["_block", *[f"{c}{i}" for i in range(len(keys)) for c in "tv"]]
            blocks = pa.RecordBatch.from_arrays([pa.array(np.arange(len(some))), *out], names=names)
            yield blocks.filter(pa.array(some))

    kept = len(base.columns) - len(features)
    names = [*base.columns[:kept], "feature", "repeat", *features]

    def copied(rows: list, feature: str | None, repeat: np.ndarray) -> pa.Table:
        which = pa.array([feature], pa.string()).take(pa.array(np.zeros(len(repeat), np.int64)))
        return pa.Table.from_arrays([*rows[:kept], which, pa.array(repeat, pa.int32()), *rows[kept:]], names=names)

    def meet(own: pa.Table, gifts: pa.Table) -> pa.Table:
        """All copies of the rows of one block."""
        at = np.full(size, -1)
        at[own.column("_rank").to_numpy() % size] = np.arange(own.num_rows)
        rows = [own.column(i).combine_chunks() for i in range(len(base_columns))]
        found = [copied(rows, None, np.zeros(own.num_rows))]
        for i, feature in enumerate(features if gifts.num_rows else ()):
            repeat, place = np.divmod(gifts.column(f"t{i}").combine_chunks().flatten().to_numpy(), size)
            value = gifts.column(f"v{i}").combine_chunks().flatten()
            receiver = at[place]
            there = receiver >= 0
            if not there.all():
                repeat, receiver, value = repeat[there], receiver[there], value.filter(pa.array(there))
            taken = [one.take(pa.array(receiver)) if j != places[i] else value for j, one in enumerate(rows)]
            found.append(copied(taken, feature, repeat + 1))
        return pa.concat_tables(found)

    base_columns = base.columns
    schema = StructType(
        [*base.schema.fields[:kept], StructField("feature", StringType()), StructField("repeat", IntegerType())]
        + base.schema.fields[kept:]
    )
    giving = ranked.select("_rank", *[col(f).alias(f"v{i}") for i, f in enumerate(features)]).mapInArrow(give, packed)
    rows = ranked.select(*[col(c) for c in base_columns], "_rank", "_block")
    return rows.groupBy("_block").cogroup(giving.groupBy("_block")).applyInArrow(meet, schema)


def _gathered(batches, rows: int):
    """Tables of at least so many rows, but for the last."""
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            held.append(part)
            size += part.num_rows
            if size >= rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def permutation_importance(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    repeats: int = REPEATS,
    seed: int = SEED,
    label: str = "label",
) -> DataFrame:
    """(feature, importance_mean, importance_std): baseline AP minus AP when shuffled.

    ``score`` adds ``probability`` to a frame of raw features, as a fitted pipeline
    does. The standard deviation over repeats is the population one.
    """
    copies = permuted_copies(df, key, features, repeats, seed, (label,))
    scored = score(copies).select("feature", "repeat", col(label).alias("label"), "probability")
    # Copies are counted by score, in packed lists, before anything is written.
    counts = settle(counted_scores(scored, "label", "probability", ("feature", "repeat")))
    # features x repeats + 1 rows from here on.
    each = ranking_of_counts(counts, ("feature", "repeat"))
    whole = Window.partitionBy()
    baseline = F.max(F.when(F.col("feature").isNull(), F.col("average_precision"))).over(whole)
    return (
        each.withColumn("_drop", baseline - F.col("average_precision"))
        .where(F.col("feature").isNotNull())
        .groupBy("feature")
        .agg(
            F.avg("_drop").alias("importance_mean"),
            F.stddev_pop("_drop").alias("importance_std"),
        )
    )


def rank_importance(importance: DataFrame) -> DataFrame:
    """(rank, feature, importance_mean, importance_std): largest mean first, then name."""
    # One row per feature.
    order = Window.partitionBy().orderBy(F.desc("importance_mean"), F.asc("feature"))
    return importance.select(
        F.row_number().over(order).alias("rank"),
        "feature",
        "importance_mean",
        "importance_std",
    )


# Workers need not have this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
