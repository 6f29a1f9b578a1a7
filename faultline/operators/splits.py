"""Exact, repeatable, stratified split into train, validation and test.

Within each class, rows are ordered by a hash of key and seed; the first n_test of them
are test, the next n_validation validation. The split is fitted once: bucket counts find
where the two cuts of each class fall, the rows of only those buckets are ranked, and the
four cutting (hash, key) pairs come to the driver. Applying it is then a row-local
expression: no join, no shuffle, and the same part for a row under any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.columns import col
from faultline.operators.checks import require_stratifiable
from faultline.spec import SEED, TEST_FRACTION, VALIDATION_FRACTION

# Hex digits by which a cut is narrowed at a time, digits of the hash, rows of one sort.
DIGITS, HASH_DIGITS = 2, 32
SORTED_ROWS = 100_000


def row_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", col(key).cast("string"), F.lit(str(seed))))


def class_shares(counts: dict[int, int], wanted: int) -> dict[int, int]:
    """Split ``wanted`` over the classes by largest remainder, ties to the lower label."""
    total = sum(counts.values())
    exact = {label: wanted * n / total for label, n in counts.items()}
    out = {label: math.floor(x) for label, x in exact.items()}
    left = wanted - sum(out.values())
    by_remainder = sorted(counts, key=lambda label: (out[label] - exact[label], label))
    for label in by_remainder[:left]:
        out[label] += 1
    return out


def upto(key: str, seed: int, cut: tuple[str, object] | None) -> Column:
    """Whether a row stands at or before the cut; no row does where there is none."""
    if cut is None:
        return F.lit(False)
    h = row_hash(key, seed)
    return (h < cut[0]) | ((h == cut[0]) & (col(key) <= F.lit(cut[1])))


def hashed_keys(df: DataFrame, key: str, target: str, seed: int) -> DataFrame:
    return df.select(
        col(target).cast("int").alias("_label"),
        col(key).alias("_key"),
        row_hash(key, seed).alias("_hash"),
    )


def bucket_sizes(hashed: DataFrame, digits: int) -> dict[int, list[tuple[str, int]]]:
    """Rows per label and leading hex digits of the hash, in order."""
    held: dict[int, list[tuple[str, int]]] = {}
    prefix = F.substring("_hash", 1, digits).alias("_prefix")
    for row in hashed.groupBy("_label", prefix).count().collect():
        held.setdefault(row["_label"], []).append((row["_prefix"], row["count"]))
    return {label: sorted(one) for label, one in held.items()}


def cutting_rows(
    hashed: DataFrame,
    buckets: dict[int, list[tuple[str, int]]],
    ranks: dict[int, Sequence[int]],
) -> dict[tuple[int, int], tuple[str, object]]:
    """(hash, key) of the row at each wanted rank of a label, by (label, place in ``ranks``).

    ``buckets`` has the sizes by DIGITS digits: at most 256 numbers per label, whatever the
    table holds. Every cut is narrowed by two more digits until its bucket is a small sort.
    A rank of 0 has no row.
    """
    digits = DIGITS
    # (label, cut number) -> (prefix, rank inside it)
    cutting = {
        (label, number): ("", rank)
        for label in buckets
        for number, rank in enumerate(ranks[label])
        if rank > 0
    }
    if not cutting:
        return {}
    while True:
        largest = 0
        for (label, number), (prefix, rank) in cutting.items():
            for bucket, n in buckets[label]:
                if bucket.startswith(prefix):
                    if rank <= n:
                        cutting[label, number] = (bucket, rank)
                        largest = max(largest, n)
                        break
                    rank -= n
        here = F.lit(False)
        for label, prefix in {(label, prefix) for (label, _), (prefix, _) in cutting.items()}:
            here = here | ((F.col("_label") == label) & F.col("_hash").startswith(prefix))
        inside = hashed.where(here)
        if largest <= SORTED_ROWS or digits >= HASH_DIGITS:
            break
        digits += DIGITS
        buckets = bucket_sizes(inside, digits)

    prefix = F.substring("_hash", 1, digits)
    place = Window.partitionBy("_label", "_prefix").orderBy("_hash", "_key")
    ranked = inside.withColumn("_prefix", prefix).withColumn("_rank", F.row_number().over(place))
    hit = F.lit(False)
    for (label, _), (prefix, rank) in cutting.items():
        hit = hit | ((F.col("_label") == label) & (F.col("_prefix") == prefix) & (F.col("_rank") == rank))
    rows = {
        (r["_label"], r["_prefix"], r["_rank"]): (r["_hash"], r["_key"])
        for r in ranked.where(hit).collect()  # at most one row per cut
    }
    return {cut: rows[cut[0], prefix, rank] for cut, (prefix, rank) in cutting.items()}


@dataclass(frozen=True)
class SplitPlan:
    """The fitted cuts: {label: (test cut, validation cut)}, each (hash, key as text)."""

    key: str
    target: str
    seed: int
    cuts: dict[int, tuple[tuple[str, object] | None, tuple[str, object] | None]]

    def part(self) -> Column:
        out = None
        for label, (test, validation) in sorted(self.cuts.items()):
            same = col(self.target).cast("int") == label
            for name, condition in (
                ("test", upto(self.key, self.seed, test)),
                ("validation", upto(self.key, self.seed, validation)),
                ("train", F.lit(True)),
            ):
                condition = same & condition
                out = F.when(condition, name) if out is None else out.when(condition, name)
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn("split", self.part())


def fit_split(
    df: DataFrame,
    key: str,
    target: str,
    seed: int = SEED,
    test_fraction: float = TEST_FRACTION,
    validation_fraction: float = VALIDATION_FRACTION,
) -> SplitPlan:
    """Find the cuts. Keys must be unique; the target must hold 0 and 1 only."""
    require_stratifiable(df, target)
    hashed = hashed_keys(df, key, target, seed)
    buckets = bucket_sizes(hashed, DIGITS)
    totals = {label: sum(n for _, n in held) for label, held in buckets.items()}
    size = sum(totals.values())
    n_test = math.ceil(test_fraction * size)
    test = class_shares(totals, n_test)
    rest = {label: totals[label] - test[label] for label in totals}
    validation = class_shares(rest, math.ceil(validation_fraction * (size - n_test)))
    found = cutting_rows(
        hashed,
        buckets,
        {label: (test[label], test[label] + validation[label]) for label in totals},
    )
    cuts = {label: (found.get((label, 0)), found.get((label, 1))) for label in totals}
    return SplitPlan(key, target, seed, cuts)


def stratified_split(df: DataFrame, key: str, target: str, **options) -> DataFrame:
    """The table with a ``split`` column: train, validation or test."""
    return fit_split(df, key, target, **options).apply(df)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("count"))


def split_class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy("split", col(target).alias("label")).agg(
        F.count(F.lit(1)).alias("count")
    )


def development_set(df: DataFrame) -> DataFrame:
    """Train and validation rows; the test part is never read."""
    return df.where(F.col("split").isin("train", "validation"))
