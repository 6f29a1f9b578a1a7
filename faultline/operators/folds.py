"""Stratified k-fold: exact, repeatable folds as a row-local expression.

Within each class, rows are ordered by a hash of key and seed and cut into consecutive
folds. Classes are dealt one after the other like cards, so fold sizes differ by at most one
row, both inside every class and over the whole table. Only the cutting rows of a class, one
less than there are folds, come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.arguments import at_least_one
from faultline.functions.columns import col
from faultline.operators.checks import require_stratifiable
from faultline.operators.splits import DIGITS, bucket_sizes, cutting_rows, hashed_keys, upto
from faultline.spec import SEED

FOLDS = 5


def fold_sizes(counts: dict[int, int], folds: int) -> dict[int, list[int]]:
    """Rows of each class by fold, when card number p of all classes goes to fold p mod folds."""
    sizes, dealt = {}, 0
    for label, n in sorted(counts.items()):
        sizes[label] = [
            (dealt + n - fold + folds - 1) // folds - (dealt - fold + folds - 1) // folds
            for fold in range(folds)
        ]
        dealt += n
    return sizes


@dataclass(frozen=True)
class FoldPlan:
    """The fitted cuts: {label: last (hash, key) of each fold but the final one}."""

    key: str
    target: str
    seed: int
    folds: int
    cuts: dict[int, tuple[tuple[str, object] | None, ...]]

    def fold(self) -> Column:
        """The row's fold, 0 to folds - 1; NULL for a label that the fit did not see."""
        out = F.lit(None).cast("int")
        for label, cuts in sorted(self.cuts.items()):
            place = F.lit(self.folds - 1)
            for fold, cut in reversed(list(enumerate(cuts))):
                place = F.when(upto(self.key, self.seed, cut), fold).otherwise(place)
            out = F.when(col(self.target).cast("int") == label, place).otherwise(out)
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn("fold", self.fold())


def fit_folds(df: DataFrame, key: str, target: str, folds: int = FOLDS, seed: int = SEED) -> FoldPlan:
    """Find the cuts. Keys must be unique; the target must hold 0 and 1 only."""
    if at_least_one(folds, "folds") < 2:
        raise ValueError("folds has to be at least 2")
    require_stratifiable(df, target)
    hashed = hashed_keys(df, key, target, seed)
    buckets = bucket_sizes(hashed, DIGITS)
    totals = {label: sum(n for _, n in held) for label, held in buckets.items()}
    few = min(totals.values(), default=0)
    if few < folds:
        raise ValueError(f"{folds} folds need as many rows of each class, one has {few}")
    ends = {label: list(accumulate(sizes[:-1])) for label, sizes in fold_sizes(totals, folds).items()}
    found = cutting_rows(hashed, buckets, ends)
    cuts = {label: tuple(found.get((label, i)) for i in range(folds - 1)) for label in totals}
    return FoldPlan(key, target, seed, folds, cuts)


def stratified_folds(df: DataFrame, key: str, target: str, **options) -> DataFrame:
    """The table with a ``fold`` column."""
    return fit_folds(df, key, target, **options).apply(df)


def fold_counts(df: DataFrame, target: str) -> DataFrame:
    """(fold, label, count) of a table with folds."""
    return df.groupBy("fold", col(target).alias("label")).agg(F.count(F.lit(1)).alias("count"))
