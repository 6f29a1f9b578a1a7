"""Table descriptions: which column plays which part in an analysis."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class DatasetSpec:
    """Roles, types and allowed values of the columns of one analysed table."""

    key: str
    target: str
    identifiers: tuple[str, ...]
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    leakage: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    types: Mapping[str, T.DataType] = field(default_factory=dict)

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric

    @property
    def required(self) -> tuple[str, ...]:
        return self.identifiers + self.features + (self.target,) + self.leakage

    def roles(self) -> list[tuple[str, str]]:
        """(column, role) in contract order."""
        parts = (
            ("identifier", self.identifiers),
            ("categorical", self.categorical),
            ("numeric", self.numeric),
            ("target", (self.target,)),
            ("leakage", self.leakage),
        )
        return [(name, role) for role, names in parts for name in names]

    def type_of(self, column: str) -> T.DataType:
        if column in self.types:
            return self.types[column]
        if column in self.numeric:
            return T.DoubleType()
        if column in self.leakage or column == self.target:
            return T.IntegerType()
        return T.StringType()

    def schema(self, columns: tuple[str, ...] | None = None) -> T.StructType:
        names = self.required if columns is None else columns
        return T.StructType([T.StructField(n, self.type_of(n), True) for n in names])


# The column contract of the machine-readings table.
MACHINE_READINGS = DatasetSpec(
    key="UDI",
    target="Machine failure",
    identifiers=("UDI", "Product ID"),
    categorical=("Type",),
    numeric=(
        "Air temperature [K]",
        "Process temperature [K]",
        "Rotational speed [rpm]",
        "Torque [Nm]",
        "Tool wear [min]",
    ),
    leakage=("TWF", "HDF", "PWF", "OSF", "RNF"),
    allowed={"Type": ("H", "L", "M")},
    types={"UDI": T.LongType()},
)

# Seed, split fractions, thresholds, costs and targets of the analysis.
SEED = 42
TEST_FRACTION = 0.20
VALIDATION_FRACTION = 0.25
THRESHOLDS = tuple(round(0.05 * k, 2) for k in range(1, 20))
FALSE_NEGATIVE_COST = 10.0
FALSE_POSITIVE_COST = 1.0
MINIMUM_RECALL = 0.80
PROFILE_MINIMUM_RECALL = 0.85
PROFILE_MINIMUM_PRECISION = 0.70
HIGH_IMBALANCE_RATIO = 10.0
OUTCOMES = ("true_negative", "false_positive", "false_negative", "true_positive")
PROFILES = ("high_recall", "balanced", "conservative")
