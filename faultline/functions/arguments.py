"""Checks of plain arguments, made before any Spark job starts."""

from __future__ import annotations

import math
from collections.abc import Iterable


def _real(value, name: str) -> float:
    if isinstance(value, (str, bool)):
        raise ValueError(f"{name} must be numeric, got {value!r}")
    try:
        out = float(value)
    except (TypeError, ValueError) as error:
        raise ValueError(f"{name} must be numeric, got {value!r}") from error
    if not math.isfinite(out):
        raise ValueError(f"{name} must be finite, got {out}")
    return out


def threshold_value(value) -> float:
    out = _real(value, "threshold")
    if not 0.0 < out < 1.0:
        raise ValueError(f"threshold must lie strictly between 0 and 1, got {out}")
    return out


def threshold_list(values: Iterable) -> list[float]:
    """Distinct thresholds in ascending order."""
    if isinstance(values, str):
        raise ValueError("thresholds must be a sequence of numbers")
    out = sorted({threshold_value(v) for v in values})
    if not out:
        raise ValueError("at least one threshold is needed")
    return out


def rate(value, name: str) -> float:
    out = _real(value, name)
    if not 0.0 <= out <= 1.0:
        raise ValueError(f"{name} must lie within [0, 1], got {out}")
    return out


def cost_pair(false_negative_cost, false_positive_cost) -> tuple[float, float]:
    fn = _real(false_negative_cost, "false_negative_cost")
    fp = _real(false_positive_cost, "false_positive_cost")
    if fp <= 0.0 or fn <= 0.0:
        raise ValueError("costs must be positive")
    if fn <= fp:
        raise ValueError("a false negative must cost more than a false positive")
    return fn, fp


def at_least_one(value, name: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be an integer of at least 1, got {value!r}")
    return value
