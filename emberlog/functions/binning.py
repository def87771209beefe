"""Binning and small numeric column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = True,
    include_lowest: bool = True,
) -> Column:
    """Label of the interval between neighbouring ``edges``; NULL outside of them."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval")
    out = F.lit(None).cast("string")
    for i in reversed(range(len(labels))):
        low, high = edges[i], edges[i + 1]
        if right:
            lower = value >= low if include_lowest and i == 0 else value > low
            inside = lower & (value <= high)
        else:
            upper = value <= high if include_lowest and i == len(labels) - 1 else value < high
            inside = (value >= low) & upper
        out = F.when(inside, labels[i]).otherwise(out)
    return out


def lookup(value: Column, mapping: Mapping[str, object], default: object) -> Column:
    """Small fixed mapping as a CASE expression."""
    out = None
    for key, result in mapping.items():
        out = F.when(value == key, result) if out is None else out.when(value == key, result)
    return F.lit(default) if out is None else out.otherwise(default)


def finite_or_zero(value: Column) -> Column:
    number = value.cast("double")
    bad = number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(bad, 0.0).otherwise(number)


def is_finite(value: Column) -> Column:
    number = value.cast("double")
    return F.coalesce(~F.isnan(number) & (F.abs(number) < float("inf")), F.lit(False))


def flag(condition: Column) -> Column:
    """0/1, with unknown counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(top: Column, bottom: Column, empty: float | None = None) -> Column:
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value if empty is None else F.coalesce(value, F.lit(empty))
