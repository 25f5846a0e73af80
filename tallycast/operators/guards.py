"""Column checks and input normalisation, decided while the plan is built."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tallycast.functions.scalars import nan_to_null


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The columns that exist, in the given order; the others are skipped."""
    return [c for c in columns if c in df.columns]


def require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in every float column; null is the only missing value."""
    floats = {c: nan_to_null(c) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(floats) if floats else df
