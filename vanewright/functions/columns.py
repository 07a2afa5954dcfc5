"""Choosing columns by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType


def numeric_columns(df: DataFrame, containing: str) -> list[str]:
    """Numeric columns whose name contains a text; text columns such as ``abnormal_sensor`` are left out."""
    return [f.name for f in df.schema.fields if containing in f.name and isinstance(f.dataType, NumericType)]


def columns_named(
    df: DataFrame, prefix: str | None = None, suffix: str | None = None, names: Iterable[str] = ()
) -> list[str]:
    """Columns that start with ``prefix``, end with ``suffix`` or are listed, sorted by name."""
    listed = set(names)
    return sorted(
        c
        for c in df.columns
        if c in listed
        or (prefix is not None and c.startswith(prefix))
        or (suffix is not None and c.endswith(suffix))
    )
