"""Argument checks on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
