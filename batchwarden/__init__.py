"""Batch data-quality, drift and regression monitoring on Spark DataFrames."""

from batchwarden.profile import (
    ColumnRule,
    ConsistencyRule,
    DriftSettings,
    ModelSettings,
    TableProfile,
)

__all__ = [
    "ColumnRule",
    "ConsistencyRule",
    "DriftSettings",
    "ModelSettings",
    "TableProfile",
]
