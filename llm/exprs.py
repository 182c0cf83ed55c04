"""Small helpers for Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: A to Z alone, whatever the locale.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body uses it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def positions(array: Column) -> Column:
    """0 to size - 1; empty for an empty array."""
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(F.array().cast("array<int>"))


def added(schema: StructType, **fields: DataType) -> StructType:
    """A schema with more fields at its end (`StructType.add` would change the one given)."""
    return StructType([*schema.fields, *(StructField(name, kind) for name, kind in fields.items())])
