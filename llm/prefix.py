"""Running totals without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_total(rows: DataFrame, by: str, part: str, order: list[Column | str], value: Column, name: str) -> DataFrame:
    """`rows` with `name`: the sum of `value` over the rows before it in its group.

    A group is cut by `part`: sums are run inside each (group, part), and each part starts after the parts before it. So no window
    holds more than one part of a group, whatever share of all rows the group has. `rows` must be stored: it's read twice.
    """
    rows = rows.withColumn("value__", value)
    sums = rows.groupBy(by, part).agg(F.sum("value__").alias("sum__"))
    earlier = Window.partitionBy(by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col(by).alias("by__"), F.col(part).alias("part__"), F.coalesce(F.sum("sum__").over(earlier), F.lit(0)).alias("base__"))
    inside = Window.partitionBy(by, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("inner__", F.coalesce(F.sum("value__").over(inside), F.lit(0)))
    joined = inner.join(bases, F.col(by).eqNullSafe(F.col("by__")) & (F.col(part) == F.col("part__")))
    return joined.withColumn(name, F.col("base__") + F.col("inner__")).drop("by__", "part__", "base__", "inner__", "value__")
