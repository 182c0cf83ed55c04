"""Lookups by keys that a large share of all rows may have."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Parts in which the rows of one key are dealt.
PARTS = 64


def looked_up(rows: DataFrame, keys: list[str], table: DataFrame, dealt_by: str, *, how: str = "inner") -> DataFrame:
    """`rows` with the other columns of `table`, which has each of `keys` once.

    The rows of a key are dealt into parts by `dealt_by`, and a key's entry is repeated for just the parts in use (kept as one 64-bit
    number), so no task gets all rows of a hot key and entries aren't repeated more often than there are rows. Null keys meet nothing.
    """
    dealt = rows.withColumn("part__", F.pmod(F.xxhash64(dealt_by), F.lit(PARTS)).cast("int"))
    used = dealt.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(
        F.bit_or(F.expr("shiftleft(1L, part__)")).alias("used__"))
    parts = F.expr(f"explode(filter(sequence(0, {PARTS - 1}), p -> (shiftrightunsigned(used__, p) & 1) = 1))")
    return dealt.join(table.join(used, keys).withColumn("part__", parts).drop("used__"), [*keys, "part__"], how).drop("part__")
