"""Vectors as binary rows, packed into matrices of bounded size for work in tasks.

Components are stored as 32-bit floats where they are given so, else as 64-bit ones, and always computed with as the latter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FloatType


def usable(vector: Column, *, zero: bool) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, and with a component that isn't 0 unless `zero`."""
    value = lambda x: F.coalesce(x.cast("double"), F.lit(float("nan")))
    finite = F.forall(vector, lambda x: ~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")))
    return F.coalesce(finite if zero else finite & F.exists(vector, lambda x: value(x) != 0), F.lit(False))


def as_rows(df: DataFrame, id_column: str, vector_column: str, *, zero: bool, scale_floor: int | None = None) -> DataFrame:
    """row (unique), id, dim, length, vector (little-endian floats) of usable vectors with an id.

    With `scale_floor` components x become floor(scale_floor * x). Extra columns are ignored, whatever their names.
    """
    stored = "<f4" if isinstance(df.schema[vector_column].dataType.elementType, FloatType) and scale_floor is None else "<f8"
    given = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("v"))
    kept = given.where(F.col("id").isNotNull() & usable(F.col("v"), zero=zero)).withColumn("v", F.col("v").cast("array<double>"))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            vectors = [np.asarray(v.values) for v in batch.column(2)]
            if scale_floor is not None:
                vectors = [np.floor(scale_floor * v) for v in vectors]
            lengths = [float(np.sqrt(v @ v)) for v in vectors]
            columns = [pa.array([len(v) for v in vectors], pa.int32()), pa.array(lengths, pa.float64()), pa.array([v.astype(stored).tobytes() for v in vectors], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["row", "id", "dim", "length", "vector"])

    return kept.mapInArrow(encode, "row bigint, id bigint, dim int, length double, vector binary")


def matrix(data: bytes, rows: int, dim: int):
    """Vectors that lie one after another, as rows of doubles."""
    import numpy as np

    single = len(data) < 8 * rows * dim
    return np.frombuffer(data, "<f4" if single else "<f8").reshape(rows, dim).astype(np.float64)


PACK_SCHEMA = "key int, dim int, least double, most double, rows array<bigint>, ids array<bigint>, vectors binary"


def pack(ordered: DataFrame, most_rows: int) -> DataFrame:
    """Rows (key, row, id, dim, length, vector), as they lie in each task, as packs of at most `most_rows` that share key and dim."""
    def packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), longs, longs, pa.binary()]
        names = [x.split()[0] for x in PACK_SCHEMA.split(", ")]

        def closed(of: tuple, held: list[tuple]) -> pa.RecordBatch:
            rows, ids, lengths, vectors = zip(*held)
            values = [*of, min(lengths), max(lengths), list(rows), list(ids), b"".join(vectors)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        of, held = None, []
        for batch in batches:
            for key, row, owner, dim, length, vector in zip(*(c.to_pylist() for c in batch.columns)):
                if held and ((key, dim) != of or len(held) >= most_rows):
                    yield closed(of, held)
                    held = []
                of = key, dim
                held.append((row, owner, length, vector))
        if held:
            yield closed(of, held)

    return ordered.select("key", "row", "id", "dim", "length", "vector").mapInArrow(packs, PACK_SCHEMA)
