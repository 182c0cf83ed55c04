"""Best-fit packing of tokenized documents into sequences of bounded length.

Method: bounded-space online best fit. A packer holds a fixed number of open sequences, keyed by their free space in a bitset, so the
fullest one that still takes a piece is found by one shift and one lowest-bit test. When all are open and a piece fits in none, the
fullest is closed for a new one. Each task packs its own share of the pieces, so packing needs one shuffle of short rows (no texts)
and no state across tasks; a task's share has at most about `PIECES_PER_TASK` rows, whatever keys or texts repeat.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from eventwin.sources.sinks import staged
from llm.exprs import added
from llm.token_ids import default_vocabulary, encoder

CAPACITY = 2048
#: Id after each document.
END_ID = 0
#: Sequences that a packer keeps open: 16 bytes each and a bitset of one bit for each possible free space.
OPEN_SEQUENCES = 65_536
PIECES_PER_TASK = 100_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class BestFit:
    """Sequences for pieces that come one by one; `place` returns (sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY, open_sequences: int = OPEN_SEQUENCES):
        self.capacity, self.most, self.opened, self.now = capacity, open_sequences, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit f: some open sequence has f free places

    def _take(self, space: int) -> int:
        sequence = self.by_space[space].pop()
        if not self.by_space[space]:
            self.spaces ^= 1 << space
        self.now -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece of {length} ids doesn't fit in {self.capacity}")
        if fitting := self.spaces >> length:
            space = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            if self.now == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes first
            space, sequence = self.capacity, self.opened
            self.opened += 1
        if left := space - length:
            self.by_space[left].append(sequence)
            self.spaces |= 1 << left
            self.now += 1
        return sequence, self.capacity - space


def cut(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: one if it fits, else pieces of `capacity`, of which the first takes what is over."""
    first = length if length <= capacity else length % capacity or capacity
    yield 0, first
    for start in range(first, length, capacity):
        yield start, capacity


def document_pieces(docs: DataFrame, *, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                    keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32, and `ids` (little-endian 32-bit) with `keep_ids`.

    A null or empty text has the end id alone. Rows that repeat, null doc_ids included, are pieces of their own. Other columns of
    `docs` are not read.
    """
    vocabulary, end = vocabulary or default_vocabulary(), struct.pack("<I", end_id)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[list] = [[] for _ in range(5 + keep_ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start: 4 * (start + length)]
                    for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(own), own)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names[:5 + keep_ids])

    schema = PIECE_SCHEMA + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(pieces, schema)


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, open_sequences: int = OPEN_SEQUENCES,
         pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """`pieces` (with a `length`) and their sequence_id and offset: places in a sequence are gapless from 0.

    Each task takes its pieces in descending length, which wastes least. Sequence ids are unique, not consecutive. An empty table
    stays empty. A column of `pieces` that is called sequence_id or offset is replaced.
    """
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    pieces = staged(pieces.select(*kept), "pieces")  # dealing them out and counting must not tokenize again
    tasks = max(1, math.ceil(pieces.count() / pieces_per_task))
    lengths = kept.index("length")
    order = [F.desc("length"), *(F.col(c) for c in kept if c in ("doc_id", "piece"))]
    dealt = pieces.repartition(tasks).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(capacity, open_sequences)
        for batch in batches:
            if not batch.num_rows:
                continue
            base = batch.column(len(kept))[0].as_py() << 40
            places = [packer.place(n) for n in batch.column(lengths).to_pylist()]
            columns = [*batch.columns[:len(kept)], pa.array([base + s for s, _ in places], pa.int64()),
                       pa.array([o for _, o in places], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    return dealt.mapInArrow(place, added(pieces.schema, sequence_id=LongType(), offset=LongType()))


def pack_documents(docs: DataFrame, *, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   keep_ids: bool = False, open_sequences: int = OPEN_SEQUENCES) -> DataFrame:
    """Documents tokenized, cut and packed: a row for each piece."""
    return pack(document_pieces(docs, vocabulary=vocabulary, capacity=capacity, end_id=end_id, keep_ids=keep_ids),
                capacity=capacity, open_sequences=open_sequences)
