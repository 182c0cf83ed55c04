"""Token-id files: every document's ids as its own zstandard frame under one shared dictionary.

Method: a dictionary is trained on serialized id arrays (a bounded sample of chunks of documents' ids, from any place in them) and
every document is compressed by itself with it, so a short document costs few bytes and is read alone. Layout under a folder:

    dictionary/  hash, bytes of the dictionary, bytes per id, samples it was trained on
    segments/    part, segment, first_id, last_id, start (ids before it in its part), dictionary_hash,
                 doc_ids[], counts[], offsets[] (place of each frame), payload (frames one after another)
    manifest/    part, base (ids in all earlier parts)

Parts and segments ascend by doc_id (nulls first; rows of one doc_id by their text's hash). A segment closes at a fixed payload, so
no task holds more than one segment and one document. Spark's writer commits the files, so lost executors leave no half file.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from llm.token_ids import default_vocabulary, encoder

SAMPLE_DOCUMENTS = 600
SAMPLE_CHUNKS = 3_000
CHUNK_IDS = 1_024
DICTIONARY_BYTES = 64 << 10
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCUMENTS = 20_000
LEVEL = 3
#: With fewer samples, or room for fewer bytes, zstandard can't train a dictionary.
LEAST_SAMPLES, LEAST_BYTES = 7, 256

SEGMENT_SCHEMA = ("part int, segment int, first_id bigint, last_id bigint, start bigint, n_tokens bigint, dictionary_hash string, "
                  "doc_ids array<bigint>, counts array<bigint>, offsets array<bigint>, payload binary")


def _serialized(ids: bytes, width: int) -> bytes:
    """Little-endian 32-bit ids in `width` bytes each."""
    import numpy as np

    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _restored(data: bytes, width: int) -> bytes:
    import numpy as np

    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def _width(vocabulary: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, *, vocabulary: str, width: int) -> tuple[bytes, int]:
    """A zstandard dictionary from at most SAMPLE_CHUNKS chunks of ids of SAMPLE_DOCUMENTS documents, drawn by a hash of row places.

    Also the number of chunks it was trained on. Fewer than LEAST_SAMPLES chunks or room for fewer than LEAST_BYTES (an eighth of
    them) give an empty dictionary, trained on none: frames then stand alone. Any other error of training is raised.
    """
    import zstandard

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, step = encoder(vocabulary), CHUNK_IDS * width
        for batch in batches:
            for text in batch.column(0):
                data = _serialized(encode(text.as_py()), width)
                yield pa.RecordBatch.from_arrays([pa.array([data[i:i + step] for i in range(0, len(data), step)], pa.binary())], ["ids"])

    place = F.xxhash64(F.monotonically_increasing_id())
    drawn = docs.select(F.col("text").cast("string"), place.alias("place")).orderBy("place").limit(SAMPLE_DOCUMENTS)
    rows = drawn.select("text").mapInArrow(chunks, "ids binary").orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE_CHUNKS).collect()
    samples = [bytes(r.ids) for r in rows]
    room = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if len(samples) < LEAST_SAMPLES or room < LEAST_BYTES:
        return b"", 0
    return zstandard.train_dictionary(room, samples).as_bytes(), len(samples)


def dictionary_hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def write_token_files(docs: DataFrame, path: str, *, vocabulary: str | None = None, end_id: int = 2,
                      segment_bytes: int = SEGMENT_BYTES) -> None:
    """Encode all texts of `docs` (null or empty: the end id alone) and write them to `path` in ascending doc_id order.

    Rows that repeat are kept as often as they stand there; null doc_ids come first; an empty table gives empty folders. Columns
    other than doc_id and text are not read.
    """
    import zstandard

    spark, vocabulary, end = docs.sparkSession, vocabulary or default_vocabulary(), struct.pack("<I", end_id)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    width = _width(vocabulary)
    dictionary, samples = train_dictionary(docs, vocabulary=vocabulary, width=width)
    name = dictionary_hash(dictionary)
    described = spark.createDataFrame([(name, bytearray(dictionary), width, samples)], "hash string, bytes binary, width int, samples int")
    described.write.parquet(f"{path}/dictionary")

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).compress
        part, segment, start = 0, 0, 0
        doc_ids: list = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            offsets = [0]
            for frame in frames[:-1]:
                offsets.append(offsets[-1] + len(frame))
            known = [x for x in doc_ids if x is not None]
            row = [part, segment, min(known, default=None), max(known, default=None), start, sum(counts), name, doc_ids, counts, offsets,
                   b"".join(frames)]
            longs = pa.list_(pa.int64())
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.string(), longs, longs, longs, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [x.split()[0] for x in SEGMENT_SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, text, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids = encode(text.as_py()) + end
                frame = compress(_serialized(ids, width))
                doc_ids.append(doc_id)
                counts.append(len(ids) // 4)
                frames.append(frame)
                size += len(frame)
                if size >= segment_bytes or len(frames) >= SEGMENT_DOCUMENTS:
                    yield close()
                    segment, start, size = segment + 1, start + sum(counts), 0
                    doc_ids, counts, frames = [], [], []
        if frames:
            yield close()

    # rows of one doc_id may be dealt over several parts by their texts' hashes
    ranged = docs.withColumn("mark", F.xxhash64("text")).repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    ordered = ranged.select("doc_id", "text", F.spark_partition_id().alias("part"))
    ordered.mapInArrow(segments, SEGMENT_SCHEMA).write.parquet(f"{path}/segments")
    parts = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that wrote
    parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).coalesce(1).write.parquet(f"{path}/manifest")


def _located(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, int]:
    """Segments with their base, the dictionary and the width of ids. The manifest has a row for each writing task: broadcast."""
    kept = spark.read.parquet(f"{path}/dictionary").collect()[0]
    dictionary = bytes(kept["bytes"])
    if dictionary_hash(dictionary) != kept["hash"]:
        raise ValueError(f"the dictionary in {path} is damaged")
    segments = spark.read.parquet(f"{path}/segments").join(F.broadcast(spark.read.parquet(f"{path}/manifest")), "part")
    return segments, dictionary, kept["width"]


def read_token_files(spark: SparkSession, path: str, *, doc_ids: Sequence[int] | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and `ids` (little-endian 32-bit) with `keep_ids`.

    `doc_ids` reads only these documents: segments by their id range, frames by the offset index.
    """
    import zstandard

    segments, dictionary, width = _located(spark, path)
    name, wanted = dictionary_hash(dictionary), None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        ids = F.array(*map(F.lit, sorted(wanted))).cast("array<bigint>")
        segments = segments.where(F.exists(ids, lambda x: x.between(F.col("first_id"), F.col("last_id"))))

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).decompress
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:4 + keep_ids]
        for batch in batches:
            for row in range(batch.num_rows):
                before, found, owners, counts, offsets, payload = (c[row].as_py() for c in batch.columns)
                if found != name:
                    raise ValueError(f"a segment needs dictionary {found}, the folder has {name}")
                rows: list[list] = [[] for _ in kinds]
                for doc_id, count, a, b in zip(owners, counts, offsets, [*offsets[1:], len(payload)]):
                    if wanted is None or doc_id in wanted:
                        ids = _restored(decompress(payload[a:b]), width)
                        for column, value in zip(rows, (doc_id, before, count, zlib.crc32(ids), ids)):
                            column.append(value)
                    before += count
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:4 + keep_ids])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    columns = [(F.col("base") + F.col("start")).alias("before"), "dictionary_hash", "doc_ids", "counts", "offsets", "payload"]
    return segments.select(*columns).mapInArrow(documents, schema)
