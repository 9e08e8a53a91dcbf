"""Token ids in files of fixed-width bits, in ascending document order.

A file set is a Parquet table whose rows are segments: a run of whole documents, their ids
packed in the fewest bits the vocabulary needs. A segment is cut into blocks of a fixed
number of ids that start on whole bytes, so the place of any id follows from its number,
and `read_ids` unpacks only the blocks that a span touches. Spark writes the container, so
the files can lie in any store it writes to and a repeated task leaves no second copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.llm.ordering import range_of, split_values
from ebbflow.llm.tokens import encoder, vocabulary_size
from ebbflow.sources.layers import new_path

BLOCK_IDS = 65_536  # a multiple of 8: every block starts on a whole byte
SEGMENT_IDS = 1 << 20
ROWS_PER_RANGE = 8_000
TEXTS_AT_ONCE = 512

SEGMENT = (
    "file_range int, segment int, first bigint, n_ids bigint, bits int, block_ids int, "
    "doc_ids array<bigint>, doc_ends array<bigint>, block_offsets array<bigint>, payload binary"
)


def bits_for(size: int) -> int:
    """Bits that hold every id below `size`."""
    return max(1, (size - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> tuple[bytes, list[int]]:
    """The packed bytes (lowest bit first) and the byte offset of each block."""
    shifts = np.arange(bits, dtype=np.uint32)
    parts, offsets, at = [], [], 0
    for i in range(0, len(ids), block_ids):
        block = ids[i : i + block_ids].astype(np.uint32)
        if bits in (8, 16, 32):
            packed = block.astype(f"<u{bits // 8}").tobytes()
        else:
            rows = (block[:, None] >> shifts) & 1
            packed = np.packbits(rows.astype(np.uint8).ravel(), bitorder="little").tobytes()
        parts.append(packed)
        offsets.append(at)
        at += len(packed)
    return b"".join(parts), offsets


def unpack_block(packed: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(packed, f"<u{bits // 8}", n).astype(np.uint32)
    rows = np.unpackbits(np.frombuffer(packed, np.uint8), count=n * bits, bitorder="little")
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return rows.reshape(n, bits).astype(np.uint32) @ weights


def read_ids(segment: dict, start: int, end: int) -> np.ndarray:
    """Ids start..end of a segment row, touching only the blocks that hold them."""
    if end <= start:
        return np.zeros(0, np.uint32)
    size, bits, n = segment["block_ids"], segment["bits"], segment["n_ids"]
    view, found = memoryview(segment["payload"]), []
    first, last = start // size, (end - 1) // size
    for k in range(first, last + 1):
        held = min(size, n - k * size)
        at = segment["block_offsets"][k]
        block = unpack_block(view[at : at + (held * bits + 7) // 8], held, bits)
        found.append(block[max(0, start - k * size) : end - k * size])
    return np.concatenate(found)


def write_ids(
    docs: DataFrame, vocabulary: str, end_id: int, path: str, block_ids: int = BLOCK_IDS
) -> None:
    """Encode every text (null: empty), append the end id and write the segments to `path`.

    One shuffle, of the texts, by ranges of doc_id; null doc_ids come first, rows with
    equal doc_ids are ordered by text. A task holds one segment and one batch of texts.
    """
    if block_ids % 8:
        raise ValueError("a block must hold a multiple of 8 ids")
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    edges = split_values(narrow.select("doc_id"), "doc_id", ROWS_PER_RANGE)
    bits = bits_for(max(vocabulary_size(vocabulary), end_id + 1))
    end = int(end_id).to_bytes(4, "little")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"range": None, "segment": 0, "first": 0}
        held: list[bytes] = []
        ids_of: list[int | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, ids_of, size
            ids = np.frombuffer(b"".join(held), "<u4")
            payload, offsets = pack_ids(ids, bits, block_ids)
            row = {
                "file_range": state["range"],
                "segment": state["segment"],
                "first": state["first"],
                "n_ids": len(ids),
                "bits": bits,
                "block_ids": block_ids,
                "doc_ids": ids_of,
                "doc_ends": np.cumsum([len(b) // 4 for b in held]).tolist(),
                "block_offsets": offsets,
                "payload": payload,
            }
            state["segment"] += 1
            state["first"] += len(ids)
            held, ids_of, size = [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_ARROW)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                piece = batch.slice(at, TEXTS_AT_ONCE)
                ranges, doc_ids, texts = (c.to_pylist() for c in piece.columns)
                for r, d, blob in zip(ranges, doc_ids, encoder(vocabulary).encode(texts)):
                    if r != state["range"] or size >= SEGMENT_IDS:
                        if held:
                            yield flush()
                        if r != state["range"]:
                            state.update({"range": r, "segment": 0, "first": 0})
                    held.append(blob + end)
                    ids_of.append(d)
                    size += len(blob) // 4 + 1
        if held:
            yield flush()

    placed = narrow.select(range_of(F.col("doc_id"), edges).alias("file_range"), "doc_id", "text")
    ordered = placed.repartition("file_range").sortWithinPartitions("file_range", "doc_id", "text")
    ordered.mapInArrow(segments, SEGMENT).write.option("compression", "zstd").parquet(path)


_SEGMENT_ARROW = pa.schema(
    [
        ("file_range", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("bits", pa.int32()),
        ("block_ids", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_ends", pa.list_(pa.int64())),
        ("block_offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file set: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it over the whole set.
    """
    rows = read_segments(spark, path)
    sizes = rows.groupBy("file_range").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("file_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("file_range", pa.int32()),
            ("start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = read_ids(row, 0, row["n_ids"]).astype("<u4")
                ends = row["doc_ends"]
                starts = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["file_range"]] * len(ends), pa.int32()),
                        pa.array([row["first"] + s for s in starts], pa.int64()),
                        pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                        pa.array([crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends)], pa.int64()),
                    ],
                    schema=schema,
                )

    kinds = "doc_id bigint, file_range int, start bigint, n_tokens bigint, ids_crc32 bigint"
    found = rows.mapInArrow(digest, kinds).join(bases, "file_range")
    return found.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def new_file_set(spark: SparkSession) -> str:
    return new_path(spark, "token-ids")
