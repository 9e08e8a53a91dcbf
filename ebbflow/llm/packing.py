"""Packing by binary decomposition: no padding, and no sequence crosses documents.

A document of L ids is cut into L div 2048 pieces of 2048 ids and one piece for every set
bit of the rest, longest first. Pieces of one length form a bucket, each piece is a
sequence of its own, and a bucket can be batched as it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.store import stored
from ebbflow.llm.tokens import encoder

LONGEST_SEQUENCE = 2048  # a power of two
TEXTS_AT_ONCE = 512


def bucket_lengths(longest: int) -> list[int]:
    return [1 << k for k in range(longest.bit_length() - 1, -1, -1)]


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, longest: int) -> DataFrame:
    """(doc_id, part, before, ids): ids with the end id, as little-endian 32-bit bytes.

    `part` is the task that read the document; `before` counts, for each bucket, the pieces
    of the documents that task read earlier. A null text is an empty one. Only doc_id and
    text are read, so other columns may have any name.
    """
    end = int(end_id).to_bytes(4, "little")
    lengths = np.array(bucket_lengths(longest))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("part", pa.int32()),
            ("before", pa.list_(pa.int64())),
            ("ids", pa.binary()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, so_far = TaskContext.get().partitionId(), np.zeros(len(lengths), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                piece = batch.slice(at, TEXTS_AT_ONCE)
                ids = [b + end for b in encoder(vocabulary).encode(piece.column(1).to_pylist())]
                total = np.array([len(b) // 4 for b in ids], np.int64)[:, None]
                counts = total // lengths
                counts[:, 1:] %= 2
                reached = so_far + np.cumsum(counts, axis=0)
                before, so_far = reached - counts, reached[-1]
                columns = [
                    piece.column(0),
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(list(before), schema.field("before").type),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return narrow.mapInArrow(encode, "doc_id bigint, part int, before array<bigint>, ids binary")


def _count(total: Column, length: int, longest: int) -> Column:
    """Pieces of `length` in a document of `total` ids."""
    whole = F.floor(total / length).cast("bigint")
    return whole if length == longest else whole % 2


def _bucket_pieces(n: Column, start: Column, length: int, first: Column) -> Column:
    """A document's n pieces of one length, from `start` on, numbered from `first` on."""
    steps = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    size = F.lit(length).cast("bigint")
    return F.transform(
        steps,
        lambda i: F.struct(
            (start + i * size).alias("start"), size.alias("length"), (first + i).alias("sequence_id")
        ),
    )


def pack(
    docs: DataFrame, vocabulary: str, end_id: int, longest: int = LONGEST_SEQUENCE
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Sequence ids have no gaps: longest bucket first, then by task and row of the stored
    token table. The texts are encoded once; their ids are neither shuffled nor sorted. The
    broadcast table has one row per task that wrote tokens, whatever the documents are.
    Repeated rows are packed each for itself; an empty table gives no piece.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    lengths = bucket_lengths(longest)
    table = stored(tokenised(docs, vocabulary, end_id, longest), "tokens").withColumn(
        "doc_tokens", F.floor(F.octet_length("ids") / 4).cast("bigint")
    )
    per_part = table.groupBy("part").agg(
        F.array(*[F.sum(_count(F.col("doc_tokens"), n, longest)) for n in lengths]).alias("counts")
    )
    long = per_part.select("part", F.posexplode("counts").alias("bucket", "n"))
    earlier = Window.orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    based = long.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    in_order = F.array_sort(F.collect_list(F.struct("bucket", "base")))
    bases = based.groupBy("part").agg(F.transform(in_order, lambda s: s["base"]).alias("bases"))
    total = F.col("doc_tokens")
    pieces = []
    for k, length in enumerate(lengths):
        n = _count(total, length, longest)
        # the longer pieces come first, so a piece starts at the total without the lower bits
        start = F.lit(0) if length == longest else F.floor(total / (2 * length)) * (2 * length)
        first = F.col("bases")[k] + F.col("before")[k]
        pieces.append(_bucket_pieces(n, start.cast("bigint"), length, first))
    placed = table.join(F.broadcast(bases), "part")
    rows = placed.select("doc_id", "doc_tokens", "ids", F.explode(F.concat(*pieces)).alias("p"))
    return rows.select(
        "doc_id",
        "p.start",
        "p.length",
        F.substring("ids", F.col("p.start").cast("int") * 4 + 1, F.col("p.length").cast("int") * 4).alias("ids"),
        "doc_tokens",
        "p.sequence_id",
        F.lit(0).cast("bigint").alias("offset"),
    )
