"""Texts as shards of word numbers: each shard is a row with a small vocabulary of its own.

Word numbers for a whole corpus would need its vocabulary in every task. A shard counts
with numbers of its own instead; what the corpus knows of a word comes back to the shard
by a join, as one table over the shard's numbers. Nothing here grows beyond one shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a shard; a longer text is a shard of its own.
SHARD_BYTES = 8 << 20


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed bytes: small ones leave whole planes of zeros."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return planes.T.copy().view("<u4").ravel().astype(np.int64)


def one_list(values: pa.Array) -> pa.ListArray:
    """An array of one list with all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def shards(
    rows: DataFrame, build: Callable[[list[tuple]], list], schema: str, size_of: int, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(shard, fields of ``schema``): what ``build`` makes of neighbouring rows.

    Column ``size_of`` of ``rows`` holds the bytes that fill a shard. Numbers of shards come
    from partitions, so the result has to be staged before it is read twice.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), *build(held)], ["shard", *names]
            )

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                held.append(row)
                size += len(row[size_of] or b"")
                if size >= shard_bytes:
                    yield closed()
                    held, size, number = [], 0, number + 1
        if held:
            yield closed()

    return rows.mapInArrow(run, f"shard long, {schema}")


def tables(values: DataFrame, fields: Column) -> DataFrame:
    """(shard, known): per shard, (local, ``fields``) of the words that ``values`` has a row for."""
    return values.groupBy("shard").agg(F.collect_list(fields).alias("known"))


def by_number(known: pa.ListScalar, field: str, out: np.ndarray) -> np.ndarray:
    """``out``, by word number, with one field of a shard's table put where the table has it."""
    if known.is_valid:
        rows = known.values
        out[rows.field("local").to_numpy()] = rows.field(field).to_numpy()
    return out
