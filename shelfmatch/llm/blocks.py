"""Asking the whole corpus about hashes without a shuffle row for each.

Documents lie in blocks by a hash of their id. A block sends the sorted distinct hashes it holds in
one binary value per bucket of the hash range; a bucket looks at what all blocks have sent and sends
back an answer for each hash, in the same order. A hash that is frequent everywhere is sent once by
each block. The exchange that puts documents into blocks is the same plan each time, so Spark runs
it once and reuses it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .worker import forget

BLOCKS_PER_PARTITION = 3  # so that partitions get similar numbers; letters grow with it
LETTERS = "_block int, _bucket int, _keys binary, _more binary"
ECHO = -1  # bucket of what a block sends to itself


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(spark: SparkSession) -> int:
    """Half as many as partitions: blocks times buckets is the number of letters."""
    return max(1, partitions(spark) // 2)


def in_blocks(df: DataFrame, key: str) -> DataFrame:
    """Columns _block and _row, the row as a struct, so that no column name can clash."""
    n = partitions(df.sparkSession)
    block = F.pmod(F.xxhash64(F.col(key)), F.lit(BLOCKS_PER_PARTITION * n)).cast("int")
    return df.select(block.alias("_block"), F.struct("*").alias("_row")).repartition(n, "_block")


def letters(
    block: int, hashes: np.ndarray, buckets: int, low: bytes | np.ndarray, more: np.ndarray,
    echo: bytes,
) -> pa.Table:
    """What a block sends. ``hashes`` are sorted; ``low`` and ``more`` hold as many values."""
    forget()
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(cuts)).tolist()
    return pa.table(
        {
            "_block": pa.array([block] * (len(full) + 1), pa.int32()),
            "_bucket": pa.array([ECHO, *full], pa.int32()),
            "_keys": pa.array([None, *(low[cuts[b] : cuts[b + 1]].tobytes() for b in full)], pa.binary()),
            "_more": pa.array([echo, *(more[cuts[b] : cuts[b + 1]].tobytes() for b in full)], pa.binary()),
        }
    )


def asked(
    sent: DataFrame, answer: Callable[[list[bytes], list[bytes]], list[bytes]], buckets: int
) -> DataFrame:
    """Each letter with its answer in _more; echoes go back as they are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            for block, bucket, keys, more in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket == ECHO:
                    yield _reply([block], bucket, [more])
                else:
                    one = got.setdefault(bucket, ([], [], []))
                    for to, x in zip(one, (block, keys, more)):
                        to.append(x)
        for bucket in sorted(got):
            blocks, keys, more = got.pop(bucket)
            yield _reply(blocks, bucket, answer(keys, more))

    to = F.when(F.col("_bucket") == ECHO, F.pmod("_block", F.lit(buckets))).otherwise(F.col("_bucket"))
    return sent.repartitionById(buckets, to.cast("int")).mapInArrow(read, LETTERS)


def _reply(blocks: list[int], bucket: int, more: list[bytes]) -> pa.RecordBatch:
    n = len(blocks)
    return pa.record_batch(
        [
            pa.array(blocks, pa.int32()),
            pa.array([bucket] * n, pa.int32()),
            pa.array([None] * n, pa.binary()),
            pa.array(more, pa.binary()),
        ],
        names=["_block", "_bucket", "_keys", "_more"],
    )


def answers(replies: pa.Table) -> tuple[list[bytes], bytes]:
    """Of one block: the answers in the order of the hashes, and the echo."""
    rows = sorted(zip(replies["_bucket"].to_pylist(), replies["_more"].to_pylist()))
    return [m for b, m in rows if b != ECHO], next((m for b, m in rows if b == ECHO), b"")


def shared_counts(keys: list[bytes], dtype, weights: list[np.ndarray]) -> list[np.ndarray]:
    """For each key of each sender the sum of its weights over all senders."""
    arrays = [np.frombuffer(k, dtype) for k in keys]
    _, inverse = np.unique(np.concatenate(arrays), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(weights))[inverse]
    return np.split(total, np.cumsum([len(a) for a in arrays])[:-1])
