"""Vectors in shards: bounded rows of packed numpy arrays, and blocks of queries dealt to every shard."""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import prepare

#: One packed shard or block: its number and its arrays.
PACKED = "part long, body binary"
Arrays = dict[str, np.ndarray]


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    x = F.col(vector).cast("array<double>")
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False))


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(body: bytes) -> Arrays:
    with np.load(io.BytesIO(body), allow_pickle=False) as found:
        return {name: found[name] for name in found.files}


def padded(column: pa.ListArray) -> np.ndarray:
    """Vectors as rows of one matrix; missing components at the end count as zero."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def widened(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, max(0, width - a.shape[1]))))


def scaled(x: np.ndarray, scale: int, most: float) -> np.ndarray:
    """``floor(scale * x)`` as integers; beyond ``most`` they stay there."""
    return np.clip(np.floor(scale * x), -most, most).astype(np.int64)


def ids_of(arrays: Arrays, at: np.ndarray) -> pa.Array:
    """The ids of some rows, null where they were."""
    return pa.array(arrays["ids"][at], mask=~arrays["known"][at])


def dealt(rows: DataFrame, size: int, make: Callable[[Arrays, pa.Table], Arrays]) -> tuple[DataFrame, int]:
    """Rows ``vec_id, vector, ...`` dealt evenly into parts of about ``size``, numbered from 0.

    A part is one packed row: ids in ascending order with nulls last, and what ``make`` adds from the
    part's rows. Parts do not depend on any key, so none is hot. Returns them and how many they are.
    """
    prepare(rows.sparkSession)
    parts = max(1, math.ceil(rows.count() / size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            whole = pa.Table.from_batches(held).sort_by([("vec_id", "ascending")]).combine_chunks()
            column = whole["vec_id"].combine_chunks()
            known = column.is_valid().to_numpy(zero_copy_only=False)
            arrays = {"ids": column.fill_null(0).to_numpy(), "known": known}
            body = pack(**arrays, **make(arrays, whole))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([body], pa.binary())], ["part", "body"])

    return rows.repartition(parts).mapInArrow(run, PACKED), parts


def facing(shards: DataFrame, blocks: DataFrame, n_shards: int, work: Callable[[Arrays, Arrays, int], pa.RecordBatch | None], schema: str) -> DataFrame:
    """What ``work(shard, block, number of the block)`` finds, for each block of queries in each shard.

    Blocks are repeated once for each shard and sorted behind it, so that a task holds one shard and one
    block at a time, and a shard is moved once whatever the number of blocks. Tasks are as many as shards:
    their work is not seen in their few bytes.
    """
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard")
    asked = blocks.select(everywhere, F.col("part").alias("block"), "body")
    both = shards.select(F.col("part").alias("shard"), F.lit(-1).cast("long").alias("block"), "body").union(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, shard = -1, None
        for batch in batches:
            for row in range(batch.num_rows):
                at, block, body = (batch[c][row].as_py() for c in ("shard", "block", "body"))
                if block < 0:
                    here, shard = at, unpack(body)
                elif at == here:
                    found = work(shard, unpack(body), block)
                    if found is not None and found.num_rows:
                        yield found

    return both.repartition(n_shards, "shard").sortWithinPartitions("shard", "block").mapInArrow(run, schema)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` largest allowed scores of each row; ties go to the smaller column."""
    least = np.iinfo(scores.dtype).min if scores.dtype.kind == "i" else -np.inf
    held = np.where(allowed, scores, least)
    n = held.shape[1]
    if n > k:
        allowed = allowed & (held >= np.partition(held, n - k, axis=1)[:, n - k, None])
    row, column = np.nonzero(allowed)
    found = scores[row, column]
    order = np.lexsort((column, ~found if found.dtype.kind == "i" else -found, row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    kept = np.arange(len(row)) - first[row] < k
    return row[kept], column[kept]
