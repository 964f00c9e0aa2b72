"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of at most this many bytes in all are broadcast; larger sides are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def remainder(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def held_out(doc_id: str) -> Column:
    """True for the rows that no model may learn from. A null id is not held out."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


#: What this worker keeps from task to task: of one operator only, as a worker goes on from one to the next.
_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept for the worker's next tasks; another key drops it.

    Tasks must come here by a function of a module: a dictionary that a nested function names travels by value, empty.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Drop what another operator's tasks kept."""
    _kept.clear()


def give_back() -> None:
    """Free memory that the allocators hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library
        trim(0)


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def alone(work: Work) -> Work:
    """``work`` for tasks that keep nothing: the worker drops what others kept before, and what was freed goes back at the end.

    Workers live on and wait beside those of other tasks, so what each still holds adds up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from work(batches)
        give_back()

    return run


#: Bytes of rows that a worker is handed at once within ``small_batches``; a longer row comes alone.
BATCH_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


#: Shuffle files of a job go when it ends, not when the driver's collector finds that nobody asks for them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Jobs run within have the setting; then the session is as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs run within hand rows to workers in batches of about ``BATCH_BYTES``; then the session is as before.

    Every running Python step of an executor holds its batch, and a copy to be sent, beside the heap, in buffers that
    double as they grow; its worker holds the batch again.
    """
    return _setting(spark, _BATCH, str(BATCH_BYTES))


def short_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of jobs run within are removed as each job ends; a table that is asked for again is made again."""
    return _setting(spark, _CLEANUP, "true")


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    start = 0
    for end in [*edges.tolist(), batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end
    # A worker lives on; what its batches took goes back.
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column without nulls, and the place where each text begins (and the last ends)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def join_keys(big: DataFrame, keys: DataFrame, on: Sequence[str], how: str, bytes_a_row: int, rows: int) -> DataFrame:
    """Join with a key table whose rows have been counted.

    Up to ``BROADCAST_BYTES`` of keys go to every executor, so that the big side is not
    moved; beyond that it is a shuffle join, whose hot keys adaptive execution splits.
    """
    return big.join(F.broadcast(keys) if rows * bytes_a_row <= BROADCAST_BYTES else keys, list(on), how)


#: Ids looked at to choose ranges, and the most ranges chosen.
RANGE_SAMPLE = 1 << 16
RANGES = 1 << 12


def id_ranges(rows: DataFrame, target: int) -> list[int]:
    """Edges that cut the ids of (id, weight) rows into ranges of about ``target`` weight each.

    A share of the ids, picked by their hash, gives the edges, so the same rows always give
    the same edges, however they are dealt to tasks and however the ids are spread.
    """
    n, total = rows.agg(F.count("id"), F.sum("weight")).first()
    wanted = min(RANGES, (total or 0) // target + 1)
    if not n or wanted <= 1:
        return []
    share = min(1 << 20, -(-RANGE_SAMPLE * (1 << 20) // n))
    some = rows.where(F.col("id").isNotNull() & (F.pmod(F.xxhash64("id", F.lit("ranges")), F.lit(1 << 20)) < share))
    found = some.groupBy("id").agg(F.sum("weight").cast("long").alias("weight")).toArrow().sort_by("id")
    ids, weights = found.column("id").to_numpy(), found.column("weight").to_numpy()
    if not len(ids):
        return []
    part = (np.cumsum(weights) - 1) * wanted // max(1, int(weights.sum()))
    return ids[np.flatnonzero(np.diff(part)) + 1].tolist()


def range_of(id_column: str, edges: Sequence[int]) -> Column:
    """The number of edges up to the id, found in two steps; -1 for a null id."""
    if not edges:
        return F.when(F.col(id_column).isNull(), -1).otherwise(0)
    step = max(1, int(len(edges) ** 0.5))
    blocks = [edges[i : i + step] for i in range(0, len(edges), step)]
    up_to = lambda values: F.size(F.filter(values, lambda e: e <= F.col(id_column)))
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    block = up_to(longs([b[0] for b in blocks]))
    inside = F.get(F.array(*[longs(b) for b in blocks]), block - 1)
    place = F.when(block == 0, 0).otherwise((block - 1) * step + up_to(inside))
    return F.when(F.col(id_column).isNull(), -1).otherwise(place)
