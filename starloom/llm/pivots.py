"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest reference points (pivots) in order, the nearest first. Two vectors share a pivot
if both name it, at places at most ``GAP`` apart. There is one inverted list for each label, length and pivot. In a list, the shared
pivots of all its pairs are counted from the orders, and pairs with ``SHARED`` or more are verified: their cosine is computed in double
precision. Pairs with as many pivots in common have one of them among the ``NEAREST - SHARED + 1`` rarest of either vector, so a vector
stands only in the lists of these; a pair counts in the list of the rarest pivot it shares, and so once.

Pivots are a sample of the vectors, picked by a hash and not close to each other, ``DENSITY`` times the root of the number of
vectors, but no more than fit ``PIVOT_BYTES``: lists then grow with the root of the input, and their pairs with its power of 1.5. From about
1.6e7 vectors of 64 numbers on, pivots stay as many and lists grow; they are never capped. Lists of more than ``BLOCK`` vectors are cut into
blocks by a hash of the vector, and each pair of blocks is a piece of work of its own. Lists of one vector are dropped before
vectors are moved. Only sums and one edge a vector leave a piece of work, never the pairs.

Vectors are compared only if their labels are equal and not null and their lengths are equal. Null or empty
vectors, those of length zero, and those with null or non-finite components link with nothing.
Equal vectors of a label are indexed once. A null vec_id is no one's component unless all of
its component are null. Of pivots as near as each other the more frequent stands first. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.graph import components
from starloom.sources.warehouse import settle

LEAST_COSINE = 0.98
#: Pivots by the root of the number of vectors, at least so many, and bytes of all pivots at most.
DENSITY = 4
LEAST_PIVOTS = 64
PIVOT_BYTES = 1 << 23
#: Pivots are no closer to each other than this.
PIVOT_COSINE = 0.95
NEAREST = 8
SHARED = 4
GAP = 4
BLOCK = 1024
#: Numbers of a product that is held at a time.
_HELD = 1 << 22


def _keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, key (null if the vector cannot link), label, dim, and the vector's doubles, of length 1."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, dims, units = [], [], []
            for label, vector in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                key = unit = None
                if label is not None and vector.is_valid and len(vector.values) and not vector.values.null_count:
                    # Minus zero is zero.
                    values = vector.values.to_numpy(zero_copy_only=False) + 0.0
                    largest = np.abs(values).max()
                    if np.isfinite(largest) and largest > 0:
                        scaled = values / largest
                        unit = (scaled / np.sqrt(scaled @ scaled)).tobytes()
                        key = hashlib.blake2b(label.encode() + b"\0" + values.tobytes(), digest_size=16).digest()
                keys.append(key)
                units.append(unit)
                dims.append(0 if unit is None else len(unit) // 8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), batch.column(1), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                names=["vec_id", "key", "label", "dim", "unit"],
            )

    return rows.mapInArrow(work, "vec_id long, key binary, label string, dim int, unit binary")


def choose_pivots(classes: DataFrame, pivots: int | None, nearest: int) -> dict[int, np.ndarray]:
    """Pivots of every length that a sample holds, the rarest among the nearest pivots of the sample first."""
    n, widest = classes.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    wanted = pivots or min(max(LEAST_PIVOTS, math.ceil(DENSITY * math.sqrt(n))), max(LEAST_PIVOTS, PIVOT_BYTES // (8 * widest)))
    # At most four times as many vectors; one that is close to a pivot already chosen tells little more.
    sample = classes.orderBy(F.xxhash64("key", F.lit("pivots")), "key").limit(4 * wanted).select("dim", "unit").collect()
    by_dim: dict[int, list[np.ndarray]] = {}
    for row in sample:
        by_dim.setdefault(row[0], []).append(np.frombuffer(bytes(row[1])))
    found, free = {}, wanted
    for dim, units in sorted(by_dim.items()):
        chosen, count = np.empty((min(free, len(units)), dim)), 0
        for unit in units:
            if count < len(chosen) and (not count or (chosen[:count] @ unit).max() < PIVOT_COSINE):
                chosen[count] = unit
                count += 1
        free -= count
        if count:
            chosen = chosen[:count]
            used = np.zeros(count, np.int64)
            for orders in _orders(np.array(units), chosen, nearest):
                used += np.bincount(orders.ravel(), minlength=count)
            found[dim] = chosen[np.argsort(used, kind="stable")]
    return found


def _orders(units: np.ndarray, points: np.ndarray, nearest: int) -> Iterator[np.ndarray]:
    """The numbers of the nearest points of each unit vector, the nearest first, some rows at a time."""
    step, count = max(1, _HELD // len(points)), min(nearest, len(points))
    for at in range(0, len(units), step):
        close = units[at : at + step] @ points.T
        # From the last point back, so that of equals the larger number stands first.
        yield (len(points) - 1 - np.argsort(-close[:, ::-1], axis=1, kind="stable")[:, :count]).astype(np.int32)


def describe(classes: DataFrame, points: dict[int, np.ndarray], nearest: int, shared: int) -> DataFrame:
    """The classes with ``near``, the order of their nearest pivots, and ``lists``, the pivots in whose lists they stand."""
    held = classes.sparkSession.sparkContext.broadcast(points)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, units = batch.column(3).to_numpy(), batch.column(4)
            near: list = [None] * batch.num_rows
            lists: list = [None] * batch.num_rows
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                # A length without pivots of its own has one list for all.
                own = held.value.get(dim, np.zeros((1, dim)))
                unit = np.frombuffer(b"".join(units.take(pa.array(rows)).to_pylist())).reshape(len(rows), dim)
                orders = np.concatenate(list(_orders(unit, own, nearest)))
                least = min(shared, orders.shape[1])
                rarest = np.sort(orders, axis=1)[:, : orders.shape[1] - least + 1]
                for i, order, few in zip(rows.tolist(), orders, rarest, strict=True):
                    near[i], lists[i] = order.tobytes(), few
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.binary()), pa.array(lists, pa.list_(pa.int32()))],
                names=["key", "size", "label", "dim", "unit", "near", "lists"],
            )

    columns = "key binary, size long, label string, dim int, unit binary, near binary, lists array<int>"
    return classes.select("key", "size", "label", "dim", "unit").mapInArrow(work, columns)


def shared_pivots(near: np.ndarray, other: np.ndarray, gap: int) -> np.ndarray:
    """For each row of ``near`` and each of ``other``, how many pivots both name at places at most ``gap`` apart."""
    counts = np.zeros((len(near), len(other)), np.int8)
    for at in range(near.shape[1]):
        for to in range(max(0, at - gap), min(other.shape[1], at + gap + 1)):
            counts += near[:, at, None] == other[None, :, to]
    return counts


def _linked(units: np.ndarray, near: np.ndarray, split: int, least: float, shared: int, gap: int, this: int) -> np.ndarray:
    """Which pairs of a list are linked and count in it. ``split`` > 0: only pairs across it. ``this`` is the list's pivot."""
    linked = np.zeros((len(units), len(units)), bool)
    left, right = (slice(0, split), slice(split, None)) if split else (slice(None), slice(None))
    found = shared_pivots(near[left], near[right], gap) >= shared
    if not split:
        found = np.triu(found, 1)
    if found.any():
        found &= units[left] @ units[right].T >= least
    a, b = np.nonzero(found)
    b = b + split
    for at in range(0, len(a), _HELD // 64):
        i, j = a[at : at + _HELD // 64], b[at : at + _HELD // 64]
        rarest = np.full(len(i), np.iinfo(np.int32).max)
        for p in range(near.shape[1]):
            for q in range(max(0, p - gap), min(near.shape[1], p + gap + 1)):
                rarest = np.where(near[i, p] == near[j, q], np.minimum(rarest, near[i, p]), rarest)
        i, j = i[rarest == this], j[rarest == this]
        linked[i, j] = linked[j, i] = True
    return linked


def _verify(rows: list[tuple], least: float, shared: int, gap: int, this: int) -> pa.RecordBatch | None:
    """Links and one edge for each vector of a piece of work: rows of (key, size, side, unit, near)."""
    rows = sorted(rows, key=lambda r: (r[2], r[0]))
    keys, sizes = [r[0] for r in rows], np.array([r[1] for r in rows], np.int64)
    split = sum(1 for r in rows if r[2] == 0) if rows[-1][2] else 0
    units = np.frombuffer(b"".join(r[3] for r in rows)).reshape(len(rows), -1)
    near = np.frombuffer(b"".join(r[4] for r in rows), np.int32).reshape(len(rows), -1)
    linked = _linked(units, near, split, least, min(shared, near.shape[1]), gap, this)
    found_links, found_label = linked @ sizes, np.arange(len(rows))
    while True:
        smallest = np.minimum(found_label, np.where(linked, found_label[None, :], len(rows)).min(axis=1))
        if (smallest == found_label).all():
            break
        found_label = smallest
    hit = np.flatnonzero(found_links)
    if not len(hit):
        return None
    return pa.RecordBatch.from_arrays(
        [
            pa.array([keys[i] for i in hit], pa.binary()), pa.array(found_links[hit]),
            pa.array([keys[i] for i in found_label[hit]], pa.binary()),
        ],
        names=["key", "links", "to"],
    )


def near_duplicates(
    vectors: DataFrame, least: float = LEAST_COSINE, pivots: int | None = None, nearest: int = NEAREST,
    shared: int = SHARED, gap: int = GAP, block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row. ``pivots`` are by the number of vectors if not given."""
    rows = settle(_keyed(vectors), "pivot_rows")
    classes = rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("size"), F.first("label").alias("label"),
        F.first("dim").alias("dim"), F.first("unit").alias("unit"),
    )
    classes = settle(classes, "pivot_classes")
    described = settle(describe(classes, choose_pivots(classes, pivots, nearest), nearest, shared), "pivot_lists")
    one_list = ["label", "dim", "pivot"]
    entries = described.select("key", "label", "dim", F.explode("lists").alias("pivot"))
    # Only lists with at least two vectors matter; long ones are cut into blocks.
    lengths = entries.groupBy(*one_list).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    placed = entries.join(lengths.withColumn("blocks", blocks), one_list).withColumn("own", own)
    # The piece of work of a pair of blocks gets the vectors of both.
    pieces = placed.select(
        "key", *one_list, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "key", *one_list, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    full = pieces.join(described.select("key", "size", "unit", "near"), "key")
    piece = [*one_list, "i", "j"]
    ordered = full.select(*piece, "key", "size", "side", "unit", "near").repartition(*piece).sortWithinPartitions(*piece)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(held) > 1 and (out := _verify(held, least, shared, gap, at[2])) is not None:
                yield out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:5] != at:
                    yield from done()
                    at, held = row[:5], []
                held.append(row[5:])
        yield from done()

    found = settle(ordered.mapInArrow(work, "key binary, links long, to binary"), "pivot_links")
    joined = components(found.select(F.col("key").alias("a"), F.col("to").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    member = joined.withColumnRenamed("node", "key")
    known = classes.select("key", "first_id", "size").join(links, "key", "left").join(member, "key", "left")
    known = settle(known.withColumn("component", F.coalesce("component", "key")), "pivot_members")
    smallest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_class = known.join(smallest, "component").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "key").join(per_class, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
