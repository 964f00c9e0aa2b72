"""N-gram Jaccard join with rare-first prefix filtering.

Documents are sets of word shingles (see ``shingles``); two are linked if 100 * common >= 75 * all.

1. Texts with equal sets are one node, named by a 128-bit digest of the set. Counts of shingles over all
   documents are kept in ``1 << SKETCH_BITS`` counters, whose number does not grow with the data; a
   shingle's rarity is its counter, ties go by its hash. Any fixed order gives right results; a good one
   gives short lists.
2. In rare-first order a set's prefix is its first n - ceil(0.75 n) + 1 shingles; linked sets share one of them.
   Prefix shingles are packed by hash bucket and dealt out; those of one node only are dropped there.
   Shingles that the sketch says are very frequent are dealt in parts by node.
3. Lists with the same nodes say the same, so one of each kind is kept. Each list's most central
   node is paired with the others; pairs that pass the length, positional and suffix filters are made distinct
   and verified from the texts. Linked nodes join, and lists within one component are done. Then all pairs between
   components are looked at list by list, long lists block by block; only those that pass the same
   filters leave the task, and those not yet verified are, so each pair is verified once. So a group of many near copies gives few pairs, no link
   between components is missed, and no list is capped.
4. Components come from the verified pairs.

The suffix filter deals a set's shingles into ``CLASSES`` by hash: two sets share no more than the smaller
count of each class, added up.

Texts without words, empty and null texts are linked with nothing and are their own component. Repeated rows
are equal texts. A component's id is the smallest non-null doc_id of its rows. An empty table gives no
rows. Other columns pass through ``keep_one`` untouched, whatever their names. A text and its hashes, about 60
bytes a byte of text, must fit into a worker.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import alone, join_keys, short_shuffles, slices, small_batches, whole
from starloom.llm.graph import components
from starloom.llm.shingles import shingle_sets
from starloom.sources.warehouse import settle

#: The threshold as a fraction.
PART, OF = 3, 4
SKETCH_BITS = 20
_SLICES = 256
CLASSES = 1024
#: Prefix shingles that a bucket should have, and those held before they are packed.
BUCKET = 1 << 18
_HELD = 1 << 19
#: Shingles with more documents than this are dealt in parts.
FREQUENT = 1 << 16
#: Nodes of a list that are compared with each other in one task.
BLOCK = 1024
#: Bytes of text whose words are hashed at once; its arrays of 64-bit numbers take some 60 times as much.
_SLICE = 1 << 18
#: Stands for a null id when rows are found again.
_NO_ID = -(1 << 63)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _counters(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole("text")).alias("tkey"), whole("text").alias("text"))


def index(docs: DataFrame) -> DataFrame:
    """One row (doc_id, tkey, n, node) per document, and each task's sketch in rows with a slice number."""
    schema = "doc_id long, tkey long, n long, node binary, slice int, sketch binary"
    names = ["doc_id", "tkey", "n", "node", "slice", "sketch"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                sets = shingle_sets(part.column("text"))
                np.add.at(counts, _counters(np.concatenate(sets)), np.uint32(1))
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                    ],
                    names=names,
                )
        filled = [(i, c) for i, c in enumerate(np.split(counts, _SLICES)) if c.any()]
        if filled:
            blank = [pa.nulls(len(filled), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            packed = pa.array([zlib.compress(c.tobytes(), 1) for _, c in filled], pa.binary())
            yield pa.RecordBatch.from_arrays([*blank, pa.array([i for i, _ in filled], pa.int32()), packed], names=names)

    return _keyed(docs).mapInArrow(alone(work), schema)


def _sketch(indexed: DataFrame) -> np.ndarray:
    """The counters of all tasks added up, slice by slice; the sum is 8 MB."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(packed), np.uint32)
                sums[i] = sums.get(i, 0) + counts.astype(np.int64)
        if sums:
            packed = pa.array([c.tobytes() for c in sums.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), packed], names=["slice", "sketch"])

    parts = indexed.where("slice is not null").select("slice", "sketch").repartition("slice")
    total = np.zeros((_SLICES, (1 << SKETCH_BITS) // _SLICES), np.int64)
    for row in parts.mapInArrow(alone(work), "slice int, sketch binary").collect():
        total[row[0]] += np.frombuffer(bytes(row[1]), np.int64)
    return total.reshape(-1)


def _thin(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, lowest bytes first, so that the many zero bytes stand together."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _thick(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, count).T.copy().view("<u4").reshape(-1)


class _Packer:
    """Prefix shingles of many sets, packed by bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.sets, self.shingles, self.parts, self.places, self.held = [], [], [], [], 0

    def add(self, node: bytes, size: int, central: float, shingles: np.ndarray, parts: np.ndarray) -> None:
        self.sets.append((node, size, central))
        self.shingles.append(shingles)
        self.parts.append(parts)
        self.held += len(shingles)

    def packed(self) -> Iterator[pa.RecordBatch]:
        if not self.sets:
            return
        lengths = np.array([len(s) for s in self.shingles])
        shingles, parts = np.concatenate(self.shingles), np.concatenate(self.parts)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        places = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        bucket = ((shingles >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((parts, bucket))
        key = bucket[order] * (1 << 32) + parts[order]
        edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        rows = []
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            some = order[start:end]
            own, inverse = np.unique(owner[some], return_inverse=True)
            sets = [self.sets[i] for i in own.tolist()]
            blob = b"".join(
                [
                    np.array([len(own), len(some)], "<u4").tobytes(), b"".join([s[0] for s in sets]),
                    _thin(np.array([s[1] for s in sets])), np.array([s[2] for s in sets], "<f4").tobytes(),
                    (shingles[some] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), _thin(inverse), _thin(places[some]),
                ]
            )
            rows.append((int(key[start] >> 32), int(key[start] & 0xFFFFFFFF), blob))
        self.clear()
        for start in range(0, len(rows), 256):
            some = rows[start : start + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in some], pa.int32()), pa.array([r[1] for r in some], pa.int32()), pa.array([r[2] for r in some], pa.binary())],
                names=["bucket", "part", "packed"],
            )


def _unpack(data: bytes) -> tuple:
    n, m = np.frombuffer(data[:8], "<u4").tolist()
    at = np.cumsum([8, 16 * n, 4 * n, 4 * n, 4 * m, 4 * m, 4 * m]).tolist()
    cut = [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return (
        np.frombuffer(cut[0], "V16"), _thick(cut[1], n), np.frombuffer(cut[2], "<f4"), np.frombuffer(cut[3], "<u4"),
        _thick(cut[4], m), _thick(cut[5], m),
    )


def prefixes(docs: DataFrame, sketch: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, part, packed): the prefixes of all sets, equal sets of a task once."""
    # Rarity in 16 bits is enough; the hash decides between equals.
    rarity = np.minimum(65535, np.rint(np.log2(sketch + 1) * 2048)).astype(np.uint16)
    frequent = np.log2(FREQUENT + 1) * 2048
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, seen = _Packer(buckets), set()
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                for found in shingle_sets(part.column("text")):
                    node = _digest(found)
                    if not len(found) or node in seen:
                        continue
                    seen.add(node)
                    counted = shared.value[_counters(found)]
                    size = len(found)
                    length = size - (PART * size + OF - 1) // OF + 1
                    order = np.argsort((counted.astype(np.uint64) << np.uint64(48)) | (found >> np.uint64(16)), kind="stable")[:length]
                    # As many parts as the counter is above the mark; part 0 for all others.
                    above = counted[order].astype(np.float64) - frequent
                    parts = np.zeros(length, np.int64)
                    hot = np.flatnonzero(above > 0)
                    if len(hot):
                        split = np.ceil(np.exp2(above[hot] / 2048)).astype(np.int64) + 1
                        parts[hot] = 1 + int.from_bytes(node[:6], "big") % split
                    packer.add(node, size, float(counted.mean()), found[order], parts)
                    if packer.held >= _HELD:
                        yield from packer.packed()
        yield from packer.packed()

    return _keyed(docs).select("text").mapInArrow(alone(work), "bucket int, part int, packed binary")


def _lists(packed: DataFrame, buckets: int) -> DataFrame:
    """(list, node, n, central, place): prefix shingles that more than one node has, or that were dealt in parts."""
    schema = "list long, node binary, n int, central float, place int"

    def merged(bucket: int, part: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        read = [_unpack(b) for b in blobs]
        sets = np.concatenate([r[0] for r in read])
        starts = np.cumsum([0, *[len(r[0]) for r in read]])
        sizes, central = np.concatenate([r[1] for r in read]), np.concatenate([r[2] for r in read])
        shingles = np.concatenate([r[3] for r in read])
        owner = np.concatenate([r[4].astype(np.int64) + s for r, s in zip(read, starts, strict=False)])
        places = np.concatenate([r[5] for r in read])
        # Equal sets of several tasks become one.
        _, first, number = np.unique(sets.view([("a", ">u8"), ("b", ">u8")]), return_index=True, return_inverse=True)
        owner = number.reshape(-1)[owner]
        key = np.unique(np.stack([shingles.astype(np.int64), owner, places.astype(np.int64)]), axis=1) if len(read) > 1 and len(first) < len(sets) else None
        if key is not None:
            shingles, owner, places = key
        order = np.argsort(shingles, kind="stable")
        shingles, owner, places = shingles[order], owner[order], places[order]
        same = np.zeros(len(shingles) + 1, bool)
        same[1:-1] = shingles[1:] == shingles[:-1]
        kept = np.flatnonzero(same[:-1] | same[1:] | (part > 0))
        for start in range(0, len(kept), 1 << 16):
            some = kept[start : start + (1 << 16)]
            own = first[owner[some]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shingles[some].astype(np.int64) * buckets + bucket), pa.array([bytes(x) for x in sets[own]], pa.binary()),
                    pa.array(sizes[own].astype(np.int32)), pa.array(central[own].astype(np.float32)), pa.array(places[some].astype(np.int32)),
                ],
                names=["list", "node", "n", "central", "place"],
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blobs = None, []
        for batch in batches:
            # Blobs are taken out of the batch one by one: a batch may hold tens of MB.
            for bucket, part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if (bucket, part) != at:
                    if blobs:
                        yield from merged(*at, blobs)
                    at, blobs = (bucket, part), []
                blobs.append(blob.as_py())
        if blobs:
            yield from merged(*at, blobs)

    dealt = packed.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return dealt.mapInArrow(alone(work), schema)


def _without_twins(lists: DataFrame) -> DataFrame:
    """One of all lists that have the same nodes, told by their number and sums of hashes; lists of one node go."""
    made = lists.groupBy("list").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        F.min("node").alias("low"), F.max("node").alias("high"),
    )
    one = made.where("k > 1").groupBy("k", "x", "y", "low", "high").agg(F.min("list").alias("list"))
    return lists.join(one.select("list"), "list", "left_semi")


def _passing(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a below b, of rows with a.*, b.* that pass the length and positional filter."""
    small, large = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    rest = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    most = F.least("a.place", "b.place") + rest
    # Sets of sizes n and m with a similarity of p/q share at least p (n + m) / (p + q).
    enough = (PART + OF) * most.cast("long") >= PART * (F.col("a.n") + F.col("b.n")).cast("long")
    good = pairs.where((OF * small.cast("long") >= PART * large.cast("long")) & enough)
    return good.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def _signature(shingles: np.ndarray) -> bytes:
    """How many shingles fall in each class, up to 15, two classes a byte."""
    counts = np.minimum(15, np.bincount((shingles & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)).astype(np.uint8)
    return (counts[: CLASSES // 2] | (counts[CLASSES // 2 :] << 4)).tobytes()


def _may_link(one: np.ndarray, other: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Suffix filter, row by row: could sets with these signatures and this sum of sizes be linked?"""
    low = np.minimum(one & 15, other & 15)
    high = np.minimum(one >> 4, other >> 4)
    most = low.sum(axis=1, dtype=np.int64) + high.sum(axis=1, dtype=np.int64)
    full = (low == 15).any(axis=1) | (high == 15).any(axis=1)
    return full | ((PART + OF) * most >= PART * both)


def _matrix(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint8).reshape(len(signatures), CLASSES // 2)


def _filtered(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs that pass the suffix filter."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                some = batch.slice(start, BLOCK)
                both = some.column(2).to_numpy() + some.column(3).to_numpy()
                good = pa.array(_may_link(_matrix(some.column(4).to_pylist()), _matrix(some.column(5).to_pylist()), both))
                yield pa.RecordBatch.from_arrays([some.column(i).filter(good) for i in (0, 1)], names=["a", "b"])

    sides = {end: signatures.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("signature").alias(f"s_{end}")) for end in "ab"}
    sized = pairs.join(sides["b"], "b").join(sides["a"], "a").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    return sized.mapInArrow(alone(work), "a binary, b binary")


def _all_pairs(rest: DataFrame, signatures: DataFrame) -> DataFrame:
    """Distinct pairs of each list between components that pass the length, positional and suffix filter.

    Lists of more than ``BLOCK`` nodes are cut by a hash of the node, and each pair of blocks
    is a piece of work. Pairs are looked at in the task; only those that pass leave it.
    """
    lengths = rest.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = rest.join(lengths, "list").withColumn("own", own)
    spread = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pieces = spread.select(
        "list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node", F.xxhash64("component").alias("component"), "n", "place",
    )
    dealt = pieces.join(signatures.select("node", "signature"), "node").select(
        "list", "i", "j", "side", "node", "component", "n", "place", "signature"
    )
    ordered = dealt.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")

    def passing(rows: list[tuple]) -> pa.RecordBatch | None:
        rows = sorted(rows)
        side, component, n, place = (np.array([r[k] for r in rows], np.int64) for k in (0, 2, 3, 4))
        signature = _matrix([r[5] for r in rows])
        ones, others = [], []
        split = int((side == 0).sum()) if side[-1] else 0
        for i in range(split or len(rows)):
            start = split or i + 1
            most = np.minimum(place[i], place[start:]) + np.minimum(n[i] - place[i], n[start:] - place[start:])
            both = n[i] + n[start:]
            good = (component[start:] != component[i]) & ((PART + OF) * most >= PART * both)
            good &= OF * np.minimum(n[i], n[start:]) >= PART * np.maximum(n[i], n[start:])
            at = np.flatnonzero(good) + start
            if len(at):
                at = at[_may_link(signature[i : i + 1], signature[at], n[i] + n[at])]
                ones += [i] * len(at)
                others += at.tolist()
        if not ones:
            return None
        pairs = [(min(x, y), max(x, y)) for x, y in ((rows[i][1], rows[k][1]) for i, k in zip(ones, others, strict=True))]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != at:
                    if len(held) > 1 and (out := passing(held)) is not None:
                        yield out
                    at, held = row[:3], []
                held.append(row[3:])
        if len(held) > 1 and (out := passing(held)) is not None:
            yield out

    return ordered.mapInArrow(alone(work), "a binary, b binary").distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts' sets are linked."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b", _SLICE):
                left, place = part.column("a").dictionary_encode(), part.column("text_a")
                numbers = left.indices.to_numpy()
                _, first = np.unique(numbers, return_index=True)
                ones = shingle_sets(place.take(pa.array(first)))
                good = []
                for i, other in zip(numbers.tolist(), shingle_sets(part.column("text_b")), strict=True):
                    one = ones[i]
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    good.append(100 * common >= 75 * (len(one) + len(other) - common))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    bodies = {end: texts.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}")) for end in "ab"}
    full = pairs.join(bodies["b"], "b").join(bodies["a"], "a").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(alone(exact), "a binary, b binary")


def _first_rows(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tkey, id) of one row of each of some nodes."""
    one = rows.join(nodes, "node", "left_semi").groupBy("node").agg(
        F.min(F.struct("tkey", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"))).alias("row")
    )
    return settle(one.select("node", "row.tkey", "row.id"), "jaccard_nodes")


def _texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, text) of chosen rows; repeated rows give a node more than once."""
    keyed = _keyed(docs).select("tkey", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "text")
    return join_keys(keyed, chosen, ["tkey", "id"], "inner", 64, chosen.count()).select("node", "text")


def _signatures(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, n, signature) of chosen rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_signature(s) for s in sets], pa.binary())],
                    names=["node", "n", "signature"],
                )

    return _texts_of(docs, chosen).mapInArrow(alone(work), "node binary, n long, signature binary").dropDuplicates(["node"])


def _across(lists: DataFrame, joined: DataFrame | None) -> DataFrame:
    """The lists with each node's component, without those that lie within one."""
    if joined is None:
        return lists.withColumn("component", F.col("node"))
    marked = lists.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_lists = marked.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return marked.join(open_lists.select("list"), "list", "left_semi")


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("list", F.struct("node", "n", "place", "component").alias(name))


def linked_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tkey, n, node) of all documents, and (node, component) of the nodes that are linked."""
    indexed = settle(index(docs), "jaccard_index")
    rows = indexed.where("slice is null").select("doc_id", "tkey", "n", "node")
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = min(1 << 30, total // OF // BUCKET + 1)
    lists = settle(_lists(prefixes(docs, _sketch(indexed), buckets), buckets), "jaccard_prefixes")
    lists = settle(_without_twins(lists), "jaccard_lists")
    chosen = _first_rows(rows, lists.select("node").distinct())
    signatures = settle(_signatures(docs, chosen), "jaccard_signatures")

    def links(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        some = settle(chosen.join(ends, "node", "left_semi"), "jaccard_ends")
        texts = settle(_texts_of(docs, some).dropDuplicates(["node"]), "jaccard_texts")
        return settle(_verified(pairs, texts), "jaccard_links")

    # First every node with the most central one of its lists.
    rest = _across(lists, None)
    lead = rest.groupBy("list").agg(F.max_by(F.struct("node", "n", "place", "component"), F.struct("central", "node")).alias("b"))
    star = _passing(_side(rest, "a").join(lead, "list").where("a.component <> b.component"))
    looked_at = settle(_filtered(star, signatures), "jaccard_pairs")
    edges = links(looked_at)
    # Then all pairs that lie between the components found so far.
    rest = settle(_across(lists, settle(components(edges), "jaccard_joined")), "jaccard_open")
    if not rest.isEmpty():
        fresh = _all_pairs(rest, signatures).join(looked_at, ["a", "b"], "left_anti")
        edges = edges.unionByName(links(settle(fresh, "jaccard_pairs")))
    return rows, components(edges)


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, tkey (hash of the text), n and component of every row; texts without words have none."""
    # Every table asked for more than once is written, so its shuffle files can go at once.
    with small_batches(docs.sparkSession), short_shuffles(docs.sparkSession):
        rows, joined = linked_components(docs.select("doc_id", "text"))
        return settle(
            rows.join(joined, "node", "left").select("doc_id", "tkey", "n", F.coalesce("component", "node").alias("component")), "jaccard_rows"
        )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, tkey (hash of the text), n_shingles and component_id of every row."""
    marked = _marked(docs)
    smallest = marked.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("first_id"))
    out = marked.join(smallest, "component", "left")
    return out.select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.coalesce("first_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the first by id (nulls last) and hash of the text, and all without words; no repeated rows.

    Texts are moved only if the rows to be dropped are too many to be sent to every executor.
    """
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "tkey").alias("row")
    decided = _marked(docs).groupBy(order).agg(F.count("*").alias("__n"), F.max("component").alias("component"))
    stays = decided.where("component is not null").groupBy("component").agg(F.min("row").alias("first"))
    counted = decided.join(stays, "component", "left").select(
        F.col("row.id").alias("__id"), F.col("row.tkey").alias("__tkey"), "__n",
        F.coalesce(F.col("row") > F.col("first"), F.lit(False)).alias("__drop"),
    )
    special = settle(counted.where("__drop or __n > 1"), "jaccard_dropped")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("__id"), F.xxhash64(whole("text")).alias("__tkey"),
    )
    met = join_keys(packed, special, ["__id", "__tkey"], "left", 64, special.count())
    single = met.where("__n is null").select("doc.*")
    repeated = met.where("__n is not null and not __drop").dropDuplicates(["__id", "__tkey"]).select("doc.*")
    return single.unionByName(repeated)
