"""Byte-level BPE with a given vocabulary.

``encode`` splits a text by the vocabulary's pattern and turns each piece into ids in two
tiers: a minimal perfect hash over the vocabulary finds pieces that are tokens already;
the others are merged pair by pair, lowest rank first, with a heap over a linked list of
their bytes, which looks ranks of pairs up in a plain dictionary. ``decode`` joins the bytes of the ids again,
by built-in expressions.

Nulls and empty texts have no ids and decode to no bytes; null id lists decode to no
bytes as well. ``round_trip`` does both in one pass and keeps their digests only. Rows are independent, so repeated rows come out alike, an empty table
gives an empty table, and other columns are passed through untouched. A text is worked
on as a whole, whatever its length. No special tokens are recognised.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import kept, slices, whole

#: Pieces whose ids a worker remembers unless told otherwise, twice: the latest, and those before them.
REMEMBERED = 600_000
_TRIES = 64


def _slot(hash64: int, displacement: int, size: int) -> int:
    mixed = (hash64 ^ (displacement * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    mixed = ((mixed ^ (mixed >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return (mixed ^ (mixed >> 32)) % size


def _slots(hashes: np.ndarray, displacements: np.ndarray, size: int) -> np.ndarray:
    """``_slot`` of each hash (columns) under each displacement (rows)."""
    mixed = hashes[None, :] ^ (displacements.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, and a minimal perfect hash from token to id.

    A key's bucket gives a number: from zero up, a displacement under which all keys of
    the bucket fall on slots of their own; below zero, the slot itself of a lone key.
    """

    tokens: tuple[bytes, ...]
    bucket_numbers: array
    slot_ids: array

    def find(self, piece: bytes) -> int:
        """The id of a token, -1 for other bytes."""
        if not self.tokens:
            return -1
        hash64 = xxhash.xxh3_64_intdigest(piece)
        number = self.bucket_numbers[hash64 % len(self.bucket_numbers)]
        found = self.slot_ids[-number - 1 if number < 0 else _slot(hash64, number, len(self.tokens))]
        return found if self.tokens[found] == piece else -1


def perfect_hash(tokens: Sequence[bytes]) -> Vocabulary:
    """Place every token on a slot of its own, as many slots as tokens; big buckets first."""
    size = len(tokens)
    numbers = np.zeros(max(1, size // 4), np.int64)
    hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64)
    members: dict[int, list[int]] = {}
    for i, bucket in enumerate((hashes % np.uint64(len(numbers))).tolist()):
        members.setdefault(bucket, []).append(i)
    slot_ids = np.full(size, -1, np.int64)
    by_size = sorted(members.items(), key=lambda item: (-len(item[1]), item[0]))
    for bucket, own in by_size:
        if len(own) == 1:
            continue
        first = 0
        while True:
            tried = _slots(hashes[own], np.arange(first, first + _TRIES), size)
            ordered = np.sort(tried, axis=1)
            good = (slot_ids[tried] < 0).all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                at = int(np.argmax(good))
                slot_ids[tried[at]] = own
                numbers[bucket] = first + at
                break
            first += _TRIES
    free = iter(np.flatnonzero(slot_ids < 0).tolist())
    for bucket, own in by_size:
        if len(own) == 1:
            slot = next(free)
            slot_ids[slot] = own[0]
            numbers[bucket] = -slot - 1
    return Vocabulary(tuple(tokens), array("q", numbers.tolist()), array("q", slot_ids.tolist()))


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary of a rank file: a token in base64 and its rank a line, ranks from 0 without gaps."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranked) != list(range(len(ranked))) or len(set(ranked.values())) != len(ranked):
        raise ValueError(f"{path}: ranks are not 0 to n-1, or a token is repeated")
    return perfect_hash([ranked[i] for i in range(len(ranked))])


def merge(piece: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """Ids of a piece that is no token itself.

    A part begins at its place and ends where the part it is linked to begins. The heap holds possible
    merges as one number each, made of rank, place of the left part and end of the right
    part; entries whose parts have changed since are passed over.
    """
    size, rank_of, push, pop = len(piece), ranks.get, heapq.heappush, heapq.heappop
    bits = (size + 1).bit_length()
    mask, wide = (1 << bits) - 1, 2 * bits
    following, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [rank << wide | i << bits | i + 2 for i in range(size - 1) if (rank := rank_of(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        left, until = entry >> bits & mask, entry & mask
        right = following[left]
        if right >= size or following[right] != until:
            continue
        following[left] = until
        following[right] = size + 1  # no longer a part
        if until < size:
            before[until] = left
            end = following[until]
            if (rank := rank_of(piece[left:end])) is not None:
                push(heap, rank << wide | left << bits | end)
        earlier = before[left]
        if earlier >= 0 and (rank := rank_of(piece[earlier:until])) is not None:
            push(heap, rank << wide | earlier << bits | until)
    ids, at = [], 0
    while at < size:
        ids.append(ranks[piece[at : following[at]]])
        at = following[at]
    return ids


class _Pieces(dict):
    """Ids of pieces as packed 32-bit numbers, worked out when first asked for.

    When ``remembered`` are held they become the older half, from which pieces asked for again come back.
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int):
        self.find = vocabulary.find
        self.remembered = remembered
        self.ranks = {token: i for i, token in enumerate(vocabulary.tokens)}
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode("utf-8")
            whole_id = self.find(raw)
            packed = array("i", [whole_id] if whole_id >= 0 else merge(raw, self.ranks)).tobytes()
            if len(raw) > 200:
                return packed
        if len(self) >= self.remembered:
            self.older = dict(self)
            self.clear()
        self[piece] = packed
        return packed


def _pieces_of(vocabulary: Vocabulary, remembered: int = REMEMBERED) -> _Pieces:
    """What this worker has remembered for a vocabulary; of one vocabulary at a time."""
    return kept(("bpe", vocabulary.tokens, remembered), lambda: _Pieces(vocabulary, remembered))


def encode_text(text: str, pieces: _Pieces, pattern: regex.Pattern) -> np.ndarray:
    return np.frombuffer(b"".join([pieces[piece] for piece in pattern.findall(text)]), np.int32)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: Sequence[str] = ("doc_id",),
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The columns ``keep`` and the ids of every text, in text order. ``remembered``: see ``REMEMBERED``; it takes about 200 bytes a piece."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    rows = docs.select(*[F.col(c) for c in keep], whole(text).alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, compiled = _pieces_of(shared.value, remembered), regex.compile(pattern)
        for batch in batches:
            for part in slices(batch, "__text"):
                found = [encode_text(t, pieces, compiled) for t in part.column("__text").to_pylist()]
                edges = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(f) for f in found], out=edges[1:])
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=[f.name for f in schema])

    return rows.mapInArrow(work, schema)


def round_trip(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, the number of ids of every text, and SHA-256 of the ids and of the bytes they decode to.

    Ids are spelled in decimal, with one space between. Both digests are taken where the ids are made, so neither ids nor
    decoded bytes leave the task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    rows = docs.select(*[F.col(c) for c in keep], whole(text).alias("__text"))
    hexes = [T.StructField(name, T.StringType(), False) for name in ("ids_sha256", "decoded_sha256")]
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType(), False), *hexes])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, compiled, tokens = _pieces_of(shared.value), regex.compile(pattern), shared.value.tokens
        spelled = [b"%d" % i for i in range(len(tokens))]
        digest = lambda table, ids, between: hashlib.sha256(between.join(map(table.__getitem__, ids))).hexdigest()
        for batch in batches:
            for part in slices(batch, "__text"):
                counts, of_ids, of_bytes = [], [], []
                for t in part.column("__text").to_pylist():
                    ids = encode_text(t, pieces, compiled).tolist()
                    counts.append(len(ids))
                    of_ids.append(digest(spelled, ids, b" "))
                    of_bytes.append(digest(tokens, ids, b""))
                columns = [*part.columns[:-1], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return rows.mapInArrow(work, schema)


def decode(
    encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` and the bytes that the ids stand for. An id beyond the vocabulary, or a null among the ids, is an error."""
    # In hex, as tokens need not be UTF-8 by themselves; built-in expressions, so that no second worker stands beside that which encodes.
    spelled = F.split(F.lit(",".join(token.hex() for token in load(path).tokens)), ",")
    strange = F.raise_error(F.lit(f"an id that is not in {path}")).cast("string")
    parts = F.transform(F.coalesce(ids, F.array().cast("array<int>")), lambda i: F.coalesce(F.get(spelled, i), strange))
    return encoded.select(*[F.col(c) for c in keep], F.unhex(F.array_join(parts, "")).alias(decoded))
