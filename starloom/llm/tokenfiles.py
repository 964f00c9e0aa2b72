"""Token ids in binary files of patched frame-of-reference blocks.

``write`` deals texts out by ranges of the id, sorted; each task encodes its texts with the tokenizers library and
appends their ids, each text closed by an end id, to files of the format below. ``read`` gives every document back
with its place in the stream of all ids.

A file is one stream of ids, cut into blocks of ``BLOCK``. Of a block the minimum is subtracted; the rest is packed at the
width that ``PERCENTILE`` of its values need. What the others have above that width stands in an exception list (positions, then
upper bits) behind the packed words. The footer has where each block starts, so any stretch of ids is read from
its own blocks, and the ids and lengths of the documents.

    magic | blocks | block starts (u64, one more than blocks) | document ids (i64) | their nulls (u8) | lengths (u64) | tail
    block: minimum u32, width u8, 0 u8, exceptions u16 | packed words u32 | positions u16 | upper bits u32
    tail: blocks u64, documents u64, ids u64, magic

Texts are cut into words before the library sees them, at ASCII white space and between letters or digits and the ASCII punctuation
behind them (apostrophes apart): no token of the vocabularies meant here crosses these places, and words that repeat are then
encoded once (a worker remembers ``REMEMBERED`` to twice as many). Tokenizers for which this does not hold must be given ``by_word=False``,
which encodes texts as they are. Words of letters go straight to the library's model, each letter as its normaliser and
pre-tokeniser turn it out. Strings of special tokens are recognised as the library does by default.

Null and empty texts are an end id alone. Null ids come first; rows of one id go by a hash of the text, then by text, and
may be spread over tasks. Repeated rows are written each. An empty table gives an empty manifest. Other columns are not read. A text must
fit into memory; its ids are packed bit by bit of ``PIECE``. Files are written under temporary names, renamed by a second job,
and count once the manifest, written last, names them; so lost tasks and second attempts leave stray files at most.
"""

from __future__ import annotations

import hashlib
import os
import re
import string
import struct
import uuid
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import alone, give_back, kept, slices, small_batches, whole
from starloom.sources.warehouse import new_folder, settle

MAGIC = b"SLIDPF1\n"
BLOCK = 512
#: This part of a block's values fits its width; the others are exceptions.
PERCENTILE = 0.98
#: Ids held before they are packed, and ids after which a file is closed.
PIECE = 1 << 18
FILE_IDS = 1 << 24
#: Bytes of text that a task gets.
RANGE_BYTES = 24 << 20
#: Words remembered, and once more as many older ones; some 190 bytes each in every worker of an executor.
REMEMBERED = 150_000
#: Words: letters (of ASCII and Latin-1) and digits that punctuation follows, or all up to white space.
WORD = re.compile(rb"[A-Za-z0-9\xc3\x80-\x96\x98-\xb6\xb8-\xbf]++(?=[!-&(-/:-@\[-`{-~])|\S+")
#: Letters below this code point may go straight to the model.
LETTERS = 0x250
_LANES = 32
_TAIL = struct.Struct("<QQQ8s")
_HEAD = struct.Struct("<IBBH")
_MANIFEST = "shard int, number int, file string, temporary string, docs long, ids long, bytes long, sha256 string"


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` numbers below 2 ** width, as rows of 32-bit words."""
    lanes = np.ascontiguousarray(values.reshape(-1, _LANES).T)
    out = np.zeros((width, lanes.shape[1]), np.uint32)
    for j in range(_LANES if width else 0):
        word, shift = divmod(j * width, 32)
        out[word] |= lanes[j] << np.uint32(shift)
        if shift + width > 32:
            out[word + 1] |= lanes[j] >> np.uint32(32 - shift)
    return np.ascontiguousarray(out.T).reshape(len(values), -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """What ``pack`` was given."""
    rows = len(words)
    if not width:
        return np.zeros((rows, BLOCK), np.uint32)
    lanes = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.empty((_LANES, lanes.shape[1]), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for j in range(_LANES):
        word, shift = divmod(j * width, 32)
        out[j] = lanes[word] >> np.uint32(shift)
        if shift + width > 32:
            out[j] |= lanes[word + 1] << np.uint32(32 - shift)
    return np.ascontiguousarray((out & mask).T).reshape(rows, BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """A whole number of blocks of 32-bit ids, as bytes each."""
    rows = ids.astype(np.uint32).reshape(-1, BLOCK)
    least = rows.min(axis=1)
    above = rows - least[:, None]
    cut = min(BLOCK - 1, max(0, int(np.ceil(PERCENTILE * BLOCK)) - 1))
    widths = np.ceil(np.log2(np.partition(above, cut, axis=1)[:, cut].astype(np.float64) + 1)).astype(np.int64)
    upper = (above.astype(np.uint64) >> widths[:, None].astype(np.uint64)).astype(np.uint32)
    block, position = np.nonzero(upper)
    edges = np.searchsorted(block, np.arange(len(rows) + 1))
    position, high = position.astype("<u2"), upper[block, position].astype("<u4")
    packed: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        words = pack(above[own] & np.uint32((1 << width) - 1), width).astype("<u4")
        for i, row in zip(own.tolist(), words, strict=True):
            packed[i] = row.tobytes()
    out = []
    for i, (low, width) in enumerate(zip(least.tolist(), widths.tolist(), strict=True)):
        a, b = edges[i], edges[i + 1]
        out.append(b"".join((_HEAD.pack(low, width, 0, b - a), packed[i], position[a:b].tobytes(), high[a:b].tobytes())))
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks; ``starts`` has where each begins in ``data``, and where the last ends."""
    count = len(starts) - 1
    heads = [_HEAD.unpack_from(data, s) for s in starts[:-1].tolist()]
    widths = np.array([h[1] for h in heads], np.int64)
    out = np.empty((count, BLOCK), np.uint32)
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        size = BLOCK * width // 8
        words = np.frombuffer(b"".join([data[s : s + size] for s in (starts[own] + _HEAD.size).tolist()]), "<u4")
        out[own] = unpack(words.reshape(len(own), -1) if width else np.zeros((len(own), 0), np.uint32), width)
    for i, (_, width, _, n) in enumerate(heads):
        if n:
            at = int(starts[i]) + _HEAD.size + BLOCK * width // 8
            position = np.frombuffer(data, "<u2", n, at)
            out[i, position] |= np.frombuffer(data, "<u4", n, at + 2 * n) << np.uint32(width)
    out += np.array([h[0] for h in heads], np.uint32)[:, None]
    return out.reshape(-1)


class _File:
    """One file being written."""

    def __init__(self, folder: str, shard: int, number: int):
        system, path = fs.FileSystem.from_uri(folder)
        self.shard, self.number, self.name = shard, number, f"part-{shard:08d}-{number:05d}.ids"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        self.out, self.digest, self.size = system.open_output_stream(f"{path}/{self.temporary}", compression=None), hashlib.sha256(), 0
        self.starts, self.docs, self.lengths, self.ids = [], [], [], 0
        self.held: list[np.ndarray] = []
        self.held_ids = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.ids += len(ids)
        for start in range(0, len(ids), PIECE):
            part = ids[start : start + PIECE]
            self.held.append(part)
            self.held_ids += len(part)
            if self.held_ids >= PIECE:
                self._blocks(self.held_ids // BLOCK * BLOCK)

    def _blocks(self, count: int) -> None:
        held = np.concatenate(self.held)
        for block in encode_blocks(held[:count]) if count else []:
            self.starts.append(self.size)
            self._put(block)
        self.held, self.held_ids = [held[count:]], len(held) - count

    def close(self) -> tuple:
        if self.held_ids:
            self.held.append(np.full(-self.held_ids % BLOCK, self.held[-1][-1]))
            self.held_ids += len(self.held[-1])
            self._blocks(self.held_ids)
        self.starts.append(self.size)
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array([0 if d is None else d for d in self.docs], "<i8").tobytes())
        self._put(np.array([d is None for d in self.docs], np.uint8).tobytes())
        self._put(np.array(self.lengths, "<u8").tobytes())
        self._put(_TAIL.pack(len(self.starts) - 1, len(self.docs), self.ids, MAGIC))
        self.out.close()
        return (self.shard, self.number, self.name, self.temporary, len(self.docs), self.ids, self.size, self.digest.hexdigest())


class Footer:
    """What stands behind the blocks of a file."""

    def __init__(self, file, name: str):
        size = file.size()
        tail = file.read_at(_TAIL.size, size - _TAIL.size) if size >= _TAIL.size + len(MAGIC) else b""
        blocks, docs, self.ids, magic = _TAIL.unpack(tail) if len(tail) == _TAIL.size else (0, 0, 0, b"")
        rest = 8 * (blocks + 1) + 17 * docs
        if magic != MAGIC or size < rest + _TAIL.size + len(MAGIC) or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name} is no file of ids, or cut off")
        data = file.read_at(rest, size - _TAIL.size - rest)
        self.starts = np.frombuffer(data, "<u8", blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.nulls = np.frombuffer(data, np.uint8, docs, at + 8 * docs).astype(bool)
        self.edges = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64))])


def ids_at(file, footer: Footer, start: int, count: int) -> np.ndarray:
    """``count`` ids of a file from its ``start``-th on, read from their own blocks only."""
    if count <= 0:
        return np.zeros(0, np.uint32)
    first, last = start // BLOCK, (start + count - 1) // BLOCK
    begin, end = int(footer.starts[first]), int(footer.starts[last + 1])
    found = decode_blocks(file.read_at(end - begin, begin), footer.starts[first : last + 2] - begin)
    return found[start - first * BLOCK : start - first * BLOCK + count]


class _Words(dict):
    """Ids of words as packed numbers, worked out when first asked for.

    When ``REMEMBERED`` are held they become the older half, from which words asked for again come back.
    """

    def __init__(self, model: str, end_id: int, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.by_word = Tokenizer.from_str(model), by_word
        self.tokens = self.library.model.tokenize
        self.code = "H" if max(self.library.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        self.end = np.array([end_id], self.kind).tobytes()
        self.older: dict[bytes, bytes] = {}
        # What the library makes of each letter before its model sees it, where that is one piece.
        self.letters = {}
        normal, cut = self.library.normalizer, self.library.pre_tokenizer
        for letter in map(chr, range(0x41, LETTERS if by_word and normal is not None and cut is not None else 0)):
            if letter.isalpha() and len(pieces := cut.pre_tokenize_str(2 * normal.normalize_str(letter))) == 1:
                self.letters[ord(letter)] = pieces[0][0][: len(pieces[0][0]) // 2]
        self.only_letters = re.compile("[" + "".join(map(chr, self.letters)) + "]+" if self.letters else "(?!)").fullmatch
        # Words of ASCII letters are turned out as bytes, if each letter gives one ASCII character.
        made = {i: self.letters[i] for i in string.ascii_letters.encode() if len(self.letters.get(i, "")) == 1 and self.letters[i].isascii()}
        self.ascii = bytes(ord(made.get(i, chr(i))) for i in range(256)) if len(made) == len(string.ascii_letters) else None

    def __missing__(self, word: bytes) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            if self.ascii and word.isalpha():
                ids = [t.id for t in self.tokens(word.translate(self.ascii).decode("ascii"))]
            elif self.only_letters(text := word.decode("utf-8", "replace")):
                ids = [t.id for t in self.tokens(text.translate(self.letters))]
            else:
                ids = self.library.encode(text, add_special_tokens=False).ids
            packed = array(self.code, ids).tobytes()
            if len(word) > 64:
                return packed
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = packed
        return packed

    def ids_of(self, text: bytes) -> np.ndarray:
        words = WORD.findall(text) if self.by_word else [text] * bool(text)
        return np.frombuffer(b"".join([*map(self.__getitem__, words), self.end]), self.kind)


def _words_of(model: str, end_id: int, by_word: bool) -> _Words:
    """What this worker has remembered for a tokenizer; of one tokenizer at a time."""
    return kept(("tokenfiles", model, end_id, by_word), lambda: _Words(model, end_id, by_word))


def _full_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def write(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, file_ids: int = FILE_IDS, by_word: bool = True
) -> str:
    """Write the ids of all (doc_id, text) rows, in ascending order of id, and their manifest; gives the folder back.

    ``tokenizer`` is the path of a tokenizers file, read by the driver.
    """
    spark = docs.sparkSession
    folder = _full_uri(folder or new_folder(spark, "ids"))
    model = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 16).cast("long")).first()[0] or 0
    tie = rows.select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    dealt = tie.repartitionByRange(total // RANGE_BYTES + 1, "doc_id", "tie", "row")
    ordered = dealt.sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{path}/_temporary", recursive=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, number, file, done = _words_of(model.value, end_id, by_word), TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for part in slices(batch, "text"):
                found = map(words.ids_of, part.column("text").cast(pa.large_binary()).to_pylist())
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), found, strict=True):
                    if file is None:
                        file, number = _File(folder, shard, number), number + 1
                    file.add(doc_id, ids)
                    if file.ids >= file_ids:
                        done.append(file.close())
                        file = None
        if file is not None:
            done.append(file.close())
        if done:
            yield _rows(done, _MANIFEST)
        give_back()

    with small_batches(spark):
        reported = settle(ordered.mapInArrow(work, _MANIFEST), "ids_report")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("file").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                    system.move(f"{path}/{temporary}", f"{path}/{name}")
            yield batch

    reported.mapInArrow(alone(commit), _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _TYPES[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def files(spark: SparkSession, folder: str, bucket: int = 1024) -> DataFrame:
    """The manifest, with ``start``: the ids in all files before.

    Sums go by buckets of ``bucket`` shards first, so no window holds more than a bucket's files, or one row a bucket.
    """
    listed = spark.read.schema(_MANIFEST).parquet(f"{_full_uri(folder)}/manifest").withColumn("bucket", F.floor(F.col("shard") / bucket))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = listed.groupBy("bucket").agg(F.sum("ids").alias("n"))
    starts = sums.select("bucket", F.coalesce(F.sum("n").over(before(Window.orderBy("bucket"))), F.lit(0)).alias("bucket_start"))
    inside = F.sum("ids").over(before(Window.partitionBy("bucket").orderBy("shard", "number")))
    placed = listed.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, "bucket")
    return placed.withColumn("start", F.col("bucket_start") + F.col("inside")).drop("bucket", "bucket_start", "inside", "temporary")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian 32-bit numbers in a binary) of every document, from the files.

    A file that differs from its digest in the manifest, or is malformed, is refused.
    """
    folder = _full_uri(folder)
    schema = "doc_id long, start long, n_tokens long, ids binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base, wanted in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "sha256")), strict=True):
                with system.open_input_file(f"{path}/{name}") as file:
                    digest = hashlib.sha256()
                    for at in range(0, file.size(), 1 << 22):
                        digest.update(file.read_at(min(1 << 22, file.size() - at), at))
                    if digest.hexdigest() != wanted:
                        raise ValueError(f"{name} differs from the manifest")
                    footer = Footer(file, name)
                    first, docs = 0, len(footer.doc_ids)
                    while first < docs:
                        # As many documents as have about a piece of ids, one at least.
                        last = max(first + 1, int(np.searchsorted(footer.edges, footer.edges[first] + PIECE, "right")) - 1)
                        edges = footer.edges[first : last + 1]
                        ids = ids_at(file, footer, int(edges[0]), int(edges[-1] - edges[0])).astype("<u4")
                        cuts = edges - edges[0]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(footer.doc_ids[first:last], mask=footer.nulls[first:last]),
                                pa.array(edges[:-1] + base),
                                pa.array(np.diff(edges)),
                                pa.array([ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )
                        first = last

    listed = files(spark, folder).select("file", "start", "sha256")
    # A file a task, or as many files a task as there are tasks.
    return listed.repartition(max(1, min(listed.count(), 1 << 16)), "file").mapInArrow(alone(work), schema)
