"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed with a rolling polynomial. Of each ``WINDOW`` neighbouring hashes
the smallest is kept, the rightmost one of ties, with its position. So two texts that share
``GRAM + WINDOW - 1`` code points share a kept hash of that passage, wherever it stands.

A text shorter than a gram is one gram, an empty or null text has an empty fingerprint. Equal texts have equal
fingerprints. Texts with fewer windows keep their smallest hash. Long texts are hashed piece by piece.
Likeness is the share of common hashes among all of two fingerprints; two empty ones are alike (1).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import id_ranges, mix64, range_of, slices, whole

#: Both are powers of two, so that hashes and minima grow by doubling.
GRAM = 16
WINDOW = 32
_FACTOR = 0x9E3779B97F4A7C15
_PIECE = 1 << 20
_RANGE_BYTES = 24 << 20


def _grams(points: np.ndarray) -> np.ndarray:
    """The hash of every gram: twice as long a gram is the first half's hash times a power, plus the second's."""
    hashes, size, factor = points.astype(np.uint64) + np.uint64(1), 1, _FACTOR
    while size < GRAM:
        hashes = hashes[:-size] * np.uint64(factor) + hashes[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    return mix64(hashes) >> np.uint64(32)


def winnow(text: str) -> np.ndarray:
    """Kept hashes with their positions, in order: hash in the upper 32 bits, position below."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = len(points)
    if size == 0:
        return np.zeros(0, np.uint64)
    if size < GRAM:
        points = np.concatenate([points, np.full(GRAM - size, 0xFFFFFFF0 + size, np.uint32)])
        size = GRAM
    last = np.uint64(0xFFFFFFFF)
    kept, before = [], None
    for start in range(0, max(1, size - GRAM - WINDOW + 2), _PIECE):
        grams = _grams(points[start : start + _PIECE + GRAM + WINDOW - 2])
        # The later place is the smaller number, so the rightmost of equal hashes wins.
        least = (grams << np.uint64(32)) | (last - np.arange(start, start + len(grams), dtype=np.uint64))
        width = 1
        while width < WINDOW and len(least) > width:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < WINDOW:
            least = least.min(keepdims=True)
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[0] = before is None or least[0] != before
        before = least[-1]
        kept.append(least[new])
    found = np.concatenate(kept)
    return (found & ~last) | (last - (found & last))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    a, b = (np.unique(x >> np.uint64(32)) for x in (one, other))
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def spell(fingerprint: np.ndarray) -> str:
    """The fingerprint as text: base64 of big-endian 64-bit numbers, hash and position each 32 bits."""
    return base64.b64encode(fingerprint.astype(">u8").tobytes()).decode()


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row packed in ``doc``, with ``marks``: its (hash, position) pairs."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), whole(f"`{text}`").alias("__text"))
    pair = T.StructType([T.StructField("hash", T.LongType()), T.StructField("position", T.LongType())])
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("marks", T.ArrayType(pair), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                found = [winnow(t) for t in part.column("__text").to_pylist()]
                edges = pa.array(np.cumsum([0, *[len(f) for f in found]]).astype(np.int32))
                all_found = np.concatenate(found) if found else np.zeros(0, np.uint64)
                pairs = pa.StructArray.from_arrays(
                    [pa.array((all_found >> np.uint64(32)).astype(np.int64)), pa.array((all_found & np.uint64(0xFFFFFFFF)).astype(np.int64))],
                    names=["hash", "position"],
                )
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(edges, pairs)], names=["doc", "marks"])

    return rows.mapInArrow(work, schema)


def _with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows in descending order of id within ranges, each range followed by the row that comes after it.

    Columns: place (of the range, falling), extra (1 for the row borrowed from the range
    below, or from the top for the lowest), doc_id, text; and the number of ranges.
    """
    sized = docs.select(F.col("doc_id").alias("id"), (F.octet_length("text") + 64).cast("long").alias("weight"))
    edges = id_ranges(sized, _RANGE_BYTES)
    # Range 0 is for null ids, which come last in descending order.
    placed = docs.select((range_of("doc_id", edges) + 1).cast("int").alias("place"), F.lit(0).alias("extra"), "doc_id", "text")
    # One row a range, so at most as many as there can be edges, and two.
    heads = dict(placed.groupBy("place").agg(F.max("doc_id")).collect())
    falling = sorted(heads, reverse=True)
    after = [(place, heads[following]) for place, following in zip(falling, falling[1:] + falling[:1], strict=True)]
    wanted = docs.sparkSession.createDataFrame(after, "place int, head long") if after else None
    if wanted is None:
        return placed, 1
    first = docs.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("head")))
    borrowed = first.groupBy("place").agg(F.min("text").alias("text"), F.max("head").alias("doc_id"))
    both = placed.unionByName(borrowed.select("place", F.lit(1).alias("extra"), "doc_id", "text"))
    return both, len(edges) + 2


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every (doc_id, text) row and of its edited text.

    The text that follows is that of the next smaller id, for the smallest id that of the
    largest; rows of one id follow each other by text, null ids come last. Texts are moved once,
    by ranges of the id, and each task walks down its ranges with one row in hand.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    rows, ranges = _with_next(docs)
    ordered = rows.repartitionById(ranges, "place").sortWithinPartitions(
        F.col("place").desc(), "extra", F.col("doc_id").desc_nulls_last(), "text"
    )
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = [f.split()[0] for f in schema.split(", ")]

    def result(doc_id, text: str, marks: np.ndarray, following: str, next_marks: np.ndarray) -> tuple:
        changed = edited(text, following)
        changed_marks = winnow(changed)
        return (
            doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), spell(marks),
            spell(changed_marks), likeness(marks, changed_marks), likeness(marks, next_marks),
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                out = []
                for extra, doc_id, text in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    marks = winnow(text)
                    if held is not None:
                        out.append(result(*held, text, marks))
                    held = None if extra else (doc_id, text, marks)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names
                    )
        assert held is None, "a range lacks the row that follows it"

    return ordered.mapInArrow(work, schema)
