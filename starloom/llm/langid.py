"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; every run of 1 to 3 code points is hashed to a bucket. Training
adds the buckets up per language; the matrix of log probabilities goes to the executors,
where a text's sparse row of bucket counts is multiplied with it. Log probabilities are whole
multiples of 2^-20, so sums are exact and do not depend on order or batches.

Training reads a sample: a language with more than ``per_language`` usable rows takes part
with a share of them picked by a hash of the id, so that about that many are expected.
Rows without text or language teach nothing. Matrix size is bounded: ``CELLS`` numbers at
most, with fewer buckets if there are very many languages. Beyond ``LANGUAGES`` languages, those with most
rows are learned (ties: the first in code point order); others teach nothing and are not predicted.

A text that is null or has no letter, and any text if nothing could be learned, is
``und`` with score 0. Ties go to the language first in code point order. Long texts are
scored whole, piece by piece, in memory of a piece beside the text. Repeated rows come out alike, an empty table gives
none. Columns that are neither kept nor read do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import alone, slices, whole

UNDETERMINED = "und"
PER_LANGUAGE = 4000
GRAMS = (1, 2, 3)
CELLS = 1 << 21
LANGUAGES = 1 << 12
BUCKET_BITS = 17
_UNIT = float(1 << 20)
_PIECE = 1 << 17
#: Numbers of the matrix that are weighted at once.
_ENTRIES = 1 << 19
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    bits: int
    #: One row per bucket and one of zeros, one column per language, in units of 2^-20.
    log_probabilities: np.ndarray
    log_priors: np.ndarray


def _blocks(texts: Sequence[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Lower-cased texts cut into pieces that overlap by a gram less one, in blocks of about ``_PIECE`` code points.

    A block is the numbers of the texts and a piece for each; a long text comes in several blocks.
    """
    numbers, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        lower = text.lower()
        for begin in range(0, len(lower), _PIECE):
            piece = lower[begin : begin + _PIECE + max(GRAMS) - 1]
            if size + len(piece) > _PIECE and pieces:
                yield numbers, pieces
                numbers, pieces, size = [], [], 0
            numbers.append(i)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield numbers, pieces


def _pieces(pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The code points of pieces, how many follow in the piece from each place on (itself
    included), whether a gram that begins there belongs to the piece, and the piece of each place.
    """
    points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(c) for c in pieces], np.int64)
    places = np.arange(len(points))
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - places
    owned = places - np.repeat(ends - lengths, lengths) < _PIECE
    return points, left, owned, np.repeat(np.arange(len(lengths)), lengths)


def _buckets(points: np.ndarray, left: np.ndarray, owned: np.ndarray, size: int, bits: int) -> np.ndarray:
    """The bucket of the gram that begins at each place; the zero row's where there is none."""
    wide = points.astype(np.uint64) + np.uint64(1)
    hashed = np.full(len(points), size, np.uint64) * _FACTORS[3]
    for k in range(size):
        hashed[: len(points) - k] += wide[k:] * _FACTORS[k]
    hashed ^= hashed >> np.uint64(32)
    hashed *= _FACTORS[0]
    buckets = (hashed >> np.uint64(64 - bits)).astype(np.int32)
    buckets[(left < size) | ~owned] = 1 << bits
    return buckets


def count_rows(texts: Sequence[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sparse rows of counts: numbers of texts (in order), buckets, and how many grams of the text fell there.

    Rows come a block and gram size at a time, so a text has several, which add up.
    """
    for numbers, pieces in _blocks(texts):
        points, left, owned, piece = _pieces(pieces)
        for size in GRAMS:
            buckets = _buckets(points, left, owned, size, bits)
            here = np.flatnonzero(buckets < 1 << bits)
            found, n = np.unique(piece[here] << bits | buckets[here], return_counts=True)
            yield np.array(numbers)[found >> bits], found & ((1 << bits) - 1), n


def train(
    docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    per_language: int = PER_LANGUAGE, smoothing: float = 0.02,
) -> Model:
    """Learn from the rows for which ``usable`` holds and text and language are not null."""
    taught = docs.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull())
    counted_languages = taught.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n"))
    most = counted_languages.orderBy(F.col("n").desc(), "lang").limit(LANGUAGES + 1).collect()
    sizes = {r[0]: r[1] for r in most[:LANGUAGES]}
    languages = tuple(sorted(sizes, key=lambda s: s.encode()))
    bits = min(BUCKET_BITS, max(8, int(np.log2(CELLS / max(1, len(languages))))))
    # A share in 2^20ths, compared with a hash of id and text, as many rows may have no id.
    shares = {k: min(1 << 20, -(-per_language * (1 << 20) // n)) for k, n in sizes.items()}
    share = F.lit(1 << 20)
    if len(most) > LANGUAGES or any(s < 1 << 20 for s in shares.values()):
        # Null, and so not picked, for a language that is not learned.
        share = F.element_at(F.create_map(*[F.lit(x) for item in sorted(shares.items()) for x in item]), F.col(lang))
    picked = taught.where(F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.xxhash64(text), F.lit("langid")), F.lit(1 << 20)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                names = part.column("lang").to_pylist()
                for numbers, buckets, n in count_rows(part.column("text").to_pylist(), bits):
                    edges = [*np.flatnonzero(np.diff(numbers, prepend=-1)).tolist(), len(numbers)]
                    for begin, end in zip(edges[:-1], edges[1:], strict=True):
                        own = sums.setdefault(names[numbers[begin]], np.zeros(1 << bits, np.int64))
                        # A text's buckets in a block are distinct, but for a text of several pieces.
                        np.add.at(own, buckets[begin:end], n[begin:end])
        for name, own in sums.items():
            found = np.flatnonzero(own)
            for begin in range(0, len(found), 1 << 14):
                some = found[begin : begin + (1 << 14)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(own[some], pa.int64())],
                    names=["lang", "bucket", "n"],
                )

    rows = picked.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = rows.mapInArrow(alone(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most CELLS rows
    counts = np.zeros((len(languages), 1 << bits))
    place = {name: i for i, name in enumerate(languages)}
    rows_of = np.array([place[name] for name in found.column("lang").to_pylist()], np.int64)
    counts[rows_of, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    counts += smoothing
    logs = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    table = np.zeros(((1 << bits) + 1, len(languages)), np.int32)
    table[:-1] = np.rint(logs.T * _UNIT)
    total = max(1, sum(sizes.values()))
    priors = np.array([np.rint(np.log(sizes[name] / total) * _UNIT) for name in languages], np.int64)
    return Model(languages, bits, table, priors)


def log_likelihoods(texts: Sequence[str], model: Model) -> np.ndarray:
    """Log prior and likelihood of each text (rows) under each language, in units of 2^-20."""
    sums = np.tile(model.log_priors, (len(texts), 1))
    step = max(1, _ENTRIES // max(1, len(model.languages)))
    for numbers, buckets, n in count_rows(texts, model.bits):
        for begin in range(0, len(n), step):
            some = slice(begin, begin + step)
            weighted = model.log_probabilities[buckets[some]] * n[some, None]
            first = np.flatnonzero(np.diff(numbers[some], prepend=-1))
            sums[numbers[some][first]] += np.add.reduceat(weighted, first, axis=0, dtype=np.int64)
    return sums


def predict(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred, and score: the language's posterior probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = whole(text)
    rows = docs.select(
        *[F.col(c) for c in keep], F.when(body.rlike(r"\p{L}"), body).otherwise("").alias("__text")
    )
    schema = T.StructType(
        [*rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNDETERMINED], object)
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                texts = part.column("__text").to_pylist()
                best, score = np.full(len(texts), -1), np.zeros(len(texts))
                if known.languages:
                    logs = log_likelihoods(texts, known)
                    best = np.argmax(logs, axis=1)
                    score = 1 / np.exp((logs - logs.max(axis=1, keepdims=True)) / _UNIT).sum(axis=1)
                    nothing = np.array([not t for t in texts])
                    best[nothing], score[nothing] = -1, 0.0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(names[best], pa.string()), pa.array(score)], names=[f.name for f in schema]
                )

    return rows.mapInArrow(alone(work), schema)
