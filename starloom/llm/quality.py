"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's features are its lower-cased words, hashed, by 1 + log of their count and scaled to length
1; how its text is built (sizes, shares of kinds of characters, repetition), each as one of some
classes; and the character count that comes with it, as metadata. Pairs of features interact through
vectors of ``RANK`` numbers. With the identity

    sum over pairs of <v_i, v_j> x_i x_j  =  1/2 sum over f of (sum of v_if x_i)^2 - sum of (v_if x_i)^2

a score takes time in proportion to the number of features.

The model is fitted on at most about ``SAMPLE`` labelled rows, picked by a hash of the id; scoring reads
all whole texts. Several labels of one document count as their mean. Labels that are neither 0 nor 1,
and documents without a label, teach nothing. If one class is missing, every score is the smoothed
share of 1s. Null and empty texts have the classes of an empty text; a null
character count is a class of its own. Repeated rows score alike, an empty table gives none.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import slices, whole
from starloom.sources.warehouse import settle

SAMPLE = 4000
WORD_BUCKETS = 1 << 14
RANK = 6
THRESHOLD = 0.7
_CLASSES = 32
_STATISTICS = 12
SIZE = WORD_BUCKETS + _CLASSES * _STATISTICS
_EDGES = np.array([0.002, 0.005, 0.01, 0.015, 0.02, 0.025, 0.03, 0.04, 0.05, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97, 1.0])


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point below 65536: 1 letter, 2 of them upper case, 4 digit, 8 white space."""
    chars = [chr(i) for i in range(1 << 16)]
    return np.array([c.isalpha() + 2 * c.isupper() + 4 * c.isdigit() + 8 * c.isspace() for c in chars], np.uint8)


def _size_class(n: float) -> int:
    return min(_CLASSES - 1, int(2 * np.log2(1 + n)) // 2)


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text."""
    words = text.lower().split()
    counts = Counter(words)
    hashed: dict[int, float] = {}
    for word, n in counts.items():
        bucket = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_BUCKETS
        hashed[bucket] = hashed.get(bucket, 0) + n
    places = np.fromiter(hashed, np.int32, len(hashed))
    values = 1 + np.log(np.fromiter(hashed.values(), np.float32, len(hashed)))
    if len(values):
        values /= np.sqrt((values * values).sum())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(_kinds()[np.minimum(points, 0xFFFF)], minlength=16) if len(points) else np.zeros(16, int)
    size, letters, spaces = len(points), kinds[[1, 3, 5, 7]].sum(), kinds[8:].sum()
    lines = [line for line in text.split("\n") if line]
    share = lambda part, of: int(np.searchsorted(_EDGES, part / of)) if of else _CLASSES - 1
    classes = (
        _size_class(len(words)),
        _size_class(size),
        min(_CLASSES - 1, int(2 * letters / len(words))) if words else _CLASSES - 1,
        share(size - letters - spaces - kinds[[4, 5, 6, 7]].sum(), size),
        share(kinds[[2, 3, 6, 7]].sum(), max(1, letters)),
        share(kinds[[4, 5, 6, 7]].sum(), size),
        share(len(counts), len(words)),
        share(max(counts.values(), default=0), len(words)),
        share(len(set(lines)), len(lines)),
        _size_class(size / len(lines)) if lines else _CLASSES - 1,
        share(sum(1 for w in counts if not w[-1].isalnum()), len(counts)),
        _CLASSES - 1 if n_chars is None else _size_class(max(0, n_chars)),
    )
    numbers = WORD_BUCKETS + _CLASSES * np.arange(_STATISTICS, dtype=np.int32) + np.array(classes, np.int32)
    return (
        np.concatenate([places, numbers]).astype(np.int32),
        np.concatenate([values, np.full(_STATISTICS, 0.5, np.float32)]).astype(np.float32),
    )


def _raw(model: Model, places: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Scores before the logistic function of documents whose features begin at ``starts``."""
    scaled = model.factors[places] * values[:, None]
    sums = np.add.reduceat(scaled, starts, axis=0)
    squares = np.add.reduceat(scaled * scaled, starts, axis=0)
    linear = np.add.reduceat(model.weights[places] * values, starts)
    return model.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def _chance(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(places: np.ndarray, values: np.ndarray, starts: np.ndarray, wanted: np.ndarray, rounds: int = 40, rate: float = 0.1) -> Model:
    """Logistic loss, whole-sample Adam steps from a fixed start."""
    share = (wanted.sum() + 1) / (len(wanted) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(wanted) == 0 or wanted.min() == wanted.max():
        return Model(bias, np.zeros(SIZE), np.zeros((SIZE, RANK)))
    # Column 0 is the weight, the others the factors. Only features of the sample are learned.
    used, places = np.unique(places, return_inverse=True)
    learned = np.random.default_rng(1).normal(0, 0.05, (len(used), 1 + RANK))
    learned[:, 0] = 0
    lengths = np.diff(np.append(starts, len(places)))
    # Features in order, so that sums per feature are sums of neighbours.
    by_feature = np.argsort(places, kind="stable")
    first = np.flatnonzero(np.diff(places[by_feature], prepend=-1))
    owner = np.repeat(np.arange(len(starts)), lengths)
    mean, square = np.zeros_like(learned), np.zeros_like(learned)
    for step in range(1, rounds + 1):
        scaled = learned[places] * values[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(scaled[:, 1:] ** 2, starts, axis=0)
        raw = bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(axis=1)
        pull = (_chance(raw) - wanted) / len(wanted)
        sums[:, 0], scaled[:, 0] = 1, 0  # a weight's own slope is the value alone
        slopes = (sums[owner] - scaled) * (pull[owner] * values)[:, None]
        slope = np.add.reduceat(slopes[by_feature], first, axis=0) + 1e-5 * learned
        bias -= rate * float(pull.sum())
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope * slope - square)
        learned -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights, factors = np.zeros(SIZE), np.zeros((SIZE, RANK))
    weights[used], factors[used] = learned[:, 0], learned[:, 1:]
    return Model(bias, weights, factors)


def _columns(docs: DataFrame, text: str, n_chars: str) -> tuple[Column, Column]:
    return whole(text).alias("__text"), F.col(n_chars).cast("long").alias("__chars")


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, text: str = "text", n_chars: str = "n_chars",
    doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE,
) -> Model:
    """Learn from the labels for whose ids ``usable`` holds."""
    marked = labels.where(usable & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    known = marked.groupBy(F.col(doc_id).alias("__id")).agg(F.avg(label).alias("__wanted"))
    n = known.count()
    share = min(1 << 20, -(-sample * (1 << 20) // max(1, n)))
    picked = settle(known.where(F.pmod(F.xxhash64("__id", F.lit("quality")), F.lit(1 << 20)) < share), "quality_sample")
    # About ``sample`` rows, so they can go to every executor; of an id's rows, the one with the smallest hash is learned from.
    rows = docs.join(F.broadcast(picked), F.col(doc_id) == F.col("__id")).select("__id", "__wanted", *_columns(docs, text, n_chars))
    first = F.min(F.struct(F.xxhash64("__text").alias("hash"), "__text", "__chars", "__wanted")).alias("row")
    texts = rows.groupBy("__id").agg(first).select("__id", "row.__wanted", "row.__text", "row.__chars")
    schema = "id long, wanted double, places array<int>, values array<float>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                made = [features(*x) for x in zip(part.column("__text").to_pylist(), part.column("__chars").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()), part.column(1),
                        pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.float32())),
                    ],
                    names=["id", "wanted", "places", "values"],
                )

    found = texts.mapInArrow(work, schema).toArrow().combine_chunks()
    # Rows in an order of their own, as sums of fractions depend on it.
    rows = sorted(zip(found["id"].to_pylist(), found["wanted"].to_pylist(), range(len(found)), strict=True))
    lists = found["places"].combine_chunks() if len(found) else None
    places = [np.asarray(lists[i].values) for _, _, i in rows]
    values = [np.asarray(found["values"][i].values, np.float64) for _, _, i in rows]
    starts = np.cumsum([0, *[len(p) for p in places]])[:-1]
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return fit(join(places, np.int32), join(values, np.float64), starts, np.array([w for _, w, _ in rows]))


def score(docs: DataFrame, model: Model, text: str = "text", n_chars: str = "n_chars", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, score, and predicted: 1 from ``THRESHOLD`` on."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(c) for c in keep], *_columns(docs, text, n_chars))
    schema = T.StructType(
        [*rows.schema.fields[:-2], T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch, "__text"):
                made = [features(*x) for x in zip(part.column("__text").to_pylist(), part.column("__chars").to_pylist(), strict=True)]
                starts = np.cumsum([0, *[len(p) for p, _ in made]])[:-1]
                chance = _chance(_raw(known, np.concatenate([p for p, _ in made]), np.concatenate([v for _, v in made]), starts))
                predicted = (chance >= THRESHOLD).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], pa.array(chance), pa.array(predicted)], names=[f.name for f in schema]
                )

    return rows.mapInArrow(work, schema)
