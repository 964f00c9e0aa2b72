"""Phrases whose words occur together more often than their parts let expect.

Texts are lower-cased (A-Z), cut into pieces at ``BREAKS`` and these into words at blanks; everything is counted per language.
A candidate is a phrase of 2 to ``LONGEST`` words found ``LEAST`` times or more in pieces, overlaps included.

Every n-gram is hashed from prefix polynomials: bytes times powers of one odd factor are added up modulo 2 ** 64, so the
hash of any stretch is a difference of two sums, shifted back by an inverse power. Tasks count hashes of their texts, and shuffles
add them up, in three scans of the texts:

1. words and pairs;
2. triples and quadruples whose pairs can all be frequent;
3. n-grams that can be frequent, now with a pointer to an occurrence (document hash and word number) and the text behind it. Inside a task
   the bytes of all occurrences of a hash are compared with each other, and over tasks rows are put together by text, so that
   different phrases of one hash are told apart and counted for themselves. Only frequent phrases become rows.

"Can be frequent" is a bit of a filter of ``2 ** FILTER_BITS`` bits, set by hashes counted ``LEAST`` times, so it is of one size for any
corpus; bits set by others cost rows and lose nothing, as parts of a frequent phrase are as frequent as it is. The
first two shuffles carry no pointers: nearly all of their rows are rare n-grams, and a pointer would make them half as large again.

Null languages count as ``UNKNOWN``, together with a language of that name. Null and empty texts have no words. A long text is hashed
stretch by stretch, however few breaks it has; a single word must fit into memory. Equal scores go by count, then by phrase in byte order.
Repeated rows count again. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import mix64, slices, whole
from starloom.sources.warehouse import settle

BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST = 4
LEAST = 30
UNKNOWN = "und"
FILTER_BITS = 27
#: A candidate goes if a longer one that holds it has this share of its count, in percent.
COVERED = 80
SCALE = 2_000_000
TOP = 2000
#: Bytes of text hashed at a time.
CHUNK = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15
_BACK = pow(_FACTOR, -1, 1 << 64)
_SALTS = 64
_PAGE = 1 << 15  # bits of one row of bitmap_construct_agg

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = re.compile(b"[" + re.escape(BLANKS + BREAKS) + b"]")
_WORDS_ON = re.compile(rb"(?:[%b]*[^%b]+){0,%d}" % (re.escape(BLANKS + BREAKS), re.escape(BLANKS + BREAKS), LONGEST - 1))

_powers: dict[int, np.ndarray] = {}


def _powers_of(factor: int, count: int) -> np.ndarray:
    """The first ``count`` powers modulo 2 ** 64, kept for the next chunk."""
    known = _powers.get(factor)
    if known is None or len(known) < count:
        steps = np.full(max(count, CHUNK + (CHUNK >> 2)), factor, np.uint64)
        steps[0] = 1
        known = _powers[factor] = np.cumprod(steps, dtype=np.uint64)
        if count > 2 * CHUNK:
            del _powers[factor]
    return known[:count]


@dataclass
class Stretch:
    """Words of some texts in order, in a buffer that has one blank behind each.

    ``starts`` and ``ends`` are places in the buffer, ``left`` the number of words from a word to the end of its piece, ``docs`` the text of each word, ``numbers`` its
    place in the text; only n-grams that start at the first ``own`` words count, the words behind belong to the next stretch.
    """

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    left: np.ndarray
    docs: np.ndarray
    numbers: np.ndarray
    own: int

    def hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all n-grams, and the polynomial hash of each."""
        if not hasattr(self, "_sums"):
            size = len(self.buffer)
            self._sums = np.zeros(size + 1, np.uint64)
            np.cumsum((self.buffer.astype(np.uint64) + np.uint64(1)) * _powers_of(_FACTOR, size), out=self._sums[1:])
            self._shift = _powers_of(_BACK, size + 1)[self.starts]
        first = np.flatnonzero(self.left[: self.own] >= n)
        return first, (self._sums[self.ends[first + n - 1]] - self._sums[self.starts[first]]) * self._shift[first]

    def text(self, first: int, n: int) -> bytes:
        return self.buffer[self.starts[first] : self.ends[first + n - 1]].tobytes()


def _stretch(raw: bytes, own_bytes: int, edges: np.ndarray, base: int) -> Stretch:
    """Words of ``raw``; texts begin at ``edges``, and the first has had ``base`` words before."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    kind = _KIND[data]
    word = kind == 0
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word
    starts = np.flatnonzero(word & ~inside[:-2])
    ends = np.flatnonzero(word & ~inside[2:]) + 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    count = len(starts)
    last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True)) if count else np.zeros(0, np.int64)
    left = last[np.searchsorted(last, np.arange(count))] - np.arange(count) + 1 if count else last
    lengths = ends - starts
    new_starts = np.cumsum(lengths + 1) - lengths - 1
    # One blank behind each word, also behind the last.
    keep = word.copy()
    keep[ends[ends < len(data)]] = True
    buffer = data[keep]
    if count and ends[-1] == len(data):
        buffer = np.append(buffer, np.uint8(32))
    buffer[new_starts + lengths] = 32
    docs = np.searchsorted(edges, starts, "right") - 1
    first_of_doc = np.searchsorted(docs, np.arange(len(edges)))
    numbers = np.arange(count) - first_of_doc[docs]
    if base:
        numbers[docs == 0] += base
    return Stretch(buffer, new_starts, new_starts + lengths, left, docs, numbers, int(np.searchsorted(starts, own_bytes)))


def stretches(texts: list[bytes]) -> Iterator[Stretch]:
    """The texts as one stretch, or several if they are longer than two chunks."""
    raw = b"\n".join(texts) + b"\n"
    edges = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
    if len(raw) <= 2 * CHUNK:
        yield _stretch(raw, len(raw), edges, 0)
        return
    at, base = 0, 0
    while at < len(raw):
        found = _SEPARATOR.search(raw, min(at + CHUNK, len(raw) - 1))
        end = found.end() if found else len(raw)
        beyond = _WORDS_ON.match(raw, end).end()
        doc = int(np.searchsorted(edges, at, "right")) - 1
        part = _stretch(raw[at:beyond], end - at, np.maximum(edges[doc:], at) - at, base)
        yield part
        # Words so far of the text that goes on.
        going_on = int(np.searchsorted(edges, end, "right")) - 1
        own_docs = part.docs[: part.own] + doc
        before = int((own_docs == going_on).sum())
        base = before + (base if going_on == doc else 0)
        at = end


def _seeds(languages: pa.Array) -> np.ndarray:
    coded = languages.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(x) for x in coded.dictionary.to_pylist()], np.uint64)
    return known[coded.indices.to_numpy(zero_copy_only=False)]


def _fingerprints(part: Stretch, n: int, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, hashed = part.hashes(n)
    return first, mix64(hashed + seeds[part.docs[first]]).view(np.int64)


def _held(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    place = prints & ((1 << FILTER_BITS) - 1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _all_pairs_held(part: Stretch, bits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each word whether the pair that starts there can be frequent."""
    held = np.zeros(len(part.starts), bool)
    everywhere = Stretch(part.buffer, part.starts, part.ends, part.left, part.docs, part.numbers, len(part.starts))
    everywhere._sums, everywhere._shift = part._sums, part._shift
    first, prints = _fingerprints(everywhere, 2, seeds)
    held[first] = _held(bits, prints)
    return held


def _counted(prints: list[np.ndarray]) -> pa.RecordBatch:
    found, counts = np.unique(np.concatenate(prints), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts.astype(np.int64))], names=["print", "f"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Stretch, np.ndarray, list[bytes], pa.Array]]:
    for batch in batches:
        for rows in slices(batch, "text", CHUNK):
            texts, languages = rows.column("text").cast(pa.large_binary()).to_pylist(), rows.column("lang")
            seeds = _seeds(languages)
            for part in stretches(texts):
                if part.own:
                    part.hashes(1)
                    yield part, seeds, texts, languages


def _short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, seeds, _, _ in _parts(batches):
        yield _counted([_fingerprints(part, n, seeds)[1] for n in (1, 2)])


def _same(part: Stretch, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the n-grams that start at words a and b have the same bytes, for each of the pairs."""
    start_a, start_b = part.starts[a], part.starts[b]
    size = part.ends[a + n - 1] - start_a
    same = size == part.ends[b + n - 1] - start_b
    padded = np.append(part.buffer, np.zeros(8, np.uint8))
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    rest, at = np.flatnonzero(same), 0
    while len(rest):
        shift = (np.uint64(8) * np.maximum(0, 8 - (size[rest] - at)).astype(np.uint64))
        equal = ((words[start_a[rest] + at] ^ words[start_b[rest] + at]) << shift) == 0
        same[rest[~equal]] = False
        at += 8
        rest = rest[equal & (size[rest] > at)]
    return same


def _with_texts(part: Stretch, n: int, first: np.ndarray, prints: np.ndarray, pointers: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """(first word, count, least pointer, text) of each different phrase among the n-grams."""
    order = np.argsort(prints, kind="stable")
    first, prints, pointers = first[order], prints[order], pointers[order]
    opens = np.append(True, prints[1:] != prints[:-1])
    # Neighbours of one hash must be of one text.
    again = np.flatnonzero(~opens)
    mixed = set(prints[again[~_same(part, n, first[again], first[again - 1])]].tolist())
    begins = np.flatnonzero(opens)
    sizes = np.diff(np.append(begins, len(prints)))
    least = np.minimum.reduceat(pointers, begins)
    for at, size, pointer in zip(begins.tolist(), sizes.tolist(), least.tolist(), strict=True):
        if mixed and prints[at] in mixed:
            own: dict[bytes, list] = {}
            for word, p in zip(first[at : at + size].tolist(), pointers[at : at + size].tolist(), strict=True):
                own.setdefault(part.text(word, n), []).append((p, word))
            for text, places in own.items():
                yield places[0][1], len(places), min(p for p, _ in places), text
        else:
            yield first[at], size, pointer, part.text(first[at], n)


def _counts(docs: DataFrame, work) -> DataFrame:
    counted = docs.mapInArrow(work, "print long, f long").groupBy("print").agg(F.sum("f").alias("f"))
    return settle(counted.where(F.col("f") >= LEAST).select("print"), "phrase_prints")


def _filter(prints: DataFrame) -> bytes:
    """A bit for every print, at its last ``FILTER_BITS`` bits: at most 2 ** FILTER_BITS / 8 bytes, whatever the corpus."""
    place = F.col("print").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    pages = prints.groupBy(F.shiftright(place, 15).alias("page")).agg(F.expr(f"bitmap_construct_agg(print & {_PAGE - 1})").alias("bits"))
    out = bytearray((1 << FILTER_BITS) // 8)
    for page, bits in pages.collect():
        out[page * _PAGE // 8 : page * _PAGE // 8 + len(bits)] = bits
    return bytes(out)


def frequent(docs: DataFrame) -> DataFrame:
    """lang, words, phrase, f, pointer of all phrases of 1 to ``LONGEST`` words found ``LEAST`` times, and for each lang a
    row of no words with the number of all its words.

    A pointer has the 32-bit hash of a text (xxh32) in its upper bits, and the number of the phrase's first word (from 0) in its lower 31.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), whole("text").alias("text"))
    short = context.broadcast(_filter(_counts(rows, _short_counts)))

    def long_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(short.value, np.uint8)
        for part, seeds, _, _ in _parts(batches):
            held, out = _all_pairs_held(part, bits, seeds), []
            for n in range(3, LONGEST + 1):
                first, prints = _fingerprints(part, n, seeds)
                ok = np.logical_and.reduce([held[first + i] for i in range(n - 1)])
                out.append(prints[ok])
            yield _counted(out)

    long = context.broadcast(_filter(_counts(rows, long_counts)))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {n: np.frombuffer((short if n <= 2 else long).value, np.uint8) for n in range(1, LONGEST + 1)}
        for part, seeds, raw, languages in _parts(batches):
            marks = np.array([xxhash.xxh32_intdigest(t) for t in raw], np.int64) << 31
            out: tuple[list, ...] = ([], [], [], [], [])
            words = np.bincount(part.docs[: part.own], minlength=len(raw))
            for doc in np.flatnonzero(words).tolist():
                for column, value in zip(out, (doc, 0, b"", int(words[doc]), int(marks[doc])), strict=True):
                    column.append(value)
            for n in range(1, LONGEST + 1):
                first, prints = _fingerprints(part, n, seeds)
                ok = _held(bits[n], prints)
                first, prints = first[ok], prints[ok]
                if not len(first):
                    continue
                pointers = marks[part.docs[first]] | (part.numbers[first] & ((1 << 31) - 1))
                for word, count, pointer, text in _with_texts(part, n, first, prints, pointers):
                    for column, value in zip(out, (part.docs[word], n, text, count, pointer), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    languages.take(pa.array(np.array(out[0], np.int64))), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()).cast(pa.string()),
                    pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()),
                ],
                names=["lang", "words", "phrase", "f", "pointer"],
            )

    found = rows.mapInArrow(texts, "lang string, words int, phrase string, f long, pointer long")
    summed = found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"), F.min("pointer").alias("pointer"))
    return settle(summed.where((F.col("f") >= LEAST) | (F.col("words") == 0)), "phrases")


def _exact(value: Column | int, digits: int = 20) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast(f"decimal({digits},0)")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, pointer: the ``top`` phrases of each language.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the cut with the least score (the shortest first part of
    equal ones), ``n`` all words of the language; the score is ``SCALE`` * a / (l + r), rounded down. All in whole numbers.
    """
    found = frequent(docs)
    counts = found.where("words > 0").select("lang", "phrase", "f")
    candidates = found.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), "pointer", F.split("phrase", " ").alias("w"))
    piece = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = candidates.select("lang", "phrase", "a", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", piece(1, F.col("k")).alias("left"), piece(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    of = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    both = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    both = both.withColumn("above", _exact(SCALE, 7) * _exact(F.col("a"))).withColumn("below", _exact(F.col("l")) + _exact(F.col("r")))
    scored = both.withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda start: F.array_join(F.slice("w", start, size), " ")),
        )
    )
    inside = candidates.where("words > 2").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = candidates.select("lang", "phrase", "a", "pointer").join(covered, ["lang", "phrase"], "left")
    kept = left.where(F.col("longer").isNull() | (_exact(100, 3) * _exact(F.col("longer")) < _exact(COVERED, 3) * _exact(F.col("a"))))
    kept = kept.join(best, ["lang", "phrase"]).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "pointer")

    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    # First among a share of the phrases, so that no task has to rank all of a language.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    some = kept.withColumn("salt", salt)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = found.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "pointer")
