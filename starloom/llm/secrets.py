"""Secret scan with DataFrame expressions only.

Three patterns give the base spans: assignments, access keys and long hex runs. A battery of
randomness tests adds more: every run of 20 or more characters of the base64 family is a
candidate, and so is every part of it between / _ and - that is as long. Base spans are cut out of
a run first; what is left on either side counts as runs of their own. A candidate's encoding is the
smallest alphabet that has all its characters. Three tests look at the places of its characters in that alphabet:

* chi-squared: counts of the characters against equal counts, by its exact tail for the alphabet and length,
* runs: runs of the alphabet's lower and upper half against a fair coin's, by the exact binomial tails,
* serial correlation of neighbours, by the normal approximation.

The first two are tabulated up to ``TABULATED`` characters and approximated beyond. The battery's value q is three times the
smallest of the three (Bonferroni), or 0 if that is below ``LEVEL``. A find must look random and be unlike ordinary text, so the
p-value is taken against ordinary text and q is part of it: it is L / q, where L is the chance of the candidate's neighbours in ordinary
text over their chance among even characters, and 1 if q is 0. How often a character follows another in ordinary text is counted
over the short runs of all documents: changes between lower case, upper case, digits and marks, and letters after letters
whatever their case. For each alphabet this gives chances within it, a share ``FREE`` of which is even, so that no neighbour alone
says much. In ordinary text q / L has the mean that q has among even characters, so at most 1, and ordinary text has a p-value below p
no more often than p (Markov's inequality), at any length.

These p-values go through false-discovery control (Benjamini and Hochberg) within each class of
length and encoding, over the candidates of all documents: p-values are counted in fixed bins, and
a class's cut is the last bin edge at which the expected share of false finds is at most ``RATE``.
A part within a found run is not told again.

Positions are code points, ends exclusive. A null text is empty and has no spans. Equal texts have equal
spans, repeated rows come out alike, an empty table gives none. Texts are scanned whole. Other columns are kept as
they are, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import whole

# The base patterns and the kinds in their order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALPHABETS = (
    ("decimal", "[0-9]+", "0123456789"),
    ("hex", "[0-9a-f]+", "0123456789abcdef"),
    ("HEX", "[0-9A-F]+", "0123456789ABCDEF"),
    ("base32", "[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "[A-Z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("base62", "[A-Za-z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "[A-Za-z0-9+/]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base66", "[A-Za-z0-9+/_-]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"),
)
#: Characters of a piece in which pairs are counted, and what is no ordinary text: assignments and candidates with more than digits.
PIECE = 64
NOT_ORDINARY = rf"{ASSIGN}|(?<![A-Za-z0-9+/_-])(?=[0-9]*[A-Za-z+/_-]){CANDIDATE}"
#: Even share of the chances of ordinary text; before anything is learned, the chance that a class stays, as this many neighbours.
FREE = 1 / 16
STAYS, STAYS_WEIGHT = 0.9, 100
#: Longest candidates with tabulated tails; tails are held down to ``FINE``.
TABULATED = 95
FINE = 1e-4
#: Lengths at which classes begin, share of false finds allowed, level of the three tests together, bins of p-values (powers of two).
LENGTHS = (20, 24, 32, 48, 96)
RATE = 0.01
LEVEL = 0.01
BINS = 60


def _running(lengths: Column) -> Column:
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("at"))
    step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["at"], F.array(acc["sum"])).alias("at"))
    return F.aggregate(lengths, start, step, lambda acc: acc["at"])


def _matches(text: Column, pattern: str, guard: Column, group: int = 0) -> Column:
    """All leftmost matches as (start, end, found); a text that fails the guard has none.

    What lies between the matches comes from a split, so a match begins after the gaps and
    matches before it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.zip_with(
        F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda g, m: F.struct(
            F.char_length(g).cast("long").alias("gap"), F.char_length(m).cast("long").alias("length"), m.alias("match"))),
        parts,
        lambda a, p: F.struct(a["gap"].alias("gap"), a["length"].alias("length"), p.alias("found")),
    )
    # Once for the lengths and once for the rest, both from one bound variable.
    placed = F.transform(
        F.array(zipped),
        lambda z: F.zip_with(
            z,
            _running(F.transform(z, lambda x: x["gap"] + x["length"])),
            lambda x, at: F.struct(
                (at + x["gap"]).alias("start"), (at + x["gap"] + x["length"]).alias("end"), x["found"].alias("found")
            ),
        ),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
    return F.when(guard, F.coalesce(F.get(placed, F.lit(0)), empty)).otherwise(empty)


def _named(spans: Column, kind: str) -> Column:
    """Found spans that are long enough, as (start, kind, end)."""
    good = F.filter(spans, lambda s: F.char_length(s["found"]) >= LEAST[kind])
    number = F.lit(KINDS.index(kind))
    return F.transform(good, lambda s: F.struct(s["start"].alias("start"), number.alias("kind"), s["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Base spans as (start, kind, end), in that order; kinds by number."""
    kinds = {
        "assign": _matches(text, ASSIGN, text.rlike(ASSIGN), 2),
        "access": _matches(text, ACCESS, text.contains("AKIA")),
        # Shorter runs of hex digits fail anyway, and a run's parts are no matches of their own.
        "hex": _matches(text, HEX.replace("+", f"{{{LEAST['hex']},}}"), text.rlike(f"[0-9a-f]{{{LEAST['hex']}}}")),
    }
    kept = [_named(spans, kind) for kind, spans in kinds.items()]
    return F.array_sort(F.concat(*kept))


def _parts(run: Column) -> Column:
    """The parts of a run between marks, as (start, end, found)."""
    parts = F.transform(F.array(F.split(run["found"], "[/_-]", -1)), lambda p: F.zip_with(
        p, _running(F.transform(p, lambda x: F.char_length(x).cast("long") + 1)),
        lambda x, at: F.struct(
            (run["start"] + at).alias("start"), (run["start"] + at + F.char_length(x)).alias("end"), x.alias("found")
        ),
    ))
    return F.get(parts, F.lit(0))


def _outside(run: Column, base: Column) -> Column:
    """What the sorted base spans leave of a run, as (start, end, found)."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    piece = lambda at, end: F.when(at < end, F.array(F.struct(at.alias("start"), end.alias("end")))).otherwise(none)
    left = F.aggregate(
        F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])),
        F.struct(run["start"].alias("at"), none.alias("pieces")),
        lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["pieces"], piece(acc["at"], b["start"])).alias("pieces")),
        lambda acc: F.concat(acc["pieces"], piece(acc["at"], run["end"])),
    )
    cut = lambda p: F.substring(run["found"], (p["start"] - run["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))
    return F.transform(left, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), cut(p).alias("found")))


def candidates(text: Column, base: Column) -> Column:
    """What is to be tested, as (start, end, found): of every run the run and then its parts; base spans are cut out."""
    runs = _matches(text, CANDIDATE, text.rlike(CANDIDATE.replace("20,", "20")))
    long = lambda spans: F.filter(spans, lambda s: s["end"] - s["start"] >= LENGTHS[0])
    # The base spans are bound once, so that they are not looked for again at every run.
    runs = F.get(F.transform(F.array(base), lambda b: long(F.flatten(F.transform(runs, lambda c: _outside(c, b))))), F.lit(0))
    return F.transform(runs, lambda c: F.when(c["found"].rlike("[/_-]"), F.concat(F.array(c), long(_parts(c)))).otherwise(F.array(c)))


def _below(z: Column) -> Column:
    """Chance that a normal number is below z (the five-term polynomial of Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    tail = F.lit(0.0)
    for factor in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        tail = (tail + factor) * t
    tail = tail * F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def _class_of(char: str) -> int:
    """Lower case, upper case, digit or mark."""
    return 0 if char.islower() else 1 if char.isupper() else 2 if char.isdigit() else 3


def evidence(pairs: Mapping[str, int]) -> list[float]:
    """Logarithms of the chance of a character after another, even over ordinary, of all alphabets in turn, from counted pairs.

    A letter's chance after a letter, and a digit's after a digit, leans on its own frequency where there are few pairs.
    """
    classes = range(4)
    turns = {a: {b: STAYS_WEIGHT * (STAYS if a == b else (1 - STAYS) / 3) for b in classes} for a in classes}
    after: dict[str, Counter[str]] = defaultdict(Counter)
    alone: Counter[str] = Counter()
    for pair, n in pairs.items():
        a, b = pair[0], pair[1]
        turns[_class_of(a)][_class_of(b)] += n
        a, b = a.lower(), b.lower()
        alone[b] += n
        if a.isalpha() == b.isalpha() and a.isdigit() == b.isdigit():
            after[a][b] += n
    kinds = ("abcdefghijklmnopqrstuvwxyz", "0123456789", "+/_-")
    kind_of = {c: kind for kind in kinds for c in kind}
    single = {c: (alone[c] + 1) / (sum(alone[x] for x in kind) + len(kind)) for kind in kinds for c in kind}

    def ordinary(a: str, b: str) -> float:
        before, to = a.lower(), b.lower()
        kind = kind_of[to]
        seen = after[before] if kind_of[before] == kind else Counter()
        row = turns[_class_of(a)]
        return row[_class_of(b)] / sum(row.values()) * (seen[to] + len(kind) * single[to]) / (seen.total() + len(kind))

    table = []
    for _, _, letters in ALPHABETS:
        for a in letters:
            chances = [ordinary(a, b) for b in letters]
            whole_chance, k = sum(chances), len(letters)
            table += [-math.log((1 - FREE) * k * c / whole_chance + FREE) for c in chances]
    return table


def ordinary_pairs(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """How often characters of the base64 family follow each other in the ordinary text of all documents.

    Runs are cut into pieces of ``PIECE`` characters that share one character, so every pair is counted once.
    """
    one = "[A-Za-z0-9+/_-]"
    some = docs.select(F.regexp_replace(whole(text), NOT_ORDINARY, " ").alias("text"))
    piece = F.lit(rf"(?=({one}{{2,{PIECE}}})){one}{{1,{PIECE - 1}}}")
    pieces = some.select(F.explode(F.regexp_extract_all("text", piece, F.lit(1))).alias("piece"))
    places = F.sequence(F.lit(1), F.char_length("piece") - 1)
    pairs = pieces.select(F.explode(F.transform(places, lambda i: F.substring("piece", i, F.lit(2)))).alias("pair"))
    return {r[0]: r[1] for r in pairs.groupBy("pair").count().collect()}  # at most 66 * 66 rows


def pair_tails(k: int, longest: int) -> list[np.ndarray]:
    """For lengths 0 to ``longest``: the chance that even characters of k make c pairs of equals or more, at place c.

    The chi-squared statistic of n characters is (2 c + n) k / n - n. Letters are added one by one to the weights of
    (characters so far, pairs so far). Chances below ``FINE`` are left out.
    """
    mean, most = longest * (longest - 1) / 2 / k, longest * (longest - 1) // 2
    width = min(most, int(mean + 10 * math.sqrt(mean + 1)) + 30) + 1
    ways = np.zeros((longest + 1, width))
    ways[0, 0] = 1.0
    for _ in range(k):
        more, weight = ways.copy(), 1.0
        for times in range(1, longest + 1):
            pairs, weight = times * (times - 1) // 2, weight / times / k
            if pairs >= width:
                break
            more[times:, pairs:] += weight * ways[: longest + 1 - times, : width - pairs]
        ways = more
    tails = []
    for n in range(longest + 1):
        fewer = np.concatenate([[0.0], np.cumsum(ways[n] * math.factorial(n))[:-1]])
        tail = np.clip(1 - fewer, 0, 1)
        tails.append(tail[: int((tail >= FINE).sum())])
    return tails


def change_tails(n: int) -> list[float]:
    """For 0 to n - 1 changes of half among n even characters: twice the smaller tail of the binomial, at most 1."""
    chances = [math.comb(n - 1, x) / 2 ** (n - 1) for x in range(n)]
    return [min(1.0, 2 * min(sum(chances[: x + 1]), sum(chances[x:]))) for x in range(n)]


def _numbers(values: Sequence[float], form: str) -> Column:
    return F.split(F.lit(",".join(format(v, form) for v in values)), ",").cast("array<double>")


@cache
def _tabulated() -> tuple[list[float], list[int], list[float], list[int]]:
    """The tails of all alphabets and lengths, and where those of an alphabet and length, or of a length, begin and end."""
    even, even_at, turns, turns_at = [], [0], [], [0]
    for _, _, letters in ALPHABETS:
        for tail in pair_tails(len(letters), TABULATED)[LENGTHS[0] :]:
            even += tail.tolist()
            even_at.append(len(even))
    for n in range(LENGTHS[0], TABULATED + 1):
        turns += change_tails(n)
        turns_at.append(len(turns))
    return even, even_at, turns, turns_at


def battery(runs: Column, table: Sequence[float]) -> Column:
    """For candidates (start, end, found): start, end, stratum, q (of the three tests) and p (against ordinary text).

    ``table`` is what ``evidence`` gives.
    """
    said = _numbers(table, ".17g")
    even, even_at, turns, turns_at = _tabulated()
    even_tail, turns_tail = _numbers(even, ".6f"), _numbers(turns, ".6f")
    even_begin, turns_begin = (F.split(F.lit(",".join(map(str, at))), ",").cast("array<int>") for at in (even_at, turns_at))
    begins, at = [], 0
    for _, _, letters in ALPHABETS:
        begins.append(at)
        at += len(letters) ** 2
    begin = F.array(*[F.lit(b) for b in begins])
    names = lambda token: F.coalesce(*[F.when(token.rlike(rf"\A{p}\z"), i) for i, (_, p, _) in enumerate(ALPHABETS)])
    inferred = F.transform(
        runs, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["found"].alias("found"), names(c["found"]).alias("code"))
    )
    letters = F.array(*[F.lit(a) for _, _, a in ALPHABETS])
    spelled = F.transform(
        inferred,
        lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["code"].alias("code"),
            F.get(letters, c["code"]).alias("letters"), F.split(c["found"], "").alias("chars"),
        ),
    )
    numbered = F.transform(
        spelled,
        lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["code"].alias("code"),
            F.char_length(c["letters"]).cast("double").alias("k"),
            F.transform(c["chars"], lambda x: F.instr(c["letters"], x).cast("double")).alias("s"),
        ),
    )
    zero = F.lit(0.0)
    add = lambda acc, x: acc + x

    def sums(c: Column) -> Column:
        s = c["s"]
        n = F.size(s)
        mean = F.aggregate(s, zero, add) / n
        next_to = lambda f: F.aggregate(F.zip_with(F.slice(s, F.lit(1), n - 1), F.slice(s, F.lit(2), n - 1), f), zero, add)
        half = c["k"] / 2
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["code"].alias("code"), c["k"].alias("k"),
            n.cast("double").alias("n"),
            F.aggregate(
                F.transform(F.array_distinct(s), lambda v: F.pow(F.size(F.filter(s, lambda x: x == v)).cast("double"), 2.0)), zero, add
            ).alias("squares"),
            (1 + next_to(lambda a, b: ((a > half) != (b > half)).cast("double"))).alias("runs"),
            F.transform(F.array(mean), lambda m: next_to(lambda a, b: (a - m) * (b - m))).getItem(0).alias("together"),
            F.transform(F.array(mean), lambda m: F.aggregate(s, zero, lambda acc, x: acc + (x - m) * (x - m))).getItem(0).alias("spread"),
            next_to(lambda a, b: F.get(said, (F.get(begin, c["code"]) + (a - 1) * c["k"] + b - 1).cast("int"))).alias("evidence"),
        )

    def scores(c: Column) -> Column:
        n, k = c["n"], c["k"]
        pairs, changes, length = ((c["squares"] - n) / 2).cast("int"), (c["runs"] - 1).cast("int"), n.cast("int")
        tabulated = n <= TABULATED
        row = c["code"] * (TABULATED + 1 - LENGTHS[0]) + length - LENGTHS[0]
        place = F.get(even_begin, row) + pairs
        exact_even = F.when(place < F.get(even_begin, row + 1), F.get(even_tail, place)).otherwise(0.0)
        # Beyond the table by the cube root of the statistic over its degrees of freedom (Wilson and Hilferty).
        free = k - 1
        cube = F.cbrt((c["squares"] * k / n - n) / free)
        near_even = 1 - _below((cube - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))
        near_turns = 2 * (1 - _below(F.abs((c["runs"] - 1 - (n - 1) / 2) / F.sqrt((n - 1) / 4))))
        serial = F.when(c["spread"] > 0, (c["together"] / c["spread"] + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["code"].alias("code"), n.alias("n"),
            F.when(tabulated, exact_even).otherwise(near_even).alias("even"),
            F.when(tabulated, F.get(turns_tail, F.get(turns_begin, length - LENGTHS[0]) + changes)).otherwise(near_turns).alias("runs"),
            (2 * (1 - _below(F.abs(serial)))).alias("serial"), c["evidence"].alias("evidence"),
        )

    def verdict(c: Column) -> Column:
        place = sum(((c["n"] >= at).cast("int") for at in LENGTHS[1:]), F.lit(0))
        q = F.least(3 * F.least(c["even"], c["runs"], c["serial"]), F.lit(1.0))
        p = F.least(F.exp(-c["evidence"]) / F.greatest(q, F.lit(LEVEL)), F.lit(1.0))
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), (c["code"] * len(LENGTHS) + place).alias("stratum"),
            F.when(q >= LEVEL, q).otherwise(0.0).alias("q"), F.when(q >= LEVEL, p).otherwise(1.0).alias("p"),
        )

    return F.transform(F.transform(F.transform(numbered, sums), scores), verdict)


def _bin(p: Column) -> Column:
    """0 for p above 1/2, then one more for each halving."""
    return F.least(F.greatest(F.floor(-F.log2(F.greatest(p, F.lit(2.0**-BINS)))), F.lit(0)), F.lit(BINS - 1)).cast("int")


def cuts(tested: DataFrame) -> dict[int, int]:
    """The lowest bin that counts as a find, by stratum, from (stratum, p); strata without finds are left out.

    A bin's p-values are taken at their upper edge. There are ``BINS`` counts a stratum at most.
    """
    counted = tested.groupBy("stratum", _bin(F.col("p")).alias("bin")).agg(F.count("*").alias("n"))
    smaller = Window.partitionBy("stratum").orderBy(F.col("bin").desc())
    ranked = counted.select(
        "stratum", "bin", F.sum("n").over(smaller).alias("finds"), F.sum("n").over(Window.partitionBy("stratum")).alias("all")
    )
    passed = ranked.where(F.pow(F.lit(2.0), -F.col("bin").cast("double")) * F.col("all") <= RATE * F.col("finds"))
    return {r[0]: r[1] for r in passed.groupBy("stratum").agg(F.min("bin")).collect()}


class Cuts(dict[int, int]):
    """``cuts``, with the evidence that the p-values came from."""

    def __init__(self, found: Mapping[int, int], table: Sequence[float]) -> None:
        super().__init__(found)
        self.table = table


def learn_cuts(docs: DataFrame, text: str = "text") -> Cuts:
    """``cuts`` over the candidates of all documents."""
    body = whole(text)
    table = evidence(ordinary_pairs(docs, text))
    some = docs.select(body.alias("text")).where(F.col("text").rlike(CANDIDATE.replace("20,", "20")))
    runs = some.select(candidates(F.col("text"), base_spans(F.col("text"))).alias("runs")).where(F.size("runs") > 0)
    tested = runs.select(F.explode(F.flatten(F.transform("runs", lambda run: battery(run, table)))).alias("c"))
    return Cuts(cuts(tested.select("c.stratum", "c.p")), table)


def scan(docs: DataFrame, found_cuts: Cuts | dict[int, int], text: str = "text") -> DataFrame:
    """Every row packed in ``doc``, with its base spans and all spans, as (start, kind, end)."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), whole(text).alias("text"))
    based = packed.select("doc", "text", base_spans(F.col("text")).alias("base"))
    if not found_cuts:
        return based.select("doc", "text", "base", F.col("base").alias("spans"))
    tested = F.transform(candidates(F.col("text"), F.col("base")), lambda run: battery(run, found_cuts.table))
    lowest = F.create_map(*[F.lit(x) for item in sorted(found_cuts.items()) for x in item])
    told = F.transform(tested, lambda run: F.transform(run, lambda c: F.struct(
        c["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), c["end"].alias("end"),
        F.coalesce(_bin(c["p"]) >= F.element_at(lowest, c["stratum"]), F.lit(False)).alias("find"),
    )))
    # A run stands before its parts. Parts do not overlap.
    outer = F.flatten(F.transform(told, lambda run: F.when(run[0]["find"], F.slice(run, 1, 1)).otherwise(F.filter(run, lambda c: c["find"]))))
    added = F.transform(outer, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return based.select("doc", "text", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def spell(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by one mark."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        fresh = s["start"] >= acc["at"]
        more = F.when(fresh, F.array(gap, F.lit(mark))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["parts"], more).alias("parts"))

    def finish(acc: Column) -> Column:
        rest = F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text))
        return F.array_join(F.concat(acc["parts"], F.array(rest)), "")

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
