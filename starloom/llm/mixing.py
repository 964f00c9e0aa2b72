"""Mixing sources to target weights.

Words are added up per source. Sources in code point order, a null source last, weigh
5, 2, 1 and so on in turn and share the words of all documents by weight; a source that
would get more than ``most`` times its own words gets just that, and what is left over goes
to the others by weight, until none is above. A source's rate is its target over its
words. Each document is emitted floor(rate) times, and once more if a number drawn from
a hash of the document's id, or of its text if that is null, lies below the fraction; so reruns and lost tasks give the same mix.

A null text has no words. Documents without words are emitted like others of their
source; if all of a source have none, its rate is 0. Repeated rows share their draw. An
empty table gives an empty mix. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import whole
from starloom.sources.warehouse import settle

WEIGHTS = (5, 2, 1)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    """Number of words of a text."""
    return F.size(F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """A number from 0 to below 1 that depends on the id and the seed alone."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target and rate per source, from (source, size) rows.

    Capped sources are those with the smallest size per weight. Walking up that order, a
    source is capped if its share of what the smaller ones leave is above its cap. All
    comparisons are between whole numbers. The windows hold one row per source.
    """
    sources = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    ranked = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    exact = "decimal(38,0)"
    ranked = ranked.select(
        "source", F.col("source_size"), F.col("place"), weight.cast("long").alias("weight"),
        F.col("source_size").cast("decimal(19,0)").alias("s"),
    )
    # Size per weight, as size times the same multiple over weight, so that ties are exact.
    common = 1
    for w in set(weights):
        common *= w
    ranked = ranked.withColumn("per_weight", (F.col("s") * F.lit(common).cast("decimal(9,0)") / F.col("weight")).cast("decimal(38,6)"))
    order = Window.orderBy("per_weight", "place")
    smaller = order.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    ranked = ranked.select(
        "*",
        (F.sum("s").over(all_rows) - most * F.coalesce(F.sum("s").over(smaller), F.lit(0))).cast(exact).alias("left"),
        (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(smaller), F.lit(0))).cast("long").alias("open"),
    )
    capped = F.col("weight").cast("decimal(9,0)") * F.col("left") > most * F.col("s") * F.col("open").cast("decimal(9,0)")
    ranked = ranked.withColumn("capped", capped)
    # The first source that is not capped sets the words per weight for all that follow.
    level = F.min(F.when(~F.col("capped"), F.struct("per_weight", "place", "left", "open"))).over(all_rows)
    ranked = ranked.withColumn("level", level)
    is_capped = F.col("level").isNull() | (
        F.struct("per_weight", "place") < F.struct(F.col("level.per_weight").alias("per_weight"), F.col("level.place").alias("place"))
    )
    target = F.when(is_capped, F.col("source_size").cast("double") * most).otherwise(
        F.col("weight").cast("double") * F.col("level.left").cast("double") / F.col("level.open").cast("double")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return ranked.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, doc_id: Column, text: Column, seed: int) -> Column:
    """A null id is drawn by the text, so that such rows do not share one draw."""
    fraction = rate - F.floor(rate)
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(whole(text).cast("binary"))))
    return F.floor(rate) + F.when(draw(key, seed) < fraction, 1).otherwise(0)


def plan(docs: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Every document packed in ``doc``, with size, source_size, target and its copies.

    The targets are written first, one row per source, so that the planner knows their
    size when it joins them; documents are not moved unless there are very many sources.
    """
    sizes = docs.select("source", words().alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    per_source = settle(targets(sizes, weights, most), "mix_targets").withColumnRenamed("source", "__source")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    joined = packed.join(per_source, F.col("doc.source").eqNullSafe(F.col("__source")), "left")
    return joined.select(
        "doc", words("doc.text").alias("size"), "source_size", "target",
        copies(F.col("rate"), F.col("doc.doc_id"), F.col("doc.text"), seed).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    planned = plan(docs, seed, weights, most).where("copies > 0")
    return planned.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy")).select("doc.*")
