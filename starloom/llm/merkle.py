"""A Merkle manifest of a dataset, with a proof for every row.

Rows are the leaves of one tree a group. A tree's leaves are numbered by its order and cut into aligned blocks of
``FANOUT ** LEVELS``. Each block hashes its own subtree. Then blocks swap roots in rounds, as in a butterfly: in
round r a block meets the (up to ``FANOUT``) blocks that hold the subtrees of its run of level r, at its own offset in
them, and all of them hash the run's digest, each for itself. So a block has its upper proof when it has the
root, and nothing goes back down. In a last subtree that is not full, offsets wrap around, so it answers for more
blocks than one. Roots of groups are the leaves of a second tree, which goes the same way.

A digest is the lowercase hex SHA-256 of what is put together, digests as hex text. While a tree has more than one node,
every ``FANOUT`` consecutive ones (the last run may have fewer, even one) become their digest; a lone leaf is its own
root. A row's leaf digest is that of its columns, each as ``-`` if null, else byte count, ``:`` and value.

Null groups come first and are a group of their own; in a group, null orders come first, ties go by leaf digest, so rows that are
equal in all columns are interchangeable. Empty texts are values of no bytes. Long texts never leave the scan. An
empty table gives an empty manifest. Other columns pass through in ``doc``, whatever their names. A proof has one (left,
right) pair of joined sibling digests a level; both are empty where a run has a single node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.sources.warehouse import settle

#: Fixed value: children of a node.
FANOUT = 8
#: Levels of a block's own subtree: 512 leaves.
LEVELS = 3
_PAIR = "struct<left:string,right:string>"
_PROOF = f"array<{_PAIR}>"
_ARROW_PAIR = pa.struct([("left", pa.string()), ("right", pa.string())])


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[framed(v) for v in values]))


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, node, lambda at, step: digest(F.concat(step["left"], at, step["right"])))


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof in one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def subtree(leaves: Sequence[str], levels: int | None) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of consecutive leaves, and for each level what stands left and right of each node in its run.

    Goes up ``levels`` levels, or until one node is left if that is None.
    """
    nodes, beside = list(leaves), []
    while len(beside) < levels if levels is not None else len(nodes) > 1:
        pairs, above = [], []
        for start in range(0, len(nodes), FANOUT):
            run = nodes[start : start + FANOUT]
            pairs += [("".join(run[:i]), "".join(run[i + 1 :])) for i in range(len(run))]
            above.append(hashlib.sha256("".join(run).encode()).hexdigest())
        beside.append(pairs)
        nodes = above
    return nodes[0], beside


def _numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Adds ``place`` (from 0, by ``order`` in each tree) and ``leaves`` (the tree's number of them).

    Rows are sorted by ranges once and written; a row's place is its place in its range plus the tree's rows in the ranges
    before, which come from one count for each range and tree.
    """
    tie = F.xxhash64("_metadata.file_path", "_metadata.row_index")  # spreads rows that are equal
    by = [tree, *order, "__tie"]
    ranged = rows.withColumn("__tie", tie).repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()
    placed = settle(ranged.drop("__tie").withColumn("__at", at).withColumn("__range", F.shiftright("__at", 33)), "merkle_sorted")
    counts = placed.groupBy(tree, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    whole_tree = Window.partitionBy(tree)
    before = whole_tree.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        tree, "__range", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole_tree).alias("leaves"),
    )
    found = placed.join(settle(starts, "merkle_ranges"), [tree, "__range"])
    return found.withColumn("place", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__range", "__first", "__before")


def _block_levels(blocks: int) -> int | None:
    return LEVELS if blocks > 1 else None


def _block_root(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("place")
    blocks = rows.column("blocks")[0].as_py()
    node, _ = subtree(rows.column("leaf").to_pylist(), _block_levels(blocks))
    return pa.table({"tree": rows.column("tree")[:1], "block": rows.column("block")[:1], "blocks": [blocks], "node": [node]})


def _butterfly(blocks: DataFrame) -> DataFrame:
    """(tree, block, blocks, node) rows to the same with the tree's root as ``node`` and the proof from the block upwards.

    As many rounds as the largest tree has levels above its blocks; each moves one digest a block and partner.
    """
    state = settle(blocks.withColumn("proof", F.array().cast(_PROOF)), "merkle_blocks")
    most = state.agg(F.max("blocks")).first()[0] or 0
    span = 1
    while span < most:
        active = state.where(F.col("blocks") > span)
        run = F.floor(F.col("block") / (span * FANOUT)) * FANOUT
        parts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(FANOUT - 1)), lambda j: run + j), lambda s: s * span < F.col("blocks"))
        asked = active.select("tree", "block", "blocks", F.explode(parts).alias("part"))
        size = F.least(F.lit(span), F.col("blocks") - F.col("part") * span)
        partner = F.col("part") * span + F.pmod(F.pmod("block", F.lit(span)), size)
        asked = asked.select("tree", F.col("block").alias("asks"), "part", partner.alias("block"))
        met = asked.join(active.select("tree", "block", "node"), ["tree", "block"])
        told = met.groupBy("tree", F.col("asks").alias("block")).agg(F.sort_array(F.collect_list(F.struct("part", "node"))).alias("run"))
        own = F.floor(F.col("block") / span)
        beside = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda x: x["node"]), "")
        pair = F.struct(beside(lambda x: x["part"] < own).alias("left"), beside(lambda x: x["part"] > own).alias("right"))
        risen = active.join(told, ["tree", "block"]).withColumn("pair", pair).select(
            "tree", "block", "blocks", digest(F.concat("pair.left", "node", "pair.right")).alias("node"),
            F.concat("proof", F.array(F.col("pair").cast(_PAIR))).alias("proof"),
        )
        state = settle(state.where(F.col("blocks") <= span).unionByName(risen), "merkle_blocks")
        span *= FANOUT
    return state


def _blocked(numbered: DataFrame) -> DataFrame:
    size = FANOUT**LEVELS
    return numbered.withColumn("block", F.floor(F.col("place") / size)).withColumn("blocks", F.ceil(F.col("leaves") / size))


def _block_proofs(rows: pa.Table, state: pa.Table) -> pa.Table:
    rows = rows.sort_by("place")
    above = [(p["left"], p["right"]) for p in state.column("proof")[0].as_py()]
    _, beside = subtree(rows.column("leaf").to_pylist(), _block_levels(state.column("blocks")[0].as_py()))
    n, depth = rows.num_rows, len(beside) + len(above)
    steps = [pairs[i // FANOUT**level] for i in range(n) for level, pairs in enumerate([*beside])] if beside else []
    paths = [(*steps[i * len(beside) : (i + 1) * len(beside)], *above) for i in range(n)]
    flat = [pair for path in paths for pair in path]
    pairs = pa.StructArray.from_arrays([pa.array([p[k] for p in flat], pa.string()) for k in (0, 1)], fields=list(_ARROW_PAIR))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * depth), pairs)
    repeat = lambda name: pa.repeat(state.column(name)[0], n)
    kept = rows.drop_columns(["block", "blocks"])
    return kept.append_column("subroot", repeat("subroot")).append_column("root", repeat("root")).append_column("proof", lists)


def _proved(numbered: DataFrame, upper) -> DataFrame:
    """Numbered leaves with subroot, root and proof; ``upper`` adds root and a further proof to one row a tree, or is None."""
    blocked = _blocked(numbered)
    roots = blocked.select("tree", "block", "blocks", "place", "leaf").groupBy("tree", "block").applyInArrow(
        _block_root, "tree string, block long, blocks long, node string"
    )
    state = _butterfly(roots).withColumnRenamed("node", "subroot")
    if upper is None:
        state = state.withColumn("root", F.col("subroot"))
    else:
        tops = upper(state.where("block = 0").select("tree", F.col("subroot").alias("leaf")))
        above = settle(tops.select("tree", "root", F.col("proof").alias("above")), "merkle_tops")
        state = state.join(above, "tree").withColumn("proof", F.concat("proof", "above")).drop("above")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in blocked.schema if f.name not in ("block", "blocks")]
    schema = ", ".join([*fields, "subroot string", "root string", f"proof {_PROOF}"])
    return blocked.groupBy("tree", "block").cogroup(state.groupBy("tree", "block")).applyInArrow(_block_proofs, schema)


def _top(subroots: DataFrame) -> DataFrame:
    """One leaf a tree, in the order of the trees, to its proof in the tree of all."""
    leaves = settle(subroots.withColumnRenamed("tree", "name").withColumn("tree", F.lit("")), "merkle_subroots")
    return _proved(_numbered(leaves, "tree", ["name"]), None).drop("tree").withColumnRenamed("name", "tree")


def manifest(rows: DataFrame, leaf_column: str, group: str, order: str) -> DataFrame:
    """Every row packed in ``doc``, with leaf, place, leaves, subroot, root and proof.

    ``place`` and ``leaves`` are the leaf's number and the number of leaves in its group. Only the columns of ``rows`` are moved, so
    texts should be hashed and dropped before. ``fold(leaf, proof)`` gives ``root`` for an untampered row.
    """
    name = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")), F.lit(""))
    packed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("doc"), name.alias("tree"),
        F.col(f"`{order}`").alias("order"), F.col(f"`{leaf_column}`").alias("leaf"),
    )
    numbered = _numbered(settle(packed, "merkle_leaves"), "tree", ["order", "leaf"]).drop("order")
    return _proved(numbered, _top).drop("tree")
