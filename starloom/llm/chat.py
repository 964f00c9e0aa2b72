"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs, sorted by turn (ties by role, then
text) and merged where neighbours have the same role. A conversation reads

    <s><|role|>ROLE<|text|>TURN<|turn|>TURN<|end|><|role|>...<|end|></s>

with one block for each run of turns of one role. A control string inside a role or text
gets a backslash after its first character, and one that has some gets one more, so no
text can forge a mark and nothing is lost. The loss mask lists start and length, in code
points, of the escaped texts of the roles to be learned.

Null texts and roles count as empty, a null turn sorts first, rows with a null
conversation id form one conversation. Repeated rows are turns of their own. Empty tables
give empty tables; other columns are not read. One conversation is one row of output, so
it must fit into a text of Spark (2 GB).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import whole

# Control strings of the template, and of common chat templates.
BEGIN, ROLE, TEXT, TURN, END, FINISH = "<s>", "<|role|>", "<|text|>", "<|turn|>", "<|end|>", "</s>"
FOREIGN = ("[INST]", "[/INST]")

_INNER = r"/?s>|\|(?:role|text|turn|end)\|>"
_BRACKET = r"/?INST\]"
LEARNED = ("assistant",)


def escape(text: Column) -> Column:
    """One more backslash after the first character of everything that looks like a control string."""
    text = F.regexp_replace(text, rf"<(?=\\*(?:{_INNER}))", r"<\\")
    return F.regexp_replace(text, rf"\[(?=\\*{_BRACKET})", r"[\\")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, rf"<\\(?=\\*(?:{_INNER}))", "<")
    return F.regexp_replace(text, rf"\[\\(?=\\*{_BRACKET})", "[")


def _running(lengths: Column) -> Column:
    """Sum of the lengths before each place of an array."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("at"))
    step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["at"], F.array(acc["sum"])).alias("at"))
    return F.aggregate(lengths, start, step, lambda acc: acc["at"])


def format_conversations(turns: DataFrame, learned: Sequence[str] = LEARNED) -> DataFrame:
    """conv_id, formatted, and loss: array of (start, length) in code points, from 0."""
    cleaned = turns.select("conv_id", "turn", whole("role").alias("role"), whole("text").alias("text"))
    sorted_turns = cleaned.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    last = F.size("turns") - 1
    is_first = lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])
    starts = sorted_turns.withColumn("starts", F.filter(F.sequence(F.lit(0), last), is_first))
    block = lambda start, k: F.struct(
        F.get("turns", start)["role"].alias("role"),
        F.slice("turns", start + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - start).alias("turns"),
    )
    merged = starts.select("conv_id", F.transform("starts", block).alias("blocks"))
    # Pieces in order; a piece is learned, or it is a mark or another role's text.
    no = F.lit(False)
    piece = lambda text, learn: F.struct(text.alias("text"), learn.alias("learn"))
    texts = lambda b: F.flatten(
        F.transform(
            b["turns"],
            lambda t, i: F.array(
                piece(F.when(i == 0, TEXT).otherwise(TURN), no), piece(escape(t["text"]), b["role"].isin(*learned))
            ),
        )
    )
    pieces = lambda b: F.concat(
        F.array(piece(F.concat(F.lit(ROLE), escape(b["role"])), no)), texts(b), F.array(piece(F.lit(END), no))
    )
    framed = merged.select(
        "conv_id",
        F.concat(
            F.array(piece(F.lit(BEGIN), no)), F.flatten(F.transform("blocks", pieces)), F.array(piece(F.lit(FINISH), no))
        ).alias("pieces"),
    )
    measured = framed.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.arrays_zip(
            F.col("pieces.learn").alias("learn"),
            _running(F.transform("pieces", lambda p: F.char_length(p["text"]).cast("long"))).alias("start"),
            F.transform("pieces", lambda p: F.char_length(p["text"]).cast("long")).alias("length"),
        ).alias("spans"),
    )
    loss = F.transform(
        F.filter("spans", lambda s: s["learn"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
    )
    return measured.select("conv_id", "formatted", loss.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns as (role, text) in order, and the learned texts, from the formatted text and its mask alone."""
    inside = F.expr(f"substring(formatted, {len(BEGIN) + 1}, char_length(formatted) - {len(BEGIN) + len(FINISH)})")
    quoted = lambda mark: mark.replace("|", r"\|")
    blocks = F.slice(F.split(inside, quoted(ROLE), -1), 2, F.greatest(F.size(F.split(inside, quoted(ROLE), -1)) - 1, F.lit(0)))

    def turns(block: Column) -> Column:
        head, body = F.get(F.split(block, quoted(TEXT), 2), F.lit(0)), F.get(F.split(block, quoted(TEXT), 2), F.lit(1))
        texts = F.split(F.regexp_replace(body, quoted(END) + r"\z", ""), quoted(TURN), -1)
        return F.transform(texts, lambda t: F.struct(unescape(head).alias("role"), unescape(t).alias("text")))

    learned = F.transform(
        "loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return formatted.select(
        "conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"), learned.alias("learned")
    )
