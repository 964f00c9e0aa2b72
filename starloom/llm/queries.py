"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, chat, fingerprints, jaccard, langid, merkle, mixing, phrases, pivots, quality, secrets, tokenfiles, warc
from starloom.llm.common import held_out, table


def _hex(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, ~held_out("doc_id"))
    marked = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return langid.predict(marked, model, keep=("doc_id", "held_out"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with equal labels."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back, and conversation -1, whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    back = chat.read_back(chat.format_conversations(turns.unionByName(extra)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _hex(F.array_join(lines, "")).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        _hex(learned).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans by kind, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = secrets.scan(docs, secrets.learn_cuts(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")
    return scanned.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        _hex(secrets.spell(F.col("base"))).alias("base_sha256"),
        secrets.spell(F.col("spans")).alias("spans"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train(docs, labels, ~held_out("doc_id"))
    marked = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text", "n_chars")
    return quality.score(marked, model, keep=("doc_id", "held_out"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return fingerprints.with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    planned = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files, and read back."""
    folder = warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Digests of the ids of every text and of the bytes they decode to."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents by language; every proof is tried on its document, a third of them tampered with."""
    docs = table(spark, sf_dir, "documents")
    values = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    own = merkle.leaf(list(values.values()))
    tampered = F.when(picked, merkle.leaf(list((values | {"text": lower}).values())))
    leaves = docs.select("doc_id", "lang", own.alias("leaf"), tampered.alias("tampered"))
    proved = merkle.manifest(leaves, "leaf", "lang", "doc_id")
    checked = proved.withColumn("folded_root", merkle.fold(F.coalesce("doc.tampered", "leaf"), F.col("proof")))
    return checked.select(
        "doc.doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Ids of all texts written to binary files, and what reading them back gives of each document."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    folder = tokenfiles.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path, end_id=2)
    return tokenfiles.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language."""
    found = phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality": op5_quality,
    "op6_fingerprints": op6_fingerprints,
    "op7_source_mixing": op7_source_mixing,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_warc": op9_warc,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_merkle": op11_merkle,
    "op12_token_files": op12_token_files,
    "op13_phrases": op13_phrases,
}
