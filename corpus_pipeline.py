"""A corpus from raw documents: language ID, near duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Documents without text, or without
letters, have no language and are rejected by the first stage. A null id or source is kept: of near copies without ids one
stays, chosen by the text. Repeated rows are near copies of each other. Other columns go along up to the last stage, which
gives doc_id, source, ids and the digest of the decoded bytes only. An empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, jaccard, langid, mixing, secrets
from starloom.llm.common import held_out, short_shuffles, small_batches, table
from starloom.sources.warehouse import new_folder, settle

#: A document whose language is less likely than this, or undetermined, is rejected.
LEAST_SCORE = 0.5
#: Pieces that a worker of the last stage remembers, as an executor that has run the stages before has little memory left.
REMEMBERED = 100_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    model = langid.train(docs, ~held_out("doc_id"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("__text"))
    found = langid.predict(packed, model, text="__text", keep=("doc",))
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    with small_batches(spark), short_shuffles(spark):
        return jaccard.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars counts the new text."""
    scanned = secrets.scan(docs, secrets.learn_cuts(docs))
    hit = F.size("spans") > 0
    new = scanned.select("doc", hit.alias("hit"), secrets.redact(F.col("text"), F.col("spans")).alias("new"))
    values = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    values["text"] = F.when(F.col("hit"), F.col("new")).otherwise(F.col("doc.text"))
    if "n_chars" in values:
        values["n_chars"] = F.when(F.col("hit"), F.char_length("new").cast("long")).otherwise(F.col("doc.n_chars"))
    return new.select(*[value.alias(c) for c, value in values.items()])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids of every document of the mix, and SHA-256 of the bytes that they decode to.

    Written here, as batches are small only while they are written.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "source"), remembered=REMEMBERED)
    back = bpe.decode(encoded, path, keep=("doc_id", "source", "ids"))
    with small_batches(spark):
        return settle(back.select("doc_id", "source", "ids", F.sha2("decoded", 256).alias("decoded_sha256")), "pipeline_tokens")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = new_folder(spark, f"pipeline_{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


#: Learned scores and hash sets are beyond SQL; a test holds the stages against plain versions.
ORACLE_SQL = None
