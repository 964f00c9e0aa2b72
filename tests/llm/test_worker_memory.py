"""What tasks hold at once, and what workers keep from task to task."""

import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import bpe, common, jaccard, langid, tokenfiles
from starloom.sources import warehouse


class _Caught:
    """Stands for a table; gives the function that its tasks would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, work, schema):
        return work


@pytest.fixture(scope="module")
def texts():
    words = np.array([f"w{i}" for i in range(50_000)])
    picked = np.random.default_rng(1).integers(0, len(words), (2000, 300))
    return [" ".join(words[row].tolist()) for row in picked]


@pytest.fixture
def kept():
    common.forget()
    yield common._kept
    common.forget()


def _peak(job):
    job()
    tracemalloc.start()
    try:
        job()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_language_is_told_in_little_memory(texts):
    table = np.full(((1 << 17) + 1, 10), -1000, np.int32)
    model = langid.Model(tuple("abcdefghij"), 17, table, np.zeros(10, np.int64))
    assert _peak(lambda: langid.log_likelihoods(texts[:600], model)) < 24


def test_sets_are_made_in_little_memory(texts, monkeypatch):
    monkeypatch.setattr(jaccard, "_keyed", lambda docs: _Caught())
    numbers = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([numbers, numbers, pa.array(texts)], names=["doc_id", "tkey", "text"])
    assert _peak(lambda: sum(out.num_rows for out in jaccard.index(None)(iter([batch])))) < 20


def test_a_worker_keeps_one_thing_and_drops_it_for_other_work(kept, monkeypatch):
    one, other = (bpe.perfect_hash([bytes([i]) for i in range(n)]) for n in (255, 256))
    pieces = bpe._pieces_of(one)
    assert bpe._pieces_of(one) is pieces
    bpe._pieces_of(other)
    assert len(kept) == 1 and bpe._pieces_of(one) is not pieces
    monkeypatch.setattr(jaccard, "_keyed", lambda docs: _Caught())
    assert list(jaccard.index(None)(iter([]))) == []
    assert not kept


def test_words_stay_with_the_worker_when_tasks_are_sent_anew(kept):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = file.read()

    def task(word):
        words = tokenfiles._words_of(model, 2, True)
        return word in words, words[word]

    sent = cloudpickle.dumps(task)
    assert [cloudpickle.loads(sent)(b"remembered")[0] for _ in range(2)] == [False, True]


def test_words_of_ascii_letters_are_as_the_library_has_them(kept):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        words = tokenfiles._words_of(file.read(), 2, True)
    assert words.ascii
    for word in ["a", "Z", "the", "THE", "tHe", "Zzyzx", "thtionedwh", "endoftext", "I" * 70, "re", "LL", "été", "Straße", "naïve", "x1", "1"]:
        ids = words.library.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(words[word.encode()], words.kind).tolist() == ids


def test_the_last_stage_hands_workers_small_batches(spark, monkeypatch):
    def sizes(encoded, path, keep):
        def work(batches):
            for batch in batches:
                n = batch.num_rows
                parts = [batch.column("doc_id"), pa.array([str(batch.nbytes)] * n), batch.column("ids"), pa.array([b""] * n)]
                yield pa.RecordBatch.from_arrays(parts, names=["doc_id", "source", "ids", "decoded"])

        return encoded.mapInArrow(work, "doc_id long, source string, ids array<int>, decoded binary")

    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda i: (F.col("id") + i).cast("string")))
    docs = spark.range(0, 1200, 1, 1).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), text.alias("text"))
    before = spark.conf.get(common._BATCH)
    monkeypatch.setattr(bpe, "decode", sizes)
    found = corpus_pipeline.byte_bpe(spark, docs, "").select("source").collect()
    assert len(found) == 1200 and max(int(row.source) for row in found) <= 2 * common.BATCH_BYTES
    assert spark.conf.get(common._BATCH) == before


def test_ids_are_decoded_without_a_second_worker(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = spark.createDataFrame([(1, [0, 300, 49_000]), (2, []), (3, None)], "doc_id long, ids array<int>")
    found = bpe.decode(ids, path)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    tokens = bpe.load(path).tokens
    assert {row.doc_id: bytes(row.decoded) for row in found.collect()} == {1: tokens[0] + tokens[300] + tokens[49_000], 2: b"", 3: b""}
    for strange in (len(tokens), -1, None):
        with pytest.raises(Exception, match="an id that is not in"):
            bpe.decode(spark.createDataFrame([(1, [strange])], "doc_id long, ids array<int>"), path).collect()


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_near_duplicates_keep_batches_small_and_drop_shuffles(spark, monkeypatch, tmp_path):
    before = [spark.conf.get(k, None) for k in (common._BATCH, common._CLEANUP)]
    seen, old = [], _shuffle_files(spark)

    def keep_one(docs):
        docs.repartition(3, "doc_id").write.parquet(f"{tmp_path}/out")
        for _ in range(50):
            if not (left := _shuffle_files(spark) - old):
                break
            time.sleep(0.2)
        seen.extend([spark.conf.get(common._BATCH), left])
        return docs

    monkeypatch.setattr(jaccard, "keep_one", keep_one)
    held = spark.range(100).withColumnRenamed("id", "doc_id")
    corpus_pipeline.near_duplicates(spark, held, "")
    assert seen == [str(common.BATCH_BYTES), set()]
    assert [spark.conf.get(k, None) for k in (common._BATCH, common._CLEANUP)] == before


def test_pieces_remembered_are_bound():
    pieces = bpe._Pieces(bpe.perfect_hash([bytes([i]) for i in range(256)]), 100)
    given = [f"p{i}" for i in range(1000)] * 2
    assert [np.frombuffer(pieces[p], np.int32).tolist() for p in given] == [list(p.encode()) for p in given]
    assert len(pieces) <= 100 and len(pieces.older) <= 100


def test_token_files_keep_batches_small(spark, tmp_path, monkeypatch):
    before, seen = spark.conf.get(common._BATCH), {}

    def settle(rows, label):
        seen[label] = spark.conf.get(common._BATCH)
        return warehouse.settle(rows, label)

    monkeypatch.setattr(tokenfiles, "settle", settle)
    docs = spark.createDataFrame([(2, "two words"), (1, None)], "doc_id long, text string")
    folder = tokenfiles.write(docs, public_tokenizers.path("word_bpe_49k.json"), 2, str(tmp_path / "ids"))
    assert seen == {"ids_report": str(common.BATCH_BYTES)}
    assert spark.conf.get(common._BATCH) == before
    assert [(r.doc_id, r.start) for r in tokenfiles.read(spark, folder).orderBy("start").collect()] == [(1, 0), (2, 1)]


def test_workers_that_read_token_files_drop_words(kept, monkeypatch):
    class Listed(_Caught):
        def count(self):
            return 1

        def repartition(self, *columns):
            return self

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenfiles._words_of(file.read(), 2, True)
    monkeypatch.setattr(tokenfiles, "files", lambda spark, folder: Listed())
    assert kept and list(tokenfiles.read(None, "/tmp/none")(iter([]))) == []
    assert not kept


def test_ids_are_packed_in_little_memory(tmp_path):
    (tmp_path / "_temporary").mkdir()
    ids = np.random.default_rng(1).integers(0, 49_000, 3 << 20).astype(np.uint16)

    def job():
        file = tokenfiles._File(f"file://{tmp_path}", 0, 0)
        file.add(1, ids)
        assert file.close()[5] == len(ids)

    assert _peak(job) < 24


def test_jaccard_join_keeps_batches_small_and_drops_shuffles(spark, monkeypatch):
    keys = (common._BATCH, common._CLEANUP)
    before, seen = [spark.conf.get(k, None) for k in keys], {}
    texts = ["a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p q", "A b c d e f g h i j k l m n o p", "x y z", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()
    docs.count()
    old = _shuffle_files(spark)

    def settle(rows, label):
        seen.setdefault(label, [spark.conf.get(k, None) for k in keys])
        return warehouse.settle(rows, label)

    monkeypatch.setattr(jaccard, "settle", settle)
    found = jaccard.near_duplicates(docs)
    for _ in range(50):
        if not (left := _shuffle_files(spark) - old):
            break
        time.sleep(0.2)
    assert not left and {"jaccard_index", "jaccard_prefixes", "jaccard_links", "jaccard_rows"} <= set(seen)
    assert all(v == [str(common.BATCH_BYTES), "true"] for v in seen.values())
    assert [spark.conf.get(k, None) for k in keys] == before
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    docs.unpersist()
    assert rows == {0: (12, 0), 1: (13, 0), 2: (12, 0), 3: (1, 3), 4: (0, 4)}
