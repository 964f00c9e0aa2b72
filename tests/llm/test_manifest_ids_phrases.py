"""Merkle manifest, token files and phrases against plain versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import merkle, phrases, tokenfiles

# Byte-level BPE


def test_op10_equals_the_library(spark, edge_docs, sf_dir):
    import base64

    import tiktoken

    from starloom.llm import bpe
    from starloom.llm.queries import op10_byte_bpe

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(doc_id, text):
        ids = library.encode_ordinary(text or "")
        return (str(doc_id), len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))

    for docs, found in (
        (spark.read.parquet(f"{sf_dir}/documents.parquet"), op10_byte_bpe(spark, sf_dir)),
        (edge_docs, bpe.round_trip(edge_docs, path, public_tokenizers.PATTERN)),
    ):
        assert found.columns[:1] == ["doc_id"] and found.schema["n_tokens"].dataType.simpleString() == "bigint"
        rows = found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
        assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted(plain(*r) for r in docs.select("doc_id", "text").collect())


# Merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    """Root of a tree, and the path of each leaf as (left, right) texts."""
    paths, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            start = i // 8 * 8
            paths[leaf].append(("".join(nodes[start:i]), "".join(nodes[i + 1 : start + 8])))
        nodes, at = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)], [i // 8 for i in at]
    return nodes[0], paths


def plain_manifest(rows):
    """(group, order, leaf) rows to (group, order, leaf, subroot, root, path)."""
    groups = collections.defaultdict(list)
    for group, order, leaf in rows:
        groups[group].append((order is not None, order or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for *_, leaf in sorted(groups[g])]) for g in names}
    root, upper = plain_tree([trees[g][0] for g in names])
    return sorted(
        (str(g), str(order if known else None), leaf, trees[g][0], root, tuple(path + upper[i]))
        for i, g in enumerate(names)
        for (known, order, leaf), path in zip(sorted(groups[g]), trees[g][1], strict=True)
    )


def proved(spark, rows):
    df = spark.createDataFrame(rows, "g string, o long, leaf string").withColumns({"tree": F.lit(1), "block": F.lit("x"), "proof": F.lit(2)})
    found = merkle.manifest(df, "leaf", "g", "o")
    found = found.withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert all(r.folded == r.root and r.doc.block == "x" for r in found)
    return sorted((str(r.doc.g), str(r.doc.o), r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in found)


def test_manifest_equals_plain_trees(spark):
    # More than 8 blocks of 512, the last subtree not full; groups of 1, 8, 9 and 513 leaves; nulls, ties and repeated rows.
    sizes = {"de": 4700, "en": 513, "": 9, None: 8, "é": 1, "~": 64}
    rows = [(g, (i * 7919) % n, sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    rows += [("en", None, sha("a")), ("en", None, sha("b")), ("en", 5, sha("c")), ("en", 5, sha("c")), (None, None, sha("d"))]
    assert proved(spark, rows) == plain_manifest(rows)


def test_manifest_of_more_groups_than_a_run_and_of_one_row(spark):
    many = [(f"g{i:03d}", 1, sha(str(i))) for i in range(70)]
    assert proved(spark, many) == plain_manifest(many)
    alone = proved(spark, [("x", 1, sha("only"))])
    assert alone == [("x", "1", sha("only"), sha("only"), sha("only"), ())]
    assert proved(spark, []) == []


def test_leaf_digest(spark):
    rows = [(1, None, "", "é\n"), (None, 2, "x", None)]
    df = spark.createDataFrame(rows, "a long, b long, c string, d string")
    found = [r[0] for r in df.select(merkle.leaf([F.col(c) for c in "abcd"])).collect()]
    assert found == [sha("".join(map(framed, row))) for row in rows]


def test_a_changed_leaf_gives_another_root(spark):
    rows = [("en", i, sha(str(i))) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, o long, leaf string")
    found = merkle.manifest(df, "leaf", "g", "o").select("root", merkle.fold(F.lit(sha("other")), F.col("proof")).alias("f")).collect()
    assert all(r.root != r.f for r in found)


# Token files

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def words():
    with open(WORDS, encoding="utf-8") as file:
        return tokenfiles._Words(file.read(), 2, True)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aAbHeZ019 \t\n.,;'\"<|>-_éÉßİ×÷ΣςK中😀", "̱", "́", "\x1c", "\x85", "\xa0", "'s", "don't", "<|endoftext|>", "<|ENDOFTEXT|>"])))
def test_words_are_encoded_as_whole_texts(words, library, parts):
    text = "".join(parts)
    assert words.ids_of(text.encode()).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_words_forgotten_come_back(library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 3)
    with open(WORDS, encoding="utf-8") as file:
        small = tokenfiles._Words(file.read(), 2, True)
    text = "one two three four, one five two one " * 3
    assert small.ids_of(text.encode()).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("top", [1, 2, 300, 49408, 2**32 - 1])
def test_blocks_round_trip(top):
    r = np.random.default_rng(top)
    ids = (r.integers(0, top, 512 * 5) // r.choice([1, 1, 7, 1000], 512 * 5)).astype(np.uint32)
    ids[[3, 700, 701]] = top - 1
    blocks = tokenfiles.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])
    assert (tokenfiles.decode_blocks(b"".join(blocks), starts) == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.full(512, 7, np.uint32)
    ids[[0, 100, 511]] = 60000
    (block,) = tokenfiles.encode_blocks(ids)
    assert len(block) == 8 + 3 * 6 and (tokenfiles.decode_blocks(block, np.array([0, len(block)])) == ids).all()


def plain_ids(docs, library):
    out, at = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out, at


def test_files_read_back(spark, edge_docs, library, tmp_path):
    docs = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    wanted, total = plain_ids(docs, library)
    for n, file_ids in ((1, 40), (3, 1 << 24)):
        folder = tokenfiles.write(edge_docs.repartition(n), WORDS, 2, f"file://{tmp_path}/f{n}", file_ids)
        found = tokenfiles.read(spark, folder).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
        key = lambda r: (str(r[0]), *r[1:])
        assert sorted(((r.doc_id, r.n_tokens, r.crc) for r in found), key=key) == sorted(wanted, key=key)
        assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found]])[:-1].tolist()
        assert [r.doc_id for r in found] == [d for d, *_ in wanted]
        assert sum(r.ids for r in tokenfiles.files(spark, folder, bucket=2).collect()) == total
    assert tokenfiles.files(spark, f"file://{tmp_path}/f1").count() > 3
    assert tokenfiles.read(spark, tokenfiles.write(edge_docs.where("false"), WORDS, 2)).isEmpty()


def test_any_stretch_is_read_from_its_blocks(spark, tmp_path):
    from pyarrow import fs

    text = "the quick brown fox, 1234 jumps; über den Zaun " * 700
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string").coalesce(1)
    tokenfiles.write(docs, WORDS, 2, f"file://{tmp_path}/f")
    rows = tokenfiles.read(spark, f"file://{tmp_path}/f").orderBy("start").collect()
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    name = next((tmp_path / "f").glob("part-*.ids"))
    with fs.LocalFileSystem().open_input_file(str(name)) as file:
        footer = tokenfiles.Footer(file, "f")
        assert footer.ids == len(stream)
        for start, count in ((0, 1), (511, 2), (512, 512), (1000, 5000), (len(stream) - 1, 1), (7, 0)):
            assert (tokenfiles.ids_at(file, footer, start, count) == stream[start : start + count]).all()


def test_damaged_files_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some text of words")], "doc_id long, text string")
    folder = tokenfiles.write(docs, WORDS, 2, f"file://{tmp_path}/f")
    name = next((tmp_path / "f").glob("part-*.ids"))
    data = bytearray(name.read_bytes())
    data[12] ^= 1
    name.write_bytes(bytes(data))
    with pytest.raises(Exception, match="differs from the manifest"):
        tokenfiles.read(spark, folder).collect()


# Phrases


def plain_counts(docs):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    return counts, totals


def plain_phrases(docs, top=2000):
    counts, totals = plain_counts(docs)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= 30}
    by_lang = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        inside = lambda long: any(long[i : i + len(words)] == words for i in range(len(long) - len(words) + 1))  # noqa: E731, B023
        if any(g == lang and len(w) > len(words) and inside(w) and 100 * f >= 80 * a for (g, w), f in candidates.items()):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, k = min((2000000 * a // (x + y), k) for k, (x, y) in enumerate(cuts))
        by_lang[lang].append((-score, -a, " ".join(words).encode(), *cuts[k]))
    return sorted(
        (lang, rank, phrase.decode(), -a, x, y, totals[lang], -score)
        for lang, found in by_lang.items()
        for rank, (score, a, phrase, x, y) in enumerate(sorted(found)[:top], 1)
    )


def phrase_docs():
    r = np.random.default_rng(5)
    names = ["New", "york", "city", "of", "the", "big", "été", "a", "a", "x-1"]
    docs = [(" ".join(r.choice(names, 12)) + ("." if i % 3 else "!\t") + "  New York  City, hall of fame\na a a a a", [None, "und", "en", "fr"][i % 4]) for i in range(160)]
    return [*docs, (None, "en"), ("", None), (" .,\n", "en"), ("one rare phrase", "de"), docs[0], docs[0]]


def test_phrases_equal_plain_counts(spark):
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "text string, lang string").selectExpr("*", "1 as phrase", "'z' as words", "2 as f")
    found = phrases.collocations(df)
    assert sorted(tuple(r) for r in found.drop("pointer").collect()) == plain_phrases(docs)
    assert sorted(tuple(r) for r in phrases.collocations(df, top=3).drop("pointer").collect()) == plain_phrases(docs, 3)
    assert phrases.collocations(df.where("false")).isEmpty()


def test_pointers_lead_to_an_occurrence(spark):
    import xxhash

    docs = phrase_docs()
    by_hash = {xxhash.xxh32_intdigest((t or "").encode()): t or "" for t, _ in docs}
    rows = phrases.frequent(spark.createDataFrame(docs, "text string, lang string")).where("words > 0").collect()
    assert rows
    for r in rows:
        words = re.findall(r"[^ \t.,;:!?\n\x0b\x0c\r]+", by_hash[r.pointer >> 31].lower())
        at = r.pointer & ((1 << 31) - 1)
        assert " ".join(words[at : at + r.words]) == r.phrase


@pytest.mark.parametrize("chunk", [7, 40, 1 << 20])
def test_long_texts_are_cut_without_loss(monkeypatch, chunk):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    texts = ["Aa b, c d  e f\tg. h" * 9, "", "no-break " * 30, "x" * 100, " . ", "a b c d"]
    found, places = collections.Counter(), []
    for part in phrases.stretches([t.encode() for t in texts]):
        for n in range(1, 5):
            first, hashes = part.hashes(n)
            for w, h in zip(first.tolist(), hashes.tolist(), strict=True):
                found[part.text(w, n).decode()] += 1
                assert h == phrases.stretches([part.text(w, n)]).__next__().hashes(n)[1][0]
        places += part.numbers[: part.own].tolist()
    counts, totals = plain_counts([(t, "") for t in texts])
    assert found == collections.Counter({" ".join(w): c for (_, w), c in counts.items()})
    each = [len(re.findall(r"[^ \t.,;:!?\n]+", t)) for t in texts]
    assert places == [i for n in each for i in range(n)] and sum(each) == totals[""]


def test_phrases_of_one_hash_are_told_apart():
    (part,) = phrases.stretches([b"aa bb aa bb cc dd aa bb extraordinarily-long-word extraordinarily-long-wordy"])
    first = np.arange(len(part.starts))
    found = list(phrases._with_texts(part, 1, first, np.zeros(len(first), np.int64), 100 + first))
    assert sorted((text, count, pointer) for _, count, pointer, text in found) == [
        (b"aa", 3, 100), (b"bb", 3, 101), (b"cc", 1, 104), (b"dd", 1, 105),
        (b"extraordinarily-long-word", 1, 108), (b"extraordinarily-long-wordy", 1, 109),
    ]


def test_filter_holds_every_print(spark):
    prints = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)
    bits = np.frombuffer(phrases._filter(spark.createDataFrame([(int(p),) for p in prints], "print long")), np.uint8)
    assert phrases._held(bits, prints).all() and np.unpackbits(bits).sum() <= 3000
