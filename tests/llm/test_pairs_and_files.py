"""Near duplicates, chat formatting, archives, the pipeline and the registered queries."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from starloom.llm import chat, graph, jaccard, pivots, secrets, warc
from starloom.llm.queries import QUERIES
from starloom.llm.sql import ORACLES
from tests.llm.conftest import PROSE


def rows(df):
    return [tuple(r) for r in df.collect()]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_components(docs):
    """(doc_id, text) rows to (doc_id, size, component), all pairs of distinct sets compared."""
    sets = []
    for _, text in docs:
        w = words_of(text)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[top(i)].append(doc_id)
    return [(d, len(s), min(least[top(i)], default=None)) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def near_group(n, seed=3):
    """Copies of one text with more and more words changed, and texts that share a passage."""
    r = np.random.default_rng(seed)
    base = [f"w{i}" for i in r.integers(0, 10000, 60)]
    out = []
    for k in range(n):
        copy = list(base)
        for at in r.integers(0, 60, r.integers(0, 6)):
            copy[at] = f"v{r.integers(0, 10000)}"
        out.append(" ".join(copy))
    out += [" ".join([*base[:25], *[f"u{i}" for i in r.integers(0, 10000, 30)]]) for _ in range(n)]
    return out


@pytest.mark.parametrize("block", [4, 1024])
def test_jaccard_join_equals_all_pairs(make_docs, edge_docs, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "BUCKET", 500)
    more = make_docs([(100 + i, t, "en", "z") for i, t in enumerate(near_group(40))])
    docs = edge_docs.union(more)
    found = jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    as_text = lambda found: sorted(map(str, found))
    assert as_text(rows(found)) == as_text(plain_components(given))


def test_jaccard_verifies_a_pair_once(make_docs, monkeypatch):
    verified, phases = jaccard._verified, []

    def seen(pairs, texts):
        phases.append([(bytes(a), bytes(b)) for a, b in pairs.select("a", "b").collect()])
        return verified(pairs, texts)

    monkeypatch.setattr(jaccard, "_verified", seen)
    monkeypatch.setattr(jaccard, "_may_link", lambda one, other, both: np.ones(max(len(one), len(other)), bool))
    jaccard.near_duplicates(make_docs([(i, t, "en", "z") for i, t in enumerate(near_group(60))])).collect()
    assert len(phases) == 2 and phases[0] and phases[1]
    assert len(phases[0]) + len(phases[1]) == len({*phases[0], *phases[1]})


def test_jaccard_keeps_one_of_each_group(edge_docs):
    kept = jaccard.keep_one(edge_docs)
    assert kept.schema == edge_docs.schema
    # 4 stands twice and takes 5 (equal words), 6 (one word more) and 11 (itself over and over) along, 9 goes for 8.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([0, 1, 2, 3, 4, 7, 8, 12, None], key=str)
    assert jaccard.keep_one(edge_docs.where("false")).isEmpty()


def test_jaccard_keeps_one_of_a_group_without_ids(make_docs):
    other = "one two three four five six seven eight nine ten"
    given = [(None, PROSE, "en", "a"), (None, PROSE + " tonight", "en", "a"), (None, PROSE.upper(), "en", "b"), (None, PROSE, "en", "a")]
    given += [(7, other, "en", "a"), (7, other.upper(), "en", "a"), (8, other.title(), "en", "a"), (None, other, "en", "a")]
    given += [(9, "", "en", "a"), (None, "", "en", "a"), (None, None, "en", "a")]
    kept = [(r.doc_id, r.text or "") for r in jaccard.keep_one(make_docs(given)).collect()]
    no_words = sorted((str(i), t) for i, t in kept if not t)
    assert no_words == [("9", ""), ("None", "")]
    groups = sorted((str(i), t.lower().startswith("one")) for i, t in kept if t)
    assert groups == [("7", True), ("None", False)]


def test_components(spark):
    r = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 600)] + [(7, None)]
    parent = {}
    top = lambda i: i if parent.setdefault(i, i) == i else top(parent[i])
    for a, b in edges:
        if b is not None and a != b:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    found = rows(graph.components(spark.createDataFrame(edges, "a long, b long")))
    assert sorted(found) == sorted((i, top(i)) for i in parent)


# Vectors


def plain_links(vectors):
    out = []
    for i, (vec_id, v, label) in enumerate(vectors):
        links = []
        for j, (_, w, other) in enumerate(vectors):
            if i != j and label is not None and label == other and usable(v) and usable(w) and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links.append(j)
        out.append((vec_id, links))
    return out


def usable(v):
    return bool(v) and None not in v and np.isfinite(v).all() and any(v)


@pytest.mark.parametrize("block", [8, 1024])
def test_vectors_against_all_pairs(spark, block):
    r = np.random.default_rng(1)
    centres = r.normal(size=(30, 32))
    vectors = [(i, (centres[i % 30] + r.normal(size=32) * 0.08).tolist(), int(i % 3)) for i in range(300)]
    vectors += [(300 + i, (centres[0] + r.normal(size=32) * 0.02).tolist(), 0) for i in range(60)]
    vectors += [(400, vectors[0][1], 0), (401, vectors[0][1], 0), (402, [2 * x for x in vectors[0][1]], 0), (403, vectors[0][1], None)]
    vectors += [(404, None, 0), (405, [], 0), (406, [0.0] * 32, 0), (407, [float("nan")] * 32, 0), (408, [None] * 32, 0), (409, [1.0, 2.0], 0)]
    vectors += [(None, vectors[5][1], 2), (0, vectors[0][1], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit("clash"))
    found = pivots.near_duplicates(df, block=block, pivots=64)
    wanted = plain_links(vectors)
    total = sum(len(links) for _, links in wanted)
    counted = {}
    for vec_id, n, component, kept in rows(found):
        counted.setdefault(vec_id, []).append(n)
        assert kept == (vec_id == component)
    assert sum(map(sum, counted.values())) >= 0.9 * total
    for (vec_id, links) in wanted:
        assert max(counted[vec_id]) <= max(len(x) for v, x in wanted if v == vec_id)
        assert links or counted[vec_id] == [0] * len(counted[vec_id])
    assert len(rows(found)) == len(vectors)
    assert pivots.near_duplicates(df.where("false")).isEmpty()


def test_shared_pivots_and_places():
    r = np.random.default_rng(6)
    near = np.array([r.permutation(12)[:6] for _ in range(40)], np.int32)
    wanted = [[sum(p in b and abs(a.index(p) - b.index(p)) <= 2 for p in a) for b in near.tolist()] for a in near.tolist()]
    assert pivots.shared_pivots(near, near, 2).tolist() == wanted
    units = np.array([np.r_[1.0, 0.0]] * 40)
    # Every pair with enough shared pivots counts in the list of the first of them, whether whole or cut in two.
    for split in (0, 15):
        counted = np.zeros((40, 40), int)
        for this in range(12):
            rows = [i for i, n in enumerate(near) if this in np.sort(n)[:4]]
            cut = sum(i < split for i in rows)
            if split and not 0 < cut < len(rows):
                continue
            counted[np.ix_(rows, rows)] += pivots._linked(units[rows], near[rows], cut, 0.98, 3, 2, this)
        for i in range(40):
            for j in range(40):
                across = not split or (i < split) != (j < split)
                assert counted[i, j] == (i != j and across and wanted[i][j] >= 3)


def test_pivot_lists_grow_with_the_root(spark):
    r = np.random.default_rng(8)
    centres = r.normal(size=(20, 64))
    pairs = {}
    for n in (2000, 8000):
        vectors = centres[np.arange(n) % 20] + r.normal(size=(n, 64)) * 0.3
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
        rows_of = pivots._keyed(df).selectExpr("key", "1L AS size", "label", "dim", "unit").cache()
        found = pivots.describe(rows_of, pivots.choose_pivots(rows_of, None, pivots.NEAREST), pivots.NEAREST, pivots.SHARED)
        lists = found.select(F.explode("lists").alias("p")).groupBy("p").count().collect()
        assert found.where("size(lists) <> 5 OR length(near) <> 32").isEmpty()
        pairs[n] = sum(k * (k - 1) / 2 for _, k in lists)
    assert pairs[8000] / pairs[2000] < 4**1.6


def test_vectors_with_production_parameters(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(150, 64))
    vectors = [(i, (centres[i % 150] + r.normal(size=64) * 0.08).tolist(), 0) for i in range(1500)]
    units = np.array([v for _, v, _ in vectors])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    wanted = (units @ units.T >= 0.98).sum(axis=1) - 1
    found = {r[0]: r[1] for r in rows(pivots.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")))}
    assert wanted.sum() > 1000
    assert all(found[i] <= n for i, n in enumerate(wanted.tolist()))
    assert sum(found.values()) >= 0.9 * wanted.sum()


# Chat


CHATS = [
    (1, 0, "user", "</s>[INST] ok [/INST]"),
    (1, 1, "assistant", "<\\s><\\\\/s>[\\INST]<|end|><|role|>x<|text|>"),
    (1, 2, "assistant", None),
    (1, 2, "assistant", "tie"),
    (1, 2, "assistant", "tie"),
    (1, 3, "user", "<"),
    (1, 4, "user", "<s"),
    (2, 1, "a<|text|>\nb", "😀 é\\"),
    (2, 0, None, ""),
    (2, None, "assistant", "first"),
    (None, 0, "assistant", "no id"),
]


def test_chat_reads_back(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    out = chat.format_conversations(df)
    for conv_id, formatted, turns, learned in rows(chat.read_back(out)):
        own = sorted(((t, r or "", x or "") for c, t, r, x in CHATS if c == conv_id), key=lambda t: (t[0] is not None, *t))
        assert [tuple(t) for t in turns] == [t[1:] for t in own]
        assert list(learned) == [x for _, r, x in own if r == "assistant"]
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(own, own[1:], strict=False))
        assert formatted.count("<|role|>") == formatted.count("<|end|>") == blocks
        assert formatted.count("<s>") == formatted.count("</s>") == 1 and "[INST]" not in formatted
    assert chat.read_back(chat.format_conversations(df.where("false"))).isEmpty()


# WARC


PAGES = [
    (5, "http://a/x y\r\nz", "p" * 100),
    (3, "http://a", "p" * 100),
    (3, "http://a", "p" * 100),
    (9, None, "p" * 100),
    (4, "http://b", "p" * 99),
    (6, "http://b", "p" * 99),
    (7, "http://c", None),
    (8, "http://c", ""),
    (None, "http://d", "q" * 200),
    (10, "http://e", "é\r\n\r\nWARC/1.1\r\n" * 5000),
    (-(2**62), "http://f", "low"),
    (2**62, "http://f", "high"),
]


def test_archives_read_back(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    folders = [warc.write(df.repartition(n), f"file://{tmp_path}/w{n}", 4096, 500) for n in (1, 3)]
    listed = [sorted(rows(spark.read.parquet(f"{f}/manifest").drop("temporary"))) for f in folders]
    assert listed[0] == listed[1] and len(listed[0]) > 3
    found = rows(warc.read(spark, folders[0]))
    assert len(found) == len(PAGES)
    first = {"p" * 100: 3}
    for page_id, url, kind, refers, size, digest, payload in found:
        html = next(h or "" for p, u, h in PAGES if p == page_id)
        assert (size, digest) == (len(html.encode()), hashlib.sha256(html.encode()).hexdigest())
        wanted = first.get(html) if first.get(html) != page_id else None
        assert (kind, refers) == (("revisit", wanted) if wanted is not None else ("response", None))
        assert payload is None if kind == "revisit" else bytes(payload).decode() == html
        assert "\n" not in url
    assert warc.read(spark, warc.write(df.where("false"))).isEmpty()


def test_damaged_archive_is_refused(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    folder = warc.write(df, f"file://{tmp_path}/w", 1 << 20, 1 << 20)
    name = next((tmp_path / "w").glob("part-*.warc.gz"))
    data = bytearray(name.read_bytes())
    data[len(data) // 2] ^= 1
    name.write_bytes(bytes(data))
    with pytest.raises(Exception, match="differs|Error|cut off|malformed"):
        warc.read(spark, folder).collect()


# Queries and pipeline


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_against_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    wanted = connection.sql(ORACLES[name])
    order = sorted(found.columns)
    assert sorted(wanted.columns) == order
    plain = lambda df: sorted(map(str, df[order].astype(object).where(df[order].notna(), None).values.tolist()))
    a, b = found.toPandas(), wanted.df()
    for c in order:
        if str(a[c].dtype) != str(b[c].dtype) and "str" not in str(b[c].dtype) and a[c].dtype != object:
            b[c] = b[c].astype(a[c].dtype)
    assert plain(a) == plain(b)


def test_all_operators_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_pipeline_stage_by_stage(spark, edge_docs, sf_dir, tmp_path):
    import base64

    import tiktoken

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").union(
        edge_docs.selectExpr("doc_id + 10000", "text", "lang", "source", "n_chars")
    )
    docs = docs.withColumn("doc", F.lit("extra"))
    names, seen = [n for n, _ in corpus_pipeline.STAGES], []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, sf_dir)
        if i < 4:
            assert docs.columns == before.columns
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append((before.toPandas(), docs.toPandas()))
    assert names == ["language_id", "ngram_jaccard_join", "secret_scan", "source_mixing", "byte_bpe"]
    (a, b), (_, c), (_, d), (_, e), (_, f) = seen
    no_letter = ~a.text.fillna("").str.contains(r"[^\W\d_]")
    assert len(b) == len(a) - no_letter.sum()
    plain = plain_components(list(zip(b.doc_id.astype(object).where(b.doc_id.notna(), None), b.text, strict=True)))
    kept = {(i, t) for (i, _, k), t in zip(plain, b.text, strict=True) if i == k or k is None}
    assert {(None if pd.isna(i) else i, t) for i, t in zip(c.doc_id, c.text, strict=True)} == kept and len(c) == len(kept)
    base = lambda t: re.search(r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6}", t)
    assert not d.text.map(base).notna().any() and (d.n_chars == d.text.str.len()).all()
    untouched = [t for t in c.text if secrets_free(t)]
    assert set(untouched) <= set(d.text)
    counts = collections.Counter(e.doc_id.fillna(-1))
    assert set(counts) <= set(d.doc_id.fillna(-1)) and max(counts.values()) <= 3
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = sorted((str(i), str(library.encode_ordinary(t))) for i, t in zip(e.doc_id, e.text, strict=True))
    assert sorted((str(i), str(list(x))) for i, x in zip(f.doc_id, f.ids, strict=True)) == wanted
    digests = sorted((str(i), hashlib.sha256(t.encode()).hexdigest()) for i, t in zip(e.doc_id, e.text, strict=True))
    assert sorted((str(i), x) for i, x in zip(f.doc_id, f.decoded_sha256, strict=True)) == digests


def secrets_free(text):
    found = re.search(secrets.ASSIGN.replace("(?i:", "(?:"), text, re.IGNORECASE) or re.search(r"[A-Za-z0-9+/_-]{20,}", text)
    return not found
