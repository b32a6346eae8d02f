import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from graphloom.llm import search as S
from graphloom.llm.queries import queries


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def wanted(docs, items, k=50):
    """The contract, document by document."""
    told = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in told), sum(sum(c.values()) for _, c in told)
    df = Counter(t for _, c in told for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, own in asked.items():
        found = []
        for doc, c in told:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        if found:
            out[item] = [(doc, -s) for s, _, _, doc in sorted(found, key=lambda f: f[:3])[:k]]
    return out


def got(frame):
    out = {}
    for r in frame.orderBy("item_id", "rank").collect():
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert len(out[r.item_id]) == r["rank"]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_the_contract(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(queries()["op11_search"](spark, f"/root/testdata/{sf}")) == wanted(docs, items)


def corpus(rng, n, copies=0):
    vocabulary = [f"w{i}" for i in range(400)]
    odds = 1 / np.arange(1, 401)
    odds /= odds.sum()
    topics = [rng.choice(400, 60, replace=False) for _ in range(20)]
    docs = []
    for i in range(n):
        common = rng.choice(400, int(rng.integers(1, 60)), p=odds)
        own = rng.choice(topics[i % 20], int(rng.integers(0, 30)))
        docs.append((i, " ".join(vocabulary[j] for j in (*common, *own))))
    return docs + [(n + i, docs[3][1]) for i in range(copies)]


def test_blocks_are_skipped_and_nothing_is_lost(spark, monkeypatch):
    """Several shards, a large group of copies; most blocks are never looked at."""
    rng = np.random.default_rng(3)
    docs = corpus(rng, 3000, 700)
    items = [(i, docs[int(rng.integers(3000))][1]) for i in range(30)]
    monkeypatch.setattr(S, "SHARD_DOCS", 900)
    monkeypatch.setattr(S, "SHARD_POSTINGS", 20000)
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id int, text string")
    assert got(S.ranked(*frames)) == wanted(docs, items)


def shard(docs, items):
    own = S.Items(pa.array([i for i, _ in items]), [[t] for _, t in items])
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs]), pa.array([t for _, t in docs])], names=["doc_id", "text"])
    vectors = list(S._vectors(own.hashes, iter([batch])))
    n = np.concatenate([v.column(1).to_numpy() for v in vectors])
    df = Counter(int(t) for v in vectors for t in v.column(2).flatten())
    own.weigh(int((n > 0).sum()), df)
    return own, list(S._shards(own, int((n > 0).sum()), int(n.sum()), iter(vectors)))


def test_bounds_hold_and_blocks_are_alike():
    rng = np.random.default_rng(4)
    docs = corpus(rng, 4000)
    items = [(i, docs[i][1]) for i in range(40)]
    own, (one,) = shard(docs, items)
    for term in range(0, len(own.hashes), 7):
        postings, begins = one.blocks(term)
        assert sorted(postings) == list(range(one.starts[term], one.starts[term + 1]))
        assert np.diff(begins).min(initial=99) > 0 and np.diff(begins).max(initial=0) < 2 * S.BLOCK_DOCS
        asking = own.askers[own.starts[term] : own.starts[term + 1]]
        found = one.bounds(term, postings, begins, asking)
        for column, item in enumerate(asking[:5]):
            weight = np.zeros(len(own.hashes), dtype=np.int64)
            weight[own.terms[item]] = own.weights[own.terms[item]]
            weight[:term] = 0
            for b in range(len(begins) - 1):
                rows = one.posted[postings[begins[b] : begins[b + 1]]]
                vectors = np.zeros((len(rows), len(own.hashes)), dtype=np.int64)
                for i, r in enumerate(rows):
                    at = slice(one.offsets[r], one.offsets[r + 1])
                    vectors[i, one.terms[at]] = one.impacts[at]
                    assert vectors[i, term] > 0
                assert found[b, column] == (vectors.max(axis=0) * weight).sum() >= (vectors * weight).sum(axis=1).max()
    best = S.Best(len(items), 10, np.zeros(len(items), dtype=np.int64))
    one.search(best)
    assert one.skipped > one.looked / 4  # random words: bounds are loose


def test_odd_rows(spark, monkeypatch):
    """Nulls, empty and long texts, equal scores, repeated ids and rows, other columns, many blocks of items."""
    long = "alpha " * 300_000 + "b" * 1_500_000 + " Beta\x00gamma\x7f" + "é9" * 10
    docs = [(1, None), (2, ""), (3, " .,-"), (None, "alpha beta"), (4, "alpha beta"), (4, "alpha beta"), (5, "ALPHA, beta!"), (6, long), (7, "İSTANBUL É é"), (8, "x1 x2 x3")]
    docs += [(100 + i, "gamma delta") for i in range(120)]
    items = [(1, "alpha Beta"), (2, None), (3, "..."), (None, "gamma"), (4, "é"), (4, "x2"), (5, "nothing here"), (6, "b" * 1_500_000), (7, "İSTANBUL")]
    monkeypatch.setattr(S, "ITEMS", 2)
    a = spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id long, text string, n string, item int").repartition(3)
    b = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, doc_id int")
    assert got(S.ranked(a, b)) == wanted(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert S.ranked(docs, items).count() == 0
    assert S.ranked(docs, items.limit(0)).count() == 0
    assert S.ranked(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_products_beyond_64_bits():
    assert S._damping(np.array([10**9, 3]), 10**12, 10**15).tolist() == [50 + 50 * 10**9 * 10**12 // 10**15, 50 + 150 * 10**12 // 10**15]
