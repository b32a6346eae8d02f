import re

import numpy as np
import pytest
import xxhash

from graphloom.llm import simhash as S
from graphloom.llm.queries import queries


def plain_fingerprint(text):
    """The contract, word by word."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    if not shingles:
        return 0
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """fps: list of (id, fp). The least id reachable, all pairs compared."""
    values = np.array([f for _, f in fps], dtype=np.uint64)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3) + i + 1:
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, (d, _) in enumerate(fps)}


@pytest.mark.parametrize("text", ["", None, "A", "a B", "x y z", " The cat\tsat\x0bon É the the the mat ", "w " * 50, "a b c " * 400000])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_query_equals_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    wanted = plain_components(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries()["op8_simhash"](spark, sf_dir).collect()}
    assert got == {d: (f"{f:016x}", wanted[d]) for d, f in docs}


@pytest.mark.parametrize("full", [4096, 30, 3])
def test_full_nodes_are_divided_without_loss(spark, monkeypatch, full):
    """Dense values, so that nodes overflow at every depth."""
    rng = np.random.default_rng(7)
    values = np.zeros(400, dtype=np.uint64)
    for bit in rng.choice(64, 11, replace=False):
        values |= (rng.random(400) < 0.4).astype(np.uint64) << np.uint64(bit)
    far = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    values = np.unique(np.concatenate([values, far, far ^ np.uint64(5)]))
    monkeypatch.setattr(S, "NODE_MEMBERS", full)
    monkeypatch.setattr(S, "_search", _with_limit(full))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    joined = {r.node: r.root for r in S.stars(S.links(frame)).collect()}
    ids = values.view(np.int64).tolist()
    wanted = plain_components(list(zip(ids, values.tolist())))
    assert {i: joined.get(i, i) for i in ids} == wanted


def _with_limit(full):
    """The search with its limit set inside the worker too."""

    def search(batches):
        from graphloom.llm import simhash

        simhash.NODE_MEMBERS = full
        yield from simhash.__dict__["_search"](batches)

    return search


def test_odd_rows(spark):
    rows = [(5, None), (None, ""), (3, " \n"), (3, " \n"), (None, "only this one"), (9, "some other words"), (8, "some Other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS fp", "1 AS component_id", "2 AS _row", "3 AS root")
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (None, 3), (3, 3), (3, 3), (None, None), (9, 8), (8, 8)], key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.filter("doc_id is not null").collect()) == [(3, " \n"), (8, "some Other words")]
    assert [r.text for r in kept.filter("doc_id is null").collect()] == ["only this one"]
    twice = spark.createDataFrame([(1, "a text"), (1, "a text"), (1, "quite another one here")], "doc_id long, text string")
    assert sorted(r.text for r in S.keep_one(twice).collect()) == ["a text", "quite another one here"]
    assert S.near_duplicates(docs.limit(0)).count() == 0
