import hashlib
import itertools
from collections import Counter

import numpy as np
import pytest

from graphloom.llm import fingerprints as M
from graphloom.llm.queries import queries


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_on_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in queries()["op1_fingerprints"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    errors, by_text = [], {}
    for (d, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        k = len(text) // 3
        changed = text[: len(text) - k] + following[:k]
        assert got[d].n_chars == len(text)
        assert got[d].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(text, got[d].fingerprint) == got[d].fingerprint
        errors += [got[d].near_edited - jaccard(text, changed), got[d].near_next - jaccard(text, following)]
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.2


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_ring_with_odd_rows(spark, parts):
    rows = [(7, "b b"), (None, "nul"), (5, None), (5, ""), (9, "a b c d e f"), (7, "a a"), (None, None), (1, "x y z" * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _part", "2 AS fingerprint")
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    wanted = []
    for a, b in zip(order, order[1:] + order[:1]):
        changed = M.edited(a[1] or "", b[1] or "")
        wanted.append((str(a[0]), len(a[1] or ""), hashlib.sha256(changed.encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256) for r in M.compare_with_edited(docs, parts).collect()]
    assert sorted(got) == sorted(wanted)
    lone = M.compare_with_edited(docs.filter("doc_id = 9"), parts).collect()
    assert [(r.near_next, r.n_chars) for r in lone] == [(1.0, 11)]
    assert M.compare_with_edited(docs.limit(0), parts).count() == 0


def test_near_duplicate_pairs_keep_every_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(12)]
    texts = base + base[:4] + [b + " extra tail" for b in base] + [" ".join(b.split()[:-1] + ["zz"]) for b in base[:6]] + ["", None, "one two"]
    monkeypatch.setattr(M, "BLOCK_MEMBERS", 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    membership, pairs = M.near_duplicate_pairs(docs)
    class_of = {r.doc_id: r.class_id for r in membership.collect()}
    assert len(class_of) == len(texts)
    found = {(r.a, r.b): r.jaccard for r in pairs.collect()}
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = texts[i] or "", texts[j] or ""
        assert (class_of[i] == class_of[j]) == (a == b)
        if a != b and a and b:
            exact, key = jaccard(a, b), tuple(sorted((class_of[i], class_of[j])))
            assert (key in found) == (exact >= 0.8)
            assert abs(found.get(key, exact) - exact) < 1e-12
    assert found


@pytest.mark.parametrize("words", [2000, 20_000, 200_000])
def test_long_unrelated_texts_are_unlike(words):
    texts = [" ".join(f"{name}{i}" for i in range(words)) for name in "ab"]
    texts.append(M.edited(*texts))
    a, b, changed = M.text_signatures(texts)
    assert M.likeness(a, b) < 0.03
    exact = jaccard(texts[0], texts[2])
    assert abs(M.likeness(a, changed) - exact) < 0.18


def test_query_tells_verified_links(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    of = {t: shingles(t) for t in set(texts.values())}
    links = dict.fromkeys(of, 0)
    for a, b in itertools.combinations(of, 2):
        if of[a] & of[b] and len(of[a] & of[b]) >= 0.8 * len(of[a] | of[b]):
            links[a] += 1
            links[b] += 1
    got = queries()["op1_fingerprints"](spark, sf_dir).select("doc_id", "class_id", "n_links").collect()
    assert {(r.doc_id, r.class_id, r.n_links) for r in got} == {(d, hashlib.md5(t.encode()).hexdigest(), links[t]) for d, t in texts.items()}
    assert any(links.values())


def test_links_are_found_among_all_pairs(spark):
    """Recall against all pairs of texts, by an exact count of shared shingles."""
    sf_dir = "/root/testdata/sf0.01"
    texts = sorted({r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()})
    sets, holders = [shingles(t) for t in texts], {}
    for i, own in enumerate(sets):
        for s in own:
            holders.setdefault(s, []).append(i)
    shared = Counter()
    for ids in holders.values():
        shared.update(itertools.combinations(ids, 2))
    exact = {(i, j) for (i, j), n in shared.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)}
    links = Counter(i for pair in exact for i in pair)
    got = {r.class_id: r.n_links for r in queries()["op1_fingerprints"](spark, sf_dir).select("class_id", "n_links").collect()}
    wanted = {hashlib.md5(t.encode()).hexdigest(): links[i] for i, t in enumerate(texts)}
    assert got == wanted and exact


@pytest.mark.parametrize("parts", [1, 7])
def test_links_reach_rows_of_odd_ids(spark, parts, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_MEMBERS", 3)
    base = " ".join(f"w{i}" for i in range(100))
    texts = [base + " " + "x" * i for i in range(1, 9)]
    rows = [*enumerate(texts), (None, texts[0]), (3, texts[5]), (3, None), (None, None), (4, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.compare_with_edited(docs, parts, M.near_duplicate_links(docs)).collect()
    told = [(str(r.doc_id), r.class_id, r.n_links) for r in got]
    assert sorted(told) == sorted((str(d), hashlib.md5((t or "").encode()).hexdigest(), 7 * (t in texts)) for d, t in rows)
