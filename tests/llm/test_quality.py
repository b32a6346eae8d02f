import math
import re
import zlib

import numpy as np

from graphloom.llm import quality as Q
from graphloom.llm.queries import queries
from graphloom.llm.textkernels import text_slices

import pyarrow as pa


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = queries()["op4_quality"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert np.mean(held) > 0.95


def figures(texts):
    ((_, _, buf, offsets),) = text_slices(pa.array(texts, pa.string()))
    return Q.passage_figures(buf, offsets)


def test_passages_do_not_depend_on_neighbours():
    texts = ["", "a b c", " x" * 250, "one", "   ", "é é !!", " ".join(["w"] * 100)]
    together, bounds = figures(texts)
    assert np.diff(bounds).tolist() == [1, 1, 3, 1, 1, 1, 1]
    for i, t in enumerate(texts):
        if t:
            alone, _ = figures([t])
            assert np.allclose(alone, together[bounds[i] : bounds[i + 1]], atol=1e-6), t
    assert (together[0] == 0).all() and (together[bounds[4]] == 0).all()


def test_gradient_finds_the_bad_passage():
    rng = np.random.default_rng(0)
    good = lambda n: rng.normal(0, 1, (n, Q.FIGURES))
    bags, labels = [], []
    for i in range(200):
        bag = good(rng.integers(2, 6))
        if i % 2:
            bag[rng.integers(len(bag)), :3] += 5
        bags.append(bag)
        labels.append(1 - i % 2)
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    model = Q.fit(np.concatenate(bags), bounds, np.array(labels, float))
    out = model.forward(np.concatenate(bags), bounds)
    assert np.mean((out["score"] > 0.5) == np.array(labels)) > 0.97
    assert np.allclose(np.add.reduceat(out["attention"], bounds[:-1]), 1)


def plain_score(model, text):
    """The score by loops over passages and words."""
    p, words = model.parts, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    raw, bags, seen = (text or "").encode(), [], set()
    for at in range(0, max(len(words), 1), Q.PASSAGE_WORDS):
        own = [w.lower() for w in words[at : at + Q.PASSAGE_WORDS]]
        if not own:
            bags.append(np.zeros(Q.FIGURES))
            continue
        end = starts[at + Q.PASSAGE_WORDS] if at + Q.PASSAGE_WORDS < len(words) else len(raw)
        part = raw[0 if at == 0 else starts[at] : end]
        counts = [0] * Q.CLASSES
        for b in part:
            counts[Q._CLASS[b]] += 1
        n, cased, lengths = len(own), words[at : at + Q.PASSAGE_WORDS], [len(w) for w in own]
        again = []
        for w in own:
            again.append(w in seen)
            seen.add(w)
        kinds = [(Q._CLASS[w[0]], Q._CLASS[w[-1]]) for w in cased]
        mean = sum(lengths) / n
        bags.append(np.array([
            *[math.sqrt(c / len(part)) for c in counts], math.log1p(mean), math.log1p(math.sqrt(max(sum(x * x for x in lengths) / n - mean**2, 0))),
            sum(a == b for a, b in zip(own, own[1:])) / n, (n - len(set(own))) / n, sum(a and x > 6 for a, x in zip(again, lengths)) / n,
            sum(b in (5, 7) for _, b in kinds) / n, sum(a == 2 and b != 1 for a, b in kinds) / n, math.log1p(n),
        ]))
    encoded = [np.tanh(np.clip((b - model.mean) / model.scale, -6, 6) @ p["w1"] + p["b1"]) for b in bags]
    gates = [math.exp((np.tanh(h @ p["v"]) / (1 + np.exp(-(h @ p["u"])))) @ p["w"]) for h in encoded]
    z = sum(g / sum(gates) * h for g, h in zip(gates, encoded))
    return 1 / (1 + math.exp(-(z @ p["c"] + p["c0"])))


def test_scores_equal_plain_ones(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = Q.fit_documents(docs, labels)
    got = {r.doc_id: r.score for r in queries()["op4_quality"](spark, sf_dir).collect()}
    wanted = {r.doc_id: plain_score(model, r.text) for r in docs.collect()}
    assert got.keys() == wanted.keys() and max(abs(got[d] - wanted[d]) for d in got) < 1e-4


def test_every_passage_is_learned_from(spark, monkeypatch):
    bags = []
    monkeypatch.setattr(Q, "fit", lambda figures, bounds, y: bags.append(np.diff(bounds)))
    docs = spark.createDataFrame([(1, "w " * 20_000), (2, "one")], "doc_id long, text string")
    Q.fit_documents(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int"))
    assert sorted(bags[0].tolist()) == [1, 200]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "a house " * 3000)], "doc_id long, text string").selectExpr("*", "1 AS quality", "1 AS label")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.quality_score for r in Q.score_documents(docs, Q.fit_documents(docs, none)).collect()} == {0.5}
    told = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    model = Q.fit_documents(docs, told)
    assert Q.score_documents(docs, model).count() == 4
    assert Q.score_documents(docs.limit(0), model).count() == 0


def test_passages_of_the_fit_are_bounded(spark, monkeypatch):
    """Whole documents by their keys, up to the bound; one beyond it alone is passed over, and repeated ids count once."""
    monkeypatch.setattr(Q, "SAMPLE_PASSAGES", 10)
    assert Q._within([(0, 5, 4), (0, 1, 4), (0, 3, 11), (0, 9, 3), (0, 8, 2), (1, 2, 10), (1, 4, 1)]) == [1, 2, 5, 8]
    seen = []
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda figures, bounds, labels: seen.append((len(figures), len(labels))) or fit(figures, bounds, labels))
    docs = spark.createDataFrame([(i % 30, "word " * (150 if i % 2 else 90) + str(i)) for i in range(3000)] + [(77, "x " * 5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(77, 1)], "doc_id long, quality int")
    assert Q.fit_documents(docs, labels) is not None
    assert seen[0][0] <= 20 and seen[0][1] <= 15
