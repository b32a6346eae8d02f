import math
import re
import zlib

import numpy as np
import pyarrow as pa

from graphloom.llm import toxicity as X
from graphloom.llm.textkernels import text_slices
from graphloom.llm.queries import queries


def buffer(texts):
    ((_, _, buf, offsets),) = text_slices(pa.array(texts, pa.string()))
    return buf, offsets


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = queries()["op3_toxicity"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p for p, y in held if y == 0]) < 0.01
    assert np.mean([p for p, y in held if y == 1]) > 0.8


def test_terms_and_lookups_agree():
    texts = ["Idiots are idiot, idiotic!", "", "ÉÉé idiot idiot", "no such thing", "x"]
    buf, offsets = buffer(texts)
    found = {}
    for row, term, _ in X.row_terms(buf, offsets):
        found.setdefault(term, set()).add(row)
    assert found[b"idiot"] == {0, 2} and found[b"idi*"] == {0, 2} and found[b"idiot*"] == {0}
    lexicon = X.Lexicon([b"idiot", b"such", b"thi*", b"idiot*"], np.arange(4), 4)
    votes = X._votes(lexicon, buf, offsets)
    assert votes.tolist() == [[True, False, False, True], [False] * 4, [True, False, False, False], [False, True, True, False], [False] * 4]


def cast_votes(rng, y, rates):
    votes = np.stack([rng.random(len(y)) < np.where(y, a, b) for a, b in rates], axis=1)
    votes = np.column_stack([votes, votes[:, 0]])
    return np.column_stack([votes, ~votes.any(axis=1)])


def test_label_model_estimates_rates_correlations_and_labels():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.3
    votes = cast_votes(rng, y, ((0.6, 0.005), (0.5, 0.005), (0.5, 0.03), (0.4, 0.003)))
    given = np.where(rng.random(6000) < 0.5, X.UNLABELLED, (y ^ (rng.random(6000) < 0.1)).astype(int))
    model = X.fit_label_model(votes, given)
    assert np.allclose(model.hit, votes[y, :-1].mean(axis=0), atol=0.08) and np.allclose(model.false, votes[~y, :-1].mean(axis=0), atol=0.02)
    assert abs(model.prior - 0.3) < 0.05
    assert model.weight[0] < 0.6 and model.weight[4] < 0.6 and model.weight[2] > 0.8
    assert 0.8 < model.right1 < 0.97 and 0.85 < model.right0 < 0.97  # true: 0.9


def test_votes_alone_teach_the_model():
    """Twelve independent voters; given labels, all right or some wrong, don't make it worse."""
    for seed in range(5):
        rng = np.random.default_rng(seed)
        y = rng.random(4000) < 0.15
        votes = np.where(y[:, None], rng.random((4000, 12)) < 0.45, rng.random((4000, 12)) < 0.02)
        votes = np.column_stack([votes, ~votes.any(axis=1)])
        none = np.full(4000, X.UNLABELLED)
        right = lambda given: ((X.fit_label_model(votes, given).posterior(votes, given) > 0.5) == y).mean()
        alone = right(none)
        model = X.fit_label_model(votes, none)
        assert alone > 0.98 and abs(model.prior - 0.15) < 0.02
        assert np.allclose(model.hit, 0.45, atol=0.1) and np.allclose(model.false, 0.02, atol=0.02)
        assert right(y.astype(int)) >= alone and right(np.where(rng.random(4000) < 0.3, y.astype(int), X.UNLABELLED)) >= alone - 0.001
        assert right((y ^ (rng.random(4000) < 0.15)).astype(int)) > 0.98


def test_wrong_labels_are_outvoted():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    votes = cast_votes(rng, y, ((0.6, 0.001), (0.6, 0.001), (0.5, 0.001), (0.6, 0.001)))
    wrong = rng.random(4000) < 0.15
    given = (y ^ wrong).astype(int)
    posterior = X.fit_label_model(votes, given).posterior(votes, given)
    several = votes[:, 1:4].sum(axis=1) >= 2
    assert ((posterior > 0.5) == y)[wrong & several].mean() > 0.95  # label 0 was given, the voters say 1
    assert ((posterior > 0.5) == y).mean() > (given == y).mean() + 0.05


def plain_score(model, text):
    """The score by a loop over words."""
    raw, lexicon = (text or "").encode(), model.lexicon
    words = [w.lower() for w in re.findall(rb"[A-Za-z\x80-\xff]+", raw)]
    votes = [0.0] * lexicon.voters
    for term, voter in zip(lexicon.terms, lexicon.voter):
        head = term.rstrip(b"*")
        if any(w == head if not term.endswith(b"*") else len(w) > len(head) and w.startswith(head) for w in words):
            votes[voter] = 1.0
    n = max(len(words), 1)
    cased = re.findall(rb"[A-Za-z\x80-\xff]+", raw)
    patterns = [
        sum(len(w) > 2 and all(65 <= c <= 90 for c in w) for w in cased) > 0.3 * n,
        raw.count(b"!") > 0.1 * n,
        sum(w in X._YOU for w in words) > 0.02 * n,
        sum(a == b for a, b in zip(words, words[1:])) > 0.3 * n,
    ]
    single = sum(votes[: lexicon.voters - X.POOLS])
    x = [*votes, single > 0, min(single, 4) / 2, *patterns, 1]
    return 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(x, model.linear))))))


def test_scores_equal_plain_ones(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = X.fit_documents(docs, labels)
    got = {r.doc_id: r.score for r in queries()["op3_toxicity"](spark, sf_dir).collect()}
    wanted = {r.doc_id: plain_score(model, r.text) for r in docs.collect()}
    assert got.keys() == wanted.keys() and max(abs(got[d] - wanted[d]) for d in got) < 1e-9
    assert max(wanted.values()) > 0.7 > min(wanted.values())


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "you total fool " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS toxic", "2 AS label")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.toxic_score for r in X.score_documents(docs, X.fit_documents(docs, none)).collect()} == {0.0}
    rng = np.random.default_rng(3)
    plain = lambda: " ".join("".join(rng.choice(list("aeioumnt"), 4)) for _ in range(20))
    texts = [f"{plain()} {plain()}" for _ in range(200)] + [f"{plain()} fool {plain()}" for _ in range(60)]
    many = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = spark.createDataFrame([(i, int(i >= 200)) for i in range(260)] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    model = X.fit_documents(many, told)
    scores = {r.doc_id: r.toxic_score for r in X.score_documents(many, model).collect()}
    assert min(scores[i] for i in range(200, 260)) > 0.7 > max(scores[i] for i in range(200))
    assert X.score_documents(docs, model).count() == 4
    assert X.score_documents(docs.limit(0), model).count() == 0
