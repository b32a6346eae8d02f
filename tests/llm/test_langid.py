import math
import zlib

import numpy as np

from graphloom.llm import langid as L
from graphloom.llm.queries import queries


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries()["op6_langid"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97
    assert sum(r.rejected for r in got) < 0.005 * len(got)


def test_far_texts_are_rejected():
    english = ["the cat sat on the mat and the dog ran to the house with them " * 5, "they were there when this thing was over and then they left " * 5]
    german = ["der hund lief schnell durch den wald und die katze schlief unter dem baum " * 5, "wir haben nicht gewusst dass ihr auch kommen werdet " * 5]
    model = L.fit(english * 8 + german * 8, ["en"] * 16 + ["de"] * 16)
    names, scores, rejected = L.predict(model, ["the dog and the cat were there", "die katze und der hund", "қазақ тілі бар " * 60, "123 ...", "", None])
    assert names[:2] == ["en", "de"] and names[3:] == ["und"] * 3
    assert not rejected[0] and not rejected[1] and rejected[2:].all()
    assert (scores[3:] == 0).all()


def plain_prediction(model, text):
    """Language, score and rejection by dictionaries of n-grams."""
    if not text or not any(map(str.isalpha, text)):
        return "und", 0.0, True
    folded = [b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()]
    counts, half = {}, L.DIMENSIONS // 2
    for n, base in ((2, 0), (3, half)):
        for i in range(len(folded) - n + 1):
            code = 0
            for b in folded[i : i + n]:
                code = code * 256 + b
            place = base + (code * 2654435761 % 2**32 >> 16) % half
            counts[place] = counts.get(place, 0) + 1
    vector = {k: math.log1p(v) * float(model.idf[k]) for k, v in counts.items()}
    norm = math.sqrt(sum(v * v for v in vector.values())) or 1
    best = {}
    for centroid, own in zip(model.centroids, model.language_of):
        best[own] = max(best.get(own, -1), sum(v / norm * float(centroid[k]) for k, v in vector.items()))
    top = max(best.values())
    least = model.least_cosine[min(int(math.log2(max(sum(counts.values()), 1))) // 2, L.CLASSES - 1)]
    return model.languages[max(best, key=best.get)], 1 / sum(math.exp(L.SHARPNESS * (v - top)) for v in best.values()), top < least


def test_predictions_equal_plain_ones(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.fit_documents(docs)
    got = {r.doc_id: r for r in queries()["op6_langid"](spark, sf_dir).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        name, score, rejected = plain_prediction(model, r.text)
        assert (got[r.doc_id].lang_pred, got[r.doc_id].rejected) == (name, rejected) and abs(got[r.doc_id].score - score) < 1e-3
    # document frequencies are those of all rows that may be learned from
    learned = [r.text for r in rows if r.text and r.lang and zlib.crc32(str(r.doc_id).encode()) % 5 and any(map(str.isalpha, r.text))]
    idf = np.log((1 + len(learned)) / (1 + (L.gram_counts(learned) > 0).sum(axis=0))) + 1
    assert np.allclose(model.idf, idf, atol=1e-5)


def test_an_unlearned_language_of_the_same_script_is_rejected(spark):
    model = L.fit_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. "
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem. "
    assert L.predict(model, [finnish * n for n in (5, 50)] + [polish * n for n in (5, 50)])[2].all()


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (1, "the cat and the dog", "en"), (None, None, None), (3, "", "de"), (4, "der hund und die katze", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'own' AS lang_pred")
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.lang_pred) for r in kept.collect()) == [(1, "own"), (1, "own"), (4, "own")]
    assert L.identify(docs.limit(0), None).count() == 0
    assert {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}
