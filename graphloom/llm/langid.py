"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's vector counts its hashed byte bigrams and trigrams, weighted by inverse
document frequency and normalised. Document frequencies are counted over all rows
that may be learned from. Each language has a few centroids, clustered from a
bounded sample of them; the nearest one by cosine names the language, and a text
that is clearly farther from it than the sample's texts of its length are is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .samples import bounded_sample, id_remainder
from .session import on_core
from .textkernels import text_slices

UNDETERMINED = "und"
#: Rows held out from learning: those of this remainder by HELD_DIVISOR.
HELD_DIVISOR = 5
#: Dimensions: bigrams hash into the first half, trigrams into the second.
DIMENSIONS = 4096
#: The fit's bounds: labelled rows of a language, and of all languages.
SAMPLE_PER_LANGUAGE = 600
SAMPLE_ROWS = 4000
CENTROIDS = 4
ROUNDS = 12
#: A text is rejected below this part of the FAR_QUANTILE of its length class: of the sample's cosines to the nearest centroid.
REJECT_PART = 0.85
FAR_QUANTILE = 0.005
#: Length classes: a text of 4**k to 4**(k+1) - 1 n-grams is of class k, the last one without an end.
CLASSES = 6
#: Sampled texts that give a class a limit of its own; a class of fewer takes that of the next shorter one.
CLASS_ROWS = 16
#: Sharpness of the score over the languages' cosines.
SHARPNESS = 25.0
ROWS_AT_ONCE = 256

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x80] = 0x20
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed n-grams (rows x DIMENSIONS); letters are lowered, ASCII that is no letter is a space."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    folded = _FOLD[np.frombuffer(b"".join(raw), dtype=np.uint8)].astype(np.uint32)
    row = np.repeat(np.arange(len(raw)), sizes)
    half = DIMENSIONS // 2
    counts = np.zeros(len(raw) * DIMENSIONS, dtype=np.int64)
    for n, base in ((2, 0), (3, half)):
        if len(folded) < n:
            continue
        code = folded[: len(folded) - n + 1].copy()
        for j in range(1, n):
            code = code * np.uint32(256) + folded[j : len(folded) - n + 1 + j]
        place = ((code * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(half)
        inside = row[: len(code)] == row[n - 1 :]
        counts += np.bincount(row[: len(code)][inside] * DIMENSIONS + base + place[inside], minlength=len(counts))
    return counts.reshape(len(raw), DIMENSIONS)


def _normalised(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class LanguageModel:
    languages: list[str]  # sorted
    idf: np.ndarray
    centroids: np.ndarray  # rows of unit length
    language_of: np.ndarray  # of each centroid
    least_cosine: np.ndarray  # of each length class: below it a text is rejected

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _normalised(np.log1p(counts).astype(np.float32) * self.idf)

    def cosines(self, vectors: np.ndarray) -> np.ndarray:
        """Cosine to the nearest centroid of each language (rows x languages)."""
        each = vectors @ self.centroids.T
        return np.stack([each[:, self.language_of == k].max(axis=1) for k in range(len(self.languages))], axis=1)


def _clusters(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; repeatable."""
    seeds = [_normalised(vectors.mean(axis=0, keepdims=True))[0]]
    nearest = vectors @ seeds[0]
    for _ in range(1, min(k, len(vectors))):
        seeds.append(vectors[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, vectors @ seeds[-1])
    centroids = np.stack(seeds)
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[own == i].sum(axis=0) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = _normalised(sums)
    return centroids


def length_class(grams: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(grams, 1)).astype(np.int64) // 2, CLASSES - 1)


def fit(texts: list[str], languages: list[str]) -> LanguageModel:
    """The model of labelled texts alone; at least one."""
    order = sorted(range(len(texts)), key=lambda i: (languages[i], texts[i]))
    texts, languages = [texts[i] for i in order], [languages[i] for i in order]
    counts = np.concatenate([gram_counts(texts[i : i + ROWS_AT_ONCE]) for i in range(0, len(texts), ROWS_AT_ONCE)])
    return fit_counts(counts, languages, len(counts), (counts > 0).sum(axis=0))


def fit_counts(counts: np.ndarray, languages: list[str], n: int, frequencies: np.ndarray) -> LanguageModel:
    """The model of the sample's n-gram counts, with the document frequencies of n texts."""
    idf = np.log((1 + n) / (1 + frequencies)).astype(np.float32) + 1
    names = sorted(set(languages))
    model = LanguageModel(names, idf, np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, np.int64), np.zeros(CLASSES))
    vectors = model.vectors(counts)
    own = np.array([names.index(x) for x in languages])
    parts = [_clusters(vectors[own == k], CENTROIDS) for k in range(len(names))]
    model.centroids = np.concatenate(parts).astype(np.float32)
    model.language_of = np.repeat(np.arange(len(names)), [len(p) for p in parts])
    nearest, of = model.cosines(vectors).max(axis=1), length_class(counts.sum(axis=1))
    limit = 0.0
    for k in range(CLASSES):
        if (of == k).sum() >= CLASS_ROWS:
            limit = REJECT_PART * float(np.quantile(nearest[of == k], FAR_QUANTILE))
        model.least_cosine[k] = limit
    return model


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are, and in how many of them each dimension occurs. Each task sums up its own rows, so only sums are exchanged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(DIMENSIONS + 1, dtype=np.int64)
        for batch in batches:
            for first, end, _, _ in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                found[:-1] += (gram_counts(batch.column("text").slice(first, end - first).to_pylist()) > 0).sum(axis=0)
                found[-1] += end - first
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(found[some], pa.int64())], names=["dimension", "n"])

    told = docs.select("text").mapInArrow(count, "dimension int, n long").groupBy("dimension").agg(F.sum("n").alias("n"))
    out = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in told.collect():  # at most DIMENSIONS + 1 rows
        out[r["dimension"]] = r["n"]
    return int(out[-1]), out[:-1]


def fit_documents(docs: DataFrame) -> LanguageModel | None:
    """The model of the rows with text and lang that are not held out; None without such rows.

    Only document frequencies and the sample's n-gram counts reach the driver. Rows
    that repeat id, text and lang are sampled once. Null ids are held out.
    """
    rows = docs.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.filter(id_remainder(F.col("doc_id"), HELD_DIVISOR) != 0).filter(F.col("text").rlike(r"\p{L}"))
    sample = bounded_sample(rows, "lang", SAMPLE_PER_LANGUAGE, SAMPLE_ROWS, ("doc_id", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                part = batch.slice(first, end - first)
                found = gram_counts(part.column("text").to_pylist()).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([f.tobytes() for f in found], pa.binary())], names=["lang", "counts"]
                )

    found = sorted((r["lang"], bytes(r["counts"])) for r in sample.mapInArrow(count, "lang string, counts binary").collect())
    if not found:
        return None
    counts = np.frombuffer(b"".join(c for _, c in found), dtype=np.float32).reshape(len(found), -1)
    return fit_counts(counts, [k for k, _ in found], *document_frequencies(rows))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predict(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether the text is rejected, for each text."""
    names = np.full(len(texts), UNDETERMINED, dtype=object)
    scores, rejected = np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
    some = np.array([i for i, t in enumerate(texts) if has_letter(t)], dtype=np.int64)
    if model is not None and len(some):
        counts = gram_counts([texts[i] for i in some])
        cosines = model.cosines(model.vectors(counts))
        best = np.argmax(cosines, axis=1)
        top = cosines[np.arange(len(some)), best]
        names[some] = np.array(model.languages, dtype=object)[best]
        scores[some] = np.clip(1 / np.exp(SHARPNESS * (cosines - top[:, None])).sum(axis=1), 0, 1)
        rejected[some] = top < model.least_cosine[length_class(counts.sum(axis=1))]
    return names.tolist(), scores, rejected


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """All rows with lang_pred, lang_score and lang_rejected added.

    A null text or one without a letter is `und`, score 0, rejected. Null ids,
    repeated rows and other columns pass through, but own columns of the three
    names, which are replaced. Without a model all rows are `und`.
    """
    added = {"lang_pred": T.StringType(), "lang_score": T.DoubleType(), "lang_rejected": T.BooleanType()}
    kept = [c for c in docs.columns if c not in added]
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                part = batch.slice(first, end - first)
                names, scores, rejected = predict(told.value, part.column("text").to_pylist())
                new = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *new], names=[*kept, *added])

    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(n, t) for n, t in added.items())])
    return docs.select(*kept).mapInArrow(run, schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is identified, columns as they are; the model is fitted on the documents themselves."""
    model = fit_documents(docs)
    return on_core(docs, lambda core: identify(core, model).filter("NOT lang_rejected").select(*core.columns))
