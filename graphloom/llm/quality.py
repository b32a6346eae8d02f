"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its character,
word and repetition figures; gated attention, learned from document labels
only, weighs the passages, and the weighted mean is scored.
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
from .session import checkpointed
from .textkernels import span_hashes, text_slices, word_spans

#: Rows held out from learning: those of remainder HELD by HELD_DIVISOR.
HELD_DIVISOR, HELD = 4, 2
PASSAGE_WORDS = 100
#: The fit's bounds: labelled documents of a label, and their passages. All passages of a document that is learned from are.
SAMPLE_PER_LABEL = 1500
SAMPLE_PASSAGES = 30_000
ENCODED, GATES = 16, 8
EPOCHS, STEP, DECAY = 250, 0.03, 1e-4
PREDICT_AT = 0.7
ROWS_AT_ONCE = 4096

#: Byte classes: other, lower, upper, digit, stop or comma, exclamation or question, bracket or quote, symbol, bar, white, line end, beyond ASCII.
_CLASS = np.zeros(256, dtype=np.int64)
for _number, _members in enumerate(
    ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!?", "()[]{}\"'", "*$%&#@^~=+_<>\\/`", "|", " \t\v\f", "\r\n"), start=1
):
    _CLASS[[ord(c) for c in _members]] = _number
_CLASS[128:] = 11
CLASSES = 12
FIGURES = CLASSES + 8


def passage_figures(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Figures of each passage (passages x FIGURES), and where each row's passages begin (one more at the end).

    A passage is PASSAGE_WORDS words, the last one the rest; a text without words
    is one passage with all figures 0.
    """
    starts, ends, first = word_spans(buf, offsets)
    counts = np.diff(first)
    passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    bounds = np.zeros(len(first), dtype=np.int64)
    np.cumsum(passages, out=bounds[1:])
    n = int(bounds[-1])
    out = np.zeros((n, FIGURES), dtype=np.float32)
    if not len(starts):
        return out, bounds
    row = np.repeat(np.arange(len(counts)), counts)
    own = bounds[row] + (np.arange(len(starts)) - first[row]) // PASSAGE_WORDS
    words = np.bincount(own, minlength=n).astype(np.float32)
    some = np.maximum(words, 1)
    # a byte belongs to the passage of the last word that began at or before it, in its own text
    byte_row = np.repeat(np.arange(len(counts)), np.diff(offsets))
    last_word = np.searchsorted(starts, np.arange(len(buf)), side="right") - 1
    of_byte = np.maximum(np.where(last_word >= first[byte_row], own[np.maximum(last_word, 0)], bounds[byte_row]), bounds[byte_row])
    classes = np.bincount(of_byte * CLASSES + _CLASS[buf], minlength=n * CLASSES).reshape(n, CLASSES)
    out[:, :CLASSES] = np.sqrt(classes / np.maximum(classes.sum(axis=1, keepdims=True), 1))
    lengths = (ends - starts).astype(np.float64)
    mean = np.bincount(own, lengths, n) / some
    hashes = span_hashes(buf, starts, ends)
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    order = np.lexsort((hashes, own))
    repeated = np.zeros(len(starts), dtype=bool)
    repeated[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
    order = np.lexsort((np.arange(len(starts)), hashes, row))
    before = np.zeros(len(starts), dtype=bool)
    before[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    first_byte, last_byte = _CLASS[buf[starts]], _CLASS[buf[ends - 1]]
    figures = (
        np.log1p(mean),
        np.log1p(np.sqrt(np.maximum(np.bincount(own, lengths**2, n) / some - mean**2, 0))),
        np.bincount(own, again, n) / some,
        np.bincount(own, repeated, n) / some,
        np.bincount(own, before & (lengths > 6), n) / some,
        np.bincount(own, (last_byte == 7) | (last_byte == 5), n) / some,
        np.bincount(own, (first_byte == 2) & (last_byte != 1), n) / some,
        np.log1p(words),
    )
    out[:, CLASSES:] = np.stack(figures, axis=1)
    out[words == 0] = 0
    return out, bounds


@dataclass
class QualityModel:
    """Standardisation, encoder (w1, b1), gated attention (v, u, w) and scorer (c, c0)."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, figures: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        p, begin = self.parts, bounds[:-1]
        x = np.clip((figures - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["w1"] + p["b1"])
        tanh, gate = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (tanh * gate) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), np.diff(bounds)))
        attention = e / np.repeat(np.add.reduceat(e, begin), np.diff(bounds))
        z = np.add.reduceat(attention[:, None] * h, begin, axis=0)
        score = 1 / (1 + np.exp(-(z @ p["c"] + p["c0"])))
        return {"x": x, "h": h, "tanh": tanh, "gate": gate, "attention": attention, "z": z, "score": score}

    def scores(self, figures: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.forward(figures, bounds)["score"]


def fit(figures: np.ndarray, bounds: np.ndarray, labels: np.ndarray, seed: int = 11) -> QualityModel:
    """The model of labelled bags, by Adam on the whole sample; repeatable."""
    rng = np.random.default_rng(seed)
    mean, scale = figures.mean(axis=0), figures.std(axis=0) + 1e-3
    shapes = {"w1": (FIGURES, ENCODED), "b1": (ENCODED,), "v": (ENCODED, GATES), "u": (ENCODED, GATES), "w": (GATES,), "c": (ENCODED,), "c0": ()}
    parts = {k: rng.normal(0, 0.3, s) if s else np.zeros(()) for k, s in shapes.items()}
    model = QualityModel(mean, scale, parts)
    sizes = np.diff(bounds)
    bag = np.repeat(np.arange(len(labels)), sizes)
    first, second = {k: np.zeros_like(v) for k, v in parts.items()}, {k: np.zeros_like(v) for k, v in parts.items()}
    for t in range(1, EPOCHS + 1):
        f = model.forward(figures, bounds)
        d_score = (f["score"] - labels) / len(labels)
        d_z = d_score[:, None] * parts["c"]
        d_a = (d_z[bag] * f["h"]).sum(axis=1)
        inner = np.add.reduceat(f["attention"] * d_a, bounds[:-1])
        d_e = f["attention"] * (d_a - inner[bag])
        d_product = d_e[:, None] * parts["w"]
        d_v, d_u = d_product * f["gate"] * (1 - f["tanh"] ** 2), d_product * f["tanh"] * f["gate"] * (1 - f["gate"])
        d_h = (f["attention"][:, None] * d_z[bag] + d_v @ parts["v"].T + d_u @ parts["u"].T) * (1 - f["h"] ** 2)
        grads = {
            "w1": f["x"].T @ d_h, "b1": d_h.sum(axis=0), "v": f["h"].T @ d_v, "u": f["h"].T @ d_u,
            "w": (f["tanh"] * f["gate"]).T @ d_e, "c": f["z"].T @ d_score, "c0": d_score.sum(),
        }
        for k in parts:
            g = grads[k] + DECAY * parts[k] * (k != "c0")
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            parts[k] = parts[k] - STEP * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
        model.parts = parts
    return model


def _within(sizes: list[tuple[int, int, int]]) -> list[int]:
    """Keys of (label, key, passages) by rising key, as long as a label's passages stay within SAMPLE_PASSAGES; a document that alone has more is passed over."""
    left: dict[int, int] = {}
    chosen = []
    for label, key, n in sorted(sizes, key=lambda s: s[1]):
        if n <= left.setdefault(label, SAMPLE_PASSAGES):
            left[label] -= n
            chosen.append(key)
    return chosen


def fit_documents(docs: DataFrame, labels: DataFrame) -> QualityModel | None:
    """The model of a bounded sample of the labelled rows that are not held out; None without both labels.

    A sampled id's rows count once, with the text of the least hash. Figures are made
    and kept in Spark; the driver gets the documents' numbers of passages, and the
    figures (FIGURES numbers a passage) of those that SAMPLE_PASSAGES lets in.
    """
    told = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    told = told.filter(id_remainder(F.col("doc_id"), HELD_DIVISOR) != HELD)
    sample = bounded_sample(told, "label", SAMPLE_PER_LABEL, 2 * SAMPLE_PER_LABEL)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                found, bounds = passage_figures(buf, offsets)
                parts = [found[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                own = [batch.column(c).slice(first, end - first) for c in ("label", "key")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(bounds)), pa.array(parts, pa.binary())], names=["label", "key", "passages", "figures"])

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most about 2 * SAMPLE_PER_LABEL ids
    rows = rows.groupBy("label", "doc_id").agg(F.min_by("text", F.coalesce(F.xxhash64("text"), F.lit(0))).alias("text"))
    made = checkpointed(rows.withColumn("key", F.xxhash64("label", "doc_id")).mapInArrow(figures, "label int, key long, passages long, figures binary"))
    chosen = _within([tuple(r) for r in made.select("label", "key", "passages").collect()])
    if not chosen:
        return None
    keys = docs.sparkSession.createDataFrame([(k,) for k in chosen], "key long")
    found = sorted((r["label"], bytes(r["figures"])) for r in made.join(F.broadcast(keys), "key", "left_semi").select("label", "figures").collect())
    y = np.array([k for k, _ in found], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return None
    bags = [np.frombuffer(f, dtype=np.float32).reshape(-1, FIGURES) for _, f in found]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return fit(np.concatenate(bags).astype(np.float64), bounds, y)


def score_documents(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """All rows with `quality_score` added (0 to 1), from the whole text.

    Null texts count as empty, and these have a score too. Without a model every
    score is 0.5. Null ids, repeated rows and other columns pass through.
    """
    kept = [c for c in docs.columns if c != "quality_score"]
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                part = batch.slice(first, end - first)
                scores = np.full(end - first, 0.5) if told.value is None else told.value.scores(*passage_figures(buf, offsets))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(scores, pa.float64())], names=[*kept, "quality_score"])

    return docs.select(*kept).mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField("quality_score", T.DoubleType())]))
