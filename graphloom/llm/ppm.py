"""Log-probabilities of texts by prediction by partial matching over bytes (PPM, escape method D, with exclusion).

A text is read as its words, A-Z lowered, joined by single spaces and closed by a line
end. The trie of byte contexts is a table: how often each byte followed each context of
up to ORDER bytes in all training texts. A byte that followed its longest known context
n times of T has the probability (n - 1/2) / T there. Otherwise the escape, half the
number of different followers over T, is paid, and the next shorter context is asked,
without the bytes that the longer one knows. These are all among the shorter one's
followers, so a context with the sum of its followers' counts in the next shorter one
says all that an exclusion needs. Last comes an even choice among the bytes never seen.

So the probability of a byte depends on the ORDER bytes before it and the counts alone,
and is found once for each different gram of ORDER + 1 bytes, in Spark, from the counts
of all documents. The table grows with the input and is not broadcast, but for the OFTEN
most frequent grams and words, which nearly every text has: documents are dealt to parts
of bounded bytes, each part names the grams and words it has, is joined with the values
of those that are not frequent, and its texts are scored with these.

Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import id_remainder
from .session import not_broadcast, packed
from .textkernels import PASS_BYTES, byte_runs, mix64, span_hashes, text_slices, word_spans

#: Bytes of the longest context; a gram of one more fits a long.
ORDER = 5
#: Bytes of texts of a part, about; a longer text is a part of its own.
PART_BYTES = 32 << 20
#: Different bytes that a text as read here can have: all but four kinds of white space.
BYTES = 252
#: Frequent grams and words, at most, that all tasks are sent; those beyond are joined.
OFTEN = 1 << 20
#: Ids whose crc32 has this remainder are not learned from.
HELD_DIVISOR, HELD = 5, 1
#: Pairs of key and count that a task holds before it adds equal ones up.
HELD_PAIRS = 1 << 22

_GAP, _END = 0x20, 0x0A
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _read(buf: np.ndarray, offsets: np.ndarray, tail: np.ndarray, closed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Grams of rows, where each row's begin, its words' hashes, where each row's begin, and the last bytes read.

    tail: the last bytes of what came before, for one row that goes on (its buffer then
    begins with white space); closed: whether a line end closes the rows.
    """
    rows = len(offsets) - 1
    wide = np.full(len(buf) + rows, _END, dtype=np.uint8)  # a byte more at the end of each row
    wide[np.arange(len(buf)) + np.repeat(np.arange(rows), np.diff(offsets))] = buf
    bounds = offsets + np.arange(rows + 1)
    starts, ends, heads = word_spans(wide, bounds)
    words = span_hashes(wide, starts, ends)
    kept = np.zeros(len(wide), dtype=bool)
    inside = np.zeros(len(wide) + 1, dtype=np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    kept[np.cumsum(inside[:-1], dtype=np.int8) > 0] = True
    later = np.ones(len(starts), dtype=bool)  # words with a gap before them
    if not len(tail):
        later[heads[:-1][np.diff(heads) > 0]] = False
    symbols = _LOWER[wide]
    symbols[starts[later] - 1] = _GAP
    kept[starts[later] - 1] = True
    if closed:
        symbols[bounds[1:] - 1] = _END
        kept[bounds[1:] - 1] = True
    begins = np.concatenate([[0], np.cumsum(kept)])[bounds]
    read = np.concatenate([tail, symbols[kept]])
    place = np.arange(len(read)) - np.repeat(begins[:-1] + len(tail) * (np.arange(rows) > 0), np.diff(begins) + len(tail) * (np.arange(rows) == 0))
    grams = read.astype(np.int64)
    for back in range(1, ORDER + 1):
        grams[back:] |= np.where(place[back:] >= back, read[:-back], 0).astype(np.int64) << (8 * back)
    return grams[len(tail) :], begins, words, heads, read[-ORDER:]


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, and of _read() the first four) of a column of texts; a long text gives several pieces."""
    none = np.zeros(0, dtype=np.uint8)
    for first, end, buf, offsets in text_slices(column):
        if end - first > 1 or len(buf) <= PASS_BYTES:
            yield first, end, *_read(buf, offsets, none, True)[:4]
            continue
        tail = none
        for a, b in byte_runs(buf):
            run = np.concatenate([np.full(1, _GAP, dtype=np.uint8), buf[a:b]])
            *found, tail = _read(run, np.array([0, len(run)]), tail, b == len(buf))
            yield first, end, *found


# --- what is gathered ------------------------------------------------------------------


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held_out, text) with the part they belong to, of about PART_BYTES."""
    task, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (size + np.cumsum(sizes) - sizes) // PART_BYTES + task
        size += int(sizes.sum())
        yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns], names=["part", "doc_id", "held_out", "text"])


class _Counts:
    """Keys with counts, equal ones added up now and then."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > HELD_PAIRS and len(self.keys) > 1:
            summed = self.summed()
            self.keys, self.counts, self.size = [summed[0]], [summed[1]], min(len(summed[0]), HELD_PAIRS // 2)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        keys, back = np.unique(np.concatenate(self.keys), return_inverse=True)
        return keys, np.bincount(back, np.concatenate(self.counts), len(keys)).astype(np.int64)


def _word_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of words: negative ones, as those of grams are not."""
    return (hashes | np.uint64(1 << 63)).view(np.int64)


def _counted(keys: np.ndarray, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, with how many of them stand in training texts."""
    known, back = np.unique(keys[trains], return_counts=True)
    others = np.setdiff1d(np.unique(keys[~trains]), known, assume_unique=True)
    return np.concatenate([known, others]), np.concatenate([back, np.zeros(len(others), dtype=np.int64)])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, doc_id, held_out, text to part, key, n: a part's different grams and words, with their number in training texts."""
    names = ["part", "key", "n"]
    part, grams, words = None, _Counts(), _Counts()

    def told() -> Iterator[pa.RecordBatch]:
        for counts in (grams, words):
            keys, n = counts.summed()
            for at in range(0, len(keys), 1 << 17):
                k, c = keys[at : at + (1 << 17)], n[at : at + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), part)), pa.array(k), pa.array(c)], names=names)

    for batch in batches:
        parts = batch.column(0).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]])
        for a, b in pairwise(cuts):
            if a == b:
                continue
            if part is not None and parts[a] != part:
                yield from told()
                grams, words = _Counts(), _Counts()
            part = parts[a]
            trains = ~batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False)
            for first, end, gram, begins, word, heads in _pieces(batch.column(3).slice(a, b - a)):
                own = trains[first:end]
                grams.add(*_counted(gram, np.repeat(own, np.diff(begins))))
                words.add(*_counted(_word_keys(word), np.repeat(own, np.diff(heads))))
    if part is not None:
        yield from told()


# --- the model -------------------------------------------------------------------------


def _bits(n: Column) -> Column:
    """A mask of n bytes, by the number of bytes."""
    masks = F.array(*[F.lit((1 << 8 * i) - 1) for i in range(ORDER + 2)])
    return F.get(masks, n)


def _suffixes(grams: DataFrame) -> DataFrame:
    """key and more to key, more, level, gram: each gram with all that end it; a level is the bytes of context."""
    levels = F.explode(F.array(*[F.lit(i) for i in range(ORDER + 1)]))
    return grams.withColumn("level", levels).withColumn("gram", F.col("key").bitwiseAND(_bits(F.col("level") + 1)))


def trie(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(level, gram, n) and (level, context, total, followers, covered) of grams (key, n > 0) of ORDER + 1 bytes.

    A gram's last byte stands lowest. `total` sums the counts of a context's followers,
    `covered` their counts in the next shorter context.
    """
    levels = packed(_suffixes(grams).groupBy("level", "gram").agg(F.sum("n").alias("n")))
    shorter = levels.select((F.col("level") + 1).alias("level"), F.col("gram").alias("rest"), F.col("n").alias("n_shorter"))
    told = levels.withColumn("rest", F.col("gram").bitwiseAND(_bits(F.col("level"))))
    met = told.join(not_broadcast(shorter), ["level", "rest"], "left")
    nodes = met.groupBy("level", F.shiftright("gram", 8).alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("followers"), F.coalesce(F.sum("n_shorter"), F.lit(0)).alias("covered")
    )
    return levels, packed(nodes)


def known_values(grams: DataFrame, nodes: DataFrame) -> DataFrame:
    """key, value: the log10 probability of the last byte after the others, of grams (key, n > 0) that the trie has."""
    top = nodes.filter(F.col("level") == ORDER).select("context", "total")
    known = grams.withColumn("context", F.shiftright("key", 8)).join(not_broadcast(top), "context")
    return known.select("key", F.log10((F.col("n") - 0.5) / F.col("total")).alias("value"))


def escaped_values(grams: DataFrame, levels: DataFrame, nodes: DataFrame) -> DataFrame:
    """The same for grams (key) that the trie doesn't have, once each: by ways through shorter contexts."""
    asked = _suffixes(grams.select("key")).withColumn("context", F.shiftright("gram", 8))
    met = asked.join(not_broadcast(nodes), ["level", "context"], "left").join(not_broadcast(levels), ["level", "gram"], "left")
    step = F.struct((-F.col("level")).alias("up"), "n", "total", "followers", "covered")
    paths = met.groupBy("key").agg(F.array_sort(F.collect_list(step)).alias("path"))  # ORDER + 1 steps

    def follow(so_far: Column, at: Column) -> Column:
        left, kinds = at["total"] - so_far["covered"], at["followers"] - so_far["followers"]
        found = so_far["value"] + F.log10((at["n"] - 0.5) / left)
        escaped = so_far["value"] + F.when(left > 0, F.log10(kinds * 0.5 / left)).otherwise(0.0)
        state = lambda value, covered, followers, done: F.struct(value.alias("value"), covered.alias("covered"), followers.alias("followers"), F.lit(done).alias("done"))
        return (
            F.when(so_far["done"] | at["total"].isNull(), so_far)
            .when(at["n"].isNotNull(), state(found, so_far["covered"], so_far["followers"], True))
            .otherwise(state(escaped, at["covered"], at["followers"], False))
        )

    begin = F.struct(F.lit(0.0).alias("value"), F.lit(0).cast("long").alias("covered"), F.lit(0).cast("long").alias("followers"), F.lit(False).alias("done"))
    finish = lambda s: F.when(s["done"], s["value"]).otherwise(s["value"] - F.log10(BYTES - s["followers"]))
    return paths.select("key", F.aggregate("path", begin, follow, finish).alias("value"))


# --- scores ----------------------------------------------------------------------------


def _lookup(keys: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A function from keys to their places, by a hash table; -1 for keys that aren't there."""
    bits = max(4, int(2 * len(keys)).bit_length())
    table, mask = np.full(1 << bits, -1, dtype=np.int32), (1 << bits) - 1
    slot_of = lambda k: (mix64(k.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
    left, slot = np.arange(len(keys), dtype=np.int32), slot_of(keys)
    while len(left):
        free = table[slot] < 0
        table[slot[free]] = left[free]
        lost = table[slot] != left
        left, slot = left[lost], (slot[lost] + 1) & mask

    def places(asked: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(asked), -1, dtype=np.int32)
        slot = slot_of(asked)
        found = table[slot]
        wrong = np.flatnonzero((found >= 0) & (keys[found] != asked))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & mask
            found[wrong] = table[slot[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (keys[found[wrong]] != asked[wrong])]
        return found

    return places


class Values:
    """Keys with the logarithm of their odds, and whether they are known."""

    def __init__(self, table: pa.Table) -> None:
        self.keys, self.values, self.known = (table.column(c).to_numpy() for c in ("key", "value", "known"))

    @cached_property
    def _places(self) -> Callable[[np.ndarray], np.ndarray]:
        return _lookup(self.keys)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_places"}

    def of(self, asked: np.ndarray, others: Values | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Values of keys, and which are known; those of absent keys come from `others`."""
        at = self._places(asked)
        absent = np.flatnonzero(at < 0)
        if len(absent) and others is None:
            raise KeyError("a gram or word without a value")
        value, known = (x[at] if len(x) else np.zeros(len(at), x.dtype) for x in (self.values, self.known))
        if len(absent):
            value[absent], known[absent] = others.of(asked[absent])
        return value, known


_SCORES = "doc_id {0}, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scored(docs: pa.Table, seldom: pa.Table, often: Values, end_value: float, end_known: bool) -> pa.Table:
    """The scores of a part's texts by the values of its seldom grams and words, and of frequent ones."""
    own, n = Values(seldom), docs.num_rows
    tokens, seen, base, score = np.ones(n, dtype=np.int64), np.full(n, int(end_known), dtype=np.int64), np.full(n, end_value), np.zeros(n)
    for first, end, gram, begins, words, heads in _pieces(docs.column("text")):
        rows = np.repeat(np.arange(end - first), np.diff(heads))
        value, known = often.of(_word_keys(words), own)
        tokens[first:end] += np.diff(heads)
        seen[first:end] += np.bincount(rows, known, end - first).astype(np.int64)
        base[first:end] += np.bincount(rows, value, end - first)
        rows = np.repeat(np.arange(end - first), np.diff(begins))
        score[first:end] += np.bincount(rows, often.of(gram, own)[0], end - first)
    return pa.table([docs.column("doc_id"), docs.column("held_out"), tokens, seen, base, score], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, HELD_DIVISOR) == HELD


def score_documents(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of all documents (doc_id, text).

    Learned from the rows that are not held out (a condition on docs; by default by
    their ids; a null id is learned from). Tokens are words and one end. base_score
    sums the logarithms of add-half word frequencies. A null text is an empty one, which
    has an end; without any row to learn from all bytes are equally likely, and the base
    is 0. Repeated rows count each. The parts and what they hold are stored in the
    checkpoint folder when this is called.
    """
    held = F.coalesce(held_out(F.col("doc_id")) if held is None else held, F.lit(False))
    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(_dealt, f"part long, doc_id {kind}, held_out boolean, text string")
    parts = packed(dealt)
    gathered = packed(parts.mapInArrow(_gathered, "part long, key long, n long"))
    counts = packed(gathered.groupBy("key").agg(F.sum("n").alias("n")))
    trained = parts.agg(F.count_if(~F.col("held_out")).alias("n")).first().n
    sums = counts.filter("key < 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n_all, kinds = sums.n + trained, sums.v + int(trained > 0)
    whole = n_all + 0.5 * (kinds + 1)

    levels, nodes = trie(counts.filter("key >= 0 AND n > 0"))
    # a class of frequency and all above it, OFTEN keys at most
    frequency = F.floor(F.log2("n") * 8)
    classes = counts.filter("n > 0").groupBy(frequency.alias("c")).count().orderBy(F.desc("c")).collect()
    whole_classes = np.cumsum([r["count"] for r in classes]) <= OFTEN
    least = min((r.c for r, kept in zip(classes, whole_classes, strict=True) if kept), default=None)
    is_often = F.lit(False) if least is None else (F.col("n") > 0) & (frequency >= least)

    def valued(rows: DataFrame, seldom: bool) -> DataFrame:
        grams = known_values(rows.filter("key >= 0 AND n > 0"), nodes)
        grams = grams.unionByName(escaped_values(rows.filter("key >= 0 AND n = 0"), levels, nodes)) if seldom else grams
        words = rows.filter("key < 0").select("key", F.log10((F.col("n") + 0.5) / F.lit(whole)).alias("value"), (F.col("n") > 0).alias("known"))
        return grams.withColumn("known", F.lit(False)).unionByName(words)

    often = docs.sparkSession.sparkContext.broadcast(Values(valued(counts.filter(is_often), False).toArrow()))
    others = gathered.select("part", "key").join(F.broadcast(counts.filter(is_often).select("key")), "key", "left_anti")
    others = others.join(not_broadcast(valued(counts.filter(~is_often), True)), "key").select("part", "key", "value", "known")
    end_value, end_known = math.log10((trained + 0.5) / whole), trained > 0
    scored = parts.groupBy("part").cogroup(others.groupBy("part")).applyInArrow(lambda a, b: _scored(a, b, often.value, end_value, end_known), _SCORES.format(kind))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
