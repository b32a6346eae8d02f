"""Ranked lexical search over posting lists that are blocked by the likeness of their documents.

Documents become vectors of the query items' terms. A task takes them shard by shard.
In a shard each term's posting list is clustered by document similarity (cosine of
random projections, evenly spaced members as first centres), and the clusters are its
blocks. A block is summarised by the coordinatewise maximum of its documents' vectors,
so an item's product with the summary is never less than the score of a document in it.
An item's terms are met from the heaviest on. A document with a heavier one was met
before, so a bound needs the terms from the present one on alone. A block whose bound
is less than the item's 50th best score so far is skipped, and nothing else is, but
for lists no block of which can reach it. Documents of other blocks are scored
exactly. A document that belongs to the result stands in a block that is not skipped,
that of its heaviest term, so the result is exact.

The best so far live on over a task's shards. They start from the 50th best score in a
hashed SEEDS-th of all documents, so a task passes on little but what can win, however
many tasks there are; the rest is one ranking by item.

Weights are products of integers, and bounds are sums of integers below 2**53, which
doubles hold exactly. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .session import checkpointed
from .textkernels import PASS_BYTES, byte_runs, span_hashes, text_slices, word_spans

#: Results of an item.
BEST = 50
#: Documents of a block, about.
BLOCK_DOCS = 64
#: Documents and postings of a shard, at most.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 20
#: Figures of a projected vector.
PROJECTED = 32
#: One document in so many gives the first thresholds.
SEEDS = 32
#: Text and number of the items that are sought in one reading of the vectors; more make more readings.
ITEM_BYTES, ITEMS = 1 << 20, 4096

#: Bytes between terms: ASCII but letters and digits.
_APART = np.zeros(256, dtype=bool)
_APART[:128] = [not chr(c).isalnum() for c in range(128)]
#: Impacts are below 10**6.
_IMPACT_BITS = 20


class Items:
    """Query items: ids, and for each its distinct terms, numbered over all items, ordered by hash."""

    def __init__(self, ids: pa.Array, texts: list[list[str | None]]) -> None:
        self.ids = ids
        own = []
        for told in texts:
            buf = "\n".join(t or "" for t in told).encode()
            raw = np.frombuffer(buf, dtype=np.uint8)
            starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), _APART)
            own.append(np.unique(span_hashes(raw, starts, ends)))
        self.hashes = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *own]))
        self.terms = [np.searchsorted(self.hashes, h) for h in own]

    def weigh(self, n_docs: int, holders: dict[int, int]) -> None:
        """Set the terms' weights, from the number of documents with a term and of those that hold each one; heaviest first, `order` gives their new numbers."""
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders.get(t, 0) + 1))) for t in range(len(self.hashes))], dtype=np.int64)
        falling = np.argsort(-weights, kind="stable")
        self.weights, self.order = weights[falling], np.argsort(falling)
        self.terms = [np.sort(self.order[t]) for t in self.terms]
        item = np.repeat(np.arange(len(self.terms)), [len(t) for t in self.terms])
        term = np.concatenate([np.zeros(0, dtype=np.int64), *self.terms])
        by_term = np.argsort(term, kind="stable")
        #: The items of all terms, term by term; where each term's begin; their places in the items' own order.
        self.askers, self.starts, self.places = item[by_term], np.searchsorted(term[by_term], np.arange(len(self.hashes) + 1)), by_term


def _vectors(hashes: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text to doc_id, n, terms, tfs: all terms counted, and those among the hashes by number."""
    for batch in batches:
        for first, end, buf, offsets in text_slices(batch.column(1)):
            rows, n, found = end - first, np.zeros(end - first, dtype=np.int64), []
            # a slice above the pass size is one long text
            for a, b in byte_runs(buf, _APART) if len(buf) > PASS_BYTES and rows == 1 else ((0, len(buf)),):
                bounds = offsets if rows > 1 else np.array([0, b - a])
                starts, ends, heads = word_spans(buf[a:b], bounds, _APART)
                n += np.diff(heads)
                h = span_hashes(buf[a:b], starts, ends)
                at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
                hit = np.flatnonzero(hashes[at] == h) if len(hashes) else np.zeros(0, dtype=np.int64)
                row = np.searchsorted(heads, hit, side="right") - 1
                found.append(np.unique(row * max(1, len(hashes)) + at[hit], return_counts=True))
            keys, back = np.unique(np.concatenate([k for k, _ in found] or [np.zeros(0, dtype=np.int64)]), return_inverse=True)
            tfs = np.bincount(back, np.concatenate([c for _, c in found] or [[]]), len(keys)).astype(np.int32)
            bounds = np.searchsorted(keys, np.arange(rows + 1) * max(1, len(hashes))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(bounds, pa.array(v.astype(np.int32))) for v in (keys % max(1, len(hashes)), tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, rows), pa.array(n), *lists], names=["doc_id", "n", "terms", "tfs"])


def _damping(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if int(n.max(initial=0)) * 50 * n_docs < 1 << 63:
        return 50 + 50 * n * n_docs // n_terms
    return np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], dtype=np.int64)


class Best:
    """The best documents of each item so far: rank by score, then id, null last."""

    def __init__(self, items: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.scores = [np.zeros(0, dtype=np.int64)] * items
        self.ids = [np.zeros(0, dtype=np.int64)] * items
        self.nulls = [np.zeros(0, dtype=bool)] * items

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        worth = (scores >= self.least[item]) & (scores > 0)
        if not worth.any():
            return
        scores, ids, nulls = (np.concatenate(p) for p in ((self.scores[item], scores[worth]), (self.ids[item], ids[worth]), (self.nulls[item], nulls[worth])))
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores[item], self.ids[item], self.nulls[item] = scores[order], ids[order], nulls[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], scores[order[-1]])


class Shard:
    """Some documents as rows of (term, impact), heaviest terms first, with the blocks of each term's posting list."""

    def __init__(self, items: Items, ids: np.ndarray, nulls: np.ndarray, offsets: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        self.items, self.ids, self.nulls, self.offsets = items, ids, nulls, offsets
        row = np.repeat(np.arange(len(ids)), np.diff(offsets))
        renumbered = items.order[terms]
        order = np.argsort(row * len(items.hashes) + renumbered)
        self.terms, self.impacts = renumbered[order], impacts[order]
        self.looked = self.skipped = 0
        by_term = np.argsort(self.terms, kind="stable")
        #: The postings term by term: document, place of its entry; where each term's begin.
        self.posted, self.placed, self.starts = row[by_term], by_term, np.searchsorted(self.terms[by_term], np.arange(len(items.hashes) + 1))
        self._projected = self._projections()

    def _projections(self) -> np.ndarray:
        axes = np.random.default_rng(11).standard_normal((len(self.items.hashes), PROJECTED), dtype=np.float32)
        values = (self.impacts * self.items.weights[self.terms]).astype(np.float32)
        out = np.zeros((len(self.ids), PROJECTED), dtype=np.float32)
        full = np.flatnonzero(np.diff(self.offsets))
        if len(full):
            out[full] = np.add.reduceat(axes[self.terms] * values[:, None], self.offsets[full], axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """(the term's postings, those of a block together; where blocks begin, and the end): clusters, cut where they have over twice BLOCK_DOCS."""
        postings = np.arange(self.starts[term], self.starts[term + 1])
        n = len(postings)
        k = -(-n // BLOCK_DOCS)
        if k <= 1:
            return postings, np.array([0, n])
        vectors = self._projected[self.posted[postings]]
        centre = (vectors @ vectors[(np.arange(k) * n) // k].T).argmax(axis=1)
        order = np.argsort(centre, kind="stable")
        begins = np.flatnonzero(np.diff(centre[order], prepend=-1))
        sizes = np.diff(begins, append=n)
        within = np.arange(n) - np.repeat(begins, sizes)
        cut = (within % BLOCK_DOCS == 0) & ((within == 0) | (np.repeat(sizes, sizes) - within >= BLOCK_DOCS))
        return postings[order], np.append(np.flatnonzero(cut), n)

    def bounds(self, term: int, postings: np.ndarray, begins: np.ndarray, asking: np.ndarray) -> np.ndarray:
        """For each block and each asking item, its product with the block's coordinatewise maximum, over terms from this one on."""
        own = [t[np.searchsorted(t, term) :] for t in (self.items.terms[i] for i in asking)]
        asked, of = np.unique(np.concatenate(own), return_inverse=True)
        place = np.full(len(self.items.hashes), -1)
        place[asked] = np.arange(len(asked))
        entries, heads = _spans(self.placed[postings], self.offsets[self.posted[postings] + 1])
        coordinate, block = place[self.terms[entries]], np.repeat(np.arange(len(begins) - 1), heads[begins[1:]] - heads[begins[:-1]])
        used = coordinate >= 0
        packed = ((block[used] * len(asked) + coordinate[used]) << _IMPACT_BITS) | self.impacts[entries[used]]
        packed.sort()
        last = np.append(np.flatnonzero(np.diff(packed >> _IMPACT_BITS)), len(packed) - 1)
        summary = np.zeros((len(begins) - 1) * len(asked))
        summary[packed[last] >> _IMPACT_BITS] = packed[last] & ((1 << _IMPACT_BITS) - 1)
        weights = np.zeros((len(asked), len(asking)))
        weights[of, np.repeat(np.arange(len(asking)), [len(t) for t in own])] = self.items.weights[asked[of]]
        return summary.reshape(-1, len(asked)) @ weights

    def scores(self, item: int, rows: np.ndarray) -> np.ndarray:
        weight = np.zeros(len(self.items.hashes), dtype=np.int64)
        weight[self.items.terms[item]] = self.items.weights[self.items.terms[item]]
        entries, heads = _spans(self.offsets[rows], self.offsets[rows + 1])
        return np.add.reduceat(self.impacts[entries] * weight[self.terms[entries]], heads[:-1])

    def _most(self) -> np.ndarray:
        """For each asker of each term, what its terms from that one on can give together in this shard."""
        most = np.zeros(len(self.items.hashes), dtype=np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        most[held] = np.maximum.reduceat(self.impacts[self.placed], self.starts[held]) if len(held) else 0
        most *= self.items.weights
        from_here = [np.cumsum(most[t][::-1])[::-1] for t in self.items.terms]
        return np.concatenate([np.zeros(0, dtype=np.int64), *from_here])[self.items.places]

    def search(self, best: Best) -> None:
        """Bring the best up to date by this shard's documents, heaviest terms first."""
        items, most = self.items, self._most()
        seen = np.zeros((len(items.terms), len(self.ids)), dtype=bool)
        for term in np.flatnonzero(np.diff(self.starts)):
            asked = slice(items.starts[term], items.starts[term + 1])
            asking = items.askers[asked]
            asking = asking[most[asked] >= best.least[asking]]
            postings, begins = self.blocks(term) if len(asking) else (None, None)
            if postings is None:
                self.skipped += -(-int(self.starts[term + 1] - self.starts[term]) // BLOCK_DOCS)
                continue
            found = self.bounds(term, postings, begins, asking)
            rows_of = self.posted[postings]
            for column, item in enumerate(asking):
                bound = found[:, column]
                falling = np.argsort(-bound, kind="stable")
                at, step = 0, 2
                while at < len(falling) and bound[falling[at]] >= best.least[item]:
                    chosen = falling[at : at + step]
                    chosen = chosen[bound[chosen] >= best.least[item]]
                    rows = np.concatenate([rows_of[begins[b] : begins[b + 1]] for b in chosen])
                    rows = rows[~seen[item, rows]]
                    seen[item, rows] = True
                    if len(rows):
                        best.add(item, self.scores(item, rows), self.ids[rows], self.nulls[rows])
                    self.looked += len(chosen)
                    at, step = at + len(chosen), 2 * step
                self.skipped += len(falling) - at


def _spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the spans, and where each span's stand."""
    heads = np.concatenate([[0], np.cumsum(ends - begins)])
    return np.repeat(begins - heads[:-1], ends - begins) + np.arange(heads[-1]), heads


def _shards(items: Items, n_docs: int, n_terms: int, batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Vectors (doc_id, n, terms, tfs), none without terms, in shards."""
    for batch in batches:
        ids, nulls = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
        sizes = np.asarray(batch.column(2).value_lengths())
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        terms, tfs = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
        damping = np.repeat(_damping(batch.column(1).to_numpy(), n_docs, n_terms), sizes)
        impacts = 1_000_000_000 * tfs // (1000 * tfs + 20 * damping)
        at = 0
        while at < len(ids):
            end = max(at + 1, min(at + SHARD_DOCS, int(np.searchsorted(offsets, offsets[at] + SHARD_POSTINGS, side="right")) - 1))
            a, b = offsets[at], offsets[min(end, len(ids))]
            yield Shard(items, ids[at:end], nulls[at:end], offsets[at : end + 1] - a, terms[a:b], impacts[a:b])
            at = end


_FOUND = "item int, doc_id long, score long"


def _local_best(vectors: DataFrame, items: Items, n_docs: int, n_terms: int, k: int, least: np.ndarray) -> DataFrame:
    """item (by number), doc_id, score: the k best of each task among documents that score `least` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.terms), k, least)
        for shard in _shards(items, n_docs, n_terms, batches):
            shard.search(best)
        number = np.repeat(np.arange(len(items.terms), dtype=np.int32), [len(s) for s in best.scores])
        ids, nulls, scores = (np.concatenate([np.zeros(0, dtype=kind), *parts]) for parts, kind in ((best.ids, np.int64), (best.nulls, bool), (best.scores, np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids, mask=nulls), pa.array(scores)], names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """item (by number), rank, doc_id, score of one block of items."""
    hashes = items.hashes
    vectors = checkpointed(docs.mapInArrow(lambda batches: _vectors(hashes, batches), "doc_id long, n long, terms array<int>, tfs array<int>"))
    sums = vectors.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.sum("n").alias("n_terms")).first()
    n_docs, n_terms = sums.n_docs, sums.n_terms or 0
    # as many rows as the items have terms
    items.weigh(n_docs, {r.term: r["count"] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()})
    held = vectors.filter(F.size("terms") > 0)
    least = np.zeros(len(items.terms), dtype=np.int64)
    seeds = held.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEEDS)) == 0)
    for r in _ranked(_local_best(seeds, items, n_docs, n_terms, k, least), k).filter(F.col("rank") == k).select("item", "score").collect():
        least[r.item] = r.score
    return _ranked(_local_best(held, items, n_docs, n_terms, k, least), k)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item by BM25-like integer scores above 0.

    docs: doc_id, text; items: item_id, text. Terms are runs of ASCII letters, digits
    and non-ASCII characters, A-Z lowered. Equal scores go by doc_id, null last. Each
    row of docs is a document, even if its id repeats; rows of one item_id (null is
    one) are one item with the terms of all its texts. Null texts have no terms; items
    without results have no rows. Items are read in blocks of ITEM_BYTES and ITEMS or
    so, which alone reach the driver and the tasks; vectors are written and counted
    when this is called.
    """
    docs = docs.select(F.col("doc_id").cast(LongType()), "text")
    asked = items.select("item_id", "text")
    sizes = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    blocks = max(1, -(-sizes.b // ITEM_BYTES), -(-sizes.n // ITEMS))
    kind = asked.schema["item_id"].dataType.simpleString()
    found = []
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else asked
        texts: dict = {}
        table = part.toArrow()
        for i, text in zip(table.column("item_id").to_pylist(), table.column("text").to_pylist(), strict=True):
            texts.setdefault(i, []).append(text)
        ids = pa.array(list(texts), table.schema.field("item_id").type)
        own = Items(ids, list(texts.values()))
        if not len(own.hashes):
            continue
        names = docs.sparkSession.createDataFrame(pa.table({"item": pa.array(np.arange(len(ids), dtype=np.int32)), "item_id": ids}))
        # a block's ids are bounded
        found.append(_search(docs, own, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
