"""SimHash fingerprints and near-duplicate components, by a Gray-order hierarchical index.

Fingerprints at three or fewer differing bits are linked, and documents fall
into the connected components of the links. The index of the distinct
fingerprints has, at the top, masked bit patterns: 64 bits in five blocks, and a
node for each value of each two blocks. Two linked fingerprints differ in at
most three blocks, so they share such a node. Spark's shuffle builds these
nodes. In a node, the members stand by Gray rank, where neighbours differ little;
runs of them are factored into nodes that hold the bits all members share, level
by level, and a search adds up the differences on its way down and leaves a
whole group once they pass three.

A node of too many members is not searched: its members go on to nodes that fix
more bits, until a node's members differ in three bits at most and are linked
all together. So no task ever holds an unbounded group, and no link is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_hot
from .session import checkpointed, not_broadcast, on_core

#: Fixed by the contract.
SHINGLE_WORDS = 3
SEED = 42
MOST_DIFFERENCES = 3

#: Members of a node that one search takes; beyond, the node is divided.
NODE_MEMBERS = 4096
#: Members and child nodes of an index node.
FAN_OUT = 8
#: (query, node) pairs that a search holds at once.
FRONTIER = 1 << 17

#: Bytes of a text whose words are held at once.
RUN_BYTES = 1 << 20

_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def _word_runs(raw: bytes) -> Iterator[list[bytes]]:
    """The words in order, in lists of about RUN_BYTES, so that a huge text has no huge list."""
    at = 0
    while at < len(raw):
        cut = _WHITE.search(raw, at + RUN_BYTES)
        end = cut.start() if cut else len(raw)
        yield raw[at:end].split()
        at = end


def fingerprint(text: str | None) -> int:
    """SimHash of a text: bit b is 1 if it is set in over half of the shingles' XXH64 values; no word: 0."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    hashed, bits, count, carried = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), 0, []
    for run in _word_runs(raw):
        words = carried + run
        n = len(words)
        carried = words[-(SHINGLE_WORDS - 1) :]
        if n < SHINGLE_WORDS:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
        starts = [0, *(ends[: n - SHINGLE_WORDS] + 1).tolist()]
        spans = zip(starts, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)
        values = np.fromiter([hashed(line[a:b], SEED) for a, b in spans], dtype=np.uint64, count=len(starts))
        octets = values.astype(">u8").view(np.uint8).reshape(-1, 8)
        for i in range(8):
            bits[8 * i : 8 * i + 8] += np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS
        count += len(values)
    if not count:
        return hashed(b" ".join(carried), SEED) if carried else 0
    return int.from_bytes(np.packbits(2 * bits > count).tobytes(), "big")


def _with_fingerprint(docs: DataFrame) -> DataFrame:
    """All columns, and the fingerprint as _fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, "_fp"])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField("_fp", T.LongType())]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row, fp the fingerprint's 64 bits as a long. A null text counts as empty."""
    return _with_fingerprint(docs.select("doc_id", "text")).select("doc_id", F.col("_fp").alias("fp"))


# --- the index inside a node ------------------------------------------------


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray code."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Distinct fingerprints by Gray rank under nodes of shared bits.

    levels[0] is the top. A level has, for each node, the bits that its members
    share beyond those of the node above (mask) and their values; the last level
    is the members themselves.
    """

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        masks, shared = [np.full(len(values), np.uint64(2**64 - 1))], [self.values]
        while len(shared[-1]) > FAN_OUT:
            first = np.arange(0, len(shared[-1]), FAN_OUT)
            ones = np.bitwise_and.reduceat(shared[-1] & masks[-1], first)
            zeros = np.bitwise_and.reduceat(~shared[-1] & masks[-1], first)
            masks.append(ones | zeros)
            shared.append(ones)
        self.levels = []
        above = np.zeros(len(shared[-1]), dtype=np.uint64)
        for level in range(len(shared) - 1, -1, -1):
            own = masks[level] & ~above
            self.levels.append((own, shared[level] & own))
            if level:
                above = np.repeat(masks[level], FAN_OUT)[: len(shared[level - 1])]

    def near(self, most: int = MOST_DIFFERENCES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places (i < j) of members that differ in at most `most` bits, in chunks."""
        n = len(self.values)
        step = max(1, FRONTIER // max(1, n))
        for begin in range(0, n, step):
            queries = np.arange(begin, min(n, begin + step))
            top = len(self.levels[0][0])
            query, node = np.repeat(queries, top), np.tile(np.arange(top), len(queries))
            spent = np.zeros(len(query), dtype=np.uint8)
            for depth, (mask, bits) in enumerate(self.levels):
                spent = spent + np.bitwise_count((self.values[query] ^ bits[node]) & mask[node])
                keep = spent <= most
                query, node, spent = query[keep], node[keep], spent[keep]
                if depth + 1 < len(self.levels):
                    below = len(self.levels[depth + 1][0])
                    node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                    query, spent = np.repeat(query, FAN_OUT), np.repeat(spent, FAN_OUT)
                    keep = node < below
                    query, node, spent = query[keep], node[keep], spent[keep]
            keep = query < node
            yield query[keep], node[keep]


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place of each place's component."""
    label = np.arange(n)
    for a, b in pairs:
        while len(a):
            low = np.minimum(label[a], label[b])
            high = np.maximum(label[a], label[b])
            np.minimum.at(label, high, low)
            while not np.array_equal(label, label[label]):
                label = label[label]
            keep = label[a] != label[b]
            a, b = a[keep], b[keep]
    return label


def node_links(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined by all links among the values of a node: at most one for each value."""
    index = GrayIndex(values)
    label = _forest(len(values), index.near())
    inner = np.flatnonzero(label != np.arange(len(values)))
    return index.values[label[inner]], index.values[inner]


# --- nodes above: masked patterns, divided where they are full ---------------


def _divided(free: list[int], parts: int, kept: int) -> list[tuple[int, list[int]]]:
    """(mask, bits left free) for each choice of `kept` of `parts` blocks of the free bits."""
    blocks = [b.tolist() for b in np.array_split(np.array(free), parts)]
    out = []
    for choice in combinations(range(parts), kept):
        fixed = [b for i in choice for b in blocks[i]]
        out.append((sum(1 << b for b in fixed), [b for i in range(parts) if i not in choice for b in blocks[i]]))
    return out


#: Blocks into which a division cuts the free bits; all but MOST_DIFFERENCES of them are fixed, so a linked pair shares a node.
DIVISIONS = (5, 7)


def node_masks(depth: int, above: int = 0) -> list[int]:
    """Masks of the nodes below a node that fixes the bits of `above`; past the last division only MOST_DIFFERENCES bits stay free."""
    free = [b for b in range(64) if not above >> b & 1]
    parts = DIVISIONS[depth] if depth < len(DIVISIONS) else len(free)
    return [above | m for m, _ in _divided(free, parts, parts - MOST_DIFFERENCES)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


_LINKS = T.StructType().add("mask", T.LongType()).add("a", T.LongType()).add("b", T.LongType())


def _small_nodes(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links in nodes of at most FAN_OUT members, of which many stand one after the other: each is one leaf."""
    found = []
    for shift in range(1, FAN_OUT):
        same = keys[shift:] == keys[:-shift]
        if not same.any():
            break
        near = same & (np.bitwise_count(values[shift:] ^ values[:-shift]) <= MOST_DIFFERENCES)
        found.append((values[:-shift][near], values[shift:][near]))
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *(a for a, _ in found)]), np.concatenate([none, *(b for _, b in found)])


def _search(members: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the nodes in sorted (mask, key, fp) rows; members of a full node come out as rows without b."""

    def rows(mask: np.ndarray | int, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        masks = np.broadcast_to(np.asarray(mask, dtype=np.int64), len(a))
        other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(masks), pa.array(a.view(np.int64)), other], schema=_ARROW_LINKS)

    held: list[np.ndarray] = []  # members of the node that is still open at the end of a batch
    held_key: tuple[int, int] | None = None
    held_n, overfull = 0, False

    def close() -> Iterator[pa.RecordBatch]:
        if held_n > 1 and not overfull:
            yield rows(0, *node_links(np.concatenate(held)))

    for batch in members:
        mask, key, fp = (batch.column(c).to_numpy() for c in ("mask", "key", "fp"))
        fp = fp.view(np.uint64)
        if not len(fp):
            continue
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])]))
        sizes = np.diff(np.append(first, len(fp)))
        node = np.repeat(np.arange(len(first)), sizes)
        inner = np.ones(len(first), dtype=bool)
        inner[[0, -1]] = False  # these may go on in other batches
        small = np.repeat(inner & (sizes > 1) & (sizes <= FAN_OUT), sizes)
        if small.any():
            yield rows(0, *_small_nodes(node[small], fp[small]))
        for i in [0, *np.flatnonzero(inner & (sizes > FAN_OUT)).tolist(), *([len(first) - 1] if len(first) > 1 else [])]:
            part, of = fp[first[i] : first[i] + sizes[i]], (int(mask[first[i]]), int(key[first[i]]))
            if of != held_key:
                yield from close()
                held, held_key, held_n, overfull = [], of, 0, False
            held_n += len(part)
            if held_n > NODE_MEMBERS:
                yield rows(of[0], np.concatenate([*held, part]), None)
                held, overfull = [], True
            else:
                held.append(part)
    yield from close()


_ARROW_LINKS = pa.schema([("mask", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _star(members: DataFrame) -> DataFrame:
    """Links in nodes of the last depth, all of whose members differ in at most MOST_DIFFERENCES bits."""
    least = members.groupBy("mask", "key").agg(F.min("fp").alias("a"))
    return join_hot(members, least, ["mask", "key"]).filter("fp <> a").select("a", F.col("fp").alias("b"))


def links(distinct: DataFrame, rows: int | None = None) -> DataFrame:
    """Links (a, b) that join what is joined by all pairs of distinct `fp` at MOST_DIFFERENCES or fewer differing bits.

    rows: a bound of how many fingerprints there are, if it is known.
    """
    found, masks = None, node_masks(0)
    members = None if rows is None else rows * len(masks)
    top = F.array(*[F.lit(_signed(m)) for m in masks])
    spread = distinct.select("fp", F.explode(top).alias("mask"))
    for depth in range(len(DIVISIONS) + 1):
        nodes = spread.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp").distinct()
        if depth == len(DIVISIONS):
            own = _star(nodes)
            return found.unionByName(own)
        nodes = nodes.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        searched = checkpointed(nodes.mapInArrow(_search, _LINKS), members)
        own = searched.filter("b IS NOT NULL").select("a", "b")
        found = own if found is None else found.unionByName(own)
        full = searched.filter("b IS NULL").select(F.col("a").alias("fp"), "mask")
        above = {r["mask"]: r["count"] for r in full.groupBy("mask").count().collect()}  # at most as many as masks of this depth
        if not above:
            return found
        below = [(m, [_signed(x) for x in node_masks(depth + 1, m % (1 << 64))]) for m in above]
        members = sum(above[m] * len(more) for m, more in below)
        told = distinct.sparkSession.createDataFrame(below, "mask long, more array<long>")
        spread = full.join(F.broadcast(told), "mask").select("fp", F.explode("more").alias("mask"))


def stars(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(root, node) for every joined node that is not its component's least, by large and small stars in turn.

    A round hangs each node's greater neighbours on its least one, then its
    smaller ones. It reads the links only through minima and equi-joins, so a
    node with very many links spreads over tasks. rows: about how many links there
    are, if it is known.
    """
    edges = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), rows)
    seen = None
    while True:
        told = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (told["n"], told["s"]) == seen:
            return edges.select(F.col("a").alias("root"), F.col("b").alias("node"))
        seen = (told["n"], told["s"])
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_hot(both, least, ["u"]).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = join_hot(large, least, ["b"]).filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = checkpointed(small.unionByName(least.select(F.col("m").alias("a"), "b")).distinct(), told["n"])


def _classes(own: DataFrame, rows: int) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint; rows: how many rows own has."""
    classes = checkpointed(own.groupBy("fp").agg(F.min("doc_id").alias("least_id")), rows)
    n = classes.count()
    joined = stars(links(classes.select("fp"), n), n * len(node_masks(0)))  # about a link for each node that a fingerprint stands in
    members = joined.unionByName(joined.select("root", F.col("root").alias("node")).distinct())
    named = members.join(classes, members["node"] == classes["fp"]).select("root", "fp", "least_id")
    component = named.groupBy("root").agg(F.min("least_id").alias("component"))
    linked = join_hot(named, component, ["root"]).select("fp", "root", "component")
    return classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "least_id").alias("component_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the least doc_id that links lead to, its own included).

    Null texts count as empty, and texts without words share fingerprint 0. A null
    doc_id never names a component with another id in it. An empty table gives no row.
    """
    own = checkpointed(fingerprints(docs))
    return join_hot(own, _classes(own, own.count()), ["fp"]).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each component kept: that of the least doc_id.

    Where several rows could stay (repeated ids, or ids that are all null), the
    first by text, then by the other columns as JSON, stays. Columns stay as they are.
    Each text is exchanged once; a repeated id is met by its rows alone.
    """
    return on_core(docs, _keep_one)


def _keep_one(docs: DataFrame) -> DataFrame:
    own = checkpointed(fingerprints(docs))
    n = own.count()
    classes = checkpointed(_classes(own, n), n)
    # a component is named by the id that stays; only where an id is repeated, its rows may be of several components
    repeated = own.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1")
    kept = classes.select(F.col("component_id").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    kept = checkpointed(kept.join(repeated, "doc_id", "left").select("doc_id", F.col("_n").isNotNull().alias("_many")), n)
    rows = docs.join(not_broadcast(kept), "doc_id")
    plain = rows.filter("NOT _many").select(docs.columns)
    # rows that their id alone doesn't tell apart are placed by their own fingerprint
    unclear = rows.filter("_many").select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))
    placed = _first_rows(_with_fingerprint(unclear), ["_fp", "doc_id"], docs.columns)
    named = classes.select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), F.col("component_id").alias("_component"))
    placed = placed.join(named, "_fp").filter(F.col("doc_id").eqNullSafe(F.col("_component")))
    return plain.unionByName(_first_rows(placed.select("_root", "_row.*"), ["_root"], docs.columns).select("_row.*"))


def _first_rows(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """keys and `_row`: the first row of each key, by text (null last), then the other columns as JSON. Groups shrink before they are exchanged."""
    place = F.struct(F.col("text").isNull(), F.col("text"), F.to_json(F.struct(*[F.col(c) for c in names if c != "text"])))
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*names), place).alias("_row"))
