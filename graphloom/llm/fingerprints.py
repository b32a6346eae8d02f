"""MinHash document fingerprints, and near-duplicate pairs from their bands.

A fingerprint is the least value of each of PERMUTATIONS universal hash
permutations over a text's word shingles. Two texts' share of equal places
estimates the Jaccard similarity of their shingle sets.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_hot
from .session import not_broadcast, settled
from .textkernels import shingle_hashes, text_slices

SHINGLE_WORDS = 5
PERMUTATIONS = 128
#: Bands of a fingerprint; rows of a band are PERMUTATIONS / BANDS. At similarity 0.8 a pair shares no band with odds of 1 to 40 million.
BANDS = 32
SIMILARITY = 0.8
#: Classes of a leader that are compared in one task; more are compared in pairs of blocks.
BLOCK_MEMBERS = 1024
#: Bits of the filter that spares the exchange of texts without candidates; a smaller one lets more through and loses none.
FILTER_BITS = 1 << 26
#: Shingles that are permuted at once.
SHINGLES_AT_ONCE = 2048

_rng = np.random.default_rng(97)
#: x -> a * x + b modulo 2**32, a odd: permutations of the 32-bit values.
_A = _rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
#: Fingerprint of a text without words: no text with words has all places greatest.
_EMPTY = np.full(PERMUTATIONS, 0xFFFF, dtype=np.uint16)


def signatures(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints (rows x PERMUTATIONS, the lower 16 bits of each minimum) of the texts in a flat buffer.

    A minimum shrinks with the number of shingles, so its upper bits tell long texts
    apart no more; its lower bits stay even.
    """
    hashes, bounds = shingle_hashes(buf, offsets, SHINGLE_WORDS)
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(offsets) - 1, PERMUTATIONS), 0xFFFFFFFF, dtype=np.uint32)
    work = np.empty((SHINGLES_AT_ONCE, PERMUTATIONS), dtype=np.uint32)
    for i in range(len(out)):
        for at in range(bounds[i], bounds[i + 1], SHINGLES_AT_ONCE):
            x = values[at : min(at + SHINGLES_AT_ONCE, bounds[i + 1])]
            part = work[: len(x)]
            np.multiply(x[:, None], _A, out=part)
            part += _B
            np.minimum(out[i], part.min(axis=0), out=out[i])
    short = (out & np.uint32(0xFFFF)).astype(np.uint16)
    short[np.diff(bounds) > 0] = np.minimum(short[np.diff(bounds) > 0], 0xFFFE)
    return short


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places, row by row: the estimated Jaccard similarity. Two texts without words are alike, one is like none with words."""
    return (a == b).mean(axis=-1)


def _texts_buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), offsets


def text_signatures(texts: list[str | None]) -> np.ndarray:
    """Fingerprints of texts; null counts as empty."""
    return signatures(*_texts_buffer([t or "" for t in texts]))


def to_hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """All rows with `fingerprint` (binary, 2 bytes a place) added; a null text counts as empty."""
    kept = [c for c in docs.columns if c != "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in text_slices(batch.column("text")):
                part = batch.slice(first, end - first)
                found = pa.array([s.astype(">u2").tobytes() for s in signatures(buf, offsets)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), found], names=[*kept, "fingerprint"])

    return docs.select(*kept).mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField("fingerprint", T.BinaryType())]))


# --- near-duplicate pairs -----------------------------------------------------

def _class() -> Column:
    return F.md5(F.coalesce("text", F.lit("")))


def near_duplicate_pairs(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): doc_id and class_id of each row; pairs (a, b, jaccard) of class ids, a < b.

    Rows of equal text form a class, named by the text's digest, so copies are not
    expanded. Classes that share a band of their fingerprints meet, and the Jaccard
    similarity of their shingle sets is computed exactly. Null texts count as empty;
    texts without words pair with none.
    """

    def pairs(ids: np.ndarray, left: int, right: np.ndarray, likeness: np.ndarray, out: dict[str, list]) -> None:
        for j, jaccard in zip(right, likeness, strict=True):
            out["a"].append(min(ids[left], ids[j]))
            out["b"].append(max(ids[left], ids[j]))
            out["jaccard"].append(jaccard)

    return docs.select("doc_id", _class().alias("class_id")), _verified(docs, similarity, pairs, "a string, b string, jaccard double")


def near_duplicate_links(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(class_id, n_links) of the classes with a verified link: to how many others. As near_duplicate_pairs, but no row a pair is made."""

    def ends(ids: np.ndarray, left: int, right: np.ndarray, _: np.ndarray, out: dict[str, list]) -> None:
        counts = out.setdefault("", Counter())
        counts[ids[left]] += len(right)
        counts.update(ids[right])

    return _verified(docs, similarity, ends, "class_id string, n_links long").groupBy("class_id").agg(F.sum("n_links").alias("n_links"))


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with words: class_id and the bytes of all places."""
    for batch in batches:
        for first, end, buf, offsets in text_slices(batch.column("text")):
            found = signatures(buf, offsets)
            part = batch.slice(first, end - first)
            rows = pa.RecordBatch.from_arrays([part.column("class_id"), pa.array([s.astype(">u2").tobytes() for s in found], pa.binary())], names=["class_id", "fingerprint"])
            yield rows.filter(pa.array((found != _EMPTY).any(axis=1)))


def _leaders(docs: DataFrame) -> DataFrame:
    """(c, leaders): of each class that shares a band with another, the least classes of its bands' buckets; c is the class's 64-bit hash.

    Two classes of one bucket have its leader in common, so they meet there; the
    classes of a near group mostly share few leaders, unlike buckets. A bucket that
    holds most classes shrinks to its least and greatest before it is exchanged.
    """
    width = 2 * PERMUTATIONS // BANDS
    classes = docs.select(_class().alias("class_id"), "text").mapInArrow(_band_keys, "class_id string, fingerprint binary")
    classes = classes.groupBy("class_id").agg(F.min("fingerprint").alias("fingerprint"))
    classes = settled(classes.select(F.xxhash64("class_id").alias("c"), "fingerprint"))
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("fingerprint", 1 + b * width, width)) for b in range(BANDS)])
    spread = classes.select("c", F.explode(keys).alias("key"))
    shared = spread.groupBy("key").agg(F.min("c").alias("leader"), F.max("c").alias("last")).filter("leader <> last")
    met = join_hot(spread, not_broadcast(shared.select("key", "leader")), ["key"])
    return met.groupBy("c").agg(F.array_sort(F.collect_set("leader")).alias("leaders"))


def _held_by(members: DataFrame) -> Callable[[Column], Column]:
    """A test of 64-bit hashes that all members pass and few others: one bit a member, FILTER_BITS at most, so texts of others need no exchange."""
    bit = F.pmod(F.col("c"), F.lit(FILTER_BITS))
    words = members.select((bit / 64).cast("int").alias("word"), (bit % 64).cast("int").alias("at"))
    told = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    table[told.column("word").to_numpy()] = told.column("bits").to_numpy()
    shared = members.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def held(c: pa.Array) -> pa.Array:
        at = np.mod(c.to_numpy(zero_copy_only=False), FILTER_BITS)
        return pa.array((shared.value[at // 64] >> (at % 64)) & 1 == 1)

    return held


def _verified(docs: DataFrame, similarity: float, tell: Callable, schema: str) -> DataFrame:
    """What `tell` makes of the pairs of classes that share a leader and whose shingle sets have at least the similarity.

    A full leader's classes are cut into blocks by hash, and each pair of blocks is
    one task's group. A pair counts at its least common leader only.
    """
    members = settled(_leaders(docs))
    named = docs.select(_class().alias("class_id"), "text").withColumn("c", F.xxhash64("class_id"))
    texts = named.filter(_held_by(members)(F.col("c"))).groupBy("class_id", "c").agg(F.first("text").alias("text"))
    sizes = members.select(F.explode("leaders").alias("leader")).groupBy("leader").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).cast("int").alias("blocks"))
    at = join_hot(members.select("*", F.explode("leaders").alias("leader")), not_broadcast(sizes), ["leader"])
    at = at.withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    at = at.select("c", "leaders", "leader", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    met = texts.join(not_broadcast(at), "c").drop("c")
    names = [f.split()[0] for f in schema.split(", ")]

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        leader, low, high = (k.as_py() for k in key)
        ids = np.array(table.column("class_id").to_pylist(), dtype=object)
        leaders = [frozenset(v) for v in table.column("leaders").to_pylist()]
        block = table.column("block").to_numpy()
        sets = []
        for _, _, buf, offsets in text_slices(table.column("text")):
            hashes, bounds = shingle_hashes(buf, offsets, SHINGLE_WORDS)
            sets += [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        sizes = np.array([len(s) for s in sets])
        right = np.flatnonzero(block == high)
        flat, places = np.unique(np.concatenate(sets), return_inverse=True)
        mine = np.split(places, np.cumsum(sizes)[:-1])
        others = np.concatenate([mine[j] for j in right]) if len(right) else places[:0]
        starts = np.concatenate([[0], np.cumsum(sizes[right])[:-1]]).astype(np.int64) if len(right) else None
        out: dict[str, list] = {n: [] for n in names}
        present = np.zeros(len(flat), dtype=np.int64)
        for i in np.flatnonzero(block == low) if len(right) else ():
            present[mine[i]] = 1
            shared = np.add.reduceat(present[others], starts)
            present[mine[i]] = 0
            jaccard = shared / (sizes[i] + sizes[right] - shared)
            near = jaccard >= similarity
            near &= (right > i) if low == high else (right != i)
            near[near] = [min(leaders[i] & leaders[j]) == leader for j in right[near]]
            if near.any():
                tell(ids, i, right[near], jaccard[near], out)
        if "" in out:
            counts = out.pop("")
            out = dict(zip(names, (list(counts), list(counts.values())), strict=True))
        kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
        return pa.table({f.split()[0]: pa.array(out[f.split()[0]], kinds[f.split()[1]]) for f in schema.split(", ")})

    return met.groupBy("leader", "low", "high").applyInArrow(compare, schema)


# --- documents against edited ones ----------------------------------------------


def _longs(values: list[int]) -> Column:
    """A constant array, as one literal however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _cuts_above(value: Column, cuts: list[int]) -> Column:
    """How many of the falling cuts are greater than a value, by two searches of about a root of their number."""
    if not cuts:
        return F.lit(0)
    run = round(len(cuts) ** 0.5) or 1
    last_of_runs = cuts[run - 1 :: run]
    greater = lambda among: F.size(F.filter(among, lambda c: c > value))
    whole = greater(_longs(last_of_runs)) * run if last_of_runs else F.lit(0)
    return whole + greater(F.slice(_longs(cuts), whole + 1, F.lit(run)))


def ring(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt to partitions by descending doc_id, each followed by the row that comes next.

    Adds _part, _ghost: a ghost is the first row of the next part, repeated at the
    end of this one (after the last part: of the first). Rows of an id stay in one
    part; null ids come last. Only as many bounds and first ids as parts reach the
    driver, and each text is exchanged once.
    """
    spark = docs.sparkSession
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], max(10_000, 20 * parts))).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    part = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(_cuts_above(F.col("doc_id"), cuts)).cast("int")
    heads = docs.select("doc_id").withColumn("_part", part).groupBy("_part").agg(F.max("doc_id").alias("head")).orderBy("_part").collect()
    if not heads:
        return docs.withColumn("_part", F.lit(0)).withColumn("_ghost", F.lit(False))
    parts_there = [h["_part"] for h in heads]
    ghost_part = dict(zip(parts_there, [parts_there[-1], *parts_there[:-1]], strict=True))
    ghost_of = _longs([ghost_part.get(p, 0) for p in range(len(cuts) + 1)])
    is_head = F.coalesce(F.col("doc_id").isin([h["head"] for h in heads if h["head"] is not None]), F.lit(heads[-1]["head"] is None))
    own = F.struct(F.col("_own").alias("_part"), F.lit(False).alias("_ghost"))
    ghost = F.struct(F.get(ghost_of, F.col("_own")).cast("int").alias("_part"), F.lit(True).alias("_ghost"))
    targets = F.when(is_head, F.array(own, ghost)).otherwise(F.array(own))
    spread = docs.withColumn("_own", part).withColumn("_to", F.explode(targets)).select(*docs.columns, "_to.*")
    order = ["_part", "_ghost", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")]
    return spread.repartitionById(len(cuts) + 1, F.col("_part")).sortWithinPartitions(*order)


_EDITED = (
    ("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()),
    ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType()),
)


_LINKED = (("class_id", T.StringType()), ("n_links", T.LongType()))


def edited(text: str, following: str) -> str:
    """The text with its last third of code points (rounded down) replaced by the first as many, or all, of the following one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def compare_with_edited(docs: DataFrame, parts: int | None = None, links: DataFrame | None = None) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    With links (of near_duplicate_links), each row also has its class_id and n_links.
    They travel as notes, rows without text before those they tell of, since a join
    would exchange texts or fingerprints once more.

    The next document is that of the next lower doc_id (after the least: of the
    greatest); rows with one id follow each other by text, null ids come last, and
    a lone row follows itself. Null texts count as empty. An empty table gives no row.
    """
    linked = links is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # the row before: id, text, fingerprint, whether it is a ghost
        known: dict[str, int] = {}
        for batch in batches:
            if linked:
                is_note = batch.column("n_links").is_valid()
                notes = batch.filter(is_note)
                known.update(zip(notes.column("class_id").to_pylist(), notes.column("n_links").to_pylist(), strict=True))
                batch = batch.filter(pa.compute.invert(is_note))
            for first, end, buf, offsets in text_slices(batch.column("text")):
                part = batch.slice(first, end - first)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, ghosts = part.column("doc_id").to_pylist(), part.column("_ghost").to_pylist()
                own = signatures(buf, offsets)
                rows = [*([last] if last else []), *zip(ids, texts, own, ghosts, strict=True)]
                last = rows[-1]
                pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if not a[3]]
                if not pairs:
                    continue
                changed = [edited(a[1], b[1]) for a, b in pairs]
                new = text_signatures(changed)
                mine, following = np.stack([a[2] for a, _ in pairs]), np.stack([b[2] for _, b in pairs])
                columns = [
                    pa.array([a[0] for a, _ in pairs], batch.schema.field("doc_id").type),
                    pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed], pa.string()),
                    pa.array([to_hex(m) for m in mine], pa.string()),
                    pa.array([to_hex(n) for n in new], pa.string()),
                    pa.array(likeness(mine, new), pa.float64()),
                    pa.array(likeness(mine, following), pa.float64()),
                ]
                if linked:
                    classes = [hashlib.md5(a[1].encode("utf-8", "surrogatepass")).hexdigest() for a, _ in pairs]
                    columns += [pa.array(classes, pa.string()), pa.array([known.get(c, 0) for c in classes], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(n for n, _ in told)])

    told = _EDITED + _LINKED if linked else _EDITED
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in told)])
    rows = docs.select("doc_id", "text")
    if linked:
        notes = docs.select("doc_id", _class().alias("class_id")).distinct()
        notes = join_hot(notes, not_broadcast(links), ["class_id"])
        notes = settled(notes.select("doc_id", "class_id", "n_links"))
        rows = rows.unionByName(notes, allowMissingColumns=True)
    return ring(rows, parts).mapInArrow(run, schema)
