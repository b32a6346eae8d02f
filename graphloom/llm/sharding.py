"""Histogram sort: shards of near-equal bytes, by counted key boundaries and one exchange.

Rows are ordered by (hash of text, hash of doc_id). A shard boundary is found by
counting the exact bytes below evenly spaced probe keys, across all partitions;
each round puts finer probes only into the intervals that still hold a wanted
boundary. Copies of one text share the first key, so the second one continues
where a single text outweighs a shard. Only probe counts reach the driver: at
most (shards - 1) * 2**DIGIT_BITS rows a round, whatever the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import cell_of, hash60, running_start
from .session import checkpointed

KEY_BITS = 60
DIGIT_BITS = 10
ROW_BYTES = 16
#: Cells of a shard in which its rows are numbered.
CELLS = 1024


@dataclass
class _Search:
    """A boundary that is being narrowed: bytes below the interval, and the interval's key prefix."""

    target: float
    below: int = 0
    text_key: int | None = None  # set once the interval holds one text only
    prefix: int = 0
    digits: int = 0


def keyed(docs: DataFrame) -> DataFrame:
    """Add _size (UTF-8 bytes of the text, null: none, plus ROW_BYTES), _k1 and _k2, the sort key.

    A null text has key 0; a null doc_id is hashed as the empty string.
    """
    return docs.select(
        "*",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES)).cast("long").alias("_size"),
        F.coalesce(hash60(F.col("text")), F.lit(0)).cast("long").alias("_k1"),
        hash60(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_k2"),
    )


def _bin(key: str, digits: int) -> Column:
    return F.shiftright(F.col(key), KEY_BITS - DIGIT_BITS * digits)


def _counts(keys: DataFrame, searches: list[_Search]) -> dict[tuple[int | None, int, int], list]:
    """Bytes of each probed interval, and the least and largest key in it, by (text key, digits, bin)."""
    wanted: dict[tuple[bool, int], list[_Search]] = {}
    for s in searches:
        wanted.setdefault((s.text_key is not None, s.digits), []).append(s)
    parts = []
    for (within_text, digits), group in wanted.items():
        if within_text:
            rows = keys.filter(F.col("_k1").isin(sorted({s.text_key for s in group})))
            key, text_key = "_k2", F.col("_k1")
        else:
            rows, key, text_key = keys, "_k1", F.lit(None).cast("long")
        if digits:
            rows = rows.filter(_bin(key, digits).isin(sorted({s.prefix for s in group})))
        parts.append(
            rows.groupBy(text_key.alias("text_key"), F.lit(digits).alias("digits"), _bin(key, digits + 1).alias("bin"))
            .agg(F.sum("_size").alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high"))
        )
    counted = parts[0]
    for p in parts[1:]:
        counted = counted.unionByName(p)
    bins: dict = {}
    for r in counted.collect():
        bins.setdefault((r["text_key"], r["digits"], r["bin"] >> DIGIT_BITS), []).append((r["bin"], r["bytes"], r["low"], r["high"]))
    return {k: sorted(v) for k, v in bins.items()}


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.0) -> list[tuple[int, int]]:
    """Keys (k1, k2) after which each next shard begins.

    A boundary is final when its interval holds a single key, or no more bytes
    than `tolerance` times a shard's; 0 makes boundaries exact to the row.
    Rows equal in text and doc_id stay together. An empty table has none.
    """
    total = keys.agg(F.sum("_size")).first()[0]
    if not total:
        return []
    searches = [_Search(target=total * j / shards) for j in range(1, shards)]
    found: dict[float, tuple[int, int]] = {}
    allowed = tolerance * total / shards
    top = (1 << KEY_BITS) - 1
    while searches:
        bins = _counts(keys, searches)
        open_ones = []
        for s in searches:
            below = s.below
            for number, size, low, high in bins[(s.text_key, s.digits, s.prefix)]:
                if below + size >= s.target:
                    break
                below += size
            s.below, s.prefix, s.digits = below, number, s.digits + 1
            if size <= allowed:
                found[s.target] = (s.text_key, high) if s.text_key is not None else (high, top)
            elif low == high and s.text_key is not None:
                found[s.target] = (s.text_key, high)
            elif low == high:
                s.text_key, s.prefix, s.digits = low, 0, 0
                open_ones.append(s)
            else:
                open_ones.append(s)
        searches = open_ones
    return [found[t] for t in sorted(found)]


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = 0.0, cells: int = CELLS) -> DataFrame:
    """All rows with two more columns: `shard`, and `slot`, gapless from 0 within a shard.

    Shards hold contiguous runs of the key order, of near-equal bytes (the text's
    UTF-8 bytes plus 16 for each row). Null texts and ids, empty texts and
    repeated rows are kept like any other; an empty table gives no row. Other
    columns pass through, but own ones named shard or slot, which are replaced.
    """
    kept = docs.select(*[c for c in docs.columns if c not in ("shard", "slot")])
    names = [F.col(f"`{c}`") for c in kept.columns if c not in ("doc_id", "text")]
    packed = kept.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *names).alias("_others"))
    done = _shard_documents(packed, shards, tolerance, cells)
    back = [F.col(c) if c in ("doc_id", "text") else F.col("_others")[c].alias(c) for c in kept.columns]
    return done.select(*back, "shard", "slot")


def _shard_documents(docs: DataFrame, shards: int, tolerance: float, cells: int) -> DataFrame:
    bounds = splitters(checkpointed(keyed(docs).select("_size", "_k1", "_k2")), shards, tolerance)
    shard = F.lit(0)
    for k1, k2 in bounds:
        shard = shard + ((F.col("_k1") > k1) | ((F.col("_k1") == k1) & (F.col("_k2") > k2))).cast("int")
    placed = keyed(docs).withColumn("shard", shard).withColumn("_cell", cell_of(F.col("_k2"), cells))
    numbered = running_start(placed, ["shard"], ["_k2", "doc_id"], F.lit(1).cast("long"), "slot", "_cell")
    return numbered.drop("_size", "_k1", "_k2", "_cell")
