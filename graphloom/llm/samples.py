"""Bounded, repeatable samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import hash60

#: Labels whose bounds are broadcast.
LABELS = 4000


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def sample_hash(*key: str) -> Column:
    """A 60-bit hash of the columns, the same in every run."""
    return hash60(F.concat(F.lit("sample:"), F.xxhash64(*key).cast("string")))


def bounded_sample(rows: DataFrame, label: str, per_label: int, most: int, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """About per_label keys of each label, and about `most` in all: those whose hash is least.

    A label's different keys are counted (by sketches, which need no exchange of rows)
    and a hash bound per label leaves about what is wanted, so nothing is ranked or
    gathered by label. Rows of one label and key count once, whatever their number;
    null keys are keys. Of more labels than `most` each keeps its share of keys, which
    for some is none. Bounds of up to LABELS labels are broadcast, those of more joined.
    """
    hashed = rows.withColumn("_h", sample_hash(label, *key))
    counts = hashed.groupBy(label).agg(F.approx_count_distinct("_h", 0.02).alias("_n"))
    kind = rows.schema[label].dataType.simpleString()
    found = counts.limit(LABELS + 1).collect()
    if not found:
        return rows.limit(0)
    n = len(found) if len(found) <= LABELS else counts.count()
    share = lambda of: min(1.0, min(per_label, most / n) / max(1, of))
    if len(found) <= LABELS:
        bounds = F.broadcast(rows.sparkSession.createDataFrame([(r[label], int(share(r["_n"]) * (1 << 60))) for r in found], f"`{label}` {kind}, _bound long"))
    else:
        bounds = counts.select(label, (F.least(F.lit(1.0), F.lit(min(per_label, most / n)) / F.greatest(F.lit(1), "_n")) * (1 << 60)).cast("long").alias("_bound"))
    near = hashed.join(bounds, label).filter(F.col("_h") <= F.col("_bound"))
    return near.dropDuplicates([label, "_h"]).select(rows.columns)
