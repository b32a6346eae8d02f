"""Talks of event rows: one vectorised reading of the texts alone, no shuffle."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import credits, lines
from ..functions.talktext import extract

def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


_TEXT = T.StringType()
_SPEAKERS = T.ArrayType(_struct(name=_TEXT, company=_TEXT, role=_TEXT, bio=_TEXT))
_PERSON = pa.struct([(n, pa.string()) for n in ("name", "company", "role", "bio")])
_ARROW_TALKS = pa.list_(pa.struct([("title", pa.string()), ("abstract", pa.string()), ("speakers", pa.list_(_PERSON)), ("order", pa.int32())]))

#: Rows of a bucket inside which batches are numbered.
BUCKET_ROWS = 65_536


@F.arrow_udf(T.ArrayType(_struct(title=_TEXT, abstract=_TEXT, speakers=_SPEAKERS, order=T.IntegerType())))
def _talks(description: pa.Array, title: pa.Array, text: pa.Array) -> pa.Array:
    told = [
        [
            {"title": t.title, "abstract": t.abstract, "order": i, "speakers": [{"name": s.name, "company": s.company} for s in t.speakers]}
            for i, t in enumerate(extract(*row))
        ]
        for row in zip(description.to_pylist(), title.to_pylist(), text.to_pylist(), strict=True)
    ]
    return pa.array(told, _ARROW_TALKS)


def with_talks(
    events: DataFrame, description: str = "description_md", title: str | None = "title", text: str = "description_text", titled: Column | None = None
) -> DataFrame:
    """Event rows with `talks`: title, abstract, speakers and order of each talk that has a speaker.

    Where the description has none, talks are sought in the event title, unless title
    is None or `titled` is not true; their abstract is taken from `text`. Only these
    columns leave the JVM.
    """
    nothing = F.lit(None).cast("string")
    own = nothing if title is None else F.col(title) if titled is None else F.when(titled, F.col(title))
    return events.withColumn("talks", _talks(F.col(description), own, F.col(text) if title else nothing))


def renumbered(talks):
    """Talks with at least one speaker, in order, numbered from 0."""
    kept = F.filter(talks, lambda t: F.size(t["speakers"]) > 0)
    return F.transform(kept, lambda t, i: t.withField("order", i.cast("int")))


def talk_rows(events: DataFrame) -> DataFrame:
    """One row per talk that has a speaker: the event's columns, talk and talk_order, from 0 within the event.

    The outer generator keeps Catalyst from testing the list before it is spread, which would read the texts twice.
    """
    spread = events.withColumn("_talks", F.filter("talks", lambda t: F.size(t["speakers"]) > 0)).drop("talks")
    rows = spread.select(*[c for c in spread.columns if c != "_talks"], F.posexplode_outer("_talks").alias("talk_order", "talk"))
    return rows.filter("talk IS NOT NULL")


def recover_descriptions(events: DataFrame, parsed: DataFrame) -> DataFrame:
    """Event rows whose text is empty take what the parsed page of the same id has: text, description and, where both sides have them, talks. Other fields stay.

    Only rows with an empty text are joined, so pages never meet the others.
    """
    taken = ["description_md", "description_text", *(["talks"] if "talks" in events.columns and "talks" in parsed.columns else [])]
    empty = F.coalesce(F.col("description_text"), F.lit("")) == ""
    mended = events.filter(empty).join(parsed.select("id", *[F.col(c).alias(f"_{c}") for c in taken]), "id", "left")
    mended = mended.withColumns({c: F.coalesce(f"_{c}", c) for c in taken})
    return events.filter(~empty).unionByName(mended.select(events.columns))


# --- what single lines are ------------------------------------------------------

def line_kinds(rows: DataFrame, line: str) -> DataFrame:
    """Rows with a struct `kinds` of booleans: what a line of an announcement can be. A null line counts as empty."""
    return rows.withColumn("kinds", lines.line_kinds(F.col(line)))


def credits_of(rows: DataFrame, line: str) -> DataFrame:
    """Rows with a struct `credit` of a credit line: all its speakers; read as one person; read as the field after a name; read as a company. A null line counts as empty."""
    return rows.withColumn("credit", credits.credit(F.col(line)))


# --- batches --------------------------------------------------------------------


def batch_positions(rows: DataFrame, key: str, size: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add bucket, batch, position (from 1) and batch_size: batches of at most `size` rows by key within hash buckets.

    Which rows share a batch has no meaning, so numbering stays inside buckets of about
    bucket_rows rows, and tasks grow in number, not in size; only a bucket's last batch
    is short. Rows are counted when the plan is made.
    """
    size, buckets = max(1, size), max(1, -(-rows.count() // bucket_rows))
    hashed = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    bucketed = rows.withColumn("bucket", (hashed % buckets).cast("int"))
    number = F.row_number().over(Window.partitionBy("bucket").orderBy(key)) - 1
    numbered = bucketed.withColumn("_n", number).withColumn("batch", F.floor(F.col("_n") / size).cast("int"))
    whole = Window.partitionBy("bucket", "batch")
    return (
        numbered.withColumn("position", (F.col("_n") % size + 1).cast("int"))
        .withColumn("batch_size", F.count("*").over(whole).cast("int"))
        .drop("_n")
    )
