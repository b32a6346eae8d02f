"""Saved event pages: rows of html, and the events in them.

The html is read once by a helper that keeps the few parts that matter; the
wide column is dropped before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.html import page_parts
from ..functions.text import event_id_of, markdown_to_text, trim_ws, utc_timestamp

_PARTS = (
    T.StructType().add("state", T.StringType()).add("json_ld", T.ArrayType(T.StringType())).add("h1", T.StringType()).add("page_description", T.StringType())
)
_ARROW_PARTS = [pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]

#: Columns of an event row, whatever it was read from.
EVENT_COLUMNS = (
    "id", "title", "description_md", "description_text", "datetime", "date", "url", "venue_name", "venue_address", "city", "group_slug", "group_name",
)


#: The id that a page is saved under, which its parser does not see.
_FILE_ID = "_file_id"
#: Which parser reads a page.
_KIND = "_kind"


def _page_files(spark: SparkSession, folder: str) -> DataFrame:
    """The .html files in folder/<group>/ as bytes; files that cannot be read, or went meanwhile, have no row. Many small files make one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html")
    return files.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).load(f"{folder}/*/")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """html, group_slug, event_id and path of the .html files in folder/<group>/ that can be read and are UTF-8; rejected_pages() tells the others. Empty files have no row in either."""
    path, html = F.col("path"), F.col("content").cast("string")
    return _page_files(spark, folder).filter(F.is_valid_utf8(html)).select(
        html.alias("html"),
        F.regexp_extract(path, r"([^/]+)/[^/]+\z", 1).alias("group_slug"),
        F.regexp_extract(path, r"([^/]+)\.html\z", 1).alias("event_id"),
        path.alias("path"),
    )


def rejected_pages(spark: SparkSession, folder: str) -> DataFrame:
    """path and reason of the .html files that read_pages() leaves out: `unreadable` or `not UTF-8`. Files are listed without their content, and read once."""
    read = _page_files(spark, folder).select("path", F.is_valid_utf8(F.col("content").cast("string")).alias("_valid"))
    told = _page_files(spark, folder).select("path").join(read, "path", "left")
    return told.filter("_valid IS NOT TRUE").select("path", F.when(F.col("_valid").isNull(), "unreadable").otherwise("not UTF-8").alias("reason"))


def with_parts(pages: DataFrame) -> DataFrame:
    """Pages with state, json_ld, h1 and page_description in place of html."""
    kept = [c for c in pages.columns if c != "html" and c not in _PARTS.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [page_parts(h) for h in batch.column("html").to_pylist()]
            new = [pa.array([p[i] for p in parts], kind) for i, kind in enumerate(_ARROW_PARTS)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], names=[*kept, *_PARTS.names])

    return pages.select(*kept, "html").mapInArrow(run, T.StructType([*(pages.schema[c] for c in kept), *_PARTS]))


def state_map(state: Column) -> Column:
    """The page's state: key to JSON text; null if the page has none."""
    return F.from_json(F.get_json_object(state, "$.props.pageProps.__APOLLO_STATE__"), "map<string,string>")


def json_string(json: Column, path: str) -> Column:
    """A string at a path of JSON text; numbers and other values count as absent."""
    value = F.try_variant_get(F.try_parse_json(json), path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _event_row(rows: DataFrame, **columns: Column) -> DataFrame:
    """Event rows from named columns; text and date follow from the description and the instant."""
    kept = [c for c in rows.columns if c in (_FILE_ID, _KIND)]
    told = rows.select(*[c.alias(n) for n, c in columns.items()], *kept)
    told = told.withColumn("description_text", markdown_to_text(F.col("description_md")))
    return told.withColumn("date", F.to_date("datetime")).select(*EVENT_COLUMNS, *kept)


def _referred(state: Column, event: Column, field: str) -> Column:
    return F.try_element_at(state, json_string(event, f"$.{field}.__ref"))


def _with_state_event(parts: DataFrame) -> DataFrame:
    """Parts with _state, its first `Event:` key's _event, and the _venue and _group that this refers to; null where there is none."""
    rows = parts.withColumn("_state", state_map(F.col("state")))
    keys = F.filter(F.map_keys("_state"), lambda k: k.startswith("Event:"))
    rows = rows.withColumn("_event", F.try_element_at("_state", F.array_min(keys)))
    rows = rows.withColumn("_venue", _referred(F.col("_state"), F.col("_event"), "venue"))
    return rows.withColumn("_group", _referred(F.col("_state"), F.col("_event"), "group"))


def _state_columns() -> dict[str, Column]:
    event = F.col("_event")
    return dict(
        id=F.coalesce(json_string(event, "$.id"), F.lit("unknown")),
        title=F.coalesce(json_string(event, "$.title"), F.lit("Untitled Event")),
        description_md=F.coalesce(json_string(event, "$.description"), F.lit("")),
        datetime=utc_timestamp(json_string(event, "$.dateTime")),
        url=F.col("url"),
        venue_name=json_string(F.col("_venue"), "$.name"),
        venue_address=json_string(F.col("_venue"), "$.address"),
        city=json_string(F.col("_venue"), "$.city"),
        group_slug=F.col("group_slug"),
        group_name=F.coalesce(json_string(F.col("_group"), "$.name"), F.col("group_slug")),
    )


def state_events(parts: DataFrame) -> DataFrame:
    """Event rows of pages with a state: its first `Event:` key, venue and group by reference, defaults for what is absent.

    parts needs state, group_slug and url.
    """
    return _event_row(_with_state_event(parts).filter("_event IS NOT NULL"), **_state_columns())


def state_metadata(parts: DataFrame, group_name: Column | None = None) -> DataFrame:
    """Event rows of the pages' own event: exactly `Event:{event_id}`, with a title; the venue by reference or inline."""
    rows = parts.withColumn("_state", state_map(F.col("state")))
    rows = rows.withColumn("_event", F.try_element_at("_state", F.concat(F.lit("Event:"), F.col("event_id"))))
    event = F.col("_event")
    by_name = json_string(event, "$.venue.__ref").isNotNull()
    rows = rows.filter(json_string(event, "$.title").isNotNull())
    rows = rows.withColumn("_venue", F.when(by_name, _referred(F.col("_state"), event, "venue")).otherwise(F.get_json_object(event, "$.venue")))
    return _event_row(
        rows,
        id=F.col("event_id"),
        title=json_string(event, "$.title"),
        description_md=F.coalesce(json_string(event, "$.description"), F.lit("")),
        datetime=utc_timestamp(json_string(event, "$.dateTime")),
        url=F.coalesce(json_string(event, "$.eventUrl"), F.lit("")),
        venue_name=json_string(F.col("_venue"), "$.name"),
        venue_address=json_string(F.col("_venue"), "$.address"),
        city=json_string(F.col("_venue"), "$.city"),
        group_slug=F.col("group_slug"),
        group_name=F.col("group_slug") if group_name is None else group_name,
    )


def _script() -> Column:
    """A page's first JSON-LD script of type Event, or null."""
    return F.get(F.filter("json_ld", lambda s: json_string(s, "$['@type']") == "Event"), F.lit(0))


def _script_columns() -> dict[str, Column]:
    event = F.col("_script")
    return dict(
        id=F.coalesce(event_id_of(F.col("url")), F.lit("unknown")),
        title=F.coalesce(json_string(event, "$.name"), F.lit("Untitled")),
        description_md=F.coalesce(json_string(event, "$.description"), F.lit("")),
        datetime=utc_timestamp(json_string(event, "$.startDate")),
        url=F.col("url"),
        venue_name=json_string(event, "$.location.name"),
        venue_address=json_string(event, "$.location.address.streetAddress"),
        city=json_string(event, "$.location.address.addressLocality"),
        group_slug=F.col("group_slug"),
        group_name=F.coalesce(json_string(event, "$.organizer.name"), F.col("group_slug")),
    )


def json_ld_events(parts: DataFrame) -> DataFrame:
    """Event rows of pages with a JSON-LD script of type Event; the first one counts."""
    return _event_row(parts.withColumn("_script", _script()).filter("_script IS NOT NULL"), **_script_columns())


def _html_columns() -> dict[str, Column]:
    nothing = F.lit(None).cast("string")
    return dict(
        id=F.coalesce(event_id_of(F.col("url")), F.lit("unknown")),
        title=F.coalesce(F.col("h1"), F.lit("Untitled Event")),
        description_md=F.coalesce(F.col("page_description"), F.lit("")),
        datetime=F.lit(None).cast("timestamp"),
        url=F.col("url"),
        venue_name=nothing,
        venue_address=nothing,
        city=nothing,
        group_slug=F.col("group_slug"),
        group_name=F.col("group_slug"),
    )


def html_events(parts: DataFrame) -> DataFrame:
    """Event rows of plain pages: the first h1 and the description element; no date, no venue."""
    return _event_row(parts, **_html_columns())


def page_events(pages: DataFrame) -> DataFrame:
    """One event row per page (html, url, group_slug): from its state, else JSON-LD, else the plain page.

    `source` names which; title talks are sought for the first kind only. Where the
    pages have an event_id, that of the file, it stays. All kinds are read in one pass.
    """
    parts = with_parts(pages)
    if "event_id" in parts.columns:
        parts = parts.withColumnRenamed("event_id", _FILE_ID)
    keys = F.filter(F.map_keys("_state"), lambda k: k.startswith("Event:"))
    rows = _with_state_event(parts).withColumn("_stated", F.coalesce(F.size(keys) > 0, F.lit(False)))
    rows = rows.withColumn("_script", F.when(~F.col("_stated"), _script()))
    rows = rows.withColumn(_KIND, F.when(F.col("_stated"), "state").when(F.col("_script").isNotNull(), "json_ld").otherwise("html"))
    rows = rows.filter((F.col(_KIND) != "state") | F.col("_event").isNotNull())
    by_kind = zip(_state_columns().items(), _script_columns().values(), _html_columns().values(), strict=True)
    columns = {n: F.when(F.col(_KIND) == "state", a).when(F.col(_KIND) == "json_ld", b).otherwise(c) for (n, a), b, c in by_kind}
    return _event_row(rows, **columns).withColumnsRenamed({_KIND: "source", _FILE_ID: "event_id"})


def event_links(parts: DataFrame) -> DataFrame:
    """(url, title) of all events in the pages' states, url without a slash at its end; the first title by page and key."""
    rows = parts.select("path", F.explode(state_map(F.col("state"))).alias("key", "event")).filter(F.col("key").startswith("Event:"))
    links = rows.select("path", "key", F.rtrim(json_string(F.col("event"), "$.eventUrl"), F.lit("/")).alias("url"), json_string(F.col("event"), "$.title").alias("title"))
    return links.filter("url IS NOT NULL").groupBy("url").agg(F.min_by("title", F.struct("path", "key")).alias("title"))


def page_title(html: Column) -> Column:
    """The text of the first h1 by pattern: for pages whose h1 holds no other element."""
    return F.nullif(trim_ws(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)), F.lit(""))
