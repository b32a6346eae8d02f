"""Event pages in JSON, talk records in both serialisations, model answers and crawl records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import markdown_to_text, trim_ws, utc_timestamp
from .pages import EVENT_COLUMNS

_BROKEN = "_corrupt_record"


def event_page_rows(pages: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Event nodes of JSON response pages (`value`, `group_slug`): pages with errors are left out, and nodes without id, title or url.

    seen gets n_nodes and n_dropped, counted by the run that reads the rows.
    """
    told = pages.withColumn("_page", F.from_json("value", schemas.EVENT_PAGE))
    good = told.filter("_page.data IS NOT NULL AND _page.errors IS NULL")
    nodes = good.select("group_slug", F.explode("_page.data.groupByUrlname.events.edges").alias("_edge"))
    node = nodes.select("group_slug", F.from_json("_edge.node", schemas.EVENT_NODE).alias("node"))
    whole = F.expr("node.id IS NOT NULL AND node.title IS NOT NULL AND node.eventUrl IS NOT NULL")
    if seen is not None:
        node = node.observe(seen, F.count("*").alias("n_nodes"), F.count_if(~whole).alias("n_dropped"))
    return node.filter(whole)


def response_events(nodes: DataFrame) -> DataFrame:
    """Event rows of event nodes (struct `node`, `group_slug`): plain text, UTC instant and date, venue; the group's name is its slug."""
    told = nodes.select(
        F.col("node.id").alias("id"),
        F.col("node.title").alias("title"),
        F.coalesce("node.description", F.lit("")).alias("description_md"),
        utc_timestamp(F.col("node.dateTime")).alias("datetime"),
        F.col("node.eventUrl").alias("url"),
        F.col("node.venue.name").alias("venue_name"),
        F.col("node.venue.address").alias("venue_address"),
        F.col("node.venue.city").alias("city"),
        "group_slug",
        F.col("group_slug").alias("group_name"),
    )
    told = told.withColumn("description_text", markdown_to_text(F.col("description_md"))).withColumn("date", F.to_date("datetime"))
    return told.select(*EVENT_COLUMNS)


def read_event_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Event nodes of folder/<group>/*.json."""
    pages = spark.read.option("pathGlobFilter", "*.json").text(f"{folder}/*/", wholetext=True)
    return event_page_rows(pages.select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+\z", 1).alias("group_slug")))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Talk records of a folder's JSON files; `broken` marks files that are none, all of whose other columns are null."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return parse_records(files.select("value", F.col("_metadata.file_path").alias("path")))


def parse_records(texts: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Talk records (columns of schemas.RECORD, `path`, `broken`) of JSON texts (`value`, `path`), current or older format.

    Texts that are no JSON object, or have no id, are broken. seen gets n_files and
    n_broken, counted by the run that reads the records.
    """
    told = texts.withColumn("_record", F.from_json("value", f"{schemas.RECORD}, {_BROKEN} string", {"columnNameOfCorruptRecord": _BROKEN}))
    broken = F.col("_record").isNull() | F.col(f"_record.{_BROKEN}").isNotNull() | F.col("_record.id").isNull()
    names = ("schema_version", "id", "scraped_at", "source_file", "nodes", "edges")
    parsed = told.select("path", broken.alias("broken"), *[F.when(~broken, F.col(f"_record.{n}")).alias(n) for n in names])
    return parsed if seen is None else parsed.observe(seen, F.count("*").alias("n_files"), F.count_if("broken").alias("n_broken"))


def _bag(properties, drop_id: bool):
    """A property bag as JSON text: anything but an object is an empty bag; a bare `id` goes if asked."""
    is_object = F.coalesce(properties.rlike(r"\A\s*\{"), F.lit(False))
    text = F.when(is_object, properties).otherwise("{}")
    if not drop_id:
        return text
    without = F.to_json(F.map_filter(F.from_json(text, "map<string,variant>"), lambda k, v: k != "id"), {"ignoreNullFields": "false"})
    return F.when(text.contains('"id"'), without).otherwise(text)


def _spread(records: DataFrame, column: str, name: str) -> DataFrame:
    """(source_file, pos, name) of a list of good records; broken ones have none.

    The outer generator keeps Catalyst from testing texts and lists before they are spread, which would parse the texts again.
    """
    rows = records.select("source_file", F.posexplode_outer(F.when(~F.col("broken"), F.col(column))).alias("pos", name))
    return rows.filter("pos IS NOT NULL")


def record_nodes(records: DataFrame, drop_id: bool = False) -> DataFrame:
    """(source_file, pos, id, label, props) of all nodes of good records; drop_id removes the bag's own `id` as older files were loaded."""
    rows = _spread(records, "nodes", "n")
    props = _bag(F.coalesce("n.props", "n.properties"), drop_id)
    return rows.select("source_file", "pos", "n.id", F.coalesce("n.label", "n.type").alias("label"), props.alias("props"))


def record_edges(records: DataFrame) -> DataFrame:
    """(source_file, pos, src, dst, label, props) of all edges of good records."""
    rows = _spread(records, "edges", "e")
    return rows.select(
        "source_file",
        "pos",
        F.col("e.from").alias("src"),
        F.col("e.to").alias("dst"),
        F.coalesce("e.label", "e.type").alias("label"),
        _bag(F.coalesce("e.props", "e.properties"), False).alias("props"),
    )


def broken_records(records: DataFrame) -> DataFrame:
    """How many files were read, and how many were broken."""
    return records.agg(F.count("*").alias("n_files"), F.count_if("broken").alias("n_broken"))


# --- crawl records ---------------------------------------------------------------


def read_crawl(spark: SparkSession, folder: str) -> DataFrame:
    """Crawl records of three shapes (event, talk, speaker) under one schema, one file each."""
    return spark.read.schema(schemas.CRAWL_SOURCE).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)


def flatten_crawl(sources: DataFrame) -> DataFrame:
    """Extracted rows of crawl records: events with their text on one line, titled speakers and talks as they are.

    Speakers without a talk title give no row. A title loses one leading "[...]",
    a description its zero-width characters and runs of white space. All rows keep
    where they come from: source and extracted file, conference and meetup.
    """
    text = trim_ws(F.regexp_replace(F.translate("event.description", "\u200b\ufeff", ""), r"(?U)\s+", " "))
    none, no_tags = F.lit(None).cast("string"), F.array().cast("array<string>")
    key = F.concat(F.lit("talk:"), F.coalesce("conference_id", "meetup_id"), F.lit(":"), F.col("source_id"))
    origin = ("source_file", "extracted_file", "conference_id", "meetup_id")

    def rows(which, shape: str, title, speaker, url, tags, **event) -> DataFrame:
        told = {n: event.get(n, none) for n in ("event_id", "event_title", "description", "date_time", "end_time")}
        return sources.filter(which).select(
            "source_id", F.lit(shape).alias("shape"), key.alias("id"), title.alias("title"), speaker.alias("speaker_text"),
            url.alias("url"), tags.alias("tags"), *[c.alias(n) for n, c in told.items()], *origin,
        )

    is_event, is_person = F.col("event").isNotNull(), F.col("event").isNull() & F.col("name").isNotNull()
    events = rows(
        is_event, "event", trim_ws(F.regexp_replace("event.title", r"\A\s*\[[^\]]*\]", "")), none, F.col("event.eventUrl"), no_tags,
        event_id=F.col("event.id"), event_title=F.col("event.title"), description=text, date_time=F.col("event.dateTime"), end_time=F.col("event.endTime"),
    )
    people = rows(is_person & F.col("talk_title").isNotNull(), "speaker", F.col("talk_title"), F.col("name"), F.col("talk_url"), no_tags)
    talks = rows(
        ~is_event & ~is_person & F.col("title").isNotNull(), "talk", F.col("title"), F.col("speaker_text"), F.col("url"), F.coalesce("tags", no_tags)
    )
    return events.unionByName(people).unionByName(talks)
