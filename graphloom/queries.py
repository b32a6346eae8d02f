"""Registered queries over the driver tables, each with its SQL.

Names begin with the operator's row in the inventory. The star schema is read
as a property graph (plans.star): orders are talks, customers events, nations
groups and companies, suppliers speakers, parts projects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions import text as X
from .operators import batches, enrich, graph, traverse
from .operators.records import record_json, spread_edges, talk_records
from .operators.talks import batch_positions, recover_descriptions, talk_rows, with_talks
from .plans import star, workloads
from .registry import DEFAULT_DATE, EDGES, LINKS, LOTS, NODES, ORACLES, QUERIES, ROWS, RUN_TS, TALK_ID, TALKS, TO_TEXT, normal, plain, query, slug, trimmed
from .sources import pages, records, tables

def _docs(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "documents")


def _seeds(spark: SparkSession, *keys: int) -> DataFrame:
    """Seed speakers as constants, whose size Catalyst knows, so that it broadcasts them by itself."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(f"speaker:{k}") for k in keys])).alias("speaker"))


def _event_rows(spark: SparkSession, d: str) -> DataFrame:
    """documents as event rows."""
    return _docs(spark, d).select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("description_md"),
        X.markdown_to_text(F.col("text")).alias("description_text"),
        F.lit(None).cast("timestamp").alias("datetime"),
        F.lit(None).cast("date").alias("date"),
        F.concat(F.lit("https://example.org/events/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("group_slug"),
        F.col("source").alias("group_name"),
    )


# --- sources ------------------------------------------------------------------------


@query(f"WITH {TALKS} SELECT l_orderkey::VARCHAR AS id, count(*) AS n_nodes, count(DISTINCT person) AS n_people FROM talks GROUP BY 1")
def a2_response_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON response pages, read back, and their talks."""
    node = star.announcements(spark, d)
    events = F.struct(F.array(F.struct("node")).alias("edges"))
    page = F.struct(F.struct(F.struct(events.alias("events")).alias("groupByUrlname")).alias("data"))
    texts = node.select("group_slug", F.to_json(page).alias("value"))
    events = records.response_events(records.event_page_rows(texts))
    told = with_talks(events, title=None).select("id", F.explode("talks").alias("t"))
    people = told.select("id", F.get("t.speakers", F.lit(0))["name"].alias("person"))
    return people.groupBy("id").agg(F.count("*").alias("n_nodes"), F.count_distinct("person").alias("n_people"))


@query("SELECT count(*) AS n_nodes, count(*) FILTER (o_orderkey % 7 = 0) AS n_dropped, count(*) FILTER (o_orderkey % 7 <> 0) AS n_events FROM orders")
def a2_dropped_nodes(spark: SparkSession, d: str) -> DataFrame:
    """How many event nodes responses have and how many are dropped (every seventh has no title), counted while their events are. Runs when called."""
    key = F.col("o_orderkey").cast("string")
    node = F.struct(key.alias("id"), F.when(F.col("o_orderkey") % 7 != 0, key).alias("title"), key.alias("eventUrl"))
    page = F.struct(F.struct(F.struct(F.struct(F.array(F.struct(node.alias("node"))).alias("edges")).alias("events")).alias("groupByUrlname")).alias("data"))
    texts = star.table(spark, d, "orders").select(F.lit("g").alias("group_slug"), F.to_json(page).alias("value"))
    seen = Observation()
    n = records.event_page_rows(texts, seen).count()
    return spark.createDataFrame([(seen.get["n_nodes"], seen.get["n_dropped"], n)], "n_nodes long, n_dropped long, n_events long")


@query(f"""WITH {TALKS}, r AS (SELECT {TALK_ID} AS tid, * FROM talks), k AS (SELECT tid, max(l_orderkey::VARCHAR || '@' || c_nationkey) AS one FROM r GROUP BY 1)
SELECT 'talk:' || tid AS id, tid AS own_id FROM k""")
def a3_record_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Talk records written as JSON text and parsed again, broken texts beside them."""
    texts = record_json(workloads.events_to_records(records.response_events(star.announcements(spark, d)), RUN_TS, DEFAULT_DATE))
    both = texts.select(F.explode(F.array("value", F.lit("{"))).alias("value"), "path")  # texts are made once
    nodes = records.record_nodes(records.parse_records(both))
    return nodes.filter("label = 'Talk'").select("id", X.str_prop(F.col("props"), "id").alias("own_id")).distinct()


@query("""SELECT 'project:' || p_partkey AS id, 'Project' AS label, p_name AS name, '' AS own_id, 'project:' || p_partkey AS src, 'group:1' AS dst FROM part""")
def a4_older_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of the older serialisation: type and properties, a bare id in the bag dropped."""
    part = star.table(spark, d, "part")
    pid = F.concat(F.lit("project:"), F.col("p_partkey").cast("string"))
    node = F.struct(pid.alias("id"), F.lit("Project").alias("type"), F.struct(F.lit("x").alias("id"), F.col("p_name").alias("name")).alias("properties"))
    edge = F.struct(pid.alias("from"), F.lit("group:1").alias("to"), F.lit("PART_OF").alias("type"))
    whole = F.struct(pid.alias("id"), pid.alias("source_file"), F.array(node).alias("nodes"), F.array(edge).alias("edges"))
    parsed = records.parse_records(part.select(F.to_json(whole).alias("value"), pid.alias("path")))
    nodes = records.record_nodes(parsed, drop_id=True)
    name, own = X.str_prop(F.col("props"), "name").alias("name"), X.str_prop(F.col("props"), "id").alias("own_id")
    edges = records.record_edges(parsed).select("source_file", "src", "dst")
    return nodes.join(edges, "source_file").select("id", "label", name, own, "src", "dst")


@query(f"""WITH {TALKS}, r AS (SELECT {TALK_ID} AS id, 'source/group-' || c_nationkey || '/' || l_orderkey || '.html' AS source_file FROM talks)
SELECT id, max(source_file) AS source_file FROM r GROUP BY id""")
def a5_last_record(spark: SparkSession, d: str) -> DataFrame:
    """One record per talk id: the last one written."""
    told = with_talks(records.response_events(star.announcements(spark, d)), title=None)
    whole = talk_records(talk_rows(told), schemas.HEURISTIC_VERSION, RUN_TS, DEFAULT_DATE)
    # only what is told is exchanged: Spark drops no column of the struct that is chosen by
    return tables.last_records(whole.select("id", "scraped_at", "source_file")).select("id", "source_file")


# --- projections and filters ----------------------------------------------------------


@query(f"""SELECT o_orderkey::VARCHAR AS id, 'Evening ' || o_orderkey AS title, o_orderdate::DATE + 1 AS date,
  strftime(o_orderdate + INTERVAL 28 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') AS instant, 'group-' || c_nationkey AS group_name
FROM orders JOIN customer ON o_custkey = c_custkey""")
def b1_event_rows(spark: SparkSession, d: str) -> DataFrame:
    events = records.response_events(star.announcements(spark, d))
    return events.select("id", "title", "date", X.rfc3339(F.col("datetime")).alias("instant"), "group_name")


@query(rf"""SELECT page_id, coalesce(nullif({trimmed("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, ''), 'Untitled Event') AS title,
  coalesce(nullif(regexp_extract(url, '/events/(\d+)', 1), ''), 'unknown') AS event_id FROM pages""")
def b5_plain_pages(spark: SparkSession, d: str) -> DataFrame:
    """First h1 and event id of plain pages, by pattern."""
    told = star.table(spark, d, "pages")
    return told.select(
        "page_id",
        F.coalesce(pages.page_title(F.col("html")), F.lit("Untitled Event")).alias("title"),
        F.coalesce(X.event_id_of(F.col("url")), F.lit("unknown")).alias("event_id"),
    )


@query("""WITH s AS (SELECT 'https://example.org/events/' || page_id % 97 AS url, min_by('Page ' || page_id, printf('%012d', page_id)) AS title FROM pages GROUP BY 1)
SELECT * FROM s""")
def b7_event_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of events in page states made of the pages' keys: slashes trimmed, the first title per url."""
    told = star.table(spark, d, "pages")
    event = F.struct(
        F.concat(F.lit("https://example.org/events/"), (F.col("page_id") % 97).cast("string"), F.lit("/")).alias("eventUrl"),
        F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"),
    )
    inner = F.to_json(F.create_map(F.concat(F.lit("Event:"), F.col("page_id").cast("string")), event))
    state = F.concat(F.lit('{"props":{"pageProps":{"__APOLLO_STATE__":'), inner, F.lit("}}}"))
    return pages.event_links(told.select(F.format_string("%012d", "page_id").alias("path"), state.alias("state")))


def _lot_talks(spark: SparkSession, d: str) -> DataFrame:
    """Orders with `talks` made of their lines; lines of small quantity have no speaker."""
    lines = star.table(spark, d, "lineitem")
    people = F.when(F.col("l_quantity") > 5, F.array(F.struct(F.col("l_suppkey").cast("string").alias("name")))).otherwise(F.array().cast("array<struct<name:string>>"))
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", people.alias("speakers"))
    told = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("talks"))  # an order has few lines
    return told.select("l_orderkey", F.transform("talks", lambda t: F.struct(t["l_partkey"].alias("part"), t["speakers"].alias("speakers"))).alias("talks"))


@query("SELECT l_orderkey, count(*) AS n_talks FROM lineitem WHERE l_quantity > 5 GROUP BY 1")
def b8_talks_with_speakers(spark: SparkSession, d: str) -> DataFrame:
    """Talks without a speaker are dropped, and events without any other talk."""
    return talk_rows(_lot_talks(spark, d)).groupBy("l_orderkey").agg(F.count("*").alias("n_talks"))


@query(f"SELECT doc_id FROM documents WHERE octet_length(encode({trimmed('text')})) >= 50")
def b9_long_descriptions(spark: SparkSession, d: str) -> DataFrame:
    return batches.long_enough(_docs(spark, d), "text").select("doc_id")


@query("SELECT source AS group_slug, count(*) AS n FROM documents WHERE source IN ('src1', 'src3', 'src8') GROUP BY 1")
def b10_group_selection(spark: SparkSession, d: str) -> DataFrame:
    chosen = batches.selected_groups(_event_rows(spark, d), ["src1", "src3", "src8"])
    return chosen.groupBy("group_slug").agg(F.count("*").alias("n"))


@query(f"""WITH {ROWS}, f AS (SELECT 'talk:' || l_orderkey AS nid, min_by(p_name, place) AS title, '' AS abstract_text, CAST(min_by(l_linenumber, place) AS BIGINT) AS talk_order
  FROM rows GROUP BY 1) SELECT * FROM f""")
def b11_typed_talks(spark: SparkSession, d: str) -> DataFrame:
    return graph.typed_nodes(graph.first_nodes(star.raw_nodes(spark, d)), "Talk")


@query(f"""WITH {ROWS} SELECT 'event:' || c_custkey AS nid, any_value(c_custkey)::VARCHAR AS event_id, any_value(c_name) AS title,
  strftime(min_by(o_orderdate, place), '%Y-%m-%d') AS date, '' AS datetime, '' AS url, '' AS venue_name, '' AS venue_address, '' AS city FROM rows GROUP BY 1""")
def b11_typed_events(spark: SparkSession, d: str) -> DataFrame:
    return graph.typed_nodes(graph.first_nodes(star.raw_nodes(spark, d)), "Event")


@query("SELECT p_type AS label, regexp_full_match(p_type, '[A-Za-z][A-Za-z0-9_]*') AS safe, count(*) AS n FROM part GROUP BY 1, 2 UNION ALL SELECT p_brand, regexp_full_match(p_brand, '[A-Za-z][A-Za-z0-9_]*'), count(*) FROM part GROUP BY 1, 2")
def b12_safe_labels(spark: SparkSession, d: str) -> DataFrame:
    part = star.table(spark, d, "part")
    labels = part.select(F.col("p_type").alias("label")).unionByName(part.select(F.col("p_brand").alias("label")))
    return labels.groupBy("label", graph.is_safe_label(F.col("label")).alias("safe")).agg(F.count("*").alias("n"))


@query(f"WITH {EDGES} SELECT label, count(*) AS n FROM edges WHERE label IN ('PRESENTED_AT', 'MENTIONS') GROUP BY 1")
def b13_closed_kinds(spark: SparkSession, d: str) -> DataFrame:
    return graph.known_kinds(star.edges(spark, d), ("PRESENTED_AT", "MENTIONS")).groupBy("label").agg(F.count("*").alias("n"))


@query(f"WITH {NODES} SELECT id, label, name FROM nodes WHERE id = 'speaker:7'")
def b14_node_lookup(spark: SparkSession, d: str) -> DataFrame:
    return graph.node_by_id(star.nodes(spark, d), "speaker:7").select("id", "label", X.str_prop(F.col("props"), "name").alias("name"))


@query("""SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 5 = 0 THEN coalesce('page ' || page_id, '') ELSE md5(text) END AS found
FROM documents LEFT JOIN pages ON doc_id = page_id""")
def b15_description_recovery(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth text is blanked, and taken from the page of that number where there is one."""
    docs = _docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.md5("text")).alias("description_text"))
    told = docs.withColumn("description_md", F.col("description_text"))
    page = star.table(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("description_text"))
    return recover_descriptions(told, page.withColumn("description_md", F.col("description_text"))).select("id", F.col("description_text").alias("found"))


# --- joins and traversals ----------------------------------------------------------------


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def c2_not_extracted(spark: SparkSession, d: str) -> DataFrame:
    done = star.table(spark, d, "labels").select(F.concat(F.lit("source/g/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("source_file"))
    todo = batches.not_extracted(_docs(spark, d).select(F.col("doc_id").cast("string").alias("id")), done)
    return todo.select(F.col("id").cast("bigint").alias("doc_id"))


@query(f"""WITH {EDGES}, {NODES}, kept AS (SELECT * FROM nodes WHERE id NOT LIKE '%7')
SELECT label, count(*) AS n FROM edges WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept) GROUP BY 1""")
def c3_joined_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges whose ends exist when all nodes whose id ends in 7 are missing; labels are checked."""
    nodes = star.nodes(spark, d).filter(~F.col("id").endswith("7"))
    return graph.joined_edges(star.edges(spark, d), nodes).groupBy("label").agg(F.count("*").alias("n"))


@query(f"WITH {EDGES} SELECT src AS talk FROM edges WHERE label = 'PRESENTED_BY' AND dst = 'speaker:7'")
def c5_talks_of_speaker(spark: SparkSession, d: str) -> DataFrame:
    return traverse.talks_of(star.edges(spark, d), "speaker:7")


@query(f"WITH {EDGES} SELECT DISTINCT b.dst AS speaker FROM edges a JOIN edges b ON a.src = b.src AND b.label = 'PRESENTED_BY' WHERE a.label = 'PRESENTED_AT' AND a.dst = 'event:11'")
def c6_speakers_at_event(spark: SparkSession, d: str) -> DataFrame:
    return traverse.speakers_at(star.edges(spark, d), "event:11")


_GROUPS = """hops AS (SELECT DISTINCT a.dst AS speaker, c.dst AS "group" FROM edges a JOIN edges b ON a.src = b.src AND b.label = 'PRESENTED_AT'
  JOIN edges c ON b.dst = c.src AND c.label = 'PART_OF' WHERE a.label = 'PRESENTED_BY')"""


@query(f"""WITH {EDGES}, {_GROUPS} SELECT speaker, "group" FROM hops WHERE speaker = 'speaker:7'""")
def c7_groups_of_speaker(spark: SparkSession, d: str) -> DataFrame:
    return traverse.groups_of(star.edges(spark, d), _seeds(spark, 7))


@query(f"""WITH {EDGES}, w AS (SELECT DISTINCT o.dst AS company, o.src AS speaker, c.src AS colleague FROM edges o JOIN edges c ON o.dst = c.dst AND c.label = 'WORKS_AT'
  WHERE o.label = 'WORKS_AT' AND o.src = 'speaker:7' AND c.src <> o.src)
SELECT DISTINCT w.speaker, m.dst AS project FROM w JOIN edges p ON p.dst = w.colleague AND p.label = 'PRESENTED_BY' JOIN edges m ON m.src = p.src AND m.label = 'MENTIONS'""")
def c9_employer_projects(spark: SparkSession, d: str) -> DataFrame:
    return traverse.employer_projects(star.edges(spark, d), _seeds(spark, 7))


@query(f"""WITH {EDGES} SELECT x.dst AS a, y.dst AS b, count(*) AS n_talks FROM edges x JOIN edges y ON x.src = y.src AND x.dst < y.dst AND y.label = 'PRESENTED_BY'
WHERE x.label = 'PRESENTED_BY' GROUP BY 1, 2""")
def c10_co_presenters(spark: SparkSession, d: str) -> DataFrame:
    return traverse.co_presenters(star.edges(spark, d))


@query(f"""WITH {EDGES}, {_GROUPS} SELECT DISTINCT "group" FROM hops WHERE speaker IN ('speaker:3', 'speaker:5', 'speaker:7')""")
def c11_groups_of_speakers(spark: SparkSession, d: str) -> DataFrame:
    return traverse.groups_of_all(star.edges(spark, d), _seeds(spark, 3, 5, 7))


@query(f"""WITH {EDGES}, {NODES} SELECT e.label, a.label AS src_label, b.label AS dst_label, count(*) AS n FROM edges e JOIN nodes a ON e.src = a.id JOIN nodes b ON e.dst = b.id GROUP BY 1, 2, 3""")
def c12_endpoint_kinds(spark: SparkSession, d: str) -> DataFrame:
    return traverse.endpoint_kinds(star.edges(spark, d), star.nodes(spark, d))


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    """Repositories beside each part: the six parts that follow it."""
    part = star.table(spark, d, "part")
    near = part.select("*", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("ahead")).withColumn("own", F.col("p_partkey") - F.col("ahead"))
    return near.select(
        F.concat(F.lit("project:"), F.col("own").cast("string")).alias("project_nid"),
        F.col("p_size").alias("stars"),
        F.concat(F.lit("https://example.org/"), F.col("p_partkey").cast("string")).alias("html_url"),
        F.concat_ws("-", "p_name", "p_brand").alias("name"),
        F.concat(F.lit("owner"), F.col("p_partkey").cast("string"), F.lit("/"), F.col("p_name")).alias("full_name"),
        F.col("p_type").alias("description"),
    )


def _projects(spark: SparkSession, d: str) -> DataFrame:
    nodes = star.nodes(spark, d).withColumns({"source_file": F.lit("s"), "pos": F.lit(0)})
    return enrich.projects_to_enrich(nodes)


_MATCHES = f"""ranked AS (SELECT p.p_partkey AS own, p.p_name AS pname, 'https://example.org/' || r.p_partkey AS html_url, r.p_name || '-' || r.p_brand AS rname,
    'owner' || r.p_partkey || '/' || r.p_name AS rfull, r.p_type AS rdesc,
    row_number() OVER (PARTITION BY p.p_partkey ORDER BY r.p_size DESC, 'owner' || r.p_partkey || '/' || r.p_name) AS rank
  FROM part p JOIN part r ON r.p_partkey BETWEEN p.p_partkey + 1 AND p.p_partkey + 6),
scored AS (SELECT *, {normal("pname")} AS n, {normal("rname")} AS r FROM ranked WHERE rank <= 5),
tiers AS (SELECT *, CASE WHEN contains(r, n) OR contains(n, r) OR contains({normal("rfull")}, n) OR contains({normal("rdesc")}, n) THEN 1
    WHEN rank = 1 AND 2 * len(list_intersect(list_distinct(string_split(n, '-')), list_distinct(string_split(r, '-'))))
      >= len(list_distinct(list_concat(string_split(n, '-'), string_split(r, '-')))) THEN 2 END AS tier FROM scored),
matches AS (SELECT 'project:' || p_partkey AS id, p_name AS name, (SELECT arg_min(html_url, tier * 10 + rank) FROM tiers WHERE own = p_partkey AND tier IS NOT NULL) AS url FROM part)"""


@query(f"WITH {_MATCHES} SELECT id, name, url FROM matches")
def c13_matched_projects(spark: SparkSession, d: str) -> DataFrame:
    return enrich.matched_projects(_projects(spark, d), enrich.ranked_candidates(_catalog(spark, d)))


@query(f"WITH {_MATCHES} SELECT id AS nid, name, coalesce(url, '') AS github_url FROM matches")
def c8_enriched_nodes(spark: SparkSession, d: str) -> DataFrame:
    matches = enrich.matched_projects(_projects(spark, d), enrich.ranked_candidates(_catalog(spark, d)))
    return graph.typed_nodes(enrich.with_urls(star.nodes(spark, d), matches), "Project")


@query(f"""WITH {_MATCHES} SELECT count(*) AS n_searched, count(url) AS n_matched, (SELECT count(*) FROM lineitem WHERE 'project:' || l_partkey IN (SELECT id FROM matches WHERE url IS NOT NULL)) AS n_nodes_updated,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE 'project:' || l_partkey IN (SELECT id FROM matches WHERE url IS NOT NULL)) AS n_records_updated FROM matches""")
def d15_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Searched and matched projects; each line of an order names its project once in the order's record."""
    matches = enrich.matched_projects(_projects(spark, d), enrich.ranked_candidates(_catalog(spark, d)))
    lines = star.table(spark, d, "lineitem")
    return enrich.coverage(matches, lines.select(F.col("l_orderkey").alias("source_file"), star.nid("project", "l_partkey").alias("id"), F.lit("Project").alias("label")))


@query(f"""WITH p AS (SELECT DISTINCT p_name || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' ' || p_partkey % 7 END AS pname, {normal("p_name || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' ' || p_partkey % 7 END")} AS n FROM part),
r AS (SELECT DISTINCT {normal("p_brand || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END")} AS r, {normal("'own/' || p_type")} AS f, {normal("p_name || ' and ' || p_type")} AS d FROM part),
m AS (SELECT pname, r.r, r.f, r.d FROM p, r WHERE n <> '' AND r.r <> '' AND (contains(r.r, n) OR contains(n, r.r) OR contains(r.f, n) OR contains(r.d, n) OR len(list_intersect(string_split(n, '-'), string_split(r.r, '-'))) * 2
  >= len(list_distinct(list_concat(string_split(n, '-'), string_split(r.r, '-'))))))
SELECT pname AS project_nid, count(*) AS n FROM m GROUP BY 1""")
def c13_catalog_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All repositories of a catalog that can match a project, by containment or by half of the tokens; names are made of parts."""
    part = star.table(spark, d, "part")
    seventh = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.concat(F.lit(" "), (F.col("p_partkey") % 7).cast("string")))
    name = F.concat("p_name", seventh)
    repo = F.concat("p_brand", F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_name")))
    catalog = part.select(repo.alias("name"), F.concat(F.lit("own/"), "p_type").alias("full_name"), F.concat("p_name", F.lit(" and "), "p_type").alias("description"))
    found = enrich.catalog_candidates(part.select(name.alias("id"), name.alias("name")).distinct(), catalog.distinct())
    return found.groupBy("project_nid").agg(F.count("*").alias("n"))


# --- aggregation, deduplication, merge ------------------------------------------------------


@query(f"""WITH {ROWS}, f AS (
  SELECT 'talk:' || l_orderkey AS id, 'Talk' AS label, min_by(p_name, place) AS v FROM rows GROUP BY 1
  UNION ALL SELECT 'event:' || c_custkey, 'Event', any_value(c_name) FROM rows GROUP BY c_custkey
  UNION ALL SELECT 'group:' || c_nationkey, 'Group', any_value(n_name) FROM rows JOIN nation ON n_nationkey = c_nationkey GROUP BY c_nationkey
  UNION ALL SELECT 'speaker:' || l_suppkey, 'Speaker', any_value(s_name) FROM rows GROUP BY l_suppkey
  UNION ALL SELECT 'company:' || s_nationkey, 'Company', any_value(n_name) FROM rows JOIN nation ON n_nationkey = s_nationkey GROUP BY s_nationkey
  UNION ALL SELECT 'project:' || l_partkey, 'Project', any_value(p_name) FROM rows GROUP BY l_partkey) SELECT * FROM f""")
def d1_first_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = graph.first_nodes(star.raw_nodes(spark, d))
    title, name = X.str_prop(F.col("props"), "title"), X.str_prop(F.col("props"), "name")
    return nodes.select("id", "label", F.when(F.col("label").isin("Talk", "Event"), title).otherwise(name).alias("v"))


@query(f"WITH {ROWS} SELECT 'event:' || c_custkey AS id, strftime(max_by(o_orderdate, place), '%Y-%m-%d') AS date FROM rows GROUP BY 1")
def d2_last_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = graph.last_nodes(star.raw_nodes(spark, d)).filter("label = 'Event'")
    return nodes.select("id", X.str_prop(F.col("props"), "date").alias("date"))


@query(f"""WITH {ROWS} SELECT DISTINCT * FROM (SELECT 'talk:' || l_orderkey AS src, 'event:' || o_custkey AS dst, 'PRESENTED_AT' AS label FROM rows
  UNION ALL SELECT 'event:' || o_custkey, 'group:' || c_nationkey, 'PART_OF' FROM rows UNION ALL SELECT 'talk:' || l_orderkey, 'speaker:' || l_suppkey, 'PRESENTED_BY' FROM rows
  UNION ALL SELECT 'speaker:' || l_suppkey, 'company:' || s_nationkey, 'WORKS_AT' FROM rows UNION ALL SELECT 'talk:' || l_orderkey, 'project:' || l_partkey, 'MENTIONS' FROM rows)""")
def d3_distinct_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.distinct_edges(star.raw_edges(spark, d)).select("src", "dst", "label")


def _merge_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part = star.table(spark, d, "part")
    keep = {"ignoreNullFields": "false"}
    pid = star.nid("project", "p_partkey").alias("id")
    old = part.filter("p_partkey % 2 = 0").select(pid, F.lit("Project").alias("label"), F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"))).alias("props"))
    new = part.filter("p_partkey % 3 = 0").select(pid, F.lit("Project").alias("label"), F.to_json(F.struct(F.upper("p_name").alias("name"), F.lit(None).cast("string").alias("brand")), keep).alias("props"))
    return old, new


def _merged(spark: SparkSession, d: str, replace: bool) -> DataFrame:
    told = graph.merge_nodes(*_merge_sides(spark, d), replace)
    return told.select("id", "label", *[X.str_prop(F.col("props"), p).alias(p) for p in ("name", "brand", "kind")])


_MERGE_SQL = """SELECT 'project:' || p_partkey AS id, 'Project' AS label, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS brand, CASE WHEN {0} THEN p_type ELSE '' END AS kind FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0"""


@query(_MERGE_SQL.format("p_partkey % 2 = 0"))
def d4_merged_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Even parts merged with those divisible by 3: names override, a null removes the brand, kinds stay."""
    return _merged(spark, d, False)


@query(_MERGE_SQL.format("p_partkey % 3 <> 0"))
def d4_replaced_nodes(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d, True)


@query(f"WITH {EDGES} SELECT src, dst, label, CASE WHEN label = 'WORKS_AT' THEN 'new' ELSE 'old' END AS props FROM edges WHERE label IN ('PART_OF', 'WORKS_AT')")
def d4_merged_edges(spark: SparkSession, d: str) -> DataFrame:
    edges = star.edges(spark, d).filter("label IN ('PART_OF', 'WORKS_AT')")
    return graph.merge_edges(edges.withColumn("props", F.lit("old")), edges.filter("label = 'WORKS_AT'").withColumn("props", F.lit("new")))


@query(f"WITH {NODES} SELECT label, count(*) AS n FROM nodes GROUP BY 1 UNION ALL SELECT 'Venue', 0")
def d5_node_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.label_counts(star.nodes(spark, d), (*schemas.NODE_LABELS, "Venue"))


@query(f"WITH {EDGES} SELECT label, count(*) AS n FROM edges GROUP BY 1")
def d6_edge_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.label_counts(star.edges(spark, d), schemas.EDGE_TYPES)


@query(f"""WITH {ROWS} SELECT count(DISTINCT l_orderkey) + count(DISTINCT c_custkey) + count(DISTINCT c_nationkey) + count(DISTINCT l_suppkey) + count(DISTINCT s_nationkey)
  + count(DISTINCT l_partkey) AS n_nodes, CAST(6 AS BIGINT) AS n_node_kinds, count(DISTINCT l_orderkey) + count(DISTINCT c_custkey) + count(DISTINCT (l_orderkey, l_suppkey))
  + count(DISTINCT l_suppkey) + count(DISTINCT (l_orderkey, l_partkey)) AS n_edges, CAST(5 AS BIGINT) AS n_edge_kinds FROM rows""")
def d7_summary(spark: SparkSession, d: str) -> DataFrame:
    return graph.summary_of_things(star.raw_things(spark, d))


@query(f"""WITH {TALKS}, t AS (SELECT l_orderkey, count(*) AS n FROM talks GROUP BY 1)
SELECT 'group-' || c_nationkey AS group_slug, count(*) AS n_events, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_talks, count(*) FILTER (n IS NULL) AS n_skipped
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN t ON l_orderkey = o_orderkey GROUP BY 1""")
def d8_run_totals(spark: SparkSession, d: str) -> DataFrame:
    return batches.run_totals(with_talks(records.response_events(star.announcements(spark, d))))


@query(f"WITH {EDGES} SELECT dst AS speaker, count(DISTINCT src) AS n_talks FROM edges WHERE label = 'PRESENTED_BY' GROUP BY 1")
def d9_talks_per_speaker(spark: SparkSession, d: str) -> DataFrame:
    return traverse.talks_per_speaker(star.edges(spark, d))


@query(f"WITH {EDGES} SELECT dst AS project, count(*) AS n_talks FROM edges WHERE label = 'MENTIONS' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def d10_top_projects(spark: SparkSession, d: str) -> DataFrame:
    return traverse.top_projects(star.edges(spark, d))


@query(f"WITH {EDGES} SELECT dst AS company, count(DISTINCT src) AS n_speakers FROM edges WHERE label = 'WORKS_AT' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def d11_top_companies(spark: SparkSession, d: str) -> DataFrame:
    return traverse.top_companies(star.edges(spark, d))


@query("SELECT 'project:' || p_partkey AS id, p_name AS name FROM part")
def d12_projects_to_enrich(spark: SparkSession, d: str) -> DataFrame:
    return _projects(spark, d)


@query("""WITH p AS (SELECT 'project:' || p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name, p_partkey % 4 = 0 AS addressed FROM part
  WHERE p_partkey % 7 <> 0 AND (p_partkey % 3 = 0 OR p_partkey % 5 <> 0))
SELECT id, name, false AS again FROM p WHERE NOT addressed UNION ALL SELECT id, name, true FROM p""")
def d12_named_projects(spark: SparkSession, d: str) -> DataFrame:
    """Projects to seek, with and without those that have an address. Parts stand in file b; every third also, first, in file a under another name; some have no name, no id, or are no projects."""
    part, k = star.table(spark, d, "part"), F.col("p_partkey")
    id_ = F.when(k % 7 == 0, "").otherwise(star.nid("project", "p_partkey"))
    bag = lambda name: F.to_json(F.struct(name.alias("name"), F.when(k % 4 == 0, "https://example.org/x").alias("github_url")))
    row = lambda rows, file, label, name: rows.select(F.lit(file).alias("source_file"), F.lit(0).alias("pos"), id_.alias("id"), F.lit(label).alias("label"), bag(name).alias("props"))
    rows = row(part, "b", "Project", F.when(k % 5 == 0, "").otherwise(F.col("p_name"))).unionByName(row(part.filter("p_partkey % 3 = 0"), "a", "Project", F.upper("p_name")))
    nodes = rows.unionByName(row(part, "0", "Company", F.lit("no project")))
    found = [enrich.projects_to_enrich(nodes, again).withColumn("again", F.lit(again)) for again in (False, True)]
    return found[0].unionByName(found[1])


@query("SELECT 'talk:' || l_orderkey AS talk, CAST(0 AS BIGINT) AS n FROM lineitem WHERE l_orderkey % 10 = 3 GROUP BY 1")
def d13_one_venue(spark: SparkSession, d: str) -> DataFrame:
    """Talks without exactly one event, when every tenth order's edge to its event is missing."""
    edges = star.edges(spark, d).filter("NOT (label = 'PRESENTED_AT' AND src LIKE '%3')")
    return graph.one_venue_violations(edges)


@query("""WITH o AS (SELECT count(*) > 0 AS talks FROM orders)
SELECT 'whole' AS graph, (NOT talks OR (SELECT count(*) > 0 FROM customer)) AS talks_have_events, (NOT talks OR (SELECT count(*) > 0 FROM nation)) AS talks_have_groups,
  (NOT talks OR (SELECT count(*) > 0 FROM supplier)) AS talks_have_speakers, ((SELECT count(*) = 0 FROM part) OR (SELECT count(*) > 0 FROM lineitem)) AS projects_are_mentioned,
  (SELECT count(*) = 0 FROM part WHERE p_name = '') AS projects_named, (SELECT count(*) = 0 FROM nation WHERE n_name = '') AS companies_named FROM o
UNION ALL SELECT 'thinned', (NOT talks OR (SELECT count(*) > 0 FROM customer WHERE c_custkey < 0)), (NOT talks OR (SELECT count(*) > 0 FROM nation)), (NOT talks OR (SELECT count(*) > 0 FROM supplier WHERE s_suppkey < 0)),
  ((SELECT count(*) = 0 FROM part) OR (SELECT count(*) > 0 FROM lineitem WHERE l_partkey < 0)), (SELECT count(*) = 0 FROM part WHERE p_partkey % 50 = 0), (SELECT count(*) = 0 FROM nation WHERE n_nationkey % 50 = 49) FROM o""")
def d14_coherence(spark: SparkSession, d: str) -> DataFrame:
    """The whole graph, and one without events, speakers and mentions, where every fiftieth project has no name."""
    nodes, edges = star.nodes(spark, d), star.edges(spark, d)
    nameless = (F.col("label") == "Project") & (F.split("id", ":")[1].cast("long") % 50 == 0)
    thin = nodes.filter("label NOT IN ('Event', 'Speaker')").withColumn("props", F.when(nameless, "{}").otherwise(F.col("props")))
    found = [(graph.coherence(nodes, edges), "whole"), (graph.coherence(thin, edges.filter("label <> 'MENTIONS'")), "thinned")]
    both = [f.withColumn("graph", F.lit(n)) for f, n in found]
    return both[0].unionByName(both[1])


# --- order, batches, top k ------------------------------------------------------------------


@query("SELECT l_orderkey, l_partkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS talk_order FROM lineitem WHERE l_quantity > 5")
def e1_talk_order(spark: SparkSession, d: str) -> DataFrame:
    """Order within an event, numbered after the talks without speakers are dropped."""
    kept = talk_rows(_lot_talks(spark, d))
    return kept.select("l_orderkey", F.col("talk.part").alias("l_partkey"), F.get("talk.speakers", F.lit(0))["name"].cast("long").alias("l_suppkey"), "talk_order")


_BUCKET = "CAST(('0x' || substr(md5({0}), 1, 8))::BIGINT % {1} AS INTEGER)"
_PLACED = f"""b AS (SELECT *, {_BUCKET.format("doc_id::VARCHAR", "greatest(1, (SELECT ceil(count(*) / 64.0)::BIGINT FROM documents))")} AS bucket FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id::VARCHAR) - 1 AS k FROM b),
placed AS (SELECT *, CAST(k // 10 AS INTEGER) AS batch, CAST(k % 10 + 1 AS INTEGER) AS position FROM n)"""


@query(f"WITH {_PLACED} SELECT doc_id::VARCHAR AS id, bucket, batch, position, CAST(count(*) OVER (PARTITION BY bucket, batch) AS INTEGER) AS batch_size FROM placed")
def e2_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of ten with each row's place in its batch."""
    return batch_positions(_docs(spark, d).select(F.col("doc_id").cast("string").alias("id")), "id", 10, 64)


_INSTRUCTIONS = "Name the talks of each of these {n} events, and who gave them.\n\n"


def _prompt_sql() -> str:
    head = _INSTRUCTIONS.replace("'", "''").replace("\n", "' || chr(10) || '").replace("{n}", "' || count(*) || '")
    block = (
        "'══ EVENT ' || position || '/' || size || '  event_id:' || doc_id || '  group:' || source || '  date:unknown' || chr(10) || 'Title: Document ' || doc_id || chr(10) || "
        f"'URL: https://example.org/events/' || doc_id || chr(10) || chr(10) || {trimmed('text')} || chr(10) || chr(10)"
    )
    return f"""WITH {_PLACED}, s AS (SELECT *, count(*) OVER (PARTITION BY bucket, batch) AS size FROM placed)
SELECT bucket, batch, CAST(count(*) AS INTEGER) AS n_events, md5('{head}' || string_agg({block}, '' ORDER BY position)) AS prompt_md5 FROM s GROUP BY 1, 2"""


@query(_prompt_sql())
def h23_prompts(spark: SparkSession, d: str) -> DataFrame:
    told = batches.prompts(_event_rows(spark, d), _INSTRUCTIONS, 10, 64)
    return told.select("bucket", "batch", "n_events", F.md5("prompt").alias("prompt_md5"))


@query(f"""WITH {LOTS}, n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lots)
SELECT l_orderkey::VARCHAR AS id, CAST(talk_order AS INTEGER) AS talk_order, person || ', ' || company || chr(10) || 'Words on lot ' || l_partkey || '.' AS body FROM n WHERE n > 1""")
def e4_section_ends(spark: SparkSession, d: str) -> DataFrame:
    """The body of a numbered section: its lines up to the next section."""
    text = F.format_string("(%d) %s\n%s, %s\n\nWords on lot %d.\n", "l_linenumber", "title", "person", "company", "l_partkey")
    told = talk_rows(with_talks(records.response_events(star.announcements(spark, d, text)), title=None))
    return told.select("id", "talk_order", F.col("talk.abstract").alias("body"))


@query("SELECT o_orderkey FROM orders ORDER BY 1 LIMIT 25")
def f2_first_events(spark: SparkSession, d: str) -> DataFrame:
    return traverse.first_by(star.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 25)


@query("SELECT DISTINCT source AS group_slug FROM documents")
def f3_sorted_groups(spark: SparkSession, d: str) -> DataFrame:
    return batches.group_list(_event_rows(spark, d))


@query(f"WITH {_MATCHES} SELECT 'project:' || own AS project_nid, html_url, CAST(rank AS INTEGER) AS rank FROM scored WHERE own >= 0 UNION ALL SELECT 'project:' || (r.p_partkey - o), 'https://example.org/' || r.p_partkey, CAST(row_number() OVER (PARTITION BY r.p_partkey - o ORDER BY r.p_size DESC, 'owner' || r.p_partkey || '/' || r.p_name) AS INTEGER) FROM part r, range(1, 7) t(o) WHERE r.p_partkey - o < 0 QUALIFY row_number() OVER (PARTITION BY r.p_partkey - o ORDER BY r.p_size DESC, 'owner' || r.p_partkey || '/' || r.p_name) <= 5")
def f4_best_candidates(spark: SparkSession, d: str) -> DataFrame:
    return enrich.ranked_candidates(_catalog(spark, d)).select("project_nid", "html_url", "rank")


# --- sets ---------------------------------------------------------------------------------------


@query(f"""WITH {EDGES}, a AS (SELECT dst FROM edges WHERE label = 'PRESENTED_BY' GROUP BY 1), b AS (SELECT 'speaker:' || s_suppkey AS s FROM supplier WHERE s_suppkey % 10 <> 0)
SELECT (SELECT count(*) FROM a WHERE dst NOT IN (SELECT s FROM b)) AS only_left, (SELECT count(*) FROM b WHERE s NOT IN (SELECT dst FROM a)) AS only_right,
  (SELECT count(*) FROM a WHERE dst NOT IN (SELECT s FROM b)) + (SELECT count(*) FROM b WHERE s NOT IN (SELECT dst FROM a)) = 0 AS same""")
def g3_same_set(spark: SparkSession, d: str) -> DataFrame:
    """The speakers found by edges against the suppliers that are not divisible by ten."""
    found = star.edges(spark, d).filter("label = 'PRESENTED_BY'").select("dst").distinct()
    wanted = star.table(spark, d, "supplier").filter("s_suppkey % 10 <> 0").select(star.nid("speaker", "s_suppkey").alias("dst"))
    return traverse.same_set(found, wanted)


@query(f"""WITH n AS (SELECT p_partkey, {normal("p_name")} AS n, {normal("p_type || ' ' || p_name")} AS r FROM part), t AS (SELECT *, list_distinct(string_split(n, '-')) AS a, list_distinct(string_split(r, '-')) AS b FROM n)
SELECT p_partkey, contains(r, n) OR contains(n, r) AS holds, len(list_intersect(a, b)) * 2 >= len(list_distinct(list_concat(a, b))) AS alike FROM t""")
def g4_token_sets(spark: SparkSession, d: str) -> DataFrame:
    """Whether one name holds the other, and whether half of their tokens agree."""
    part = star.table(spark, d, "part")
    holds, alike = X.match_score(F.col("p_name"), F.concat_ws(" ", "p_type", "p_name"), F.lit("-"), F.lit(None).cast("string"))
    return part.select("p_partkey", holds.alias("holds"), alike.alias("alike"))


# --- scalar functions ----------------------------------------------------------------------------


@query(f"SELECT doc_id, {slug('text')} AS slug, md5({normal('text')}) AS name_md5 FROM documents")
def h1_slugs(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return _docs(spark, d).select("doc_id", X.slugify(text).alias("slug"), F.md5(X.normalize_name(text)).alias("name_md5"))


@query(f"""SELECT o_orderkey, 'talk-' || strftime(o_orderdate, '%Y%m%d') || '-' || {slug("c_name || ' ' || c_mktsegment", 45)} || '-' || {slug("c_name", 30)} AS with_speaker,
  'talk-' || strftime(o_orderdate, '%Y%m%d') || '-' || {slug("c_name || ' ' || c_mktsegment", 45)} AS without FROM orders JOIN customer ON o_custkey = c_custkey""")
def h2_talk_ids(spark: SparkSession, d: str) -> DataFrame:
    told = star.table(spark, d, "orders").join(star.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    date, title = F.to_date("o_orderdate"), F.concat_ws(" ", "c_name", "c_mktsegment")
    return told.select(
        "o_orderkey",
        X.make_talk_id(date, title, F.col("c_name")).alias("with_speaker"),
        X.make_talk_id(date, title, F.lit(None).cast("string")).alias("without"),
    )


@query(f"SELECT doc_id, md5({plain('text', *TO_TEXT)}) AS plain_md5, md5({plain('text', *LINKS, (chr(92) * 2, ''))}) AS clean_md5 FROM documents")
def h5_markdown(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return _docs(spark, d).select("doc_id", F.md5(X.markdown_to_text(text)).alias("plain_md5"), F.md5(X.clean_md(text)).alias("clean_md5"))


@query(r"SELECT doc_id, md5(regexp_replace(translate(text, chr(8203) || chr(65279), ''), '\\([#\-*.])', '\1', 'g')) AS text_md5 FROM documents")
def h7_preclean(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.md5(X.preclean(F.col("text"))).alias("text_md5"))


@query(r"SELECT p_partkey, regexp_replace('Talk ' || p_partkey || ': ' || p_name, '^(?i:tech\s+talk|talk|topic|presentation)\s*\d+\s*[:.\-]\s*', '') AS title FROM part")
def h8_titles(spark: SparkSession, d: str) -> DataFrame:
    title = F.concat(F.lit("Talk "), F.col("p_partkey").cast("string"), F.lit(": "), F.col("p_name"))
    return star.table(spark, d, "part").select("p_partkey", X.normalize_title(title).alias("title"))


@query(f"""SELECT doc_id, CASE WHEN octet_length(encode({trimmed('text')})) >= 30 THEN octet_length(encode({trimmed('text')})) <= 1000 END AS whole FROM documents""")
def h16_abstracts(spark: SparkSession, d: str) -> DataFrame:
    """Whether the abstract of a text is all of it (null: too short); the cut itself is tested by hand."""
    found = X.single_talk_abstract(F.col("text"))
    return _docs(spark, d).select("doc_id", (found == X.trim_ws(F.col("text"))).alias("whole"))


@query(f"""WITH b AS (SELECT doc_id, {trimmed('text')} AS body FROM documents), c AS (SELECT *, octet_length(encode(body)) AS size FROM b)
SELECT doc_id, CASE WHEN size >= 30 THEN md5({trimmed("CASE WHEN size <= 1000 THEN body ELSE substr(body, 1, list_max(list_filter(range(1, 1001), lambda k: octet_length(encode(substr(body, 1, k::BIGINT))) <= 1000))) END")}) END AS abstract_md5 FROM c""")
def h16_cut_abstracts(spark: SparkSession, d: str) -> DataFrame:
    """The abstracts themselves: as many whole characters as 1000 bytes hold."""
    return _docs(spark, d).select("doc_id", F.md5(X.single_talk_abstract(F.col("text"))).alias("abstract_md5"))


@query("SELECT doc_id, 'source/' || source || '/' || doc_id || '.html' AS path, doc_id::VARCHAR AS stem, 'https://example.org/g/' || source AS url, CASE source WHEN 'src1' THEN 'One' ELSE source END AS name FROM documents")
def h18_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths, their stems, group addresses and group names."""
    path = X.source_path(F.col("source"), F.col("doc_id").cast("string"))
    name = X.group_display_name(F.col("source"), {"src1": "One"})
    return _docs(spark, d).select("doc_id", path.alias("path"), X.file_stem(path).alias("stem"), X.group_url(F.col("source"), "https://example.org/g/").alias("url"), name.alias("name"))


@query("SELECT o_orderkey, o_orderpriority AS s, '' AS not_a_string, CAST(0 AS BIGINT) AS no_number, o_orderkey AS n FROM orders")
def h21_properties(spark: SparkSession, d: str) -> DataFrame:
    told = star.table(spark, d, "orders").select("o_orderkey", F.to_json(F.struct(F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("k"))).alias("j"))
    j = F.col("j")
    return told.select("o_orderkey", X.str_prop(j, "p").alias("s"), X.str_prop(j, "k").alias("not_a_string"), X.int_prop(j, "p").alias("no_number"), X.int_prop(j, "k").alias("n"))


# --- talks, records, answers -----------------------------------------------------------------------


@query(f"WITH {TALKS} SELECT l_orderkey::VARCHAR AS id, CAST(talk_order AS INTEGER) AS talk_order, title, person, company FROM talks")
def x_talks(spark: SparkSession, d: str) -> DataFrame:
    """Talks of announcements in five layouts; their titles, people and companies are known from the tables."""
    told = talk_rows(with_talks(records.response_events(star.announcements(spark, d))))
    first = F.get("talk.speakers", F.lit(0))
    return told.select("id", "talk_order", F.col("talk.title").alias("title"), first["name"].alias("person"), first["company"].alias("company"))


_KEPT = f"""kept AS (SELECT tid, max(source_file) AS source_file FROM (SELECT {TALK_ID} AS tid, 'source/group-' || c_nationkey || '/' || l_orderkey || '.html' AS source_file FROM talks) GROUP BY 1),
told AS (SELECT k.tid, regexp_extract(k.source_file, '([^/]+)\\.html', 1) AS event_id, regexp_extract(k.source_file, 'group-([0-9]+)', 1) AS g FROM kept k)"""


@query(f"""WITH {TALKS}, {_KEPT}, p AS (SELECT DISTINCT {TALK_ID} AS tid, {slug("person")} AS who FROM talks)
SELECT 'talk:' || tid AS src, 'event:group-' || g || '-' || event_id AS dst, 'PRESENTED_AT' AS label FROM told
UNION SELECT 'event:group-' || g || '-' || event_id, 'group:group-' || g, 'PART_OF' FROM told
UNION SELECT 'talk:' || tid, 'speaker:' || who, 'PRESENTED_BY' FROM p""")
def w1_events_to_graph(spark: SparkSession, d: str) -> DataFrame:
    """Announcements to a deduplicated graph, ends checked: its edges."""
    _, edges = workloads.events_to_graph(records.response_events(star.announcements(spark, d)), RUN_TS, DEFAULT_DATE)
    return edges.select("src", "dst", "label")


def _answers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Model answers made of orders and lines, ten orders a batch, and the event rows they answer, each after an outdated one; every 50th batch is malformed."""
    lines = star.table(spark, d, "lineitem")
    names = lines.join(star.table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    names = names.join(star.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"), "l_suppkey")
    batch = F.floor(F.col("l_orderkey") / 10)
    title = F.when((batch % 50 == 49) & (F.col("l_linenumber") == 1), F.lit(None)).otherwise(F.concat_ws(" ", F.lit("Lot"), F.col("l_linenumber").cast("string"), "p_name"))
    company = F.when(F.col("s_nationkey") % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")))
    person = F.struct(F.col("s_name").alias("name"), company.alias("company"))
    talk = F.struct(title.alias("title"), F.lit("words").alias("abstract_text"), F.array(person).alias("speakers"), F.array(F.struct(F.col("p_name").alias("name"))).alias("projects"))
    per_event = names.groupBy(batch.alias("batch_id"), F.col("l_orderkey").alias("k")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", talk.alias("t")))), lambda x: x["t"]).alias("talks")
    )
    event = F.struct(F.col("k").cast("string").alias("event_id"), "talks")
    answers = per_event.groupBy("batch_id").agg(F.collect_list(event).alias("events"))
    body = F.struct(F.array(F.struct(F.lit("tool_use").alias("type"), F.struct("events").alias("input"))).alias("content"))
    told = records.response_events(star.announcements(spark, d)).withColumn("batch_id", F.floor(F.col("id").cast("bigint") / 10))
    told = told.filter("id NOT LIKE '%77'").withColumn("position", F.lit(2))
    earlier = told.withColumns({"position": F.lit(1), "title": F.concat(F.lit("Z "), "title"), "url": F.lit("z")})
    return answers.select("batch_id", F.to_json(body).alias("value")), told.unionByName(earlier)


_GOOD = """good AS (SELECT *, l_orderkey // 10 AS batch_id FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey),
bad AS (SELECT DISTINCT batch_id FROM good WHERE batch_id % 50 = 49 AND l_linenumber = 1),
talks AS (SELECT *, 'Lot ' || l_linenumber || ' ' || p_name AS title, o_orderdate::DATE + 1 AS day, s_name AS person FROM good WHERE batch_id NOT IN (SELECT batch_id FROM bad) AND l_orderkey::VARCHAR NOT LIKE '%77')"""


@query(f"""WITH {_GOOD} SELECT batch_id, l_orderkey::VARCHAR AS event_id, count(*) AS n_talks, false AS rejected FROM good WHERE batch_id NOT IN (SELECT batch_id FROM bad) GROUP BY 1, 2
UNION ALL SELECT batch_id, NULL, 0, true FROM bad""")
def h24_answers(spark: SparkSession, d: str) -> DataFrame:
    decoded = batches.decoded_answers(_answers(spark, d)[0])
    return decoded.select("batch_id", "event_id", F.coalesce(F.size("talks"), F.lit(0)).cast("bigint").alias("n_talks"), "rejected")


@query(f"WITH {_GOOD} SELECT DISTINCT batch_id, l_orderkey::VARCHAR AS event_id FROM good WHERE batch_id NOT IN (SELECT batch_id FROM bad) AND l_orderkey::VARCHAR LIKE '%77'")
def c1_unknown_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answered ids whose event is unknown."""
    answers, events = _answers(spark, d)
    return batches.matched_answers(batches.decoded_answers(answers), events)[1]


@query(f"""WITH {_GOOD} SELECT (SELECT count(DISTINCT batch_id) FROM good) AS n_batches, (SELECT count(*) FROM bad) AS n_failed_batches, count(DISTINCT l_orderkey) AS n_events, count(*) AS n_talks FROM talks""")
def d8_extraction_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of a run over model answers, failed batches among them, counted while the answers are read."""
    return batches.extraction_totals(*_answers(spark, d))


@query(f"""WITH {_GOOD} SELECT DISTINCT l_orderkey // 10 AS batch_id, l_orderkey::VARCHAR AS id, 'Evening ' || l_orderkey AS title, count(*) AS n_talks FROM talks GROUP BY 1, 2, 3""")
def c1_answered_events(spark: SparkSession, d: str) -> DataFrame:
    """Answers with the last of their events' rows."""
    answers, events = _answers(spark, d)
    found = batches.matched_answers(batches.decoded_answers(answers), events)[0]
    return found.select("batch_id", "id", "title", F.size("talks").cast("bigint").alias("n_talks"))


@query(f"""WITH {_GOOD}, r AS (SELECT {TALK_ID} AS tid, * FROM talks)
SELECT DISTINCT * FROM (SELECT 'talk:' || tid AS src, 'speaker:' || {slug("s_name")} AS dst, 'PRESENTED_BY' AS label FROM r
  UNION ALL SELECT 'speaker:' || {slug("s_name")}, 'company:nation-' || s_nationkey, 'WORKS_AT' FROM r WHERE s_nationkey % 4 <> 0
  UNION ALL SELECT 'talk:' || tid, 'project:' || {slug("p_name")}, 'MENTIONS' FROM r)""")
def r2_answer_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of answers: speakers, companies that are not blank, and projects."""
    answers, events = _answers(spark, d)
    edges = spread_edges(workloads.answers_to_records(answers, events, RUN_TS, DEFAULT_DATE))
    kinds = ("PRESENTED_BY", "WORKS_AT", "MENTIONS")
    return graph.distinct_edges(graph.known_kinds(edges, kinds)).select("src", "dst", "label")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the groups of a speaker, three hops."""
    return c7_groups_of_speaker(spark, sf_dir)


from . import text_queries as _more  # noqa: E402, F401  registers the queries of texts, pages and sinks
