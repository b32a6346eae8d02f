"""Registered queries of lines, credits, layouts, saved pages, crawl records and sinks, each with its SQL.

Their texts are made of the tables' rows (plans.star), so what is found in them is
known from the tables; document lines are judged by the rules themselves in SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .operators import enrich, graph
from .operators.graph import label_counts
from .operators.records import talk_records
from .operators.talks import credits_of, line_kinds, talk_rows, with_talks
from .plans import star, workloads
from .registry import DEFAULT_DATE, EDGES, LOTS, NODES, RUN_TS, SPELLED, TALK_ID, TALKS, cap, query, slug
from .sources import adjacency, pages, records, tables

# --- what a line is ---------------------------------------------------------------

_WHITE = r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_FORMS = (
    "{t}", "{t}.", "{t}!", "{n}", "{n}, {c}", "{n} at {c}", "{m} and {n}", "CTO", "Data Engineer", "{c} Engineer, Retired", "Networking", "Agenda:",
    "Please bring {t}", "{t} http://x.y", "{n} will show {t}", "6:30 pm {t}", "Built with {t}", "{n}, a friend of {c}", "About the {c} people",
    "Machine Learning", "{n} Data", "**{n}, {c}**", "*{n}* of {c}", "Senior Engineer at the {c} house", "{t}, and what it takes to do so",
    "One. Two. Three of {t}", "{t} is one of those many things that take a very long title to tell in a line. Or so", "In this talk {t}", "{c}: {t}", "RSVP {t}",
)


def _listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in sorted(values))


def _any(test: str, values) -> str:
    return "(" + " OR ".join(test.format("'" + v.replace("'", "''") + "'") for v in values) + ")"


def _trim(text: str) -> str:
    return f"regexp_replace({text}, '^[{_WHITE}]+|[{_WHITE}]+$', '', 'g')"


_MADE = """replace(replace(replace(replace({forms}[1 + c_custkey % {k}], '{{n}}', 'Ann ' || {name} || 'son'), '{{m}}', 'Bob ' || {name} || 'son'), '{{c}}', {company}), '{{t}}', 'Shipping Goods By Lot ' || {name})"""


def _filled(forms: tuple[str, ...]) -> str:
    name, company = cap(SPELLED.format("c_custkey")), cap(SPELLED.format("c_nationkey")) + " || 'corp'"
    return _MADE.format(forms="[" + ", ".join("'" + f + "'" for f in forms) + "]", k=len(forms), name=name, company=company)


# Fixed values, written out for the SQL, so that a wrong list of the library shows.
_SQL_FIRST = (
    "machine", "big", "deep", "applied", "open", "free", "cloud", "data", "community", "shapeless", "software", "enterprise", "distributed", "real",
    "advanced", "new", "fast", "reactive", "functional", "mobile", "web", "tech", "ai", "ml", "iot", "devops", "agile", "scala", "spark", "kafka",
    "hadoop", "akka", "play", "flink", "joint", "lightning", "keynote", "workshop", "panel", "session", "solving", "building", "using", "leveraging",
    "exploring", "introducing", "understanding", "scaling", "managing", "designing", "deploying", "getting", "making", "running", "powering",
    "enabling", "winning", "ask", "welcome", "apache", "exabytes", "four", "splice", "large", "small", "natural", "graph", "vector", "knowledge",
    "neural",
)
_SQL_LAST = (
    "learning", "data", "day", "materialization", "workshop", "science", "engineering", "computing", "intelligence", "analytics", "systems",
    "platform", "framework", "technologies", "services", "solutions", "conference", "summit", "meetup", "group", "team", "labs", "research",
    "security", "privacy", "compliance", "management", "governance", "processing", "storage", "pipeline", "architecture", "infrastructure",
    "anything", "spark", "engines", "mates", "network", "machine", "daily", "models", "graph", "graphs", "search", "retrieval",
)
_SQL_GENERIC = (
    "networking", "food", "pizza", "beer", "checkin", "check-in", "doors open", "welcome", "registration", "refreshments", "social", "break", "q&a",
    "q & a", "intro", "agenda", "schedule", "announcements", "sponsor", "sponsors", "closing", "overview", "summary", "introduction", "description",
    "about", "join the community", "what to expect", "why join?", "why join", "sunset social", "welcome remarks", "speaker bio",
)
_SQL_GENERIC_STARTS = (
    "about the ", "about your ", "about our ", "featured talks", "join the ", "any questions", "everyone who", "google build", "register now",
    "sign up", "click here", "learn more", "you must be", "please note", "please contact", "for more info", "hands-on technical",
    "hands on technical", "lightning talk", "speaker 1 bio", "speaker 2 bio", "note: ", "our friends at", "registration is", "networking with",
    "great networking", "you have to", "live demos ", "ml and infra", "ways to get", "welcome remarks", "sunset social", "the on-going",
    "the mission of", "laptop to follow", "a photo id",
)
_SQL_NOT_BEFORE = (
    "!", "Please ", "Note:", "NOTE:", "Come learn ", "Come hear ", "Come see ", "Some considerations ", "Some thoughts ", "Some tips ", "What would ",
    "What if ", "What does ", "How would ", "How will ", "In this talk", "This talk ",
)
_SQL_NOT_IN = (
    "http", "://", "MUST BE REGISTERED", "RSVP",
)
_SQL_JOBS = (
    "ceo", "cto", "coo", "cfo", "vp", "director", "manager", "engineer", "architect", "researcher", "developer", "scientist", "consultant", "founder",
    "co-founder", "partner", "senior engineer", "software engineer", "ml engineer", "principal engineer", "staff engineer",
)
_SQL_ROLES = (
    "vp", "evp", "svp", "director", "ceo", "cto", "coo", "cfo", "head", "senior", "principal", "staff", "founder", "co-founder", "engineer",
    "manager", "architect", "lead", "president", "partner", "chair", "chief", "developer", "advocate", "consultant", "specialist", "researcher",
    "scientist", "professor", "oss",
)
_SQL_PROSE = (
    r"[\d:]+\s*(?:[aApP][mM])?[:\s–\-]",
    r"[A-Z][a-z]+ (?:[A-Z][a-z]+ )?(?:will\b|is\b|has\b|was\b|shows?\b|describes?\b|presents?\b|gave\b|joins?\b|talks?\b|explains?\b)",
    r"(?:Built|Powered|Backed|Driven|Implemented|Hosted|Sponsored)\s+(?:using|by|with|on)\b",
    r"[A-Z][a-z]+ [A-Z][a-z]+, an? \w+",
)


_LINES = f"""lines AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS line FROM documents UNION SELECT {_filled(_FORMS)} FROM customer),
words AS (SELECT line, {_trim("line")} AS t, {_trim("lower(line)")} AS low, regexp_extract_all(line, '[^{_WHITE}]+') AS w, octet_length(encode(line)) AS size FROM lines),
names AS (SELECT *, len(w) > 0 AND NOT regexp_matches(line, '[0-9]') AND lower(w[1]) NOT IN ({_listed(_SQL_FIRST)})
  AND lower(w[-1]) NOT IN ({_listed(_SQL_LAST)}) AS possible_name FROM words),
persons AS (SELECT *, possible_name AND len(w) IN (2, 3) AND NOT {_any("contains(line, {0})", (" and ", " of ", " with ", " for ", " in "))}
  AND list_bool_and(list_transform(w, lambda x: regexp_full_match(x, '\\p{{Lu}}\\p{{Ll}}*') AND octet_length(encode(x)) <= 15)) AS person FROM names),
generics AS (SELECT *, octet_length(encode(low)) < 6 OR low IN ({_listed(_SQL_GENERIC)}) OR {_any("starts_with(low, {0})", _SQL_GENERIC_STARTS)} OR ends_with(t, ':') OR person AS generic FROM persons),
fields AS (SELECT *, (contains(t, ',') OR contains(t, ' at ') OR contains(t, '@')) AND NOT contains(t, 'http') AND octet_length(encode(t)) < 120 AND len(w) < 12
  AND NOT ends_with(t, ':') AND regexp_matches(t, '^\\p{{Lu}}') AS speaker_field, (length(line) - length(replace(line, '. ', ''))) / 2 AS stops FROM generics),
kinds AS (SELECT line, possible_name, person, generic, speaker_field,
  size BETWEEN 8 AND 200 AND NOT ends_with(line, ':') AND NOT {_any("starts_with(line, {0})", _SQL_NOT_BEFORE)} AND NOT {_any("contains(line, {0})", _SQL_NOT_IN)}
    AND NOT {_any("regexp_matches(line, '^(?:' || {0} || ')')", _SQL_PROSE)} AND NOT generic
    AND NOT (stops >= 2 OR (stops >= 1 AND len(w) > 14) OR (regexp_matches(line, '[.!?]$') AND len(w) > 12)) AS title,
  low IN ({_listed(_SQL_JOBS)}) OR (NOT contains(line, ',') AND len(w) <= 3 AND {_any("contains(line, {0})", ("Engineer", "Director", "Manager"))}) AS job_title,
  CASE WHEN contains(t, ',') AND (starts_with(t, '**') OR (starts_with(t, '*') AND ends_with(t, '*'))) THEN octet_length(encode(t)) < 120 ELSE speaker_field END AS speaker_line,
  len(w) >= 4 AND lower(w[1]) NOT IN ({_listed(_SQL_ROLES)}) AND NOT contains(lower(line), ' at the ') AS title_remainder FROM fields)"""


def _kinds(spark: SparkSession, d: str, *kinds: str) -> DataFrame:
    """Which lines of documents and made ones are of the kinds."""
    lines = star.table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.unionByName(star.filled_lines(spark, d, _FORMS).select("line")).distinct()
    return line_kinds(lines, "line").select("line", *[F.col("kinds")[k].alias(k) for k in kinds])


@query(f"WITH {_LINES} SELECT line, title FROM kinds")
def b16_titles(spark: SparkSession, d: str) -> DataFrame:
    """Lines that can be a talk's title."""
    return _kinds(spark, d, "title")


@query(f"WITH {_LINES} SELECT line, generic FROM kinds")
def b17_generic_lines(spark: SparkSession, d: str) -> DataFrame:
    """Boilerplate, headings and bare names."""
    return _kinds(spark, d, "generic")


@query(f"WITH {_LINES} SELECT line, person FROM kinds")
def b18_persons(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are a name and nothing else."""
    return _kinds(spark, d, "person")


@query(f"WITH {_LINES} SELECT line, possible_name FROM kinds")
def b19_possible_names(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose first and last words do not name a thing."""
    return _kinds(spark, d, "possible_name")


@query(f"WITH {_LINES} SELECT line, job_title FROM kinds")
def b20_job_titles(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are a job title."""
    return _kinds(spark, d, "job_title")


@query(f"WITH {_LINES} SELECT line, speaker_field, speaker_line FROM kinds")
def b21_speaker_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines that name a speaker, emphasised or not."""
    return _kinds(spark, d, "speaker_field", "speaker_line")


@query(f"WITH {_LINES} SELECT line, title_remainder FROM kinds")
def b22_title_remainders(spark: SparkSession, d: str) -> DataFrame:
    """What after a name reads as a title, not as a role."""
    return _kinds(spark, d, "title_remainder")


# --- credits ------------------------------------------------------------------------

_PEOPLE = (
    ("{n}, {c}", "{n}|{c}"), ("{n} at {c}", "{n}|{c}"), ("{n} @ {c}", "{n}|{c}"), ("{n} ({c})", "{n}|{c}"), ("Speaker: {n}, Senior Engineer, {c}", "{n}|{c}"),
    ("{n} and {m}", "{n}|-;{m}|-"), ("{n}, {c}; {m}, {c}", "{n}|{c};{m}|{c}"), ("{n} & {m}", "{n}|-;{m}|-"), ("{n}, Director and Founder at {c}", "{n}|{c}"),
    ("Software Engineer", ""), ("By: {n}; Bob", "{n}|-"), ("{n}, {c} and {m}", "{n}|{c} and {m}"), ("Machine Learning, {c}", ""),
)
_PERSONS = (
    ("{n} @ {c}", "{n}|{c}"), ("{n} (CTO at {c})", "{n}|{c}"), ("{n}", "{n}|-"), ("{c}, {n}", "{n}|{c}"), ("{n}, {c}", "{n}|{c}"), ("{n}, Lead, {c}", "{n}|{c}"),
    ("{n} at {c}", "{n}|{c}"), ("**{n}, {c}.**", "{n}|{c}"), ("{n}, CEO", "{n}|-"), ("{n} ( )", "{n}|-"),
)
_FIELDS = (
    ("Engineer at {c}", "{c}"), ("Lead, Search, {c}", "{c}"), ("{c}", "{c}"), ("Head of Data at {c} CEO", "{c}"), ("CTO", "-"), ("{c}*", "{c}"),
)
_COMPANIES = (
    ("{c} CEO", "{c}"), ("{c} Software Engineer", "{c}"), ("Founder", "-"), ("Products for {c} People", "-"), ("{c} One Two Three Four Five", "-"), ("{c}", "{c}"),
    ("*{c}*,", "{c}"), ("{c} Labs, VP", "{c} Labs,"), ("", "-"),
)


def _credit_sql(forms: tuple[tuple[str, str], ...]) -> str:
    return f"SELECT c_custkey AS key, {_filled(tuple(a for a, _ in forms))} AS line, {_filled(tuple(b for _, b in forms))} AS found FROM customer"


def _credits(spark: SparkSession, d: str, forms: tuple[tuple[str, str], ...], found: Column) -> DataFrame:
    lines = star.filled_lines(spark, d, tuple(a for a, _ in forms))
    return credits_of(lines, "line").select("key", "line", found.alias("found"))


def _pair(p: Column) -> Column:
    return F.concat(p["name"], F.lit("|"), F.coalesce(p["company"], F.lit("-")))


@query(_credit_sql(_PERSONS))
def h12_persons(spark: SparkSession, d: str) -> DataFrame:
    """Name and company of one credit."""
    return _credits(spark, d, _PERSONS, _pair(F.col("credit.person")))


@query(_credit_sql(_FIELDS))
def h13_companies_of_fields(spark: SparkSession, d: str) -> DataFrame:
    """The company in the field after a name."""
    return _credits(spark, d, _FIELDS, F.coalesce("credit.company_of", F.lit("-")))


@query(_credit_sql(_COMPANIES))
def h14_companies(spark: SparkSession, d: str) -> DataFrame:
    """Companies without roles before or after them."""
    return _credits(spark, d, _COMPANIES, F.coalesce("credit.company", F.lit("-")))


@query(_credit_sql(_PEOPLE))
def h15_speakers(spark: SparkSession, d: str) -> DataFrame:
    """All people of a credit line."""
    return _credits(spark, d, _PEOPLE, F.array_join(F.transform("credit.speakers", _pair), ";"))


# --- layouts ------------------------------------------------------------------------

_MORE = "SELECT l_orderkey::VARCHAR AS id, CAST(talk_order AS INTEGER) AS talk_order, title, person, company, {0} AS abstract FROM lots WHERE l_orderkey % 5 IN ({1})"


def _layout(spark: SparkSession, d: str, *layouts: int) -> DataFrame:
    events = records.response_events(star.announcements(spark, d, star.other_layouts()))
    told = talk_rows(with_talks(events.filter((F.col("id").cast("long") % 5).isin(*layouts)), title=None))
    first = F.get("talk.speakers", F.lit(0))
    return told.select("id", "talk_order", F.col("talk.title").alias("title"), first["name"].alias("person"), first["company"].alias("company"), F.col("talk.abstract").alias("abstract"))


@query(f"WITH {LOTS} " + _MORE.format("'Words on lots.'", "0"))
def x4_headings(spark: SparkSession, d: str) -> DataFrame:
    """A heading, then a line with a speaker label."""
    return _layout(spark, d, 0)


@query(f"WITH {LOTS} " + _MORE.format("CASE l_orderkey % 5 WHEN 2 THEN 'Words on lots.' END", "1, 2"))
def x5_quoted_titles(spark: SparkSession, d: str) -> DataFrame:
    """A title in quotes, by somebody on the same line or on the next."""
    return _layout(spark, d, 1, 2)


@query(f"WITH {LOTS} " + _MORE.format("NULL::VARCHAR", "3, 4"))
def x7_bullet_agenda(spark: SparkSession, d: str) -> DataFrame:
    """Bulleted titles: bold or plain with a dash, bold with the people on the next line."""
    return _layout(spark, d, 3, 4)


_TITLED = f"""t AS (SELECT p_partkey AS k, 'Ann ' || {cap(SPELLED.format("p_partkey"))} || 'son' AS a, 'Bob ' || {cap(SPELLED.format("p_partkey"))} || 'son' AS b,
  'Shipping Goods By Lot ' || {cap(SPELLED.format("p_partkey"))} AS t1, 'Moving Things In ' || {cap(SPELLED.format("p_size"))} || ' Days' AS t2 FROM part)"""


@query(f"""WITH {_TITLED} SELECT k, 0 AS talk_order, t1 AS title, a AS person, 'What is told of part ' || k || ' this evening.' AS abstract FROM t WHERE k % 4 <> 3
UNION ALL SELECT k, 1, t2, b, 'What is told of part ' || k || ' this evening.' FROM t WHERE k % 4 = 2""")
def x9_event_titles(spark: SparkSession, d: str) -> DataFrame:
    """Talks told in the event's own title, where its text has none."""
    part, k = star.table(spark, d, "part"), F.col("p_partkey")
    named = lambda c: F.initcap(F.translate(F.col(c).cast("string"), "0123456789", "abcdefghij"))
    first, second = F.concat(F.lit("Shipping Goods By Lot "), named("p_partkey")), F.concat(F.lit("Moving Things In "), named("p_size"), F.lit(" Days"))
    a, b = star.person("p_partkey"), star.person("p_partkey", "Bob")
    title = (
        F.when(k % 4 == 0, F.concat(a, F.lit(": "), first))
        .when(k % 4 == 1, F.concat(a, F.lit(', "'), first, F.lit('"')))
        .when(k % 4 == 2, F.concat(a, F.lit(": "), first, F.lit("; "), b, F.lit(", "), second))
        .otherwise(F.concat(F.lit("Evening "), named("p_partkey")))
    )
    text = F.concat(F.lit("What is told of part "), k.cast("string"), F.lit(" this evening."))
    told = talk_rows(with_talks(part.select(k.alias("k"), title.alias("title"), F.lit("no talk").alias("description_md"), text.alias("description_text"))))
    return told.select("k", "talk_order", F.col("talk.title").alias("title"), F.get("talk.speakers", F.lit(0))["name"].alias("person"), F.col("talk.abstract").alias("abstract"))


@query("""SELECT c_custkey AS key, 'First line of ' || c_custkey || '.' || chr(10) || 'Second line here.' AS abstract FROM customer""")
def h17_abstracts(spark: SparkSession, d: str) -> DataFrame:
    """The text after a speaker's line, up to a bullet, heading, numbered or bold line."""
    ends = ("- a bullet", "# A Heading Of Things", "2) A Numbered Line", "**A Bold Line Of Many Things**")
    lines = star.table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    end = F.element_at(F.array(*map(F.lit, ends)), (F.col("key") % len(ends) + 1).cast("int"))
    title = F.concat(F.lit("Shipping Goods By Lot "), F.initcap(F.translate(F.col("key").cast("string"), "0123456789", "abcdefghij")))
    text = F.format_string("**%s**\n\n*%s, Acorp*\n\nFirst line of %d.\nSecond *line* [here](http://x.y).\n\n%s\nafter\n", title, star.person("key"), "key", end)
    told = talk_rows(with_talks(lines.withColumn("description_md", text), title=None))
    return told.select("key", F.col("talk.abstract").alias("abstract"))


# --- saved pages ----------------------------------------------------------------------

_TOLD = f"""{LOTS},
said AS (SELECT l_orderkey, string_agg('Presentation: ' || title || chr(10) || 'Speaker: ' || person || ', ' || company || chr(10), chr(10) ORDER BY talk_order) AS text FROM lots GROUP BY 1),
events AS (SELECT o_orderkey AS k, o_orderdate::DATE + 1 AS day, c_nationkey, o_custkey, text,
    CASE WHEN text IS NULL THEN 'Ann ' || {cap(SPELLED.format("o_custkey"))} || 'son: Shipping Goods By Lot ' || {cap(SPELLED.format("o_orderkey"))} ELSE 'Evening ' || o_orderkey END AS event_title
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN said ON l_orderkey = o_orderkey)"""


def _parts(spark: SparkSession, d: str, kind: int) -> DataFrame:
    saved = star.saved_pages(spark, d).filter(F.col("key") % 4 == kind)
    return pages.with_parts(saved)


@query(f"WITH {_TOLD} SELECT k::VARCHAR AS id, event_title AS title, day AS date, coalesce(md5(rtrim(text, chr(10))), md5('')) AS text_md5, 'Group ' || c_nationkey AS group_name FROM events WHERE k % 4 = 0")
def b2_state_events(spark: SparkSession, d: str) -> DataFrame:
    """Event rows of page states."""
    return pages.state_events(_parts(spark, d, 0)).select("id", "title", "date", F.md5("description_text").alias("text_md5"), "group_name")


@query(f"""WITH {_TOLD} SELECT k::VARCHAR AS id, event_title AS title, day AS date, 'https://example.org/events/' || k || '/' AS url, 'Hall ' || k AS venue_name, 'Town' AS city FROM events WHERE k % 4 = 0 AND k % 12 <> 0""")
def b3_state_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of the pages' own events, venues by reference or inline; pages saved under another id have none."""
    parts = _parts(spark, d, 0).withColumn("event_id", F.when(F.col("key") % 12 == 0, "none").otherwise(F.col("event_id")))
    return pages.state_metadata(parts).select("id", "title", "date", "url", "venue_name", "city")


@query(f"""WITH {_TOLD} SELECT k::VARCHAR AS id, CASE WHEN k % 8 = 0 THEN 'Hall ' || k END AS venue_name, CASE WHEN k % 8 = 0 THEN '1 Road' END AS venue_address, 'Group ' || c_nationkey AS group_name FROM events WHERE k % 4 = 0""")
def c4_page_references(spark: SparkSession, d: str) -> DataFrame:
    """Venues and groups that a page state names by reference; a venue held inline is none."""
    return pages.state_events(_parts(spark, d, 0)).select("id", "venue_name", "venue_address", "group_name")


@query(f"""WITH {_TOLD} SELECT k::VARCHAR AS id, event_title AS title, day AS date, coalesce(md5(rtrim(text, chr(10))), md5('')) AS text_md5, 'Room ' || k AS venue_name, '2 Road' AS venue_address, 'City' AS city,
  'Makers ' || c_nationkey AS group_name FROM events WHERE k % 4 = 1""")
def b4_json_ld_events(spark: SparkSession, d: str) -> DataFrame:
    """Event rows of JSON-LD scripts; scripts of other types stand before them."""
    told = pages.json_ld_events(_parts(spark, d, 1))
    return told.select("id", "title", "date", F.md5("description_text").alias("text_md5"), "venue_name", "venue_address", "city", "group_name")


@query(f"WITH {_TOLD} SELECT k::VARCHAR AS id, event_title AS title, NULL::DATE AS date, coalesce(md5(text), md5('')) AS description_md5 FROM events WHERE k % 4 > 1")
def b5_descriptions(spark: SparkSession, d: str) -> DataFrame:
    """First h1 and description element of plain pages: a test id counts before a class."""
    told = pages.html_events(_parts(spark, d, 2).unionByName(_parts(spark, d, 3)))
    return told.select("id", "title", "date", F.md5("description_md").alias("description_md5"))


@query("""SELECT ['state', 'json_ld', 'html', 'html'][1 + o_orderkey % 4] AS source, o_orderkey::VARCHAR AS id FROM orders
UNION ALL SELECT 'html', coalesce(nullif(regexp_extract(url, '/events/(\\d+)', 1), ''), 'unknown') FROM pages""")
def b6_page_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Which parser reads each page: of all kinds, and the raw pages."""
    raw = star.table(spark, d, "pages").select("html", "url", F.lit("g").alias("group_slug"))
    told = pages.page_events(star.saved_pages(spark, d).select("html", "url", "group_slug").unionByName(raw))
    return told.select("source", "id")


_PAGE_TALKS = f"""{_TOLD},
page_talks AS (SELECT k, c_nationkey, title, person, talk_order, CASE WHEN k % 4 > 1 THEN DATE '2024-01-01' ELSE day END AS day FROM lots JOIN events ON l_orderkey = k
  UNION ALL SELECT k, c_nationkey, split_part(event_title, ': ', 2), split_part(event_title, ': ', 1), 0, day FROM events WHERE text IS NULL AND k % 4 = 0),
ids AS (SELECT *, {TALK_ID} AS tid, 'source/group-' || c_nationkey || '/' || k || '.html' AS source_file FROM page_talks),
last AS (SELECT tid, arg_max({{k: k, g: c_nationkey, person: person}}, {{f: source_file, o: talk_order}}) AS e FROM ids GROUP BY 1)"""


@query(f"""WITH {_PAGE_TALKS} SELECT 'talk:' || tid AS src, 'event:group-' || e.g || '-' || e.k AS dst, 'PRESENTED_AT' AS label FROM last
UNION SELECT 'event:group-' || e.g || '-' || e.k, 'group:group-' || e.g, 'PART_OF' FROM last
UNION SELECT 'talk:' || tid, 'speaker:' || {slug("e.person")}, 'PRESENTED_BY' FROM last""")
def w_pages_to_graph(spark: SparkSession, d: str) -> DataFrame:
    """Saved pages to a deduplicated graph, ends checked: its edges. Titles tell talks on pages with a state only."""
    _, edges = workloads.pages_to_graph(star.saved_pages(spark, d), RUN_TS, DEFAULT_DATE)
    return edges.select("src", "dst", "label")


@query(f"""WITH {_TOLD}, found AS (SELECT k, c_nationkey, day, title, person, talk_order FROM lots JOIN events ON l_orderkey = k
  UNION ALL SELECT k, c_nationkey, day, split_part(event_title, ': ', 2), split_part(event_title, ': ', 1), 0 FROM events WHERE text IS NULL AND k % 4 = 0),
ids AS (SELECT {TALK_ID} AS id, 'source/group-' || c_nationkey || '/' || k || '.html' AS source_file FROM found)
SELECT id, max(source_file) AS source_file FROM ids GROUP BY 1""")
def w_recovered_records(spark: SparkSession, d: str) -> DataFrame:
    """Responses, of which every fifth has no description, with their saved pages: text and talks come from the page then, the date stays."""
    events = records.response_events(star.announcements(spark, d, star.labels_layout()))
    blank = F.col("id").cast("long") % 5 == 0
    events = events.withColumns({c: F.when(blank, "").otherwise(F.col(c)) for c in ("description_md", "description_text")})
    told = workloads.crawl_to_records(events, star.saved_pages(spark, d), RUN_TS, DEFAULT_DATE)
    return told.select("id", "source_file")


# --- crawl records and sinks -------------------------------------------------------------


@query(f"""SELECT ['event', 'speaker', 'talk'][1 + o_orderkey % 3] AS shape, 'talk:' || CASE WHEN o_orderkey % 3 = 0 THEN 'm' ELSE 'c' || o_custkey END || ':' || o_orderkey AS id,
  'Lot ' || o_orderkey AS title, CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE o_clerk END AS speaker_text, 'https://example.org/' || o_orderkey AS url,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Some words, ' || o_clerk || '.' END AS description, CASE WHEN o_orderkey % 3 <> 0 THEN 'c' || o_custkey END AS conference_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'm' END AS meetup_id, 'in/' || o_orderkey AS source_file, 'out/' || o_orderkey AS extracted_file
FROM (SELECT *, 'Clerk ' || o_custkey AS o_clerk FROM orders) WHERE NOT (o_orderkey % 3 = 1 AND o_orderkey % 2 = 0)""")
def a10_crawl_rows(spark: SparkSession, d: str) -> DataFrame:
    """Crawl records of three shapes as one; speakers without a talk give no row."""
    orders = star.table(spark, d, "orders")
    key, shape = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3
    clerk, url = F.concat(F.lit("Clerk "), F.col("o_custkey").cast("string")), F.concat(F.lit("https://example.org/"), key)
    words = F.concat(F.lit("Some​  words,\n "), clerk, F.lit(".﻿ "))
    event = F.struct(key.alias("id"), F.concat(F.lit("[news] Lot "), key).alias("title"), words.alias("description"), url.alias("eventUrl"))
    conference, lot = F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.concat(F.lit("Lot "), key)
    raw = F.struct(
        key.alias("source_id"), F.concat(F.lit("in/"), key).alias("source_file"), F.concat(F.lit("out/"), key).alias("extracted_file"),
        F.when(shape == 0, event).alias("event"), F.when(shape == 0, "m").alias("meetup_id"), F.when(shape != 0, conference).alias("conference_id"),
        F.when(shape == 1, clerk).alias("name"), F.when((shape == 1) & (F.col("o_orderkey") % 2 == 1), lot).alias("talk_title"), F.when(shape == 1, url).alias("talk_url"),
        F.when(shape == 2, lot).alias("title"), F.when(shape == 2, clerk).alias("speaker_text"), F.when(shape == 2, url).alias("url"),
    )
    read = orders.select(F.from_json(F.to_json(raw), schemas.CRAWL_SOURCE).alias("r")).select("r.*")
    columns = ("shape", "id", "title", "speaker_text", "url", "description", "conference_id", "meetup_id", "source_file", "extracted_file")
    return records.flatten_crawl(read).select(*columns)


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = tables.read_graph(spark, folder)
    counted = label_counts(nodes.select("label"), schemas.NODE_LABELS)
    return counted.unionByName(label_counts(edges.select("label"), schemas.EDGE_TYPES))


def _folder(spark: SparkSession) -> str:
    return f"{tables.shared_folder(spark)}/graph-{uuid.uuid4().hex}"


_COUNTS = """SELECT 'Talk' AS label, count(*) AS n FROM orders UNION ALL SELECT 'Event', count(*) FROM customer UNION ALL SELECT 'Group', count(*) FROM nation
UNION ALL SELECT 'Speaker', count(*) FROM supplier UNION ALL SELECT 'Company', count(*) FROM nation UNION ALL SELECT 'Project', {projects} FROM part
UNION ALL SELECT 'PRESENTED_AT', count(*) FROM orders UNION ALL SELECT 'PART_OF', count(*) FROM customer UNION ALL SELECT 'WORKS_AT', count(*) FROM supplier
UNION ALL SELECT 'PRESENTED_BY', count(DISTINCT (l_orderkey, l_suppkey)) FROM lineitem UNION ALL SELECT 'MENTIONS', {mentions} FROM lineitem"""


@query(_COUNTS.format(projects="count(*)", mentions="count(DISTINCT (l_orderkey, l_partkey))"))
def a6_written_graph(spark: SparkSession, d: str) -> DataFrame:
    """The graph, written by label and read again: rows of each label. Writes when called."""
    folder = _folder(spark)
    tables.write_graph(star.nodes(spark, d), star.edges(spark, d).withColumn("props", F.lit("{}")), folder)
    return _counts(spark, folder)


@query(_COUNTS.format(projects="0::BIGINT", mentions="0::BIGINT").replace("FROM part", "").replace("SELECT 'MENTIONS', 0::BIGINT FROM lineitem", "SELECT 'MENTIONS', 0::BIGINT"))
def a7_cleared_graph(spark: SparkSession, d: str) -> DataFrame:
    """A graph written over an older one, which is cleared: nothing of that is left. Writes when called."""
    folder, nodes, edges = _folder(spark), star.nodes(spark, d), star.edges(spark, d).withColumn("props", F.lit("{}"))
    tables.write_graph(nodes, edges, folder)
    tables.write_graph(nodes.filter("label <> 'Project'"), edges.filter("label <> 'MENTIONS'"), folder, clear=True)
    return _counts(spark, folder)


@query(f"""WITH {LOTS}, t AS (SELECT *, o_orderdate::DATE + 1 AS day FROM lots JOIN orders ON l_orderkey = o_orderkey) SELECT DISTINCT {TALK_ID} AS id FROM t""")
def a9_dry_run(spark: SparkSession, d: str) -> DataFrame:
    """The records that a run would write, without writing them."""
    events = records.response_events(star.announcements(spark, d, star.labels_layout()))
    told = talk_records(talk_rows(with_talks(events, title=None)), schemas.HEURISTIC_VERSION, RUN_TS, DEFAULT_DATE)
    return tables.write_records(told, _folder(spark), dry_run=True).select("id")


# --- tables that are updated in part --------------------------------------------------


def _run_records(spark: SparkSession, d: str, every: int, run_ts: str) -> DataFrame:
    """Records of a run over the announcements whose number is divisible by `every`."""
    events = records.response_events(star.announcements(spark, d).filter(F.col("node.id").cast("bigint") % every == 0))
    return talk_records(talk_rows(with_talks(events, title=None)), schemas.HEURISTIC_VERSION, run_ts, DEFAULT_DATE)


@query(f"""WITH {TALKS}, r AS (SELECT {TALK_ID} AS id, 'source/group-' || c_nationkey || '/' || l_orderkey || '.html' AS source_file, l_orderkey FROM talks),
a AS (SELECT id, max(source_file) AS source_file, 'first' AS run FROM r WHERE l_orderkey % 2 = 0 GROUP BY id), b AS (SELECT id, max(source_file) AS source_file, 'again' AS run FROM r WHERE l_orderkey % 3 = 0 GROUP BY id)
SELECT * FROM b UNION ALL SELECT * FROM a WHERE id NOT IN (SELECT id FROM b)""")
def a5_two_runs(spark: SparkSession, d: str) -> DataFrame:
    """The stored records after two runs over overlapping events: the second replaces records of the same id and keeps the others. Writes when called."""
    folder = _folder(spark)
    tables.write_records(_run_records(spark, d, 2, "first"), folder)
    tables.write_records(_run_records(spark, d, 3, "again"), folder)
    return tables.record_table(spark, folder).read().select("id", "source_file", F.col("scraped_at").alias("run"))


_MATCHED = """matched AS (SELECT 'project:' || p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'https://example.org/' || p_partkey END AS url FROM part)"""
_PLACES = """places AS (SELECT printf('%012d-%04d-%09d-%09d', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, 'project:' || l_partkey AS project
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""


def _stored_lines(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """A folder with the records of lines, and addresses of every third project."""
    told = star.records(spark, d)
    nodes = F.transform("nodes", lambda n: F.struct(n["id"].alias("id"), n["label"].alias("label"), n["props"].alias("props")))
    edges = F.transform("edges", lambda e: F.struct(e["src"].alias("src"), e["dst"].alias("dst"), e["label"].alias("label"), F.lit("{}").alias("props")))
    place = F.col("source_file")
    rows = told.select(F.lit("1.1").alias("schema_version"), place.alias("id"), F.lit(RUN_TS).alias("scraped_at"), place, nodes.alias("nodes"), edges.alias("edges"))
    folder, part = _folder(spark), star.table(spark, d, "part")
    tables.write_records(rows, folder)
    url = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("https://example.org/"), F.col("p_partkey").cast("string")))
    return folder, part.select(star.nid("project", "p_partkey").alias("id"), F.col("p_name").alias("name"), url.alias("url"))


@query(f"""WITH {_PLACES}, {_MATCHED} SELECT DISTINCT p.id, project, coalesce(url, '') AS github_url, CASE WHEN url IS NULL THEN 1 ELSE 2 END::BIGINT AS version
FROM places p JOIN matched m ON p.project = m.id""")
def a8_rewritten_records(spark: SparkSession, d: str) -> DataFrame:
    """Stored records of lines after their projects' addresses were written into them; version 2 holds the changed ones. Writes when called."""
    folder, matches = _stored_lines(spark, d)
    changed = tables.rewrite_records(spark, folder, matches).select("id", F.lit(2).cast("long").alias("version"))
    rows = tables.record_table(spark, folder).read().select("id", F.explode("nodes").alias("n")).filter("n.label = 'Project'")
    url = F.coalesce(F.get_json_object("n.props", "$.github_url"), F.lit(""))
    told = rows.select("id", F.col("n.id").alias("project"), url.alias("github_url"))  # no whole record meets its version
    return told.join(changed, "id", "left").withColumn("version", F.coalesce("version", F.lit(1)))


@query(f"""WITH {_PLACES}, {_MATCHED}, u AS (SELECT DISTINCT p.id, project FROM places p JOIN matched m ON p.project = m.id WHERE url IS NOT NULL)
SELECT count(*) AS n_nodes_updated, count(DISTINCT id) AS n_records_updated, (SELECT count(*) FROM u) AS nodes_told, (SELECT count(DISTINCT id) FROM u) AS records_told FROM u""")
def a8_update_counts(spark: SparkSession, d: str) -> DataFrame:
    """What rewriting changed, beside what coverage() tells of the same records beforehand. Writes when called."""
    folder, matches = _stored_lines(spark, d)
    before = tables.record_table(spark, folder).read(1)
    nodes = before.select(F.col("id").alias("source_file"), F.explode("nodes").alias("n")).select("source_file", "n.id", "n.label")
    told = enrich.coverage(matches, nodes).select(F.col("n_nodes_updated").alias("nodes_told"), F.col("n_records_updated").alias("records_told"))
    return graph.one_row(enrich.updated_counts(tables.rewrite_records(spark, folder, matches), matches), told)


_STORED = """SELECT 'project:' || p_partkey AS id, 'Project' AS label, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS brand, CASE WHEN {0} THEN p_type ELSE '' END AS kind FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0"""


def _merged_store(spark: SparkSession, d: str, replace: bool = False) -> str:
    """A folder with a graph of even parts, part of the edges, into which parts divisible by 3 and new edges were merged."""
    part, keep, pid = star.table(spark, d, "part"), {"ignoreNullFields": "false"}, star.nid("project", "p_partkey").alias("id")
    bag = lambda keep_nulls, **c: F.to_json(F.struct(*[v.alias(n) for n, v in c.items()]), keep if keep_nulls else {}).alias("props")
    old = part.filter("p_partkey % 2 = 0").select(pid, F.lit("Project").alias("label"), bag(False, name=F.col("p_name"), brand=F.col("p_brand"), kind=F.col("p_type")))
    new = part.filter("p_partkey % 3 = 0").select(pid, F.lit("Project").alias("label"), bag(True, name=F.upper("p_name"), brand=F.lit(None).cast("string")))
    edges, folder = star.edges(spark, d).drop("props").filter("label IN ('PART_OF', 'WORKS_AT')"), _folder(spark)
    tables.merge_into_graph(old, edges.withColumn("props", F.lit("old")), folder)
    tables.merge_into_graph(new, edges.filter("label = 'WORKS_AT'").withColumn("props", F.lit("new")), folder, replace)
    return folder


def _stored_nodes(spark: SparkSession, folder: str) -> DataFrame:
    nodes = tables.graph_tables(spark, folder)[0].read()
    return nodes.select("id", "label", *[F.coalesce(F.get_json_object("props", f"$.{p}"), F.lit("")).alias(p) for p in ("name", "brand", "kind")])


@query(_STORED.format("p_partkey % 2 = 0"))
def d4_stored_nodes(spark: SparkSession, d: str) -> DataFrame:
    """A stored graph's nodes after a merge into it: names override, a null removes the brand, kinds stay. Writes when called."""
    return _stored_nodes(spark, _merged_store(spark, d))


@query(_STORED.format("p_partkey % 3 <> 0"))
def d4_stored_replaced(spark: SparkSession, d: str) -> DataFrame:
    """The same with bags replaced whole. Writes when called."""
    return _stored_nodes(spark, _merged_store(spark, d, replace=True))


@query(f"WITH {EDGES} SELECT src, dst, label, CASE WHEN label = 'WORKS_AT' THEN 'new' ELSE 'old' END AS props FROM edges WHERE label IN ('PART_OF', 'WORKS_AT')")
def d4_stored_edges(spark: SparkSession, d: str) -> DataFrame:
    """A stored graph's edges after a merge into it. Writes when called."""
    return tables.graph_tables(spark, _merged_store(spark, d))[1].read()


@query(f"""WITH {EDGES}, {NODES} SELECT label, id AS a, '' AS b, row_number() OVER (PARTITION BY label ORDER BY id) - 1 AS place FROM nodes
UNION ALL SELECT label, src, dst, row_number() OVER (PARTITION BY label ORDER BY src, dst) - 1 FROM edges""")
def f3_written_order(spark: SparkSession, d: str) -> DataFrame:
    """Where each node and edge stands in the written graph's files. Writes when called."""
    folder = _folder(spark)
    tables.write_graph(star.nodes(spark, d), star.edges(spark, d).withColumn("props", F.lit("{}")), folder)
    nodes, edges = (tables.in_file_order(spark.read.parquet(f"{folder}/{name}")) for name in ("nodes", "edges"))
    return nodes.select("label", F.col("id").alias("a"), F.lit("").alias("b"), "place").unionByName(edges.select("label", F.col("src").alias("a"), F.col("dst").alias("b"), "place"))


def _adjacency(spark: SparkSession, d: str) -> adjacency.Adjacency:
    name = uuid.uuid4().hex
    return adjacency.write_adjacency(star.edges(spark, d), f"{tables.shared_folder(spark)}/edges-{name}", f"edges_{name}", 64)


def _seed(spark: SparkSession, *ids: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, ids))).alias("id"))


@query(f"""WITH {EDGES} SELECT DISTINCT a.dst AS speaker, c.dst AS "group" FROM edges a JOIN edges b ON a.src = b.src AND b.label = 'PRESENTED_AT' JOIN edges c ON b.dst = c.src AND c.label = 'PART_OF'
WHERE a.label = 'PRESENTED_BY' AND a.dst IN ('speaker:3', 'speaker:7')""")
def c7_stored_groups(spark: SparkSession, d: str) -> DataFrame:
    """The groups of two speakers, three hops over edges stored for hops. Writes when called."""
    steps = (("PRESENTED_BY", adjacency.IN), ("PRESENTED_AT", adjacency.OUT), ("PART_OF", adjacency.OUT))
    found = _adjacency(spark, d).path(_seed(spark, "speaker:3", "speaker:7"), *steps)
    return found.select(F.col("seed").alias("speaker"), F.col("id").alias("group"))


@query(f"""WITH RECURSIVE {EDGES}, both_ways AS (SELECT src AS a, dst AS b FROM edges WHERE label IN ('WORKS_AT', 'PRESENTED_BY') UNION SELECT dst, src FROM edges WHERE label IN ('WORKS_AT', 'PRESENTED_BY')),
reached AS (SELECT 'company:3' AS id, 0 AS distance UNION SELECT b, distance + 1 FROM reached JOIN both_ways ON id = a WHERE distance < 3)
SELECT id, min(distance) AS distance FROM reached GROUP BY id""")
def c9_stored_reach(spark: SparkSession, d: str) -> DataFrame:
    """All nodes within three hops of a company, over employers and talks in both directions, by a loop over frontiers. Writes when called."""
    return _adjacency(spark, d).within(_seed(spark, "company:3"), ("WORKS_AT", "PRESENTED_BY"), 3)


@query(f"""WITH {TALKS}, r AS (SELECT {TALK_ID} AS tid, 'source/group-' || c_nationkey || '/' || l_orderkey || '.html' AS source_file, l_orderkey % 2 AS half, {slug("person")} AS who FROM talks),
kept AS (SELECT half, tid, max(source_file) AS source_file FROM r GROUP BY half, tid),
told AS (SELECT tid, regexp_extract(source_file, '([^/]+)\\.html', 1) AS event_id, regexp_extract(source_file, 'group-([0-9]+)', 1) AS g FROM kept)
SELECT 'talk:' || tid AS src, 'event:group-' || g || '-' || event_id AS dst, 'PRESENTED_AT' AS label FROM told
UNION SELECT 'event:group-' || g || '-' || event_id, 'group:group-' || g, 'PART_OF' FROM told
UNION SELECT 'talk:' || tid, 'speaker:' || who, 'PRESENTED_BY' FROM r""")
def w_incremental_load(spark: SparkSession, d: str) -> DataFrame:
    """A stored graph's edges after two runs, over even and odd announcements, were loaded into it one after the other. Writes when called."""
    folder, node = _folder(spark), star.announcements(spark, d)
    for half in (0, 1):
        events = records.response_events(node.filter(F.col("node.id").cast("bigint") % 2 == half))
        workloads.load_records(workloads.events_to_records(events, RUN_TS, DEFAULT_DATE), folder)
    return tables.graph_tables(spark, folder)[1].read().select("src", "dst", "label")
