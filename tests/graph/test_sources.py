"""Readers on small hand-written inputs: pages, JSON responses, records, crawl records, tables."""

import json

import pytest

from graphloom.functions.html import page_parts
from graphloom.operators import graph
from graphloom.sources import pages, records, tables


def page(state=None, ld=None, body=""):
    head = f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(state)}</script>' if state else ""
    head += "".join(f'<script type="application/ld+json">{json.dumps(x)}</script>' for x in ld or [])
    return f"<html><head>{head}</head><body>{body}</body></html>"


def state(**entries):
    return {"props": {"pageProps": {"__APOLLO_STATE__": entries}}}


STATE = state(
    **{
        "Event:20": {"id": "20", "title": "Second", "dateTime": "2020-01-01T18:30:00-08:00", "eventUrl": "https://x/events/20/"},
        "Event:10": {
            "id": "10", "title": "First", "description": "**Bold** [a](http://b)", "dateTime": "bad", "eventUrl": "https://x/events/10//",
            "venue": {"__ref": "Venue:1"}, "group": {"__ref": "Group:1"},
        },
        "Event:30": {"id": "30", "title": "Inline", "venue": {"name": "Hall", "city": "SF"}},
        "Event:40": {"id": "40"},
        "Venue:1": {"name": "Loft", "address": "1 Main", "city": "Oakland"},
        "Group:1": {"name": "The Group"},
    }
)
LD = {"@type": "Event", "name": "Ld", "description": "d", "startDate": "2020-05-01T02:00:00Z", "location": {"name": "L", "address": {"streetAddress": "S", "addressLocality": "C"}}, "organizer": {"name": "O"}}


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("source")
    files = {
        "g1/10.html": page(STATE), "g1/20.html": page(STATE), "g1/30.html": page(STATE), "g1/40.html": page(STATE), "g1/50.html": page(STATE),
        "g2/60.html": page(None, [{"@type": "Person"}, LD]),
        "g2/70.html": page(None, None, '<h1> A <b>title</b>\n</h1><h1>no</h1><div class="x event-description">some <i>text</i><div>in</div></div>'),
        "g2/notes.txt": "no page",
    }
    for name, text in files.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_text(text)
    from pyspark.sql import functions as F

    told = pages.read_pages(spark, str(root))
    return told.withColumn("url", F.concat(F.lit("https://x/events/"), "event_id", F.lit("/"))).cache()


def test_pages_are_read_with_group_and_id(saved):
    got = {(r.group_slug, r.event_id) for r in saved.collect()}
    assert got == {("g1", "10"), ("g1", "20"), ("g1", "30"), ("g1", "40"), ("g1", "50"), ("g2", "60"), ("g2", "70")}


def test_page_cascade(saved):
    got = {(r.group_slug, r.url[-3:-1]): r for r in pages.page_events(saved).collect()}
    first = got["g1", "20"]
    assert (first.source, first.id, first.title, first.date, first.venue_name, first.city, first.group_name) == ("state", "10", "First", None, "Loft", "Oakland", "The Group")
    assert first.description_text == "Bold a"
    ld = got["g2", "60"]
    assert (ld.source, ld.id, ld.title, str(ld.date), ld.venue_address, ld.city, ld.group_name) == ("json_ld", "60", "Ld", "2020-05-01", "S", "C", "O")
    plain = got["g2", "70"]
    assert (plain.source, plain.title, plain.description_md, plain.date, plain.group_name) == ("html", "A title", "some <i>text</i><div>in</div>", None, "g2")


def test_metadata_uses_the_exact_key(saved):
    got = {r.id: r for r in pages.state_metadata(pages.with_parts(saved)).collect()}
    assert set(got) == {"10", "20", "30"}  # 40 has no title, 50 is not in the state
    assert (got["10"].venue_name, got["30"].venue_name, got["30"].city, got["20"].venue_name) == ("Loft", "Hall", "SF", None)
    assert str(got["20"].date) == "2020-01-02" and got["10"].date is None


def test_event_links(saved):
    got = {r.url: r.title for r in pages.event_links(pages.with_parts(saved)).collect()}
    assert got == {"https://x/events/10": "First", "https://x/events/20": "Second"}


def test_page_parts_of_broken_pages():
    assert page_parts(None) == page_parts("") == (None, [], None, None)
    assert page_parts("<h1>open").h1 == "open"
    assert page_parts('<div data-testid="event-description">a<br>b').description == "a<br>b"
    both = '<p class="event-description">c</p><p data-testid="event-description">t</p>'
    assert page_parts(both).description == "t"


def test_response_pages(spark):
    node = lambda **k: {"node": {"id": "1", "title": "T", "eventUrl": "u", **k}}
    whole = {"data": {"groupByUrlname": {"events": {"edges": [
        node(description=None, dateTime="2017-01-17T18:30-08:00", venue=None),
        node(id="2", title=None),
        node(id="3", description="# Head\n* a", dateTime="soon", venue={"name": "V", "city": "C"}),
    ]}}}}
    texts = [(json.dumps(whole), "g"), (json.dumps({**whole, "errors": [{"message": "no"}]}), "g"), ("{", "g"), (json.dumps({"data": None}), "g")]
    got = {r.id: r for r in records.response_events(records.event_page_rows(spark.createDataFrame(texts, "value string, group_slug string"))).collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"].description_text, str(got["1"].date), got["1"].venue_name) == ("", "2017-01-18", None)
    assert (got["3"].description_text, got["3"].date, got["3"].city) == ("Head\na", None, "C")


CURRENT = {"schema_version": "1.0", "id": "t1", "source_file": "source/g/1.html", "nodes": [{"id": "talk:t1", "label": "Talk", "props": {"id": "t1", "title": "A"}}], "edges": [{"from": "talk:t1", "to": "event:1", "label": "PRESENTED_AT", "props": {}}]}
OLDER = {
    "schema_version": "1.0", "id": "t2", "source_file": "source/g/2.html",
    "nodes": [{"id": "talk:t2", "type": "Talk", "properties": {"id": "x", "title": "B", "n": None}}, {"id": "group:g", "type": "Group", "properties": "odd"}],
    "edges": [{"from": "talk:t2", "to": "event:1", "type": "PRESENTED_AT"}],
}


def test_records_of_both_formats(spark, tmp_path):
    for name, text in (("a", json.dumps(CURRENT)), ("b", json.dumps(OLDER, indent=1)), ("c", "{ broken"), ("d", "[]")):
        (tmp_path / f"{name}.json").write_text(text)
    told = records.read_records(spark, str(tmp_path))
    assert records.broken_records(told).collect()[0] == (4, 2)
    nodes = {r.id: r for r in records.record_nodes(told, drop_id=True).collect()}
    assert {n: (r.label, json.loads(r.props)) for n, r in nodes.items()} == {
        "talk:t1": ("Talk", {"title": "A"}), "talk:t2": ("Talk", {"title": "B", "n": None}), "group:g": ("Group", {}),
    }
    kept = {r.id: json.loads(r.props) for r in records.record_nodes(told).collect()}
    assert kept["talk:t2"]["id"] == "x"
    assert sorted((r.src, r.dst, r.label, r.props) for r in records.record_edges(told).collect()) == [
        ("talk:t1", "event:1", "PRESENTED_AT", "{}"), ("talk:t2", "event:1", "PRESENTED_AT", "{}"),
    ]


def test_graph_tables_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([("a", "Talk", "{}"), ("b", "Event", '{"id":"1"}')], "id string, label string, props string")
    edges = spark.createDataFrame([("a", "b", "PRESENTED_AT", "{}")], "src string, dst string, label string, props string")
    folder = str(tmp_path / "graph")
    tables.write_graph(nodes, edges, folder)
    again = tables.read_graph(spark, folder)
    assert sorted(again[0].collect()) == sorted(nodes.collect()) and again[1].collect() == edges.collect()
    with pytest.raises(Exception, match="already exists"):
        tables.write_graph(nodes, edges, folder, clear=False)
    tables.write_graph(nodes.limit(1), edges, folder)
    assert tables.read_graph(spark, folder)[0].count() == 1


def test_last_records_and_dry_run(spark, tmp_path):
    rows = [("t", "2020", "a", 1), ("t", "2021", "b", 2), ("u", "2020", "c", 3)]
    told = spark.createDataFrame(rows, "id string, scraped_at string, source_file string, n int")
    folder = str(tmp_path / "talks")
    assert sorted(r.n for r in tables.write_records(told, folder, dry_run=True).collect()) == [2, 3]
    assert not (tmp_path / "talks").exists()
    tables.write_records(told, folder)
    assert sorted(r.n for r in spark.read.json(folder).collect()) == [2, 3]


def test_crawl_records(spark, tmp_path):
    rows = [
        {"source_id": "e", "conference_id": "c", "event": {"id": "7", "title": "[Cross] Big  Day", "description": "a​\n\n b", "dateTime": "x", "endTime": "y", "eventUrl": "u"}, "meetup_id": "m"},
        {"source_id": "s", "meetup_id": "m", "name": "Jane Roe", "talk_title": "T", "talk_url": "v"},
        {"source_id": "n", "meetup_id": "m", "name": "No Talk"},
        {"source_id": "t", "conference_id": "c", "title": "U", "speaker_text": "John", "tags": ["a"], "url": "w"},
    ]
    for r in rows:
        (tmp_path / f"{r['source_id']}.json").write_text(json.dumps(r, indent=1))
    got = {r.source_id: r for r in records.flatten_crawl(records.read_crawl(spark, str(tmp_path))).collect()}
    assert set(got) == {"e", "s", "t"}
    assert (got["e"].id, got["e"].title, got["e"].description, got["e"].event_title, got["e"].end_time) == ("talk:c:e", "Big  Day", "a b", "[Cross] Big  Day", "y")
    assert (got["s"].id, got["s"].title, got["s"].speaker_text, got["s"].url, got["s"].tags) == ("talk:m:s", "T", "Jane Roe", "v", [])
    assert (got["t"].title, got["t"].tags, got["t"].event_id) == ("U", ["a"], None)
    assert (got["e"].conference_id, got["e"].meetup_id, got["s"].meetup_id, got["t"].conference_id, got["t"].source_file) == ("c", "m", "m", "c", None)


def test_typed_tables_and_labels(spark):
    nodes = spark.createDataFrame(
        [("talk:1", "Talk", '{"title":"A","abstract":null,"order":3}'), ("talk:2", "Talk", '{"title":5,"order":"x"}'), ("odd:1", "Odd", "{}")], "id string, label string, props string"
    )
    assert sorted(map(tuple, graph.typed_nodes(nodes, "Talk").collect())) == [("talk:1", "A", "", 3), ("talk:2", "", "", 0)]
    assert graph.typed_nodes(nodes, "Odd").columns == ["nid"]
    assert graph.checked_labels(nodes).count() == 3
    for bad in ("1x", "a-b", "", "é", "a\n", None):
        with pytest.raises(Exception, match="unsafe label"):
            graph.checked_labels(spark.createDataFrame([("i", bad, "{}")], "id string, label string, props string")).collect()


def test_pages_that_cannot_be_read_are_rejected(spark, tmp_path):
    (tmp_path / "g").mkdir()
    for name, content in (("1", b"<h1>One</h1>"), ("2", "<h1>Zwölf</h1>".encode()), ("3", b"<h1>\xff\xfe</h1>"), ("4", b""), ("5", b"<h1>lost</h1>")):
        (tmp_path / "g" / f"{name}.html").write_bytes(content)
    # a checksum that the file doesn't have: reading it fails
    (tmp_path / "g" / ".5.html.crc").write_bytes(b"crc\0" + (512).to_bytes(4, "big") + b"\0\0\0\0")
    got = {r.event_id: (r.group_slug, r.html) for r in pages.read_pages(spark, str(tmp_path)).collect()}
    assert got == {"1": ("g", "<h1>One</h1>"), "2": ("g", "<h1>Zwölf</h1>")}  # Spark skips the empty file
    rejects = {r.path.rsplit("/", 1)[1]: r.reason for r in pages.rejected_pages(spark, str(tmp_path)).collect()}
    assert rejects == {"3.html": "not UTF-8", "5.html": "unreadable"}


def test_response_pages_of_a_folder(spark, tmp_path):
    """read_event_pages(): groups by folder; dropped nodes and broken records are counted on the way."""
    (tmp_path / "g1").mkdir()
    edge = lambda **n: {"node": n}
    whole = edge(id="1", title="One", eventUrl="u", dateTime="2020-01-01T18:30:00-08:00", description="d")
    told = {"data": {"groupByUrlname": {"events": {"edges": [whole, edge(id="2", eventUrl="u"), edge(title="T", eventUrl="u")]}}}}
    (tmp_path / "g1" / "0.json").write_text(json.dumps(told))
    (tmp_path / "g1" / "1.json").write_text(json.dumps({"errors": [{"message": "no"}]}))
    found = records.response_events(records.read_event_pages(spark, str(tmp_path))).collect()
    assert [(r.id, r.group_slug, str(r.date)) for r in found] == [("1", "g1", "2020-01-02")]
    from pyspark.sql import Observation

    seen, files = Observation(), Observation()
    texts = spark.read.text(str(tmp_path / "g1"), wholetext=True).selectExpr("value", "'g1' AS group_slug", "'p' AS path")
    assert records.event_page_rows(texts, seen).count() == 1 and seen.get == {"n_nodes": 3, "n_dropped": 2}
    assert records.parse_records(texts, files).filter("NOT broken").count() == 0 and files.get == {"n_files": 2, "n_broken": 2}
