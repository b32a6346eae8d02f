"""Records, merges, batches, answers and repository matches on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from graphloom import schemas
from graphloom.functions import text as X
from graphloom.operators import batches, enrich, graph, traverse
from graphloom.operators.records import spread_edges, spread_nodes
from graphloom.operators.talks import batch_positions, renumbered, talk_rows, with_talks
from graphloom.plans import workloads
from graphloom.sources.pages import EVENT_COLUMNS

EVENT = "id string, title string, description_md string, description_text string, datetime timestamp, date date, url string, venue_name string, venue_address string, city string, group_slug string, group_name string"


def event(id_, title="An Evening", text="", date=None, group="g"):
    return (id_, title, text, text, None, date, f"https://x/events/{id_}", None, None, None, group, "The Group")


def test_event_to_graph(spark):
    import datetime

    day = datetime.date(2024, 3, 9)
    text = "**Streaming Joins at Scale**\n***Jane Roe*, Acme**\nBody.\n**Typed Tables for Everyone**\n***Ann Poe*, Acme**"
    rows = [event("1", text=text, date=day), event("2", title="John Doe: Graphs in Anger", text="nothing"), event("3", text="no talks here")]
    events = spark.createDataFrame(rows, EVENT)
    assert events.columns == list(EVENT_COLUMNS)
    nodes, edges = workloads.events_to_graph(events, "2024-05-01", "2024-01-02", id_prefix="tt", url_base="https://x/")
    ids = {r.id: json.loads(r.props) for r in nodes.collect()}
    assert set(ids) == {
        "talk:tt-20240309-streaming-joins-at-scale-jane-roe", "talk:tt-20240309-typed-tables-for-everyone-ann-poe", "talk:tt-20240102-graphs-in-anger-john-doe",
        "event:g-1", "event:g-2", "group:g", "speaker:jane-roe", "speaker:ann-poe", "speaker:john-doe",
    }
    assert ids["speaker:jane-roe"] == {"name": "Jane Roe", "bio": None, "company": "Acme", "role": None}
    assert ids["talk:tt-20240309-typed-tables-for-everyone-ann-poe"]["order"] == 1
    assert ids["group:g"] == {"slug": "g", "name": "The Group", "url": "https://x/g"} and ids["event:g-1"]["date"] == "2024-03-09"
    counts = {r.label: r.n for r in graph.label_counts(edges, schemas.EDGE_TYPES).collect()}
    assert counts == {"PRESENTED_AT": 3, "PART_OF": 2, "PRESENTED_BY": 3, "WORKS_AT": 0, "MENTIONS": 0}
    assert [r.speaker for r in traverse.speakers_at(edges, "event:g-1").orderBy("speaker").collect()] == ["speaker:ann-poe", "speaker:jane-roe"]
    assert graph.one_venue_violations(edges).count() == 0
    assert all(graph.coherence(nodes, edges).collect()[0])
    totals = batches.run_totals(with_talks(events)).collect()[0]
    assert (totals.n_events, totals.n_talks, totals.n_skipped) == (3, 3, 1)


def test_hot_group_is_cut_before_the_shuffle(spark):
    nodes = spark.range(1000).select(F.format_string("%05d", "id").alias("source_file"), F.lit(0).alias("pos"), F.lit("group:g").alias("id"), F.lit("Group").alias("label"), F.col("id").cast("string").alias("props"))
    assert graph.first_nodes(nodes).collect()[0].props == "0" and graph.last_nodes(nodes).collect()[0].props == "999"
    plan = graph.first_nodes(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_merge_keeps_overrides_and_removes(spark):
    old = spark.createDataFrame([("a", "Talk", '{"x":1,"y":"k"}'), ("b", "Talk", "{}")], "id string, label string, props string")
    new = spark.createDataFrame([("a", "Talk", '{"x":null,"z":[1]}'), ("c", "Event", '{"q":null}')], "id string, label string, props string")
    got = {r.id: (r.label, json.loads(r.props)) for r in graph.merge_nodes(old, new).collect()}
    assert got == {"a": ("Talk", {"y": "k", "z": [1]}), "b": ("Talk", {}), "c": ("Event", {})}
    replaced = {r.id: json.loads(r.props) for r in graph.merge_nodes(old, new, replace=True).collect()}
    assert replaced["a"] == {"x": None, "z": [1]}


def test_endpoint_rule(spark):
    nodes = spark.createDataFrame([("t", "Talk", ""), ("e", "Event", ""), ("g", "Group", "")], "id string, label string, props string")
    edges = spark.createDataFrame([("t", "e", "PRESENTED_AT", ""), ("t", "g", "PRESENTED_AT", ""), ("t", "x", "PRESENTED_AT", ""), ("t", "e", "ODD", "")], "src string, dst string, label string, props string")
    assert [(r.src, r.dst) for r in graph.joined_edges(edges, nodes).collect()] == [("t", "e")]
    assert graph.joined_edges(edges, nodes, check_labels=False).count() == 3


def answer(*events, kind="tool_use"):
    return json.dumps({"content": [{"type": "text"}, {"type": kind, "input": {"events": list(events)}}]})


def test_answers(spark):
    talk = {"title": "Keys", "abstract": "a", "speakers": [{"name": "Jane Roe", "company": "Acme"}, {"name": "Ann Poe", "company": " "}], "projects": [{"name": "Big Tool"}, {"name": ""}]}
    rows = [
        (1, answer({"event_id": "1", "talks": [{"title": "None here", "speakers": []}, talk]}, {"event_id": "9", "talks": []})),
        (2, answer({"event_id": "2", "talks": [{"title": None, "speakers": []}]})),
        (3, answer({"event_id": "2", "talks": []}, kind="other")),
        (4, answer({"event_id": "2", "talks": [{"title": "Joins", "abstract_text": "b", "speakers": [{"name": "Jane Roe"}]}]})),
    ]
    decoded = batches.decoded_answers(spark.createDataFrame(rows, "batch_id int, value string"))
    assert {r.batch_id for r in decoded.filter("rejected").collect()} == {2, 3}
    events = spark.createDataFrame([(1, *event("1")), (4, *event("2"))], f"batch_id int, {EVENT}")
    found, lost = batches.matched_answers(decoded, events)
    assert [tuple(r) for r in lost.collect()] == [(1, "9")]
    kept = workloads.answers_to_records(spark.createDataFrame(rows, "batch_id int, value string"), events, "now", "2024-01-02").collect()
    assert {r.id for r in kept} == {"talk-20240102-keys-jane-roe", "talk-20240102-joins-jane-roe"}
    told = spark.createDataFrame(kept)
    assert {r.id for r in spread_nodes(told).collect() if r.label in ("Company", "Project")} == {"company:acme", "project:big-tool"}
    keys = {(r.src, r.label, r.dst) for r in spread_edges(told).collect()}
    assert ("speaker:jane-roe", "WORKS_AT", "company:acme") in keys and ("talk:talk-20240102-keys-jane-roe", "MENTIONS", "project:big-tool") in keys
    orders = {json.loads(r.props)["order"] for r in spread_nodes(told).collect() if r.label == "Talk"}
    assert orders == {0}  # numbered after talks without speakers are dropped
    assert found.count() == 2


def test_batches_and_prompts(spark):
    events = spark.createDataFrame([event(str(i), text=f" body {i} " * 10) for i in range(23)] + [event("short", text="é" * 24)], EVENT)
    assert batches.long_enough(events).count() == 23
    placed = batch_positions(events, "id", 5, 12).collect()
    assert {r.bucket for r in placed} == {0, 1}
    assert {r.position for r in placed} <= set(range(1, 6)) and len({(r.bucket, r.batch, r.position) for r in placed}) == 24
    assert all(r.batch_size == sum((x.bucket, x.batch) == (r.bucket, r.batch) for x in placed) for r in placed)
    assert batch_positions(events, "id", 0).select("batch").distinct().count() == 24
    done = spark.createDataFrame([("source/g/3.html",), ("odd",), (None,)], "source_file string")
    prompts = workloads.batch_prompts(events, done, "Of the following {n} events:\n\n", 5).orderBy("batch").collect()
    assert sum(r.n_events for r in prompts) == 22 and len(prompts) == 5
    assert prompts[0].prompt.count("══ EVENT") == 5 and "══ EVENT 2/5  event_id:" in prompts[0].prompt and "following 5 event" in prompts[0].prompt
    assert "date:unknown\nTitle: An Evening\nURL: https://x/events/" in prompts[0].prompt


def test_renumbering(spark):
    row = spark.createDataFrame([event("1", text="**Streaming Joins at Scale**\nJane Roe, Acme\n**Typed Tables for Everyone**\nAnn Poe, Acme")], EVENT)
    told = with_talks(row).withColumn("talks", renumbered(F.reverse("talks")))
    assert [(r.talk_order, r.talk["order"], r.talk["title"]) for r in talk_rows(told).collect()] == [(0, 0, "Typed Tables for Everyone"), (1, 1, "Streaming Joins at Scale")]


CANDIDATES = [
    ("p1", 1, "u1", "other", "o/other", None), ("p1", 2, "u2", "my-big-tool", "o/t", None),
    ("p2", 1, "u3", "kit", "o/kit", None),
    ("p3", 1, "u4", "x", "o/x", "The small lib of all"),
    ("p4", 1, "u5", "alpha gamma", "o/q", None), ("p5", 1, "u6", "alpha gamma delta", "o/q", None), ("p5", 2, "u7", "alpha beta", "o/q", None),
    ("p6", 1, "u8", "zzz", "o/zzz", None), ("p8", 1, "u9", "anything", "o/a", None), ("p9", 6, "u10", "late tool", "o/l", None),
]


def test_repository_matches(spark):
    names = {"p1": "Big Tool", "p2": "My Kit", "p3": "Small Lib", "p4": "Alpha Beta", "p5": "Alpha Epsilon", "p6": "None", "p7": "No Candidates", "p8": "日本", "p9": "late tool"}
    projects = spark.createDataFrame(sorted(names.items()), "id string, name string")
    told = spark.createDataFrame(CANDIDATES, "project_nid string, rank int, html_url string, name string, full_name string, description string")
    got = {r.id: r.url for r in enrich.matched_projects(projects, told).collect()}
    # p4: one of three tokens agrees; p8 has no letters that count; p9's only candidate is beyond the best five
    assert got == {"p1": "u2", "p2": "u3", "p3": "u4", "p4": None, "p5": None, "p6": None, "p7": None, "p8": None, "p9": None}
    half = spark.createDataFrame([("p4", 1, "u5", "alpha beta gamma delta", "o/q", None)], told.schema).withColumn("name", F.lit("alpha-x-beta-y"))
    assert enrich.matched_projects(projects.filter("id = 'p4'"), half).collect()[0].url == "u5"


def test_addresses_are_written_everywhere(spark):
    rows = [("a", 0, "project:t", "Project", '{"name":"T","github_url":null}'), ("b", 1, "project:t", "Project", '{"name":"T2"}'), ("b", 2, "project:u", "Project", '{"name":"U","github_url":"old"}'), ("c", 0, "talk:1", "Talk", "{}"), ("c", 1, "project:v", "Project", '{"name":""}')]
    nodes = spark.createDataFrame(rows, "source_file string, pos int, id string, label string, props string")
    assert [tuple(r) for r in enrich.projects_to_enrich(nodes).collect()] == [("project:t", "T")]
    assert enrich.projects_to_enrich(nodes, again=True).count() == 2
    candidates = spark.createDataFrame([("project:t", 1, 'https://x/"t"\\', "t", "o/t", None)], "project_nid string, rank int, html_url string, name string, full_name string, description string")
    new, matches = workloads.enriched_nodes(nodes, candidates)
    got = {(r.source_file, r.pos): json.loads(r.props) for r in new.collect()}
    assert got["a", 0] == {"name": "T", "github_url": 'https://x/"t"\\'} and got["b", 1]["github_url"] == 'https://x/"t"\\'
    assert got["b", 2]["github_url"] == "old" and got["c", 0] == {}
    assert tuple(enrich.coverage(matches, nodes).collect()[0]) == (1, 1, 2, 2)


@pytest.mark.parametrize(
    "text,slug",
    [("Hello, World!", "hello-world"), ("--a--", "a"), ("日本", ""), ("x" * 70, "x" * 60), ("a" * 59 + " b", "a" * 59), ("É t", "t"), (None, None)],
)
def test_slugs(spark, text, slug):
    assert spark.createDataFrame([(text,)], "t string").select(X.slugify(F.col("t"))).collect()[0][0] == slug


def test_scalars(spark):
    one = lambda value, f, kind="string": spark.createDataFrame([(value,)], f"t {kind}").select(f(F.col("t"))).collect()[0][0]
    assert one("  x　\n", X.trim_ws) == "x"
    assert one("a [l](u) **b** \\# c\n\n\n\n## h\n* i\n", X.markdown_to_text) == "a l b # c\n\nh\ni"
    assert one(" [l](u) *b* \\#c\\", X.clean_md) == "l b #c"
    assert one("​a\\#\\-\\*\\.\\x", X.preclean) == "a#-*.\\x"
    assert one(" TECH talk 3 - Keys ", X.normalize_title) == "Keys"
    assert one("https://x/events/12/y", X.event_id_of) == "12" and one("https://x", X.event_id_of) is None
    assert str(one("2017-01-17T18:30-08:00", lambda c: F.to_date(X.utc_timestamp(c)))) == "2017-01-18"
    assert one("2017-01-17", X.utc_timestamp) is None and one("2017-13-17T18:30:00Z", X.utc_timestamp) is None
    assert one("é" * 14, X.single_talk_abstract) is None and one("é" * 15, X.single_talk_abstract) == "é" * 15
    assert one("x" + "é" * 600, X.single_talk_abstract) == "x" + "é" * 499
    assert one("a/b/c.d.html", X.file_stem) == "c.d" and one("abc", X.file_stem) is None
    assert one("x", lambda c: X.group_display_name(c, {"x": "X"})) == "X" and one("y", lambda c: X.group_display_name(c, {})) == "y"


def test_last_event_of_an_id_is_answered(spark):
    decoded = batches.decoded_answers(spark.createDataFrame([(1, answer({"event_id": "1", "talks": []}))], "batch_id int, value string"))
    events = spark.createDataFrame([(1, 2, *event("1", title="A")), (1, 1, *event("1", title="Z"))], f"batch_id int, position int, {EVENT}")
    assert [r.title for r in batches.matched_answers(decoded, events)[0].collect()] == ["A"]


def test_recovered_talks_replace_the_title_s(spark):
    events = spark.createDataFrame([event("1", title="John Doe: Graphs in Anger"), event("2", title="John Doe: Graphs in Anger"), event("3", text="words")], EVENT)
    html = '<h1>x</h1><div class="event-description">**Streaming Joins at Scale**\nJane Roe, Acme</div>'
    pages = spark.createDataFrame([(html, "https://x/events/77", "g", "1"), (html, "https://x/events/3", "g", "3")], "html string, url string, group_slug string, event_id string")
    kept = workloads.crawl_to_records(events, pages, "now", "2024-01-02").collect()
    assert {(r.id, r.source_file) for r in kept} == {("talk-20240102-streaming-joins-at-scale-jane-roe", "source/g/1.html"), ("talk-20240102-graphs-in-anger-john-doe", "source/g/2.html")}


def test_titles_tell_talks_on_pages_with_a_state_only(spark):
    state = '<script id="__NEXT_DATA__">{"props":{"pageProps":{"__APOLLO_STATE__":{"Event:1":{"id":"1","title":"John Doe: Graphs in Anger"}}}}}</script>'
    script = '<script type="application/ld+json">{"@type":"Event","name":"John Doe: Graphs in Anger"}</script>'
    rows = [(h, f"https://x/events/{i}", "g") for i, h in enumerate((state, script, "<h1>John Doe: Graphs in Anger</h1>"), start=1)]
    got = {r.source: len(r.talks) for r in workloads.page_talks(spark.createDataFrame(rows, "html string, url string, group_slug string")).collect()}
    assert got == {"state": 1, "json_ld": 0, "html": 0}


def test_candidates_equal_a_comparison_of_all_pairs(spark):
    import itertools

    words = ["spark", "kit", "a", "re", "graph", "tool", "日"]
    names = [" ".join(p) for n in (1, 2, 3) for p in itertools.permutations(words[:5], n)][::3] + words + ["", "!"]
    repos = [("-".join(p), f"own/{p[0]}x", "the " + p[-1]) for p in itertools.permutations(words, 3)][::4] + [("sparkkit", "o/s", None), ("ki", "o/k", "")]
    projects = spark.createDataFrame([(f"p{i}", n) for i, n in enumerate(names)], "id string, name string")
    catalog = spark.createDataFrame(repos, "name string, full_name string, description string")
    scores = X.match_score(F.col("pname"), F.col("name"), F.col("full_name"), F.col("description"))
    every = projects.select(F.col("id").alias("project_nid"), F.col("name").alias("pname")).crossJoin(catalog).filter(scores[0] | scores[1])
    wanted = {(r.project_nid, r.name, r.full_name) for r in every.collect()}
    found = [(r.project_nid, r.name, r.full_name) for r in enrich.catalog_candidates(projects, catalog).collect()]
    assert len(found) == len(set(found)) and set(found) == wanted and len(wanted) > 100


def test_candidates_by_frequent_tokens_only(spark):
    n = 2500
    catalog = spark.range(n).selectExpr("concat('graph-', id) AS name", "concat('o/graph-', id) AS full_name", "id AS stars")
    projects = spark.createDataFrame([("p:1", "Graph"), ("p:2", "graph 7"), ("p:3", "other")], "id string, name string")
    found = enrich.catalog_candidates(projects, catalog)
    assert found.columns == ["project_nid", "project_name", "name", "full_name", "stars"]
    assert {(r.project_nid, r.n) for r in found.groupBy("project_nid").agg(F.count("*").alias("n")).collect()} == {("p:1", n), ("p:2", 111)}
