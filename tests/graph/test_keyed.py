"""Tables that are updated in part: versions, untouched buckets, failures, records and graphs stored in them."""

import os

import pytest
from pyspark.sql import functions as F

from graphloom import schemas
from graphloom.operators import enrich
from graphloom.sources import keyed, tables


def table(spark, folder, **more):
    return keyed.KeyedTable(spark, str(folder), ("k",), "k long, v string", more.pop("buckets", 8), **more)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def files(folder):
    return {os.path.join(p, n) for p, _, names in os.walk(folder) for n in names if n.startswith("part-")}


def content(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_new_rows_replace_old_ones_and_others_stay(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.read().count() == 0 and t.versions() == []
    assert t.upsert(rows(spark, *[(k, "a") for k in range(100)])) == 1
    before = files(tmp_path)
    assert t.upsert(rows(spark, (3, "b"), (1000, "b"), (None, "n"))) == 2
    assert content(t.read()) == sorted([(k, "b" if k == 3 else "a") for k in range(100)] + [(1000, "b"), (None, "n")], key=str)
    assert content(t.read(1)) == sorted([(k, "a") for k in range(100)], key=str)
    assert before < files(tmp_path)
    named = {os.path.relpath(f.split("file:")[-1], str(tmp_path)) for f in t.read().inputFiles()}
    old = {os.path.relpath(f, tmp_path) for f in before}
    assert len(named & old) >= 5 and len(named - old) <= 3  # buckets without a new row keep their files
    assert t.upsert(rows(spark).limit(0)) == 2 and t.versions() == [1, 2]


def test_the_number_of_buckets_is_the_first_version_s(spark, tmp_path):
    table(spark, tmp_path / "t", buckets=4).upsert(rows(spark, *[(k, "a") for k in range(20)]))
    table(spark, tmp_path / "t", buckets=16).upsert(rows(spark, *[(k, "b") for k in range(10)]))
    assert content(table(spark, tmp_path / "t").read()) == sorted([(k, "b" if k < 10 else "a") for k in range(20)], key=str)


def test_a_failed_merge_leaves_the_old_version(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(rows(spark, (1, "a"), (2, "a")))
    broken = lambda old, new: new.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("no"))).otherwise("b").cast("string"))
    with pytest.raises(Exception, match="no"):
        t.upsert(rows(spark, (1, "b"), (2, "b")), broken)
    assert t.versions() == [1] and content(t.read()) == [(1, "a"), (2, "a")]
    assert t.upsert(rows(spark, (2, "c"))) == 2 and content(t.read()) == [(1, "a"), (2, "c")]


def test_of_two_writers_from_one_version_the_second_fails(spark, tmp_path):
    t, other = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    t.upsert(rows(spark, (1, "a")))

    def slow(old, new):
        other.upsert(rows(spark, (1, "other")))
        return new

    with pytest.raises(keyed.Conflict):
        t.upsert(rows(spark, (1, "mine")), slow)
    assert content(t.read()) == [(1, "other")] and t.versions() == [1, 2]


def test_a_merge_may_empty_buckets_and_vacuum_deletes_what_no_version_names(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for text in "abc":
        t.upsert(rows(spark, *[(k, text) for k in range(30)]))
    t.upsert(rows(spark, *[(k, "-") for k in range(30)]), lambda old, new: old.filter("k = 7"))
    many = files(tmp_path)
    t.vacuum(2)
    assert t.versions() == [3, 4] and len(files(tmp_path)) < len(many)
    assert content(t.read(3)) == sorted([(k, "c") for k in range(30)], key=str) and content(t.read()) == [(7, "c")]
    t.vacuum()
    assert t.versions() == [4] and content(t.read()) == [(7, "c")]


def records(spark, *ids, url=None, ts="1"):
    props = '{"name":"P"}' if url is None else '{"name":"P","github_url":"%s"}' % url
    told = [("1.1", i, ts, f"f/{i}", [(f"talk:{i}", "Talk", "{}"), (f"project:{i}", "Project", props), ("project:all", "Project", "{}")], []) for i in ids]
    return spark.createDataFrame(told, schemas.STORED_RECORD)


def test_records_survive_a_second_run(spark, tmp_path):
    folder = str(tmp_path / "r")
    tables.write_records(records(spark, "a", "b"), folder)
    tables.write_records(records(spark, "b", "c", ts="2"), folder)
    tables.write_records(records(spark, "d"), folder, dry_run=True)
    assert {(r.id, r.scraped_at) for r in tables.record_table(spark, folder).read().collect()} == {("a", "1"), ("b", "2"), ("c", "2")}


def test_records_are_rewritten_where_an_address_changes_them(spark, tmp_path):
    folder, kind = str(tmp_path / "r"), "id string, name string, url string"
    tables.write_records(records(spark, "a", "b", "c"), folder)
    tables.write_records(records(spark, "d", url="https://d"), folder)
    matches = spark.createDataFrame([("project:a", "P", 'https://"a\\'), ("project:b", "P", None), ("project:d", "P", "https://d"), ("talk:c", "P", "no")], kind)
    changed = tables.rewrite_records(spark, folder, matches)
    assert [r.id for r in changed.collect()] == ["a"]  # d has its address already, c's id is a talk's
    assert enrich.updated_counts(changed, matches).first() == (1, 1)
    found = {r.id: (r.u, r.n, r.x) for r in tables.record_table(spark, folder).read().select(
        "id", F.get_json_object(F.col("nodes")[1]["props"], "$.github_url").alias("u"), F.get_json_object(F.col("nodes")[1]["props"], "$.name").alias("n"), F.col("nodes")[2]["props"].alias("x")
    ).collect()}
    assert found == {"a": ('https://"a\\', "P", "{}"), "b": (None, "P", "{}"), "c": (None, "P", "{}"), "d": ("https://d", "P", "{}")}
    every = spark.createDataFrame([("project:all", "P", "https://all")], kind)
    assert tables.rewrite_records(spark, folder, every).count() == 4  # a project that all records name
    assert tables.rewrite_records(spark, folder, every).count() == 0


def test_a_stored_graph_is_merged_into(spark, tmp_path):
    folder = str(tmp_path / "g")
    nodes = spark.createDataFrame([(f"n{i}", "Talk", '{"a":1,"b":2}') for i in range(200)], schemas.NODES)
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}", "NEXT", "{}") for i in range(199)], schemas.EDGES)
    assert tables.merge_into_graph(nodes, edges, folder) == (1, 1)
    stored_nodes, stored_edges = tables.graph_tables(spark, folder)
    before = set(stored_nodes.read().inputFiles())
    new = spark.createDataFrame([("n5", "Talk", '{"a":null,"c":3}'), ("m", "Talk", "{}")], schemas.NODES)
    again = spark.createDataFrame([("n5", "n6", "NEXT", '{"w":1}'), ("n5", "m", "NEXT", "{}")], schemas.EDGES)
    assert tables.merge_into_graph(new, again, folder) == (2, 2)
    assert tables.merge_into_graph(new, again, folder) == (3, 3)  # once more: nothing changes
    found = {r.id: r.props for r in stored_nodes.read().collect()}
    assert len(found) == 201 and found["n5"] == '{"b":2,"c":3}' and found["n6"] == '{"a":1,"b":2}' and found["m"] == "{}"
    assert len(before & set(stored_nodes.read().inputFiles())) >= len(before) - 2
    ends = {(r.src, r.dst): r.props for r in stored_edges.read().collect()}
    assert len(ends) == 200 and ends["n5", "n6"] == '{"w":1}'


def test_written_graphs_stand_in_order(spark, tmp_path):
    ids = [f"n{i * 7919 % 1000}" for i in range(1000)]
    nodes = spark.createDataFrame([(i, "Talk" if i < "n5" else "Event", "{}") for i in ids], schemas.NODES).repartition(7)
    edges = spark.createDataFrame([(i, j, "NEXT", "{}") for i, j in zip(ids, ids[1:], strict=False)], schemas.EDGES).repartition(7)
    tables.write_graph(nodes, edges, str(tmp_path / "g"))
    placed = tables.in_file_order(spark.read.parquet(str(tmp_path / "g/nodes"))).collect()
    for label in ("Talk", "Event"):
        assert [r.id for r in sorted((r for r in placed if r.label == label), key=lambda r: r.place)] == sorted(r.id for r in placed if r.label == label)
    told = tables.in_file_order(spark.read.parquet(str(tmp_path / "g/edges"))).collect()
    assert [(r.src, r.dst) for r in sorted(told, key=lambda r: r.place)] == sorted(zip(ids, ids[1:], strict=False))
