"""What is exchanged and stored of wide rows."""

import re

from pyspark.sql import functions as F

from graphloom import queries as Q
from graphloom import schemas
from graphloom.plans import star, workloads
from graphloom.sources import keyed, tables

SF = "/root/testdata/sf0.001"


def plan(frame):
    """The plan that ran, or will, with expressions."""
    return frame._jdf.queryExecution().executedPlan().toString()


def test_only_what_is_told_of_last_records_is_exchanged(spark):
    assert not re.search(r"PRESENTED_AT|Aggregate.*nodes", plan(Q.QUERIES["a5_last_record"](spark, SF)))


def test_descriptions_are_not_exchanged_for_their_customers(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = plan(star.described_orders(spark, SF, F.lit("text")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = told.splitlines()
    at = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in x)
    assert at > next(i for i, x in enumerate(lines) if "Join [o_orderkey" in x or "Join [cast(o_orderkey" in x)  # deeper than the join with descriptions


def record(id_, nodes, edges):
    return ("1.1", id_, "1", f"f/{id_}", [(i, label, "{}") for i, label in nodes], [(a, b, t, "{}") for a, b, t in edges])


def test_edges_are_checked_by_their_own_records_or_by_all(spark):
    """With ends in the records themselves nothing is exchanged for the check; strays, odd labels and disputed ids are found by the joins."""
    talk, event = ("talk:a", "Talk"), ("event:1", "Event")
    whole = [record("a", [talk, event, ("group:g", "Group")], [("talk:a", "event:1", "PRESENTED_AT"), ("event:1", "group:g", "PART_OF")]), record("b", [], [])]
    edges = workloads.graph_of_records(spark.createDataFrame(whole, schemas.STORED_RECORD))[1]
    assert "Join" not in plan(edges) and {(r.src, r.dst) for r in edges.collect()} == {("talk:a", "event:1"), ("event:1", "group:g")}
    cases = {
        "an end in another record": ([record("c", [("talk:c", "Talk")], [("talk:c", "event:1", "PRESENTED_AT")])], {("talk:c", "event:1")}),
        "no end": ([record("c", [("talk:c", "Talk")], [("talk:c", "event:2", "PRESENTED_AT")])], set()),
        "a null end": ([record("c", [("talk:c", "Talk"), (None, "Event")], [("talk:c", None, "PRESENTED_AT")])], set()),
        "an unknown type": ([record("c", [talk, event], [("talk:a", "event:1", "NEXT")])], set()),
        "an unknown label": ([record("c", [("talk:c", "Odd"), event], [("talk:c", "event:1", "PRESENTED_AT")])], set()),
        "an id that was something else first": ([record("0", [("event:1", "Group")], [])], {None}),
    }
    for name, (more, found) in cases.items():
        records = spark.createDataFrame(whole + more, schemas.STORED_RECORD)
        nodes, edges = workloads.graph_of_records(records)
        assert "Join" in plan(edges), name
        wanted = set() if None in found else {("talk:a", "event:1"), ("event:1", "group:g")} | found
        assert {(r.src, r.dst) for r in edges.collect()} == wanted, name


def test_pages_are_read_once(spark):
    """Each kind of page had its own reading of all pages and its own of all talks."""
    told = plan(workloads.page_talks(star.saved_pages(spark, SF)))
    assert told.count("MapInArrow") == 1 and told.count("ArrowEvalPython") == 1


def test_large_updates_are_merged_in_passes(spark, tmp_path, monkeypatch):
    schema = "k long, at string, v string"
    rows = lambda v, ids: spark.range(200).filter(ids).select(F.col("id").alias("k"), F.explode(F.array(F.lit("1"), F.lit("2"))).alias("at"), F.lit(v).alias("v"))
    found = {}
    for size in (1, 128 << 20):
        monkeypatch.setattr(keyed, "PASS_BYTES", size)
        t = keyed.KeyedTable(spark, str(tmp_path / str(size)), ("k",), schema, 16)
        merges = []
        told = keyed.KeyedTable._replaced
        monkeypatch.setattr(keyed.KeyedTable, "_replaced", lambda self, *a: merges.append(1) or told(self, *a))
        t.upsert(rows("old", "id >= 0"), last=("at",))
        t.upsert(rows("new", "id % 2 = 0"), last=("at",))
        monkeypatch.setattr(keyed.KeyedTable, "_replaced", told)
        found[size] = sorted(map(tuple, t.read().collect()))
        assert len(merges) == (16 if size == 1 else 2) and t.versions() == [1, 2]
        assert sorted(r.k for r in t.told(lambda r: r.filter("v = 'new'")).collect()) == list(range(0, 200, 2))
    assert found[1] == found[128 << 20] == [(k, "2", "old" if k % 2 else "new") for k in range(200)]


def test_stored_records_are_compressed(spark, tmp_path):
    rows = [record(f"talk-{i}", [("project:1", "Project")], []) for i in range(50)]
    tables.write_records(spark.createDataFrame(rows, schemas.STORED_RECORD), str(tmp_path / "r"))
    files = tables.record_table(spark, str(tmp_path / "r")).read().inputFiles()
    assert files and all(f.endswith(".gz") for f in files)


def test_record_texts_are_made_and_parsed_once(spark):
    told = plan(Q.QUERIES["a3_record_roundtrip"](spark, SF)).split("== Initial Plan ==")[0]
    assert told.count("ArrowEvalPython") == 1 and told.count("from_json(StructField(schema_version") <= 1
