"""Nodes with very many edges: their pairs are made in many tasks."""

from itertools import combinations

from pyspark.sql import functions as F

from graphloom.operators import traverse
from graphloom.sources import adjacency


def test_pairs_of_a_talk_with_many_speakers(spark, monkeypatch):
    monkeypatch.setattr(traverse, "BLOCK_SPEAKERS", 40)
    hub = spark.range(700).select(F.lit("talk:hub").alias("src"), F.concat(F.lit("speaker:"), F.col("id").cast("string")).alias("dst"))
    small = spark.createDataFrame([("talk:a", "speaker:1"), ("talk:a", "speaker:2"), ("talk:a", "speaker:2"), ("talk:b", "speaker:9"), (None, "speaker:3"), ("talk:c", None)], "src string, dst string")
    edges = hub.unionByName(small).withColumn("label", F.lit("PRESENTED_BY"))
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        pairs = traverse.presenter_pairs(edges)
        tasks = pairs.filter("talk = 'talk:hub'").groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in tasks) == 700 * 699 // 2
        assert len(tasks) > 4 and max(r["count"] for r in tasks) < 700 * 699 // 2 / 3
        found = {(r.a, r.b): r.n_talks for r in traverse.co_presenters(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    wanted = dict.fromkeys(combinations(sorted(f"speaker:{i}" for i in range(700)), 2), 1)
    wanted["speaker:1", "speaker:2"] = 2
    assert found == wanted


def test_stored_edges_are_not_exchanged(spark, tmp_path):
    """Hops over the bucketed tables: between a scan and its join there is no exchange, and a new session finds the tables."""
    rows = [(f"talk:{i}", f"speaker:{i % 5}", "PRESENTED_BY") for i in range(50)] + [(f"talk:{i}", f"event:{i % 7}", "PRESENTED_AT") for i in range(50)]
    edges = spark.createDataFrame(rows, "src string, dst string, label string")
    labels = ("PRESENTED_BY", "PRESENTED_AT")
    stored = adjacency.write_adjacency(edges, str(tmp_path / "e"), "hops", 8, labels)
    seeds = spark.createDataFrame([("speaker:1",), ("speaker:4",), ("speaker:9",), (None,)], "id string")
    wanted = {(f"speaker:{s}", f"event:{i % 7}") for s in (1, 4) for i in range(50) if i % 5 == s}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side were small
    try:
        found = stored.path(seeds, ("PRESENTED_BY", adjacency.IN), ("PRESENTED_AT", adjacency.OUT))
        assert {tuple(r) for r in found.collect()} == wanted
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [max(x.find("+- "), x.find(":- ")) for x in plan]
    scans = [i for i, x in enumerate(plan) if "FileScan" in x]
    assert len(scans) == 2
    for i in scans:
        above, level = [], depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < level:
                above.append(plan[j])
                level = depth[j]
                if "Join" in plan[j]:
                    break
        assert above and "Join" in above[-1] and not any("Exchange" in x for x in above), above
    again = adjacency.open_adjacency(spark, str(tmp_path / "e"), "again", 8, labels)
    assert {tuple(r) for r in again.path(seeds, ("PRESENTED_BY", adjacency.IN), ("PRESENTED_AT", adjacency.OUT)).collect()} == wanted
    far = {r.id: r.distance for r in again.within(seeds.filter("id = 'speaker:1'"), labels, 9).collect()}
    assert far["speaker:1"] == 0 and far["talk:6"] == 1 and far["event:6"] == 2 and max(far.values()) == 4 and len(far) == 50 + 5 + 7
    assert again.within(seeds.limit(0), labels, 3).count() == 0
