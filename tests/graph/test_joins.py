import pytest
from pyspark.sql import functions as F

from graphloom.operators import enrich
from graphloom.operators.joins import join_hot

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(spark):
    """A third of the rows and more have key 0, some have none."""
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 97 != 0, F.col("id"))
    return spark.range(0, 20_000, 1, 8).select(key.alias("k"), "id")


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_a_hot_key_is_divided_and_no_row_is_lost(spark, small_partitions, how):
    told = rows(spark).filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    joined = join_hot(rows(spark), told, ["k"], how)
    got = joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.columns == (["k", "id", "n"] if how == "inner" else ["k", "id"])
    assert sorted(r.id for r in got) == [i for i in range(20_000) if i % 2 == 0 or i % 97 != 0]
    if how == "inner":
        assert all(r.n == (10_000 if r.k == 0 else 1) for r in got)


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k long, n long")
    assert join_hot(rows(spark), none, ["k"]).count() == 0
    assert join_hot(none, rows(spark), ["k"]).count() == 0


def test_addresses_are_not_broadcast_on_a_guess(spark):
    """Candidates and addresses grow with the catalog: neither passes the driver, however small the files they are read from."""
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    key = F.concat(F.lit("project:"), F.col("p_partkey").cast("string"))
    many = parts.select("*", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("rank"))
    candidates = many.select(key.alias("project_nid"), "rank", F.lit("u").alias("html_url"), F.col("p_name").alias("name"), F.col("p_name").alias("full_name"), F.lit("").alias("description"))
    matches = enrich.matched_projects(parts.select(key.alias("id"), F.col("p_name").alias("name")), candidates)
    nodes = parts.select(key.alias("id"), F.lit("Project").alias("label"), F.lit("{}").alias("props"))
    found = enrich.with_urls(nodes, matches)
    assert found.filter("props = '{\"github_url\":\"u\"}'").count() == parts.count()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_coverage_broadcasts_no_side_that_grows(spark):
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    matches = parts.select(F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_partkey") % 2 == 0, "u").alias("url"))
    nodes = parts.select(F.lit("f").alias("source_file"), F.col("p_partkey").cast("string").alias("id"), F.lit("Project").alias("label"))
    told, n = enrich.coverage(matches, nodes), parts.count()
    assert told.first() == (n, parts.filter("p_partkey % 2 = 0").count(), parts.filter("p_partkey % 2 = 0").count(), 1)
    assert "Broadcast" not in told._jdf.queryExecution().executedPlan().toString()
