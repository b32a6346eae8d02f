import pytest
from pyspark.sql import functions as F

from graphloom.llm import samples as S


@pytest.mark.parametrize("labels", [4000, 1])
def test_a_repeated_key_starves_nothing(spark, monkeypatch, labels):
    """As many keys as without repeats, whether bounds are broadcast or joined."""
    monkeypatch.setattr(S, "LABELS", labels)
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("label"))
    repeated = rows.unionByName(spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("label")))
    plain, many = (S.bounded_sample(r, "label", 500, 800).groupBy("label").count().collect() for r in (rows, repeated))
    for found in (plain, many):
        assert len(found) == 2 and all(320 <= r["count"] <= 480 for r in found)


def test_rows_of_a_key_count_once_and_nulls_are_keys(spark):
    rows = spark.createDataFrame([(None, "a")] * 50 + [(1, "a"), (2, "b"), (None, None)], "doc_id long, label string")
    assert sorted(S.bounded_sample(rows, "label", 10, 100).collect(), key=str) == sorted([(None, "a"), (1, "a"), (2, "b")], key=str)
    assert S.bounded_sample(rows.limit(0), "label", 10, 100).count() == 0


def test_more_labels_than_rows_wanted(spark, monkeypatch):
    monkeypatch.setattr(S, "LABELS", 10)
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2000).alias("label"))
    found = S.bounded_sample(rows, "label", 500, 1000)
    assert 800 <= found.count() <= 1200 and found.select("label").distinct().count() > 600
