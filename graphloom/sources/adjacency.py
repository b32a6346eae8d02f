"""Edges stored for hops: per edge type one table bucketed by src and one by dst.

A hop joins a frontier of ids with the table bucketed by the end that it starts from.
The edges lie as the join needs them, so only the frontier is exchanged (or broadcast,
if Spark finds it small); the stored edges never are. Tables are Spark's own bucketed
tables under a folder; `open_adjacency` registers the tables of a folder in another session.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .tables import kept

#: Along an edge, from src to dst, or against it.
OUT, IN = "out", "in"
_END = {OUT: "src", IN: "dst"}


@dataclass(frozen=True)
class Adjacency:
    """Stored edges (src, dst) by type, in tables named after `name`."""

    spark: SparkSession
    folder: str
    name: str
    labels: tuple[str, ...]

    def table(self, label: str, direction: str) -> DataFrame:
        """(near, far) of a type's edges, bucketed by near."""
        near, far = (_END[direction], _END[IN if direction == OUT else OUT])
        return self.spark.table(_named(self.name, label, direction)).select(F.col(near).alias("near"), F.col(far).alias("far"))

    def hop(self, frontier: DataFrame, label: str, direction: str) -> DataFrame:
        """The frontier (id, and what each id came from) one hop on: each row once."""
        others = [c for c in frontier.columns if c != "id"]
        met = self.table(label, direction).join(frontier.withColumnRenamed("id", "near"), "near")
        return met.select(*others, F.col("far").alias("id")).distinct()

    def path(self, seeds: DataFrame, *steps: tuple[str, str]) -> DataFrame:
        """(seed, id): what is reached from each seed (id) by the steps (type, direction)."""
        frontier = seeds.select(F.col("id").alias("seed"), "id").distinct()
        for label, direction in steps:
            frontier = self.hop(frontier, label, direction)
        return frontier

    def within(self, seeds: DataFrame, labels: Iterable[str], depth: int) -> DataFrame:
        """(id, distance): all that is at most `depth` hops from the seeds (id), along edges of the types or against them.

        A loop over frontiers: each level's new ids are computed once, when this is called, and it ends with the first level without any.
        """
        seen = kept(seeds.select("id").distinct().withColumn("distance", F.lit(0)))
        frontier = seen
        for distance in range(1, depth + 1):
            ids = frontier.select("id")
            hops = [self.hop(ids, label, direction) for label in labels for direction in (OUT, IN)]
            met = hops[0]
            for h in hops[1:]:
                met = met.unionByName(h)
            frontier = kept(met.distinct().join(seen.select("id"), "id", "left_anti").withColumn("distance", F.lit(distance)))
            if frontier.isEmpty():
                break
            seen = seen.unionByName(frontier)
        return seen


def _named(name: str, label: str, direction: str) -> str:
    return f"`{name}_{label.lower()}_{direction}`"


def write_adjacency(edges: DataFrame, folder: str, name: str, buckets: int = 64, labels: tuple[str, ...] = schemas.EDGE_TYPES) -> Adjacency:
    """Store distinct edges for hops. buckets: at least as many as Spark's shuffle partitions, else Spark exchanges the edges after all."""
    rows = kept(edges.select("src", "dst", "label"))
    for label in labels:
        own = rows.filter(F.col("label") == label).select("src", "dst")
        for direction, end in _END.items():
            dealt = own.repartition(buckets, end)
            dealt.write.bucketBy(buckets, end).sortBy(end).option("path", f"{folder}/{label.lower()}_{direction}").saveAsTable(_named(name, label, direction))
    return Adjacency(rows.sparkSession, folder, name, labels)


def open_adjacency(spark: SparkSession, folder: str, name: str, buckets: int = 64, labels: tuple[str, ...] = schemas.EDGE_TYPES) -> Adjacency:
    """The stored edges of a folder, written with as many buckets, for a session that doesn't know their tables yet."""
    for label in labels:
        for direction, end in _END.items():
            place = f"{folder}/{label.lower()}_{direction}".replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {_named(name, label, direction)} (src STRING, dst STRING) USING parquet CLUSTERED BY ({end}) SORTED BY ({end}) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
    return Adjacency(spark, folder, name, labels)
