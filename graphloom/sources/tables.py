"""Graph tables and talk records on disk."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

if TYPE_CHECKING:
    from .keyed import KeyedTable


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str, clear: bool = True) -> None:
    """Deduplicated nodes, then edges, as Parquet by label. clear replaces what is there; else the folder must be new.

    A label's files, read by name, hold nodes in the order of ids and edges in that of
    src and dst: both are dealt by ranges and sorted in each, never in one task.

    To add to a stored graph, use merge_into_graph(): a table is never rewritten while it is read.
    """
    mode = "overwrite" if clear else "errorifexists"
    for rows, columns, order, name in ((nodes, ["id", "label", "props"], ["label", "id"], "nodes"), (edges, ["src", "dst", "label", "props"], ["label", "src", "dst"], "edges")):
        ranged = rows.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.write.mode(mode).partitionBy("label").parquet(f"{folder}/{name}")


def read_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a written graph."""
    nodes = spark.read.schema(schemas.NODES).parquet(f"{folder}/nodes")
    edges = spark.read.schema(schemas.EDGES).parquet(f"{folder}/edges")
    return nodes.select("id", "label", "props"), edges.select("src", "dst", "label", "props")


def in_file_order(rows: DataFrame) -> DataFrame:
    """Rows of a written Parquet table with `place`: their number, from 0, in the label's files as these follow by name."""
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    placed = rows.select("*", name.alias("_file"), row.alias("_row"))
    # a file's rows are counted, not numbered again: only one row a file is sorted
    files = placed.groupBy("label", "_file").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("label").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("label", "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, ["label", "_file"]).withColumn("place", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, set for this context if it isn't yet.

    Only a local master gets a new temporary folder where the setting is absent; on a
    cluster, whose executors don't see each other's disks, that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir", None)
        if folder is None and context.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def kept(frame: DataFrame) -> DataFrame:
    """The frame, computed now and once: a checkpoint in the shared folder, which outlives lost executors.

    spark.cleaner.referenceTracking.cleanCheckpoints deletes it when the driver no longer refers to it.
    """
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


@contextmanager
def exchanges_deleted(spark: SparkSession) -> Iterator[None]:
    """What runs in this block exchanges is deleted at each run's end, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(frame: DataFrame, path: str | None = None, by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """The frame, computed now and once, as a well compressed table in the shared folder, and its path, for forget().

    For wide rows: checkpoints aren't compressed. A given path's table is added to.
    """
    spark = frame.sparkSession
    path = path or f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with exchanges_deleted(spark):
        frame.select("*").write.mode("append").partitionBy(*by).parquet(path, compression="zstd")
    return spark.read.schema(frame.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a stored table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def last_records(records: DataFrame) -> DataFrame:
    """One record per id: that of the last run_ts, then source_file; a later write replaces an earlier one."""
    others = [c for c in records.columns if c != "id"]
    last = records.groupBy("id").agg(F.max_by(F.struct(*others), F.struct("scraped_at", "source_file")).alias("_r"))
    return last.select("id", "_r.*").select(records.columns)


def record_table(spark: SparkSession, folder: str, buckets: int = 64, schema: str | T.StructType = schemas.STORED_RECORD) -> KeyedTable:
    """The stored talk records of a folder, by id, as compressed JSON lines."""
    from .keyed import KeyedTable

    return KeyedTable(spark, folder, ("id",), schema, buckets, "json")


def write_records(records: DataFrame, folder: str, dry_run: bool = False) -> DataFrame:
    """The records to keep, one per id, added to the folder's records unless dry_run: each replaces that of its id, all others stay."""
    if not dry_run:
        record_table(records.sparkSession, folder, schema=records.schema).upsert(records, last=("scraped_at", "source_file"))
    return last_records(records)


def rewrite_records(spark: SparkSession, folder: str, matches: DataFrame) -> DataFrame:
    """Give the folder's records the found addresses (operators.enrich.enriched_records); the changed ones, which alone are merged in.

    Records are read some buckets at a time. The changed ones are stored in the shared folder.
    """
    from ..operators.enrich import enriched_records

    table = record_table(spark, folder)
    found, path = stored(matches.filter("url IS NOT NULL").select("id", "url"))
    try:
        changed = table.told(lambda rows: enriched_records(rows, found))
    finally:
        forget(spark, path)
    table.upsert(changed)
    return changed


def graph_tables(spark: SparkSession, folder: str, buckets: int = 64) -> tuple[KeyedTable, KeyedTable]:
    """The stored nodes and edges of a folder that are merged into: by id, and by src, label and dst."""
    from .keyed import KeyedTable

    return (
        KeyedTable(spark, f"{folder}/nodes", ("id",), schemas.NODES, buckets),
        KeyedTable(spark, f"{folder}/edges", ("src", "label", "dst"), schemas.EDGES, buckets),
    )


def merge_into_graph(nodes: DataFrame, edges: DataFrame, folder: str, replace: bool = False, buckets: int = 64) -> tuple[int, int]:
    """Merge deduplicated nodes, then edges, into a stored graph (operators.graph.merge_nodes, merge_edges); the new versions.

    Only the buckets that new rows fall into are rewritten, files in the order of ids
    (nodes) and of ends (edges). Nodes come first, so edges never wait for their ends.
    """
    from ..operators.graph import merge_edges, merge_nodes

    stored_nodes, stored_edges = graph_tables(nodes.sparkSession, folder, buckets)
    at = stored_nodes.upsert(nodes, lambda old, new: merge_nodes(old, new, replace), ("id",))
    return at, stored_edges.upsert(edges, merge_edges, ("label", "src", "dst"))
