"""Checkpoints and session settings that several operators need."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, set for this context if it isn't yet.

    Only a local master, where driver and tasks share their disk, gets a new
    temporary folder if the setting is absent; elsewhere that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


#: Rows of ids and numbers that one checkpoint file should hold at least.
FILE_ROWS = 1 << 16


def checkpointed(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """The frame, computed once and kept in the checkpoint folder, so that it outlives lost executors.

    rows is about how many rows of ids and numbers the frame has, or a bound of it,
    where that is known: they go to as many files as hold FILE_ROWS each. Otherwise each
    partition, also an empty one, makes a file and its checksum, for both of which a
    local file system without native code starts processes from the executor. The
    estimate moves no row out or in, and files grow in number with it.

    With spark.cleaner.referenceTracking.cleanCheckpoints its files go when the
    driver no longer refers to it.
    """
    checkpoint_folder(frame.sparkSession)
    if rows is not None:
        frame = frame.coalesce(max(1, -(-rows // FILE_ROWS)))
    return frame.checkpoint(eager=True)


def stored(frame: DataFrame, codec: str | None = None) -> tuple[DataFrame, str]:
    """The frame as a Parquet table in the checkpoint folder, read back, and the table's path, for forget()."""
    spark = frame.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path, compression=codec)
    return spark.read.parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a stored table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _deleting_exchanges(spark: SparkSession) -> Iterator[None]:
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


def settled(frame: DataFrame) -> DataFrame:
    """As checkpointed; what the frame's own run has exchanged is deleted at its end, not when the driver next collects its garbage."""
    with _deleting_exchanges(frame.sparkSession):
        return checkpointed(frame.select("*"))


def packed(frame: DataFrame) -> DataFrame:
    """As settled, but stored as a well compressed table, for what is large; the table stays."""
    with _deleting_exchanges(frame.sparkSession):
        return stored(frame.select("*"), "zstd")[0]


#: Bytes of rows that go to a Python worker at once; long texts count, not rows.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches in this session, unless they are bounded lower already.

    A batch stands in the JVM, in Arrow and in the worker at the same time, for
    each task of an executor. Spark has this bound for a session only, so it holds
    for later queries too; no result depends on it. Operators leave it alone: only
    the registered queries and the pipeline call this.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "64MB").lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    size = int(now[:-1]) * units[now[-1]] if now[-1:] in units else int(now)
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def not_broadcast(frame: DataFrame) -> DataFrame:
    """The frame, to be joined by shuffle and merge.

    Sizes after Python code and generators are guessed from what went in, often
    far too small; a side that grows with the input must not be broadcast on such a
    guess.
    """
    return frame.hint("merge")


#: Columns of documents that operators read or change.
CORE = ("doc_id", "text", "lang", "source", "n_chars")


def on_core(docs: DataFrame, operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """operate(docs), with all columns but CORE packed away meanwhile, so that no name of theirs can clash."""
    others = [c for c in docs.columns if c not in CORE]
    if not others:
        return operate(docs)
    packed = docs.select(*[c for c in docs.columns if c in CORE], F.struct(*[F.col(f"`{c}`") for c in others]).alias("_others"))
    done = operate(packed)
    return done.select(*[F.col(c) if c in CORE else F.col("_others")[c].alias(c) for c in docs.columns])
