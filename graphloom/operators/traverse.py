"""Questions to the graph: hops over typed edges, rankings, set comparisons.

Each hop keeps only the frontier's ids and is made distinct before the next
join, so nodes with very many edges are met by one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_hot

#: Speakers of a talk that are paired as one group.
BLOCK_SPEAKERS = 1000


def typed(edges: DataFrame, label: str, src: str, dst: str) -> DataFrame:
    """The edges of a type, with names for their ends."""
    return edges.filter(F.col("label") == label).select(F.col("src").alias(src), F.col("dst").alias(dst))


def talks_of(edges: DataFrame, speaker: str) -> DataFrame:
    """Talks of a speaker (1 hop)."""
    return typed(edges, "PRESENTED_BY", "talk", "speaker").filter(F.col("speaker") == speaker).select("talk").distinct()


def speakers_at(edges: DataFrame, event: str) -> DataFrame:
    """Speakers at an event (2 hops)."""
    talks = typed(edges, "PRESENTED_AT", "talk", "event").filter(F.col("event") == event).select("talk").distinct()
    return talks.join(typed(edges, "PRESENTED_BY", "talk", "speaker"), "talk").select("speaker").distinct()


def groups_of(edges: DataFrame, speakers: DataFrame) -> DataFrame:
    """(speaker, group) of the speakers in a seed table (3 hops each)."""
    talks = join_hot(typed(edges, "PRESENTED_BY", "talk", "speaker"), speakers.select("speaker").distinct(), ["speaker"], "left_semi")
    events = talks.join(typed(edges, "PRESENTED_AT", "talk", "event"), "talk").select("speaker", "event").distinct()
    return events.join(typed(edges, "PART_OF", "event", "group"), "event").select("speaker", "group").distinct()


def groups_of_all(edges: DataFrame, speakers: DataFrame) -> DataFrame:
    """The union of the seed speakers' groups."""
    return groups_of(edges, speakers).select("group").distinct()


def colleagues(edges: DataFrame, speakers: DataFrame) -> DataFrame:
    """(speaker, colleague) who work at a company of a seed speaker; nobody is their own colleague."""
    works = typed(edges, "WORKS_AT", "speaker", "company").distinct()
    own = join_hot(works, speakers.select("speaker").distinct(), ["speaker"], "left_semi")
    others = works.withColumnRenamed("speaker", "colleague")
    return own.join(others, "company").filter("colleague <> speaker").select("speaker", "colleague").distinct()


def employer_projects(edges: DataFrame, speakers: DataFrame) -> DataFrame:
    """(speaker, project) mentioned in talks of a seed speaker's colleagues (4 hops); colleagues are distinct before their talks are met."""
    found = colleagues(edges, speakers)
    talks = found.join(typed(edges, "PRESENTED_BY", "talk", "colleague"), "colleague").select("speaker", "talk").distinct()
    return talks.join(typed(edges, "MENTIONS", "talk", "project"), "talk").select("speaker", "project").distinct()


def presenter_pairs(edges: DataFrame) -> DataFrame:
    """(talk, a, b) of every two speakers a < b of a talk, each once.

    The speakers of a talk are dealt to blocks of about BLOCK_SPEAKERS, and every two
    blocks meet on their own, so the pairs of a talk of any size are made in many
    tasks, each block of two at most BLOCK_SPEAKERS squared.
    """
    members = typed(edges, "PRESENTED_BY", "talk", "speaker").distinct()
    # one talk in BLOCK_SPEAKERS edges at most
    large = members.groupBy("talk").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK_SPEAKERS)
    large = large.select("talk", F.ceil(F.col("n") / BLOCK_SPEAKERS).cast("int").alias("blocks"))
    dealt = join_hot(members, large, ["talk"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("speaker"), "blocks").cast("int"))
    first = dealt.select("talk", F.col("speaker").alias("a"), F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    second = dealt.select("talk", F.col("speaker").alias("b"), F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    met = first.join(second, ["talk", "i", "j"]).filter((F.col("i") < F.col("j")) & (F.col("a") != F.col("b")) | (F.col("a") < F.col("b")))
    return met.select("talk", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def co_presenters(edges: DataFrame) -> DataFrame:
    """Pairs (a < b) of speakers who share a talk, with the number of talks."""
    return presenter_pairs(edges).groupBy("a", "b").agg(F.count("*").alias("n_talks"))


def endpoint_kinds(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """How often each edge type joins which two labels."""
    kinds = nodes.select("id", F.col("label").alias("kind"))
    told = edges.join(kinds.withColumnsRenamed({"id": "src", "kind": "src_label"}), "src").join(
        kinds.withColumnsRenamed({"id": "dst", "kind": "dst_label"}), "dst"
    )
    return told.groupBy("label", "src_label", "dst_label").agg(F.count("*").alias("n"))


def talks_per_speaker(edges: DataFrame) -> DataFrame:
    return typed(edges, "PRESENTED_BY", "talk", "speaker").groupBy("speaker").agg(F.count_distinct("talk").alias("n_talks"))


def top_projects(edges: DataFrame, k: int = 10) -> DataFrame:
    """The projects with most mentions; ties by id."""
    counted = typed(edges, "MENTIONS", "talk", "project").groupBy("project").agg(F.count("*").alias("n_talks"))
    return counted.orderBy(F.desc("n_talks"), "project").limit(k)


def top_companies(edges: DataFrame, k: int = 10) -> DataFrame:
    """The companies with most distinct speakers; ties by id."""
    counted = typed(edges, "WORKS_AT", "speaker", "company").groupBy("company").agg(F.count_distinct("speaker").alias("n_speakers"))
    return counted.orderBy(F.desc("n_speakers"), "company").limit(k)


def first_by(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows by a key: a bounded run over an ordered table."""
    return rows.orderBy(key).limit(n)


def same_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many rows only one side holds (counting repeats), and whether that is none."""
    left = a.exceptAll(b).select(F.lit(1).alias("l"), F.lit(0).alias("r"))
    right = b.exceptAll(a).select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    told = left.unionByName(right).agg(F.coalesce(F.sum("l"), F.lit(0)).alias("only_left"), F.coalesce(F.sum("r"), F.lit(0)).alias("only_right"))
    return told.withColumn("same", F.col("only_left") + F.col("only_right") == 0)
