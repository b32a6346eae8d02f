"""The property graph: deduplication, merge, checks, counts and typed projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import int_prop, str_prop
from .joins import join_hot

#: Properties of each label as table columns: (property, column); columns of integers in INTEGERS.
PROJECTIONS = {
    "Talk": (("title", "title"), ("abstract", "abstract_text"), ("order", "talk_order")),
    "Event": (("id", "event_id"), *((p, p) for p in ("title", "date", "datetime", "url", "venue_name", "venue_address", "city"))),
    "Group": tuple((p, p) for p in ("slug", "name", "url")),
    "Speaker": tuple((p, p) for p in ("name", "bio", "company", "role")),
    "Project": (("name", "name"), ("github_url", "github_url")),
    "Company": (("name", "name"),),
}
INTEGERS = {"talk_order"}
_PLACE = ("source_file", "pos")


def first_nodes(nodes: DataFrame) -> DataFrame:
    """One node per id, the first by (source_file, pos). A hot id shrinks to a row per task before the shuffle."""
    return _one_node(nodes, F.min_by)


def last_nodes(nodes: DataFrame) -> DataFrame:
    """One node per id, the last by (source_file, pos)."""
    return _one_node(nodes, F.max_by)


def _one_node(nodes: DataFrame, choose) -> DataFrame:
    chosen = nodes.groupBy("id").agg(choose(F.struct("label", "props"), F.struct(*_PLACE)).alias("_n"))
    return chosen.select("id", "_n.label", "_n.props")


def distinct_edges(edges: DataFrame) -> DataFrame:
    """One edge per (src, label, dst), with the first bag by (source_file, pos) where these are given."""
    if not set(_PLACE) <= set(edges.columns):
        return edges.select("src", "dst", "label").distinct().withColumn("props", F.lit("{}"))
    return edges.groupBy("src", "dst", "label").agg(F.min_by("props", F.struct(*_PLACE)).alias("props"))


def known_kinds(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Rows whose label is of a closed set."""
    return rows.filter(F.col("label").isin(*kinds))


def is_safe_label(label: Column) -> Column:
    """An ASCII letter, then ASCII letters, digits or underscores."""
    return F.coalesce(label.rlike(r"\A[A-Za-z][A-Za-z0-9_]*\z"), F.lit(False))


def checked_labels(rows: DataFrame) -> DataFrame:
    """The rows; a row with an unsafe label fails the job when it is reached."""
    message = F.concat(F.lit("unsafe label: "), F.coalesce("label", F.lit("null")))
    return rows.withColumn("label", F.when(is_safe_label(F.col("label")), F.col("label")).otherwise(F.raise_error(message).cast("string")))


def joined_edges(edges: DataFrame, nodes: DataFrame, check_labels: bool = True) -> DataFrame:
    """Edges whose two ends exist; with check_labels, as nodes of the labels that the edge type joins."""
    if not check_labels:
        ids = nodes.select("id").distinct()
        begun = join_hot(edges, ids.select(F.col("id").alias("src")), ["src"], "left_semi")
        return join_hot(begun, ids.select(F.col("id").alias("dst")), ["dst"], "left_semi").select(edges.columns)
    pairs = [F.struct(F.lit(t).alias("type"), F.lit(a).alias("a"), F.lit(b).alias("b")) for t, (a, b) in schemas.ENDPOINTS.items()]
    wanted = F.filter(F.array(*pairs), lambda p: p["type"] == F.col("label"))
    told = edges.withColumn("_a", F.get(wanted, F.lit(0))["a"]).withColumn("_b", F.get(wanted, F.lit(0))["b"])
    sources = nodes.select(F.col("id").alias("src"), F.col("label").alias("_a")).distinct()
    targets = nodes.select(F.col("id").alias("dst"), F.col("label").alias("_b")).distinct()
    return join_hot(join_hot(told, sources, ["src", "_a"], "left_semi"), targets, ["dst", "_b"], "left_semi").select(edges.columns)


def stray_edges(nodes: Column, edges: Column) -> Column:
    """How many edge ends of a record are no node of the same record with the label that the edge type joins."""
    end = lambda e, side: F.coalesce(*[F.when(e["label"] == t, F.lit(ab[side])) for t, ab in schemas.ENDPOINTS.items()])
    pair = lambda id_, label: F.struct(id_.alias("id"), label.alias("label"))
    ends = F.flatten(F.transform(edges, lambda e: F.array(pair(e["src"], end(e, 0)), pair(e["dst"], end(e, 1)))))
    own = F.transform(nodes, lambda n: pair(n["id"], n["label"]))
    unknown = F.size(F.filter(ends, lambda p: p["id"].isNull() | p["label"].isNull()))
    return F.when(edges.isNull() | (F.size(edges) == 0), 0).otherwise(F.coalesce(F.size(F.array_except(ends, own)) + unknown, F.lit(1)))


def ids_of_many_labels(nodes: DataFrame) -> DataFrame:
    """Ids that stand beside more than one label, or one that is not in schemas.NODE_LABELS."""
    bits = [F.when(F.col("label") == k, F.lit(1 << i).cast("long")) for i, k in enumerate(schemas.NODE_LABELS)]
    other = F.lit(3 << len(bits)).cast("long")  # counts as two
    return nodes.groupBy("id").agg(F.bit_or(F.coalesce(*bits, other)).alias("_labels")).filter(F.bit_count("_labels") > 1).select("id")


def merge_nodes(old: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """The old graph's nodes with new ones merged in, one row per id on either side.

    New properties override, absent ones stay, and a null removes a property; with
    replace, a new node's bag replaces the old one whole.
    """
    a = old.select("id", F.col("label").alias("_la"), F.col("props").alias("_pa"))
    b = new.select("id", F.col("label").alias("_lb"), F.col("props").alias("_pb"))
    both = a.join(b, "id", "full_outer")
    if replace:
        return both.select("id", F.coalesce("_lb", "_la").alias("label"), F.coalesce("_pb", "_pa").alias("props"))
    bags = [F.from_json(F.coalesce(p, F.lit("{}")), "map<string,variant>") for p in ("_pa", "_pb")]
    told = both.withColumn("_ma", bags[0]).withColumn("_mb", bags[1])
    kept = F.map_filter("_ma", lambda k, v: ~F.map_contains_key(F.col("_mb"), k))
    present = lambda k, v: v.isNotNull() & ~F.is_variant_null(v)
    merged = F.map_filter(F.map_concat(kept, "_mb"), present)
    ordered = F.map_from_entries(F.array_sort(F.map_entries(merged), _by_key))
    return told.select("id", F.coalesce("_lb", "_la").alias("label"), F.to_json(ordered).alias("props"))


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)


def merge_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """The edges of both sides, each (src, label, dst) once; a new bag replaces an old one."""
    told = old.select("src", "dst", "label", "props", F.lit(0).alias("_new")).unionByName(new.select("src", "dst", "label", "props", F.lit(1).alias("_new")))
    return told.groupBy("src", "dst", "label").agg(F.max_by("props", "_new").alias("props"))


def label_counts(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """(label, n) for each kind, 0 where there is none: one pass for all labels."""
    listed = rows.sparkSession.createDataFrame([(k,) for k in kinds], "label string")
    counted = rows.groupBy("label").agg(F.count("*").alias("n"))
    return listed.join(counted, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: unique nodes and kinds, unique edges and kinds. Duplicates are cut before they are counted."""
    return summary_of_things(nodes.select(F.lit(None).cast("string").alias("src"), F.col("id").alias("dst"), "label").unionByName(edges.select("src", "dst", "label")))


def summary_of_things(things: DataFrame) -> DataFrame:
    """summary() of nodes and edges in one table (src, dst, label), where a node has no src: both come from one reading of their records."""
    one, is_node = things.distinct(), F.col("src").isNull()
    by_label = one.groupBy("label", is_node.alias("is_node")).agg(F.count("*").alias("n"))
    kinds = by_label.agg(
        F.count_distinct(F.when(F.col("is_node"), F.col("label"))).alias("n_node_kinds"),
        F.coalesce(F.sum(F.when(~F.col("is_node"), F.col("n"))), F.lit(0)).alias("n_edges"),
        F.count_distinct(F.when(~F.col("is_node"), F.col("label"))).alias("n_edge_kinds"),
    )
    return one_row(one.filter(is_node).agg(F.count_distinct("dst").alias("n_nodes")), kinds)


def one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row tables side by side."""
    return a.unionByName(b, allowMissingColumns=True).agg(*[F.first(c, ignorenulls=True).alias(c) for c in (*a.columns, *b.columns)])


def typed_nodes(nodes: DataFrame, label: str) -> DataFrame:
    """A label's nodes with its properties as columns: absent strings are "", absent integers 0. Unknown labels have nid only."""
    columns = [
        (int_prop if column in INTEGERS else str_prop)(F.col("props"), prop).alias(column) for prop, column in PROJECTIONS.get(label, ())
    ]
    return nodes.filter(F.col("label") == label).select(F.col("id").alias("nid"), *columns)


def node_by_id(nodes: DataFrame, id_: str) -> DataFrame:
    return nodes.filter(F.col("id") == id_)


def one_venue_violations(edges: DataFrame) -> DataFrame:
    """Talks that do not have exactly one PRESENTED_AT edge, among talks that have any edge."""
    at = F.count_if(F.col("label") == "PRESENTED_AT")
    talks = edges.filter(F.col("label").isin("PRESENTED_AT", "PRESENTED_BY", "MENTIONS"))
    return talks.groupBy(F.col("src").alias("talk")).agg(at.alias("n")).filter("n <> 1")


def coherence(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of booleans: talks imply events, groups and speakers; projects imply mentions; projects and companies have names."""
    kinds = {k: F.count_if(F.col("label") == k) > 0 for k in schemas.NODE_LABELS}
    named = lambda k: F.count_if((F.col("label") == k) & (str_prop(F.col("props"), "name") == "")) == 0
    seen = nodes.agg(
        *[c.alias(k) for k, c in kinds.items()], named("Project").alias("projects_named"), named("Company").alias("companies_named")
    )
    mentions = edges.agg((F.count_if(F.col("label") == "MENTIONS") > 0).alias("mentions"))
    implies = lambda k: (~F.col("Talk") | F.col(k))
    return one_row(seen, mentions).select(
        implies("Event").alias("talks_have_events"),
        implies("Group").alias("talks_have_groups"),
        implies("Speaker").alias("talks_have_speakers"),
        (~F.col("Project") | F.col("mentions")).alias("projects_are_mentioned"),
        "projects_named",
        "companies_named",
    )
