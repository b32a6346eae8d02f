"""The register of queries, and SQL that several of their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_TS, DEFAULT_DATE = "2024-01-01T00:00:00Z", "2024-01-01"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


# --- SQL that several oracles share ----------------------------------------------

EDGES = """edges AS (SELECT DISTINCT * FROM (
  SELECT 'talk:' || o_orderkey AS src, 'event:' || o_custkey AS dst, 'PRESENTED_AT' AS label FROM orders
  UNION ALL SELECT 'event:' || c_custkey, 'group:' || c_nationkey, 'PART_OF' FROM customer
  UNION ALL SELECT 'talk:' || l_orderkey, 'speaker:' || l_suppkey, 'PRESENTED_BY' FROM lineitem
  UNION ALL SELECT 'speaker:' || s_suppkey, 'company:' || s_nationkey, 'WORKS_AT' FROM supplier
  UNION ALL SELECT 'talk:' || l_orderkey, 'project:' || l_partkey, 'MENTIONS' FROM lineitem))"""
NODES = """nodes AS (
  SELECT 'talk:' || o_orderkey AS id, 'Talk' AS label, NULL AS name FROM orders
  UNION ALL SELECT 'event:' || c_custkey, 'Event', c_name FROM customer
  UNION ALL SELECT 'group:' || n_nationkey, 'Group', n_name FROM nation
  UNION ALL SELECT 'speaker:' || s_suppkey, 'Speaker', s_name FROM supplier
  UNION ALL SELECT 'company:' || n_nationkey, 'Company', n_name FROM nation
  UNION ALL SELECT 'project:' || p_partkey, 'Project', p_name FROM part)"""
ROWS = """rows AS (SELECT *, printf('%012d-%04d-%09d-%09d', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey)"""


def slug(text: str, cap: int = 60) -> str:
    whole = f"rtrim(substr(trim(regexp_replace(lower({text}), '[^a-z0-9]+', '-', 'g'), '-'), 1, 60), '-')"
    return whole if cap >= 60 else f"rtrim(substr({whole}, 1, {cap}), '-')"


def normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[^a-z0-9]+', '-', 'g'), '-')"


def trimmed(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def plain(text: str, *steps: tuple[str, str]) -> str:
    for pattern, new in steps:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return trimmed(text)


LINKS = ((r"\[([^\]]+)\]\([^)]+\)", r"\1"), (r"\*{1,3}([^*]+)\*{1,3}", r"\1"))
TO_TEXT = (*LINKS, (r"(?m)^#{1,6}\s+", ""), (r"(?m)^[*\-•]\s+", ""), (r"\\(.)", r"\1"), (r"\n{3,}", "\n\n"))
INITCAP = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
SPELLED = "translate({0}::VARCHAR, '0123456789', 'abcdefghij')"


def cap(text: str) -> str:
    return f"upper(({text})[1]) || ({text})[2:]"


LOTS = f"""lots AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    'Ann ' || {cap(SPELLED.format("l_suppkey"))} || 'son' AS person, {cap(SPELLED.format("s_nationkey"))} || 'corp' AS company,
    'Shipping ' || {INITCAP.format("p_name")} || ' By Lot ' || {cap(SPELLED.format("l_linenumber"))} AS title,
    count(*) OVER (PARTITION BY l_orderkey) AS n_lines,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS talk_order
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""
TALKS = f"""{LOTS},
talks AS (SELECT *, o_orderdate::DATE + 1 AS day FROM lots JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  WHERE l_orderkey % 5 <> 1 OR n_lines > 1)"""
TALK_ID = f"'talk-' || strftime(day, '%Y%m%d') || '-' || {slug('title', 45)} || '-' || {slug('person', 30)}"
