import hashlib

import pytest

from graphloom.llm import sharding as H


def key(row):
    h = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    return (h(row[1]) if row[1] is not None else 0, h("" if row[0] is None else str(row[0])))


def plain(rows, shards):
    """Shard of each row by running bytes in key order."""
    size = lambda r: 16 + len((r[1] or "").encode())
    total, before, out = sum(map(size, rows)), 0, []
    for r in sorted(rows, key=key):
        out.append((r, min(shards - 1, int(before * shards / total))))
        before += size(r)
    return out


ROWS = [(i, f"text {i * 7919 % 1009} " * (i % 11 + 1)) for i in range(300)] + [(1000 + i, "one text that very many rows hold") for i in range(250)]
ROWS += [(None, None), (5000, None), (5001, ""), (None, "é" * 4000)]


@pytest.mark.parametrize("shards,cells", [(7, 4), (40, 1024)])
def test_equal_to_running_sums(spark, shards, cells):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' AS source", "1 AS _cell", "2 AS slot", "3 AS size")
    assert H.shard_documents(docs, 2).columns == ["doc_id", "text", "source", "_cell", "size", "shard", "slot"]
    got = H.shard_documents(docs, shards, cells=cells).collect()
    assert sorted((str(r.doc_id), str(r.text), r.shard) for r in got) == sorted((str(a), str(b), s) for (a, b), s in plain(ROWS, shards))
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_tolerance_bounds_the_sizes(spark):
    docs = spark.createDataFrame(ROWS[:550], "doc_id long, text string")
    got = H.shard_documents(docs, 5, tolerance=0.1).collect()
    sizes = [sum(16 + len(r.text.encode()) for r in got if r.shard == s) for s in range(5)]
    assert max(sizes) - min(sizes) < 0.25 * sum(sizes) / 5


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a")] * 6, "doc_id long, text string")
    got = H.shard_documents(docs, 4).collect()
    assert len(got) == 6 and len({r.shard for r in got}) == 1 and sorted(r.slot for r in got) == list(range(6))
    assert H.shard_documents(docs.limit(0), 4).count() == 0
