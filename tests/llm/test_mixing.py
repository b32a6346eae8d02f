import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from graphloom.llm import mixing as M


def plain_targets(sizes):
    """sizes by source in order; the contract's sharing in exact fractions."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    capped, total = set(), sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(3 * sizes[i] for i in capped)
        share = {i: Fraction(rest * weights[i], sum(weights[j] for j in free)) for i in free}
        over = {i for i in free if share[i] > 3 * sizes[i]}
        if not over:
            return [3 * sizes[i] if i in capped else share[i] for i in range(len(sizes))]
        capped |= over


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        source = ["big", "zed", None, "a", "Ü", "tiny", "mid"][0 if i % 3 == 0 else int(rng.integers(1, 7))]
        words = " ".join(f"w{j}" for j in range(int(rng.integers(0, 9 if source == "tiny" else 90))))
        rows.append((i, words, source, len(words)))
    return rows + [(7, None, "big", None), (None, "three more words", None, 16), (3, rows[3][1], rows[3][2], rows[3][3])]


@pytest.mark.parametrize("block,cells", [(1, 4), (16, 3), (512, 1024)])
def test_targets_and_taken(spark, table, block, cells):
    docs = documents(spark, table)
    got = M.mix_documents(docs, block, cells).collect()
    again = M.mix_documents(docs.repartition(5), block, cells).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(table)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({r[2] for r in table} - {None}, key=lambda s: s.encode()) + [None]
    sizes = [sum(size(r[1]) for r in table if r[2] == s) for s in names]
    targets = dict(zip(names, plain_targets(sizes)))
    for s, n in zip(names, sizes):
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {n}
        assert all(abs(r.target - float(targets[s])) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - float(targets[s])) <= 1
        assert all(r.taken <= 3 * r.size for r in mine)


def test_schedule_is_spread_evenly(spark, table):
    docs = documents(spark, table)
    _, _, slots = M.mix_plan(docs, 4, 8)
    rows = sorted(slots.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert [r["rank"] for r in mine] == list(range(len(mine)))
        for r in mine:  # at every point the source has had its share so far, within a few slots
            assert abs(r["rank"] - len(mine) * r.slot / len(rows)) < 4


def test_mixed_documents(spark, table):
    docs = documents(spark, table)
    taken = {}
    for r in M.mix_documents(docs, 16, 4).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    clash = docs.selectExpr("*", "1 AS _size", "2 AS taken", "3 AS position", "4 AS size")
    out = M.mixed_documents(clash, 16, 4)
    assert out.columns == clash.columns and {(r._size, r.taken, r.position, r.size) for r in out.collect()} == {(1, 2, 3, 4)}
    out = M.mixed_documents(docs, 16, 4)
    assert out.schema.names == docs.schema.names
    rows, whole, uses = out.collect(), Counter(), Counter()
    for r in table:
        whole[r] += 1
    for r in rows:
        assert tuple(r) in whole  # documents stay whole
        uses[tuple(r)] += 1
    assert all(n <= 3 * whole[r] for r, n in uses.items())
    words, longest = {}, {}
    for r in rows:
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
        longest[r.source] = max(longest.get(r.source, 0), len(r.text.split()))
    assert words.keys() == {s for s, n in taken.items() if n}
    assert all(abs(n - taken[s]) <= longest[s] / 2 for s, n in words.items())
    # the schedule's order: every prefix is near the shares
    total, seen, done = sum(words.values()), Counter(), 0
    for r in rows:
        seen[r.source] += len(r.text.split())
        done += len(r.text.split())
        assert all(abs(seen[s] - done * n / total) <= 3 * max(longest.values()) for s, n in words.items())


def test_first_slots_and_their_number(spark, table):
    docs = documents(spark, table)
    documents_, pieces, slots = (f.collect() for f in M.mix_plan(docs, 16, 4))
    wanted = Counter()
    for d in documents_:
        met = []
        for s in slots:
            begin, end = s.block * 16, s.block * 16 + s.words
            if s.position == d.position and max(d.start, begin) < min(d.start + d["size"], end):
                met.append((s.slot, min(d.start + d["size"], end) - max(d.start, begin)))
        wanted[str(d.doc_id), d["size"], sum(n for _, n in met), min((s for s, _ in met), default=None), len(met)] += 1
    got = Counter((str(r.doc_id), r["size"], r.taken, r.first_slot, r.slots) for r in M.mix_documents(docs, 16, 4).collect())
    assert got == wanted


def test_odd_tables(spark, table):
    docs = documents(spark, table)
    assert M.mixed_documents(docs.limit(0)).count() == 0
    assert M.mix_documents(docs.filter("text is null")).collect()[0].taken == 0
