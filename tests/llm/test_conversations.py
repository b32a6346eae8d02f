import hashlib
import re
import zlib
from itertools import product

import numpy as np
import pytest

from graphloom.llm import conversations as C
from graphloom.llm.queries import queries

WHITE = "\x20\x09-\x0d"


def harmed(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        last = re.findall(f"[^{WHITE}]", text)[-1:]
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """All edits by least cost, then by initials: a search from the start, state by state, that keeps the best of each."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}  # role before -> cost, initials, repaired

    def better(new, state, told):
        if state not in new or told < new[state]:
            new[state] = told

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                role = "a" if state == "u" else "u"
                better(best, role, (cost + 3, audit + "I", (*out, ("user" if role == "u" else "assistant", ""))))
        return best

    best = inserted(best)
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        new = {}
        for state, (cost, audit, out) in best.items():
            better(new, state, (cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            if (state, role[:1]) in after:
                better(new, role[:1], (cost + extra, audit + "K", (*out, (role, text))))
            for fill in ("user", "assistant"):
                if (state, fill[0]) in after:
                    better(new, fill[0], (cost + extra + 3, audit + "R", (*out, (fill, text))))
        best = inserted(new)
    return min(v for k, v in best.items() if k in ("", "a"))


def wanted(table):
    """{conv: row} of the whole contract."""
    out = {}
    convs = {r[0] for r in table}
    rows = sorted(harmed(table), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    for conv in convs:
        own = [r for r in rows if r[0] == conv]
        turns = {r[1] for r in own} - {None}
        found = faults(own)
        firsts = [r[2][:1] for r in own]
        illegal = sum((a + b) not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        cost, audit, fixed = cheapest(own, found)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return out


def told(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def test_every_short_conversation():
    """All rows of up to four symbols, clean or not, against a search over all edits."""
    role = ["system", "user", "assistant", "tool"]
    for n in range(5):
        for symbols in product(range(9), repeat=n):
            rows = [(1, i, role[(s - 1) % 4] if s else "user", "x") for i, s in enumerate(symbols)]
            found = ["blank" if s == 0 else "truncated" if s > 4 else "" for s in symbols]
            codes = np.array([2 * 4 if s == 0 else (s - 1) % 4 + (4 if s > 4 else 0) for s in symbols], dtype=np.uint8)
            assert C.cheapest_edits(codes) == cheapest(rows, found)[:2], symbols


@pytest.mark.parametrize("seed", range(30))
def test_long_conversations(seed):
    rng = np.random.default_rng(seed)
    symbols = rng.integers(0, 9, int(rng.integers(5, 400)))
    role = ["system", "user", "assistant", "tool"]
    rows = [(1, i, role[(s - 1) % 4], "x") for i, s in enumerate(symbols)]
    found = ["blank" if s == 0 else "truncated" if s > 4 else "" for s in symbols]
    codes = np.array([8 if s == 0 else (s - 1) % 4 + (4 if s > 4 else 0) for s in symbols], dtype=np.uint8)
    assert C.cheapest_edits(codes) == cheapest(rows, found)[:2]


def test_vectors_are_few_and_blocks_are_steps():
    vectors, before, paid = C._steps()
    assert 0 in vectors[0] and len(vectors) < 100
    number, cost = C._blocks()
    for block in np.random.default_rng(1).integers(0, 10**C.BLOCK, 200):
        digits = [int(d) for d in f"{block:0{C.BLOCK}d}"]
        for v in range(len(vectors)):
            at, sum_ = v, 0
            for d in reversed(digits):
                at, sum_ = before[at, d], sum_ + paid[at, d]
            assert (number[v, block], cost[v, block]) == (at, sum_)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_the_contract(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries()["op13_conversations"](spark, f"/root/testdata/{sf}")) == wanted(table)


def test_odd_rows(spark):
    """Nulls in any column, repeated rows and turns, odd roles, white texts, other columns, a long conversation."""
    rng = np.random.default_rng(5)
    table = [
        (c, t, r, x)
        for c in (None, 1, 2, 3)
        for t in (None, 0, 1, 1, 5, 2**40)
        for r in (None, "", "user", "superuser", "assistant", "Ünder")
        for x in (None, "", " \x0b\t", "Ja. \n", "Nein", "a ", "?!", "x ")
        if rng.random() < 0.2
    ]
    table += [(7, int(t), ["user", "assistant", "system"][rng.integers(3)], f"text {rng.integers(300)}" + "." * int(rng.integers(2))) for t in rng.integers(0, 4000, 5000)]
    table += [(8, None, None, None)] * 40
    table += [(-1, 10**9 + i, "user", "é" * 50000 + ".") for i in range(3)]
    frame = spark.createDataFrame([(*r, 1, "c") for r in table], "conv_id long, turn long, role string, text string, audit int, code string").repartition(5)
    rows = C.damaged(frame)
    plans = C.repair_plans(rows)
    assert told(C.repair_digests(rows, plans)) == wanted(table)
    repaired = {}
    for r in C.repaired_rows(rows, plans).collect():
        repaired.setdefault(r.conv_id, {})[r.place] = f"{r.role}:{r.text}"
    for conv, row in wanted(table).items():
        own = repaired.get(conv, {})
        assert hashlib.sha256("\n".join(own[i] for i in range(len(own))).encode()).hexdigest() == row[-1]


def test_dropped_and_empty(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    kind = "conv_id long, turn long, role string, text string"
    rows = C.damaged(spark.createDataFrame([(5, dropped, "user", "Hm.")], kind))
    assert told(C.repair_digests(rows, C.repair_plans(rows))) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    rows = C.damaged(spark.createDataFrame([], kind))
    assert C.repair_digests(rows, C.repair_plans(rows)).count() == 0
