"""Conversations whose turns follow each other wrongly, and the cheapest edits that mend them.

A conversation is right if its role initials read `(s?(ua)+)?`. Each of its rows is
kept (0), given the role user or assistant (3) or deleted (4); an empty user or
assistant row can be inserted anywhere (3); a truncated row that stays costs 3 more;
blank and repeated rows must go.

The least costs still to pay, one per state of the pattern, change with each row in a
way that depends on the row's symbol alone (role and fault), and less their minimum
they take a few values only. So the change over every block of BLOCK symbols is
tabulated once for each of these vectors: a conversation is then read from its end in
blocks by lookup. The edits are traced from its start: inside a block the vectors are
expanded backward from the block's end, and of the edits that keep to the least cost
the one whose initial is ASCII-least is taken, which gives the ASCII-least string of
initials. An expanded block is remembered for its next use.

A task holds a byte per row of one conversation, as the row that tells its edits does;
texts and their digest are read as a stream, so a conversation may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

# What edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows that are looked up at once.
BLOCK = 4
#: White space, of which blank texts consist.
WHITE = " \t\n\x0b\x0c\r"

# States: nothing yet, after s, after u, after a. Roles: s, u, a, any other.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_ENDS = (START, AFTER_A)
#: The state after a row of a role, where the pattern allows it there.
_NEXT = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
#: The state after a row that was given, or inserted with, the role that fits.
_FILLED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
_ROLE_OF = {AFTER_U: "user", AFTER_A: "assistant"}

#: A row's code: 4 * fault + role, or DROPPED for a row that only names its conversation.
CLEAN, CUT, BLANK, REPEATED = range(4)
DROPPED = 16
#: Symbols: 0 must go, 1 + role clean, 5 + role truncated, NOTHING fills a last block.
NOTHING = 9
_SYMBOL = np.array([1, 2, 3, 4, 5, 6, 7, 8, 0, 0, 0, 0, 0, 0, 0, 0], dtype=np.uint8)

Vector = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Vector:
    """Costs still to pay when rows may be inserted first."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[_FILLED[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


_FAR = 1 << 20
_AT_END: Vector = _with_inserts([0 if q in _ENDS else _FAR for q in range(4)])


def _choices(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of a row, ASCII-least first; inserts are told apart from them."""
    yield "D", DELETE, state
    if symbol:
        role, extra = (symbol - 1) % 4, TRUNCATED if symbol > 4 else 0
        if (state, role) in _NEXT:
            yield "K", KEEP + extra, _NEXT[state, role]
        yield "R", REROLE + extra, _FILLED[state]


def _before(symbol: int, after: Vector) -> Vector:
    """The costs to pay before a row, given those after it."""
    if symbol == NOTHING:
        return after
    return _with_inserts([min(cost + after[to] for _, cost, to in _choices(symbol, q)) for q in range(4)])


@cache
def _steps() -> tuple[list[Vector], np.ndarray, np.ndarray]:
    """All vectors that can occur, less their minimum; for each and each symbol the number of the one before it, and the cost in between."""
    vectors, numbers = [_AT_END], {_AT_END: 0}
    before, paid = [], []
    for vector in vectors:  # grows meanwhile
        row = [_before(symbol, vector) for symbol in range(NOTHING + 1)]
        for costs in row:
            known = tuple(c - min(costs) for c in costs)
            if known not in numbers:
                numbers[known] = len(vectors)
                vectors.append(known)
        before.append([numbers[tuple(c - min(costs) for c in costs)] for costs in row])
        paid.append([min(costs) for costs in row])
    return vectors, np.array(before), np.array(paid)


@cache
def _blocks() -> tuple[np.ndarray, np.ndarray]:
    """For each vector and block (its symbols as digits, the first one highest): the vector before it, and the cost in between."""
    _, before, paid = _steps()
    base = NOTHING + 1
    number, cost = np.arange(len(before))[:, None], np.zeros((len(before), 1), dtype=np.int64)
    for _ in range(BLOCK):  # put a symbol in front of all blocks so far
        cost = np.concatenate([cost + paid[number, s] for s in range(base)], axis=1)
        number = np.concatenate([before[number, s] for s in range(base)], axis=1)
    return number, cost


@lru_cache(maxsize=1 << 16)
def _traced(block: int, vector: int, state: int) -> tuple[str, int]:
    """The initials of a block's edits and the state after it, for the vector after it and the state before it."""
    vectors, _, _ = _steps()
    symbols = [block // (NOTHING + 1) ** i % (NOTHING + 1) for i in reversed(range(BLOCK))]
    after = [vectors[vector]]
    for symbol in reversed(symbols):
        after.append(_before(symbol, after[-1]))
    after.reverse()
    told = []
    for i, symbol in enumerate(symbols):
        while symbol != NOTHING:
            left = after[i][state]
            best = next(((e, to) for e, cost, to in _choices(symbol, state) if e == "D" and cost + after[i + 1][to] == left), None)
            if best is None and INSERT + after[i][_FILLED[state]] == left:
                told.append("I")
                state = _FILLED[state]
                continue
            best = best or next((e, to) for e, cost, to in _choices(symbol, state) if cost + after[i + 1][to] == left)
            told.append(best[0])
            state = best[1]
            break
    return "".join(told), state


def cheapest_edits(codes: np.ndarray) -> tuple[int, str]:
    """(cost, initials) of the cheapest edits of a conversation's row codes; of equally cheap ones the ASCII-least."""
    symbols = np.full(-(-len(codes) // BLOCK) * BLOCK, NOTHING, dtype=np.int64)
    symbols[: len(codes)] = _SYMBOL[codes]
    blocks = symbols.reshape(-1, BLOCK) @ (NOTHING + 1) ** np.arange(BLOCK)[::-1]
    number, paid = _blocks()
    after = np.zeros(len(blocks), dtype=np.int64)  # the vector after each block
    vector = cost = 0
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = vector
        cost += paid[vector, blocks[i]]
        vector = number[vector, blocks[i]]
    told, state = [], START
    for block, vector_after in zip(blocks.tolist(), after.tolist(), strict=True):
        edits, state = _traced(block, vector_after, state)
        told.append(edits)
    while state not in _ENDS:
        told.append("I")
        state = _FILLED[state]
    return int(cost) + _steps()[0][int(vector)][START], "".join(told)


# --- in Spark -----------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped of conversations damaged by a hash of id and turn.

    Of 20 remainders 0 drops a row (it stays as `dropped`, so that its conversation
    does), 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it a
    user's. Nulls count as one space, but ids and turns stay null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), harm.alias("_harm"))
    text = F.when(F.col("_harm") == 1, "").when(F.col("_harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_harm") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    told = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("_harm") == 0).alias("dropped"), times.alias("_times"))
    return told.withColumn("_time", F.explode("_times")).drop("_times", "_time")


def _ordered(rows: DataFrame, before: str | None = None, after: str | None = None) -> DataFrame:
    """Whole conversations in tasks, their rows by turn, nulls first; rows of one turn by role and digest of the text."""
    keys = ["conv_id", before, F.asc_nulls_first("turn"), "role", "digest", after]
    return rows.sortWithinPartitions(*[k for k in keys if k is not None])


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256).alias("digest")


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLANS = f"conv_id {{0}}, {', '.join(f'{n} long' for n in NUMBERS)}, audit string"


def repair_plans(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps of its turns, rows by fault, adjacent roles that must not follow each other, and the cheapest edits with their cost.

    rows: conv_id, turn, role, text, and `dropped` for rows that only name their
    conversation. Each row's first fault counts: blank; repeated, if role and text
    were seen earlier; truncated, if its last character but white space is no
    sentence end. Rows of one turn are ordered by role and SHA-256 of the text; equal
    rows are alike. A null id is a conversation of its own; texts stay where they are,
    only their digests are exchanged. No rows: zeros and no edits.
    """
    end = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    initial = F.substring("role", 1, 1)
    told = rows.select(
        "conv_id", "turn", "role", _digest(), "dropped", (end == "").alias("_blank"), (~end.isin(".", "!", "?")).alias("_cut"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("_role"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.asc_nulls_first("turn")))
    fault = F.when(F.col("_blank"), BLANK).when(F.col("_place") > 1, REPEATED).when(F.col("_cut"), CUT).otherwise(CLEAN)
    code = F.when(F.col("dropped"), DROPPED).otherwise(fault * 4 + F.col("_role")).cast("byte")
    coded = told.repartition("conv_id").withColumn("_place", place)
    # of equal rows the first is the one that isn't repeated
    coded = _ordered(coded.select("conv_id", "turn", "role", "digest", code.alias("code")), after="code").select("conv_id", F.col("turn").cast("long"), "code")
    return coded.mapInArrow(_planned, _PLANS.format(rows.schema["conv_id"].dataType.simpleString()))


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ordered rows to plans; a conversation may go on over batches."""
    names = ["conv_id", *NUMBERS, "audit"]
    kind, now, codes, turns = None, None, None, None  # of the conversation being read: codes, and [least, greatest, number] of its turns

    def finished() -> tuple:
        had = np.frombuffer(bytes(codes), dtype=np.uint8)
        faults = np.bincount(had >> 2, minlength=4)
        role = had & 3
        legal = ((role[:-1] == 0) & (role[1:] == 1)) | ((role[:-1] == 1) & (role[1:] == 2)) | ((role[:-1] == 2) & (role[1:] == 1))
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        return now, gaps, faults[BLANK], faults[REPEATED], faults[CUT], np.count_nonzero(~legal), *cheapest_edits(had)

    def told(done: list[tuple]) -> pa.RecordBatch:
        kinds = (kind, *[pa.int64()] * 6, pa.string())
        columns = zip(*done, strict=True) if done else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        kind, done = batch.column(0).type, []
        for conv, turn, code in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if codes is None or conv != now:
                if codes is not None:
                    done.append(finished())
                now, codes, turns = conv, bytearray(), [0, 0, 0]
            if code == DROPPED:
                continue
            codes.append(code)
            if turn is not None and (not turns[2] or turn != turns[1]):
                turns = [turn if not turns[2] else turns[0], turn, turns[2] + 1]
        yield told(done)
    if codes is not None:
        yield told([finished()])


def _repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) after the edits."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = _NEXT[state, "sua".index(role[0])]
            yield role, text
        else:
            state = _FILLED[state]
            yield _ROLE_OF[state], text


def _with_plans(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows in order, before each conversation's rows one with its edits (`audit`) and the plan's numbers."""
    nothing, no_numbers = F.lit(None).cast("string"), F.lit(None).cast("array<long>")
    no_turn = F.lit(None).cast(rows.schema["turn"].dataType)
    heads = plans.select(
        "conv_id", F.lit(0).alias("kind"), no_turn.alias("turn"), *[nothing.alias(c) for c in ("role", "text", "digest")], "audit", F.array(*NUMBERS).alias("numbers")
    )
    bodies = rows.filter("NOT dropped").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", _digest(), nothing.alias("audit"), no_numbers.alias("numbers"))
    return _ordered(heads.unionByName(bodies).repartition("conv_id"), "kind").select("conv_id", "role", "text", "audit", "numbers")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[int], str, Iterator[tuple[str, str]]]]:
    """(conv_id, numbers, audit, repaired rows) of ordered rows; what is not read of one is passed over."""
    stream = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    ahead = next(stream, None)

    def own() -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and ahead[3] is None:
            row, ahead = ahead, next(stream, None)
            yield row[1], row[2]

    while ahead is not None:
        (conv, _, _, audit, numbers), ahead = ahead, next(stream, None)
        rows = own()
        yield conv, numbers, audit, _repaired(audit, rows)
        for _ in rows:
            pass


def _batched(rows: Iterator[tuple], names: tuple[str, ...], kinds: tuple[pa.DataType, ...]) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, 1024)):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=list(names))


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text of the repaired conversations. rows, plans: as for and from repair_plans()."""
    kind = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((conv, i, *row) for conv, _, _, own in _conversations(batches) for i, row in enumerate(own))
        return _batched(found, ("conv_id", "place", "role", "text"), (to_arrow_type(kind), pa.int64(), pa.string(), pa.string()))

    return _with_plans(rows, plans).mapInArrow(run, f"conv_id {kind.simpleString()}, place long, role string, text string")


def repair_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans with repaired_sha256: the digest of each repaired conversation, its rows as `role:text` joined by line ends, read as a stream."""
    kind = rows.schema["conv_id"].dataType
    names = ("conv_id", *NUMBERS, "audit", "repaired_sha256")

    def told(own: Iterator[tuple[str, str]]) -> str:
        digest = hashlib.sha256()
        for i, (role, text) in enumerate(own):
            digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
        return digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((conv, *numbers, audit, told(own)) for conv, numbers, audit, own in _conversations(batches))
        return _batched(found, names, (to_arrow_type(kind), *[pa.int64()] * len(NUMBERS), pa.string(), pa.string()))

    return _with_plans(rows, plans).mapInArrow(run, f"{_PLANS.format(kind.simpleString())}, repaired_sha256 string")
