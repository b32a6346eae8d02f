"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of equal-token slots. Slot i belongs to the source into
whose share of [0, 1) the i-th golden-ratio point falls, so any stretch of the
schedule is close to the shares. A source's documents are shuffled by a hash
and laid end to end; the slots of a source, ranked, take its equal-token blocks
one after the other, and begin anew when the source is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import cell_of, hash60, running_start
from .session import checkpointed, not_broadcast, on_core

#: Fixed by the contract: weights in turn over the sources by code point, and the largest reuse.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Words of a slot.
BLOCK_WORDS = 512
#: Slots ranked in one task's group.
SLOT_RUN = 65_536
CELLS = 1024
_WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_table(sized: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per source: source_size and weight; weights follow the sources' code points, null last.

    The rank is a row number over distinct sources only, cut into ranges, so it
    does not meet in one task. rows: a bound of how many sources there are, if known.
    """
    sizes = checkpointed(sized.groupBy("source").agg(F.sum("size").alias("source_size")), rows)
    ranged = checkpointed(
        sizes.repartitionByRange(F.asc_nulls_last("source"))
        .withColumn("_part", F.spark_partition_id()),
        sizes.count(),
    )
    parts = ranged.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.asc_nulls_last("source")))
    position = F.col("_start") + F.col("_rank") - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (position % len(WEIGHTS)).cast("int") + 1)
    return (
        ranged.withColumn("_rank", within)
        .join(starts, "_part")
        .select("source", "source_size", position.alias("position"), weight.cast("long").alias("weight"))
    )


def with_targets(sources: DataFrame, most_times: int = MOST_TIMES) -> DataFrame:
    """Add `target`: shares of all words by weight, at most most_times the source's size.

    Each round gives the capped sources their cap and shares the rest among the
    others by weight, until no source is above its cap. A round adds up two
    numbers, so sources never gather.
    """
    cap = F.col("source_size") * F.lit(most_times)
    level, capped = None, F.lit(False)
    while True:
        left = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(capped, cap)).alias("fixed"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
            F.count(F.when(capped, 1)).alias("n_capped"),
        ).first()
        rest, weight = (left["all"] or 0) - (left["fixed"] or 0), left["weight"] or 0
        new_level = rest / weight if weight else None
        if new_level is None or new_level == level:
            break
        level = new_level
        capped = F.col("weight") * F.lit(level) >= cap
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(share))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix's slots: slot (its place in the mix), source, position, rank, use, block, words.

    A source has as many slots as blocks that hold its target: all its blocks for
    each whole use, then as many as the remainder needs, the last one cut to it.
    The points are the golden-ratio lattice i * g mod n, with g next to n / phi and
    coprime to n, so a source whose share of [0, n) is as long as its slots gets
    exactly that many. Shares are cut into runs before they are expanded, so a
    source of any size spreads over tasks.
    """
    per_use = F.ceil(F.col("source_size") / F.lit(float(block_words))).cast("long")
    whole = F.floor("target").cast("long")
    told = (
        sources.filter("source_size > 0")
        .withColumn("_whole", whole)
        .withColumn("_per_use", per_use)
        .withColumn("_rest", F.col("_whole") % F.col("source_size"))
        .withColumn(
            "_slots",
            F.floor(F.col("_whole") / F.col("source_size")).cast("long") * F.col("_per_use")
            + F.ceil(F.col("_rest") / F.lit(float(block_words))).cast("long"),
        )
        .filter("_slots > 0")
    )
    told = told.withColumn("_cell", (F.col("position") / 65_536).cast("int"))
    n_sources = sources.count()
    told = running_start(told.withColumn("_all", F.lit(0)), ["_all"], ["position"], F.col("_slots"), "_begin", "_cell")
    told = checkpointed(told, n_sources)
    n = told.agg(F.sum("_slots")).first()[0] or 1
    back = pow(_golden_step(n), -1, n) if n > 1 else 0
    runs = told.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1, F.lit(SLOT_RUN).cast("long"))).alias("_from"))
    runs = runs.repartition(F.col("position"), F.col("_from"))
    points = runs.select(
        "*", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + SLOT_RUN, F.col("_slots")) - 1)).alias("_point")
    )
    place = ((F.col("_begin") + F.col("_point")).cast("decimal(19,0)") * F.lit(back).cast("decimal(19,0)")) % F.lit(n).cast("decimal(19,0)")
    placed = points.withColumn("slot", place.cast("long")).withColumn("_cell", F.floor(F.col("slot") / F.lit(max(n / CELLS, 1.0))).cast("int"))
    ranked = running_start(
        placed.select("source", "position", "source_size", "slot", "_cell", "_whole", "_per_use", "_slots"),
        ["position"], ["slot"], F.lit(1).cast("long"), "rank", "_cell",
    )
    block = F.col("rank") % F.col("_per_use")
    length = F.least(F.lit(block_words).cast("long"), F.col("source_size") - block * block_words)
    rest = F.col("_whole") % F.col("source_size")
    cut = F.when(F.col("rank") == F.col("_slots") - 1, F.when(rest > 0, rest - block * block_words).otherwise(length)).otherwise(length)
    use = F.floor(F.col("rank") / F.col("_per_use")).cast("int")
    return ranked.select("slot", "source", "position", "rank", use.alias("use"), block.alias("block"), cut.alias("words"))


def _golden_step(n: int) -> int:
    """The first step from n / phi on that is coprime to n."""
    step = max(1, round(n * (5**0.5 - 1) / 2))
    while math.gcd(step, n) != 1:
        step += 1
    return step % n or 1


def mix_plan(docs: DataFrame, block_words: int = BLOCK_WORDS, cells: int = CELLS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, pieces, slots) of the mix of all rows.

    documents: doc_id, source, size, source_size, target, position, start (the
    place of the row's first word in its source). pieces: doc_id, position, start,
    size, block, from_word and to_word in the row, words_in_block (where the piece
    begins in its block). slots: as schedule() gives them.

    A null source is a source, after all others; a null text has no word; rows
    without words and sources without words take part with target and share 0.
    """
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    sized = sized.withColumn("_h", hash60(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    sized = checkpointed(sized)
    n, n_words = sized.agg(F.count("*"), F.sum("size")).first()
    sources = checkpointed(with_targets(source_table(sized, n)), n)
    # each use of a source, MOST_TIMES and a part of one at most, can end in a slot that isn't full
    slots = checkpointed(schedule(sources, block_words), (n_words or 0) // block_words + (MOST_TIMES + 1) * sources.count())
    placed = running_start(
        sized.withColumn("_cell", cell_of(F.col("_h"), cells)), ["source"], ["_h", "size"], F.col("size"), "start", "_cell"
    ).drop("_cell", "_h")
    told = sources.select(F.col("source").alias("_source"), "source_size", "target", "position")
    documents = checkpointed(placed.join(told, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), n)
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = (
        documents.filter("size > 0")
        .select("doc_id", "position", "start", "size", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("block"))
        .select(
            "doc_id",
            "position",
            "start",
            "size",
            "block",
            F.greatest(F.lit(0).cast("long"), F.col("block") * block_words - F.col("start")).alias("from_word"),
            F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("start")).alias("to_word"),
        )
        .withColumn("words_in_block", F.col("start") + F.col("from_word") - F.col("block") * block_words)
    )
    return documents, pieces, slots


def _taken_pieces(pieces: DataFrame, slots: DataFrame) -> DataFrame:
    """Each piece in each slot that takes words of it: the piece, slot, use, and `used` words."""
    used = F.least(F.col("to_word") - F.col("from_word"), F.col("words") - F.col("words_in_block"))
    met = pieces.join(not_broadcast(slots.select("position", "block", "slot", "use", "words")), ["position", "block"])
    return met.withColumn("used", used).filter("used > 0")


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, cells: int = CELLS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words the mix takes, repeats counted), first_slot, slots.

    first_slot is the first of the mix's slots that takes words of the document (null:
    none does), slots is their number. No row is taken more than MOST_TIMES times.
    Equal rows (same doc_id, source and size) may swap what is taken of them. An
    empty table gives no row.
    """
    documents, pieces, slots = mix_plan(docs, block_words, cells)
    taken = _taken_pieces(pieces, slots).groupBy(F.col("position").alias("_position"), F.col("start").alias("_start_taken"))
    taken = taken.agg(F.sum("used").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("slots"))
    own = documents.withColumn("_start", F.when(F.col("size") > 0, F.col("start")))
    joined = own.join(not_broadcast(taken), (own["position"] == taken["_position"]) & (own["_start"] == taken["_start_taken"]), "left")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_slot", F.coalesce("slots", F.lit(0)).cast("long").alias("slots"),
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, cells: int = CELLS) -> DataFrame:
    """The mix as documents, in the order of the schedule: a row for each time a document is taken, columns as they are.

    Documents stay whole: the last use of a source, which can end inside one, takes
    it if it takes half of its words or more. A document stands at the first slot that
    takes words of it in that use. Documents that the mix doesn't take, and those
    without words, go. A text is exchanged twice: to meet its slots, and into their order.
    """
    return on_core(docs, lambda core: _mixed_documents(core, block_words, cells))


def _mixed_documents(docs: DataFrame, block_words: int, cells: int) -> DataFrame:
    documents, pieces, slots = mix_plan(docs, block_words, cells)
    uses = _taken_pieces(pieces, slots).groupBy("doc_id", "position", "start", "size", "use").agg(F.sum("used").alias("used"), F.min("slot").alias("slot"))
    n = documents.count()
    uses = checkpointed(uses.filter("2 * used >= size").select("doc_id", "position", "start", "size", "slot"), n)
    repeated = documents.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id")
    place = F.struct("slot", "start")
    once = uses.join(not_broadcast(repeated), "doc_id", "left_anti").filter("doc_id IS NOT NULL")
    once = once.groupBy("doc_id").agg(F.collect_list(place).alias("_places"))  # an id that is not repeated has MOST_TIMES uses at most
    told = checkpointed(once.unionByName(repeated.withColumn("_places", F.lit(None).cast(once.schema["_places"].dataType))), n)
    rows = docs.join(not_broadcast(told), "doc_id")
    plain = rows.filter("_places IS NOT NULL").select(*docs.columns, F.inline("_places").alias("_slot", "_start"))
    # rows that share an id, or have none, meet their uses by source, size and number among their equals
    unclear = rows.filter("_places IS NULL").select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))
    same = ["doc_id", "position", "size"]
    shared = uses.join(not_broadcast(repeated), "doc_id", "left_semi").unionByName(uses.filter("doc_id IS NULL")).groupBy(*same, "start")
    shared = shared.agg(F.collect_list(place).alias("_places")).withColumn("_same", F.row_number().over(Window.partitionBy(*same).orderBy("start")))
    shared = shared.select(*[F.col(c).alias(f"_t{i}") for i, c in enumerate([*same, "_same"])], "_places")
    sources = documents.select(F.col("source").alias("_source"), F.col("position").alias("_position")).distinct()
    unclear = unclear.withColumn("_size", words(F.col("text"))).join(sources, F.col("source").eqNullSafe(F.col("_source")))
    order = Window.partitionBy("doc_id", "_position", "_size").orderBy("text", F.to_json(F.struct(*docs.columns)))
    unclear = unclear.withColumn("_same", F.row_number().over(order))
    match = [F.col(c).eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(["doc_id", "_position", "_size", "_same"])]
    found = unclear.join(not_broadcast(shared), match).select(*docs.columns, F.inline("_places").alias("_slot", "_start"))
    return plain.unionByName(found).orderBy("_slot", "_start").select(docs.columns)
