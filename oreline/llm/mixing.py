"""Mixing sources to target weights along a low-discrepancy schedule.

The mix is a line of slots, each one block of words. Slot ``t`` takes the point
``t`` times the golden ratio, modulo one; the source whose stretch of the
cumulative weights holds the point fills the slot. Slots are ranked within their
source and joined with that source's blocks, which are cut from its documents in
an order shuffled by hash; a source that needs more than it has starts again.

Ranks and running sums are computed in two levels (chunks of slots, ranges of
hashes), so a source with most of the rows is not gathered in one task. Only sizes
and hashes move; texts are read to be counted, and once more to be copied.

Cases: a null source is a source, the last; null and blank texts have no words
and are taken zero times; repeated rows are rows like others (their copies are dealt
out evenly); a source without words gets no slots; an empty table gives an empty
result. Further columns are ignored by ``mix`` and stay in ``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import kept, require, scratch, stored, word_count

BLOCK_WORDS = 32
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
POINT_BITS = 31
GOLDEN = 1327217885  # odd, nearest to 2**31 times the golden ratio's fraction
CELL_BITS = 12
CHUNK_BITS = 12
RANGE_BITS = 12


def sized(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """``(doc_id, source, mix_size, mix_order)``: size, and place in the shuffled source."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("mix_size"),
        _order(doc_id, text, source).alias("mix_order"),
    )


def _order(doc_id: str, text: str, source: str) -> F.Column:
    return F.xxhash64(F.col(doc_id), F.col(source), F.col(text))


def targets(sized_docs: DataFrame) -> DataFrame:
    """One row per source: number, size, weight, target.

    Weights 1, 2, 3 repeat over the sources by code point, null last. Targets
    share all words by weight and stop at three times their source's size; what
    is cut off is shared by weight among the others until none is above.
    """
    each = sized_docs.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # sources only
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    each = each.withColumn("number", number).withColumn("weight", weight)
    each = stored(each.withColumn("most", MOST_REPEATS * F.col("source_size")), "sources")
    total = each.agg(F.sum("source_size")).first()[0] or 0
    share = -1.0
    while True:
        above = F.col("weight") * F.lit(share) > F.col("most")
        used, free = each.agg(
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        now = (total - used) / free if free else share
        if now <= share:
            break
        share = now
    target = F.least(F.col("weight") * F.lit(float(share)), F.col("most").cast("double"))
    return each.withColumn("target", target)


def schedule(shares: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(slot, number, rank)``: which source fills each slot, and its how-manieth that is."""
    spark = shares.sparkSession
    line = shares.agg(F.sum("target")).first()[0] or 0.0
    ends = F.sum("target").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0))
    scale = float(1 << POINT_BITS) / line if line else 0.0
    stretch = shares.withColumn("end", F.round(ends * scale).cast("long"))
    stretch = stretch.withColumn("start", F.lag("end", 1, 0).over(Window.orderBy("number")))
    stretch = stretch.where("end > start").select("number", "start", "end")
    shift = POINT_BITS - CELL_BITS
    cells = stretch.withColumn(
        "cell", F.explode(F.expr(f"sequence(shiftright(start, {shift}), shiftright(end - 1, {shift}))"))
    )
    point = (F.expr(f"pmod(id, {1 << POINT_BITS}L)") * F.lit(GOLDEN)) % F.lit(1 << POINT_BITS)
    slots = spark.range(round(line / block_words)).select(F.col("id").alias("slot"), point.alias("point"))
    slots = slots.withColumn("cell", F.shiftright("point", shift)).join(cells, "cell")
    slots = slots.where("point >= start and point < end").select(
        "slot", "number", F.shiftright("slot", CHUNK_BITS).alias("chunk")
    )
    before = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = slots.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n"))
    chunks = chunks.select("number", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("slot")) - 1
    ranked = slots.withColumn("inside", inside).join(chunks, ["number", "chunk"])
    return ranked.select("slot", "number", (F.col("base") + F.col("inside")).alias("rank"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, mix_order)`` of each document.

    ``taken`` is the number of its words that the mix takes, with repeats; no document
    is taken more than three times. ``mix_order`` is the hash that shuffles the source.
    """
    require(docs, doc_id, text, source)
    with scratch(docs.sparkSession):
        rows = stored(sized(docs, doc_id, text, source), "sized")
        return kept(_mixed(rows, block_words), "mixed")


def _mixed(rows: DataFrame, block_words: int) -> DataFrame:
    shares = stored(targets(rows), "targets")
    known = shares.select(
        F.col("source").alias("mix_source"),
        F.col("number").alias("mix_number"),
        F.col("source_size").alias("mix_total"),
        F.col("target").alias("mix_target"),
    )
    # Sources are few against documents, but no bound on them is known: a plain join.
    rows = rows.join(known, F.expr("source <=> mix_source"))
    rows = rows.withColumn("mix_range", F.shiftright("mix_order", 64 - RANGE_BITS))
    ahead = Window.partitionBy("mix_number").orderBy("mix_range")
    ranges = rows.groupBy("mix_number", "mix_range").agg(F.sum("mix_size").alias("n"))
    ranges = ranges.select(
        "mix_number",
        "mix_range",
        F.coalesce(F.sum("n").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
    )
    inner = Window.partitionBy("mix_number", "mix_range").orderBy("mix_order", "mix_size")
    upto = F.sum("mix_size").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("upto", upto).join(ranges, ["mix_number", "mix_range"])
    placed = placed.withColumn("mix_start", F.col("base") + F.col("upto") - F.col("mix_size"))
    placed = stored(placed.drop("upto", "base", "mix_range"), "placed")

    block = F.explode(
        F.expr(f"sequence(mix_start div {block_words}, (mix_start + mix_size - 1) div {block_words})")
    )
    parts = placed.where("mix_size > 0").select("mix_number", "mix_start", "mix_size", block.alias("block"))
    words = F.least(F.col("mix_start") + F.col("mix_size"), (F.col("block") + 1) * block_words) - F.greatest(
        F.col("mix_start"), F.col("block") * block_words
    )
    parts = parts.select("mix_number", "mix_start", "block", words.alias("words"))
    blocks = shares.select("number", F.ceil(F.col("source_size") / block_words).alias("n_blocks"))
    slots = schedule(shares, block_words).join(blocks, "number")
    slots = slots.where(F.col("rank") < MOST_REPEATS * F.col("n_blocks"))
    uses = slots.groupBy("number", (F.col("rank") % F.col("n_blocks")).alias("slot_block")).agg(
        F.count(F.lit(1)).alias("uses")
    )
    taken = parts.join(uses, F.expr("mix_number = number and block = slot_block"))
    taken = taken.groupBy("mix_number", "mix_start").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    taken = taken.withColumnsRenamed({"mix_number": "of", "mix_start": "from"})
    out = placed.join(taken, F.expr("mix_number = of and mix_start = from and mix_size > 0"), "left")
    return out.select(
        "doc_id",
        "source",
        F.col("mix_size").alias("size"),
        F.col("mix_total").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "mix_order",
    )


def copies(
    docs: DataFrame,
    mixed: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as its taken words say, rounded.

    ``mixed`` is the result of ``mix`` for the same rows.
    """
    times = F.round(F.avg(F.col("taken") / F.col("size"))).cast("int")
    taken = mixed.where("size > 0").groupBy("mix_order").agg(times.alias("times")).where("times > 0")
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
        _order(doc_id, text, source).alias("mix_order"),
    )
    repeated = own.join(taken, "mix_order").select("own", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    return repeated.select(*[F.col(f"own.`{c}`") for c in docs.columns])
