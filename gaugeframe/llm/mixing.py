"""Mixing sources to target weights, with DataFrame functions only.

Each source is a stream of words: its documents in a pseudorandom order. The stream is packed
into blocks of ``block_words``. Output shards of ``shard_slots`` slots take blocks:

1. A shard gets the whole part of each source's expected count, and draws the slots that remain
   from the multinomial of the fractional parts.
2. A source's slots are numbered over all shards. Slot j takes, in pass j / blocks over the
   source, the block that a pseudorandom permutation of the block numbers gives for j % blocks.
3. Slots and blocks are joined by (source, block).

Running totals (of words in a source, of slots over shards) are built in two levels, so that no
source is summed up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.sources.scratch import materialize

WEIGHTS = (5, 2, 1)
PASSES = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
# Rows that one window task sorts, about.
PART_ROWS = 2_000
# Slots that one task numbers, about.
TASK_SLOTS = 250_000
# Multipliers of the block permutations: primes just under 2^31.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549)
SEED = 20240229


def _unit(*cols) -> F.Column:
    """A pseudorandom number in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    # A word starts where a character that is no white space follows one or the beginning.
    words = F.size(F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""),
                           r"[\x20\x09-\x0D]+"))
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.when(blank, F.lit(0)).otherwise(words).cast("long").alias("size"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources numbered by code point, null last, from 0: two levels over ranges of names."""
    spread = sources.withColumn("last", F.col("source").isNull()).repartitionByRange(
        64, "last", "source").withColumn("part", F.spark_partition_id())
    spread = materialize(spread, "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = spread.groupBy("part").count().withColumn(
        "offset", F.coalesce(F.sum("count").over(before), F.lit(0))).select("part", "offset")
    inside = Window.partitionBy("part").orderBy("last", "source")
    return spread.withColumn("n", F.row_number().over(inside) - 1).join(
        F.broadcast(offset), "part").select(
            (F.col("offset") + F.col("n")).alias("sid"), "source", "source_size", "docs")


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds ``sid``, ``weight`` and ``target`` to ``(source, source_size, docs)``.

    The targets share the total size by weight, up to ``PASSES`` times a source's size; what a
    full source leaves is shared again until none is above. A round is one aggregate.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    ranked = materialize(_ranked(sources).withColumn("weight", weight), "sources")
    limit = F.lit(PASSES) * F.col("source_size")
    level, full = 0.0, None
    while True:
        above = F.col("weight") * F.lit(level) > limit
        row = ranked.agg(
            F.sum("source_size").alias("total"), F.sum(above.cast("long")).alias("full"),
            F.sum(F.when(above, limit)).alias("fixed"),
            F.sum(F.when(~above, F.col("weight"))).alias("weights")).head()
        if row["full"] == full or not row["weights"]:
            break
        full = row["full"]
        level = (row["total"] - (row["fixed"] or 0)) / row["weights"]
    return ranked.withColumn(
        "target", F.least(limit.cast("double"), F.col("weight") * F.lit(float(level))))


def _running(df: DataFrame, group: str, part: str, order: list[str], value: str, out: str):
    """Adds the sum of ``value`` over the rows of ``group`` that come before, part by part."""
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = df.groupBy(group, part).agg(F.sum(value).alias("__gf_sum")).withColumn(
        "__gf_before", F.coalesce(F.sum("__gf_sum").over(before), F.lit(0))).drop("__gf_sum")
    inside = Window.partitionBy(group, part).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    return df.withColumn("__gf_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(
        parts, [group, part]).withColumn(out, F.col("__gf_before") + F.col("__gf_inside")).drop(
            "__gf_before", "__gf_inside", part)


def draw_counts(sources: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(shard, sid, blocks, slots)``: how many blocks of each source a shard takes.

    ``sources (sid, source_size, blocks, target)``. The drawn slots find their source by
    joining on cells of the unit interval, so many sources cost no more than few.
    """
    want = F.col("target") * F.col("blocks") / F.col("source_size")
    wanted = sources.where("source_size > 0 AND target > 0").select("sid", "blocks", want.alias("want"))
    total = wanted.agg(F.sum(F.col("want").cast("decimal(38,6)")), F.count("*")).head()
    if not total[0]:
        return wanted.select(F.lit(0).cast("long").alias("shard"), "sid", "blocks",
                             F.lit(0).cast("long").alias("slots")).limit(0)
    shards = max(1, round(float(total[0]) / shard_slots))
    cells = 1 << max(4, (4 * total[1]).bit_length())
    share = F.col("want") / F.lit(float(shards))
    # Fractions are whole numbers of 2^-32, so their sums do not depend on the order.
    parted = materialize(wanted.select(
        "sid", "blocks", F.floor(share).alias("whole"),
        F.floor((share - F.floor(share)) * float(1 << 32)).alias("rest")), "shares")
    units = parted.agg(F.sum("rest")).head()[0] or 0
    rest = units / float(1 << 32)

    spark = sources.sparkSession
    shard = spark.range(shards).withColumnRenamed("id", "shard")
    whole = parted.where("whole > 0").select(
        "sid", "blocks", "whole", F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // 1024))).alias("k"))
    whole = whole.select("sid", "blocks", F.explode(F.sequence(
        F.col("k") * 1024, F.least(F.col("k") * 1024 + 1023, F.lit(shards - 1)))).alias("shard"),
        F.col("whole").alias("slots")).select(
            F.col("shard").cast("long").alias("shard"), "sid", "blocks", "slots")
    if not units:
        return whole
    # The fractional parts as consecutive intervals of [0, 1), split at the cells' borders.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part = F.floor(F.col("sid") / PART_ROWS)
    split = parted.where("rest > 0").withColumn("part", part)
    offset = split.groupBy("part").agg(F.sum("rest").alias("s")).withColumn(
        "offset", F.coalesce(F.sum("s").over(before), F.lit(0))).drop("s")
    inside = Window.partitionBy("part").orderBy("sid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    spans = split.withColumn("end", F.sum("rest").over(inside)).join(
        F.broadcast(offset), "part").select(
            "sid", "blocks",
            ((F.col("offset") + F.col("end") - F.col("rest")) / float(units)).alias("low"),
            ((F.col("offset") + F.col("end")) / float(units)).alias("high"))
    cell = lambda u: F.least(F.floor(u * cells), F.lit(cells - 1))
    spans = materialize(spans.withColumn(
        "cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high"))))), "spans")
    draws = shard.select("shard", F.explode(F.sequence(
        F.floor(F.col("shard") * F.lit(rest)), F.floor((F.col("shard") + 1) * F.lit(rest)))).alias("d"))
    draws = draws.where(F.col("d") < F.floor((F.col("shard") + 1) * F.lit(rest))).withColumn(
        "u", _unit(F.lit(SEED), "shard", "d")).withColumn("cell", cell(F.col("u")))
    drawn = draws.join(spans.hint("merge"), "cell").where("u >= low AND u < high").select(
        "shard", "sid", "blocks", F.lit(1).cast("long").alias("slots"))
    return whole.unionByName(drawn).groupBy("shard", "sid", "blocks").agg(
        F.sum("slots").cast("long").alias("slots"))


def _permuted(x, blocks, sid, turn):
    """A pseudorandom permutation of 0 .. blocks-1: a line modulo ``blocks`` whose slope is a
    prime that does not divide it. The product is taken in two pieces, so no long overflows for
    up to 2^46 blocks."""
    slopes = F.filter(F.array(*map(F.lit, PRIMES)), lambda p: blocks % p != 0)
    pick = F.pmod(F.xxhash64(F.lit(SEED), sid, turn), F.size(slopes).cast("long"))
    slope = F.element_at(slopes, (pick + 1).cast("int")).cast("long")
    shift = F.pmod(F.xxhash64(F.lit(SEED + 1), sid, turn), blocks)
    high = (slope * F.floor(x / 65536)) % blocks * 65536
    return (high + slope * (x % 65536) + shift) % blocks


def mix_slots(counts: DataFrame) -> DataFrame:
    """``(shard, slot, sid, turn, block)``: the block that each slot takes.

    Slots beyond ``PASSES`` turns over a source are left out: a source that must give all it may
    cannot make up for a draw above its target.
    """
    numbered = _running(counts.withColumn("part", F.floor(F.col("shard") / 1024)),
                        "sid", "part", ["shard"], "slots", "first")
    # A row makes many slots, so few bytes are much work: tasks are counted, not sized by bytes.
    tasks = max(1, (counts.agg(F.sum("slots")).head()[0] or 0) // TASK_SLOTS)
    numbered = numbered.where("slots > 0").repartition(tasks, "sid", "shard").select(
        "shard", "sid", "blocks", "first", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("k"))
    j = F.col("first") + F.col("k")
    slot = numbered.select("shard", F.col("k").alias("slot"), "sid", "blocks",
                           F.floor(j / F.col("blocks")).alias("turn"), (j % F.col("blocks")).alias("x"))
    return slot.where(F.col("turn") < PASSES).select(
        "shard", "slot", "sid", "turn",
        _permuted(F.col("x"), F.col("blocks"), F.col("sid"), F.col("turn")).alias("block"))


def pack_blocks(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(sid, block, row, words)``: how many words of each document lie in each block.

    ``sized (sid, row, doc_id, size)``; documents follow each other by a hash of their id.
    """
    parts = max(1, sized.count() // PART_ROWS)
    placed = _running(
        sized.where("size > 0").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(parts))),
        "sid", "part", ["doc_id", "size", "row"], "size", "begin")
    end = F.col("begin") + F.col("size")
    cut = placed.select("sid", "row", "begin", end.alias("end"), F.explode(F.sequence(
        F.floor(F.col("begin") / block_words), F.floor((end - 1) / block_words))).alias("block"))
    words = F.least("end", (F.col("block") + 1) * block_words) - F.greatest(
        "begin", F.col("block") * block_words)
    return cut.select("sid", "block", "row", words.alias("words"))


def mix_sources(docs: DataFrame, block_words: int = BLOCK_WORDS,
                shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row of ``docs (doc_id, text, source)``.

    ``size`` counts the words of the text (null: 0), ``source_size`` those of its source,
    ``target`` the words the mix should take from the source, ``taken`` those it takes from the
    document, repeats counted: at most ``PASSES`` times its size. Sources are weighed 5, 2, 1
    and again, in the order of their names, null last. The draw depends on the data only, so
    reruns agree. Repeated rows are documents of their own; an empty table gives an empty
    result. Other columns are not looked at.
    """
    sizes = materialize(_sized(docs), "sizes")
    sources = source_targets(sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("docs")))
    sources = materialize(sources.withColumn(
        "blocks", F.ceil(F.col("source_size") / block_words)), "sources")
    named = sources.select(F.col("source").alias("__gf_source"), "sid", "source_size", "target")
    # One row per source, two numbers each: joined by size, split where a source is hot.
    rows = materialize(sizes.join(
        named, sizes["source"].eqNullSafe(named["__gf_source"])).select(
            "doc_id", "size", "sid", "source_size", "target",
            F.monotonically_increasing_id().alias("row")), "rows")
    counts = materialize(draw_counts(sources, shard_slots), "counts")
    slots = mix_slots(counts).groupBy("sid", "block").agg(
        F.count("*").alias("times"))
    # Few counts make many slots, which the planner's estimate misses: both sides are shuffled.
    taken = pack_blocks(rows, block_words).join(
        slots.hint("merge"), ["sid", "block"]).groupBy("row").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"))
    return rows.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
