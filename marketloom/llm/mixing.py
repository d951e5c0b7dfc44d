"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

The shuffled documents of a source form an endless cyclic stream of words, cut into blocks of ``block_words``. The
schedule gives every source as many slots as its target needs. Slot times are van der Corput points: the slot whose
point falls into a source's share of the cumulative weights goes to that source, so each source is spread evenly
over the mix. The k-th slot of a source, in time, takes the k-th block of its stream; a source's last slot is cut
so that its target is met to the word.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketloom.llm.common import WORD, running_starts, stored

WEIGHTS = (5, 2, 1)
"""Weights of the sources in code point order, repeating."""

MOST_PASSES = 3
BLOCK_WORDS = 256
CHUNK = 4096
"""Slots that one exploded row makes."""

SLOTS_PER_WINDOW = 65_536


def words_in(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MOST_PASSES) -> DataFrame:
    """Per source: ``src`` (its number in code point order, null last), ``source_size``, ``target`` in words.

    Targets are shares by weight of all words, at most ``passes`` times the source's words; what is above is shared
    again among the rest. Water filling does that in one step: ordered by words per weight, the sources before a
    certain one are full. Windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("src", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")))
        .withColumn("most", F.lit(passes) * F.col("source_size"))
    )
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "src")
    earlier, everyone = by_room.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    full = F.coalesce(F.sum("most").over(earlier), F.lit(0))
    weight_left = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    level = (
        weighed.withColumn("level", (F.sum("source_size").over(everyone) - full) / weight_left)
        .withColumn("place", F.row_number().over(by_room))
        .withColumn("level", F.min(
            F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("place", "level"))
        ).over(everyone)["level"])
    )
    return level.select(
        "source", "src", "source_size", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots ``(src, block, slot)``: at time ``slot`` the mix takes block ``block`` of the stream of ``src``.

    The point of time t is its bits reversed (van der Corput, base 2); cumulative slot counts map points to sources, so
    every source gets exactly the slots its target needs. ``sources`` is read several times: store it first.
    """
    counted = sources.withColumn("slots", F.ceil(F.round("target") / block_words).cast("long"))
    total = counted.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    bits = max(1, math.ceil(math.log2(max(2, total))))
    first = F.sum("slots").over(Window.orderBy("src")) - F.col("slots")
    chunks = counted.where("slots > 0").withColumn("first", first).select(
        "src", "first", "slots", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK))).alias("chunk")
    ).repartition("src", "chunk")
    low = F.col("first") + F.col("chunk") * CHUNK
    high = F.least(F.col("first") + F.col("slots"), low + CHUNK) - 1
    # The point of a slot, as an integer of so many bits, and its time.
    points = chunks.select("src", F.explode(F.sequence(low, high)).alias("point"))
    slots = points.select("src", F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long").alias("slot"))
    # Rank per source in stretches of time; every stretch holds an even share of each source.
    stretch = max(0, bits - max(0, math.ceil(math.log2(max(1, total) / SLOTS_PER_WINDOW))))
    # Stored, as Spark can't know how many rows explode makes and would broadcast them.
    slots = stored(slots.withColumn("stretch", F.shiftright("slot", stretch)), "mix-slots")
    before = Window.partitionBy("src").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slots.groupBy("src", "stretch").agg(F.count("*").alias("n")).select(
        "src", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    rank = F.row_number().over(Window.partitionBy("src", "stretch").orderBy("slot")) - 1
    return slots.join(offsets, ["src", "stretch"]).select("src", (rank + F.col("earlier")).alias("block"), "slot")


def streamed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in the shuffled stream of their source, and the sources' targets; both stored.

    Expects ``doc_id, source, size``. Adds ``src, source_size, target``, ``start`` (words of the source before the
    document) and ``row`` (place among the source's documents).
    """
    sizes = stored(docs.select("doc_id", "source", "size"), "mix-sizes")
    sources = stored(source_targets(sizes, weights), "mix-sources")
    placed = sizes.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "src", "source_size", "target", F.xxhash64("doc_id", "size", F.lit("mix")).alias("shuffle")
    )
    return stored(
        running_starts(placed, ["src"], ["shuffle", "doc_id", "size"], {"start": F.col("size"), "row": F.lit(1)}), "mix-stream"
    ), sources


def pieces(stream: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS, passes: int = MOST_PASSES) -> DataFrame:
    """The mix: per slot the spans of documents in its block, ``slot`` null for documents that it leaves out.

    Columns: those of ``stream``, ``slot``, ``block``, ``turn`` (how often the source had been used up), ``first_word`` and
    ``words`` of the span. Order by ``slot``, ``start`` to read the mix.
    """
    begin = lambda turn: F.col("start") + turn * F.col("source_size")
    end = lambda turn: F.least(begin(turn) + F.col("size"), F.round("target").cast("long"))
    turns = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(passes - 1).cast("long")), lambda t: end(t) > begin(t))
    spread = stream.withColumn("turn", F.explode_outer(turns))
    blocks = F.when(
        F.col("turn").isNotNull(),
        F.sequence(F.floor(begin(F.col("turn")) / block_words), F.floor((end(F.col("turn")) - 1) / block_words)),
    )
    spread = spread.withColumn("block", F.explode_outer(blocks))
    turn, block = F.col("turn"), F.col("block")
    low = F.greatest(begin(turn), block * block_words)
    high = F.least(end(turn), (block + 1) * block_words)
    spread = spread.withColumns({"first_word": low - begin(turn), "words": F.coalesce(high - low, F.lit(0))})
    return spread.join(schedule(sources, block_words), ["src", "block"], "left")


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document ``doc_id, size, source_size, target, taken``: the words that the mix takes of it, repeats counted.

    Null and empty texts have size 0 and are taken 0 times; a null source is a source of its own. Repeated rows and
    documents of one id are separate documents. A table without words has targets of 0. Columns besides ``doc_id``,
    ``source`` and ``text`` are ignored.
    """
    stream, sources = streamed(docs.select("doc_id", "source", words_in("text").alias("size")), weights)
    taken = F.sum(F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(0)).cast("long").alias("taken")
    keys = ["src", "row", "doc_id", "size", "source_size", "target"]
    return pieces(stream, sources, block_words).groupBy(*keys).agg(taken).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: each one as often as the mix takes more than half of it.

    Only the document at the end of a source's share can be taken in part, so a source misses its target by half a
    document at most. Null and empty texts and texts without words are never taken; a null source is one of its own.
    Rows that agree in id, source and size are dealt their copies one by one. Texts are shuffled once and kept whole; an
    empty table stays empty. Columns of any name are kept as they are.
    """
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", words_in("text").alias("size"))
    stream, sources = streamed(rows.select("doc_id", "source", "size"), weights)
    turns = pieces(stream, sources, block_words).groupBy("src", "row", "doc_id", "size", "turn").agg(
        F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))).alias("words")
    )
    # A document id may stand in several rows: one line per id, source and size.
    copies = turns.groupBy("src", "doc_id", "size").agg(
        F.count(F.when(F.col("words") * 2 > F.col("size"), 1)).alias("copies"), F.countDistinct("row").alias("rows")
    ).where("copies > 0")
    copies = copies.join(sources.select("src", F.col("source").alias("of_source")), "src").select(
        F.col("doc_id").alias("of_id"), "of_source", F.col("size").alias("of_size"), "copies", "rows"
    )
    met = rows.join(copies, F.col("doc_id").eqNullSafe(F.col("of_id")) & F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size")))
    nth = F.row_number().over(Window.partitionBy("of_id", "of_source", "of_size").orderBy(F.lit(0)))
    repeated = met.where("rows > 1").withColumn("nth", nth).withColumn(
        "copies", F.expr("copies div rows") + F.when(F.col("nth") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    ).where("copies > 0")
    taken = met.where("rows = 1").select("row", "copies").unionByName(repeated.select("row", "copies"))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
