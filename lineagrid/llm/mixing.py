"""Mixing sources to target weights by a low-discrepancy schedule.

Slot k of the mix belongs to the source into whose stretch of the cumulated
target shares the point frac(k / golden ratio) falls, so every stretch of the
schedule holds the sources in close to their shares. A slot is ``block_words``
words. Each source's documents are shuffled by a hash of their id and laid end
to end; their words are cut into blocks of equal size. The r-th slot of a source
takes its r-th block, round and round; the last slot a source needs is cut to
what is left of its target, and slots beyond it stay empty. So the words taken
of a source are its target, rounded, and nothing is repeated over
``max_repeats`` times.

Running sums and ranks are taken within slices of a source and then over the
slices, so a source with a third of all rows is spread like the rest.

Defined cases: a null source is one of its own and comes last; sources are
ordered by code point and weigh 1, 2, 3, repeating, or as ``weights`` says; a
null or empty text has size 0 and takes 0; documents of one source and one id
(repeated rows) stand next to each other in the shuffle in the order of their
sizes, and each has its own result; a source without words has target 0; an
empty table gives an empty mix; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.llm.common import WORD, running_total, stored

#: golden ratio in 31 bits (odd), so that k * GOLDEN fits a long for k < 2 ** 31
GOLDEN, SPAN = 1327217885, 1 << 31
BLOCK_WORDS = 256
SLICE_ROWS = 2_000


def _text_key(text: Column) -> Column:
    """What tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, number of words and hash of the text of every row, numbered
    (``row_no``)."""
    words = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        docs["doc_id"], docs["source"], words.alias("size"), _text_key(docs["text"]).alias("text_key")
    )
    return stored(rows.withColumn("row_no", F.monotonically_increasing_id()), "sizes")


def targets(sizes: DataFrame, max_repeats: int = 3, weights: Column | None = None) -> DataFrame:
    """source, place, n_docs, source_size, target: one row per source.

    Weights share all words. A target over ``max_repeats`` times its source's size
    stops there and the rest is shared again. The sources that stop are those with
    the least room per weight, so one pass in that order finds them all: from the
    first source that keeps to its share on (it has the highest level) none stops.
    One row per source is handled here, never documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    per_source = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")
    ).withColumn("place", F.row_number().over(order) - 1)
    weight = weights if weights is not None else F.col("place") % 3 + 1
    room = per_source.withColumn("weight", weight.cast("double")).withColumn(
        "room", (F.col("source_size") * max_repeats).cast("double")
    )
    everything = Window.partitionBy()
    by_room = Window.orderBy(F.col("room") / F.col("weight"), "place")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    leveled = room.withColumn("level", level).withColumn(
        "stops", F.col("room") < F.col("weight") * F.col("level")
    )
    shared = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)
    return leveled.select(
        "source", "place", "n_docs", "source_size",
        F.when(F.col("stops"), F.col("room"))
        .otherwise(F.least("room", F.col("weight") * shared)).alias("target"),
    )


def blocks(sizes: DataFrame, per_source: DataFrame, block_words: int) -> DataFrame:
    """Pieces of shuffled documents: place, block, row_no, words."""
    facts = per_source.select(
        F.col("source").alias("_s"), "place",
        F.ceil(F.col("n_docs") / SLICE_ROWS).alias("n_slices"),
    )
    rows = sizes.join(facts, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "shuffled", F.xxhash64(F.lit("mix"), "doc_id")
    )
    # slices follow one another in the order of the unsigned top bits of the hash
    high = F.shiftrightunsigned("shuffled", 33)
    laid = running_total(
        rows.withColumn("order", high), ["place"], ["order", "shuffled", "size", "row_no"],
        "size", F.floor(high * F.col("n_slices") / F.lit(SPAN)), "start",
    ).filter("size > 0")
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    cut = laid.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.select(
        "place", "block", "row_no",
        (begin - F.col("block") * block_words).alias("offset"), (end - begin).alias("words"),
    )


def needs(per_source: DataFrame, block_words: int) -> DataFrame:
    """place, source_size, aim, n_blocks, need: how many slots fill each target. In one
    round a source gives as many words as it has, so its last block may be shorter."""
    aim = F.round("target").cast("long")
    n_blocks = F.ceil(F.col("source_size") / block_words)
    rounds = F.floor(F.col("aim") / F.col("source_size"))
    rest = F.col("aim") - rounds * F.col("source_size")
    return per_source.select("place", "source_size", aim.alias("aim")).filter("aim > 0").select(
        "place", "source_size", "aim", n_blocks.alias("n_blocks"),
        (rounds * n_blocks + F.ceil(rest / block_words)).alias("need"),
    )


def schedule(per_source: DataFrame, block_words: int) -> DataFrame:
    """slot, place, block, limit: what each slot of the mix takes; ``limit`` is how
    many words of the block.

    A source's stretch of the unit interval is as long as its need and a constant
    more, which covers the discrepancy of the points. Of the slots it is given
    it then fills as many as it needs, evenly.
    """
    spark = per_source.sparkSession
    wanted = needs(per_source, block_words)
    total, n_sources = wanted.agg(F.sum("need"), F.count(F.lit(1))).first()
    if not n_sources:
        return spark.createDataFrame([], "slot long, place int, block long, limit long")
    slack = 4 + 2 * int(total).bit_length()
    n_slots = int(total) + slack * n_sources
    upto = F.sum(F.col("need") + slack).over(Window.orderBy("place"))
    stretches = wanted.select(
        "*", (upto / n_slots).alias("high"), ((upto - F.col("need") - slack) / n_slots).alias("low")
    )
    # the interval in equal cells: points and stretches meet by cell
    cells = 8 * n_sources
    touched = F.sequence(F.floor(F.col("low") * cells), F.ceil(F.col("high") * cells))
    points = spark.range(n_slots).select(
        F.col("id").alias("slot"),
        (F.pmod(F.pmod("id", F.lit(SPAN)) * GOLDEN, F.lit(SPAN)) / SPAN).alias("point"),
    ).withColumn("cell", F.floor(F.col("point") * cells))
    placed = points.join(stretches.withColumn("cell", F.explode(touched)), "cell").filter(
        (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    ).select("slot", "place", F.lit(1).alias("one"))
    placed = stored(placed, "slots")
    given = placed.groupBy("place").agg(F.count(F.lit(1)).alias("given"))
    ranked = running_total(
        placed, ["place"], ["slot"], "one", F.floor(F.col("slot") / SLICE_ROWS), "rank"
    ).join(given.join(wanted, "place"), "place")
    nth = lambda rank: F.floor(rank * F.col("need") / F.col("given"))
    filled = ranked.withColumn("nth", nth(F.col("rank"))).filter(
        nth(F.col("rank") + 1) > F.col("nth")
    )
    block = F.pmod("nth", "n_blocks")
    before = F.floor(F.col("nth") / F.col("n_blocks")) * F.col("source_size") + block * block_words
    return filled.select(
        "slot", "place", block.alias("block"),
        F.least(F.lit(block_words), F.col("aim") - before).alias("limit"),
    )


def mix(
    docs: DataFrame, max_repeats: int = 3, block_words: int = BLOCK_WORDS,
    weights: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix itself (slot, row_no, offset, words: in each slot the pieces of documents
    in order of offset), the sizes by row_no, and the targets by source."""
    sizes = sized(docs)
    per_source = stored(targets(sizes, max_repeats, weights), "targets")
    pieces = blocks(sizes, per_source, block_words)
    slots = schedule(per_source, block_words)
    placed = slots.join(pieces, ["place", "block"]).filter(F.col("offset") < F.col("limit"))
    words = F.least(F.col("words"), F.col("limit") - F.col("offset"))
    return placed.select("slot", "row_no", "offset", words.alias("words")), sizes, per_source


def taken_words(
    docs: DataFrame, max_repeats: int = 3, block_words: int = BLOCK_WORDS,
    weights: Column | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, text_key for every row."""
    mixed, sizes, per_source = mix(docs, max_repeats, block_words, weights)
    taken = mixed.groupBy("row_no").agg(F.sum("words").alias("taken"))
    facts = per_source.select(F.col("source").alias("_s"), "source_size", "target")
    return (
        sizes.join(taken, "row_no", "left")
        .join(facts, F.col("source").eqNullSafe(F.col("_s")))
        .select("doc_id", "size", "source_size", "target",
                F.coalesce("taken", F.lit(0)).alias("taken"), "text_key")
    )


def mixed_documents(
    docs: DataFrame, max_repeats: int = 3, block_words: int = BLOCK_WORDS,
    weights: Column | None = None,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them. Where
    the mix ends inside a document (once a source), that row is taken whole if half of its
    words or more are, else not at all; no text is cut. Documents the mix takes nothing of
    are left out."""
    taken = taken_words(docs, max_repeats, block_words, weights).filter("taken > 0")
    times = F.floor((2 * F.sum("taken") + F.max("size")) / (2 * F.max("size")))
    wanted = stored(
        taken.groupBy(F.col("doc_id").alias("_llm_id"), F.col("text_key").alias("_llm_key"))
        .agg(times.alias("_llm_times")).filter("_llm_times > 0"),
        "wanted",
    )
    rows = docs.withColumn("_llm_text", _text_key(docs["text"]))
    same = rows["doc_id"].eqNullSafe(wanted["_llm_id"]) & (rows["_llm_text"] == wanted["_llm_key"])
    return (
        rows.dropDuplicates(["doc_id", "_llm_text"]).join(wanted, same)
        .withColumn("_llm_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_llm_times")))
        .select(*docs.columns)
    )
