"""Repeated runs of lines, found by prefix doubling over the sequence of line ids.

All documents' lines (those with a word) form one sequence in order of doc_id and
line. A run is some consecutive lines of one document; a run of at least
``min_words`` words that also occurs earlier is a copy, and all its lines are
deleted. First occurrences stay.

Prefix doubling names the suffixes by their first 1, 2, 4, ... lines: the name is the
place where those lines occur first, and the name for twice the length comes from the
pair of names at a place and at that distance behind it. Suffixes that share a name
form an interval whose common prefix has at least that many lines. Places whose
prefix occurs once drop out, so the rounds shrink, and ``log2(min_words)`` rounds do:
a copied run is covered by its smallest windows of ``min_words`` words, those
from each line forward and those from each line back, and a window of any length is
named by two overlapping prefixes. Overlapping windows merge to maximal runs.

Built-in functions only. Names are by first occurrence, not by rank: no step needs
the order of suffixes, only which of them agree and where they do first.

Defined cases: null and empty texts have no line; lines without a word are in no run
and stay, except between deleted lines; a run does not cross documents, but may
repeat within one; rows that share an id and a text are one document and all cut
alike, other rows that share an id stand one after the other in the sequence; a
text of which nothing is left is empty;
null text stays null; an empty table gives an empty result; columns other than id
and text play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.llm.common import WORD, stored

MIN_WORDS = 50


def document(docs: DataFrame):
    """What tells rows of one id apart."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def numbered_documents(docs: DataFrame) -> DataFrame:
    """doc, doc_id, and for each line with a word: its number, two hashes, its words."""
    lines = F.split(F.coalesce(docs["text"], F.lit("")), "\n", -1)
    told = F.filter(
        F.transform(lines, lambda line, i: F.struct(
            i.alias("line"),
            F.xxhash64(F.lit(1), line).alias("h1"), F.xxhash64(F.lit(2), line).alias("h2"),
            F.regexp_count(line, F.lit(WORD)).cast("long").alias("words"),
        )),
        lambda t: t["words"] > 0,
    )
    return docs.select(document(docs).alias("doc"), docs["doc_id"], told.alias("told"))


def line_sequence(docs: DataFrame) -> DataFrame:
    """doc (hash of the text), doc_id, pos, line, h1, h2, left (lines to the document's end), begin and end
    (words before and up to the line's end), total (words of the document).

    ``pos`` numbers the lines in order; in one document without gaps.
    """
    rows = stored(
        numbered_documents(docs)
        .select("doc", "doc_id", F.size("told").alias("n"), F.posexplode("told").alias("i", "t"))
        .select("doc", "doc_id", (F.col("n") - F.col("i")).alias("left"), "t.*"),
        "lines",
    )
    so_far = Window.partitionBy("doc_id", "doc").orderBy("line")
    whole = Window.partitionBy("doc_id", "doc")
    ordered = (
        rows.repartitionByRange("doc_id", "doc").dropDuplicates(["doc_id", "doc", "line"])
        .sortWithinPartitions("doc_id", "doc", "line")
    )
    return stored(
        ordered.withColumn("pos", F.monotonically_increasing_id())
        .withColumn("end", F.sum("words").over(so_far))
        .withColumn("total", F.sum("words").over(whole))
        .withColumn("begin", F.col("end") - F.col("words")),
        "sequence",
    )


def first_names(lines: DataFrame) -> DataFrame:
    """pos, left, name of every line that occurs twice or more."""
    groups = lines.groupBy("h1", "h2").agg(
        F.min("pos").alias("name"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select("h1", "h2", "name")
    return stored(
        lines.join(stored(groups, "names"), ["h1", "h2"]).select("pos", "left", "name"), "named"
    )


def doubled(names: DataFrame, length: int) -> DataFrame:
    """Names for prefixes of twice the length; those that occur once drop out."""
    behind = names.select((F.col("pos") - length).alias("pos"), F.col("name").alias("name2"))
    pairs = stored(
        names.filter(F.col("left") >= 2 * length).join(behind, "pos"), "pairs"
    )
    groups = pairs.groupBy("name", "name2").agg(
        F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select("name", "name2", "first")
    return stored(
        pairs.join(stored(groups, "names"), ["name", "name2"])
        .select("pos", "left", F.col("first").alias("name")),
        "named",
    )


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """pos, length: for each line the fewest lines from it on, and up to it, that have
    ``min_words`` words."""
    doc = Window.partitionBy("doc_id", "doc")
    on = F.count(F.lit(1)).over(doc.orderBy("begin").rangeBetween(0, min_words - 1))
    back = F.count(F.lit(1)).over(doc.orderBy("end").rangeBetween(1 - min_words, 0))
    counted = lines.withColumn("on", on).withColumn("back", back)
    forward = counted.filter(F.col("total") - F.col("begin") >= min_words).select(
        "doc", "doc_id", "pos", F.col("on").alias("length")
    )
    backward = counted.filter(F.col("end") >= min_words).select(
        "doc", "doc_id", (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("length")
    )
    return forward.union(backward).distinct()


def copied_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """doc, doc_id, pos, length of the windows that occur earlier."""
    asked = stored(windows(lines, min_words), "windows")
    names, length, found = first_names(lines), 1, []
    while length <= min_words:
        here = asked.filter((F.col("length") >= length) & (F.col("length") < 2 * length))
        other = names.select(F.col("pos").alias("pos2"), F.col("name").alias("name2"))
        named = stored(
            here.join(names.select("pos", "name"), "pos")
            .withColumn("pos2", F.col("pos") + F.col("length") - length).join(other, "pos2")
            .select("doc", "doc_id", "pos", "length", "name", "name2"),
            "windows",
        )
        groups = named.groupBy("length", "name", "name2").agg(
            F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")
        ).filter("n > 1").drop("n")
        found.append(
            named.join(stored(groups, "groups"), ["length", "name", "name2"])
            .filter("pos > first").select("doc", "doc_id", "pos", "length")
        )
        if 2 * length <= min_words:
            names = doubled(names, length)
        length *= 2
    return reduce(DataFrame.union, found)


def copied_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """doc, doc_id, from_line, to_line (inclusive), n_words: maximal stretches of copied
    windows, by the documents' own line numbers."""
    spans = stored(
        copied_windows(lines, min_words).withColumn("stop", F.col("pos") + F.col("length")), "spans"
    )
    by_doc = Window.partitionBy("doc_id", "doc").orderBy("pos", "stop")
    before = F.max("stop").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("new", (before.isNull() | (F.col("pos") > before)).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(by_doc))
    runs = stored(
        islands.groupBy("doc_id", "doc", "island").agg(
            F.min("pos").alias("first"), (F.max("stop") - 1).alias("last")
        ),
        "runs",
    )
    at = lambda name, line, words: lines.select(
        F.col("pos").alias(name), F.col("line").alias(line), F.col(words).alias(f"{line}_words")
    )
    return (
        runs.join(at("first", "from_line", "begin"), "first")
        .join(at("last", "to_line", "end"), "last")
        .select("doc", "doc_id", "from_line", "to_line",
                (F.col("to_line_words") - F.col("from_line_words")).alias("n_words"))
    )


def delete_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without copied runs, n_lines (before), n_removed, for every row."""
    runs = copied_runs(line_sequence(docs), min_words)
    of_doc = stored(
        runs.groupBy("doc_id", "doc").agg(
            F.array_sort(F.collect_list(F.struct("from_line", "to_line"))).alias("cuts")
        ),
        "cuts",
    ).select(F.col("doc_id").alias("_id"), "doc", "cuts")
    rows = docs.select("doc_id", "text", document(docs).alias("_doc"))
    # cuts grow with the corpus: always meet by merge, so that the plan is one at every size
    joined = rows.join(
        of_doc.hint("merge"), rows["doc_id"].eqNullSafe(of_doc["_id"]) & (rows["_doc"] == of_doc["doc"]), "left"
    )
    lines = F.split("text", "\n", -1)
    size = F.size("cuts")
    # what stays: from after one cut to before the next
    start = lambda i: F.when(i == 0, 0).otherwise(F.get("cuts", i - 1)["to_line"] + 1)
    stop = lambda i: F.when(i == size, F.size(lines)).otherwise(F.get("cuts", i)["from_line"])
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), size), lambda i: F.slice(lines, start(i) + 1, stop(i) - start(i))
    ))
    cut = F.aggregate(
        "cuts", F.lit(0), lambda n, c: n + (c["to_line"] - c["from_line"] + 1).cast("int")
    )
    return joined.select(
        "doc_id",
        F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(cut, F.lit(0)).cast("long").alias("n_removed"),
    )
