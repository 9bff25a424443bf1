"""Conditions: splitting, and attribution to the tables they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagrid.functions.text import readable_not, strip, unmark_placeholders
from lineagrid.functions.words import token_array
from lineagrid.operators.closure import follow, union_all
from lineagrid.operators.render import printed, render, spaced
from lineagrid.operators.resolve import GUESSES, Model


def condition_mentions(m: Model, inside: DataFrame) -> DataFrame:
    """Qualified mentions in each condition whose qualifier the condition's
    own block knows: (h, bpos, pred, pos, name, q, n, node).

    Mentions in queries nested in the condition count too and are looked up in
    the outer block. Nesting is followed bracket by bracket.
    """
    usable = m.refs.filter("q <> ''").filter(
        ~F.upper(unmark_placeholders(F.col("name"))).startswith("V_")
    ).select("h", "own_spos", "pos", "name", "q", "n")
    own = inside.filter("is_ref").select("h", "bpos", "pos", "pred").join(
        usable.drop("own_spos"), ["h", "pos"]
    )
    seed = inside.filter("opens_next").select(
        "h", "bpos", "pred", (F.col("pos") + 1).alias("spos"), F.lit(0).alias("depth")
    )
    links = m.all_scopes.select("h", F.col("outer_spos").alias("spos"), F.col("spos").alias("inner"))

    def step(frontier):
        return frontier.join(links, ["h", "spos"]).select(
            "h", "bpos", "pred", F.col("inner").alias("spos"), (F.col("depth") + 1).alias("depth")
        )

    held = follow(seed, step, ["h", "bpos", "pred", "spos"], "depth").drop("depth")
    nested = held.join(usable.withColumnRenamed("own_spos", "spos"), ["h", "spos"]).drop("spos")
    both = union_all([own, nested])
    known = both.join(m.keys.select("h", "bpos", F.col("key").alias("q")), ["h", "bpos", "q"], "left_semi")
    # a CTE name counts in every block of the statement
    cte = both.join(
        m.ctes.select("h", F.col("cte_name").alias("q")), ["h", "q"], "left_semi"
    ).join(m.keys.select("h", "bpos", F.col("key").alias("q")), ["h", "bpos", "q"], "left_anti")
    return known.unionByName(cte.select(*known.columns)).withColumn(
        "node", F.concat_ws("|", F.lit(""), F.col("bpos").cast("string"), "q", "n")
    )


def attribute(
    m: Model, predicates: DataFrame, mentions: DataFrame, nodes: DataFrame, results: DataFrame
) -> DataFrame:
    """(h, bpos, cat, sch, name, where_condition): the conditions of a block
    that touch each table, in order, each once, joined with AND."""
    physical = (
        mentions.join(nodes.filter(~F.col("rule").isin(GUESSES)).select("h", "node"), ["h", "node"])
        .join(results, ["h", "node"])
        .filter("name_t <> '' AND name_t <> 'DUAL'")
    )
    safe = F.col("first_name").rlike("^[_a-zA-Z][_a-zA-Z0-9]*$")
    shown = F.when(safe, F.col("first_name")).otherwise(F.concat(F.lit('"'), "first_name", F.lit('"')))
    swaps = (
        physical.groupBy("h", "bpos", "pred", "pos", "name")
        .agg(F.min_by("name_t", "path").alias("first_name"))
        .groupBy("h", "bpos", "pred")
        .agg(F.map_from_entries(F.collect_list(
            F.struct("pos", F.concat(shown, F.lit("."), "name"))
        )).alias("repl"))
    )
    ranges = predicates.join(swaps, ["h", "bpos", "pred"]).select(
        "h", "bpos", "pred", "start", "end", "repl",
        F.when(F.col("clause") == "WHERE", 0).otherwise(1).alias("late"),
    )
    texts = render(ranges, m.texts, ["bpos", "pred", "late"]).withColumn("text", readable_not("text"))
    touched = physical.select("h", "bpos", "pred", "cat", "sch", F.col("name_t").alias("name")).distinct()
    return (
        touched.join(texts, ["h", "bpos", "pred"])
        .groupBy("h", "bpos", "cat", "sch", "name", "text")
        .agg(F.min(F.struct("late", "pred")).alias("place"))
        .groupBy("h", "bpos", "cat", "sch", "name")
        .agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("parts"))
        .select(
            "h", "bpos", "cat", "sch", "name",
            F.array_join(F.transform("parts", lambda p: p["text"]), " AND ").alias("where_condition"),
        )
    )


#: tokens that can change where a condition is cut
CUT_WORDS = ["(", ")", "CASE", "END", "AND", "OR", "BETWEEN", "'", '"']


def _read_mark(state: Column, mark: Column) -> Column:
    """What is known behind a token of ``CUT_WORDS``; words count at the top only, between
    brackets and CASE to END they belong to an operand."""
    u = mark["u"]
    depth = state["depth"] + F.when(u.isin("(", "CASE"), 1).when(u.isin(")", "END"), -1).otherwise(0)
    top = state["depth"] == 0
    return F.struct(
        depth.alias("depth"),
        F.least(state["low"], depth).alias("low"),
        (state["has_or"] | (top & (u == "OR"))).alias("has_or"),
        (state["stray"] | u.isin("'", '"')).alias("stray"),
        F.when(top & u.isin("AND", "OR", "BETWEEN"), u == "BETWEEN").otherwise(state["between"]).alias("between"),
        F.when(top & (u == "AND") & ~state["between"], F.array_append(state["cuts"], mark["pos"]))
        .otherwise(state["cuts"]).alias("cuts"),
    )


def split_conditions(texts: DataFrame, key: str) -> DataFrame:
    """(key, pred_no, predicate) for condition texts (key, text).

    A leading WHERE or AND is dropped. The text is cut at top-level ANDs; the
    AND of BETWEEN, of a CASE or inside brackets does not cut, nor does any AND
    beside a top-level OR. Text whose brackets do not match stays whole.

    A text is read where it lies: one fold over the words that matter finds the cuts, so
    tokens are neither exchanged nor sorted.
    """
    bare = F.regexp_replace(strip(F.col("text")), r"(?i)^WHERE\s+", "")
    bare = strip(F.regexp_replace(strip(bare), r"(?i)^AND\s+", ""))
    no, none = F.lit(False), F.array().cast("array<int>")
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("low"), no.alias("has_or"), no.alias("stray"),
        no.alias("between"), none.alias("cuts"),
    )
    marks = F.filter(
        F.transform("toks", lambda tok, i: F.struct(i.alias("pos"), F.upper(tok).alias("u"))),
        lambda mark: mark["u"].isin(CUT_WORDS),
    )

    def piece(tok: Column, i: Column) -> Column:
        return spaced(tok, F.when(i > 0, F.get("toks", i - 1)), printed(tok))

    def predicate(cut: Column, i: Column) -> Column:
        """What stands before a cut, or NULL."""
        first = F.when(i > 0, F.get("cuts", i - 1) + 1).otherwise(F.lit(0))
        found = strip(F.array_join(F.slice("pieces", first + 1, cut - first), ""))
        return F.struct(
            i.cast("long").alias("pred_no"),
            F.when(cut > first, F.when(F.col("broken"), F.col("text")).otherwise(found)).alias("predicate"),
        )

    state = F.col("state")
    return (
        texts.select(key, bare.alias("text"))
        .withColumn("toks", token_array(F.col("text")))
        .withColumn("state", F.aggregate(marks, start, _read_mark))
        .withColumn("broken", (state["low"] < 0) | (state["depth"] != 0) | state["stray"])
        .withColumn("pieces", F.transform("toks", piece))
        .withColumn("cuts", F.when(F.col("broken") | state["has_or"], none).otherwise(state["cuts"]))
        # the end of the text is the last cut
        .withColumn("cuts", F.array_append("cuts", F.size("pieces")))
        .select(key, F.inline(F.transform("cuts", predicate)))
        .filter("predicate IS NOT NULL")
    )
