"""Text of token ranges, in one canonical spacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagrid.functions.text import unmark_placeholders
from lineagrid.functions.words import RESERVED, is_name


def printed(token: Column) -> Column:
    """Reserved words in capitals, one spelling of 'not equal', tight dots."""
    upper = F.upper(token)
    return (
        F.when(upper.isin(RESERVED), upper)
        .when(token == "!=", F.lit("<>"))
        .when(
            token.rlike(r"\s") & ~token.startswith("'"),
            F.regexp_replace(token, r"\s*\.\s*", "."),
        )
        .otherwise(token)
    )


def spaced(token: Column, before: Column, shown: Column) -> Column:
    """``shown`` with a blank in front unless it sticks to the token before."""
    glued = (
        before.isNull()
        | token.isin(",", ")", ".", ";")
        | (before == "(")
        | ((token == "(") & (is_name(before) | before.isin("EXISTS", "exists", "Exists")))
    )
    return F.when(glued, shown).otherwise(F.concat(F.lit(" "), shown))


def render(fragments: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """(h, *keys, text) for fragments (h, *keys, start, end[, repl]).

    ``repl`` maps token positions to replacement text. The fragments of one
    statement meet its token array in one row, so an array is read once and
    never copied per fragment.
    """
    if "repl" not in fragments.columns:
        fragments = fragments.withColumn("repl", F.lit(None).cast("map<int,string>"))
    grouped = fragments.groupBy("h").agg(
        F.collect_list(F.struct(*keys, "start", "end", "repl")).alias("frags")
    )

    def one(fragment: Column) -> Column:
        length = F.greatest(fragment["end"] - fragment["start"] + 1, F.lit(0))
        part = F.slice(F.col("toks"), fragment["start"] + 1, length)

        def piece(token: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(F.col("toks"), fragment["start"] + i - 1))
            swapped = F.try_element_at(fragment["repl"], fragment["start"] + i)
            return spaced(token, before, F.coalesce(swapped, printed(token)))

        text = unmark_placeholders(F.array_join(F.transform(part, piece), ""))
        return F.struct(*[fragment[k].alias(k) for k in keys], text.alias("text"))

    return (
        grouped.join(texts.select("h", "toks"), "h")
        .select("h", F.inline(F.transform("frags", one)))
    )
