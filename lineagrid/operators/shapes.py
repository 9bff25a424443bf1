"""Texts that differ in one number only.

Job definitions are generated, so that many texts are one text with another number in its
names (``sales_17``, ``sales_18``). Nothing in lineage depends on which number it is, only on
which names are the same and on their order. So each text is read as a shape, in which a
stand-in of digits takes the number's place, and a number; results are worked out for
shapes and the number is put back into them.

One number of a text is taken out: the longest that ends a word's letters, or, where no word
has any, the only number of the text. A text keeps its number where that could change a result:

* where another number stands behind the same letters, for the two could sort otherwise;
* where a rewrite of dynamic SQL could join digits to what stands before them;
* where it holds the stand-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: digits, so that a shape is read just as its texts are.
STAND_IN = "91827364554637281907"
# anything beyond ASCII counts as a letter here
_HEAD = r"[A-Za-z_$@#\x{80}-\x{10ffff}]"
_NUMBER = rf"[0-9](?<={_HEAD}[0-9])[0-9]*+"
_NUMBERED = rf"(?<!{_HEAD})({_HEAD}++)([0-9]+)"
_JOINABLE = (
    r"(?=[')9])(?:'(?<=[0-9A-Za-z_$@#\x{80}-\x{10ffff}]')[\s|']*+[0-9]|\)[0-9]|" + STAND_IN + ")"
)
# the rewrites look for this number
_REWRITTEN = "1"
# put around numbers while they are told apart; a text that holds one keeps its number
_OPEN, _CLOSE = "\x01", "\x02"
# which numbers of a text the stand-in can stand for: those behind letters, or any
BEHIND_LETTERS, ANY = "L", "A"


def with_shape(texts: DataFrame) -> DataFrame:
    """Adds ``shape``, ``number`` and ``number_at`` to texts (text, ...).

    ``number`` is what ``STAND_IN`` stands for in the shape; a text that keeps its number
    has the stand-in itself. ``number_at`` says at which places, or is NULL. Shape and
    number together give the text again. All patterns are fixed, so none is compiled per text.
    """
    lower = F.lower("text")
    named = lambda same: F.transform(
        F.filter("named_all", lambda p: (p["numbers"] == F.col("named")) == F.lit(same)), lambda p: p["heads"]
    )
    several = F.size("numbers") > 1
    held = F.col("text").contains(_OPEN) | F.col("text").contains(_CLOSE)
    return (
        texts.withColumn("keeps", F.col("text").rlike(_JOINABLE) | held)
        .withColumn("marked", _marked("text", _NUMBER))
        .withColumn("numbers", F.array_distinct(F.transform(
            F.filter(F.split("marked", _OPEN), lambda part: part.contains(_CLOSE)),
            lambda part: F.substring_index(part, _CLOSE, 1),
        )))
        .withColumn("named", F.when(F.size("numbers") == 1, F.get("numbers", F.lit(0))).otherwise(
            F.array_max(F.transform("numbers", lambda n, i: F.struct(F.length(n), -i, n.alias("n"))))["n"]
        ))
        .withColumn("named_all", F.when(several, F.arrays_zip(
            F.regexp_extract_all(lower, F.lit(_NUMBERED), F.lit(1)).alias("heads"),
            F.regexp_extract_all(lower, F.lit(_NUMBERED), F.lit(2)).alias("numbers"),
        )))
        .withColumn("alone", F.when(
            F.col("named").isNull(), F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0)))
        ))
        .withColumn(
            "number_at",
            F.when(F.col("keeps"), F.lit(None).cast("string"))
            .when(
                (F.size("numbers") == 1) | (several & ~F.arrays_overlap(named(True), named(False))),
                F.lit(BEHIND_LETTERS),
            )
            .when((F.size("alone") == 1) & (F.get("alone", F.lit(0)) != _REWRITTEN), F.lit(ANY)),
        )
        .withColumn("number", F.when(
            F.col("number_at").isNotNull(), F.coalesce("named", F.get("alone", F.lit(0)))
        ).otherwise(F.lit(STAND_IN)))
        .withColumn("shape", as_shape("text", F.col("marked")))
        .drop("keeps", "marked", "numbers", "named", "named_all", "alone")
    )


def _marked(name: str, pattern: str) -> Column:
    return F.regexp_replace(F.col(name), F.lit(pattern), F.lit(f"{_OPEN}$0{_CLOSE}"))


def as_shape(name: str, marked: Column | None = None) -> Column:
    """A text, or a name from it, with the stand-in for its ``number`` where ``number_at`` says.
    ``marked`` is the text with marks around the numbers behind letters, where it is known."""
    marked = _marked(name, _NUMBER) if marked is None else marked
    text = F.when(F.col("number_at") == ANY, _marked(name, "[0-9]+")).otherwise(marked)
    own = F.concat(F.lit(_OPEN), F.col("number"), F.lit(_CLOSE))
    swapped = F.replace(text, own, F.lit(STAND_IN))
    plain = F.replace(F.replace(swapped, F.lit(_OPEN), F.lit("")), F.lit(_CLOSE), F.lit(""))
    return F.when(F.col("number_at").isNotNull(), plain).otherwise(F.col(name))


def with_number(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (number, ...) with the number put back into columns of results."""
    return rows.withColumns({c: F.replace(F.col(c), F.lit(STAND_IN), F.col("number")) for c in columns})


def places(text: Column) -> Column:
    """How often the stand-in stands in a text."""
    without = F.replace(text, F.lit(STAND_IN), F.lit(""))
    return ((F.length(text) - F.length(without)) / len(STAND_IN)).cast("int")


def text_columns(rows: DataFrame) -> list[str]:
    return [name for name, kind in rows.dtypes if kind == "string"]
