"""Statement texts to a token table with nesting, block and clause.

One exchange on the text key carries the different shapes of texts; exploding and every window
below keep that partitioning. All windows group by one statement (or a part of
one), whose tokens came out of a single cell of the input.

Brackets, blocks and clauses are worked out on the tokens that can change them
(a fraction of all) and carried on to the tokens behind, in one pass over all;
neighbours are read from the token array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.functions.text import (
    clean_statement, foreign_mark, frame, frame_error, mark_placeholders, normalize_dynamic_sql, plain_blanks,
)
from lineagrid.functions.words import (
    JOIN_WORDS, SET_WORDS, token_array, without_partition_clause,
)
from lineagrid.operators.shapes import STAND_IN, with_shape


def text_key(cleaned):
    return F.unhex(F.md5(cleaned))


def shaped(statements: DataFrame) -> DataFrame:
    """Statements with the shape of their text and its number; see ``with_shape``."""
    return with_shape(statements.withColumn("text", clean_statement(F.col("SELECT_STATEMENT"))))


def distinct_shapes(keyed: DataFrame) -> DataFrame:
    """One row per shape of texts of statements (h, shape, number): (h, n_copies, has_number, text),
    where ``text`` is the shape.

    The lineage of a statement depends on its shape only, but for the number in its
    names, so texts are folded before any other work; the fold is partial on the map side,
    in a hash table of shapes, so a shape that makes up a large share of the rows is one row
    per task in the exchange.
    """
    return keyed.groupBy("h", F.col("shape").alias("text")).agg(
        F.count("*").alias("n_copies"), F.max(F.col("number") != STAND_IN).alias("has_number")
    )


def read_shapes(texts: DataFrame) -> DataFrame:
    """Shapes (h, n_copies, has_number, text) with sql, parse_error and toks.

    ``sql`` is the text that can be read: as given, or after the rewrites for
    dynamic SQL; NULL with an error where neither can. ``toks`` are its tokens.
    """
    texts = texts.repartition("h")
    rewritten = F.when(F.col("error_1").isNotNull(), normalize_dynamic_sql(F.col("text")))
    texts = (
        texts.withColumn("frame", frame(plain_blanks(F.col("text"))))
        .withColumn("error_1", F.coalesce(foreign_mark(F.col("text")), frame_error(F.col("frame"))))
        .withColumn("rewritten", rewritten)
        .withColumn("frame", frame(plain_blanks(F.col("rewritten"))))
        .withColumn("error_2", F.coalesce(foreign_mark(F.col("text")), frame_error(F.col("frame"))))
        .withColumn(
            "sql",
            F.when(F.col("error_1").isNull(), F.col("text"))
            .when(F.col("error_2").isNull(), F.col("rewritten")),
        )
    )
    plain = without_partition_clause(
        F.regexp_replace(plain_blanks(F.col("sql")), r"[\s;]+$", "")
    )
    return texts.withColumn("marked", mark_placeholders(plain)).select(
        "h", "n_copies", "has_number", "text", "sql",
        F.when(
            F.col("sql").isNull(), F.concat("error_1", F.lit(" | normalized: "), "error_2")
        ).alias("parse_error"),
        token_array(F.col("marked")).alias("toks"),
    )


OTHER_WORDS = ["USING", "CONNECT", "LIMIT", "FETCH", "OFFSET", "FOR"]
#: what a token has in common with those before it, back to the last that changes anything
CARRIED = ["dp", "qd", "spos", "bpos", "bdp", "cpos", "item", "clause"]
#: what only such a token has
OWN = ["comma", "closes", "prv_match_before"]


def _rows(window):
    """Running frame by rows; the default frame by values compares more."""
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _flag(condition):
    return F.when(condition, 1).otherwise(0)


def _with_neighbours(texts: DataFrame) -> DataFrame:
    """One row per token with the words around it, and whether it opens a query."""

    def near(step):
        return F.when(F.col("pos") + step >= 0, F.get("toks", F.col("pos") + step))

    def begins_query(word, after):
        return word.isin("SELECT", "WITH") | ((word == "(") & after.isin("SELECT", "WITH"))

    nxt, nxt2 = F.upper("nxt_tok"), F.upper("nxt_tok2")
    opens = (F.col("tok") == "(") & F.coalesce(begins_query(nxt, nxt2), F.lit(False))
    return (
        texts.select("h", "toks", F.posexplode("toks").alias("pos", "tok"))
        .select(
            "h", "pos", "tok", F.upper("tok").alias("u"),
            near(-1).alias("prv_tok"), near(-2).alias("prv_tok2"),
            near(1).alias("nxt_tok"), near(2).alias("nxt_tok2"),
            F.coalesce(begins_query(F.upper(near(2)), F.upper(near(3))), F.lit(False)).alias("_then"),
        )
        .withColumn("prv", F.upper("prv_tok"))
        .withColumn("nxt", F.upper("nxt_tok"))
        .withColumn("isq", opens)
        .withColumn("opens_next", F.coalesce((F.col("nxt_tok") == "(") & F.col("_then"), F.lit(False)))
        .drop("_then")
    )


def _changes_state():
    """Tokens at which brackets, blocks or clauses can change, the one behind a closing
    bracket, where the outer scope goes on, and the one before an opening bracket."""
    return (
        F.col("u").isin(
            "(", ")", ",", "SELECT", "FROM", "JOIN", "ON", "WHERE", "HAVING", "WINDOW", "QUALIFY",
            "GROUP", "ORDER", *JOIN_WORDS, "OUTER", *SET_WORDS, *OTHER_WORDS, "START",
        )
        | F.coalesce((F.col("prv_tok") == ")") | (F.col("nxt_tok") == "("), F.lit(False))
        | (F.col("pos") == 0)
    )


def _with_depth(tokens: DataFrame) -> DataFrame:
    """Bracket depth."""
    running = _rows(Window.partitionBy("h").orderBy("pos"))
    opened, closed = _flag(F.col("u") == "("), _flag(F.col("u") == ")")
    return tokens.withColumn(
        "dp", F.sum(opened).over(running) - F.sum(closed).over(running) + closed
    )


def _with_scope(tokens: DataFrame) -> DataFrame:
    """Number of query brackets around a token and the innermost one."""
    by_depth = _rows(Window.partitionBy("h", "dp").orderBy("pos"))
    by_pos = Window.partitionBy("h").orderBy("pos")
    running = _rows(by_pos)
    matching = F.last(
        F.when(F.col("u") == "(", F.struct("pos", "isq", F.col("prv_tok").alias("before"))), True
    ).over(by_depth)
    closes = F.when((F.col("u") == ")") & F.col("match.isq"), F.col("match.pos"))
    left = F.coalesce(_flag(F.lag("closes").over(by_pos).isNotNull()), F.lit(0))
    return (
        tokens.withColumn("match", matching)
        .withColumn("closes", closes)
        .withColumn("match_before", F.when(F.col("u") == ")", F.col("match.before")))
        .drop("match")
        .withColumn("left_query", left)
        .withColumn("prv_match_before", F.lag("match_before").over(by_pos))
        .withColumn(
            "qd", F.sum(_flag(F.col("isq"))).over(running) - F.sum("left_query").over(running)
        )
        .drop("left_query", "match_before")
    )


def _with_block(tokens: DataFrame) -> DataFrame:
    """Scope, block and clause of each token.

    ``bpos`` is the position of the block's SELECT, ``cpos`` of the word that
    opened the clause, ``item`` the number of commas since then at block depth.
    """
    in_scope = _rows(Window.partitionBy("h", "qd").orderBy("pos"))
    scope = F.last(F.when(F.col("isq"), F.col("pos")), True).over(in_scope)
    select = F.last(F.when(F.col("u") == "SELECT", F.struct("pos", "dp")), True).over(in_scope)
    own = (F.col("dp") == F.col("bdp")) & F.col("bpos").isNotNull()
    u, nxt = F.col("u"), F.col("nxt")
    opens = (
        F.when(u == "SELECT", "PROJECTION")
        .when(u.isin("FROM", "JOIN"), "FROM")
        .when(u.isin(JOIN_WORDS) & nxt.isin("JOIN", "OUTER", *JOIN_WORDS), "FROM")
        .when(u.isin("CROSS", "OUTER") & (nxt == "APPLY"), "FROM")
        .when(u == "ON", "JOIN_ON")
        .when(u.isin("WHERE", "HAVING", "WINDOW", "QUALIFY"), u)
        .when((u == "GROUP") & (nxt == "BY"), "GROUP_BY")
        .when((u == "ORDER") & nxt.isin("BY", "SIBLINGS"), "ORDER_BY")
        .when(u.isin(SET_WORDS), "SET")
        .when(
            u.isin(OTHER_WORDS)
            | ((u == "START") & (nxt == "WITH")),
            "OTHER",
        )
    )
    # a closing bracket around a branch of a set operation ends its last clause
    opens = F.when(own, opens).when(F.col("dp") < F.col("bdp"), F.lit("SET"))
    return (
        tokens.withColumns({"scope": scope, "sel": select})
        .withColumn("spos", F.when(F.col("qd") > 0, F.col("scope")).otherwise(F.lit(-1)))
        .withColumn("bpos", F.when(F.col("sel.pos") > F.col("spos"), F.col("sel.pos")))
        .withColumn("bdp", F.when(F.col("bpos").isNotNull(), F.col("sel.dp")))
        .drop("sel", "scope")
        .withColumn("comma", (u == ",") & own)
        .withColumn("commas", F.sum(_flag(F.col("comma"))).over(in_scope))
        .withColumn("opens", opens)
        .withColumn(
            "at",
            F.last(F.when(F.col("opens").isNotNull(), F.struct("pos", "opens", "commas")), True)
            .over(in_scope),
        )
        .withColumn("at", F.when(F.col("at.pos") >= F.col("bpos"), F.col("at")))
        .withColumn("cpos", F.col("at.pos"))
        .withColumn("item", (F.col("commas") - F.col("at.commas")).cast("int"))
        .withColumn(
            "clause",
            # a comma after ON goes back to the list of sources
            F.when((F.col("at.opens") == "JOIN_ON") & (F.col("item") > 0), F.lit("FROM"))
            .otherwise(F.col("at.opens")),
        )
        .drop("at", "commas", "opens")
    )


def token_table(texts: DataFrame) -> DataFrame:
    tokens = _with_neighbours(texts)
    few = _with_block(_with_scope(_with_depth(tokens.filter(_changes_state()))))
    state = F.struct(*CARRIED).alias("state")
    # by merge: its order serves the window below, and texts unfold to far more than their files
    found = few.select("h", "pos", state, *OWN).hint("merge")
    marked = tokens.join(found, ["h", "pos"], "left")
    running = _rows(Window.partitionBy("h").orderBy("pos"))
    carried = marked.withColumn("here", F.col("state").isNotNull()).withColumn(
        "state", F.last("state", True).over(running)
    )
    # below the block's own depth (around branches of a set operation) each token stands for itself
    alone = ~F.col("here") & F.coalesce(F.col("state.dp") < F.col("state.bdp"), F.lit(False))
    changed = {"cpos": F.col("pos"), "item": F.lit(0)}
    return carried.select(
        *tokens.columns, *OWN[1:], F.coalesce("comma", F.lit(False)).alias("comma"),
        *[
            (F.when(alone, changed[c]).otherwise(F.col(f"state.{c}")) if c in changed
             else F.col(f"state.{c}")).alias(c)
            for c in CARRIED
        ],
    )
