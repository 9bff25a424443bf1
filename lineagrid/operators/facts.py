"""Blocks, scopes, sources, outputs, references and predicates.

Every table is derived from the token table by filters, grouping and windows
inside one statement, and is keyed by the text key ``h``; a block is named by
the position of its SELECT (``bpos``), a scope by that of its bracket
(``spos``, -1 for the statement itself).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.functions.text import unmark_placeholders
from lineagrid.functions.words import (
    AFTER_PIVOT, BETWEEN_OPERANDS, CLAUSES, CONTENT_CALLS, CONTENT_WORDS, NAMING_CALLS, PIVOTS,
    SET_WORDS, UNIT_CALLS, UNITS, ZONES, ends_operand, in_phrase, is_literal, is_name, name_parts,
)
from lineagrid.session import keep_bucketed

NO_POS = -1


def _words_of_calls():
    """Two conditions on a name: that it is a word of the function around it, as NAME in
    XMLELEMENT(NAME e, ...), and that an operand must stand there, as x in
    JSON_OBJECT(KEY 'k' VALUE x), though the word before it looks like one."""
    u, prv, nxt = F.col("u"), F.col("prv"), F.coalesce("nxt", F.lit(""))
    prv2, nxt2 = F.upper("prv_tok2"), F.upper("nxt_tok2")
    inside = F.col("dp") > F.col("bdp")
    operand_follows = is_name(F.col("nxt_tok")) | is_literal(F.col("nxt_tok"))
    # KEY is a column itself if VALUE comes at once: JSON_OBJECT(key VALUE x)
    key = (u == "KEY") & prv.isin("(", ",") & operand_follows & (
        (nxt != "VALUE") | nxt2.isin("VALUE", "IS")
    )
    word = (
        ((prv == "(") & prv2.isin(NAMING_CALLS))
        | ((prv == "(") & prv2.isin(CONTENT_CALLS) & u.isin(CONTENT_WORDS) & operand_follows)
        | ((prv == "(") & prv2.isin(UNIT_CALLS) & u.isin(UNITS) & (nxt == ","))
        | ((prv == "BY") & (prv2 == "PASSING"))
        | (prv == "USING")
        | key
    )
    operand = (
        (prv.isin(BETWEEN_OPERANDS) & (ends_operand(F.col("prv_tok2")) | (prv2 == "BY")))
        | (prv.isin("EVALNAME", *CONTENT_WORDS) & (prv2 == "("))
        | ((prv == "KEY") & prv2.isin("(", ",") & ((u != "VALUE") | nxt.isin("VALUE", "IS")))
    )
    zone = (prv == "ZONE") & (prv2 == "TIME")
    no = F.lit(False)
    return (
        F.coalesce((inside & word) | (zone & u.isin(ZONES)), no),
        F.coalesce((inside & operand) | zone, no),
    )


def with_references(tokens: DataFrame) -> DataFrame:
    """Mark the tokens that name a column of the clause they stand in."""
    word_of_call, operand = _words_of_calls()
    tok, u, prv, nxt = F.col("tok"), F.col("u"), F.col("prv"), F.coalesce("nxt", F.lit(""))
    unit_of_extract = (prv == "(") & (F.upper("prv_tok2") == "EXTRACT") & (nxt == "FROM")
    typed_literal = u.isin("DATE", "TIMESTAMP", "INTERVAL", "N") & is_literal(nxt)
    named_window = ((F.col("clause") == "WINDOW") & (nxt == "AS")) | (prv == "OVER")
    after_join = (F.col("clause") == "JOIN_ON") & (F.col("cpos") == F.col("pos") - 1)
    return tokens.withColumn(
        "is_ref",
        F.coalesce(
            F.col("clause").isin(CLAUSES)
            & is_name(tok)
            & ~nxt.isin("(", "=>")
            & ~tok.endswith("*")
            & (prv != "AS")
            & (operand | ~ends_operand(F.col("prv_tok")))
            & ~word_of_call
            & ~unit_of_extract
            & ~typed_literal
            & (after_join | ~in_phrase(prv, u))
            & ~named_window,
            F.lit(False),
        ),
    )


def _pivots(word, after):
    return F.coalesce(F.upper(word).isin(PIVOTS) & F.upper(after).isin(AFTER_PIVOT), F.lit(False))


def pivots_of(tokens: DataFrame) -> DataFrame:
    """(h, pivot_pos, pivot_alias): where a source is turned by PIVOT or UNPIVOT, once or
    several times in a row, and the name it has from there, which stands behind the brackets."""
    tok = F.col("tok")
    turns = _pivots(tok, F.col("nxt_tok"))
    behind = F.coalesce(
        (F.col("prv") == ")") & F.upper("prv_match_before").isin(*PIVOTS, "XML", "NULLS"), F.lit(False)
    )
    name = F.when(F.col("u") == "AS", F.col("nxt_tok")).when(is_name(tok) & ~turns, tok)
    running = Window.partitionBy("h", "bpos").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        tokens.filter(
            (F.col("clause") == "FROM") & (F.col("dp") == F.col("bdp")) & (turns | behind)
        )
        .select(
            "h", "bpos", "pos", (turns & ~behind).cast("int").alias("first"),
            F.when(behind, F.element_at(name_parts(name), -1)).alias("name"),
        )
        .withColumn("nth", F.sum("first").over(running))
        .groupBy("h", "bpos", "nth")
        .agg(F.min("pos").alias("pivot_pos"), F.max("name").alias("pivot_alias"))
        .select("h", "pivot_pos", "pivot_alias")
    )


def _alias_behind():
    """(alias, number of its tokens) of the source that ends at a token."""
    after = F.when(F.col("nxt") == "AS", F.col("nxt_tok2")).otherwise(F.col("nxt_tok"))
    # t AS OF SCN 1 names a time, not an alias
    at_time = (F.col("nxt") == "AS") & (F.upper("nxt_tok2") == "OF")
    given = is_name(after) & ~F.coalesce(at_time, F.lit(False)) & ~_pivots(
        F.col("nxt_tok"), F.col("nxt_tok2")
    )
    return (
        F.when(given, F.element_at(name_parts(after), -1)),
        F.when(given, F.when(F.col("nxt") == "AS", 2).otherwise(1)).otherwise(0),
    )


def scopes_of(tokens: DataFrame, pivots: DataFrame) -> DataFrame:
    """Query brackets: where they stand, what they are and their alias.

    kind: CTE, SOURCE (in FROM, also behind LATERAL or APPLY), BRANCH (a bracketed part of a set operation)
    or EXPR (anywhere else).
    """
    u, prv = F.col("u"), F.col("prv")
    cte = (u == "AS") & F.col("bpos").isNull()
    lateral = (u == "LATERAL") & prv.isin("FROM", "JOIN", ",")
    applied = (u == "APPLY") & prv.isin("CROSS", "OUTER")
    source = (
        (u.isin("FROM", "JOIN", ",") | lateral | applied) & (F.col("clause") == "FROM") & (F.col("dp") == F.col("bdp"))
    )
    branch = u.isin(SET_WORDS) | (u.isin("ALL", "DISTINCT") & prv.isin(SET_WORDS)) | F.col("isq")
    kind = (
        F.when(cte, "CTE").when(source, "SOURCE").when(branch, "BRANCH").otherwise("EXPR")
    )
    cte_name = F.when(prv == ")", F.col("prv_match_before")).otherwise(F.col("prv_tok"))
    nothing = F.lit(None)
    here = F.struct(
        (F.col("pos") + 1).alias("spos"), F.col("spos").alias("outer_spos"),
        F.col("bpos").alias("outer_bpos"), F.col("clause").alias("outer_clause"),
        F.col("item").alias("outer_item"), u.alias("word"),
        F.when(u.isin(SET_WORDS), u).otherwise(prv).alias("set_word"), kind.alias("kind"),
        F.when(cte, F.element_at(name_parts(cte_name), -1)).alias("cte_name"),
    )
    # a statement may begin with a bracket, which no token stands before
    leading = F.struct(
        F.col("pos").alias("spos"), F.lit(NO_POS).alias("outer_spos"),
        nothing.cast("int").alias("outer_bpos"), nothing.cast("string").alias("outer_clause"),
        nothing.cast("int").alias("outer_item"), nothing.cast("string").alias("word"),
        nothing.cast("string").alias("set_word"), F.lit("BRANCH").alias("kind"),
        nothing.cast("string").alias("cte_name"),
    )
    at_start = F.col("isq") & (F.col("pos") == 0)
    outer = tokens.filter(F.col("opens_next") | at_start).select(
        "h",
        F.inline(F.array_compact(F.array(
            F.when(F.col("opens_next"), here), F.when(at_start, leading)
        ))),
    )
    alias, width = _alias_behind()
    ends = tokens.filter(F.col("closes").isNotNull()).select(
        "h", F.col("closes").alias("spos"), F.col("pos").alias("end_pos"), alias.alias("alias"),
        (F.col("pos") + 1 + width).alias("pivot_pos"),
    )
    return (
        outer.join(ends, ["h", "spos"], "left")
        .join(pivots, ["h", "pivot_pos"], "left")
        .withColumn("alias", F.coalesce("pivot_alias", "alias"))
        .drop("pivot_pos", "pivot_alias")
        .withColumn(
            "alias",
            F.when(F.col("kind") == "CTE", F.col("cte_name"))
            .when(F.col("kind").isin("SOURCE", "EXPR"), F.col("alias")),
        )
        .drop("cte_name")
    )


def blocks_of(tokens: DataFrame, scopes: DataFrame) -> DataFrame:
    """One row per SELECT with its place in the statement.

    A branch in brackets counts as a block of the enclosing scope. ``head`` is
    where the block's text starts: at its WITH, if it is alone in its scope.
    """
    selects = tokens.filter((F.col("u") == "SELECT") & (F.col("pos") == F.col("bpos")))
    word2 = F.upper("prv_tok2")
    selects = selects.select(
        "h", "bpos", "bdp", F.col("spos").alias("own_spos"), F.col("qd").cast("int").alias("qd"),
        F.when(F.col("prv").isin(SET_WORDS), F.col("prv"))
        .when(F.col("prv").isin("ALL", "DISTINCT") & word2.isin(SET_WORDS), word2)
        .alias("set_word"),
    )
    cut = tokens.filter((F.col("clause") == "SET") & F.col("bpos").isNotNull()).groupBy(
        "h", "bpos"
    ).agg(F.min("pos").alias("cut"))
    last = tokens.groupBy("h").agg(F.max("pos").alias("last_pos"))
    branch = scopes.filter("kind = 'BRANCH'").select(
        "h", F.col("spos").alias("own_spos"), F.col("outer_spos").alias("up_1"),
        F.col("set_word").alias("branch_word"),
    )
    up = branch.select("h", F.col("own_spos").alias("up_1"), F.col("up_1").alias("up_2"))
    home = scopes.select(
        "h", "spos", F.col("end_pos").alias("scope_end"), "outer_spos", "outer_bpos", "kind",
        "word", F.col("alias").alias("scope_alias"),
    )
    own_end = scopes.select("h", F.col("spos").alias("own_spos"), F.col("end_pos").alias("own_end"))
    in_scope = Window.partitionBy("h", "spos").orderBy("bpos")
    scope_all = Window.partitionBy("h", "spos")
    kind_of = lambda word: F.when(word == "MINUS", "EXCEPT").otherwise(word)
    set_type = F.when(
        F.col("branch_no") == 1,
        F.concat(kind_of(F.lead("set_word").over(in_scope)), F.lit("_LEFT")),
    ).otherwise(F.concat(kind_of(F.col("set_word")), F.lit("_RIGHT")))
    # read three times below, so it is kept
    placed = keep_bucketed(
        selects.join(cut, ["h", "bpos"], "left")
        .join(last, "h")
        .join(branch, ["h", "own_spos"], "left")
        .join(up, ["h", "up_1"], "left")
        .join(own_end, ["h", "own_spos"], "left")
        .withColumn("spos", F.coalesce("up_2", "up_1", "own_spos"))
        .withColumn("set_word", F.coalesce("set_word", "branch_word"))
        .join(home, ["h", "spos"], "left")
        .withColumn("branch_no", F.row_number().over(in_scope))
        .withColumn("n_branches", F.count("*").over(scope_all))
        .withColumn("n_own", F.count("*").over(Window.partitionBy("h", "own_spos")))
        .withColumn("set_type", set_type)
        .withColumn("first_bpos", F.min("bpos").over(scope_all))
        .withColumn(
            "tail",
            F.coalesce(F.col("cut") - 1, F.col("own_end") - 1, F.col("last_pos")),
        )
        .withColumn(
            "head",
            F.when(
                (F.col("n_branches") == 1) & (F.col("own_spos") == F.col("spos")),
                F.col("spos") + 1,
            ).otherwise(F.col("bpos")),
        ),
        "placed",
    )
    firsts = placed.filter("branch_no = 1").select(
        "h", F.col("spos").alias("outer_spos"), F.col("bpos").alias("outer_first")
    )
    root_bpos = F.min(F.when(F.col("spos") == NO_POS, F.col("bpos"))).over(Window.partitionBy("h"))
    block_type = (
        F.when(F.col("n_branches") > 1, F.col("set_type"))
        .when(F.col("spos") == NO_POS, "ROOT_SELECT")
        .when(F.col("kind") == "CTE", "CTE")
        .when(F.col("word").isin("EXISTS", "ANY", "ALL", "SOME"), "SELECT")
        .otherwise("SUBQUERY")
    )
    # a WITH belongs after the block it serves
    preorder = Window.partitionBy("h").orderBy(
        (F.col("bpos") < F.col("root_bpos")).cast("int"), "bpos"
    )
    return (
        placed.join(firsts, ["h", "outer_spos"], "left")
        .withColumn("root_bpos", root_bpos)
        .withColumn("block_id", F.row_number().over(preorder))
        .select(
            "h", "bpos", "bdp", "spos", "branch_no", "n_branches", "head", "tail", "block_id",
            ((F.col("own_spos") != F.col("spos")) & (F.col("n_own") == 1)).alias("bracketed"),
            F.coalesce("outer_bpos", "outer_first").alias("parent_bpos"),
            F.col("qd").alias("level_no"), block_type.alias("block_type"),
            F.when(F.col("n_branches") == 1, F.coalesce("scope_alias", F.lit("")))
            .otherwise(F.lit("")).alias("alias_name"),
            F.when((F.col("spos") == NO_POS) & (F.col("branch_no") == 1), 1).otherwise(0)
            .alias("is_root"),
        )
    )


def table_mentions(tokens: DataFrame, pivots: DataFrame) -> DataFrame:
    """Every table name in a FROM list, CTE names included, numbered by place."""
    parts = F.col("parts")
    alias, width = _alias_behind()
    part = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    return (
        tokens.filter(
            (F.col("clause") == "FROM")
            & F.col("prv").isin("FROM", "JOIN", ",")
            & (F.col("dp") == F.col("bdp"))
            & is_name(F.col("tok"))
            & (F.coalesce("nxt", F.lit("")) != "(")
        )
        .withColumn("parts", name_parts(F.col("tok")))
        .select(
            "h", "bpos", "pos", part(-1).alias("name"), part(-2).alias("db"),
            part(-3).alias("cat"),
            alias.alias("given_alias"), width.alias("alias_width"),
            (F.col("pos") + 1 + width).alias("pivot_pos"),
        )
        .join(pivots, ["h", "pivot_pos"], "left")
        .withColumn("sch", F.when(F.col("db") != "", F.col("db")).otherwise(F.col("cat")))
        .withColumn("alias", F.coalesce("pivot_alias", "given_alias", "name"))
        .drop("db", "given_alias", "pivot_pos", "pivot_alias")
    )


def ctes_of(scopes: DataFrame) -> DataFrame:
    """(h, name, target): flat per statement, the last definition wins."""
    return (
        scopes.filter("kind = 'CTE'")
        .groupBy("h", F.lower("alias").alias("cte_name"))
        .agg(F.max("spos").alias("target"))
    )


def tables_with_cte(mentions: DataFrame, ctes: DataFrame) -> DataFrame:
    """Mentions with the CTE they name, if any, and a running number among the
    mentions that name a stored table."""
    by_pos = Window.partitionBy("h").orderBy("pos")
    return (
        mentions.withColumn("cte_name", F.lower("name"))
        .join(ctes, ["h", "cte_name"], "left")
        .drop("cte_name")
        .withColumn("n_all", F.row_number().over(by_pos))
        .withColumn("n_stored", F.count(F.when(F.col("target").isNull(), 1)).over(by_pos))
    )


def block_ranges(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """Per block, the numbers of the first and last table mention beneath it.

    Block borders and mentions are sorted once and counted with running sums,
    so deep nesting costs no pairs of blocks and tables.
    """
    borders = blocks.select(
        "h", "bpos", F.explode(F.array(
            F.struct(F.col("head").alias("pos"), F.lit(0).alias("side")),
            F.struct(F.col("tail").alias("pos"), F.lit(2).alias("side")),
        )).alias("b"),
    ).select("h", "bpos", "b.*")
    marks = tables.select(
        "h", "pos", F.lit(1).alias("side"), F.lit(1).alias("one"),
        F.when(F.col("target").isNull(), 1).otherwise(0).alias("stored"),
    )
    running = Window.partitionBy("h").orderBy("pos", "side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        borders.unionByName(marks, allowMissingColumns=True)
        .withColumn("n_all", F.coalesce(F.sum("one").over(running), F.lit(0)))
        .withColumn("n_stored", F.coalesce(F.sum("stored").over(running), F.lit(0)))
        .filter("bpos IS NOT NULL")
        .groupBy("h", "bpos")
        .agg(
            F.min("n_all").alias("all_from"), F.max("n_all").alias("all_to"),
            F.min("n_stored").alias("stored_from"), F.max("n_stored").alias("stored_to"),
        )
    )


def sources_of(
    blocks: DataFrame, scopes: DataFrame, tables: DataFrame, ranges: DataFrame
) -> DataFrame:
    """FROM entries of each block: kind T (table), C (CTE) or S (sub-query).

    A block without any entry takes every table beneath it instead.
    """
    named = tables.select(
        "h", "bpos", "pos", F.when(F.col("target").isNull(), "T").otherwise("C").alias("kind"),
        "cat", "sch", "name", "alias", "target", F.lit(False).alias("borrowed"),
    )
    nested = scopes.filter("kind = 'SOURCE'").select(
        "h", F.col("outer_bpos").alias("bpos"), F.col("spos").alias("pos"), F.lit("S").alias("kind"),
        F.lit("").alias("cat"), F.lit("").alias("sch"), F.lit("").alias("name"), "alias",
        F.col("spos").alias("target"), F.lit(False).alias("borrowed"),
    )
    own = named.unionByName(nested)
    bare = (
        blocks.select("h", "bpos")
        .join(own.select("h", "bpos").distinct(), ["h", "bpos"], "left_anti")
        .join(ranges.filter("all_to > all_from"), ["h", "bpos"])
        .select("h", "bpos", F.explode(F.sequence(F.col("all_from") + 1, "all_to")).alias("n_all"))
    )
    borrowed = bare.join(tables.drop("bpos"), ["h", "n_all"]).select(
        "h", "bpos", "pos", F.lit("T").alias("kind"), "cat", "sch", "name", "alias", "target",
        F.lit(True).alias("borrowed"),
    )
    return own.unionByName(borrowed)


def segments_of(tokens: DataFrame, blocks: DataFrame) -> DataFrame:
    """Clauses of a block as token ranges [cpos, end]."""
    in_block = Window.partitionBy("h", "bpos").orderBy("pos")
    return (
        tokens.filter(
            (F.col("pos") == F.col("cpos")) | (F.col("comma") & (F.col("clause") == "FROM"))
        )
        .select("h", "bpos", "pos", "clause", "nxt")
        .withColumn("next_pos", F.lead("pos").over(in_block))
        .join(blocks.select("h", "bpos", "tail"), ["h", "bpos"])
        .select(
            "h", "bpos", F.col("pos").alias("cpos"), "clause",
            F.coalesce(F.col("next_pos") - 1, F.col("tail")).alias("end"),
            F.when(F.col("nxt").isin("DISTINCT", "UNIQUE", "ALL") & (F.col("clause") == "PROJECTION"),
                   1).otherwise(0).alias("skip"),
        )
    )


def outputs_of(tokens: DataFrame, segments: DataFrame, refs: DataFrame, scopes: DataFrame) -> DataFrame:
    """Output columns of each block: name, star, and whether columns feed it.

    ``start``/``end`` give the token range without the alias.
    """
    content = ~(F.col("comma") | (F.col("u") == "SELECT")
                | (F.col("u").isin("DISTINCT", "UNIQUE", "ALL") & (F.col("prv") == "SELECT")))
    top = content & (F.col("dp") == F.col("bdp"))
    last = F.max_by(F.struct("tok", "prv_tok", "pos", "u"), F.when(top, F.col("pos")))
    items = (
        tokens.filter("clause = 'PROJECTION'")
        .groupBy("h", "bpos", "cpos", "item")
        .agg(
            F.min("pos").alias("sep"),
            F.count(F.when(content, 1)).alias("n_toks"),
            F.max(F.col("opens_next").cast("int")).alias("nested"),
            last.alias("last"),
            F.max(F.when(top & (F.col("u") == "AS"), F.struct("pos", "nxt_tok"))).alias("as_"),
            F.count(F.when(F.col("is_ref"), 1)).alias("n_cols"),
        )
        .join(segments.select("h", "bpos", "cpos", "end", "skip"), ["h", "bpos", "cpos"])
    )
    in_block = Window.partitionBy("h", "bpos").orderBy("item")
    last_tok = F.col("last.tok")
    one = (F.col("n_toks") == 1) & (F.col("nested") == 0)
    star = one & last_tok.endswith("*")
    implicit = (
        is_name(last_tok) & ~last_tok.contains(".") & ends_operand(F.col("last.prv_tok"))
    )
    name = (
        F.when(star, F.lit(None))
        .when(F.col("as_").isNotNull(), F.element_at(name_parts(F.col("as_.nxt_tok")), -1))
        .when(implicit | (one & is_name(last_tok)), F.element_at(name_parts(last_tok), -1))
    )
    fed = (
        scopes.filter("kind = 'EXPR' AND outer_clause = 'PROJECTION'")
        .select("h", "spos", F.col("outer_bpos").alias("bpos"), F.col("outer_item").alias("item"))
        .join(refs.select("h", F.col("own_spos").alias("spos")).distinct(), ["h", "spos"], "left_semi")
        .select("h", "bpos", "item", F.lit(1).alias("fed")).distinct()
    )
    return (
        items.withColumn("next_sep", F.lead("sep").over(in_block))
        .join(fed, ["h", "bpos", "item"], "left")
        .select(
            "h", "bpos", F.col("item").alias("out_no"),
            unmark_placeholders(name).alias("out_name"),
            star.alias("is_star"),
            F.when(star & last_tok.contains("."),
                   F.element_at(name_parts(last_tok), -2)).alias("star_alias"),
            "n_cols", ((F.col("n_cols") > 0) | F.col("fed").isNotNull()).alias("has_col"),
            (F.col("sep") + 1 + F.when(F.col("item") == 0, F.col("skip")).otherwise(0)).alias("start"),
            F.coalesce(F.col("next_sep") - 1, F.col("end")).alias("full_end"),
            F.when(F.col("as_").isNotNull(), F.col("as_.pos") - 1)
            .when(implicit, F.col("last.pos") - 1)
            .otherwise(F.coalesce(F.col("next_sep") - 1, F.col("end"))).alias("end"),
        )
    )


def references_of(tokens: DataFrame) -> DataFrame:
    """Column mentions: (h, bpos, pos, clause, cpos, item, qual, name)."""
    parts = name_parts(F.col("tok"))
    return (
        tokens.filter("is_ref")
        .select(
            "h", "bpos", F.col("spos").alias("own_spos"), "pos", "tok", "clause", "cpos", "item",
            parts.alias("parts"),
        )
        .withColumn("name", F.element_at("parts", -1))
        .withColumn("qual", F.coalesce(F.try_element_at("parts", F.lit(-2)), F.lit("")))
        .drop("parts")
    )


def predicates_of(tokens: DataFrame, segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conditions of WHERE and ON cut at their top-level ANDs.

    Returns the predicates as token ranges, and for the references and nested
    queries inside them (h, bpos, pos, pred) with the predicate's position.
    """
    seg = Window.partitionBy("h", "bpos", "cpos")
    by_pos = seg.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = seg.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    u = F.col("u")
    case_depth = F.coalesce(
        F.sum(F.when(u == "CASE", 1).when(u == "END", -1)).over(by_pos), F.lit(0)
    )
    marks = (
        tokens.filter(
            F.col("clause").isin("WHERE", "JOIN_ON")
            & (u.isin("AND", "OR", "BETWEEN", "CASE", "END") | F.col("is_ref") | F.col("opens_next"))
        )
        .select("h", "bpos", "cpos", "pos", "u", "is_ref", "opens_next",
                (F.col("dp") == F.col("bdp")).alias("top"))
        .withColumn("case_depth", case_depth)
        .withColumn(
            "k", F.when(F.col("top") & (F.col("case_depth") == 0) & u.isin("AND", "OR", "BETWEEN"), u)
        )
        .withColumn("prev_k", F.last("k", True).over(before))
        .withColumn("has_or", F.coalesce(F.max(F.when(F.col("k") == "OR", 1)).over(seg), F.lit(0)))
        .withColumn(
            "cut",
            F.when(
                (F.col("k") == "AND") & (F.coalesce("prev_k", F.lit("")) != "BETWEEN")
                & (F.col("has_or") == 0), F.col("pos"),
            ),
        )
        .withColumn("pred", F.coalesce(F.last("cut", True).over(by_pos), "cpos"))
    )
    starts = segments.filter(F.col("clause").isin("WHERE", "JOIN_ON"))
    cuts = marks.filter("cut IS NOT NULL").select("h", "bpos", "cpos", F.col("cut").alias("pred"))
    in_seg = seg.orderBy("pred")
    predicates = (
        starts.select("h", "bpos", "cpos", F.col("cpos").alias("pred"))
        .unionByName(cuts)
        .withColumn("next_pred", F.lead("pred").over(in_seg))
        .join(starts.select("h", "bpos", "cpos", "clause", "end"), ["h", "bpos", "cpos"])
        .select(
            "h", "bpos", "pred", "clause", (F.col("pred") + 1).alias("start"),
            F.coalesce(F.col("next_pred") - 1, F.col("end")).alias("end"),
        )
    )
    inside = marks.filter("is_ref OR opens_next").select(
        "h", "bpos", "pos", "pred", "is_ref", "opens_next"
    )
    return predicates, inside
