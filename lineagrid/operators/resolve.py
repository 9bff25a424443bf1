"""Column mentions to physical columns.

Every different mention (block, qualifier, name) is classified once against an
ordered list of rules. A rule either names a table or hands the name on to
other blocks; the latter are edges of a graph whose nodes are mentions again,
because whatever feeds an output column is itself a mention of its own block.
A closure over those edges ends at the tables.

A trace gives one row for every way from the mention to a table. Equal physical
columns are folded where branches of a set operation, several scopes or nested
queries are looked through together, and below; not where they meet in the
expression of one output. The guard against cycles works along one path: a
mention whose trace comes back to where it entered a cycle is looked up once more
without tracing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.functions.text import text_alias_pairs, text_table_refs, unmark_placeholders
from lineagrid.operators.closure import contained, follow, union_all
from lineagrid.operators.scopes import EVERY_NAME, tables_beneath
from lineagrid.session import keep, keep_bucketed, together

TABLE_TYPE = "struct<cat:string,sch:string,name:string>"
# Rules whose result depends on who asks: see `for_conditions` and `for_report`.
GUESSES = ["FIRST_TABLE", "NOTHING"]


def no_table() -> Column:
    return F.lit(None).cast(TABLE_TYPE)


def named_only(name: str) -> Column:
    """A table known by name alone; without a name, no table at all."""
    return F.struct(F.lit("").alias("cat"), F.lit("").alias("sch"), F.lit(name).alias("name"))


@dataclass
class Model:
    """The structural tables that resolution reads."""

    texts: DataFrame
    blocks: DataFrame
    info: DataFrame
    ranges: DataFrame
    tables: DataFrame
    sources: DataFrame
    keys: DataFrame
    ctes: DataFrame
    outputs: DataFrame
    refs: DataFrame
    scopes: DataFrame
    bases: DataFrame
    stars: DataFrame
    traceable: DataFrame
    all_scopes: DataFrame
    cyclic: DataFrame
    edges: DataFrame
    scan_text: bool = True


def node_id(prefix: str = "") -> Column:
    return F.concat_ws("|", F.lit(prefix), F.col("bpos").cast("string"), "q", "n")


def with_node(refs: DataFrame) -> DataFrame:
    return (
        refs.withColumn("q", F.lower("qual"))
        .withColumn("n", F.lower(unmark_placeholders(F.col("name"))))
        .withColumn("node", node_id())
    )


def scope_names(m: Model) -> DataFrame:
    """(h, s, n): traceable names of a scope over all its branches."""
    return m.traceable.join(m.blocks.select("h", "bpos", F.col("spos").alias("s")), ["h", "bpos"]).select(
        "h", "s", "n"
    ).distinct()


def scope_outcome(df: DataFrame, m: Model, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What looking up name ``n`` in scope ``s`` gives, in fixed order: a trace,
    a trace from nested blocks, the scope's base table for a star, a derived
    column, the single base table, a derived column again, the alias, nothing.

    ``df`` needs (h, s, n, q, alias_ok). Returns it with (outcome, table,
    reason), and the blocks (h, s, n, bpos) for outcome NESTED.
    """
    pairs = df.filter("s IS NOT NULL").select("h", "s", "n").distinct()
    exported = (
        m.outputs.filter("out_name IS NOT NULL")
        .join(m.blocks.select("h", "bpos", F.col("spos").alias("s")), ["h", "bpos"])
        .withColumn("n", F.lower("out_name"))
        .groupBy("h", "s", "bpos", "n").agg(F.min_by("has_col", "out_no").alias("has_col"))
        .groupBy("h", "s", "n").agg(F.max(~F.col("has_col")).alias("derived"))
        .withColumn("exported", F.lit(True))
    )
    any_name = names.filter(F.col("n") == EVERY_NAME).select("h", "s", F.lit(True).alias("any_name"))
    about = m.scopes.withColumnRenamed("spos", "s")
    pairs = keep(
        pairs.join(about, ["h", "s"], "left")
        .join(names.withColumn("by_name", F.lit(True)), ["h", "s", "n"], "left")
        .join(any_name, ["h", "s"], "left")
        .join(exported, ["h", "s", "n"], "left")
    )
    traced = F.col("by_name").isNotNull() | F.col("any_name").isNotNull()
    missing = pairs.filter(~traced).select(
        "h", "n", F.col("s").alias("low"), F.col("end_pos").alias("high")
    )
    inside = m.traceable.select("h", "n", F.col("bpos").alias("at"))
    by_name = contained(missing, inside.filter(F.col("n") != EVERY_NAME), ["h", "n"])
    any_of = contained(missing, inside.filter(F.col("n") == EVERY_NAME), ["h"])
    nested = keep(
        union_all([by_name, missing.join(any_of, ["h", "low", "high"])])
        .select("h", F.col("low").alias("s"), "n", F.col("at").alias("bpos"))
        .distinct()
    )
    pairs = pairs.join(
        nested.select("h", "s", "n", F.lit(True).alias("nested")).distinct(), ["h", "s", "n"], "left"
    )
    star_table = F.coalesce("single_table", "first_base")
    outcome = (
        F.when(traced, "TRACE")
        .when(F.col("nested").isNotNull(), "NESTED")
        .when(F.col("scope_star") & star_table.isNotNull(), "STAR")
        .when(F.col("derived"), "DERIVED")
        .when(F.col("single_table").isNotNull(), "SINGLE")
        .when(F.col("exported"), "DERIVED")
        .otherwise("NONE")
    )
    pairs = pairs.withColumn("outcome", outcome).select(
        "h", "s", "n", "outcome", "is_cte", "scope_star", "first_base", "has_bases",
        F.when(F.col("outcome") == "STAR", star_table)
        .when(F.col("outcome") == "DERIVED", named_only("dual"))
        .when(F.col("outcome") == "SINGLE", F.col("single_table")).alias("scope_table"),
        F.when(F.col("outcome") == "STAR", "SUBQUERY_STAR_FALLBACK")
        .when(F.col("outcome") == "DERIVED", "DERIVED_COLUMN")
        .otherwise("").alias("scope_reason"),
    )
    by_alias = (F.col("outcome") == "NONE") & ~F.col("is_cte") & (F.col("q") != "") & F.col("alias_ok")
    alias_table = F.struct(F.lit("").alias("cat"), F.lit("").alias("sch"), F.col("q").alias("name"))
    result = (
        df.join(pairs, ["h", "s", "n"], "left")
        .withColumn("scope_table", F.when(by_alias, alias_table).otherwise(F.col("scope_table")))
        .withColumn(
            "scope_reason",
            F.when(by_alias, F.lit("SUBQUERY_ALIAS_FALLBACK")).otherwise(F.col("scope_reason")),
        )
        .withColumn("outcome", F.when(by_alias, F.lit("ALIAS")).otherwise(F.col("outcome")))
    )
    return result, nested


def classify(nodes: DataFrame, m: Model, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply the rules that need no statement text.

    Result per node: ``rule``; ``table`` and ``reason`` where the rule ends
    here; ``act`` (TRACE, NESTED, ANY, BASES) and ``s`` where it goes on;
    ``tweak``, a reason to give to traced rows that carry none.
    """
    lone = m.tables.filter("target IS NULL").select(
        "h", F.col("n_stored").alias("lone_no"),
        F.struct("cat", "sch", "name").alias("lone"),
    )
    placed = (
        together(nodes.join(m.info.drop("spos"), ["h", "bpos"]))
        .join(m.ranges.select("h", "bpos", "stored_from", "stored_to"), ["h", "bpos"], "left")
        .withColumn(
            "lone_no",
            F.when((F.col("n_tables") == 0) & (F.col("stored_to") - F.col("stored_from") == 1),
                   F.col("stored_to")),
        )
        .join(lone, ["h", "lone_no"], "left")
        .join(m.keys.withColumnRenamed("key", "q"), ["h", "bpos", "q"], "left")
        .join(m.bases, ["h", "bpos"], "left")
    )
    by_key = F.col("key_table").isNotNull()
    own = F.when(by_key, F.col("key_table")).when(F.col("n_tables") == 1, F.col("first_table"))
    own_cte = F.when(by_key, F.col("key_table_cte")).when(F.col("n_tables") == 1, F.col("first_cte"))
    only_scope = (F.col("n_tables") == 0) & (F.col("n_subs") == 1)
    placed = (
        placed.withColumn("own", F.when(F.col("key_scope").isNull(), own))
        .withColumn("own_cte", F.when(F.col("key_scope").isNull(), own_cte))
        .withColumn(
            "early",
            F.when(F.col("n").contains("#"), "PLACEHOLDER")
            .when(F.col("own").isNotNull() & F.col("own_cte").isNull(), "OWN_TABLE")
            .when(F.col("own").isNotNull(), "OWN_CTE")
            .when(F.col("lone").isNotNull(), "LONE_TABLE")
            .when(F.col("key_scope").isNotNull(), "SCOPE")
            .when(only_scope, "ONLY_SCOPE"),
        )
        .withColumn(
            "s",
            F.when(F.col("early") == "OWN_CTE", F.col("own_cte"))
            .when(F.col("early") == "SCOPE", F.col("key_scope"))
            .when(F.col("early") == "ONLY_SCOPE", F.col("only_sub")),
        )
        .withColumn("alias_ok", F.coalesce(F.col("early") == "SCOPE", F.lit(False)))
    )
    settled = F.coalesce(F.col("early").isin("PLACEHOLDER", "OWN_TABLE", "LONE_TABLE"), F.lit(False))
    placed = keep(placed)
    direct = placed.filter(settled).select(
        "h", "bpos", "q", "n", "node", F.col("early").alias("rule"),
        F.when(F.col("early") == "PLACEHOLDER", named_only("dual"))
        .when(F.col("early") == "OWN_TABLE", F.col("own"))
        .otherwise(F.col("lone")).alias("table"),
        F.when(F.col("early") == "PLACEHOLDER", "PLACEHOLDER_COLUMN").otherwise("").alias("reason"),
    )
    open_, nested = scope_outcome(placed.filter(~settled), m, names)
    # rule for several scopes: does any of them trace the name
    some = together(open_.filter("n_tables = 0 AND n_subs > 1").select("h", "bpos", "n").distinct().join(
        m.sources.filter("kind <> 'T'").select("h", "bpos", F.col("target").alias("s")), ["h", "bpos"]
    ))
    some = _traced(some, names).select("h", "bpos", "n", F.lit(True).alias("any_traces")).distinct()
    star = star_choice(
        open_.filter("q = ''").select("h", "bpos", "n").distinct(), m, names, with_rest=False
    ).select(
        "h", "bpos", "n", F.col("table").alias("star_table"), F.col("s").alias("star_scope")
    )
    open_ = (
        open_.join(some, ["h", "bpos", "n"], "left")
        .join(star, ["h", "bpos", "n"], "left")
    )
    hit = F.col("outcome").isNotNull() & (F.col("outcome") != "NONE")
    several = (F.col("n_tables") == 0) & (F.col("n_subs") > 1)
    bare = F.col("q") == ""
    rule = (
        F.when((F.col("early") == "OWN_CTE") & hit, "SCOPE_HIT")
        .when((F.col("early") == "OWN_CTE") & F.col("first_base").isNotNull(), "OWN_CTE_BASE")
        .when(F.col("early") == "OWN_CTE", "OWN_TABLE")
        .when((F.col("early") == "SCOPE") & hit, "SCOPE_HIT")
        .when((F.col("early") == "SCOPE") & F.col("is_cte") & F.col("has_bases"), "BASES")
        .when(only_scope & hit, "LATE_SCOPE_HIT")
        .when(only_scope & F.col("first_base").isNotNull(), "LATE_BASE")
        .when(several & F.col("any_traces").isNotNull(), "ANY")
        .when(several & F.col("block_one_base"), "ONE_BASE")
        .when(several & F.col("block_base").isNotNull(), "SOME_BASE")
        .when(bare & F.col("star_scope").isNotNull(), "STAR_SCOPE")
        .when(bare & F.col("star_table").isNotNull(), "STAR_TABLE")
        .when(bare & (F.col("n_tables") > 0), "FIRST_TABLE")
        .otherwise("NOTHING")
    )
    scope_rule = F.col("rule").isin("SCOPE_HIT", "LATE_SCOPE_HIT")
    goes_on = scope_rule & F.col("outcome").isin("TRACE", "NESTED")
    tweakable = (
        (F.col("early") == "SCOPE") & (F.col("rule") == "SCOPE_HIT")
        & F.col("is_cte") & F.col("scope_star") & (F.col("scope_reason") == "")
    )
    tweak = F.when(
        tweakable,
        F.when(F.col("n_subs") > 1, "CTE_SINGLE_TABLE_FALLBACK").otherwise("SUBQUERY_STAR_FALLBACK"),
    )
    open_ = open_.withColumn("rule", rule).withColumn("tweak", tweak).select(
        "h", "bpos", "q", "n", "node", "rule", "tweak",
        F.when(goes_on, F.col("outcome"))
        .when(F.col("rule") == "STAR_SCOPE", "TRACE")
        .when(F.col("rule").isin("ANY", "BASES"), F.col("rule")).alias("act"),
        F.when(F.col("rule") == "STAR_SCOPE", F.col("star_scope")).otherwise(F.col("s")).alias("s"),
        F.when(scope_rule, F.col("scope_table"))
        .when(F.col("rule").isin("OWN_CTE_BASE", "LATE_BASE"), F.col("first_base"))
        .when(F.col("rule") == "OWN_TABLE", F.col("own"))
        .when(F.col("rule").isin("ONE_BASE", "SOME_BASE"), F.col("block_base"))
        .when(F.col("rule") == "STAR_TABLE", F.col("star_table"))
        .when(F.col("rule") == "FIRST_TABLE", F.col("first_table"))
        .when(F.col("rule") == "NOTHING", named_only("")).alias("table"),
        F.when(scope_rule & tweak.isNotNull() & ~goes_on, tweak)
        .when(scope_rule, F.col("scope_reason"))
        .when(F.col("rule") == "OWN_CTE_BASE", "CTE_ANY_TABLE_FALLBACK")
        .when(F.col("rule").isin("LATE_BASE", "SOME_BASE"), "SUBQUERY_ANY_TABLE_FALLBACK")
        .when(F.col("rule") == "ONE_BASE", "SUBQUERY_SINGLE_TABLE_FALLBACK")
        .when(F.col("rule") == "STAR_TABLE", "STAR_ALIAS_FALLBACK")
        .when(F.col("rule") == "FIRST_TABLE", "FIRST_TABLE_FALLBACK")
        .when((F.col("rule") == "NOTHING") & (F.col("n_tables") > 0), "UNRESOLVED_TABLE")
        .when(F.col("rule") == "NOTHING", "SUBQUERY_UNRESOLVED")
        .otherwise("").alias("reason"),
    )
    return union_all([direct, open_]), nested


def _traced(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of ``df`` (h, s, n, ...) whose scope traces the name."""
    by_name = df.join(names, ["h", "s", "n"], "left_semi")
    any_name = df.join(
        names.filter(F.col("n") == EVERY_NAME).select("h", "s"), ["h", "s"], "left_semi"
    )
    return union_all([by_name, any_name]).distinct()


def star_choice(nodes: DataFrame, m: Model, names: DataFrame, with_rest: bool) -> DataFrame:
    """Where the stars of a block lead for a name: (h, bpos, n, table, s, reason).

    First the ``a.*`` aliases in order; with ``with_rest`` also all scopes of
    the block, its only table, and the only base table beneath (``s`` = -2
    stands for all scopes).
    """
    alternatives = together(nodes.join(m.stars, ["h", "bpos"]))
    traced = _traced(
        alternatives.filter("key_table IS NULL AND key_scope IS NOT NULL")
        .select("h", F.col("key_scope").alias("s"), "n").distinct(),
        names,
    ).select("h", F.col("s").alias("key_scope"), "n", F.lit(True).alias("traces"))
    single = m.scopes.select("h", F.col("spos").alias("key_scope"), "single_table")
    choice = (
        alternatives.join(traced, ["h", "key_scope", "n"], "left")
        .join(single, ["h", "key_scope"], "left")
        .withColumn(
            "pick",
            F.when(
                F.col("key_table").isNotNull(),
                F.struct(F.col("key_table").alias("table"), F.lit(None).cast("int").alias("s")),
            )
            .when(F.col("traces"), F.struct(no_table().alias("table"), F.col("key_scope").alias("s")))
            .when(
                F.col("single_table").isNotNull(),
                F.struct(F.col("single_table").alias("table"), F.lit(None).cast("int").alias("s")),
            ),
        )
        .filter("pick IS NOT NULL")
        .groupBy("h", "bpos", "n")
        .agg(F.min_by("pick", "alt").alias("pick"))
        .select("h", "bpos", "n", "pick.table", "pick.s", F.lit("STAR_ALIAS_FALLBACK").alias("reason"))
    )
    if not with_rest:
        return choice
    rest = nodes.join(choice, ["h", "bpos", "n"], "left_anti")
    subs = _traced(
        together(rest.join(m.sources.filter("kind <> 'T'").select("h", "bpos", F.col("target").alias("s")),
                           ["h", "bpos"])),
        names,
    ).select("h", "bpos", "n", F.lit(-2).alias("all_scopes")).distinct()
    only = m.scopes.select("h", F.col("spos").alias("only_sub"), "single_table")
    table = (
        F.when(F.col("n_tables") == 1, F.col("first_table"))
        .when((F.col("n_tables") == 0) & (F.col("n_subs") == 1) & F.col("single_table").isNotNull(),
              F.col("single_table"))
        .when((F.col("n_tables") == 0) & (F.col("n_subs") > 0) & F.col("block_one_base"),
              F.col("block_base"))
    )
    rest = (
        together(rest.join(m.info.drop("spos"), ["h", "bpos"]))
        .join(m.bases, ["h", "bpos"], "left")
        .join(only, ["h", "only_sub"], "left")
        .join(subs, ["h", "bpos", "n"], "left")
        .select(
            "h", "bpos", "n",
            F.when(F.col("all_scopes").isNull(), table).otherwise(no_table()).alias("table"),
            F.col("all_scopes").alias("s"),
            F.when(F.col("n_tables") == 1, "").otherwise("SUBQUERY_STAR_FALLBACK").alias("reason"),
        )
        .filter("table IS NOT NULL OR s IS NOT NULL")
    )
    return union_all([choice, rest])


def _targets(df: DataFrame, m: Model, columns: list[str]) -> DataFrame:
    """Blocks (``to``) of the scopes in ``s``; -2 means all scopes of ``bpos``.
    ``folds`` where several blocks are looked through together."""
    members = m.blocks.select(
        "h", F.col("spos").alias("s"), F.col("bpos").alias("to"), (F.col("n_branches") > 1).alias("set")
    )
    all_of = (
        df.filter("s = -2").drop("s")
        .join(m.sources.filter("kind <> 'T'").select("h", "bpos", F.col("target").alias("s")),
              ["h", "bpos"])
    )
    return (
        union_all([
            df.filter("s <> -2").select(*columns, "s", F.lit(False).alias("several")),
            all_of.select(*columns, "s", F.lit(True).alias("several")),
        ])
        .join(members, ["h", "s"])
        .select(*columns, "to", (F.col("several") | F.col("set")).alias("folds"))
    )


def feeding_columns(m: Model) -> DataFrame:
    """(h, bpos, n, node, pos): mentions inside the output named n."""
    named = m.outputs.filter("out_name IS NOT NULL").select(
        "h", "bpos", F.col("out_no").alias("item"), F.lower("out_name").alias("out_n")
    )
    return (
        m.refs.filter("clause = 'PROJECTION'").select("h", "bpos", "item", "node", "pos")
        .join(named, ["h", "bpos", "item"])
        .select("h", "bpos", F.col("out_n").alias("n"), "node", "pos")
    )


def sort_columns(m: Model) -> DataFrame:
    """(h, bpos, out_n, q, n, node, pos, depth): for outputs named like a sort key of
    their statement, the mentions in sub-queries inside the output. As a sort key's
    columns they are looked up in the output's own block ``bpos``."""
    keys = m.refs.filter("clause = 'ORDER_BY' AND q = ''").select("h", F.col("n").alias("out_n"))
    nesting = m.all_scopes.filter("kind = 'EXPR' AND outer_clause = 'PROJECTION'").select(
        "h", F.col("outer_bpos").alias("bpos"), F.col("outer_item").alias("out_no")
    )
    items = keep(
        m.outputs.filter("out_name IS NOT NULL").withColumn("out_n", F.lower("out_name"))
        .join(keys.distinct(), ["h", "out_n"], "left_semi")
        .join(nesting, ["h", "bpos", "out_no"], "left_semi")
        .select("h", "bpos", "out_n", (F.col("start") - 1).alias("low"), (F.col("end") + 1).alias("high"))
    )
    points = m.refs.select("h", F.col("pos").alias("at")).join(
        items.select("h").distinct(), "h", "left_semi"
    )
    inner = m.refs.select("h", F.col("bpos").alias("inner"), F.col("pos").alias("at"), "q", "n")
    level = m.blocks.select("h", F.col("bpos").alias("inner"), F.col("level_no").alias("depth"))
    return (
        contained(items, points, ["h"]).join(items, ["h", "low", "high"])
        .join(inner, ["h", "at"]).filter(F.col("inner") != F.col("bpos"))
        .join(level, ["h", "inner"])
        .withColumn("node", node_id())
        .select("h", "bpos", "out_n", "q", "n", "node", F.col("at").alias("pos"), "depth")
    )


def expand_outputs(wanted: DataFrame, m: Model, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For output names ``n`` of blocks ``bpos``: the mentions that feed them,
    following stars down, and the tables where a star ends.

    Returns (h, bpos, n, node, path, folds) and (h, bpos, n, table, reason, path);
    ``folds`` where equal columns found by a star count once.
    """
    feeding = keep(feeding_columns(m))
    direct = wanted.join(feeding, ["h", "bpos", "n"]).select(
        "h", "bpos", "n", "node", F.array("pos").alias("path"), F.lit(False).alias("folds")
    )
    hits = feeding.select("h", "bpos", "n").distinct()
    seed = keep(
        wanted.join(hits, ["h", "bpos", "n"], "left_anti")
        .join(m.info.filter("has_star").select("h", "bpos"), ["h", "bpos"], "left_semi")
        .select("h", "bpos", "n", F.col("bpos").alias("at"), F.array("bpos").alias("path"),
                F.lit(False).alias("folds"))
    )
    if seed.isEmpty():
        rows = seed.select("h", "bpos", "n", no_table().alias("table"), F.lit("").alias("reason"), "path")
        return direct, rows

    star_blocks = m.info.filter("has_star").select("h", F.col("bpos").alias("at"))
    feeds = hits.withColumnRenamed("bpos", "at")

    def choices(df):
        cur = (
            df.select("h", "at", "n").distinct()
            .join(feeds, ["h", "at", "n"], "left_anti")
            .join(star_blocks, ["h", "at"], "left_semi")
            .withColumnRenamed("at", "bpos")
        )
        # read twice: by its tables and by its scopes
        return keep(star_choice(cur, m, names, with_rest=True))

    def step(frontier):
        hops = _targets(choices(frontier).filter("s IS NOT NULL"), m, ["h", "bpos", "n"])
        hops = hops.withColumnRenamed("bpos", "at").withColumnRenamed("folds", "hop_folds")
        return frontier.join(hops, ["h", "at", "n"]).select(
            "h", "bpos", "n", F.col("to").alias("at"), F.concat("path", F.array("to")).alias("path"),
            (F.col("folds") | F.col("hop_folds")).alias("folds"),
        )

    walked = follow(seed, step, ["h", "bpos", "n", "at"], "path")
    found = walked.join(feeding.withColumnRenamed("bpos", "at"), ["h", "at", "n"]).select(
        "h", "bpos", "n", "node", F.concat("path", F.array("pos")).alias("path"), "folds"
    )
    ends = choices(walked).filter("table IS NOT NULL").withColumnRenamed("bpos", "at").drop("s")
    rows = walked.join(ends, ["h", "at", "n"]).select("h", "bpos", "n", "table", "reason", "path")
    return union_all([direct, found]), rows


def text_rules(open_: DataFrame, m: Model, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two rules that scan the statement text, for nodes that reach them.

    By alias in the text (or its only table) before the weaker rules, by first
    table of the text at the end. A table that is a CTE is looked into.
    """
    def as_table(ref: Column) -> Column:
        return F.struct(
            F.lit("").alias("cat"), ref["schema_name"].alias("sch"), ref["table_name"].alias("name")
        )

    texts = m.texts.join(open_.select("h").distinct(), "h", "left_semi")
    named = F.filter("refs", lambda r: r["table_name"] != "")
    firsts = texts.select("h", text_table_refs(F.col("text")).alias("refs")).select(
        "h",
        F.when(F.size("refs") > 0, as_table(F.get("refs", F.lit(0)))).alias("first_ref"),
        F.when(F.size(named) == 1, as_table(F.get(named, F.lit(0)))).alias("only_ref"),
    )
    # of equal aliases the last one counts
    aliases = (
        texts.select("h", F.posexplode(text_alias_pairs(F.col("text"))).alias("nth", "pair"))
        .groupBy("h", F.col("pair.alias").alias("q"))
        .agg(F.max_by(as_table(F.col("pair")), "nth").alias("alias_ref"))
    )
    looked = (
        together(open_.select("h", "bpos", "q", "n", "rule").join(firsts, "h"))
        .join(aliases, ["h", "q"], "left")
        .withColumn("by_alias", F.coalesce("alias_ref", "only_ref"))
        .withColumn(
            "text_table",
            F.coalesce("by_alias", F.when(F.col("rule") == "NOTHING", F.col("first_ref"))),
        )
        .filter("text_table IS NOT NULL")
        .select("h", "bpos", "q", "n", "text_table", F.col("by_alias").isNotNull().alias("aliased"),
                F.lower("text_table.name").alias("cte_name"))
        .join(m.ctes.withColumnRenamed("target", "s"), ["h", "cte_name"], "left")
        .withColumn("alias_ok", F.lit(False))
    )
    looked, nested = scope_outcome(looked, m, names)
    hit_scope = F.col("outcome").isNotNull() & (F.col("outcome") != "NONE")
    goes_on = hit_scope & F.col("outcome").isin("TRACE", "NESTED")
    bases = ~hit_scope & F.col("aliased") & F.coalesce("has_bases", F.lit(False))
    first = ~hit_scope & ~F.col("aliased") & F.col("first_base").isNotNull()
    looked = (
        looked.withColumn("outcome", F.coalesce("outcome", F.lit("NONE")))
        .select(
            "h", "bpos", "q", "n", node_id("text").alias("node"), F.lit("TEXT").alias("rule"), "s",
            F.when(goes_on, F.col("outcome")).when(bases, "BASES").alias("act"),
            F.when(goes_on | bases, no_table()).when(hit_scope, F.col("scope_table"))
            .when(first, F.col("first_base")).otherwise(F.col("text_table")).alias("table"),
            F.when(hit_scope, F.col("scope_reason"))
            .when(first, "CTE_ANY_TABLE_FALLBACK")
            .when(F.col("aliased"), "TEXT_ALIAS_FALLBACK")
            .otherwise("TEXT_TABLE_FALLBACK").alias("reason"),
        )
    )
    return looked, nested


def settled_ends(nodes: DataFrame) -> DataFrame:
    """(h, node, table, reason, n, path) of the mentions whose rule names a table."""
    return nodes.filter("act IS NULL").select(
        "h", "node", "table", "reason", "n", F.array().cast("array<int>").alias("path")
    )


def base_ends(nodes: DataFrame, m: Model) -> DataFrame:
    """The same for mentions that get every base table of their scope."""
    asking = keep(nodes.filter("act = 'BASES'").select("h", "node", "n", "s"))
    if asking.isEmpty():
        empty = asking.select("h", "node", no_table().alias("table"), F.lit("").alias("reason"), "n")
        return empty.withColumn("path", F.array().cast("array<int>"))
    beneath = tables_beneath(asking.select("h", "s").distinct(), m.info, m.sources, m.edges)
    found = asking.join(beneath.filter(F.lower("name") != "dual"), ["h", "s"])
    by_name = Window.partitionBy("h", "node").orderBy("sch", "name", "cat")
    return found.select(
        "h", "node", F.struct(F.col("cat"), F.col("sch"), F.col("name")).alias("table"),
        F.lit("CTE_ANY_TABLE_FALLBACK").alias("reason"), "n",
        F.array(F.row_number().over(by_name)).alias("path"),
    )


def without_tracing(nodes: DataFrame, m: Model) -> DataFrame:
    """Ends of mentions that must not be traced (any further): the rules after the trace."""
    nothing = m.traceable.limit(0)
    again, _ = classify(
        nodes.select("h", "bpos", "q", "n", "node"), replace(m, traceable=nothing),
        scope_names(replace(m, traceable=nothing)),
    )
    again = keep(again)
    return union_all([settled_ends(again), base_ends(again, m)])


def cut_cycles(
    m: Model, going: DataFrame, links: DataFrame, walked: DataFrame, traced: DataFrame
) -> DataFrame:
    """Rows (h, node, rid, table, reason, n, tweaked, path) of traces that come back.

    A mention lies on a cycle if something that feeds it leads back to it; mutual
    reachability tells the strongly connected parts of the graph apart. A trace
    enters a cycle at the mention it starts from or at the last one outside. Where
    it would enter there again, the mention at hand gets what the rules after
    tracing give. A mention for which that leaves nothing is looked up the same way.
    """
    in_cycles = m.cyclic.select("h").distinct()
    reach = keep(
        walked.join(in_cycles, "h", "left_semi").groupBy("h", "origin", "node")
        .agg(F.min(F.struct("path", "rid", "tweaked")).alias("way"))
    )
    hops = keep(links.join(in_cycles, "h", "left_semi").select("h", "node", "to").distinct())
    back = reach.select("h", F.col("origin").alias("to"), "node")
    on_cycle = keep(
        hops.join(back, ["h", "node", "to"])
        .join(going.filter("act <> 'ANY'").select("h", "node"), ["h", "node"], "left_semi")
    )
    same_entry = (
        hops.withColumnRenamed("node", "entering")
        .join(on_cycle.withColumnRenamed("node", "closing"), ["h", "to"])
        .select("h", "entering", "closing").distinct()
    )
    inside = reach.select("h", F.col("origin").alias("closing"), F.col("node").alias("entering"))
    outside = same_entry.join(inside, ["h", "entering", "closing"], "left_anti")
    starts = same_entry.select("h", F.col("entering").alias("origin"), "closing")
    passed = reach.select("h", "origin", F.col("node").alias("entering")).join(
        outside, ["h", "entering"]
    ).select("h", "origin", "closing")
    pairs = union_all([starts, passed]).distinct()
    cut = keep(without_tracing(
        going.join(on_cycle.select("h", "node").distinct(), ["h", "node"], "left_semi"), m
    ))
    closed = (
        pairs.withColumnRenamed("closing", "node")
        .join(reach, ["h", "origin", "node"])
        .join(cut.withColumnRenamed("path", "end_path"), ["h", "node"])
        .select("h", F.col("origin").alias("node"), "way.rid", "table", "reason", "n", "way.tweaked",
                F.concat("way.path", "end_path").alias("path"))
    )
    closed = keep(closed)
    # several scopes that all lead back: no single entry, so the mention itself is looked up
    found = union_all([traced.select("h", "node"), closed.select("h", "node")]).distinct()
    lost = going.join(in_cycles, "h", "left_semi").join(found, ["h", "node"], "left_anti")
    rest = without_tracing(lost, m).select(
        "h", "node", F.lit(0).cast("long").alias("rid"), "table", "reason", "n",
        F.lit(None).cast("string").alias("tweaked"), "path",
    )
    return union_all([closed, rest])


def resolve(m: Model, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of every mention, and of the lookups in ``more``: (nodes, results).

    ``nodes`` gives the rule and the node to read for the report (``report_node``);
    ``results`` is (h, node, rid, cat, sch, name_t, col, reason, path), upper-cased, where
    ``rid`` tells the ways apart on which one column is met more than once.
    """
    columns = ["h", "bpos", "q", "n", "node"]
    mentions = union_all([m.refs.select(*columns), more.select(*columns)]).distinct()
    names = keep(scope_names(m))
    plain, nested = classify(mentions, m, names)
    plain = keep(plain)
    late = ["LATE_SCOPE_HIT", "LATE_BASE", "ANY", "ONE_BASE", "SOME_BASE", "STAR_SCOPE", "STAR_TABLE"]
    scanned, nested_2 = text_rules(
        plain.filter(F.col("rule").isin(late + GUESSES) & F.lit(m.scan_text)), m, names
    )
    scanned = keep(scanned)
    nodes = union_all([plain, scanned])
    nested = union_all([nested, nested_2]).distinct()

    going = nodes.filter("act IN ('TRACE', 'NESTED', 'ANY')")
    sets = m.blocks.filter("n_branches > 1").select("h", F.col("spos").alias("s"))
    folding = union_all([sets, m.cyclic]).distinct().withColumn("set", F.lit(True))
    # from a folding mention on, equal columns count once
    going = keep(
        going.join(folding, ["h", "s"], "left")
        .withColumn("fold", (F.col("act") != "TRACE") | F.col("set").isNotNull())
        .drop("set")
    )
    columns = ["h", "node", "n"]
    entry = _targets(
        going.filter("act = 'TRACE'").select(*columns, "bpos", "s")
        .unionByName(going.filter("act = 'ANY'").select(*columns, "bpos", F.lit(-2).alias("s"))),
        m, columns,
    ).select(*columns, "to").unionByName(
        going.filter("act = 'NESTED'").select(*columns, "s")
        .join(nested.withColumnRenamed("bpos", "to"), ["h", "s", "n"]).select(*columns, "to")
    )
    entry = keep(entry)
    wanted = entry.select("h", F.col("to").alias("bpos"), "n").distinct()
    feeds, star_rows = expand_outputs(wanted, m, names)
    entry = entry.withColumnRenamed("to", "bpos")
    star_ends = entry.join(star_rows, ["h", "bpos", "n"]).select(
        "h", "node", "table", "reason", "n", F.concat(F.array("bpos"), "path").alias("path")
    )
    ends = keep(union_all([settled_ends(nodes), base_ends(nodes, m), star_ends]))

    about = going.select(
        "h", F.col("node").alias("to"), F.col("tweak").isNotNull().alias("has_tweak"),
        F.col("fold").alias("to_folds"),
    )
    hop = F.concat(F.array("bpos"), "path")
    links = keep(
        entry.join(feeds.withColumnRenamed("node", "to"), ["h", "bpos", "n"])
        .select("h", "node", "to", hop.alias("hop"), "folds",
                F.when(F.col("folds"), F.array("bpos")).otherwise(hop).alias("way"))
        .distinct()
        .join(about, ["h", "to"], "left")
        .fillna(False, ["has_tweak", "to_folds"])
    )
    seed = going.select(
        "h", F.col("node").alias("origin"), "node", F.lit(0).cast("long").alias("rid"),
        F.when(F.col("tweak").isNotNull(), F.col("node")).alias("tweaked"),
        F.col("fold").alias("folded"), F.array().cast("array<int>").alias("path"),
    )

    def step(frontier):
        return frontier.join(links, ["h", "node"]).select(
            "h", "origin", F.col("to").alias("node"),
            F.when(F.col("folded"), F.col("rid")).otherwise(F.xxhash64("rid", "way")).alias("rid"),
            F.when(F.col("has_tweak"), F.col("to")).otherwise(F.col("tweaked")).alias("tweaked"),
            (F.col("folded") | F.col("folds") | F.col("to_folds")).alias("folded"),
            F.concat("path", "hop").alias("path"),
        )

    walked = follow(seed, step, ["h", "origin", "node", "rid"], "path")
    traced = walked.join(ends.withColumnRenamed("path", "end_path"), ["h", "node"]).select(
        "h", F.col("origin").alias("node"), "rid", "table", "reason", "n", "tweaked",
        F.concat("path", "end_path").alias("path"),
    )
    traced = keep(traced)
    if not m.cyclic.isEmpty():
        traced = keep(union_all([traced, cut_cycles(m, going, links, walked, traced)]))
    # a reason is filled in only where no row of that mention has one, and the
    # innermost such mention decides
    fires = (
        traced.join(going.filter("tweak IS NOT NULL").select("h", "node", "tweak"), ["h", "node"])
        .groupBy("h", "node", "tweak")
        .agg(F.max((F.col("reason") != "") | (F.col("tweaked") != F.col("node"))).alias("blocked"))
        .filter(~F.col("blocked"))
        .select("h", F.col("node").alias("tweaked"), "tweak")
    )
    traced = traced.join(fires, ["h", "tweaked"], "left").select(
        "h", "node", "rid", "table", "n", "path", F.coalesce("tweak", "reason").alias("reason")
    )
    plain_ends = ends.join(going.select("h", "node"), ["h", "node"], "left_anti").select(
        "h", "node", F.lit(0).cast("long").alias("rid"), "table", "n", "path", "reason"
    )
    up = lambda c: F.upper(unmark_placeholders(F.col(c)))
    results = (
        union_all([plain_ends, traced])
        .select("h", "node", "rid", up("table.cat").alias("cat"), up("table.sch").alias("sch"),
                up("table.name").alias("name"), F.upper("n").alias("col"), "reason", "path")
        .groupBy("h", "node", "rid", "cat", "sch", "name", "col")
        .agg(F.min(F.struct("path", "reason")).alias("p"))
        .select("h", "node", "rid", "cat", "sch", F.col("name").alias("name_t"), "col", "p.reason", "p.path")
    )
    chosen = plain.select("h", "bpos", "q", "n", "node", "rule").join(
        scanned.select("h", "bpos", "q", "n", F.col("node").alias("text_node")),
        ["h", "bpos", "q", "n"], "left",
    ).select("h", "node", "rule", F.coalesce("text_node", "node").alias("report_node"))
    return keep_bucketed(chosen, "nodes"), keep_bucketed(results, "results")
