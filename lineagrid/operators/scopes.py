"""What a sub-query, CTE or set operation stands on.

Base tables of a scope, its single table if it has exactly one, and the names
it can trace further; all per statement, from joins on the text key, in as many rounds
as scopes are nested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.operators.closure import follow, union_all
from lineagrid.session import keep, keep_sized

EVERY_NAME = "*"


def table_struct():
    return F.struct("cat", "sch", "name")


def identity():
    return F.struct("name", "sch", "cat")


def block_info(blocks: DataFrame, sources: DataFrame, outputs: DataFrame) -> DataFrame:
    """Counts and first entries of each block's FROM list, and its stars."""
    is_table = F.col("kind") == "T"
    per_source = sources.groupBy("h", "bpos").agg(
        F.count(F.when(is_table, 1)).alias("n_tables"),
        F.count(F.when(~is_table, 1)).alias("n_subs"),
        F.min_by(F.when(is_table, table_struct()), F.when(is_table, F.col("pos"))).alias("first_table"),
        F.min_by(F.when(is_table, F.col("target")), F.when(is_table, F.col("pos")))
        .alias("first_cte"),
        F.min(F.when(is_table, identity())).alias("id_from"),
        F.max(F.when(is_table, identity())).alias("id_to"),
        F.min(F.when(~is_table, F.col("target"))).alias("only_sub"),
    )
    stars = outputs.groupBy("h", "bpos").agg(F.max("is_star").alias("has_star"))
    return (
        blocks.select("h", "bpos", "spos")
        .join(per_source, ["h", "bpos"], "left")
        .join(stars, ["h", "bpos"], "left")
        .fillna(0, ["n_tables", "n_subs"])
        .fillna(False, ["has_star"])
    )


def source_keys(sources: DataFrame, scopes: DataFrame) -> DataFrame:
    """What a qualifier means in a block: table (first entry wins) or scope
    (last entry wins)."""
    is_table = F.col("kind") == "T"

    def entry(column, rank):
        return F.struct(F.lower(column).alias("key"), F.lit(rank).alias("rank"))

    entries = sources.select(
        "h", "bpos", "pos", "kind", table_struct().alias("table"),
        F.when(~is_table, F.col("target")).alias("scope"),
        F.when(is_table, F.col("target")).alias("table_cte"),
        F.inline(F.array_compact(F.array(
            F.when(F.col("kind") != "S", entry("name", 0)),
            F.when(F.col("alias").isNotNull(), entry("alias", 1)),
        ))),
    )
    place = F.struct("pos", "rank")
    picked = entries.groupBy("h", "bpos", "key").agg(
        F.min_by(F.when(is_table, F.struct("table", "table_cte")), F.when(is_table, place)).alias("t"),
        F.max_by(
            F.when(~is_table, F.struct("scope", (F.col("kind") == "C").alias("is_cte"))),
            F.when(~is_table, place),
        ).alias("s"),
    )
    return picked.select(
        "h", "bpos", "key", F.col("t.table").alias("key_table"), F.col("t.table_cte").alias("key_table_cte"),
        F.col("s.scope").alias("key_scope"), F.col("s.is_cte").alias("key_is_cte"),
    )



def scope_edges(info: DataFrame, sources: DataFrame) -> DataFrame:
    """(h, spos, bpos, pos, target, single): a scope reads another scope.
    ``single`` where that is the block's only source."""
    return sources.filter("kind <> 'T'").select("h", "bpos", "pos", "target").join(
        info.select(
            "h", "bpos", "spos",
            ((F.col("n_tables") == 0) & (F.col("n_subs") == 1)).alias("single"), "has_star",
        ),
        ["h", "bpos"],
    )


def _order_of(columns: list[str]):
    return F.struct(*columns) if len(columns) > 1 else F.col(columns[0])


def _summed(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Base tables in short: the first in order, the least and the greatest by name, and
    whether one is a real table. Two summaries add up to one, so no list of tables is kept."""
    return rows.groupBy(*keys).agg(
        F.min_by("first", _order_of(order)).alias("first"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.max("real").alias("real"),
    )


def _own_tables(info: DataFrame, sources: DataFrame) -> DataFrame:
    """(h, spos, bpos, pos, first, low, high, real): the tables blocks name themselves."""
    return (
        sources.filter("kind = 'T' AND NOT borrowed")
        .join(info.select("h", "bpos", "spos"), ["h", "bpos"])
        .select("h", "spos", "bpos", "pos", table_struct().alias("first"), identity().alias("low"),
                identity().alias("high"), (F.lower("name") != "dual").alias("real"))
    )


def _values(scopes: DataFrame, info: DataFrame, own: DataFrame, arrived: DataFrame) -> DataFrame:
    """(h, spos, first, low, high, real, single) of scopes (h, spos) from their own tables and
    what has arrived from the scopes they read."""
    parts = ["h", "spos", "bpos", "pos", "first", "low", "high", "real"]
    rows = union_all([
        own.join(scopes, ["h", "spos"], "left_semi").select(*parts),
        arrived.filter("low IS NOT NULL").select(*parts),
    ])
    below = block_bases(arrived)
    passed = arrived.select("h", "bpos", F.col("single").alias("passed"))
    leaf = (
        F.when(F.col("n_tables") == 1, F.col("first_table"))
        .when((F.col("n_tables") > 1) & (F.col("id_from") == F.col("id_to")), F.col("first_table"))
        .when((F.col("n_tables") == 0) & (F.col("n_subs") == 1), F.col("passed"))
        .when((F.col("n_tables") == 0) & (F.col("n_subs") > 1) & F.col("block_one_base"),
              F.col("block_base"))
    )
    one_sub = info.filter("n_tables = 0 AND n_subs = 1").select("h", "bpos")
    leaf_id = F.when(F.col("leaf").isNotNull(), F.struct("leaf.name", "leaf.sch", "leaf.cat"))
    singles = (
        info.join(scopes, ["h", "spos"], "left_semi")
        .join(below, ["h", "bpos"], "left")
        .join(passed.join(one_sub, ["h", "bpos"], "left_semi"), ["h", "bpos"], "left")
        .withColumn("leaf", leaf).withColumn("leaf_id", leaf_id)
        .groupBy("h", "spos")
        .agg(
            F.min_by("leaf", "bpos").alias("leaf"),
            ((F.count("leaf_id") == F.count("*")) & (F.min("leaf_id") == F.max("leaf_id"))).alias("agree"),
        )
        .select("h", "spos", F.when(F.col("agree"), F.col("leaf")).alias("single"))
    )
    return scopes.join(_summed(rows, ["h", "spos"], ["bpos", "pos"]), ["h", "spos"], "left").join(
        singles, ["h", "spos"], "left"
    )


def block_bases(arrived: DataFrame) -> DataFrame:
    """First base table over all scopes a block reads, and whether it is the only one."""
    return _summed(arrived.filter("low IS NOT NULL"), ["h", "bpos"], ["pos"]).select(
        "h", "bpos", F.col("first").alias("block_base"), (F.col("low") == F.col("high")).alias("block_one_base")
    )


def scope_values(
    info: DataFrame, sources: DataFrame, edges: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What scopes stand on: values (h, spos, first, low, high, real, single), what arrives
    in each block from each scope it reads (h, spos, bpos, pos, target, ...), and the scopes
    that read themselves (h, s).

    Values rise from the innermost scopes along the edges; each edge carries one summary
    once, so a chain of n CTEs costs n rows. A scope is worked out in the round in
    which the last scope it reads is. What is left when nothing rises any more are
    recursive CTEs and their readers; see ``_recursive_values``.
    """
    own = keep(_own_tables(info, sources))
    edges = edges.select("h", "spos", "bpos", "pos", "target", "single")
    waits = keep(edges.groupBy("h", "spos").agg(F.count("*").alias("n_edges")))
    every = info.select("h", "spos").distinct()
    none = edges.limit(0).select(
        "h", "spos", "bpos", "pos", "target", *[
            F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("first", "low", "high", "real")
        ], F.lit(None).cast(own.schema["first"].dataType).alias("single"),
    )
    rising = keep_sized(_values(every.join(waits, ["h", "spos"], "left_anti"), info, own, none))
    done, arrived = [rising], []
    in_scope = Window.partitionBy("h", "spos")
    while not rising.isEmpty():
        touched = edges.join(
            rising.select("h", F.col("spos").alias("target")), ["h", "target"], "left_semi"
        ).select("h", "spos").distinct()
        ready = keep_sized(
            edges.drop("single").join(touched, ["h", "spos"], "left_semi")
            .join(union_all(done).withColumnRenamed("spos", "target"), ["h", "target"])
            .withColumn("n_edges", F.count("*").over(in_scope))
            .join(waits, ["h", "spos", "n_edges"], "left_semi")
            .select(*none.columns)
        )
        arrived.append(ready)
        rising = keep_sized(_values(ready.select("h", "spos").distinct(), info, own, ready))
        done.append(rising)
    values, arrivals = union_all(done), union_all(arrived or [none])
    stuck = keep(waits.join(values, ["h", "spos"], "left_anti").select("h", "spos"))
    if stuck.isEmpty():
        return values, arrivals, stuck.select("h", F.col("spos").alias("s"))
    here = keep(
        edges.drop("single").join(stuck, ["h", "spos"], "left_semi")
        .join(values.withColumnRenamed("spos", "target"), ["h", "target"]).select(*none.columns)
    )
    more, came, cyclic = _recursive_values(stuck, info, own, edges, here)
    return union_all([values, more]), union_all([arrivals, here, came.select(*none.columns)]), cyclic


def _recursive_values(
    stuck: DataFrame, info: DataFrame, own: DataFrame, edges: DataFrame, here: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Values of recursive CTEs and of scopes above them, by pairs of these scopes.

    ``here`` is what arrives in them from the others. All tables below count, each
    scope's once. A scope handed on to where it is being looked at already has no single table.
    """
    inner = keep(
        edges.join(stuck, ["h", "spos"], "left_semi")
        .join(stuck.withColumnRenamed("spos", "target"), ["h", "target"], "left_semi")
    )
    links = inner.select(
        "h", "spos", "bpos", "pos", F.col("target").alias("next_spos"),
        F.when(F.col("single"), 0).otherwise(1).alias("link_not_single"),
    )
    seed = stuck.select(
        "h", F.col("spos").alias("origin"), "spos", F.lit(0).alias("not_single"),
        F.array().cast("array<int>").alias("path"),
    )

    def step(frontier):
        return frontier.join(links, ["h", "spos"]).select(
            "h", "origin", F.col("next_spos").alias("spos"),
            F.greatest("not_single", "link_not_single").alias("not_single"),
            F.concat("path", F.array("bpos", "pos")).alias("path"),
        )

    reached = keep(follow(seed, step, ["h", "origin", "spos"], "path"))
    around = inner.select("h", "spos", F.col("target").alias("origin"), "single")
    cyclic = around.join(reached, ["h", "origin", "spos"])
    parts = ["h", "spos", "bpos", "pos", "first", "low", "high", "real"]
    tables = union_all([
        own.join(stuck, ["h", "spos"], "left_semi").select(*parts),
        here.filter("low IS NOT NULL").select(*parts),
    ])
    summed = keep(_summed(
        reached.join(tables, ["h", "spos"]).select(
            "h", F.col("origin").alias("spos"), F.concat("path", F.array("bpos", "pos")).alias("place"),
            "first", "low", "high", "real",
        ),
        ["h", "spos"], ["place"],
    ))
    came = inner.drop("single").join(summed.withColumnRenamed("spos", "target"), ["h", "target"], "left")
    came = came.withColumn("single", F.lit(None).cast(own.schema["first"].dataType))
    # a single table rises along chains of lone sources that do not come back
    back = cyclic.filter("single AND not_single = 0").select("h", "origin").distinct()
    none = reached.filter("not_single = 0").select("h", F.col("origin").alias("top"), F.col("spos").alias("origin")).join(
        back, ["h", "origin"], "left_semi"
    ).select("h", F.col("top").alias("spos")).distinct()
    inputs = union_all([here, came.select(*here.columns)])
    leaves = _values(stuck, info.join(
        inner.filter("single").select("h", "bpos"), ["h", "bpos"], "left_anti"
    ), own, inputs).select("h", F.col("spos").alias("leaf_spos"), F.col("single").alias("leaf"))
    holding = info.join(stuck, ["h", "spos"], "left_semi").select("h", "bpos", "spos").join(
        inner.filter("single").select("h", "bpos"), ["h", "bpos"], "left_anti"
    ).select("h", F.col("spos").alias("leaf_spos")).distinct()
    singles = (
        reached.filter("not_single = 0")
        .select("h", "origin", F.col("spos").alias("leaf_spos"), "path")
        .join(holding, ["h", "leaf_spos"])
        .join(leaves, ["h", "leaf_spos"], "left")
        .withColumn("leaf_id", F.when(F.col("leaf").isNotNull(), F.struct("leaf.name", "leaf.sch", "leaf.cat")))
        .groupBy("h", F.col("origin").alias("spos"))
        .agg(
            F.min_by("leaf", "path").alias("leaf"),
            ((F.count("leaf_id") == F.count("*")) & (F.min("leaf_id") == F.max("leaf_id"))).alias("agree"),
        )
        .filter("agree").select("h", "spos", F.col("leaf").alias("single"))
        .join(none, ["h", "spos"], "left_anti")
    )
    values = keep(stuck.join(summed, ["h", "spos"], "left").join(singles, ["h", "spos"], "left"))
    came = keep(came.drop("single").join(
        singles.withColumnRenamed("spos", "target"), ["h", "target"], "left"
    ))
    return values, came, keep(cyclic.select("h", F.col("spos").alias("s")).distinct())


def tables_beneath(wanted: DataFrame, info: DataFrame, sources: DataFrame, edges: DataFrame) -> DataFrame:
    """(h, s, cat, sch, name): all base tables of the scopes (h, s) asked for, each once."""
    links = edges.select("h", "spos", F.col("target").alias("next_spos")).distinct()
    seed = wanted.select("h", "s", F.col("s").alias("spos"), F.lit(0).alias("round"))

    def step(frontier):
        return frontier.join(links, ["h", "spos"]).select(
            "h", "s", F.col("next_spos").alias("spos"), (F.col("round") + 1).alias("round")
        )

    own = sources.filter("kind = 'T' AND NOT borrowed").select("h", "bpos", "cat", "sch", "name").join(
        info.select("h", "bpos", "spos"), ["h", "bpos"]
    )
    reached = follow(seed, step, ["h", "s", "spos"], "round")
    return reached.join(own, ["h", "spos"]).select("h", "s", "cat", "sch", "name").distinct()


def scope_info(
    values: DataFrame, edges: DataFrame, scopes: DataFrame, info: DataFrame
) -> DataFrame:
    """Per scope that is read: star, first base table, single table, whether a real
    table lies beneath, end position."""
    own = edges.select("h", F.col("target").alias("spos")).distinct()
    stars = info.groupBy("h", "spos").agg(F.max("has_star").alias("scope_star"))
    return (
        own.join(stars, ["h", "spos"], "left")
        .join(
            values.select("h", "spos", F.col("first").alias("first_base"), F.col("single").alias("single_table"),
                          F.coalesce("real", F.lit(False)).alias("has_bases")),
            ["h", "spos"], "left",
        )
        .join(scopes.select("h", "spos", "end_pos", (F.col("kind") == "CTE").alias("is_cte")),
              ["h", "spos"])
    )


def star_aliases(outputs: DataFrame, keys: DataFrame) -> DataFrame:
    """``a.*`` entries of a block in order, with what their alias means."""
    ordered = (
        outputs.filter("star_alias IS NOT NULL")
        .groupBy("h", "bpos", F.lower("star_alias").alias("key"))
        .agg(F.min("out_no").alias("alt"))
    )
    return ordered.join(keys, ["h", "bpos", "key"]).drop("key")


def traceable_names(
    info: DataFrame, outputs: DataFrame, edges: DataFrame, stars: DataFrame, scopes: DataFrame,
    bases: DataFrame,
) -> DataFrame:
    """(h, bpos, n): names for which tracing into the block finds something;
    '*' for a block that finds a source for any name."""
    named = outputs.filter("out_name IS NOT NULL AND n_cols > 0").select(
        "h", "bpos", F.lower("out_name").alias("n")
    )
    by_alias = stars.join(
        scopes.select("h", F.col("spos").alias("key_scope"), "single_table"), ["h", "key_scope"], "left"
    ).filter("key_table IS NOT NULL OR single_table IS NOT NULL").select("h", "bpos")
    only_scope = scopes.select("h", F.col("spos").alias("only_sub"), "single_table")
    by_count = (
        info.filter("has_star")
        .join(only_scope, ["h", "only_sub"], "left")
        .join(bases, ["h", "bpos"], "left")
        .filter(
            (F.col("n_tables") == 1)
            | ((F.col("n_tables") == 0) & (F.col("n_subs") == 1) & F.col("single_table").isNotNull())
            | ((F.col("n_tables") == 0) & (F.col("n_subs") > 0) & F.col("block_one_base"))
        )
        .select("h", "bpos")
    )
    any_name = union_all([by_alias, by_count]).withColumn("n", F.lit(EVERY_NAME))
    seed = union_all([named, any_name]).distinct().withColumn("round", F.lit(0))
    passing = keep(
        edges.filter("has_star")
        .select("h", F.col("bpos").alias("outer_bpos"), F.col("target").alias("spos"))
        .join(info.select("h", "spos", "bpos"), ["h", "spos"])
        .select("h", "bpos", "outer_bpos")
    )

    def step(frontier):
        return frontier.join(passing, ["h", "bpos"]).select(
            "h", F.col("outer_bpos").alias("bpos"), "n", (F.col("round") + 1).alias("round")
        )

    return follow(seed, step, ["h", "bpos", "n"], "round").select("h", "bpos", "n")
