"""Report rows of every column mention, including ORDER BY by alias."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagrid.functions.text import unmark_placeholders
from lineagrid.functions.words import CLAUSES
from lineagrid.operators.closure import contained, union_all
from lineagrid.operators.resolve import Model, feeding_columns
from lineagrid.session import keep, together

COLUMNS = ["h", "bpos", "pos", "clause", "cpos", "tok"]


def clause_number(clause):
    return F.array_position(F.array(*[F.lit(c) for c in CLAUSES]), clause)


def mention_rows(
    m: Model, nodes: DataFrame, results: DataFrame, sort_columns: DataFrame
) -> DataFrame:
    """(h, bpos, pos, clause, cpos, tok, cat, sch, name_t, col, reason, path)."""
    # ORDER BY after the last branch belongs to the set operation as a whole; a branch in
    # brackets of its own has an ORDER BY of its own
    in_set = m.blocks.filter("n_branches > 1 AND NOT bracketed").select(
        "h", "bpos", F.lit("ORDER_BY").alias("clause")
    )
    refs = m.refs.join(in_set, ["h", "bpos", "clause"], "left_anti")
    is_sort = (F.col("clause") == "ORDER_BY") & (F.col("q") == "")
    read = results.withColumnRenamed("node", "report_node")
    to_report = nodes.select("h", "node", "report_node")
    plain = together(refs.filter(~is_sort).join(to_report, ["h", "node"])).join(read, ["h", "report_node"]).select(
        *COLUMNS, "cat", "sch", "name_t", "col", "reason", "path"
    )
    sorts = refs.filter(is_sort).select(*COLUMNS, "n", "node", "name")
    named = (
        m.outputs.filter("out_name IS NOT NULL")
        .groupBy("h", "bpos", F.lower("out_name").alias("n"))
        .agg(F.count("*").alias("n_outputs"), F.max("has_col").alias("has_col"))
    )
    inside = sort_columns.select("h", "bpos", F.col("out_n").alias("n"), "node", "pos", "depth")
    has_inside = inside.select("h", "bpos", "n", F.lit(True).alias("has_inside")).distinct()
    sorts = keep(
        sorts.join(named, ["h", "bpos", "n"], "left")
        .join(has_inside, ["h", "bpos", "n"], "left")
        .withColumn("has_col", F.col("has_col") | F.coalesce("has_inside", F.lit(False)))
        .join(m.info.select("h", "bpos", "n_tables", "n_subs"), ["h", "bpos"])
        .withColumn(
            "way",
            F.when((F.col("n_outputs") == 1) & ~F.col("has_col"), "DERIVED")
            .when(F.col("n_outputs") == 1, "OUTPUT")
            .when((F.col("n_tables") == 0) & (F.col("n_subs") > 0), "NESTED")
            .otherwise("PLAIN"),
        )
    )
    if sorts.isEmpty():
        return plain
    empty = F.lit("")
    derived = sorts.filter("way = 'DERIVED'").select(
        *COLUMNS, empty.alias("cat"), empty.alias("sch"), F.lit("DUAL").alias("name_t"),
        F.upper("n").alias("col"), F.lit("DERIVED_COLUMN").alias("reason"),
        F.array().cast("array<int>").alias("path"),
    )
    feeding = union_all([feeding_columns(m).withColumn("depth", F.lit(0)), inside])
    as_written = unmark_placeholders(F.col("name"))
    by_output = (
        together(together(
            sorts.filter("way = 'OUTPUT'").drop("node")
            .join(feeding.withColumnRenamed("pos", "at"), ["h", "bpos", "n"])
        ).join(to_report, ["h", "node"])).join(read.drop("col"), ["h", "report_node"])
        .select(*COLUMNS, "cat", "sch", "name_t", as_written.alias("col"), "reason",
                F.concat(F.array("depth", "at"), "path").alias("path"))
    )
    # the name as an output of any query nested in the block
    area = m.blocks.select(
        "h", "bpos", F.col("head").alias("low"), (F.col("tail") + 1).alias("high")
    )
    asking = sorts.filter("way = 'NESTED'").drop("node").join(area, ["h", "bpos"])
    below = contained(asking, feeding.select("h", "n", F.col("bpos").alias("at")), ["h", "n"])
    nested = (
        asking.join(below.withColumnRenamed("at", "inner"), ["h", "n", "low", "high"])
        .filter(F.col("inner") != F.col("bpos"))
        .join(feeding.select("h", F.col("bpos").alias("inner"), "n", "node", F.col("pos").alias("at"),
                             "depth"), ["h", "inner", "n"])
        .join(results, ["h", "node"])
        .select(*COLUMNS, "cat", "sch", "name_t", "col", "reason",
                F.concat(F.array("depth", "at"), "path").alias("path"))
    )
    nested = keep(nested)
    rest = union_all([
        sorts.filter("way = 'PLAIN'"),
        sorts.filter("way = 'NESTED'").join(nested.select("h", "pos").distinct(), ["h", "pos"], "left_anti")
        .select(*sorts.columns),
    ])
    rest = together(rest.join(to_report, ["h", "node"])).join(read, ["h", "report_node"]).select(
        *COLUMNS, "cat", "sch", "name_t", "col", "reason", "path"
    )
    return union_all([plain, derived, by_output, nested, rest])
