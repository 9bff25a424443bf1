"""Per-statement lists of outputs, tables, conditions and schemas, and the
stage record of sources. Outer blocks come first, then text order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.functions.names import qualified
from lineagrid.functions.text import readable_not, unmark_placeholders
from lineagrid.operators.render import render


def joined_once(items: DataFrame, separator: str, name: str) -> DataFrame:
    """(h, name): items (h, place, item) in order, repeats dropped."""
    return (
        items.groupBy("h", "item")
        .agg(F.min("place").alias("place"))
        .groupBy("h")
        .agg(F.array_sort(F.collect_list(F.struct("place", "item"))).alias("all"))
        .select("h", F.array_join(F.transform("all", lambda x: x["item"]), separator).alias(name))
    )


def _levels(job) -> DataFrame:
    return job.blocks.select("h", "bpos", "level_no", "block_id")


def column_list(job) -> DataFrame:
    unnamed = job.outputs.filter("out_name IS NULL").select(
        "h", "bpos", "out_no", "start", F.col("full_end").alias("end")
    )
    texts = render(unnamed, job.texts, ["bpos", "out_no"])
    items = (
        job.outputs.join(_levels(job), ["h", "bpos"])
        .join(texts, ["h", "bpos", "out_no"], "left")
        .select("h", F.struct("level_no", "block_id", "out_no").alias("place"),
                F.coalesce("out_name", "text").alias("item"))
        .filter("item <> ''")
    )
    return joined_once(items, ", ", "column_list")


def _tables(job) -> DataFrame:
    return job.tables.join(_levels(job), ["h", "bpos"]).select(
        "h", F.struct("level_no", "pos").alias("place"),
        unmark_placeholders(F.col("sch")).alias("sch"), unmark_placeholders(F.col("name")).alias("name"),
    )


def table_list(job) -> DataFrame:
    items = _tables(job).select("h", "place", qualified(F.col("sch"), F.col("name")).alias("item"))
    return joined_once(items, ", ", "table_list")


def schema_list(job) -> DataFrame:
    items = _tables(job).filter("sch <> ''").select("h", "place", F.col("sch").alias("item"))
    return joined_once(items, ", ", "schema_list")


def where_list(job) -> DataFrame:
    ranges = job.segments.filter("clause = 'WHERE'").select(
        "h", "bpos", (F.col("cpos") + 1).alias("start"), "end"
    )
    items = (
        render(ranges, job.texts, ["bpos"])
        .join(_levels(job), ["h", "bpos"])
        .select("h", F.struct("level_no", "block_id").alias("place"),
                readable_not(F.col("text")).alias("item"))
    )
    return joined_once(items, " | ", "where_list")


def catalog_tables(job) -> DataFrame:
    """Stage record of every FROM entry."""
    own = job.sources.filter("NOT borrowed").join(_levels(job), ["h", "bpos"])
    width = job.tables.select("h", "pos", "alias_width")
    ends = job.scopes.select("h", F.col("spos").alias("pos"), "end_pos",
                             F.when(F.col("alias").isNotNull(), 1).otherwise(0).alias("has_alias"))
    own = own.join(width, ["h", "pos"], "left").join(ends, ["h", "pos"], "left")
    stop = F.when(F.col("kind") == "S", F.col("end_pos") + F.col("has_alias")).otherwise(
        F.col("pos") + F.col("alias_width")
    )
    texts = render(
        own.select("h", "pos", F.col("pos").alias("start"), stop.alias("end")), job.texts, ["pos"]
    )
    order = Window.partitionBy("h").orderBy("level_no", "block_id", "pos")
    text = lambda c: unmark_placeholders(F.coalesce(c, F.lit("")))
    return (
        own.join(texts, ["h", "pos"])
        .select(
            "h", F.row_number().over(order).alias("table_id"), "block_id",
            text("name").alias("table_name"), text("sch").alias("schema_name"),
            text("cat").alias("catalog_name"), text("alias").alias("alias_name"),
            F.when(F.col("kind") == "T", "PHYSICAL_TABLE").when(F.col("kind") == "C", "CTE")
            .otherwise("SUBQUERY").alias("source_type"),
            F.col("text").alias("raw_sql"),
        )
    )
