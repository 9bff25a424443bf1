"""From lineage rows to the final table of columns and conditions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.functions.names import split_dblink, table_only
from lineagrid.functions.text import strip
from lineagrid.operators.predicates import split_conditions
from lineagrid.session import keep

TABLE_KEYS = ["SCHEMA", "TABLE", "DBLINK"]
COLUMN_KEYS = [*TABLE_KEYS, "COLUMN"]
REPORT = [*COLUMN_KEYS, "WHERE_CONDITION", "CLAUSE"]


def shown_clause() -> Column:
    """The clause's text, or its kind where it has none."""
    return F.when(F.col("CLAUSE_SQL") != "", F.col("CLAUSE_SQL")).otherwise(F.col("CLAUSE"))


def report_rows(rows: DataFrame) -> DataFrame:
    """Lineage rows with the names of the report; their other columns stay.

    The part before a dot is cut off before the link is split at '@', so a
    dotted link leaves its last part as the table. V_ columns are dropped.
    """
    table, dblink = split_dblink(table_only(F.col("TABLE")))
    found = rows.filter(~F.upper("COLUMN").startswith("V_")).select(
        "*", table.alias("_table"), dblink.alias("DBLINK")
    ).drop("TABLE").withColumnRenamed("_table", "TABLE")
    if "CLAUSE_SQL" in rows.columns:
        found = found.withColumn("CLAUSE", shown_clause()).drop("CLAUSE_SQL")
    return found


def _text(name: str):
    return F.coalesce(F.col(name), F.lit(""))


#: conditions that are put together at a time
SEGMENT = 256


def table_id() -> Column:
    """One value for a table's three names, nulls told apart from empty names."""
    return F.unhex(F.md5(F.to_json(F.struct(*TABLE_KEYS))))


def text_id(name: str) -> Column:
    return F.unhex(F.md5(name))


def cut_texts(texts: DataFrame, text: str) -> DataFrame:
    """(text_id, chunk_no, pred_no, predicate, key) of different condition texts
    (text_id, text). ``key`` is the same for predicates that differ only in
    case, blanks or a leading AND."""
    chunks = texts.select(
        "text_id", F.posexplode(F.split(text, ";+")).alias("chunk_no", "chunk")
    )
    chunks = chunks.filter(strip(F.col("chunk")) != "").select(
        F.struct("text_id", "chunk_no").alias("id"), F.col("chunk").alias("text"),
    )
    collapsed = strip(F.regexp_replace("predicate", r"(?U)\s+", " "))
    key = F.upper(strip(F.regexp_replace(collapsed, r"(?i)^AND\s+", "")))
    return (
        split_conditions(chunks, "id")
        .select("id.text_id", "id.chunk_no", "pred_no", "predicate", key.alias("key"))
        .filter("key <> ''")
    )


def split_texts(texts: DataFrame) -> DataFrame:
    """(text_id, chunk_no, pred_no, predicate, pred_id) of different condition texts
    (text_id, where_text), ``pred_id`` being that of the ``key``."""
    return cut_texts(texts, "where_text").withColumn("pred_id", text_id("key")).drop("key")


def conditions_by_table(uses: DataFrame, pieces: DataFrame) -> DataFrame:
    """(table_id, nth, predicate): every condition of a table once, in order.

    ``uses`` is (table_id, text_id, first), with ``first`` the place of a text's first use.
    Conditions are folded by their ids and numbered in two steps, within ranges of the
    sorted whole and by where the ranges start, so a table touched by very many
    conditions is no task of its own. Texts come back at the end, by id.
    """
    once = (
        uses.join(pieces.drop("predicate"), "text_id")
        .groupBy("table_id", "pred_id")
        .agg(F.min(F.struct("first", "chunk_no", "pred_no", "text_id")).alias("p"))
        .select("table_id", "p.*")
    )
    order = ["first", "chunk_no", "pred_no"]
    ranged = keep(
        once.repartitionByRange("table_id", *order).withColumn("part", F.spark_partition_id())
    )
    before = Window.partitionBy("table_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("table_id", "part").agg(F.count("*").alias("n")).select(
        "table_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("table_id", "part").orderBy(*order)
    return (
        ranged.withColumn("n", F.row_number().over(inside))
        .join(starts, ["table_id", "part"])
        .select("table_id", (F.col("start") + F.col("n")).alias("nth"), "text_id", "chunk_no", "pred_no")
        .join(pieces.drop("pred_id"), ["text_id", "chunk_no", "pred_no"])
        .select("table_id", "nth", "predicate")
    )


def cells(conditions: DataFrame) -> DataFrame:
    """(table_id, merged): the conditions of a table as the one text that the report
    shows, put together by segments first."""

    def joined(df: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
        rows = F.array_sort(F.collect_list(F.struct(order, text)))
        return df.groupBy(*keys).agg(
            F.array_join(F.transform(rows, lambda r: r[text]), "\nAND ").alias("merged")
        )

    segments = conditions.withColumn("segment", F.floor((F.col("nth") - 1) / SEGMENT))
    parts = joined(segments, ["table_id", "segment"], "nth", "predicate")
    return joined(parts.withColumnRenamed("merged", "part"), ["table_id"], "segment", "part")


def merged_conditions(rows: DataFrame) -> DataFrame:
    """(SCHEMA, TABLE, DBLINK, merged): all conditions of a table, each once.

    Equal texts are folded before anything is split, each different text is
    split once for all tables, and equal conditions are folded again before
    they are put together.
    """
    where = (
        rows.withColumn("where_text", strip(_text("WHERE_CONDITION")))
        .filter("where_text <> ''")
        .withColumn("text_id", text_id("where_text")).withColumn("table_id", table_id())
    )
    uses = where.groupBy("table_id", "text_id").agg(F.min(F.struct("COLUMN", "place")).alias("first"))
    pieces = keep(split_texts(where.select("text_id", "where_text").dropDuplicates(["text_id"])))
    names = where.select("table_id", *TABLE_KEYS).dropDuplicates(["table_id"])
    return names.join(cells(conditions_by_table(uses, pieces)), "table_id").drop("table_id")


def best_rows(rows: DataFrame) -> DataFrame:
    """One row per column: one with a condition, the longest, the earliest.

    A grouped minimum instead of a ranked window: it is reduced on the map
    side, so a column mentioned in very many statements is no hot task.
    """
    length = F.length(_text("WHERE_CONDITION"))
    rank = F.struct((-length).alias("short"), "place", "WHERE_CONDITION", "CLAUSE")
    return rows.groupBy(*COLUMN_KEYS).agg(F.min(rank).alias("best")).select(
        *COLUMN_KEYS, "best.WHERE_CONDITION", "best.CLAUSE"
    )


def best_places(rows: DataFrame) -> DataFrame:
    """The same choice for rows (keys, seq, row_no, where_length) whose texts are kept
    elsewhere: (keys, seq, row_no) of the best row of each column.

    Length, statement and number in the statement make up one fixed-width number,
    so the minimum is a hash aggregation over numbers.
    """
    def number(value: Column, power: int) -> Column:
        return value.cast("decimal(20,0)") * F.lit(Decimal(2**power))

    rank = (
        number(F.lit(2**31 - 1) - F.col("where_length"), 95)
        + number(F.col("seq").cast("decimal(20,0)") + F.lit(Decimal(2**63)), 31)
        + number(F.col("row_no"), 0)
    )
    ranked = rows.select(*COLUMN_KEYS, "seq", "row_no", rank.cast("decimal(38,0)").alias("rank"))
    return ranked.groupBy(*COLUMN_KEYS).agg(
        F.min_by("seq", "rank").alias("seq"), F.min_by("row_no", "rank").alias("row_no")
    )


def with_some_key(rows: DataFrame) -> DataFrame:
    """Rows that name at least a schema, table, link or column."""
    named = F.lit(False)
    for name in COLUMN_KEYS:
        named = named | (_text(name) != "")
    return rows.filter(named)


def merge_back(best: DataFrame, merged: DataFrame) -> DataFrame:
    """Give every row of a table its merged conditions (table_id, merged), where there are any."""
    use = F.trim(F.coalesce("merged", F.lit(""))) != ""
    return best.withColumn("table_id", table_id()).join(merged, "table_id", "left").select(
        *COLUMN_KEYS, F.when(use, F.col("merged")).otherwise(F.col("WHERE_CONDITION")).alias("WHERE_CONDITION"),
        "CLAUSE",
    )


def in_order(table: DataFrame) -> DataFrame:
    """The report in order of its keys; an empty input keeps the six columns."""
    return table.select(*REPORT).orderBy(*[F.asc_nulls_last(k) for k in COLUMN_KEYS])


def final_report(rows: DataFrame) -> DataFrame:
    """The report of given rows (report columns and place)."""
    rows = with_some_key(rows)
    merged = merged_conditions(rows).withColumn("table_id", table_id()).select("table_id", "merged")
    return in_order(merge_back(best_rows(rows), merged))
