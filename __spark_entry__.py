"""

The statement corpus comes from ``orders`` (see ``corpus.py``). Queries over
one corpus in one session share the job's kept results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus
from lineagrid import Lineage
from lineagrid.functions import names, text
from lineagrid.operators import report
from lineagrid.operators.closure import union_all
from lineagrid.operators.predicates import split_conditions
from lineagrid.session import new_folder, prepare
from lineagrid.sources.statements import (
    CSV_OPTIONS, STATEMENT_SCHEMA, append_stages, read_stages, read_statements, write_report,
)

try:
    import corpus_pipeline
    from lineagrid.llm import queries as llm
except ImportError:  # the text operators are a part that can be taken out
    llm = None

TABLES = ["orders", "lineitem", "documents", "pages", "conversations", "labels", "benchmark"]
_jobs: dict[tuple[str, str], Lineage] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, source: str, sql: str) -> DataFrame:
    """A relation given by SQL text over one of the tables."""
    return spark.sql(sql.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "orders", corpus.STATEMENTS)


def job(spark: SparkSession, sf_dir: str) -> Lineage:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _jobs:
        _jobs[key] = Lineage(statements(spark, sf_dir))
    return _jobs[key]


def forget_jobs() -> None:
    """Start the next query from the source tables again."""
    _jobs.clear()


# --- derived inputs that Spark and DuckDB build alike ------------------------

COMMENTED = """
SELECT o_orderkey AS id,
       concat('SELECT a.x -- priority ', o_orderpriority, chr(10), 'FROM t a WHERE a.s = ''--',
              o_orderstatus, ''' -- by ', CAST(o_custkey AS STRING), ' AND a.y = "c--d" --') AS txt,
       concat('SELECT a.x /*priority ', o_orderpriority, '*/', chr(10), 'FROM t a WHERE a.s = ''--',
              o_orderstatus, ''' /*by ', CAST(o_custkey AS STRING), '*/AND a.y = "c--d" /**/')
         AS expected
FROM orders
"""
HOLDERS = """
SELECT o_orderkey AS id,
       concat('x = ''#D', o_orderstatus, '#'' and y = #P_', CAST(o_custkey AS STRING),
              '# and z = #D', o_orderstatus, '#') AS txt,
       concat('x = ''__SQLGLOT_PH_0__'' and y = __SQLGLOT_PH_1__ and z = __SQLGLOT_PH_2__') AS masked,
       concat('#D', o_orderstatus, '#|#P_', CAST(o_custkey AS STRING), '#|#D', o_orderstatus, '#')
         AS originals
FROM orders
"""
DYNAMIC = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 8
    WHEN 0 THEN concat('x = ''''''||p_', CAST(o_custkey AS STRING), '||''''''')
    WHEN 1 THEN concat('x = a || v', CAST(o_custkey AS STRING), ' || b')
    WHEN 2 THEN concat('FROM t', CAST(o_custkey AS STRING), ' PARTITION(P#D#) a')
    WHEN 3 THEN concat('x = ''''', o_orderstatus, '''''')
    WHEN 4 THEN concat('SELECT a, SELECT b FROM t', CAST(o_custkey AS STRING))
    WHEN 5 THEN concat('SELECT #a#'' , b FROM t', CAST(o_custkey AS STRING), ' ''WHERE 1 = 1')
    WHEN 6 THEN concat('SELECT a FROM t PARTITION (p', CAST(o_custkey AS STRING), ') WHERE x = 1'';')
    ELSE concat('x = ''a'' || ''', o_orderstatus, '''')
  END AS txt,
  CASE o_orderkey % 8
    WHEN 0 THEN concat('x = #p_', CAST(o_custkey AS STRING), '#')
    WHEN 1 THEN concat('x = a #v', CAST(o_custkey AS STRING), '# b')
    WHEN 2 THEN concat('FROM t', CAST(o_custkey AS STRING), '  a')
    WHEN 3 THEN concat('x = ''', o_orderstatus, '''')
    WHEN 4 THEN concat('SELECT a, b FROM t', CAST(o_custkey AS STRING))
    WHEN 5 THEN concat('SELECT #a# , b FROM t', CAST(o_custkey AS STRING), ' WHERE 1 = 1')
    WHEN 6 THEN 'SELECT a FROM t  WHERE x = 1;'
    ELSE concat('x = ''a', o_orderstatus, '''')
  END AS expected
FROM orders
"""
DOTTED = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 6
    WHEN 0 THEN concat('s.TAB', CAST(o_custkey AS STRING), '@LNK')
    WHEN 1 THEN concat('TAB', CAST(o_custkey AS STRING), '@LNK.WORLD')
    WHEN 2 THEN concat('TAB', CAST(o_custkey AS STRING), '@')
    WHEN 3 THEN concat('"S"."T', CAST(o_custkey AS STRING), '"')
    WHEN 4 THEN concat('c.[s].t', CAST(o_custkey AS STRING))
    ELSE concat(' t', CAST(o_custkey AS STRING), ' ')
  END AS name
FROM orders
"""
PREDICATES = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 5
    WHEN 0 THEN concat('WHERE a = ', CAST(o_custkey AS STRING), ' AND b BETWEEN 1 AND 2 AND (c = 1 AND d = 2)')
    WHEN 1 THEN concat('a = ', CAST(o_custkey AS STRING), ' AND b = 2 OR c = 3')
    WHEN 2 THEN concat('AND CASE WHEN a = 1 AND b = 2 THEN ', CAST(o_custkey AS STRING), ' END = 3 AND c = ''x AND y''')
    WHEN 3 THEN concat('(a = 1 AND b = ', CAST(o_custkey AS STRING))
    ELSE concat('a NOT BETWEEN 1 AND 2 AND b IN (1, ', CAST(o_custkey AS STRING), ')')
  END AS txt
FROM orders
"""
PIECES = """
SELECT o_orderkey AS id, p.n AS pred_no,
  replace(p.predicate, '~', CAST(o_custkey AS STRING)) AS predicate
FROM orders JOIN (VALUES
  (0, 0, 'a = ~'), (0, 1, 'b BETWEEN 1 AND 2'), (0, 2, '(c = 1 AND d = 2)'),
  (1, 0, 'a = ~ AND b = 2 OR c = 3'),
  (2, 0, 'CASE WHEN a = 1 AND b = 2 THEN ~ END = 3'), (2, 1, 'c = ''x AND y'''),
  (3, 0, '(a = 1 AND b = ~'),
  (4, 0, 'a NOT BETWEEN 1 AND 2'), (4, 1, 'b IN (1, ~)')) p(m, n, predicate)
  ON o_orderkey % 5 = p.m
"""
NEGATED = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 4
    WHEN 0 THEN concat('NOT a.x LIKE ''', o_orderstatus, '%''')
    WHEN 1 THEN concat('NOT a.x IN (', CAST(o_custkey AS STRING), ', 2)')
    WHEN 2 THEN concat('NOT f(a.x) BETWEEN 1 AND ', CAST(o_custkey AS STRING))
    ELSE concat('NOT (a.x = ', CAST(o_custkey AS STRING), ')') END AS txt,
  CASE o_orderkey % 4
    WHEN 0 THEN concat('a.x NOT LIKE ''', o_orderstatus, '%''')
    WHEN 1 THEN concat('a.x NOT IN (', CAST(o_custkey AS STRING), ', 2)')
    WHEN 2 THEN concat('f(a.x) NOT BETWEEN 1 AND ', CAST(o_custkey AS STRING))
    ELSE concat('NOT (a.x = ', CAST(o_custkey AS STRING), ')') END AS expected
FROM orders
"""
# half of all rows share the empty schema; links are NULL for half of them
REPORT_INPUT = """
SELECT CASE WHEN l_returnflag = 'N' THEN '' ELSE concat('S_', l_returnflag) END AS "SCHEMA",
       CASE WHEN l_linenumber = 7 THEN '' ELSE concat('T', CAST(l_suppkey % 20 AS STRING)) END AS "TABLE",
       CASE WHEN l_linestatus = 'O' THEN '@L' END AS "DBLINK",
       CASE WHEN l_partkey % 9 = 0 THEN '' ELSE concat('C', CAST(l_partkey % 50 AS STRING)) END AS "COLUMN",
       CASE WHEN l_quantity > 25 THEN ''
            ELSE concat('q = ', CAST(CAST(l_quantity AS INT) AS STRING), ' AND t BETWEEN 0 AND ',
                        CAST(l_linenumber AS STRING)) END AS "WHERE_CONDITION",
       concat('SELECT C', CAST(l_linenumber AS STRING)) AS "CLAUSE",
       l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4
FROM lineitem
"""


def _report_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(spark, sf_dir, "lineitem", REPORT_INPUT.replace('"', "`"))
    return rows.withColumn("place", F.struct("k1", "k2", "k3", "k4")).drop("k1", "k2", "k3", "k4")


def _no_space(column: str):
    return F.regexp_replace(column, r"\s+", "")


# --- queries ---------------------------------------------------------------


def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.clean_statement(F.col("text")).alias("cleaned")
    )


def clean_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.clean_statement(F.col("html")).alias("cleaned")
    )


def clean_turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", text.clean_statement(F.col("text")).alias("cleaned")
    )


def inline_comments(spark, sf_dir):
    return derived(spark, sf_dir, "orders", COMMENTED).select(
        "id", text.inline_comments_to_block(F.col("txt")).alias("converted")
    )


def mask_placeholders(spark, sf_dir):
    mapping = text.placeholder_map(F.col("txt"))
    return derived(spark, sf_dir, "orders", HOLDERS).select(
        "id", text.mask_placeholders(F.col("txt")).alias("masked"),
        F.array_join(F.map_values(mapping), "|").alias("originals"),
    )


def restore_placeholders(spark, sf_dir):
    masked = text.mask_placeholders(F.col("txt"))
    return derived(spark, sf_dir, "orders", HOLDERS).select(
        "id", text.restore_placeholders(masked, text.placeholder_map(F.col("txt"))).alias("restored")
    )


def normalize_dynamic_sql(spark, sf_dir):
    return derived(spark, sf_dir, "orders", DYNAMIC).select(
        "id", text.normalize_dynamic_sql(F.col("txt")).alias("normalized")
    )


def table_names(spark, sf_dir):
    only = names.table_only(F.col("name"))
    name, link = names.split_dblink(only)
    schema, last = names.last_two_parts(F.col("name"))
    return derived(spark, sf_dir, "orders", DOTTED).select(
        "id", only.alias("table_only"), name.alias("table_part"), link.alias("dblink"),
        schema, last, names.qualified(schema, last).alias("qualified"),
    )


def readable_not(spark, sf_dir):
    return derived(spark, sf_dir, "orders", NEGATED).select(
        "id", text.readable_not(F.col("txt")).alias("readable")
    )


def text_aliases(spark, sf_dir):
    pairs = text.text_alias_pairs(F.col("SELECT_STATEMENT"))
    return statements(spark, sf_dir).select(
        "stmt_id", F.inline(text.last_by_alias(pairs))
    )


def text_tables(spark, sf_dir):
    return statements(spark, sf_dir).select(
        "stmt_id", F.posexplode(text.text_table_refs(F.col("SELECT_STATEMENT"))).alias("pos", "r")
    ).select("stmt_id", (F.col("pos") + 1).alias("nth"), "r.schema_name", "r.table_name")


def token_depth(spark, sf_dir):
    prepare(spark)
    work = job(spark, sf_dir)
    per_text = work.tokens.groupBy("h").agg(
        F.count("*").alias("n_tokens"), F.max("dp").alias("max_depth")
    )
    return work._per_statement(per_text)


def parse_status(spark, sf_dir):
    work = job(spark, sf_dir)
    status = F.when(F.col("parse_error").isNotNull(), "rejected").when(
        F.col("sql") != F.col("text"), "rewritten").otherwise("as given")
    return work._per_statement(work.texts.select("h", status.alias("status"), "parse_error"))


def query_blocks(spark, sf_dir):
    return job(spark, sf_dir).query_blocks().drop("raw_sql")


def catalog_tables(spark, sf_dir):
    return job(spark, sf_dir).catalog_tables().drop("raw_sql", "table_id", "catalog_name")


def catalog_columns(spark, sf_dir):
    return job(spark, sf_dir).catalog_columns().drop("clause_sql", "raw_sql")


def clause_texts(spark, sf_dir):
    return job(spark, sf_dir).catalog_columns().groupBy("clause_type", "clause_sql").agg(
        F.count("*").alias("n_rows")
    )


ROW = ["stmt_id", "block_id", "SCHEMA", "TABLE", "COLUMN", "REASON", "CLAUSE"]


def lineage(spark, sf_dir):
    return job(spark, sf_dir).lineage().select(*ROW, _no_space("WHERE_CONDITION").alias("WHERE_CONDITION"))


def lineage_reasons(spark, sf_dir):
    return job(spark, sf_dir).lineage().groupBy("REASON", "CLAUSE").agg(
        F.count("*").alias("n_rows"), F.countDistinct("stmt_id").alias("n_statements")
    )


def lineage_order_by(spark, sf_dir):
    return job(spark, sf_dir).lineage().filter("CLAUSE = 'ORDER_BY'").select(*ROW)


def lineage_stars(spark, sf_dir):
    return job(spark, sf_dir).lineage().filter(
        F.col("REASON").isin(
            "STAR_ALIAS_FALLBACK", "SUBQUERY_STAR_FALLBACK", "CTE_SINGLE_TABLE_FALLBACK"
        )
    ).select(*ROW)


def lineage_tables(spark, sf_dir):
    return job(spark, sf_dir).lineage().groupBy("SCHEMA", "TABLE").agg(
        F.count("*").alias("n_rows"), F.countDistinct("COLUMN").alias("n_columns"),
        F.countDistinct("stmt_id").alias("n_statements"),
    )


def where_by_table(spark, sf_dir):
    work = job(spark, sf_dir)
    found = work.conditions.join(work.blocks.select("h", "bpos", "block_id"), ["h", "bpos"])
    return work._per_statement(
        found.select("h", "block_id", F.col("sch").alias("SCHEMA"), F.col("name").alias("TABLE"),
                     _no_space("where_condition").alias("WHERE_CONDITION"))
    )


def trace_outputs(spark, sf_dir):
    """Every named output of every statement."""
    work = job(spark, sf_dir)
    return work.trace_outputs(work.named_outputs()).drop("CATALOG")


def rejects(spark, sf_dir):
    return job(spark, sf_dir).rejects()


def unresolved(spark, sf_dir):
    return job(spark, sf_dir).unresolved()


def column_list(spark, sf_dir):
    return job(spark, sf_dir).column_list()


def table_list(spark, sf_dir):
    return job(spark, sf_dir).table_list()


def schema_list(spark, sf_dir):
    return job(spark, sf_dir).schema_list()


def where_list(spark, sf_dir):
    return job(spark, sf_dir).where_list().withColumn("where_list", _no_space("where_list"))


def predicate_split(spark, sf_dir):
    rows = derived(spark, sf_dir, "orders", PREDICATES)
    return split_conditions(rows.select("id", F.col("txt").alias("text")), "id")


def report_merged_conditions(spark, sf_dir):
    return report.merged_conditions(_report_input(spark, sf_dir))


def report_best_rows(spark, sf_dir):
    return report.best_rows(report.with_some_key(_report_input(spark, sf_dir)))


def report_from_rows(spark, sf_dir):
    return report.final_report(_report_input(spark, sf_dir))


def report_rows(spark, sf_dir):
    rows = report.report_rows(job(spark, sf_dir).text_rows())
    return rows.groupBy(*report.COLUMN_KEYS).agg(F.count("*").alias("n_rows"))


def lineage_report(spark, sf_dir):
    merged = F.array_join(F.array_sort(F.split("WHERE_CONDITION", "\nAND ")), " AND ")
    return job(spark, sf_dir).report().withColumn("w", merged).select(
        *report.COLUMN_KEYS, _no_space("w").alias("WHERE_CONDITION")
    )


def report_full(spark, sf_dir):
    return job(spark, sf_dir).report()


def report_written(spark, sf_dir):
    """The report as it is read back from where it was written."""
    path = new_folder(spark, "report")
    write_report(job(spark, sf_dir).report(), path)
    return spark.read.parquet(path)


def statement_formats(spark, sf_dir):
    """The statements, read back from every format they may come in."""
    folder = new_folder(spark, "statements")
    found = statements(spark, sf_dir).select(*STATEMENT_SCHEMA.names)
    tables = []
    for name in ("csv", "json", "orc", "parquet"):
        options = CSV_OPTIONS if name == "csv" else {}
        found.write.options(**options).format(name).save(f"{folder}/{name}")
        read = read_statements(spark, f"{folder}/{name}", name)
        tables.append(read.select(F.lit(name).alias("file_format"), "*"))
    return union_all(tables)


def stage_tables(spark, sf_dir):
    """Rows by stage and statement after a run was appended, and appended again."""
    folder, work = new_folder(spark, "stages"), job(spark, sf_dir)
    append_stages(work, folder, "2024-05-01")
    append_stages(work, folder, "2024-05-01")
    return union_all([
        records.groupBy(F.lit(name).alias("stage"), "stmt_id").agg(F.count("*").alias("n_rows"))
        for name, records in read_stages(spark, folder).items()
    ])


def entry(spark: SparkSession) -> DataFrame:
    """The whole job over the smallest corpus: statements in, report out."""
    return report_full(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        clean_text, clean_pages, clean_turns, inline_comments, mask_placeholders,
        restore_placeholders, normalize_dynamic_sql, table_names, readable_not, text_aliases,
        text_tables, parse_status, token_depth, query_blocks, catalog_tables, catalog_columns, clause_texts,
        lineage, lineage_reasons, lineage_order_by, lineage_stars, lineage_tables, where_by_table,
        trace_outputs, rejects, unresolved, column_list, table_list, schema_list, where_list, predicate_split,
        report_merged_conditions, report_best_rows, report_from_rows, report_rows, lineage_report,
        report_full, report_written, statement_formats, stage_tables,
    ]
    found = {q.__name__: q for q in listed}
    return found if llm is None else found | llm.queries() | llm.more_queries() | {"pipeline": corpus_pipeline.run}


# --- oracles -----------------------------------------------------------------


def _cleaned(column: str) -> str:
    steps = [("_x000D_", "chr(10)", "gi"), ("\\r\\n", "chr(10)", "g"), ("\\r", "chr(10)", "g"),
             ("[\\t ]+", "' '", "g"), ("^[\\s\\p{Z}]+|[\\s\\p{Z}]+$", "''", "g")]
    for pattern, by, flags in steps:
        column = f"regexp_replace({column}, '{pattern}', {by}, '{flags}')"
    return column


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return lineage_oracles()
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return lineage_oracles() | llm.oracle_sql() | whole


def lineage_oracles() -> dict[str, str]:
    stm = f"({corpus.STATEMENTS})"
    good = f"(SELECT * FROM {stm} WHERE READ_MODE = 'Select')"
    k = "replace(v.{0}, '~', s.k)".format

    def expected(block, columns, select):
        return (f"SELECT s.stmt_id, {select} FROM {good} s JOIN "
                f"{corpus.values(block, ['tpl', *columns])} ON s.tpl = v.tpl")

    row_columns = ["block", "sch", "tab", "col", "reason", "spot"]
    rows = expected(
        corpus.LINEAGE, row_columns,
        f'CAST(v.block AS INT) AS block_id, v.sch AS "SCHEMA", {k("tab")} AS "TABLE", '
        f'{k("col")} AS "COLUMN", v.reason AS "REASON", split_part(v.spot, \':\', 1) AS "CLAUSE", s.tpl, '
        "v.spot, v.nth, s.SELECT_STATEMENT",
    )
    conditions = expected(
        corpus.CONDITIONS, ["block", "sch", "tab", "cond"],
        f'CAST(v.block AS INT) AS block_id, v.sch AS "SCHEMA", {k("tab")} AS "TABLE", '
        f"replace({k('cond')}, ' && ', ' AND ') AS cond, {k('cond')} AS pieces",
    )
    clauses = expected(
        corpus.CLAUSES, ["block", "spot", "txt"],
        f"CAST(v.block AS INT) AS block_id, split_part(v.spot, ':', 1) AS clause, v.spot, {k('txt')} AS txt",
    )
    with_where = (
        f"SELECT r.*, coalesce(c.cond, '') AS cond, c.pieces FROM ({rows}) r LEFT JOIN ({conditions}) c "
        'ON r.stmt_id = c.stmt_id AND r.block_id = c.block_id AND r."SCHEMA" = c."SCHEMA" '
        'AND r."TABLE" = c."TABLE"'
    )
    row = ", ".join(f'"{c}"' for c in ROW)
    squeezed = "regexp_replace({0}, '\\s+', '', 'g')".format
    lists = lambda column, name: (
        "SELECT * FROM (" + expected(
            corpus.LISTS, ["outputs", "tables", "schemas", "conds"], f"{column} AS {name}"
        ) + f") WHERE {name} <> ''"
    )
    ref = r"(?i)\b(?:FROM|JOIN)\s+([\w.\[\]\x22]+)"
    aliased = ref + r"\s+(?:AS\s+)?(\w+)"
    parts = (
        "CASE WHEN contains(ref, '.') THEN trim(string_split(ref, '.')[-2], '\"') ELSE '' END AS schema_name, "
        "trim(string_split(ref, '.')[-1], '\"') AS table_name"
    )
    plain = f"(SELECT * REPLACE (replace(SELECT_STATEMENT, chr(160), ' ') AS SELECT_STATEMENT) FROM {stm})"
    part = r"(?:\x22[^\x22]*\x22|[\p{L}_#][\p{L}\p{N}_$@#]*)"
    token = (
        rf"'[^']*(?:''[^']*)*'|{part}(?:\.{part})*(?:\.\*)?|[0-9]+|<>|<=|>=|\|\||\S"
    ).replace("'", "''")
    bad = ", ".join(map(str, corpus.REJECTED))
    error = "CASE tpl " + " ".join(
        f"WHEN {tpl} THEN '{why} | normalized: {why}'" for tpl, why in corpus.REJECTED.items()
    ) + " END"
    rewritten = ", ".join(map(str, corpus.REWRITTEN))
    as_read = "CASE tpl " + " ".join(
        f"WHEN {tpl} THEN replace({corpus.quoted(text)}, '~', k)" for tpl, text in corpus.REWRITTEN.items()
    ) + " ELSE replace(SELECT_STATEMENT, chr(160), ' ') END"
    report_keys = 'PARTITION BY "SCHEMA", "TABLE", "DBLINK"'
    report_place = "k1, k2, k3, k4"
    firsts = (
        f"SELECT *, row_number() OVER ({report_keys}, \"WHERE_CONDITION\" "
        f'ORDER BY "COLUMN", {report_place}) AS rn FROM ({REPORT_INPUT}) WHERE "WHERE_CONDITION" <> \'\''
    )

    def merged(source):
        return f"""
        SELECT "SCHEMA", "TABLE", "DBLINK", string_agg(pred, chr(10) || 'AND ' ORDER BY "COLUMN", {report_place}, n) AS merged
        FROM (SELECT *, row_number() OVER ({report_keys}, pred ORDER BY "COLUMN", {report_place}, n) AS pn FROM (
          SELECT *, 0 AS n, split_part("WHERE_CONDITION", ' AND ', 1) AS pred FROM ({source}) WHERE rn = 1
          UNION ALL
          SELECT *, 1 AS n, substr("WHERE_CONDITION", strpos("WHERE_CONDITION", ' AND ') + 5) AS pred
          FROM ({source}) WHERE rn = 1)) WHERE pn = 1
        GROUP BY "SCHEMA", "TABLE", "DBLINK" """

    named = ('("SCHEMA" <> \'\' OR "TABLE" <> \'\' OR coalesce("DBLINK", \'\') <> \'\' OR "COLUMN" <> \'\')')
    best = f"""
    SELECT "SCHEMA", "TABLE", "DBLINK", "COLUMN", "WHERE_CONDITION", "CLAUSE" FROM (
      SELECT *, row_number() OVER (PARTITION BY "SCHEMA", "TABLE", "DBLINK", "COLUMN" ORDER BY
        CASE WHEN "WHERE_CONDITION" = '' THEN 1 ELSE 0 END, length("WHERE_CONDITION") DESC, {report_place}) AS rn
      FROM ({REPORT_INPUT}) WHERE {named}) WHERE rn = 1"""
    firsts_named = firsts.replace(
        'WHERE "WHERE_CONDITION" <>', f'WHERE {named} AND "WHERE_CONDITION" <>'
    )
    report_table = (
        "CASE WHEN contains(\"TABLE\", '@') THEN split_part(\"TABLE\", '@', 1) ELSE \"TABLE\" END"
    )
    report_link = "CASE WHEN contains(\"TABLE\", '@') THEN '@' || split_part(\"TABLE\", '@', 2) ELSE '' END"
    # rows of each different text once, as its first statement, with what the report takes from them
    report_view = (
        f'SELECT r."SCHEMA", {report_table.replace(chr(34) + "TABLE", "r." + chr(34) + "TABLE")} AS "TABLE", '
        f'{report_link.replace(chr(34) + "TABLE", "r." + chr(34) + "TABLE")} AS "DBLINK", r."COLUMN", r.cond, '
        f'r.pieces, r.stmt_id AS seq, r.nth, t.txt AS "CLAUSE" FROM ({with_where}) r '
        f"JOIN ({clauses}) t ON r.stmt_id = t.stmt_id AND r.block_id = t.block_id AND r.spot = t.spot "
        f"JOIN (SELECT min(stmt_id) AS stmt_id FROM {good} GROUP BY SELECT_STATEMENT) f "
        "ON r.stmt_id = f.stmt_id WHERE NOT starts_with(upper(r.\"COLUMN\"), 'V_')"
    )
    blocks = expected(
        corpus.BLOCKS, ["block", "parent", "type", "alias", "level"],
        "CAST(v.block AS INT) AS block_id, CAST(nullif(v.parent, '') AS INT) AS parent_id, "
        "v.type AS block_type, v.alias AS alias_name, CAST(v.level AS INT) AS level_no, "
        "CAST(v.block AS INT) AS ordinal_position, CASE v.block WHEN '1' THEN 1 ELSE 0 END AS is_root",
    )
    sources = expected(
        corpus.SOURCES, ["block", "name", "sch", "alias", "type"],
        f"CAST(v.block AS INT) AS block_id, {k('name')} AS table_name, v.sch AS schema_name, "
        f"{k('alias')} AS alias_name, v.type AS source_type",
    )
    full_report = f"""
        WITH v AS ({report_view}),
        w AS (SELECT "SCHEMA", "TABLE", "DBLINK", pieces, min(("COLUMN", seq, nth)) AS first
              FROM v WHERE cond <> '' GROUP BY 1, 2, 3, 4),
        cut AS (SELECT *, string_split_regex(pieces, ' && |;+') AS found FROM w),
        p AS (SELECT "SCHEMA", "TABLE", "DBLINK", first, unnest(found) AS pred,
                     generate_subscripts(found, 1) AS n FROM cut),
        once AS (SELECT "SCHEMA", "TABLE", "DBLINK", min((first, n, pred)) AS p FROM p
                 GROUP BY 1, 2, 3, upper(trim(pred))),
        m AS (SELECT "SCHEMA", "TABLE", "DBLINK", string_agg(trim(p[3]), chr(10) || 'AND ' ORDER BY p) AS merged
              FROM once GROUP BY 1, 2, 3),
        b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "SCHEMA", "TABLE", "DBLINK", "COLUMN"
                ORDER BY CASE WHEN cond = '' THEN 1 ELSE 0 END, length(cond) DESC, seq, nth) AS rn FROM v)
              WHERE rn = 1)
        SELECT b."SCHEMA", b."TABLE", b."DBLINK", b."COLUMN",
               coalesce(m.merged, b.cond) AS "WHERE_CONDITION", b."CLAUSE"
        FROM b LEFT JOIN m ON b."SCHEMA" = m."SCHEMA" AND b."TABLE" = m."TABLE" AND b."DBLINK" = m."DBLINK" """
    return {
        "clean_text": f"SELECT doc_id, {_cleaned('text')} AS cleaned FROM documents",
        "clean_pages": f"SELECT page_id, {_cleaned('html')} AS cleaned FROM pages",
        "clean_turns": f"SELECT conv_id, turn, {_cleaned('text')} AS cleaned FROM conversations",
        "inline_comments": f"SELECT id, expected AS converted FROM ({COMMENTED})",
        "mask_placeholders": f"SELECT id, masked, originals FROM ({HOLDERS})",
        "restore_placeholders": f"SELECT id, txt AS restored FROM ({HOLDERS})",
        "normalize_dynamic_sql": f"SELECT id, expected AS normalized FROM ({DYNAMIC})",
        "table_names": f"""
            SELECT id, table_only, CASE WHEN contains(table_only, '@') THEN split_part(table_only, '@', 1)
                     ELSE table_only END AS table_part,
                   CASE WHEN split_part(table_only, '@', 2) <> '' THEN '@' || split_part(table_only, '@', 2)
                     ELSE '' END AS dblink,
                   schema_name, table_name,
                   CASE WHEN schema_name <> '' THEN schema_name || '.' || table_name ELSE table_name END AS qualified
            FROM (SELECT id, trim(list_extract(parts, -1)) AS table_only,
                     CASE WHEN len(parts) > 1 THEN trim(list_extract(parts, -2), ' "[]') ELSE '' END AS schema_name,
                     trim(list_extract(parts, -1), ' "[]') AS table_name
                  FROM (SELECT id, string_split(name, '.') AS parts FROM ({DOTTED})))""",
        "readable_not": f"SELECT id, expected AS readable FROM ({NEGATED})",
        "text_aliases": f"""
            SELECT stmt_id, lower(alias) AS alias, {parts} FROM (
              SELECT *, row_number() OVER (PARTITION BY stmt_id, lower(alias) ORDER BY n DESC) AS rn FROM (
                SELECT stmt_id, unnest(regexp_extract_all(SELECT_STATEMENT, '{aliased}', 1)) AS ref,
                       unnest(regexp_extract_all(SELECT_STATEMENT, '{aliased}', 2)) AS alias,
                       generate_subscripts(regexp_extract_all(SELECT_STATEMENT, '{aliased}', 1), 1) AS n
                FROM {plain})) WHERE rn = 1""",
        "text_tables": f"""
            SELECT stmt_id, row_number() OVER (PARTITION BY stmt_id ORDER BY n) AS nth, {parts} FROM (
              SELECT stmt_id, ref, min(n) AS n FROM (
                SELECT stmt_id, unnest(regexp_extract_all(SELECT_STATEMENT, '{ref}', 1)) AS ref,
                       generate_subscripts(regexp_extract_all(SELECT_STATEMENT, '{ref}', 1), 1) AS n
                FROM {plain}) WHERE lower(ref) <> 'select' GROUP BY stmt_id, ref)""",
        "parse_status": f"""
            SELECT stmt_id, CASE WHEN tpl IN ({bad}) THEN 'rejected' WHEN tpl IN ({rewritten}) THEN 'rewritten'
                   ELSE 'as given' END AS status, {error} AS parse_error FROM {good}""",
        "token_depth": f"""
            SELECT stmt_id, count(*) AS n_tokens, max(dp) AS max_depth FROM (
              SELECT stmt_id, sum(CASE tok WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER w
                       + CASE tok WHEN ')' THEN 1 ELSE 0 END AS dp
              FROM (
                SELECT stmt_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS n FROM (
                  SELECT stmt_id, regexp_extract_all(sql, '{token}') AS toks FROM (
                    SELECT stmt_id, regexp_replace({as_read}, '/[*].*?[*]/', '', 'g') AS sql
                    FROM {good} WHERE tpl NOT IN ({bad}))))
              WINDOW w AS (PARTITION BY stmt_id ORDER BY n))
            GROUP BY stmt_id""",
        "query_blocks": blocks,
        "catalog_tables": sources,
        "catalog_columns": f"""
            SELECT stmt_id, block_id, CASE tpl WHEN {corpus.THREE_PARTS} THEN 'ARCH' ELSE '' END AS catalog_name,
                   "SCHEMA" AS schema_name,
                   "TABLE" AS table_name, "COLUMN" AS column_name, "REASON" AS reason,
                   "CLAUSE" AS clause_type FROM ({rows})""",
        "lineage": f'SELECT {row}, {squeezed("cond")} AS "WHERE_CONDITION" FROM ({with_where})',
        "lineage_reasons": f"""
            SELECT "REASON", "CLAUSE", count(*) AS n_rows, count(DISTINCT stmt_id) AS n_statements
            FROM ({rows}) GROUP BY 1, 2""",
        "lineage_order_by": f"SELECT {row} FROM ({rows}) WHERE \"CLAUSE\" = 'ORDER_BY'",
        "lineage_stars": f"""SELECT {row} FROM ({rows}) WHERE "REASON" IN
            ('STAR_ALIAS_FALLBACK', 'SUBQUERY_STAR_FALLBACK', 'CTE_SINGLE_TABLE_FALLBACK')""",
        "lineage_tables": f"""
            SELECT "SCHEMA", "TABLE", count(*) AS n_rows, count(DISTINCT "COLUMN") AS n_columns,
                   count(DISTINCT stmt_id) AS n_statements FROM ({rows}) GROUP BY 1, 2""",
        "where_by_table": f"""SELECT stmt_id, block_id, "SCHEMA", "TABLE",
            {squeezed("cond")} AS "WHERE_CONDITION" FROM ({conditions})""",
        "trace_outputs": expected(
            corpus.TRACES, ["block", "target", "sch", "tab", "col", "reason"],
            f'CAST(v.block AS INT) AS block_id, v.target, v.sch AS "SCHEMA", {k("tab")} AS "TABLE", '
            f'{k("col")} AS "COLUMN", v.reason AS "REASON"',
        ),
        "rejects": f"""
            SELECT stmt_id, JOB_NAME, SELECT_STATEMENT, {error} AS parse_error
            FROM {good} WHERE tpl IN ({bad})""",
        "unresolved": f"""
            SELECT r.stmt_id, s.JOB_NAME, r."COLUMN", r."REASON", s.SELECT_STATEMENT
            FROM ({rows}) r JOIN {good} s ON r.stmt_id = s.stmt_id
            WHERE r."SCHEMA" = '' AND r."TABLE" = ''""",
        "column_list": lists("v.outputs", "column_list"),
        "table_list": lists(k("tables"), "table_list"),
        "schema_list": lists("v.schemas", "schema_list"),
        "where_list": lists(squeezed(f"replace({k('conds')}, ' / ', '|')"), "where_list"),
        "predicate_split": PIECES,
        "report_merged_conditions": merged(firsts),
        "report_best_rows": best,
        "report_from_rows": f"""
            SELECT b."SCHEMA", b."TABLE", b."DBLINK", b."COLUMN",
                   coalesce(m.merged, b."WHERE_CONDITION") AS "WHERE_CONDITION", b."CLAUSE"
            FROM ({best}) b LEFT JOIN ({merged(firsts_named)}) m ON b."SCHEMA" = m."SCHEMA"
              AND b."TABLE" = m."TABLE" AND b."DBLINK" IS NOT DISTINCT FROM m."DBLINK" """,
        "report_rows": f"""
            SELECT "SCHEMA", "TABLE", "DBLINK", "COLUMN", count(*) AS n_rows FROM (
              SELECT DISTINCT ON (t.SELECT_STATEMENT, r.rn) r.* FROM (
                SELECT *, row_number() OVER (PARTITION BY stmt_id) AS rn FROM (
                  SELECT stmt_id, "SCHEMA", {report_table} AS "TABLE", {report_link} AS "DBLINK", "COLUMN"
                  FROM ({rows}) WHERE NOT starts_with(upper("COLUMN"), 'V_'))) r
              JOIN (SELECT SELECT_STATEMENT, min(stmt_id) AS stmt_id FROM {good} GROUP BY 1) t
                ON r.stmt_id = t.stmt_id) GROUP BY 1, 2, 3, 4""",
        "lineage_report": f"""
            SELECT "SCHEMA", "TABLE", "DBLINK", "COLUMN",
                   {squeezed("array_to_string(list_sort(string_split(\"WHERE_CONDITION\", chr(10) || 'AND ')), ' AND ')")}
                     AS "WHERE_CONDITION"
            FROM ({full_report})""",
        "report_full": full_report,
        "report_written": full_report,
        "clause_texts": f"""
            SELECT c.clause AS clause_type, c.txt AS clause_sql, count(*) AS n_rows
            FROM ({rows}) r JOIN ({clauses}) c ON r.stmt_id = c.stmt_id AND r.block_id = c.block_id
              AND r.spot = c.spot GROUP BY 1, 2""",
        "statement_formats": f"""
            SELECT f.file_format, stmt_id, JOB_NAME, READ_MODE, SELECT_STATEMENT
            FROM {stm} CROSS JOIN (VALUES ('csv'), ('json'), ('orc'), ('parquet')) f(file_format)""",
        "stage_tables": f"""
            SELECT 'query_blocks' AS stage, stmt_id, count(*) AS n_rows FROM ({blocks}) GROUP BY 2
            UNION ALL SELECT 'catalog_tables', stmt_id, count(*) FROM ({sources}) GROUP BY 2
            UNION ALL SELECT 'catalog_columns', stmt_id, count(*) FROM ({rows}) GROUP BY 2""",
    }
