"""Lineage of single statements; all run as one corpus, in one job."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus
from conftest import statement_table
from lineagrid import Lineage
from lineagrid.operators import scopes
from lineagrid.session import checkpoint_dir
from lineagrid.sources.statements import append_stages, read_stages

# name -> (statement, rows that must be there, rows that must not be there)
# a row is (SCHEMA, TABLE, COLUMN, REASON, CLAUSE)
CASES = {
    "a name handed down two set operations and a grouping": (
        """WITH paid AS (
             SELECT f.ship, f.amount, f.port FROM dues.harbour_fee f
             INTERSECT SELECT g.ship, g.amount, g.port FROM dues.ledger g
             MINUS SELECT w.ship, w.amount, w.port FROM dues.waived w WHERE w.till > SYSDATE),
           best AS (SELECT port, MAX(amount) AS top, MIN(ship) KEEP (DENSE_RANK LAST ORDER BY amount) AS payer
             FROM paid GROUP BY port)
           SELECT b.payer, b.top - (SELECT AVG(q.amount) FROM paid q) gap FROM best b, ports p
           WHERE b.port = p.code OR p.code IS NULL""",
        [("DUES", t, c, "", "PROJECTION") for t in ("HARBOUR_FEE", "LEDGER", "WAIVED") for c in ("SHIP", "AMOUNT")]
        + [("DUES", "WAIVED", "PORT", "", "WHERE"), ("DUES", "WAIVED", "PORT", "", "GROUP_BY"),
           ("", "PORTS", "CODE", "", "WHERE"), ("DUES", "WAIVED", "TILL", "", "WHERE")],
        [("DUES", "HARBOUR_FEE", "PAYER", "", "PROJECTION"), ("", "PORTS", "GAP", "", "PROJECTION")],
    ),
    "a CTE that only reads itself": (
        "WITH r AS (SELECT r.m FROM r) SELECT r.m FROM r", [("", "DUAL", "M", "DERIVED_COLUMN", "PROJECTION")], [],
    ),
    "columns that swap places in a recursive CTE": (
        "WITH r AS (SELECT a.n, a.m FROM t1 a, t2 b UNION ALL SELECT r.m AS n, r.n AS m FROM r) SELECT r.n FROM r",
        [("", "T1", "N", "", "PROJECTION"), ("", "T1", "M", "", "PROJECTION"),
         ("", "DUAL", "N", "DERIVED_COLUMN", "PROJECTION"), ("", "DUAL", "M", "DERIVED_COLUMN", "PROJECTION")], [],
    ),
    "two recursive CTEs that read each other, and a star over one": (
        "WITH p AS (SELECT a.x FROM t1 a UNION ALL SELECT q.x FROM q), q AS (SELECT b.x FROM t2 b UNION ALL"
        " SELECT p.x FROM p), s AS (SELECT * FROM p) SELECT s.x, s.y FROM s",
        [("", "T1", "X", "", "PROJECTION"), ("", "T2", "X", "", "PROJECTION"),
         ("", "DUAL", "X", "DERIVED_COLUMN", "PROJECTION"), ("", "T1", "Y", "SUBQUERY_STAR_FALLBACK", "PROJECTION")],
        [("", "T1", "X", "SUBQUERY_STAR_FALLBACK", "PROJECTION")],
    ),
    "words after NULLS, CURRENT and DENSE_RANK are no columns": (
        "SELECT MAX(t.a) KEEP (DENSE_RANK FIRST ORDER BY t.d NULLS LAST) AS m,"
        " SUM(t.e) OVER (PARTITION BY t.k ORDER BY t.f ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS r"
        " FROM t1 t ORDER BY t.b NULLS FIRST",
        [("", "T1", c, "", "PROJECTION") for c in "ADEKF"] + [("", "T1", "B", "", "ORDER_BY")],
        [("", "T1", "FIRST", "", "PROJECTION"), ("", "T1", "LAST", "", "PROJECTION"),
         ("", "T1", "ROW", "", "PROJECTION"), ("", "T1", "FIRST", "", "ORDER_BY"),
         ("", "T1", "FIRST", "FIRST_TABLE_FALLBACK", "ORDER_BY")],
    ),
    "types, value words and free literals are no columns": (
        "SELECT CAST(t.a AS TIMESTAMP WITH LOCAL TIME ZONE) AS z, CURRENT_TIMESTAMP ts, SYSTIMESTAMP st,"
        " q'[it's (here)]' AS note, TO_NUMBER(t.n DEFAULT 0 ON CONVERSION ERROR) AS num FROM t1 t",
        [("", "T1", "A", "", "PROJECTION"), ("", "T1", "N", "", "PROJECTION")],
        [("", "T1", c, "", "PROJECTION") for c in
         ("TIME", "ZONE", "LOCAL", "TS", "ST", "Q", "HERE", "CONVERSION", "ERROR", "DEFAULT")],
    ),
    "words of XML and JSON functions are no columns, their operands are": (
        "SELECT XMLELEMENT(NAME ship, XMLATTRIBUTES(t.a AS no), t.b) x1, XMLELEMENT(EVALNAME t.c, t.d) x2,"
        " XMLSERIALIZE(CONTENT t.e AS CLOB) x3, XMLQUERY('/a' PASSING BY VALUE t.f RETURNING CONTENT) x4,"
        " JSON_OBJECT(KEY 'k' VALUE t.g, 'l' VALUE h, KEY t.i VALUE 1) x5, JSON_OBJECT(key VALUE t.j) x6"
        " FROM t1 t",
        [("", "T1", c, "", "PROJECTION") for c in [*"ABCDEFGHIJ", "KEY"]],
        [("", "T1", c, "", "PROJECTION") for c in
         ("NAME", "SHIP", "NO", "EVALNAME", "CONTENT", "CLOB", "VALUE", "PASSING", "RETURNING", "X1")],
    ),
    "a column called value or key stays one": (
        "SELECT MAX(value) AS v, SUM(t.n) OVER (PARTITION BY key ORDER BY value DESC) AS s,"
        " JSON_OBJECT(KEY value VALUE content) AS j FROM t1 t WHERE name = 1 AND document IS NULL",
        [("", "T1", c, "", "PROJECTION") for c in ("VALUE", "N", "KEY", "CONTENT")]
        + [("", "T1", "NAME", "", "WHERE"), ("", "T1", "DOCUMENT", "", "WHERE")], [],
    ),
    "units, character sets, zones and frames": (
        "SELECT DATEDIFF(day, t.a, t.b) AS d, TRANSLATE(t.c USING NCHAR_CS) AS e, t.d AT TIME ZONE t.z AS f,"
        " t.g AT TIME ZONE DBTIMEZONE AS h, SUM(t.n) OVER (ORDER BY t.o DESC GROUPS BETWEEN 1 PRECEDING"
        " AND 1 FOLLOWING EXCLUDE TIES) AS s, OVERLAY(t.p PLACING t.q FROM 2) AS r FROM t1 t",
        [("", "T1", c, "", "PROJECTION") for c in "ABCDZGNOPQ"],
        [("", "T1", c, "", "PROJECTION") for c in
         ("DAY", "NCHAR_CS", "DBTIMEZONE", "GROUPS", "EXCLUDE", "TIES", "PLACING", "ZONE")],
    ),
    "a lateral query is a source under its alias": (
        "SELECT l.y, a.x FROM t1 a, LATERAL (SELECT b.y FROM t2 b WHERE b.k = a.k) l WHERE l.y > 1",
        [("", "T2", "Y", "", "PROJECTION"), ("", "T1", "X", "", "PROJECTION"), ("", "T2", "Y", "", "WHERE")],
        [("", "T1", "Y", "", "PROJECTION"), ("", "T1", "Y", "", "WHERE")],
    ),
    "an applied query is a source under its alias": (
        "SELECT l.y, m.z FROM t1 a JOIN t4 d ON a.i = d.i CROSS APPLY (SELECT b.y FROM t2 b) l"
        " OUTER APPLY (SELECT c.z FROM t3 c) m",
        [("", "T2", "Y", "", "PROJECTION"), ("", "T3", "Z", "", "PROJECTION"), ("", "T1", "I", "", "JOIN_ON"),
         ("", "T4", "I", "", "JOIN_ON")],
        [("", "T1", "APPLY", "", "JOIN_ON"), ("", "T4", "APPLY", "", "JOIN_ON")],
    ),
    "the name behind PIVOT is the source's": (
        "SELECT p.k, u.w, q.v FROM t1 PIVOT (SUM(n) FOR m IN ('a' AS a, 'b' AS b)) p JOIN t2 u ON u.k = p.k,"
        " (SELECT c.v, c.g FROM t3 c) UNPIVOT INCLUDE NULLS (v2 FOR g2 IN (g)) PIVOT XML (MAX(v) FOR h IN (ANY)) q",
        [("", "T1", "K", "", "PROJECTION"), ("", "T2", "W", "", "PROJECTION"), ("", "T3", "V", "", "PROJECTION"),
         ("", "T2", "K", "", "JOIN_ON"), ("", "T1", "K", "", "JOIN_ON")],
        [("", "T1", "V", "", "PROJECTION"), ("", "T2", "V", "", "PROJECTION")],
    ),
    "a source turned without a name keeps its own": (
        "SELECT t1.k, u.k FROM t1 PIVOT (SUM(n) FOR m IN (1, 2)), t2 AS OF SCN 5, t3 u WHERE t2.j = t1.j",
        [("", "T1", "K", "", "PROJECTION"), ("", "T3", "K", "", "PROJECTION"), ("", "T2", "J", "", "WHERE"),
         ("", "T1", "J", "", "WHERE")], [],
    ),
    "the root of a hierarchy names its column": (
        "SELECT CONNECT_BY_ROOT t.a AS top FROM t1 t START WITH t.p IS NULL CONNECT BY PRIOR t.a = t.p",
        [("", "T1", "A", "", "PROJECTION")], [("", "T1", "CONNECT_BY_ROOT", "", "PROJECTION")],
    ),
    "wide blanks are blanks": (
        "SELECT t.a,\u00a0u.b FROM\u00a0t1 t,\u2003t2\u00a0u WHERE t.x = 'a\u00a0b'",
        [("", "T1", "A", "", "PROJECTION"), ("", "T2", "B", "", "PROJECTION"), ("", "T1", "X", "", "WHERE")],
        [],
    ),
    "a bracketed branch keeps its ORDER BY": (
        "(SELECT a.x FROM t1 a ORDER BY a.y FETCH FIRST 1 ROWS ONLY) UNION ALL SELECT b.x FROM t2 b",
        [("", "T1", "Y", "", "ORDER_BY")], [],
    ),
    "a bracketed set operation keeps its ORDER BY to itself": (
        "(SELECT a.x FROM t1 a UNION SELECT c.x FROM t3 c ORDER BY y) UNION ALL SELECT b.x FROM t2 b",
        [], [("", "T3", "Y", "", "ORDER_BY"), ("", "T1", "Y", "", "ORDER_BY")],
    ),
    "outer mention inside a one-table query": (
        "SELECT a.x FROM t1 a, t3 c WHERE EXISTS (SELECT 1 FROM t2 b WHERE b.k = a.k)",
        [("", "T2", "K", "", "WHERE")], [("", "T1", "K", "", "WHERE")],
    ),
    "two mentions of one table are not one table": (
        "SELECT s.x FROM (SELECT a.x FROM t1 a JOIN t1 b ON a.i = b.i) s",
        [("", "T1", "X", "", "PROJECTION")], [],
    ),
    "recursive CTE ends": (
        "WITH r AS (SELECT t.id, t.up FROM tree t WHERE t.up IS NULL UNION ALL"
        " SELECT c.id, c.up FROM tree c JOIN r ON c.up = r.id) SELECT r.id FROM r",
        [("", "TREE", "ID", "", "PROJECTION")], [],
    ),
    "union branches that read one CTE": (
        "WITH c AS (SELECT t.v, u.w FROM t JOIN u ON t.i = u.i)"
        " SELECT x.v FROM (SELECT c.v FROM c UNION ALL SELECT d.v FROM c d) x",
        [("", "T", "V", "", "PROJECTION")], [("", "DUAL", "V", "DERIVED_COLUMN", "PROJECTION")],
    ),
    "bracketed branches": (
        "(SELECT a.x FROM t1 a) UNION (SELECT b.x FROM t2 b)",
        [("", "T1", "X", "", "PROJECTION"), ("", "T2", "X", "", "PROJECTION")], [],
    ),
    "bracketed branches in FROM": (
        "SELECT s.x FROM ((SELECT a.x FROM t1 a) UNION (SELECT b.x FROM t2 b)) s",
        [("", "T1", "X", "", "PROJECTION"), ("", "T2", "X", "", "PROJECTION")], [],
    ),
    "ORDER BY of a set operation is nobody's": (
        "SELECT a.x FROM t1 a UNION SELECT b.x FROM t2 b ORDER BY y",
        [], [("", "T2", "Y", "", "ORDER_BY"), ("", "T1", "Y", "", "ORDER_BY")],
    ),
    "window order stays in the projection": (
        "SELECT ROW_NUMBER() OVER (PARTITION BY a.p ORDER BY a.o) rn FROM t1 a ORDER BY a.z",
        [("", "T1", "P", "", "PROJECTION"), ("", "T1", "O", "", "PROJECTION"),
         ("", "T1", "Z", "", "ORDER_BY")],
        [("", "T1", "O", "", "ORDER_BY"), ("", "T1", "RN", "", "PROJECTION")],
    ),
    "all clauses": (
        "SELECT t.a FROM t1 t WHERE t.b = 1 GROUP BY t.a, t.c HAVING MAX(t.d) > 1"
        " WINDOW w AS (ORDER BY t.e) QUALIFY t.f = 1 ORDER BY t.g",
        [("", "T1", "A", "", "PROJECTION"), ("", "T1", "B", "", "WHERE"),
         ("", "T1", "C", "", "GROUP_BY"), ("", "T1", "D", "", "HAVING"),
         ("", "T1", "E", "", "WINDOW"), ("", "T1", "F", "", "QUALIFY"),
         ("", "T1", "G", "", "ORDER_BY")], [("", "T1", "W", "", "WINDOW")],
    ),
    "USING names no column, a comma after ON names a table": (
        "SELECT c.z FROM t1 a JOIN t2 b USING (k) JOIN t3 d ON a.i = d.i, t4 c",
        [("", "T4", "Z", "", "PROJECTION"), ("", "T3", "I", "", "JOIN_ON")],
        [("", "T1", "K", "", "JOIN_ON")],
    ),
    "words and types are no columns": (
        "SELECT CAST(a.x AS NUMBER) y, EXTRACT(YEAR FROM a.d) z, DATE '2020-01-01' q, SYSDATE s,"
        " INTERVAL '1' DAY, :bind FROM t1 a",
        [("", "T1", "X", "", "PROJECTION"), ("", "T1", "D", "", "PROJECTION")],
        [("", "T1", n, "", "PROJECTION") for n in ["NUMBER", "YEAR", "DATE", "DAY", "SYSDATE", "BIND", "Q"]],
    ),
    "three-part name and old outer join": (
        "SELECT a.x FROM c1.s1.t1 a, t2 b WHERE a.i = b.i(+)",
        [("S1", "T1", "X", "", "PROJECTION"), ("", "T2", "I", "", "WHERE")], [],
    ),
    "placeholder in a table name": (
        "SELECT a.x FROM TBL_#D# a", [("", "TBL_#D#", "X", "", "PROJECTION")], [],
    ),
    "several sub-queries": (
        "SELECT v FROM (SELECT a.v, a.w FROM t1 a JOIN t0 z ON a.i = z.i) p, (SELECT 1 AS u FROM t2) q",
        [("", "T1", "V", "", "PROJECTION")], [],
    ),
    "star over a CTE, then an alias": (
        "WITH c AS (SELECT a.k, b.m FROM t1 a JOIN t2 b ON a.i = b.i), d AS (SELECT * FROM c)"
        " SELECT e.m FROM d e",
        [("", "T2", "M", "SUBQUERY_STAR_FALLBACK", "PROJECTION")], [],
    ),
    "alias of a sub-query that knows no such name": (
        "SELECT s.q FROM (SELECT a.x, b.y FROM t1 a JOIN t2 b ON a.i = b.i) s, t3, t4",
        [("", "S", "Q", "SUBQUERY_ALIAS_FALLBACK", "PROJECTION")], [],
    ),
    "text alias": (
        "SELECT (SELECT MAX(o.z) FROM u, w) m, b.k FROM t1 a JOIN t2 c ON a.i = c.i"
        " WHERE a.i IN (SELECT b.k FROM t3 b, t5 d)",
        [("", "T3", "K", "TEXT_ALIAS_FALLBACK", "PROJECTION")], [],
    ),
    "sub-query in the projection": (
        "SELECT (SELECT MAX(b.z) FROM t2 b) m, a.x FROM t1 a, t3 c",
        [("", "T2", "Z", "", "PROJECTION"), ("", "T1", "X", "", "PROJECTION")], [],
    ),
    "sort key over a scalar sub-query": (
        "SELECT (SELECT MAX(b.z) FROM t2 b WHERE b.k = 1) AS m FROM t1 a, t3 c ORDER BY m",
        [("", "T2", "m", "TEXT_ALIAS_FALLBACK", "ORDER_BY")], [("", "DUAL", "M", "DERIVED_COLUMN", "ORDER_BY")],
    ),
    "sort key over a scalar sub-query and a column": (
        "SELECT (SELECT MAX(b.z) FROM t2 b) + a.x AS m FROM t1 a, t3 c ORDER BY m",
        [("", "T1", "m", "", "ORDER_BY"), ("", "T2", "m", "TEXT_ALIAS_FALLBACK", "ORDER_BY")], [],
    ),
    "sort key over columns two queries down": (
        "SELECT (SELECT COUNT(*) FROM (SELECT b.z FROM t2 b) q) AS m FROM t1 a, t3 c ORDER BY m",
        [("", "T2", "m", "TEXT_ALIAS_FALLBACK", "ORDER_BY")], [("", "DUAL", "M", "DERIVED_COLUMN", "ORDER_BY")],
    ),
    "sort key over a scalar sub-query in a nested query": (
        "SELECT * FROM (SELECT (SELECT MAX(b.z) FROM t2 b WHERE a.i = b.i) AS m FROM t1 a) s ORDER BY m",
        [("", "T1", "Z", "", "ORDER_BY"), ("", "T1", "I", "", "ORDER_BY")], [],
    ),
    "columns named like a phrase after the ON of a join": (
        "SELECT a.x FROM t1 a JOIN t2 l ON error = l.code JOIN t3 m ON overflow = m.code"
        " AND TO_NUMBER(m.n DEFAULT 0 ON CONVERSION ERROR) = 1",
        [("", "T1", "ERROR", "FIRST_TABLE_FALLBACK", "JOIN_ON"), ("", "T1", "OVERFLOW", "FIRST_TABLE_FALLBACK", "JOIN_ON"),
         ("", "T3", "N", "", "JOIN_ON")],
        [("", "T1", "CONVERSION", "FIRST_TABLE_FALLBACK", "JOIN_ON")],
    ),
    "table name of a source-free block": (
        "SELECT (SELECT b.z FROM t2 b) + q m", [("", "T2", "Q", "", "PROJECTION")], [],
    ),
}


#: recursion of every kind: every mention must still give a row
TANGLED = [
    "WITH r AS (SELECT q.a FROM r q, r p) SELECT a, q.b FROM r q, r p",
    "WITH r AS (SELECT a, b AS c FROM (SELECT * FROM r) x, (SELECT r.b AS a FROM r) y) SELECT c, x.a FROM r x, r",
    "WITH a AS (SELECT * FROM b), b AS (SELECT * FROM c), c AS (SELECT * FROM a) SELECT a.v, b.w FROM a, b, c",
    "WITH r AS (SELECT t.k, (SELECT MAX(r.k) FROM r) AS m FROM t UNION SELECT r.m, r.k + r.m AS m FROM r, r s)"
    " SELECT m, s.k FROM (SELECT r.* FROM r) s, r",
]
CHAIN = 10
CHAINED = (
    "WITH c0 AS (SELECT t.x, u.y FROM t JOIN u ON t.i = u.i), "
    + ", ".join(f"c{i} AS (SELECT c{i - 1}.x FROM c{i - 1})" for i in range(1, CHAIN))
    + f" SELECT c{CHAIN - 1}.x FROM c{CHAIN - 1}"
)
FILLED = [t.replace("~", "5") for t in corpus.TEMPLATES]
ALL = [sql for sql, _, _ in CASES.values()] + TANGLED + [CHAINED] + FILLED + FILLED
FIRST_TEMPLATE = len(ALL) - 2 * len(FILLED)


@pytest.fixture(scope="module")
def job(spark):
    """All statements of this file as one corpus."""
    hidden = statement_table(spark, ["SELECT a FROM hidden"], mode="select")
    return Lineage(statement_table(spark, ALL).unionByName(hidden))


@pytest.fixture(scope="module")
def found(job):
    rows = {name: set() for name in CASES}
    names = list(CASES)
    for r in job.lineage().filter(F.col("stmt_id") < len(CASES)).collect():
        rows[names[r.stmt_id]].add((r.SCHEMA, r.TABLE, r.COLUMN, r.REASON, r.CLAUSE))
    return rows


@pytest.mark.parametrize("name", CASES)
def test_case(found, name):
    _, present, absent = CASES[name]
    assert set(present) <= found[name]
    assert not set(absent) & found[name]


def test_no_text_means_no_guess_from_text(spark):
    sql = "SELECT x.col1 FROM t1 JOIN t2 ON t1.id = t2.id"
    job = Lineage(statement_table(spark, [sql]), scan_text=False)
    rows = {(r.TABLE, r.COLUMN, r.REASON, r.CLAUSE) for r in job.lineage().collect()}
    assert ("", "COL1", "UNRESOLVED_TABLE", "PROJECTION") in rows


def test_templates_copies_and_modes(job):
    """Rows of a statement do not depend on the other statements, copies give
    equal rows, and only READ_MODE 'Select' counts."""
    n = len(FILLED)
    got = sorted(
        ((r.stmt_id - FIRST_TEMPLATE) % n, str(r.block_id), r.SCHEMA, r.TABLE, r.COLUMN, r.REASON, r.CLAUSE)
        for r in job.lineage().filter(F.col("stmt_id") >= FIRST_TEMPLATE).collect()
    )
    expected = sorted(
        (int(t), b, s, tab.replace("~", "5"), c.replace("~", "5"), reason, spot.split(":")[0])
        for t, b, s, tab, c, reason, spot in corpus.rows_of(corpus.LINEAGE) for _ in range(2)
    )
    assert got == expected
    assert job.lineage().filter("TABLE = 'HIDDEN'").count() == 0


def test_stages_are_appended_once_however_often(spark, job, tmp_path):
    folder, n_rows = str(tmp_path / "stages"), job.lineage().count()
    for run in ("2024-05-01", "r2", "2024-05-01"):
        append_stages(job, folder, run)
    stages = read_stages(spark, folder)
    assert {(r.run_id, r["count"]) for r in stages["catalog_columns"].groupBy("run_id").count().collect()} == {
        ("2024-05-01", n_rows), ("r2", n_rows)
    }

    class Nothing:
        statements = job.statements

        def __getattr__(self, name):
            return lambda: getattr(job, name)().limit(0)

    append_stages(Nothing(), folder, "r2")
    assert {r.run_id for t in read_stages(spark, folder).values() for r in t.select("run_id").distinct().collect()} == {
        "2024-05-01"
    }


def test_traced_outputs(spark, job):
    targets = spark.createDataFrame(
        [(FIRST_TEMPLATE + t, b, name) for t, b, name in [(2, 1, "IMO"), (13, 1, "ANY"), (16, 3, "twice")]],
        "stmt_id long, block_id int, target string",
    )
    traced = sorted((r.TABLE, r.COLUMN, r.REASON) for r in job.trace_outputs(targets).collect())
    assert traced == [
        ("CLEARED_5", "IMO", ""), ("DETAINED_5", "IMO", ""), ("INBOUND_5", "IMO", ""),
        ("ITEM_5", "KG", ""), ("ITEM_5", "KG", ""),
    ]


def test_every_mention_gives_a_row(job):
    """Also where a trace leads back to where it came from."""
    branch = job.blocks.filter("n_branches > 1 AND NOT bracketed").select("h", "bpos", F.lit("ORDER_BY").alias("clause"))
    asked = job.refs.join(branch, ["h", "bpos", "clause"], "left_anti").select("h", "pos")
    given = job.rows.select("h", F.col("place.pos").alias("pos"))
    assert asked.join(given, ["h", "pos"], "left_anti").count() == 0
    assert asked.count() > 300


def test_a_chain_of_ctes_costs_a_row_for_each(job):
    """What rises from scope to scope is one summary for each edge, not one for each pair."""
    own = job.texts.filter(F.col("text") == CHAINED).select("h")
    edges = job.model.edges.join(own, "h")
    info = job.model.info.join(own, "h")
    values, arrived, cyclic = scopes.scope_values(info, job.sources.join(own, "h"), edges)
    assert (values.count(), arrived.count(), cyclic.count()) == (CHAIN + 1, CHAIN, 0)
    assert {r.first.name for r in values.collect()} == {"t"}
    rows = job.lineage().filter(F.col("stmt_id") == ALL.index(CHAINED)).filter("CLAUSE = 'PROJECTION'")
    assert {(r.TABLE, r.COLUMN) for r in rows.collect()} == {("T", "X"), ("U", "Y")}


def test_report_carries_no_texts_through_its_groupings(job):
    plan = job.report()._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.split("\n") if "Aggregate" in line and "rank" in line]
    assert lines and all("HashAggregate" in line for line in lines)
    assert not any("CLAUSE_SQL" in line or "WHERE_CONDITION" in line for line in plan.split("\n") if "Aggregate" in line)


def test_hot_texts_are_dealt_out(spark, monkeypatch):
    """A text with very many copies goes through several join keys, all rows kept."""
    from lineagrid.plans import pipeline

    monkeypatch.setattr(pipeline, "COPIES_PER_PART", 10)
    texts = ["SELECT a.x, a.y FROM hot a"] * 100 + [f"SELECT a.x FROM t{i} a" for i in range(50)]
    job = Lineage(statement_table(spark, texts))
    assert [r.n_parts for r in job.hot_texts.collect()] == [10]
    got = sorted((r.stmt_id, r.TABLE, r.COLUMN) for r in job.lineage().collect())
    expected = [(i, "HOT", c) for i in range(100) for c in "XY"]
    expected += [(100 + i, f"T{i}", "X") for i in range(50)]
    assert got == sorted(expected)


def test_close_drops_tables_and_files(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    with Lineage(statement_table(spark, ["SELECT t.a FROM t1 t"])) as job:
        assert job.tokens.count() == 5
        own = Path(folder, f"lineagrid-{job.job_id}")
        assert own.exists() and spark.catalog.listTables(pattern=f"lineagrid_{job.job_id}_*")
    assert not own.exists()
    assert not spark.catalog.listTables(pattern=f"lineagrid_{job.job_id}_*")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
