from __future__ import annotations

import random

from pyspark.sql import functions as F

from lineagrid.operators import report
from lineagrid.operators.closure import contained, follow
from lineagrid.operators.predicates import split_conditions
from lineagrid.session import prepare
from lineagrid.sources.statements import read_statements, write_report

ROW = "SCHEMA string, TABLE string, DBLINK string, COLUMN string, WHERE_CONDITION string, CLAUSE string, place int"


def test_report_fixture(spark):
    rows = spark.createDataFrame(
        [
            ("S", "T", "", "A", "", "SELECT A", 1),
            ("S", "T", "", "A", "x = 1", "WHERE x = 1", 2),
            ("S", "T", "", "A", "x = 1 AND y = 2", "WHERE x = 1 AND y = 2", 3),
            ("S", "T", "", "B", "", "SELECT B", 4),
            ("", "", "", "", "z = 1", "SELECT 1", 5),
            ("", "U", "@L", "C", "", "SELECT C", 6),
            (None, "N", None, "D", "w = 1", "SELECT D", 7),
            (None, "N", None, "E", "", "SELECT E", 8),
        ],
        ROW,
    )
    got = [tuple(r) for r in report.final_report(rows).collect()]
    assert got == [
        ("", "U", "@L", "C", "", "SELECT C"),
        ("S", "T", "", "A", "x = 1\nAND y = 2", "WHERE x = 1 AND y = 2"),
        ("S", "T", "", "B", "x = 1\nAND y = 2", "SELECT B"),
        (None, "N", None, "D", "w = 1", "SELECT D"),
        (None, "N", None, "E", "w = 1", "SELECT E"),
    ]


def test_empty_report_keeps_its_columns(spark):
    empty = report.final_report(spark.createDataFrame([], ROW))
    assert empty.columns == report.REPORT and empty.count() == 0


def test_merge_splits_at_semicolons_and_folds_case(spark):
    rows = spark.createDataFrame(
        [("S", "T", "", "A", "x = 1 AND y = 2", "c", 1), ("S", "T", "", "B", "X  =  1; z = 3", "c", 2)], ROW
    )
    assert report.merged_conditions(rows).first().merged == "x = 1\nAND y = 2\nAND z = 3"


def test_best_row_prefers_condition_then_length_then_order(spark):
    """Brute force over random rows, a third of them on one key."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        hot = i % 3 == 0
        table = "HOT" if hot else f"T{rng.randrange(5)}"
        where = "" if rng.random() < 0.3 else "x" * rng.randrange(1, 6)
        rows.append(("S", table, "", "C" if hot else f"C{rng.randrange(4)}", where, f"clause {i}", i))
    best = {}
    for r in rows:
        rank = (0 if r[4] else 1, -len(r[4]), r[6])
        if r[:4] not in best or rank < best[r[:4]][0]:
            best[r[:4]] = (rank, r[4:6])
    got = {tuple(r)[:4]: tuple(r)[4:] for r in report.best_rows(spark.createDataFrame(rows, ROW)).collect()}
    assert got == {k: v for k, (_, v) in best.items()}


def test_link_is_split_after_the_schema_is_cut(spark):
    rows = spark.createDataFrame(
        [("S", "T@L", "A", "", "P", "", 1, 1), ("S", "T@L.WORLD", "B", "SELECT B", "P", "", 1, 2),
         ("S", "T", "v_x", "", "P", "", 1, 3)],
        "SCHEMA string, TABLE string, COLUMN string, CLAUSE_SQL string, CLAUSE string,"
        " WHERE_CONDITION string, seq long, place int",
    )
    got = [(r.TABLE, r.DBLINK, r.COLUMN, r.CLAUSE) for r in report.report_rows(rows).collect()]
    assert got == [("T", "@L", "A", "P"), ("WORLD", "", "B", "SELECT B")]


def test_split_conditions(spark):
    texts = {
        "a=1 AND b BETWEEN 1 AND 2 AND (c=1 AND d=2)": ["a = 1", "b BETWEEN 1 AND 2", "(c = 1 AND d = 2)"],
        "a=1 AND b=2 OR c=3": ["a = 1 AND b = 2 OR c = 3"],
        "WHERE a = 'x AND y' AND CASE WHEN p = 1 AND q = 2 THEN 1 END = 1":
            ["a = 'x AND y'", "CASE WHEN p = 1 AND q = 2 THEN 1 END = 1"],
        "(a = 1 AND b = 2": ["(a = 1 AND b = 2"],
        "  ": [],
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {i: [] for i in range(len(texts))}
    for r in split_conditions(frame, "id").orderBy("id", "pred_no").collect():
        got[r.id].append(r.predicate)
    assert list(got.values()) == list(texts.values())


def test_follow_matches_a_plain_search(spark):
    """Closure with cycles against breadth-first search by hand."""
    prepare(spark)
    rng = random.Random(3)
    edges = {(rng.randrange(12), rng.randrange(12)) for _ in range(25)}
    links = spark.createDataFrame(sorted(edges), "at int, next int")
    seed = spark.range(12).select(F.col("id").cast("int").alias("origin")).select(
        "origin", F.col("origin").alias("at"), F.lit(0).alias("n")
    )
    step = lambda f: f.join(links, "at").select(
        "origin", F.col("next").alias("at"), (F.col("n") + 1).alias("n")
    )
    got = {(r.origin, r.at): r.n for r in follow(seed, step, ["origin", "at"], "n").collect()}
    expected = {}
    for start in range(12):
        frontier, seen, n = {start}, {}, 0
        while frontier:
            seen.update({x: n for x in frontier})
            n += 1
            frontier = {b for a, b in edges if a in frontier} - set(seen)
        expected.update({(start, x): d for x, d in seen.items()})
    assert got == expected


def test_files_round_trip(spark, tmp_path):
    rows = [(1, "J", "Select", 'SELECT "a",\n b FROM t'), (2, "K", "Table", None)]
    table = spark.createDataFrame(
        rows, "stmt_id long, JOB_NAME string, READ_MODE string, SELECT_STATEMENT string"
    )
    for kind in ["parquet", "csv", "json", "orc"]:
        path = str(tmp_path / kind)
        write_report(table, path, kind)
        write_report(table, path, kind)
        back = sorted(tuple(r) for r in read_statements(spark, path, kind).collect())
        assert back == rows, kind


def test_contained_matches_all_pairs(spark):
    rng = random.Random(5)
    points = {(k, 2 * rng.randrange(100)) for k in "ab" for _ in range(30)}
    spans = set()
    for k in "abc":
        for _ in range(20):
            low = 2 * rng.randrange(90) + 1
            spans.add((k, low, low + 2 * rng.randrange(1, 20)))
    got = contained(
        spark.createDataFrame(sorted(spans), "k string, low int, high int"),
        spark.createDataFrame(sorted(points), "k string, at int"), ["k"],
    )
    expected = {(k, lo, hi, p) for k, lo, hi in spans for j, p in points if j == k and lo < p < hi}
    rows = [tuple(r) for r in got.select("k", "low", "high", "at").collect()]
    assert len(rows) == len(expected) and set(rows) == expected


def test_best_places_agree_with_best_rows(spark):
    """The packed order of length, statement and row, with statement ids at both ends."""
    rng = random.Random(8)
    ids = [-(2**63), -5, 0, 7, 2**63 - 1]
    rows = []
    for i in range(300):
        where = "x" * rng.choice([0, 0, 1, 2, 5])
        rows.append(("S", "T", "", f"C{rng.randrange(6)}", where, "c", rng.choice(ids), i, len(where)))
    frame = spark.createDataFrame(
        rows, "SCHEMA string, TABLE string, DBLINK string, COLUMN string, WHERE_CONDITION string, CLAUSE string, "
        "seq long, row_no int, where_length int",
    )
    got = {(r.COLUMN, r.seq, r.row_no) for r in report.best_places(frame).collect()}
    assert got == {
        (c, *min((-r[8], r[6], r[7]) for r in rows if r[3] == c)[1:]) for c in {r[3] for r in rows}
    }


def test_conditions_are_cut_without_exchange_or_sort(spark):
    texts = [" AND ".join(f"a{j} = {j}" for j in range(500)), "a = 1 AND AND b = 2 AND", "AND", "", None, "a = '", "-- b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = split_conditions(frame, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    rows = {(r.id, r.pred_no): r.predicate for r in found.collect()}
    assert rows == {(0, j): f"a{j} = {j}" for j in range(500)} | {
        (1, 0): "a = 1", (1, 2): "b = 2", (5, 0): "a = '",
    }
