"""Texts that differ in one number are read once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lineagrid.operators.shapes import STAND_IN, as_shape, with_number, with_shape
from lineagrid.plans.pipeline import Lineage
from lineagrid.session import (
    CHARACTERS_PER_TASK, FEW, prepare, session_settings, settings_for, together, with_settings,
)
from conftest import statement_table

FOLDED = [
    "SELECT a.x FROM t_~ a JOIN s~ b ON a.i = b.i WHERE a.y > 40",
    "SELECT g2 FROM \"Item_~\"", "SELECT #SHIFT~# AS s FROM t", "SELECT ~ AS wind",
]
KEPT = [
    "SELECT c1.x FROM c2 c1", "SELECT C1 FROM c2", "SELECT 1 FROM t WHERE 1 = 1", "SELECT 1 AS a, 2 AS b",
    "SELECT a FROM t_7 WHERE b = 'x'||'7'", f"SELECT a FROM t_{STAND_IN}", "SELECT a FROM t", "",
]


def test_shapes_give_their_texts_again(spark):
    texts = [t.replace("~", k) for t in FOLDED for k in ("17", "00123")] + KEPT
    found = with_shape(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows = {r.text: r for r in with_number(found.withColumn("again", F.col("shape")), ["again"]).collect()}
    assert all(text == r.again for text, r in rows.items())
    for text in FOLDED:
        assert {rows[text.replace("~", k)].shape for k in ("17", "00123")} == {text.replace("~", STAND_IN)}
    for text in KEPT:
        assert (rows[text].shape, rows[text].number) == (text, STAND_IN)


def test_texts_of_one_shape_are_read_once(spark):
    texts = [f"SELECT a.x{i} FROM t_{i} a WHERE a.y = 4" for i in range(10, 40)]
    with Lineage(statement_table(spark, texts)) as job:
        assert (job.texts.count(), job.instances.count()) == (1, 30)
        assert job.tokens.select("h").distinct().count() == 1
        status = job._per_statement(job.texts.select("h", F.col("sql").alias("sql")))
        assert {r.stmt_id: r.sql for r in status.collect()} == dict(enumerate(texts))


def test_places_of_a_number_are_no_pattern_of_their_own(spark):
    texts = ["SELECT a.x17 FROM t_17 a", "SELECT 17 AS wind", "SELECT a.x\x01 FROM t_17 a", "SELECT c1.x FROM c2 c1"]
    found = with_shape(spark.createDataFrame([(t,) for t in texts], "text string")).withColumn(
        "name", F.lit("x17 x18 17")
    )
    rows = {r.text: r for r in found.withColumn("other", as_shape("name")).collect()}
    assert [rows[t].number_at for t in texts] == ["L", "A", None, None]
    assert [rows[t].other for t in texts] == [
        f"x{STAND_IN} x18 17", f"x{STAND_IN} x18 {STAND_IN}", "x17 x18 17", "x17 x18 17",
    ]
    assert rows[texts[2]].shape == texts[2]


def test_texts_are_read_once_for_all_results(spark):
    texts = [f"SELECT a.x{i} FROM t_{i} a" for i in range(10, 20)] + ["", None, " \t"]
    with Lineage(statement_table(spark, texts)) as job:
        assert job.texts.count() == 1
        status = job._per_statement(job.texts.select("h", "parse_error"))
        assert "SELECT_STATEMENT" not in status._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r.stmt_id for r in status.collect()) == list(range(10))


def test_work_on_few_shapes_gets_tasks_by_their_size(spark):
    prepare(spark)
    before = session_settings(spark)
    with Lineage(statement_table(spark, [f"SELECT a.x FROM sales_{i} a" for i in range(20)])) as job:
        assert job.shapes.count() == 1
        assert job.blocks.rdd.getNumPartitions() == 1  # one for each shuffle partition before
        assert session_settings(spark) == before
    assert settings_for(spark, FEW + 1) == before
    small = settings_for(spark, 3 * CHARACTERS_PER_TASK)
    assert small["spark.sql.shuffle.partitions"] == "3"
    with pytest.raises(ValueError), with_settings(spark, small):
        raise ValueError
    assert session_settings(spark) == before


def test_few_shapes_are_joined_and_grouped_without_exchange(spark):
    texts = [f"SELECT a.x FROM (SELECT b.x FROM sales_{i} b) a WHERE a.x > 1 ORDER BY x" for i in range(20)]
    with Lineage(statement_table(spark, texts)) as job:
        with with_settings(spark, job.shape_settings):
            both = job.blocks.join(job.refs, ["h", "bpos"]).groupBy("h", "bpos").count()
            some = job.refs.join(job.blocks.select("h"), ["h"], "left_semi").distinct()
            plans = [df._jdf.queryExecution().executedPlan().toString() for df in (both, some)]
        assert not any("Exchange" in plan for plan in plans)
        assert job.lineage().count() == 20 * job.rows.count() > 0
    # tables of more than one task, and statements, keep their partitions
    wide = spark.range(0, 100, 1, 4)
    with with_settings(spark, settings_for(spark, 3 * CHARACTERS_PER_TASK)):
        assert together(wide).rdd.getNumPartitions() == 4
    assert together(wide).rdd.getNumPartitions() == 4
