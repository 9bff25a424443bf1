from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lineagrid.functions import names, text


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("function", "given", "expected"),
    [
        (text.clean_statement, "a_x000D_b\r\nc\t\t d ", "a\nb\nc d"),
        (text.clean_statement, " a  b\rc　", "a b\nc"),
        (text.inline_comments_to_block, "SELECT a -- x y FROM t", "SELECT a /*x y*/FROM t"),
        (text.inline_comments_to_block, "a '--no' --yes\nb", "a '--no' /*yes*/\nb"),
        (text.inline_comments_to_block, "f(a -- one, two) -- three; x", "f(a /*one*/, two) /*three*/; x"),
        (text.mask_placeholders, "#A# x #B##A#",
         "__SQLGLOT_PH_0__ x __SQLGLOT_PH_1____SQLGLOT_PH_2__"),
        (text.normalize_dynamic_sql, "x = '''||p_d||'''", "x = #p_d#"),
        (text.normalize_dynamic_sql, "FROM t PARTITION(P#D#) a", "FROM t  a"),
        (text.normalize_dynamic_sql, "x = ''A''", "x = 'A'"),
        (text.normalize_dynamic_sql, "SELECT a, SELECT b FROM t", "SELECT a, b FROM t"),
        (text.normalize_dynamic_sql, "a = 1 'AND b = 2", "a = 1 AND b = 2"),
        (text.normalize_dynamic_sql, "SELECT a, SELECT x FROM y WHERE 1=1'; b", "SELECT a b"),
        (text.readable_not, "NOT a.x LIKE 'b%'", "a.x NOT LIKE 'b%'"),
        (text.readable_not, "NOT a.x IN (1, 2)", "a.x NOT IN (1, 2)"),
        (text.readable_not, "NOT a.x BETWEEN 1 AND 2", "a.x NOT BETWEEN 1 AND 2"),
        (text.readable_not, "NOT EXISTS(SELECT 1)", "NOT EXISTS(SELECT 1)"),
        (text.foreign_mark, "SELECT 'a\ue000b' FROM t", "private-use mark in the text"),
        (text.foreign_mark, "SELECT '\ue003' FROM t", None),
        (names.table_only, "s.TAB@LNK", "TAB@LNK"),
        (names.table_only, "TAB@LNK.WORLD", "WORLD"),
    ],
)
def test_scalar(spark, function, given, expected):
    assert one(spark, function, given) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [("TAB@LNK", ("TAB", "@LNK")), ("TAB@", ("TAB", "")), (" TAB ", ("TAB", "")), ("", ("", ""))],
)
def test_split_dblink(spark, given, expected):
    row = spark.createDataFrame([(given,)], "v string").select(*names.split_dblink(F.col("v"))).first()
    assert tuple(row) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [('"S"."T"', ("S", "T")), ("a.b.c", ("b", "c")), ("t", ("", "t")), ("[s].[t]", ("s", "t")), (".", ("", ""))],
)
def test_last_two_parts(spark, given, expected):
    row = spark.createDataFrame([(given,)], "v string").select(*names.last_two_parts(F.col("v"))).first()
    assert tuple(row) == expected


def test_text_scans(spark):
    pairs = one(spark, text.text_alias_pairs, "FROM s.t1 a JOIN t2 AS b ON")
    assert [tuple(p) for p in pairs] == [("a", "s", "t1"), ("b", "", "t2")]
    pairs = one(spark, text.text_alias_pairs, "FROM t1 JOIN t2 ON")
    assert [tuple(p) for p in pairs] == [("join", "", "t1")]
    refs = one(spark, text.text_table_refs, "FROM t1 JOIN t2 ON x FROM select FROM t1")
    assert [tuple(r) for r in refs] == [("", "t1"), ("", "t2")]


def test_placeholder_round_trip(spark):
    sql = "x = '#D#' and y = #D# and z = #E F#"
    frame = spark.createDataFrame([(sql,)], "v string")
    v = F.col("v")
    row = frame.select(
        text.placeholder_map(v).alias("m"),
        text.restore_placeholders(text.mask_placeholders(v), text.placeholder_map(v)).alias("back"),
        text.unmark_placeholders(text.mark_placeholders(v)).alias("marked_back"),
    ).first()
    assert [row.m[k] for k in sorted(row.m)] == ["#D#", "#D#", "#E F#"]
    assert row.back == row.marked_back == sql
