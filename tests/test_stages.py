"""Stage records on disk: small, each run in one place, old records never beside new ones."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lineagrid.sources import statements
from lineagrid.sources.statements import STAGES, append_stages, read_stages

ROW = {"stmt_id": 1, "clause_sql": "WHERE a.x = 'é' AND b.y IS NULL", "raw_sql": "SELECT a.x FROM a, b\nWHERE 1 = 1"}


class Job:
    """A job with ``n`` rows in each stage."""

    def __init__(self, spark, n, change=lambda name, rows: rows):
        self.statements, self.n, self.change = spark.range(1), n, change

    def __getattr__(self, name):
        spark = self.statements.sparkSession
        rows = spark.createDataFrame([(i,) for i in range(self.n)], "i long").coalesce(1)
        columns = [c.split() for c in STAGES[name].split(", ")]
        given = {c: F.lit(ROW.get(c)).cast(kind).alias(c) for c, kind in columns} | {"stmt_id": F.col("i").alias("stmt_id")}
        return lambda: self.change(name, rows.select(*given.values()))


def files(folder, name):
    return sorted(p for p in Path(folder, name).rglob("part-*") if p.is_file())


def counts(spark, folder):
    return {name: {r.run_id: r["count"] for r in t.groupBy("run_id").count().collect()}
            for name, t in read_stages(spark, folder).items()}


def test_records_are_compressed_json_lines(spark, tmp_path):
    append_stages(Job(spark, 500), str(tmp_path), "r1")
    for name in STAGES:
        texts = [gzip.decompress(p.read_bytes()) for p in files(tmp_path, name)]
        assert sum(len(t.splitlines()) for t in texts) == 500
        assert 5 * sum(p.stat().st_size for p in files(tmp_path, name)) < sum(map(len, texts))
    row = read_stages(spark, str(tmp_path))["catalog_columns"].filter("stmt_id = 7").first()
    assert (row.clause_sql, row.raw_sql, row.run_id) == (ROW["clause_sql"], ROW["raw_sql"], "r1")


def test_old_records_go_before_new_ones_are_written(spark, tmp_path):
    """A run that breaks off while it is appended again holds no disk with its old records."""
    odd = "5/1: a=b%c d"
    for run in (odd, "r2"):
        append_stages(Job(spark, 3), str(tmp_path), run)
    held = {name: len(files(tmp_path, name)) for name in STAGES}

    def breaks(name, rows):
        late = name == "catalog_columns"
        return rows.withColumn("raw_sql", F.raise_error(F.lit("broken")).cast("string")) if late else rows

    with pytest.raises(Exception, match="broken"):
        append_stages(Job(spark, 4, breaks), str(tmp_path), odd)
    assert len(files(tmp_path, "catalog_columns")) == held["catalog_columns"] // 2
    assert counts(spark, str(tmp_path)) == {name: {"r2": 3} for name in STAGES}
    append_stages(Job(spark, 4), str(tmp_path), odd)
    assert counts(spark, str(tmp_path)) == {name: {"r2": 3, odd: 4} for name in STAGES}
    assert {name: len(files(tmp_path, name)) for name in STAGES} == held


def test_a_file_of_records_has_its_length(spark, tmp_path, monkeypatch):
    assert int(statements.RECORD_OPTIONS["maxRecordsPerFile"]) > 0
    monkeypatch.setitem(statements.RECORD_OPTIONS, "maxRecordsPerFile", "10")
    append_stages(Job(spark, 25), str(tmp_path), "r1")
    assert {name: len(files(tmp_path, name)) for name in STAGES} == dict.fromkeys(STAGES, 3)
    assert counts(spark, str(tmp_path)) == {name: {"r1": 25} for name in STAGES}


def test_records_of_earlier_runs_that_are_plain_are_read_and_replaced(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(statements.RECORD_OPTIONS, "compression", "none")
    append_stages(Job(spark, 3), str(tmp_path), "r1")
    monkeypatch.undo()
    append_stages(Job(spark, 4), str(tmp_path), "r2")
    assert counts(spark, str(tmp_path)) == {name: {"r1": 3, "r2": 4} for name in STAGES}
    append_stages(Job(spark, 2), str(tmp_path), "r1")
    assert counts(spark, str(tmp_path)) == {name: {"r1": 2, "r2": 4} for name in STAGES}
