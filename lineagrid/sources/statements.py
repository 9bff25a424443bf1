"""Statement tables in, reports and stage records out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineagrid.session import drop_files

STATEMENT_SCHEMA = T.StructType([
    T.StructField("stmt_id", T.LongType()),
    T.StructField("JOB_NAME", T.StringType()),
    T.StructField("READ_MODE", T.StringType()),
    T.StructField("SELECT_STATEMENT", T.StringType()),
])
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_statements(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A statement table from Parquet, ORC, JSON lines or CSV.

    A missing column is an error at once and not a column of NULLs. CSV needs
    ``stmt_id`` first and its columns in the order of the schema.
    """
    reader = spark.read
    if file_format == "csv":
        found = reader.options(**CSV_OPTIONS, enforceSchema="false").schema(STATEMENT_SCHEMA).csv(path)
    else:
        found = reader.format(file_format).load(path)
    missing = [f.name for f in STATEMENT_SCHEMA if f.name not in found.columns]
    if missing:
        raise ValueError(f"statement table lacks {', '.join(missing)}")
    return found.select(*[F.col(f.name).cast(f.dataType) for f in STATEMENT_SCHEMA])


def write_report(table: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace the report at ``path``; column names as they are, no index."""
    writer = table.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.options(header="true", quote='"', escape='"')
    writer.format(file_format).save(path)


#: columns of the stage tables; ``run_id`` is the partition
STAGES = {
    "query_blocks": "stmt_id long, block_id int, parent_id int, block_type string, alias_name string, "
    "level_no int, ordinal_position int, is_root int, raw_sql string",
    "catalog_tables": "stmt_id long, table_id int, block_id int, table_name string, schema_name string, "
    "catalog_name string, alias_name string, source_type string, raw_sql string",
    "catalog_columns": "stmt_id long, block_id int, catalog_name string, schema_name string, "
    "table_name string, column_name string, reason string, clause_type string, clause_sql string, "
    "raw_sql string",
}
RUNS = "run_id string, stage string, n_rows long, done boolean"
# Records of a stage are much alike, so little of them is left when compressed; a
# compressed file is read by one task, so a new one begins after so many records
RECORD_OPTIONS = {"compression": "gzip", "maxRecordsPerFile": "1000000"}


def append_stages(job, folder: str, run_id: str) -> None:
    """Append the three stage tables of a run as JSON lines (gzip), one folder per run.

    A run that is appended again replaces its own records and no others. The table
    ``runs`` says what a run has written; it is marked as under way first and as done when
    all three stages are complete, so that what a run broken off has left is not
    read. What the run wrote before goes once it is marked, so that old and new records never
    take disk side by side. Records carry ``stmt_id``, so runs and statements can be told apart.
    """
    spark, folder = job.statements.sparkSession, folder.rstrip("/")
    records = {
        "query_blocks": job.query_blocks(),
        "catalog_tables": job.catalog_tables(),
        "catalog_columns": job.catalog_columns(),
    }

    def replace(table: DataFrame, name: str) -> None:
        table.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).options(**RECORD_OPTIONS).partitionBy("run_id").json(f"{folder}/{name}")

    def mark(rows: list[tuple]) -> None:
        replace(spark.createDataFrame(rows, "stage string, n_rows long, done boolean").coalesce(1), "runs")

    mark([(name, 0, False) for name in STAGES])
    paths = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    own = paths.getPartitionPathString("run_id", str(run_id))
    for name in STAGES:
        drop_files(spark, f"{folder}/{name}/{own}")
    written = []
    for name in STAGES:
        count = Observation()
        replace(records[name].observe(count, F.count(F.lit(1)).alias("n")), name)
        written.append((name, count.get["n"], True))
    mark(written)


def read_stages(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stage tables with the records of all complete runs, by name."""
    folder = folder.rstrip("/")
    runs = spark.read.schema(RUNS).json(f"{folder}/runs").filter("done AND n_rows > 0")
    found = {}
    for name, columns in STAGES.items():
        complete = runs.filter(F.col("stage") == name).select("run_id")
        table = spark.createDataFrame([], f"{columns}, run_id string")
        if not complete.isEmpty():
            table = spark.read.schema(f"{columns}, run_id string").json(f"{folder}/{name}").join(
                complete, "run_id", "left_semi"
            ).select(*table.columns)
        found[name] = table
    return found
