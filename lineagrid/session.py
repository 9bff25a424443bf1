"""Session settings and the two ways intermediate results are kept.

Both keep their data in the shared folder named by ``spark.checkpoint.dir``, so
that a lost executor costs a re-read and never a recomputation from the source.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

KEY = "h"
#: the job whose results are being kept
_job: ContextVar[str] = ContextVar("job", default="")
#: the settings the session had when the outermost method of a job began
_own: ContextVar[dict | None] = ContextVar("own", default=None)
#: whether what is kept has so few rows that one task takes all of it
_one_task: ContextVar[bool] = ContextVar("one_task", default=False)
# one method at a time changes settings and puts them back
_lock = RLock()


def prepare(spark: SparkSession) -> SparkSession:
    """Let joins on (h, more keys) reuse a partitioning on h alone, let small
    shuffle partitions stand, and make sure that a checkpoint folder is set.

    Statement texts compress well and are dear to take apart, so partitions
    that look small on disk are still worth a task of their own.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    # a task of a bucketed write holds few buckets: keep their files open, do not sort
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "64")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The shared folder that all executors see: the argument, else
    ``spark.checkpoint.dir``, else what the session has been given. Only a
    session whose executors are threads of the driver gets a temporary one."""
    context = spark.sparkContext
    folder = folder or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(
                "executors share no local folder: name a shared one in spark.checkpoint.dir"
            )
        folder = tempfile.mkdtemp(prefix="lineagrid-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small or once-read result. Without adaptive plans a checkpoint would carry
    on its plan's order, which a join of two of its readers can't take, and be worked out twice."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "false":
        return keep_sized(df)
    return df.checkpoint(eager=True)


def keep_sized(df: DataFrame) -> DataFrame:
    """The same for results that go through many rounds of joins. A checkpoint carries the
    planner's guess of its size on into every later guess, which grows with each round;
    files have their real size."""
    spark = df.sparkSession
    path = f"{_folder(spark, _job.get())}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return together(spark.read.schema(df.schema).parquet(path))


def together(df: DataFrame) -> DataFrame:
    """Rows that are few enough for one task, as one partition: it is known to hold all rows of
    each key, so what reads it needs no exchange. Others stay as they are."""
    return df.coalesce(1) if _one_task.get() else df


#: what is set otherwise for work on few shapes
SETTINGS = [
    "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.codegen.wholeStage",
    "spark.sql.codegen.factoryMode", "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.optimizer.runtime.bloomFilter.enabled", "spark.sql.constraintPropagation.enabled",
    "spark.sql.dataFrameQueryContext.enabled", "spark.sql.ui.explainMode",
    "spark.sql.optimizer.excludedRules",
]
# these would put a semi join beneath what says that its side is one partition
PUSHED = ",".join(
    f"org.apache.spark.sql.catalyst.optimizer.{rule}"
    for rule in ("PushDownLeftSemiAntiJoin", "PushLeftSemiLeftAntiThroughJoin")
)
# Up to so many characters of shapes cost less to work on than to plan for, and so
# many make a task of their own then.
FEW, CHARACTERS_PER_TASK = 1_000_000, 125_000


def session_settings(spark: SparkSession) -> dict[str, str]:
    return {name: spark.conf.get(name, None) for name in SETTINGS}


def settings_for(spark: SparkSession, n_characters: int) -> dict[str, str]:
    """Settings for work on shapes of so many characters in all.

    The work takes some hundred short plans. On few shapes their cost is that of compiling code
    for each, of a job for each exchange and of tasks that hold no row, so plans are
    interpreted, run as one job and get tasks by the size. Shapes for one task are kept as one
    partition each result, which no join, grouping or window exchanges. Results are the same; with
    more shapes the session's own settings hold.
    """
    settings = session_settings(spark)
    if n_characters > FEW:
        return settings
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_characters // CHARACTERS_PER_TASK) or 1)
    return dict(zip(SETTINGS, [str(parts), "false", "false", "NO_CODEGEN", "-1", "false", "false", "false", "simple", PUSHED]))


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]):
    """Plans that are made and run inside get these settings."""
    before = session_settings(spark)
    few = settings["spark.sql.codegen.factoryMode"] == "NO_CODEGEN"
    token = _one_task.set(few and settings["spark.sql.shuffle.partitions"] == "1")
    try:
        _set(spark, before, settings)
        yield
    finally:
        _one_task.reset(token)
        _set(spark, settings, before)


def _set(spark: SparkSession, now: dict[str, str], settings: dict[str, str]) -> None:
    for name, value in settings.items():
        if value is None:
            spark.conf.unset(name)
        elif value != now[name]:
            spark.conf.set(name, value)


def in_job(method):
    """Let what a method of a job keeps be dropped with the job (see ``drop_job``). It works on
    statements, with the session's own settings."""
    return _in_job(method, lambda job, own: own)


def on_shapes(method):
    """The same for a method that works on shapes only."""
    return _in_job(method, lambda job, own: job.shape_settings)


def _in_job(method, settings):
    @wraps(method)
    def wrapped(self, *args, **kwargs):
        spark = self.statements.sparkSession
        with _lock:
            own = _own.get() or session_settings(spark)
            tokens = [(_job, _job.set(self.job_id)), (_own, _own.set(own))]
            try:
                with with_settings(spark, settings(self, own)):
                    return method(self, *args, **kwargs)
            finally:
                for variable, token in tokens:
                    variable.reset(token)

    return wrapped


def keep_bucketed(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several joins read as a table bucketed on the text
    key: later joins and windows on that key start without an exchange, and
    each reader scans only the columns it uses. One partition needs no buckets for that."""
    spark = df.sparkSession
    writer = df.write
    if not _one_task.get():
        writer = writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), KEY)
    table = f"lineagrid_{_job.get()}_{name}_{uuid.uuid4().hex}"
    (
        writer.option("path", f"{_folder(spark, _job.get())}/{table}")
        .format("parquet")
        .saveAsTable(table)
    )
    return together(spark.table(table))


def _folder(spark: SparkSession, job_id: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/lineagrid-{job_id}"


def drop_job(spark: SparkSession, job_id: str) -> None:
    """Drop the tables a job has kept, and their files."""
    for table in spark.catalog.listTables(pattern=f"lineagrid_{job_id}_*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    drop_files(spark, _folder(spark, job_id))


def drop_files(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
