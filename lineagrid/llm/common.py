"""Small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineagrid.session import checkpoint_dir

#: white space of all contracts: blank, tab, line feed, vertical tab, form feed, return
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
KNOWN_WORDS = 1_000_000


class WordHashes(dict):
    """64-bit hash by word (bytes); emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


#: one in each Python worker
word_hashes = WordHashes()
#: what operators remember in this Python worker, and how it is dropped
_remembered: dict[str, Callable[[], None]] = {"words": word_hashes.clear}


def remembers(operator: str, drop: Callable[[], None]) -> None:
    """Name what an operator remembers from task to task."""
    _remembered[operator] = drop


def begin(operator: str) -> None:
    """Called where a task of ``operator`` begins. A Python worker serves one stage after
    another; what other operators remember in it is dropped, so that it does not add up."""
    for name, drop in _remembered.items():
        if name != operator:
            drop()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD1B54A32D192ED03)
    return x ^ (x >> np.uint64(32))


#: places and tables made by this process, for ``close``
_places: list[str] = []
_tables: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new place in the folder that all executors share."""
    _places.append(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _places[-1]


def shared_table(name: str) -> str:
    """A new name that tables of the catalog may begin with."""
    _tables.append(f"{name}_{uuid.uuid4().hex}")
    return _tables[-1]


def close(spark: SparkSession) -> None:
    """Drop all that the operators have kept in this process: no result that reads
    it can be used any longer."""
    while _tables:
        for table in spark.catalog.listTables(pattern=f"{_tables.pop()}*"):
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    while _places:
        path = spark._jvm.org.apache.hadoop.fs.Path(_places.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back: its lineage is cut,
    a lost executor costs a re-read, and a join on it gets an exchange of its own,
    whose hot partitions adaptive execution can split."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def union_all(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text alone, so that other columns, whatever their names, do not
    matter. A null text counts as empty."""
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of few rows, so that what Python makes of one is small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def running_total(
    df: DataFrame, group: list[str], order: list[str], value: str, parts: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one in its group.

    ``parts`` numbers slices of a group that follow one another in the order;
    rows are summed within slices, slices within groups, so that a hot group is
    spread over as many tasks as it has slices.
    """
    sliced = df.withColumn("_part", parts)
    base = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sliced.groupBy(*group, "_part").agg(F.sum(value).alias("_sum")).select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_sum").over(base), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    on = [F.col("_part") == F.col("_p")] + [
        F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)
    ]
    return (
        sliced.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, on)
        .withColumn(name, F.col("_start") + F.col("_in"))
        .drop("_part", "_p", "_start", "_in", *[f"_g{i}" for i in range(len(group))])
    )
