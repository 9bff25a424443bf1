"""Exact dedup against a persistent digest index.

The index has one row per different text. It is a few runs, one for each batch that
brought new texts; a run is a table bucketed and sorted by digest with one file per
bucket, so a sort-merge join reads it without exchange and without sorting. A batch of
documents is reduced to its different digests (map-side first), those are joined with the
runs, and what no run knows becomes a new one. More than ``MAX_RUNS`` runs are merged.
Built-in functions only.

Defined cases: ids are whole numbers; a null text is an empty one, and empty texts
equal each other; white space is folded, so ``"a  b"`` equals ``"a\\nb"`` but not
``" a b"``; documents with a null id count in their group but never stay while another
row has an id; a row repeated under one id is reported once per row by
``annotate`` and returned once by ``distinct_documents``; an empty batch adds
nothing; columns other than id and text play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineagrid.llm.common import shared_path, shared_table, stored, texts, union_all

INDEX_SCHEMA = "digest binary, first_id bigint"
MAX_RUNS = 8
ORDERED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def folded(text: Column) -> Column:
    """Runs of white space as one blank. Single blanks, nearly all of the white
    space, do not match and so are not rewritten."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """The 32 bytes of SHA-256 over the folded text in UTF-8."""
    return F.unhex(F.sha2(folded(text).cast("binary"), 256))


class DigestIndex:
    """Sorted, bucketed runs of known digests.

    ``name`` is what its tables begin with; ``path`` their folder, in which a later session
    finds the index again. ``buckets`` must stay what it was at creation.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None
    ):
        self.spark = spark
        self.name = name
        self.path = (path or shared_path(spark, name)).rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(ORDERED_SCANS, "true")
        self.runs = sorted(self._folders())
        for run in self.runs:
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name}_{run} ({INDEX_SCHEMA}) USING parquet CLUSTERED BY "
                f"(digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{run}'"
            )

    def _folder(self, run: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{run}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self) -> list[str]:
        """The runs that were written to the end."""
        path, files = self._folder()
        names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        done = lambda name: files.exists(self._folder(f"{name}/_SUCCESS")[0])
        return [name for name in names if name.startswith("run") and done(name)]

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(f"{self.name}_{run}") for run in self.runs]

    def digests(self) -> DataFrame:
        empty = self.spark.createDataFrame([], INDEX_SCHEMA)
        return union_all([empty, *self.tables()])

    def append(self, new: DataFrame) -> None:
        """Add a run of digests the index lacks (its columns, each digest once)."""
        last = int(self.runs[-1][3:]) if self.runs else -1
        self._write(new, f"run{last + 1:06d}")
        if len(self.runs) > MAX_RUNS:
            self.compact()

    def _write(self, new: DataFrame, run: str) -> None:
        # a task holds one bucket, so a bucket is one file
        new.select("digest", "first_id").repartition(self.buckets, "digest").sortWithinPartitions(
            "digest"
        ).write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").option(
            "path", f"{self.path}/{run}"
        ).saveAsTable(f"{self.name}_{run}")
        self.runs.append(run)

    def compact(self) -> None:
        """Put all runs into one."""
        old = self.runs
        self.runs, whole = [], union_all(self.tables())
        self._write(whole, f"run{int(old[-1][3:]) + 1:06d}")
        for run in old:
            self._forget(run)

    def _forget(self, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{run}")
        path, files = self._folder(run)
        files.delete(path, True)

    def look_up(self, groups: DataFrame) -> DataFrame:
        """``groups`` (digest, ...) with ``known``: the id the index has for a digest."""
        found = groups.withColumn("known", F.lit(None).cast("long")).withColumn("old", F.lit(False))
        for run in self.tables():
            run = run.select("digest", F.col("first_id").alias("_id"), F.lit(True).alias("_hit"))
            found = found.hint("merge").join(run.hint("merge"), "digest", "left").select(
                *groups.columns, F.coalesce("known", "_id").alias("known"),
                (F.col("old") | F.coalesce("_hit", F.lit(False))).alias("old"),
            )
        return found

    def decide(self, digests: DataFrame) -> DataFrame:
        """digest, group_size, first_id: once for each digest of the batch, whose
        new ones enter the index."""
        groups = digests.groupBy("digest").agg(
            F.min("doc_id").alias("own_id"), F.count(F.lit(1)).alias("group_size")
        )
        decided = stored(
            self.look_up(groups).select(
                "digest", "group_size", "old",
                F.when(F.col("old"), F.col("known")).otherwise(F.col("own_id")).alias("first_id"),
            ),
            "decided",
        )
        self.append(decided.filter("NOT old"))
        return decided.drop("old")

    def annotate(self, docs: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

        ``keep_id`` is the id under which the index knows the text: from an
        earlier batch, else the smallest id of this one. ``group_size`` counts
        the rows of this batch.
        """
        rows = stored(
            texts(docs).select("doc_id", digest(F.col("text")).alias("digest")), "digests"
        )
        return self._annotated(rows, self.decide(rows))

    def _annotated(self, rows: DataFrame, decided: DataFrame) -> DataFrame:
        # the rows are read back, so they get a plain exchange and adaptive
        # execution can split the partition of a hot digest
        return rows.join(decided, "digest").select(
            "doc_id",
            F.col("first_id").alias("keep_id"),
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("first_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def keep(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns, each once."""
        text = F.coalesce(docs["text"], F.lit(""))
        rows = docs.withColumn("_llm_digest", digest(text))
        decided = self.decide(rows.select("doc_id", F.col("_llm_digest").alias("digest")))
        same = (rows["_llm_digest"] == decided["digest"]) & rows["doc_id"].eqNullSafe(
            decided["first_id"]
        )
        return (
            rows.join(decided, same, "left_semi")
            .dropDuplicates(["doc_id", "_llm_digest"])
            .drop("_llm_digest")
        )

    def annotate_in_batches(self, docs: DataFrame, n_batches: int = 2) -> DataFrame:
        """The same for rows that come to the index in batches of rising ids, those without
        an id last. ``group_size`` counts the rows of all batches."""
        rows = stored(
            texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest")),
            "digests",
        )
        low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        cuts = [low + (high - low + 1) * i // n_batches for i in range(1, n_batches)] if low is not None else []
        batch = sum([(F.col("doc_id") >= cut).cast("int") for cut in cuts], F.lit(0))
        numbered = rows.withColumn("batch", F.coalesce(batch, F.lit(len(cuts))))
        decided = union_all([
            self.decide(numbered.filter(F.col("batch") == i).drop("batch")) for i in range(len(cuts) + 1)
        ])
        whole = decided.groupBy("digest").agg(
            F.min("first_id").alias("first_id"), F.sum("group_size").alias("group_size")
        )
        return self._annotated(rows, whole)

    def drop(self) -> None:
        """Drop the tables; a later session finds the runs in ``path``."""
        for run in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{run}")
        self.runs = []

    def delete(self) -> None:
        """Drop the tables and their files."""
        for run in self.runs:
            self._forget(run)
        self.runs = []


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index of its own."""
    return DigestIndex(spark, shared_table("digest_index"))


def annotate_exact_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Every row with the row of equal text that stays (see ``DigestIndex.annotate``)."""
    return (index or new_index(docs.sparkSession)).annotate(docs)


def annotate_batches(docs: DataFrame, index: DigestIndex | None = None, n_batches: int = 2) -> DataFrame:
    """The same, batch by batch (see ``DigestIndex.annotate_in_batches``)."""
    return (index or new_index(docs.sparkSession)).annotate_in_batches(docs, n_batches)


def distinct_documents(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay (see ``DigestIndex.keep``)."""
    return (index or new_index(docs.sparkSession)).keep(docs)
