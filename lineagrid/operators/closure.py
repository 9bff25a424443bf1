"""Level-by-level closures over small edge tables.

Each round is one equi-join inside the statements that still have something to
follow; the loop ends when a round adds nothing. Rounds are as many as the
query nesting is deep. The rows of every round are checkpointed, so the plan
stays short and a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.session import keep, together


def union_all(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return together(result)


def follow(seed: DataFrame, step, best_of: list[str], order: str) -> DataFrame:
    """Grow ``seed`` by ``step(frontier)`` until nothing new or better appears.

    One row is kept per ``best_of`` key, the one with the smallest ``order``;
    a later row enters only if its key is new or its order is smaller, so
    cycles stop by themselves. What is known is carried on as one table in which
    the rows of the last round are marked: a round is one grouping and one write.
    """
    columns = seed.columns
    rest = [c for c in columns if c not in best_of and c != order]

    def best(df: DataFrame) -> DataFrame:
        picked = F.min(F.struct(order, "fresh", *rest)).alias("p")
        return df.groupBy(*best_of).agg(picked).select(*best_of, "p.*").select(*columns, "fresh")

    known = keep(best(seed.withColumn("fresh", F.lit(1))))
    while not (frontier := known.filter("fresh = 1")).isEmpty():
        more = step(frontier.drop("fresh")).select(*columns).withColumn("fresh", F.lit(1))
        known = keep(best(union_all([known.withColumn("fresh", F.lit(0)), more])))
    return known.drop("fresh")


def contained(intervals: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, low, high, at): the points strictly inside each interval.

    ``intervals`` has (*keys, low, high), ``points`` (*keys, at). Borders and
    points are sorted once per key and numbered; an interval is then a range of
    numbers, so only pairs that belong to the result are ever made.
    """
    intervals = intervals.select(*keys, "low", "high").distinct()
    points = points.select(*keys, "at").distinct()
    borders = intervals.select(
        *keys, "low", "high", F.explode(F.array("low", "high")).alias("at"), F.lit(0).alias("one")
    )
    marks = points.withColumn("one", F.lit(1))
    running = Window.partitionBy(*keys).orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranges = (
        union_all([borders, marks])
        .withColumn("no", F.sum("one").over(running))
        .filter("low IS NOT NULL")
        .groupBy(*keys, "low", "high")
        .agg(F.min("no").alias("first"), F.max("no").alias("last"))
        .filter("last > first")
        .select(*keys, "low", "high", F.explode(F.sequence(F.col("first") + 1, "last")).alias("no"))
    )
    numbered = points.withColumn(
        "no", F.row_number().over(Window.partitionBy(*keys).orderBy("at")).cast("long")
    )
    return ranges.join(numbered, [*keys, "no"]).drop("no")
