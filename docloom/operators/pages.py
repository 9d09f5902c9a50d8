"""Ordering, paging and latest-row operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keyset_page(rows: DataFrame, keys: list[str], after: list | None, limit: int, tie: list[str] | None = None) -> DataFrame:
    """Up to limit + 1 rows behind the cursor; the row beyond the limit tells that a page follows."""
    if after is not None:
        kinds = dict(rows.dtypes)
        cursor = F.struct(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in zip(keys, after)])
        rows = rows.where(F.struct(*keys) > cursor).where(F.col(keys[0]) >= F.lit(after[0]))  # the second prunes files
    return rows.orderBy(*keys, *(tie or [])).limit(limit + 1)


def latest(rows: DataFrame, by: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """The last row of each key; one aggregate, no sort, so hot keys combine before the shuffle."""
    best = rows.groupBy(*by).agg(F.max(F.struct(*order, *[k for k in keep if k not in order])).alias("m"))
    return best.select(*by, *[F.col(f"m.{k}").alias(k) for k in keep])


def due(resources: DataFrame, now: float, limit: int) -> DataFrame:
    """Each source's first limit due resources, and one more, marked beyond, if there are more."""
    w = Window.partitionBy("source_id").orderBy("next_check", "id")
    n = F.row_number().over(w)
    return resources.where(F.col("next_check") <= now).withColumn("n", n).where(F.col("n") <= limit + 1).select("id", "source_id", (F.col("n") > limit).alias("beyond"))


def deliverable_rows(rows: DataFrame, key: str, roles: list[str]) -> DataFrame:
    """Row numbers 1..n by role rank, order and text."""
    rank = F.array_position(F.array(*[F.lit(r) for r in roles]), F.col("role"))
    return rows.withColumn("row_number", F.row_number().over(Window.partitionBy(key).orderBy(rank, "turn", "text")).cast("long"))


def file_references(rows: DataFrame) -> DataFrame:
    """One row for each original and each derived file that delivery rows name."""
    original = rows.where("original_hash IS NOT NULL").select(F.col("original_hash").alias("sha"), F.lit("original").alias("kind"), "version_id", "row_number")
    return original.unionByName(rows.select(F.col("markdown_hash").alias("sha"), F.lit("markdown").alias("kind"), "version_id", "row_number"))


def seeded_places(rows: DataFrame, key: str, seed: int, name: str = "place") -> DataFrame:
    """``rows`` with their places (from 1) in a seeded shuffle, without one task that has them all.

    The order is that of a digest of seed and key; its first digits deal rows into 4096 like parts, whose places begin
    after the rows of the parts before (one count a part is added up).
    """
    dealt = rows.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string")))).withColumn("_part", F.substring("_key", 1, 3))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_key", key))
    numbered = dealt.withColumn("_r", inside).join(F.broadcast(base.select("_part", "_base")), "_part")  # at most 4096 rows
    return numbered.withColumn(name, (F.col("_r") + F.col("_base")).cast("long")).drop("_key", "_part", "_r", "_base")
