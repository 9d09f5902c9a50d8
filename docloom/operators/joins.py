"""Joins of the versioned ledger: closure, current versions, overrides, readiness, dominance, regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def snapshot_rows(items: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the versions that a snapshot maps."""
    return items.join(rows, "version_id")


def effective_versions(resources: DataFrame, overrides: DataFrame, versions: DataFrame) -> DataFrame:
    """Each resource's version, its override before its current one; the version must be the resource's own."""
    wanted = resources.join(overrides.withColumnsRenamed({"resource_id": "id", "version_id": "override_id"}), "id", "left")
    wanted = wanted.withColumn("version_id", F.coalesce("override_id", "current_version_id"))
    owned = versions.select(F.col("id").alias("version_id"), F.col("resource_id").alias("owner"))
    return wanted.join(owned, "version_id").where(F.col("owner") == F.col("id")).select("id", "source_id", "version_id", F.col("override_id").isNotNull().alias("overridden"))


def override_checks(overrides: DataFrame, resources: DataFrame, versions: DataFrame, sources: DataFrame) -> DataFrame:
    """C4: for each override whether its resource, its version and its source exist."""
    r = resources.select(F.col("id").alias("resource_id"), "source_id", F.lit(True).alias("_r"))
    v = versions.select(F.col("id").alias("version_id"), F.lit(True).alias("_v"))
    s = sources.select("source_id", F.lit(True).alias("_s"))
    joined = overrides.join(r, "resource_id", "left").join(v, "version_id", "left").join(s, "source_id", "left")
    return joined.select("resource_id", "version_id", F.col("_r").isNotNull().alias("has_resource"), F.col("_v").isNotNull().alias("has_version"), F.col("_s").isNotNull().alias("has_source"))


def ready_targets(tasks: DataFrame, inputs: DataFrame, open_states: list[str]) -> DataFrame:
    """Pending targets without an input request in a state that is still open."""
    waiting = inputs.join(tasks.where((F.col("kind") == "request") & F.col("state").isin(open_states)).select(F.col("id").alias("request_id")), "request_id").select(F.col("target_id").alias("id")).distinct()
    return tasks.where((F.col("kind") == "target") & (F.col("state") == "pending")).join(waiting, "id", "left_anti")


def dominated(points: DataFrame, guard: float | None = None) -> DataFrame:
    """Points that another point of the language dominates.

    Without guard: no worse in both measures and better in one. With guard: no worse in cer and faster by
    more than the guard ratio. Instead of a theta join, each language's least cer up to every time is a
    running minimum over distinct times (at most one row for each time enters a window).
    """
    best = points.groupBy("language", "seconds").agg(F.min("cer").alias("cer"))
    if guard is None:
        upto = Window.partitionBy("language").orderBy("seconds")
        same = best.withColumn("least", F.min("cer").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("before", F.min("cer").over(upto.rowsBetween(Window.unboundedPreceding, -1)))
        marked = points.join(same.select("language", "seconds", "least", "before"), ["language", "seconds"])
        return marked.where((F.col("least") < F.col("cer")) | (F.col("before") <= F.col("cer"))).drop("least", "before")
    # events on one time axis: points at seconds, questions at seconds / guard (strictly before)
    facts = best.select("language", F.col("seconds").cast("double").alias("at"), "cer", F.lit(1).alias("fact"))
    asks = points.select("language", (F.col("seconds") / F.lit(guard)).alias("at"), F.lit(None).cast("long").alias("cer"), F.lit(0).alias("fact")).distinct()
    line = facts.unionByName(asks)
    w = Window.partitionBy("language").orderBy("at", "fact").rowsBetween(Window.unboundedPreceding, -1)
    known = line.withColumn("least", F.min("cer").over(w)).where("fact = 0").select("language", F.col("at").alias("_at"), "least")
    return points.withColumn("_at", F.col("seconds") / F.lit(guard)).join(known, ["language", "_at"]).where(F.col("least") <= F.col("cer")).drop("_at", "least")


def in_regions(words: DataFrame, regions: DataFrame) -> DataFrame:
    """C11: words whose centre is inside a region of their page, edges included."""
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    inside = x.between(F.col("rx0"), F.col("rx1")) & y.between(F.col("ry0"), F.col("ry1"))
    return words.join(regions, "page_id").where(inside)


def coverage_difference(result: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with the side they miss."""
    a = result.select(key, F.lit(1).alias("_a")).distinct()
    b = inventory.select(key, F.lit(1).alias("_b")).distinct()
    return a.join(b, key, "full_outer").where("_a IS NULL OR _b IS NULL").select(key, F.when(F.col("_a").isNull(), "missing").otherwise("unexpected").alias("side"))


def chain_roots(nodes: DataFrame, id_: str = "id", parent: str = "parent_id", hops: int = 11) -> DataFrame:
    """A4: each node with the first node of its chain, or its ancestor ``hops`` parents up if the chain is longer, and the depth between.

    Steps of 1, 2, 4 ... parents come from joining a table of steps to itself; the steps that ``hops`` is the sum of
    are walked from the largest on. So it takes about 2 log(hops) joins, whose inputs Spark reads and shuffles once.
    """
    step = nodes.select(F.col(id_).alias("id"), F.coalesce(F.col(parent), F.col(id_)).alias("to"), F.when(F.col(parent).isNull(), 0).otherwise(1).alias("n"))

    def walk(rows: DataFrame, steps: DataFrame) -> DataFrame:
        """``rows`` (id, to, n) with as many parents more as ``steps`` has; nodes that are not there end a chain."""
        more = steps.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("n").alias("_n"))
        return rows.join(more, "to", "left").select("id", F.coalesce("_to", "to").alias("to"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"))

    found, power = None, 1
    steps = step
    while power <= hops:
        if hops & power:
            found = steps if found is None else walk(found, steps)
        power *= 2
        steps = walk(steps, steps)
    if found is None:
        found = step.select("id", F.col("id").alias("to"), F.lit(0).alias("n"))
    return found.select("id", F.col("to").alias("root"), F.col("n").alias("depth"))


def exactly_one(lookup: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """``rows`` with the number of matches of their key, and whether that is exactly one."""
    n = lookup.groupBy(key).agg(F.count(F.lit(1)).alias("matches"))
    return rows.join(n, key, "left").withColumn("matches", F.coalesce("matches", F.lit(0))).withColumn("resolved", F.col("matches") == 1)


def any_of(values: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, values)
