"""Rules that tables keep, as queries over their states (L6), and the catalog's joins.

A table is a set of rows that writers only append to, so what a trigger would refuse is found by comparing what is stored
with what was: each rule gives rows (rule, key, why), and a state is sound if there are none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _told(rows: DataFrame, rule: str, key: Column | str, why: Column | str) -> DataFrame:
    why = F.lit(why) if isinstance(why, str) else why
    return rows.select(F.lit(rule).alias("rule"), (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"), why.alias("why"))


def mutations(before: DataFrame, after: DataFrame, key: str, free: list[str] | None = None) -> DataFrame:
    """Rows of an append-only table that were deleted or changed (but for the columns ``free``); new rows are in order.

    Nulls are values here. One hash of a row travels, not the row. Keys are unique in both states.
    """
    kept = [c for c in sorted(before.columns) if c != key and c not in (free or [])]
    value = lambda: F.sha2(F.to_json(F.struct(*[F.col(c) for c in kept]), {"ignoreNullFields": "false"}), 256)
    old, new = before.select(key, value().alias("old")), after.select(key, value().alias("new"))
    both = old.join(new, key, "left").where(F.col("new").isNull() | (F.col("new") != F.col("old")))
    return _told(both, "immutable_record", key, F.when(F.col("new").isNull(), "deleted").otherwise("changed"))


def closed_mappings(before: DataFrame, after: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Mapping rows (snapshot_id, resource_id, version_id) added to, changed in or taken from closed snapshots (id, sealed)."""
    closed = snapshots.where("sealed").select(F.col("id").alias("snapshot_id"))
    pair = ["snapshot_id", "resource_id"]
    old = before.select(*pair, F.struct("version_id").alias("old"))
    new = after.select(*pair, F.struct("version_id").alias("new"))
    differ = old.join(new, pair, "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).join(closed, "snapshot_id", "left_semi")
    why = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "deleted").otherwise("changed")
    return _told(differ, "immutable_snapshot_mapping", F.concat_ws("/", *pair), why)


def snapshot_counts(snapshots: DataFrame, items: DataFrame) -> DataFrame:
    """Closed snapshots whose counters are not those of their mapping; open ones that have counters."""
    counted = items.groupBy(F.col("snapshot_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("version_id").alias("v"))
    told = snapshots.join(counted, "id", "left")
    n, v = F.coalesce("n", F.lit(0)), F.coalesce("v", F.lit(0))
    wrong = ~F.col("resource_count").eqNullSafe(n) | ~F.col("version_count").eqNullSafe(v)
    early = ~F.col("sealed") & ((F.col("resource_count") != 0) | (F.col("version_count") != 0))
    return _told(told.where((F.col("sealed") & wrong) | early), "invalid_snapshot_counts", "id", F.when(F.col("sealed"), "counters_differ").otherwise("counted_before_closing"))


def publications(log: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Publications (sequence, before, after) of snapshots that are not closed, or that change nothing."""
    told = log.join(snapshots.select(F.col("id").alias("after"), "sealed"), "after", "left")
    same = F.col("before").eqNullSafe(F.col("after"))
    return _told(told.where(same | ~F.coalesce("sealed", F.lit(False))), "invalid_publication", "sequence", F.when(same, "unchanged").otherwise("snapshot_not_sealed"))


def version_conflicts(versions: DataFrame) -> DataFrame:
    """Observations that made more than one version (id, observation_id)."""
    many = versions.where("observation_id IS NOT NULL").groupBy("observation_id").agg(F.count_distinct("id").alias("n")).where("n > 1")
    return _told(many, "version_observation_conflict", "observation_id", F.concat(F.col("n").cast("string"), F.lit(" versions")))


def all_of(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def catalog_objects(objects: DataFrame, indexes: DataFrame, deleted: list[str], foreign: str) -> DataFrame:
    """Catalog objects (oid, name, kind) with the table that an index belongs to (indexes: oid, table_oid), and what a
    migration does with them: delete (they or their table are listed), third_party (by prefix) or retain."""
    parents = objects.select(F.col("oid").alias("table_oid"), F.col("name").alias("table_name"))
    joined = objects.join(indexes.select("oid", "table_oid"), "oid", "left").join(parents, "table_oid", "left")
    goes = F.col("name").isin(deleted) | F.coalesce(F.col("table_name").isin(deleted), F.lit(False))
    return joined.select("oid", "name", "kind", "table_name", F.when(goes, "delete").when(F.col("name").startswith(foreign), "third_party").otherwise("retain").alias("action"))


def leftovers(objects: DataFrame, routines: DataFrame, prefix: str) -> DataFrame:
    """names of objects and of routines that still have a prefix, one row for each that has."""
    return objects.select("name").unionAll(routines.select("name")).where(F.col("name").startswith(prefix))
