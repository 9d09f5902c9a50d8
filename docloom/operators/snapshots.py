"""Global snapshots: freezing a mapping, closing it with its closure, publishing, reading pages.

A snapshot is a folder of Parquet tables and becomes visible by its last write, ``counters``; nothing in it is
written twice. Publications are an append-only log, whose last row is the pointer.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
import json
import secrets
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.accounting import snapshot_counters, table_digest
from docloom.operators.joins import effective_versions
from docloom.operators.pages import keyset_page
from docloom.session import exists
from docloom.sources.config import ConfigError, page_arguments


def is_closed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/counters/_SUCCESS")


def create(path: str, resources: DataFrame, overrides: DataFrame, versions: DataFrame, rows: DataFrame, coverage: DataFrame | None = None) -> DataFrame:
    """Writes a snapshot's tables and closes it; returns the one row of counters."""
    spark = resources.sparkSession
    if is_closed(spark, path):
        raise ConfigError("snapshot_is_closed")
    items = effective_versions(resources, overrides, versions).withColumnRenamed("id", "resource_id")
    items.write.mode("overwrite").parquet(f"{path}/items")
    items = spark.read.parquet(f"{path}/items")
    closed = items.select("source_id", "resource_id", "version_id").join(rows, "version_id")
    # clustered by the page key, so that a page reads few row groups
    closed.repartitionByRange("source_id", "resource_id", "row_number").sortWithinPartitions("source_id", "resource_id", "row_number").write.mode("overwrite").parquet(f"{path}/rows")
    if coverage is not None:
        coverage.write.mode("overwrite").parquet(f"{path}/coverage")
    sealed = snapshot_counters(items, rows).crossJoin(_contents(spark, path))  # one row each
    sealed.coalesce(1).write.mode("overwrite").parquet(f"{path}/counters")
    return spark.read.parquet(f"{path}/counters").drop(*_DIGESTS)


_DIGESTS = ["items_low", "items_high", "rows_low", "rows_high"]


def _contents(spark: SparkSession, path: str) -> DataFrame:
    """One row: digests of a snapshot's tables as they are stored."""
    parts = [table_digest(spark.read.parquet(f"{path}/{name}")).select(F.col("low").alias(f"{name}_low"), F.col("high").alias(f"{name}_high")) for name in ("items", "rows")]
    return parts[0].crossJoin(parts[1])


def verify(spark: SparkSession, path: str, bodies: DataFrame | None = None) -> bool:
    """Whether a closed snapshot's tables hold what they were closed with, and all its files have a body.

    ``bodies``: sha256 and body of the archive; each file of the closure must be there with its own digest.
    """
    if not is_closed(spark, path):
        return False
    told = spark.read.parquet(f"{path}/counters")
    rows = spark.read.parquet(f"{path}/rows")
    now = snapshot_counters(spark.read.parquet(f"{path}/items"), rows.drop("source_id", "resource_id")).crossJoin(_contents(spark, path))
    if now.select(*told.columns).first() != told.first():
        return False
    if bodies is None:
        return True
    wanted = rows.select(F.explode(F.array("markdown_hash", "original_hash")).alias("sha256")).where("sha256 IS NOT NULL").distinct()
    sound = bodies.where(F.sha2("body", 256) == F.col("sha256")).select("sha256")
    return not wanted.join(sound, "sha256", "left_anti").limit(1).count()


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """The names of the closed snapshots below a folder, in order."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()] if files.exists(where) else []
    return sorted(n for n in found if is_closed(spark, f"{root}/{n}"))


def inspect(spark: SparkSession, path: str) -> dict:
    """A closed snapshot's counters and digests, and whether its tables still have them."""
    if not is_closed(spark, path):
        raise ConfigError("snapshot_not_closed")
    return {**spark.read.parquet(f"{path}/counters").first().asDict(), "verified": verify(spark, path)}


def publish(spark: SparkSession, log: str, snapshot: str, path: str) -> bool:
    """Appends a publication if the snapshot verifies and is not the published one; whether it changed."""
    if not is_closed(spark, path) or not verify(spark, path):
        raise ConfigError("snapshot_not_verified")
    before = published(spark, log)
    if before == snapshot:
        return False
    n = spark.read.json(log).count() if before else 0
    spark.createDataFrame([(n + 1, before, snapshot)], "sequence long, before string, after string").coalesce(1).write.mode("append").json(log)
    return True


def published(spark: SparkSession, log: str) -> str | None:
    """The pointer: the log's last row."""
    if not exists(spark, log):
        return None
    last = spark.read.schema("sequence long, before string, after string").json(log).orderBy(F.desc("sequence")).first()
    return last["after"] if last else None


_KEYS = ["source_id", "resource_id", "row_number"]


class Cursors:
    """Cursors that only their issuer can make, for one caller, one filter and one snapshot, and for a time."""

    def __init__(self, secret: bytes, seconds: int = 86_400, clock=time.time):
        self.secret, self.seconds, self.clock = secret, seconds, clock

    def _proof(self, body: bytes) -> str:
        return hmac.new(self.secret, body, hashlib.sha256).hexdigest()

    def issue(self, held: dict) -> str:
        body = json.dumps({**held, "until": self.clock() + self.seconds}, sort_keys=True).encode()
        return base64.urlsafe_b64encode(self._proof(body).encode() + body).decode()

    def read(self, cursor: str) -> dict:
        try:
            raw = base64.urlsafe_b64decode(cursor)
            proof, body = raw[:64].decode(), raw[64:]
            held = json.loads(body) if hmac.compare_digest(proof, self._proof(body)) else None
        except ValueError:
            held = None
        if held is None:
            raise ConfigError("invalid_cursor")
        if held["until"] < self.clock():
            raise ConfigError("expired_cursor")
        return held


def page(spark: SparkSession, root: str, log: str, caller: str, sources: list | None, limit: int, cursor: str | None = None, cursors: Cursors | None = None) -> dict:
    """Up to ``limit`` rows as dicts, and the cursor of the next page.

    A cursor is bound to its caller, its sources and the snapshot on which the reading began, carries a proof of that
    and has a life time (see Cursors; without one, cursors are proved by a key of this process).
    """
    page_arguments(limit)
    cursors = cursors or _OWN
    snapshot, after = published(spark, log), None
    if snapshot is None:
        raise ConfigError("snapshot_not_published")
    if cursor is not None:
        held = cursors.read(cursor)
        if held.get("caller") != caller or held.get("sources") != sources or not is_closed(spark, f"{root}/{held.get('snapshot')}"):
            raise ConfigError("invalid_cursor")
        snapshot, after = held["snapshot"], held["after"]
    rows = spark.read.parquet(f"{root}/{snapshot}/rows")
    if sources is not None:
        rows = rows.where(F.col("source_id").isin(sources))
    found = keyset_page(rows, _KEYS, after, limit).collect()  # at most limit + 1 rows
    items, more = [r.asDict() for r in found[:limit]], len(found) > limit
    token = cursors.issue({"caller": caller, "sources": sources, "snapshot": snapshot, "after": [items[-1][k] for k in _KEYS]}) if more else None
    return {"snapshot_id": snapshot, "items": items, "next_cursor": token}


_OWN = Cursors(secrets.token_bytes(32))


def file_bodies(cas: DataFrame, rows: DataFrame) -> DataFrame:
    """The stored bodies that a closure names."""
    named = rows.select(F.explode(F.array("markdown_hash", "original_hash")).alias("sha256")).where("sha256 IS NOT NULL").distinct()
    return cas.join(named, "sha256", "left_semi")


def file_body(spark: SparkSession, cas: DataFrame, rows: DataFrame, sha: str) -> DataFrame:
    """The stored body of one file, only if the published closure names it."""
    return file_bodies(cas.where(F.col("sha256") == sha), rows.where((F.col("markdown_hash") == sha) | (F.col("original_hash") == sha)))
