"""Run accounting: progress counts, failure taxonomy, coverage, snapshot counters, table digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.pages import latest

REQUIRED = "required_input_failed:"


def progress(tasks: DataFrame, by: str) -> DataFrame:
    """Seven counts of requests and targets in one pass."""
    request, target = F.col("kind") == "request", F.col("kind") == "target"
    return tasks.groupBy(by).agg(
        F.count_if(request).alias("discovered"),
        F.count_if(request & F.col("state").isin("archived", "done")).alias("fetched"),
        F.count_if(request & (F.col("state") == "pending")).alias("pending"),
        F.count_if(request & (F.col("state") == "failed")).alias("request_failed"),
        F.count_if(target).alias("targets"),
        F.count_if(target & F.col("state").isin("done", "failed", "skipped")).alias("processed"),
        F.count_if(target & (F.col("state") == "skipped")).alias("skipped"),
    )


def failure_category(error: Column) -> Column:
    """The cause under which an error is reported; the first rule that fits."""
    code = F.regexp_replace(error, f"^{REQUIRED}", "")
    return (
        F.when(code.isin("interrupted", "attempt_superseded"), "cancelled")
        .when(code.isin("request_budget_exceeded", "crawl_time_budget_exceeded", "document_budget_exceeded"), "budget_truncated")
        .when(error.startswith(REQUIRED), "required_input_missing")
        .when(code.isin("network_failed", "redirect_limit_exceeded") | code.rlike("^(?:robots|http_)"), "network_failed")
        .when(code.startswith("quality_check_failed"), "quality_check_failed")
        .when(code.isin("document_original_missing", "document_body_missing", "document_deliverables_required", "document_missing_from_batch", "reparse_input_unavailable"), "required_input_missing")
        .when(code.isin("inputs_unavailable", "page_limit_exceeded"), "enumeration_incomplete")
        .otherwise("parse_failed")
    )


def failures(tasks: DataFrame, flags: DataFrame, by: str) -> DataFrame:
    """Failed tasks by category; a run's flagged category (``by``, category) counts at least once."""
    counted = tasks.where("error IS NOT NULL").groupBy(by, failure_category(F.col("error")).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    floors = flags.select(by, "category").distinct().withColumn("least", F.lit(1).cast("long"))
    joined = counted.join(floors, [by, "category"], "full_outer")
    return joined.select(by, "category", F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("least", F.lit(0))).alias("n"))


def coverage(sources: DataFrame, runs: DataFrame, most: int = 200) -> DataFrame:
    """Each source's latest finished run with its sorted gaps; a source never run says so."""
    ended = runs.where(F.col("status").isin("complete", "failed")).withColumn("_at", F.coalesce(F.col("completed_at"), F.lit("0001-01-01").cast("timestamp")))
    last = latest(ended, ["source_id"], ["_at", "id"], ["id", "status", "reason", "truncated"])
    gaps = F.slice(F.array_sort(F.array_distinct(F.array_compact(F.array("reason", "truncated")))), 1, most)
    joined = sources.select(F.col("id").alias("source_id")).join(last, "source_id", "left")
    return joined.select("source_id", F.col("id").alias("run_id"), F.coalesce("status", F.lit("UNKNOWN")).alias("status"), F.when(F.col("id").isNull(), "never_run").otherwise(F.array_join(gaps, ",")).alias("known_gaps"))


def snapshot_counters(items: DataFrame, rows: DataFrame) -> DataFrame:
    """Sources, resources, versions, rows and files of a snapshot, in one row."""
    mapped = items.agg(F.count_distinct("source_id").alias("sources"), F.count_distinct("resource_id").alias("resources"), F.count_distinct("version_id").alias("versions"))
    closed = items.select("version_id").distinct().join(rows, "version_id")
    shas = closed.select(F.explode(F.array("markdown_hash", "original_hash")).alias("sha")).where("sha IS NOT NULL")
    return mapped.crossJoin(closed.agg(F.count(F.lit(1)).alias("rows"))).crossJoin(shas.agg(F.count_distinct("sha").alias("files")))


def table_digest(rows: DataFrame) -> DataFrame:
    """Rows and an order-free digest of a table: sums of two halves of each row's hash, modulo a prime.

    Row hashes are added up rather than sorted, so no task holds the table.
    """
    text = F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in sorted(rows.columns)])
    h = F.md5(text)
    half = lambda a: F.sum(F.conv(F.substring(h, a, 12), 16, 10).cast("decimal(38,0)"))
    return rows.agg(F.count(F.lit(1)).alias("n"), half(1).cast("string").alias("low"), half(13).cast("string").alias("high"))


def campaigns(rows: DataFrame, by: str, order: str) -> DataFrame:
    """Each key's campaign row that counts: a later row replaces one that was interrupted; one that replaces a
    finished row is a conflict (``error``), and the finished row stays. Columns: ``by``, ``order``, campaign, outcome."""
    whole = F.struct(order, "campaign", "outcome")
    broken = F.col("outcome") == "INTERRUPTED"
    agg = rows.groupBy(by).agg(F.min(F.when(~broken, whole)).alias("done"), F.max(whole).alias("last"))
    conflict = F.col("done").isNotNull() & (F.col(f"last.{order}") > F.col(f"done.{order}"))
    kept = F.coalesce("done", "last")
    return agg.select(by, kept["campaign"].alias("campaign"), kept["outcome"].alias("outcome"), F.when(conflict, "campaign_conflict").alias("error"))


def recoverable_jobs(jobs: DataFrame, queue: DataFrame, now: DataFrame, stalled_days: int) -> DataFrame:
    """Jobs to put back, and why: running ones whose sign of life is too old (``stalled``), and waiting ones that
    no queue entry stands for (``unqueued``). ``jobs``: id, state, seen_at; ``queue``: id; ``now``: one row."""
    old = F.col("seen_at") < F.col("now") - F.expr(f"INTERVAL {stalled_days} DAY")
    stalled = jobs.where("state = 'running'").join(F.broadcast(now)).where(old).select("id", F.lit("stalled").alias("why"))
    unqueued = jobs.where("state = 'waiting'").join(queue.select("id").distinct(), "id", "left_anti").select("id", F.lit("unqueued").alias("why"))
    return stalled.unionByName(unqueued)


def run_status(tasks: DataFrame, by: str) -> DataFrame:
    """A run has failed if any of its tasks has an error, else it is complete."""
    return tasks.groupBy(by).agg(F.when(F.count("error") > 0, "failed").otherwise("complete").alias("status"))
