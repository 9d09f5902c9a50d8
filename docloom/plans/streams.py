"""Registered streaming flows, run over all rows that are there."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.plans.base import query
from docloom.session import place
from docloom.sources.tables import LEDGERS
from docloom.streaming import flows as S


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def s01_windowed_counts(spark, sf):
    out = S.windowed_counts(S.read_events(spark, f"{sf}/events.parquet"), "ts", "2 hours", "1 day", "event_type")
    return S.drain_totals(out, ["window", "event_type"], place(spark, "stream")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s02_deduplicated_stream(spark, sf):
    e = S.read_events(spark, f"{sf}/events.parquet")
    twice = e.unionByName(e)
    out = S.deduplicated(twice, ["event_id"], "ts", "60 days")
    return S.drain(out.select("event_id", "event_type"), place(spark, "stream")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH d AS (SELECT user_id AS resource_id, event_id AS seq, 'i' || CAST(CAST(floor(event_id / 7) AS BIGINT) % 2 AS VARCHAR) AS input_fp, 'p' || CAST(CAST(floor(event_id / 1500) AS BIGINT) AS VARCHAR) AS parser_fp,
        'c' || CAST(CAST(floor(event_id / 7) AS BIGINT) % 2 AS VARCHAR) || CASE WHEN event_id % 11 = 0 THEN 'x' ELSE '' END AS content_hash, event_type = 'error' AND event_id % 2 = 0 AS bad FROM events),
    g AS (SELECT *, lag(input_fp) OVER w AS pi, lag(parser_fp) OVER w AS pp FROM d WHERE NOT bad WINDOW w AS (PARTITION BY resource_id ORDER BY seq)), i AS (SELECT *, sum(CASE WHEN pi IS NULL OR pi <> input_fp OR pp <> parser_fp THEN 1 ELSE 0 END) OVER (PARTITION BY resource_id ORDER BY seq) AS v FROM g),
    b AS (SELECT *, first_value(content_hash) OVER (PARTITION BY resource_id, v ORDER BY seq) AS base FROM i)
    SELECT d.resource_id, d.seq, CASE WHEN d.bad THEN 'failed' WHEN b.pi IS NULL THEN 'created' WHEN b.pi <> b.input_fp OR b.pp <> b.parser_fp THEN 'changed' WHEN b.content_hash <> b.base THEN 'failed' ELSE 'unchanged' END AS outcome,
        CAST(coalesce(last_value(b.v IGNORE NULLS) OVER (PARTITION BY d.resource_id ORDER BY d.seq), 0) AS BIGINT) AS version FROM d LEFT JOIN b ON b.resource_id = d.resource_id AND b.seq = d.seq""")
def s03_incremental_timeline(spark, sf):
    e = S.read_events(spark, f"{sf}/events.parquet")
    d = spark.sql(LEDGERS["delivery"], events=e).select("resource_id", "seq", "input_fp", "parser_fp", "content_hash", "failed_code")
    return S.drain(S.incremental_timeline(d), place(spark, "stream"))
