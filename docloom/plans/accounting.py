"""Registered run accounting and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import accounting as A
from docloom.operators import integrity
from docloom.plans.base import query
from docloom.sources.tables import ledger, table, with_ledgers

_PROGRESS = """SELECT run_id, count(*) FILTER (kind = 'request') AS discovered, count(*) FILTER (kind = 'request' AND state IN ('archived', 'done')) AS fetched, count(*) FILTER (kind = 'request' AND state = 'pending') AS pending,
    count(*) FILTER (kind = 'request' AND state = 'failed') AS request_failed, count(*) FILTER (kind = 'target') AS targets, count(*) FILTER (kind = 'target' AND state IN ('done', 'failed', 'skipped')) AS processed, count(*) FILTER (kind = 'target' AND state = 'skipped') AS skipped FROM task GROUP BY run_id"""
_CATEGORY = """CASE WHEN c IN ('interrupted', 'attempt_superseded') THEN 'cancelled' WHEN c LIKE '%budget_exceeded' THEN 'budget_truncated' WHEN error LIKE 'required_input_failed:%' THEN 'required_input_missing'
    WHEN c IN ('network_failed', 'redirect_limit_exceeded') OR c LIKE 'robots%' OR c LIKE 'http_%' THEN 'network_failed' WHEN c LIKE 'quality_check_failed%' THEN 'quality_check_failed' WHEN c IN ('document_body_missing') THEN 'required_input_missing'
    WHEN c IN ('inputs_unavailable', 'page_limit_exceeded') THEN 'enumeration_incomplete' ELSE 'parse_failed' END"""


@query(with_ledgers("task", sql=_PROGRESS))
def d01_progress(spark, sf):
    return A.progress(ledger(spark, sf, "task"), "run_id")


@query(with_ledgers("delivery", sql="SELECT run_seq, count(DISTINCT resource_id) FILTER (failed_code IS NULL) AS resources, count(*) FILTER (failed_code IS NOT NULL) AS failed, count(*) FILTER (content_hash LIKE '%x') AS odd FROM delivery GROUP BY run_seq"))
def d02_observation_counts(spark, sf):
    d = ledger(spark, sf, "delivery")
    return d.groupBy("run_seq").agg(F.count_distinct(F.when(F.col("failed_code").isNull(), F.col("resource_id"))).alias("resources"), F.count_if(F.col("failed_code").isNotNull()).alias("failed"), F.count_if(F.col("content_hash").endswith("x")).alias("odd"))


@query(with_ledgers("task", sql="SELECT run_id, kind, state, count(*) AS n FROM task GROUP BY ALL"))
def d03_counts_by_state(spark, sf):
    return ledger(spark, sf, "task").groupBy("run_id", "kind", "state").agg(F.count(F.lit(1)).alias("n"))


@query(with_ledgers("task", sql=f"""
    WITH e AS (SELECT run_id, error, CASE WHEN error LIKE 'required_input_failed:%' THEN substr(error, 23) ELSE error END AS c FROM task WHERE error IS NOT NULL), n AS (SELECT run_id, {_CATEGORY} AS category, count(*) AS n FROM e GROUP BY 1, 2),
    f AS (SELECT DISTINCT user_id % 20 AS run_id, 'cancelled' AS category FROM events WHERE event_id % 50 = 0)
    SELECT coalesce(n.run_id, f.run_id) AS run_id, coalesce(n.category, f.category) AS category, greatest(coalesce(n.n, 0), CASE WHEN f.run_id IS NULL THEN 0 ELSE 1 END) AS n FROM n FULL JOIN f ON f.run_id = n.run_id AND f.category = n.category"""))
def d04_failure_taxonomy(spark, sf):
    flags = table(spark, sf, "events").where("event_id % 50 = 0").select((F.col("user_id") % 20).alias("run_id"), F.lit("cancelled").alias("category"))
    return A.failures(ledger(spark, sf, "task"), flags, "run_id")


@query(with_ledgers("version", sql="SELECT count(DISTINCT id) AS versions, count(DISTINCT resource_id) AS resources FROM version"))
def d05_distinct_versions(spark, sf):
    return ledger(spark, sf, "version").agg(F.count_distinct("id").alias("versions"), F.count_distinct("resource_id").alias("resources"))


@query(with_ledgers("task", sql="SELECT r.run_id, coalesce(max(t.seq), 0) AS checkpoint FROM (SELECT DISTINCT run_id FROM task) r LEFT JOIN task t ON t.run_id = r.run_id AND t.state IN ('done', 'failed', 'skipped') AND t.seq % 2 = 0 GROUP BY r.run_id"))
def d07_terminal_checkpoint(spark, sf):
    done = F.col("state").isin("done", "failed", "skipped") & (F.col("seq") % 2 == 0)
    return ledger(spark, sf, "task").groupBy("run_id").agg(F.coalesce(F.max(F.when(done, F.col("seq"))), F.lit(0)).alias("checkpoint"))


@query(with_ledgers("task", sql="SELECT run_id, string_agg(DISTINCT error, ',' ORDER BY error) AS codes FROM task WHERE error IS NOT NULL GROUP BY run_id"))
def d08_sorted_codes(spark, sf):
    return ledger(spark, sf, "task").where("error IS NOT NULL").groupBy("run_id").agg(F.array_join(F.array_sort(F.collect_set("error")), ",").alias("codes"))


@query("SELECT sha256(text) AS sha, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def d09_duplicate_groups(spark, sf):
    return table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("sha")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(with_ledgers("delivery_row", sql="""
    WITH i AS (SELECT o_orderkey AS version_id, o_custkey AS resource_id, o_custkey % 25 AS source_id FROM orders WHERE o_orderstatus = 'F'), c AS (SELECT r.* FROM delivery_row r WHERE version_id IN (SELECT version_id FROM i))
    SELECT (SELECT count(DISTINCT source_id) FROM i) AS sources, (SELECT count(DISTINCT resource_id) FROM i) AS resources, (SELECT count(DISTINCT version_id) FROM i) AS versions, (SELECT count(*) FROM c) AS rows,
        (SELECT count(DISTINCT s) FROM (SELECT markdown_hash AS s FROM c UNION ALL SELECT original_hash FROM c WHERE original_hash IS NOT NULL)) AS files"""))
def d10_snapshot_counters(spark, sf):
    items = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("version_id"), F.col("o_custkey").alias("resource_id"), (F.col("o_custkey") % 25).alias("source_id"))
    return A.snapshot_counters(items, ledger(spark, sf, "delivery_row"))


@query(with_ledgers("run", "source", sql="""
    WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY completed_at DESC NULLS LAST, id DESC) AS n FROM run WHERE status IN ('complete', 'failed')) WHERE n = 1)
    SELECT s.id AS source_id, l.id AS run_id, coalesce(l.status, 'UNKNOWN') AS status, CASE WHEN l.id IS NULL THEN 'never_run' ELSE array_to_string(list_sort(list_distinct(list_filter([l.reason, l.truncated], lambda x: x IS NOT NULL))), ',') END AS known_gaps
    FROM (SELECT id FROM source UNION ALL SELECT 'dd-none') s LEFT JOIN l ON l.source_id = s.id"""))
def d11_coverage(spark, sf):
    sources = ledger(spark, sf, "source").select("id").unionByName(spark.range(1).select(F.lit("dd-none").alias("id")))
    return A.coverage(sources, ledger(spark, sf, "run"))


@query("SELECT conv_id, max_by(route, (rank, route)) AS worst FROM (SELECT conv_id, CASE turn % 3 WHEN 0 THEN 'accept' WHEN 1 THEN 'accept_with_warning' ELSE 'vision_reparse_pages' END AS route, turn % 3 AS rank FROM conversations) GROUP BY conv_id")
def d12_worst_route(spark, sf):
    routes = F.array(F.lit("accept"), F.lit("accept_with_warning"), F.lit("vision_reparse_pages"))
    c = table(spark, sf, "conversations").withColumn("rank", (F.col("turn") % 3).cast("int"))
    return c.groupBy("conv_id").agg(F.max("rank").alias("r")).select("conv_id", F.element_at(routes, F.col("r") + 1).alias("worst"))


@query(with_ledgers("block", sql="SELECT document_id, page_idx, sum(length(text)) AS chars, count(*) AS blocks, CAST(sum(length(text) - length(replace(text, 'the', ''))) / 3 AS BIGINT) AS marks, coalesce(sum(length(text)) FILTER (type = 'table'), 0) AS table_chars FROM block GROUP BY 1, 2"))
def d13_page_blocks(spark, sf):
    n = F.char_length("text")
    return ledger(spark, sf, "block").groupBy("document_id", "page_idx").agg(F.sum(n).alias("chars"), F.count(F.lit(1)).alias("blocks"), (F.sum(n - F.char_length(F.replace("text", F.lit("the"), F.lit("")))) / 3).cast("long").alias("marks"), F.coalesce(F.sum(F.when(F.col("type") == "table", n)), F.lit(0)).alias("table_chars"))


@query("SELECT source, lang, count(*) AS n, CAST(row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS INTEGER) AS place FROM documents GROUP BY 1, 2")
def d16_most_common(spark, sf):
    from pyspark.sql.window import Window

    counts = table(spark, sf, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "lang")))


@query("SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, count(*) AS n, string_agg(DISTINCT regexp_extract(url, '://[^/]*/([a-z]*)', 1), ',' ORDER BY regexp_extract(url, '://[^/]*/([a-z]*)', 1)) AS classes FROM pages GROUP BY 1")
def d17_host_rollup(spark, sf):
    p = table(spark, sf, "pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", "://[^/]*/([a-z]*)", 1).alias("class"))
    return p.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("class")), ",").alias("classes"))


@query("SELECT lang, count(DISTINCT md5(text)) AS bodies, count(*) FILTER (n_chars > 1000) AS long_ones, max(n_chars) AS longest FROM documents GROUP BY lang")
def d18_d20_bodies(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count_distinct(F.md5("text")).alias("bodies"), F.count_if(F.col("n_chars") > 1000).alias("long_ones"), F.max("n_chars").alias("longest"))


@query("SELECT count(*) AS n, CAST(sum(CAST('0x' || substr(h, 1, 12) AS HUGEINT)) AS VARCHAR) AS low, CAST(sum(CAST('0x' || substr(h, 13, 12) AS HUGEINT)) AS VARCHAR) AS high FROM (SELECT md5(CAST(n_name AS VARCHAR) || chr(31) || CAST(n_nationkey AS VARCHAR) || chr(31) || CAST(n_regionkey AS VARCHAR)) AS h FROM nation)")
def d19_table_digest(spark, sf):
    return A.table_digest(table(spark, sf, "nation"))


@query("SELECT conv_id, string_agg(role, ',' ORDER BY first, role) AS roles FROM (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY 1, 2) GROUP BY 1")
def d21_ordered_distinct(spark, sf):
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    first = F.array_distinct(F.transform("t", lambda x: x["role"]))
    return turns.select("conv_id", F.array_join(first, ",").alias("roles"))


@query(with_ledgers("acquisition", sql="SELECT id, 'stalled' AS why FROM acquisition WHERE state = 'failed' AND acquired_at < (SELECT max(acquired_at) FROM acquisition) - INTERVAL 2 DAY UNION ALL SELECT id, 'unqueued' FROM acquisition WHERE state <> 'failed' AND id % 3 <> 0"))
def a20_recoverable_jobs(spark, sf):
    """Failed acquisitions stand for running jobs, others for waiting ones, of which every third is queued."""
    a = ledger(spark, sf, "acquisition")
    jobs = a.select("id", F.when(F.col("state") == "failed", "running").otherwise("waiting").alias("state"), F.col("acquired_at").alias("seen_at"))
    return A.recoverable_jobs(jobs, a.where("state <> 'failed' AND id % 3 = 0"), a.agg(F.max("acquired_at").alias("now")), 2)


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS campaign, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 <> 0 THEN 'INTERRUPTED' ELSE 'OK' END AS outcome,
    CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 2 = 0 THEN 'campaign_conflict' END AS error FROM orders""")
def a18_campaign_merge(spark, sf):
    o = table(spark, sf, "orders")
    first = o.select(F.col("o_orderkey").alias("id"), F.lit(1).alias("n"), F.lit("first").alias("campaign"), F.when(F.col("o_orderstatus") == "F", "INTERRUPTED").otherwise("OK").alias("outcome"))
    second = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.lit(2).alias("n"), F.lit("second").alias("campaign"), F.lit("OK").alias("outcome"))
    return A.campaigns(first.unionByName(second), "id", "n")


_SNAPSHOTS = "SELECT o_custkey AS id, o_custkey % 4 <> 0 AS sealed, count(*) + CASE WHEN o_custkey % 10 = 1 THEN 1 ELSE 0 END AS resource_count, count(DISTINCT o_orderkey % 7) AS version_count FROM {orders} GROUP BY o_custkey"


@query("""
    WITH s AS (""" + _SNAPSHOTS.format(orders="orders") + """), m AS (SELECT o_custkey AS snapshot_id, o_orderkey AS resource_id FROM orders),
    log AS (SELECT o_orderkey AS sequence, lag(o_custkey) OVER (ORDER BY o_orderkey) AS before, o_custkey AS after FROM orders WHERE o_orderkey % 20 = 0)
    SELECT 'immutable_record' AS rule, CAST(o_orderkey AS VARCHAR) AS key, CASE o_orderkey % 50 WHEN 0 THEN 'deleted' ELSE 'changed' END AS why FROM orders WHERE o_orderkey % 50 IN (0, 1)
    UNION ALL SELECT 'immutable_snapshot_mapping', m.snapshot_id || '/' || resource_id, CASE resource_id % 60 WHEN 0 THEN 'deleted' WHEN 1 THEN 'inserted' ELSE 'changed' END FROM m JOIN s ON s.id = m.snapshot_id WHERE sealed AND resource_id % 60 IN (0, 1, 2)
    UNION ALL SELECT 'invalid_snapshot_counts', CAST(id AS VARCHAR), CASE WHEN sealed THEN 'counters_differ' ELSE 'counted_before_closing' END FROM s WHERE NOT sealed OR id % 10 = 1
    UNION ALL SELECT 'invalid_publication', CAST(sequence AS VARCHAR), CASE WHEN before IS NOT DISTINCT FROM after THEN 'unchanged' ELSE 'snapshot_not_sealed' END FROM log WHERE before IS NOT DISTINCT FROM after OR after % 4 = 0
    UNION ALL SELECT 'version_observation_conflict', CAST(l_orderkey AS VARCHAR), count(DISTINCT l_partkey) || ' versions' FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_partkey) > 1""")
def l06_integrity_rules(spark, sf):
    """What the rules find in states of which some rows were changed after they were written."""
    from pyspark.sql.window import Window

    o = table(spark, sf, "orders")
    changed = o.where("o_orderkey % 50 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 50 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn("o_orderpriority", F.lit("seen"))
    snapshots = spark.sql(_SNAPSHOTS, orders=o)
    items = o.select(F.col("o_custkey").alias("snapshot_id"), F.col("o_orderkey").alias("resource_id"), (F.col("o_orderkey") % 7).alias("version_id"))
    n = F.col("resource_id") % 60
    later = items.where(n != 0).withColumn("version_id", F.when(n == 2, F.lit(99)).otherwise(F.col("version_id")))
    log = o.where("o_orderkey % 20 = 0").select(F.col("o_orderkey").alias("sequence"), F.lag("o_custkey").over(Window.orderBy("o_orderkey")).alias("before"), F.col("o_custkey").alias("after"))  # a log has few rows
    versions = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_orderkey").alias("observation_id"))
    return integrity.all_of(
        integrity.mutations(o, changed, "o_orderkey", free=["o_orderpriority"]),
        integrity.closed_mappings(items.where(n != 1), later, snapshots),
        integrity.snapshot_counts(snapshots, items),
        integrity.publications(log, snapshots),
        integrity.version_conflicts(versions),
    )


@query("""
    WITH c AS (SELECT p_partkey AS oid, CASE WHEN p_partkey % 5 = 0 THEN 'old_' WHEN p_partkey % 7 = 0 THEN 'job_' ELSE 'now_' END || p_partkey AS name, CASE WHEN p_partkey % 3 = 0 THEN 'i' ELSE 'r' END AS kind FROM part)
    SELECT c.oid, c.name, c.kind, t.name AS table_name, CASE WHEN c.name IN ('old_5', 'old_10') OR t.name IN ('old_5', 'old_10') THEN 'delete' WHEN starts_with(c.name, 'job_') THEN 'third_party' ELSE 'retain' END AS action,
        starts_with(c.name, 'old_') AS leftover FROM c LEFT JOIN c t ON c.kind = 'i' AND t.oid = c.oid - 1""")
def c13_f6_catalog(spark, sf):
    """A catalog of as many objects as there are parts; indexes belong to the table before them."""
    p = F.col("p_partkey")
    head = F.when(p % 5 == 0, "old_").when(p % 7 == 0, "job_").otherwise("now_")
    objects = table(spark, sf, "part").select(p.alias("oid"), F.concat(head, p.cast("string")).alias("name"), F.when(p % 3 == 0, "i").otherwise("r").alias("kind"))
    indexes = objects.where("kind = 'i'").select("oid", (F.col("oid") - 1).alias("table_oid"))
    told = integrity.catalog_objects(objects, indexes, ["old_5", "old_10"], "job_")
    left = integrity.leftovers(objects.where("kind = 'r'"), objects.where("kind = 'i'"), "old_").distinct().withColumn("leftover", F.lit(True))
    return told.join(left, "name", "left").withColumn("leftover", F.coalesce("leftover", F.lit(False)))
