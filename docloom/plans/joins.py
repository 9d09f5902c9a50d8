"""Registered joins, set operations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import joins as J
from docloom.operators import pages as P
from docloom.plans.base import query
from docloom.sources.tables import ledger, table, with_ledgers


@query(with_ledgers("delivery_row", sql="SELECT o.o_orderkey AS version_id, o.o_custkey AS resource_id, r.row_number, r.title, r.role FROM orders o JOIN delivery_row r ON r.version_id = o.o_orderkey WHERE o.o_orderstatus = 'F'"))
def c01_snapshot_rows(spark, sf):
    items = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("version_id"), F.col("o_custkey").alias("resource_id"))
    return J.snapshot_rows(items, ledger(spark, sf, "delivery_row")).select("version_id", "resource_id", "row_number", "title", "role")


@query("SELECT c.c_custkey AS resource_id, n.n_name AS source, o.o_orderkey AS version_id FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN orders o ON o.o_custkey = c.c_custkey")
def c02_current_version(spark, sf):
    c, n, o = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "orders")
    joined = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(o, o["o_custkey"] == c["c_custkey"])
    return joined.select(F.col("c_custkey").alias("resource_id"), F.col("n_name").alias("source"), F.col("o_orderkey").alias("version_id"))


@query("SELECT n.n_name AS source, r.r_name AS frontier FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey")
def c03_source_frontier(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_name").alias("source"), F.col("r_name").alias("frontier"))


@query(with_ledgers("override", "resource", "version", sql="""
    SELECT o.resource_id, o.version_id, r.id IS NOT NULL AS has_resource, v.id IS NOT NULL AS has_version, n.n_nationkey IS NOT NULL AS has_source
    FROM (SELECT resource_id + 5 AS resource_id, version_id FROM override) o LEFT JOIN resource r ON r.id = o.resource_id LEFT JOIN version v ON v.id = o.version_id LEFT JOIN nation n ON n.n_nationkey = r.source_id"""))
def c04_override_checks(spark, sf):
    shifted = ledger(spark, sf, "override").withColumn("resource_id", F.col("resource_id") + 5)
    sources = table(spark, sf, "nation").select(F.col("n_nationkey").alias("source_id"))
    return J.override_checks(shifted, ledger(spark, sf, "resource"), ledger(spark, sf, "version"), sources)


@query(with_ledgers("override", "resource", "version", sql="""
    SELECT r.id, r.source_id, v.id AS version_id, o.version_id IS NOT NULL AS overridden
    FROM resource r LEFT JOIN override o ON o.resource_id = r.id JOIN version v ON v.id = coalesce(o.version_id, r.current_version_id) AND v.resource_id = r.id"""))
def c05_effective_versions(spark, sf):
    return J.effective_versions(ledger(spark, sf, "resource"), ledger(spark, sf, "override"), ledger(spark, sf, "version"))


@query(with_ledgers("task", "task_input", sql="""
    SELECT id, seq FROM task t WHERE kind = 'target' AND state = 'pending' AND NOT EXISTS (
        SELECT 1 FROM task_input i JOIN task q ON q.id = i.request_id WHERE i.target_id = t.id AND q.kind = 'request' AND q.state IN ('pending', 'failed'))"""))
def c06_ready_targets(spark, sf):
    return J.ready_targets(ledger(spark, sf, "task"), ledger(spark, sf, "task_input"), ["pending", "failed"]).select("id", "seq")


@query(with_ledgers("task", "task_input", sql="SELECT i.target_id, string_agg(q.state, ',' ORDER BY i.position) AS states FROM task_input i JOIN task q ON q.id = i.request_id GROUP BY i.target_id"))
def c07_inputs_by_position(spark, sf):
    q = ledger(spark, sf, "task").select(F.col("id").alias("request_id"), "state")
    joined = ledger(spark, sf, "task_input").join(q, "request_id")
    ordered = joined.groupBy("target_id").agg(F.array_sort(F.collect_list(F.struct("position", "state"))).alias("s"))
    return ordered.select("target_id", F.array_join(F.transform("s", lambda x: x["state"]), ",").alias("states"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT unnest([1, 3, 5, 7]))")
def c08_semi_join_sources(spark, sf):
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in (1, 3, 5, 7)])).alias("c_nationkey"))
    return table(spark, sf, "customer").join(F.broadcast(wanted), "c_nationkey", "left_semi").select("c_custkey", "c_name")


@query(with_ledgers("point", sql="""
    SELECT id, language, cer, seconds FROM point r WHERE NOT EXISTS (
        SELECT 1 FROM point o WHERE o.language = r.language AND o.cer <= r.cer AND o.seconds <= r.seconds AND (o.cer < r.cer OR o.seconds < r.seconds))"""))
def c09_pareto_frontier(spark, sf):
    p = ledger(spark, sf, "point")
    return p.join(J.dominated(p).select("id"), "id", "left_anti").select("id", "language", "cer", "seconds")


@query(with_ledgers("point", sql="SELECT id, language, cer, seconds FROM point r WHERE NOT EXISTS (SELECT 1 FROM point o WHERE o.language = r.language AND o.cer <= r.cer AND CAST(o.seconds AS DOUBLE) < r.seconds / 1.25)"))
def c10_guarded_frontier(spark, sf):
    p = ledger(spark, sf, "point")
    return p.join(J.dominated(p, 1.25).select("id"), "id", "left_anti").select("id", "language", "cer", "seconds")


_WORDS = "SELECT event_id AS seq, event_id % 50 AS page_id, (event_id * 7 % 100) / 100.0 AS x0, (event_id * 7 % 100 + 4) / 100.0 AS x1, (event_id * 13 % 100) / 100.0 AS y0, (event_id * 13 % 100 + 2) / 100.0 AS y1 FROM {events}"
_REGIONS = "SELECT event_id % 50 AS page_id, event_id AS region_id, 0.125 AS rx0, 0.5 AS rx1, 0.25 AS ry0, 0.75 AS ry1 FROM {events} WHERE event_id < 100"


@query(f"WITH w AS ({_WORDS.replace('{events}', 'events')}), r AS ({_REGIONS.replace('{events}', 'events')}) SELECT w.page_id, r.region_id, count(*) AS words FROM w JOIN r ON r.page_id = w.page_id AND CAST(w.x0 + w.x1 AS DOUBLE) / 2 BETWEEN rx0 AND rx1 AND CAST(w.y0 + w.y1 AS DOUBLE) / 2 BETWEEN ry0 AND ry1 GROUP BY 1, 2")
def c11_words_in_regions(spark, sf):
    e = table(spark, sf, "events")
    return J.in_regions(spark.sql(_WORDS, events=e), spark.sql(_REGIONS, events=e)).groupBy("page_id", "region_id").agg(F.count(F.lit(1)).alias("words"))


@query("SELECT coalesce(l.doc_id, d.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'unexpected' END AS side FROM (SELECT DISTINCT doc_id + 3 AS doc_id FROM labels) l FULL JOIN documents d ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR d.doc_id IS NULL")
def c12_coverage_difference(spark, sf):
    return J.coverage_difference(table(spark, sf, "labels").withColumn("doc_id", F.col("doc_id") + 3), table(spark, sf, "documents"), "doc_id")


@query(with_ledgers("run", sql="SELECT source_id, e AS code, count(DISTINCT id) AS runs FROM (SELECT id, source_id, unnest(list_distinct([status, reason, coalesce(truncated, status)])) AS e FROM run) GROUP BY 1, 2"))
def c14_lateral_distinct_codes(spark, sf):
    r = ledger(spark, sf, "run").withColumn("codes", F.array_union(F.array("status", "reason"), F.array(F.coalesce("truncated", "status"))))
    return r.select("id", "source_id", F.explode("codes").alias("code")).groupBy("source_id", "code").agg(F.countDistinct("id").alias("runs"))


@query(with_ledgers("task", "task_input", sql="SELECT i.target_id, min(a.request_key) AS request_key, count(*) AS n FROM task_input i JOIN (SELECT event_id AS id, concat('q', user_id, event_type) AS request_key FROM events) a ON a.id = i.request_id GROUP BY 1"))
def c15_lookup_by_key(spark, sf):
    a = ledger(spark, sf, "acquisition").select(F.col("id").alias("request_id"), "request_key")
    return ledger(spark, sf, "task_input").join(a, "request_id").groupBy("target_id").agg(F.min("request_key").alias("request_key"), F.count(F.lit(1)).alias("n"))


@query("SELECT c.c_custkey AS resource_id, count(o.o_orderkey) AS matches, count(o.o_orderkey) = 1 AS resolved FROM customer c LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 10 = 1) o ON o.o_custkey = c.c_custkey GROUP BY 1")
def c16_exactly_one_match(spark, sf):
    o = table(spark, sf, "orders").where("o_orderkey % 10 = 1").select(F.col("o_custkey").alias("resource_id"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("resource_id"))
    return J.exactly_one(o, "resource_id", c).select("resource_id", "matches", "resolved")


@query(with_ledgers("acquisition", sql="""
    WITH chain AS (SELECT id, id AS root, 0 AS depth FROM acquisition WHERE parent_id IS NULL UNION ALL SELECT a.id, c.root, c.depth + 1 FROM acquisition a JOIN chain c ON a.parent_id = c.id)
    SELECT id, root, depth FROM chain"""))
def a04_acquisition_chains(spark, sf):
    return J.chain_roots(ledger(spark, sf, "acquisition"))


@query("SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def f01_union_distinct(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"))
    return o.unionByName(table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("key"))).distinct()


@query("SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels")
def f02_set_difference(spark, sf):
    return table(spark, sf, "documents").select("doc_id").exceptAll(table(spark, sf, "labels").select("doc_id"))


@query(with_ledgers("run", sql="SELECT id, array_to_string(list_sort(list_distinct([status, reason, coalesce(truncated, reason)])), ',') AS gaps FROM run"))
def f03_union_of_gaps(spark, sf):
    gaps = F.array_sort(F.array_union(F.array("status", "reason"), F.array(F.coalesce("truncated", "reason"))))
    return ledger(spark, sf, "run").select("id", F.array_join(gaps, ",").alias("gaps"))


@query("(SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def f04_inventory_equality(spark, sf):
    d, l = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    return d.exceptAll(l).distinct().unionByName(l.subtract(d))


@query(with_ledgers("delivery_row", sql="SELECT sha, min(kind) AS kind, count(*) AS refs FROM (SELECT original_hash AS sha, 'original' AS kind FROM delivery_row WHERE original_hash IS NOT NULL UNION ALL SELECT markdown_hash, 'markdown' FROM delivery_row) GROUP BY sha"))
def f05_file_closure(spark, sf):
    return P.file_references(ledger(spark, sf, "delivery_row")).groupBy("sha").agg(F.min("kind").alias("kind"), F.count(F.lit(1)).alias("refs"))


@query(with_ledgers("delivery_row", sql="""
    SELECT o.o_custkey % 25 AS source_id, o.o_custkey AS resource_id, r.version_id, r.row_number, r.title FROM delivery_row r JOIN orders o ON o.o_orderkey = r.version_id
    WHERE (o.o_custkey % 25, o.o_custkey, r.version_id, r.row_number) > (3, 28, 0, 0) ORDER BY 1, 2, 3, 4, 5 LIMIT 51"""))
def e01_keyset_page(spark, sf):
    rows = ledger(spark, sf, "delivery_row").join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("version_id"), F.col("o_custkey").alias("resource_id"), (F.col("o_custkey") % 25).alias("source_id")), "version_id")
    return P.keyset_page(rows, ["source_id", "resource_id", "version_id", "row_number"], [3, 28, 0, 0], 50, tie=["title"]).select("source_id", "resource_id", "version_id", "row_number", "title")


@query("SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderkey > 120 ORDER BY o_orderkey LIMIT 101")
def e03_id_listing(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    return P.keyset_page(rows, ["id"], [120], 100)


@query(with_ledgers("task", sql="SELECT id, seq FROM task WHERE state = 'pending' AND kind = 'request' ORDER BY seq LIMIT 8"))
def e04_take_queue(spark, sf):
    return ledger(spark, sf, "task").where("state = 'pending' AND kind = 'request'").orderBy("seq").limit(8).select("id", "seq")


@query(with_ledgers("acquisition", sql="SELECT request_key, id, archive_ref FROM (SELECT *, row_number() OVER (PARTITION BY request_key ORDER BY acquired_at DESC, id DESC) AS n FROM acquisition WHERE state = 'archived' AND outcome = 'ok') WHERE n = 1"))
def e05_latest_archived(spark, sf):
    a = ledger(spark, sf, "acquisition").where("state = 'archived' AND outcome = 'ok'")
    return P.latest(a, ["request_key"], ["acquired_at", "id"], ["id", "archive_ref"])


@query(with_ledgers("resource", sql="SELECT id, source_id, n > 5 AS beyond FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY next_check, id) AS n FROM resource WHERE next_check <= 4000) WHERE n <= 6"))
def e06_due_resources(spark, sf):
    return P.due(ledger(spark, sf, "resource"), 4000.0, 5)


@query("""
    SELECT conv_id, turn, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END, turn, text) AS BIGINT) AS row_number FROM conversations""")
def e07_deliverable_order(spark, sf):
    return P.deliverable_rows(table(spark, sf, "conversations"), "conv_id", ["system", "user", "assistant"]).select("conv_id", "turn", "role", "row_number")


@query(with_ledgers("delivery_row", sql="SELECT sha, kind, version_id FROM (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY kind DESC, version_id, row_number) AS n FROM (SELECT original_hash AS sha, 'original' AS kind, version_id, row_number FROM delivery_row WHERE original_hash IS NOT NULL UNION ALL SELECT markdown_hash, 'markdown', version_id, row_number FROM delivery_row)) WHERE n = 1"))
def e09_file_preference(spark, sf):
    refs = P.file_references(ledger(spark, sf, "delivery_row"))
    first = refs.groupBy("sha").agg(F.min(F.struct(F.when(F.col("kind") == "original", 0).otherwise(1), "version_id", "row_number", "kind")).alias("m"))
    return first.select("sha", F.col("m.kind").alias("kind"), F.col("m.version_id").alias("version_id"))


@query("SELECT * FROM (SELECT page_id, 3 * CAST(regexp_matches(url, '/[0-9]+\\.html$') AS INTEGER) + 2 * CAST(regexp_matches(html, 'Was |The ') AS INTEGER) + CAST(regexp_matches(url, '20[0-9]{2}|[0-9]{4}') AS INTEGER) AS score FROM pages) WHERE score >= 3 ORDER BY score DESC, page_id LIMIT 12")
def e10_link_score(spark, sf):
    p = table(spark, sf, "pages")
    score = 3 * F.col("url").rlike(r"/[0-9]+\.html$").cast("int") + 2 * F.col("html").rlike("Was |The ").cast("int") + F.col("url").rlike("20[0-9]{2}|[0-9]{4}").cast("int")
    return p.select("page_id", score.alias("score")).where("score >= 3").orderBy(F.desc("score"), "page_id").limit(12)


@query("SELECT item_id, CAST(row_number() OVER (ORDER BY md5('20260714/' || item_id), item_id) AS BIGINT) AS place FROM benchmark")
def e12_seeded_shuffle(spark, sf):
    """Jobs in the order of a seed: each with its place."""
    return P.seeded_places(table(spark, sf, "benchmark").select("item_id"), "item_id", 20260714)
