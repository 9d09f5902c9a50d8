"""Registered timelines and state machines."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import timeline as T
from docloom.plans.base import query
from docloom.sources.tables import ledger, table, with_ledgers

#: The timeline in its island form; a sequential fold in the tests is the other judge.
_TIMELINE = """
    WITH a AS (SELECT *, row_number() OVER r AS n, first_value(input_fp) OVER r = input_fp AND first_value(parser_fp) OVER r = parser_fp AND first_value(content_hash) OVER r = content_hash AND first_value(failed_code) OVER r IS NULL AND failed_code IS NULL AS same
        FROM delivery WINDOW r AS (PARTITION BY resource_id, run_seq ORDER BY seq)),
    g AS (SELECT *, lag(input_fp) OVER w AS pi, lag(parser_fp) OVER w AS pp FROM a WHERE n = 1 AND failed_code IS NULL WINDOW w AS (PARTITION BY resource_id ORDER BY run_seq, seq)),
    v AS (SELECT *, pi IS NULL OR pi <> input_fp OR pp <> parser_fp AS fresh FROM g),
    i AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY resource_id ORDER BY run_seq, seq) AS version FROM v),
    b AS (SELECT *, first_value(content_hash) OVER (PARTITION BY resource_id, version ORDER BY run_seq, seq) AS base FROM i),
    j AS (SELECT resource_id, seq, CAST(version AS BIGINT) AS version, CASE WHEN fresh AND pi IS NULL THEN 'created' WHEN fresh THEN 'changed' WHEN content_hash <> base THEN 'failed' ELSE 'unchanged' END AS outcome,
        CASE WHEN fresh AND pi IS NULL THEN 'first_success' WHEN fresh AND pi <> input_fp AND pp <> parser_fp THEN 'both_changed' WHEN fresh AND pi <> input_fp THEN 'source_changed' WHEN fresh AND mode = 'reparse' THEN 'parser_recomputed' WHEN fresh THEN 'parser_changed' WHEN content_hash <> base THEN 'nondeterministic' ELSE 'unchanged' END AS reason FROM b)
    SELECT a.resource_id, a.run_seq, a.seq,
        CASE WHEN a.n > 1 AND a.same THEN 'replayed' WHEN a.n > 1 AND a.failed_code IS NOT NULL THEN 'ignored' WHEN a.n > 1 THEN 'conflict' WHEN a.failed_code IS NOT NULL THEN 'failed' ELSE j.outcome END AS outcome,
        CASE WHEN a.n > 1 AND a.same THEN 'replayed' WHEN a.n > 1 AND a.failed_code IS NOT NULL THEN 'ignored_failure' WHEN a.n > 1 THEN 'delivery_key_conflict' WHEN a.failed_code IS NOT NULL THEN a.failed_code ELSE j.reason END AS reason,
        last_value(j.version IGNORE NULLS) OVER (PARTITION BY a.resource_id ORDER BY a.run_seq, a.seq) AS version
    FROM a LEFT JOIN j ON j.resource_id = a.resource_id AND j.seq = a.seq"""


@query(with_ledgers("delivery", sql=_TIMELINE))
def j04_version_timeline(spark, sf):
    return T.version_timeline(ledger(spark, sf, "delivery"))


@query("""WITH s AS (SELECT source || '/' || CAST(doc_id % 40 AS VARCHAR) AS resource, doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS hash FROM documents), l AS (SELECT *, lag(hash) OVER (PARTITION BY resource ORDER BY doc_id) AS p FROM s)
    SELECT resource, doc_id, hash, CASE WHEN p IS NULL THEN 'created' WHEN p = hash THEN 'unchanged' ELSE 'changed' END AS reason, CAST(sum(CASE WHEN p IS NULL OR p <> hash THEN 1 ELSE 0 END) OVER (PARTITION BY resource ORDER BY doc_id) AS BIGINT) AS version FROM l""")
def j04_document_timeline(spark, sf):
    return T.document_timeline(table(spark, sf, "documents"), F.concat_ws("/", "source", (F.col("doc_id") % 40).cast("string")), "doc_id")


@query(with_ledgers("task", sql="SELECT run_id, kind, key, seq, state FROM (SELECT *, coalesce(external_key, 'none') AS key, row_number() OVER (PARTITION BY run_id, kind, coalesce(external_key, 'none') ORDER BY seq) AS n FROM task) WHERE n = 1"))
def j01_task_upsert(spark, sf):
    t = ledger(spark, sf, "task").select("run_id", "kind", F.coalesce("external_key", F.lit("none")).alias("key"), "seq", "state")
    return T.upsert_first(t, ["run_id", "kind", "key"], "seq")


@query(with_ledgers("task", sql="""
    WITH t AS (SELECT run_id, seq, namespace || '/' || coalesce(external_key, '-') AS identity FROM task WHERE kind = 'target'), f AS (SELECT run_id, identity, row_number() OVER (PARTITION BY run_id ORDER BY min(seq)) AS place, min(seq) AS first_seq FROM t GROUP BY 1, 2)
    SELECT t.run_id, t.seq, t.identity, CASE WHEN f.place > 12 THEN 'skipped' WHEN t.seq > f.first_seq THEN 'replay_candidate' ELSE 'pending' END AS state FROM t JOIN f ON f.run_id = t.run_id AND f.identity = t.identity"""))
def j02_register_targets(spark, sf):
    t = ledger(spark, sf, "task").where("kind = 'target'").select("run_id", "seq", F.concat_ws("/", "namespace", F.coalesce("external_key", F.lit("-"))).alias("identity"))
    return T.register_targets(t, 12)


_INPUTS = "CASE id % 6 WHEN 0 THEN {0}'a'{1} WHEN 1 THEN {0}'a', 'b'{1} WHEN 2 THEN {0}'b', 'a', 'c'{1} WHEN 3 THEN {0}'d'{1} ELSE {0}'a', 'b'{1} END"


@query(with_ledgers("task", sql=f"""
    WITH t AS (SELECT run_id, namespace, seq, {_INPUTS.format('[', ']')} AS inputs, id % 4 <> 0 AS open, row_number() OVER (PARTITION BY run_id, namespace, external_key ORDER BY seq) AS n, external_key FROM task WHERE external_key IS NOT NULL),
    r AS (SELECT run_id, namespace, external_key, n, seq, inputs AS current, CAST([] AS VARCHAR[]) AS replayed, 'register' AS action, inputs AS told FROM t WHERE n = 1
        UNION ALL SELECT run_id, namespace, external_key, n, seq, CASE WHEN action = 'amend' THEN more ELSE current END, CASE WHEN action = 'replay' THEN list_append(replayed, text) ELSE replayed END, action, CASE WHEN action = 'replay' THEN inputs WHEN action = 'amend' THEN more ELSE current END
        FROM (SELECT t.run_id, t.namespace, t.external_key, t.n, t.seq, t.inputs, r.current, r.replayed, array_to_string(t.inputs, chr(10)) AS text, list_concat(r.current, list_filter(t.inputs, lambda x: NOT list_contains(r.current, x))) AS more,
            CASE WHEN t.inputs = r.current THEN 'skip' WHEN t.open AND list_has_all(t.inputs, r.current) THEN 'amend' WHEN list_contains(r.replayed, array_to_string(t.inputs, chr(10))) THEN 'skip' ELSE 'replay' END AS action
            FROM r JOIN t ON t.run_id = r.run_id AND t.namespace = r.namespace AND t.external_key = r.external_key AND t.n = r.n + 1))
    SELECT run_id, namespace, external_key, seq, action, array_to_string(told, ',') AS inputs FROM r"""))
def j02_registrations(spark, sf):
    """Targets that appear again in their run: skipped, amended or replayed."""
    t = ledger(spark, sf, "task").where("external_key IS NOT NULL")
    t = t.select("run_id", "namespace", "external_key", "seq", F.expr(_INPUTS.format("array(", ")")).alias("inputs"), F.expr("id % 4 <> 0").alias("open"))
    return T.registrations(t, ["run_id", "namespace", "external_key"], "seq").withColumn("inputs", F.array_join("inputs", ","))


@query(with_ledgers("acquisition", sql="SELECT id, CAST(least(60, CASE WHEN id % 2 = 0 THEN 30 ELSE 86400 END) AS BIGINT) AS retry_seconds FROM acquisition WHERE state = 'failed' AND request_key NOT IN (SELECT request_key FROM acquisition WHERE state = 'archived' AND outcome = 'ok' AND id % 4 = 0)"))
def j05_failure_delivery(spark, sf):
    a = ledger(spark, sf, "acquisition")
    done = a.where("state = 'archived' AND outcome = 'ok' AND id % 4 = 0").select("request_key").distinct()
    recheck = F.when(F.col("id") % 2 == 0, 30).otherwise(86400)
    return a.where("state = 'failed'").join(done, "request_key", "left_anti").select("id", F.least(F.lit(60), recheck).cast("long").alias("retry_seconds"))


@query(with_ledgers("delivery_row", sql="""
    SELECT version_id, CASE WHEN unnumbered > 0 OR (n > 0 AND orders <> range(1, n + 1)) THEN 'volume_order_ambiguous' WHEN n > 0 AND primaries > 0 THEN 'volume_and_primary_conflict' WHEN primaries > 1 THEN 'multiple_primary_deliverables' END AS error
    FROM (SELECT version_id, count(*) FILTER (role = 'volume') AS n, count(*) FILTER (role = 'primary') AS primaries, count(*) FILTER (role = 'volume' AND volume_order IS NULL) AS unnumbered, list_sort(coalesce(list(CAST(volume_order - 1 AS BIGINT)) FILTER (role = 'volume'), [])) AS orders
        FROM (SELECT version_id, CASE WHEN version_id % 3 = 0 AND role = 'primary' THEN 'x' ELSE role END AS role, volume_order FROM delivery_row) GROUP BY 1)"""))
def j06_volume_contract(spark, sf):
    r = ledger(spark, sf, "delivery_row").withColumn("role", F.when((F.col("version_id") % 3 == 0) & (F.col("role") == "primary"), "x").otherwise(F.col("role"))).withColumn("volume_order", F.col("volume_order") - 1)
    return T.valid_volumes(r, "version_id")


@query("""WITH f AS (SELECT conv_id, turn AS position, CASE WHEN role = 'user' THEN (turn + conv_id) % 5 END AS number FROM conversations), c AS (SELECT *, count(number) OVER (PARTITION BY conv_id) AS numbered, count(*) OVER (PARTITION BY conv_id, number) AS same FROM f),
    d AS (SELECT *, max(CASE WHEN number IS NOT NULL THEN same END) OVER (PARTITION BY conv_id) > 1 AS void, numbered >= 2 AND number IS NOT NULL AS vol FROM c)
    SELECT conv_id, position, CASE WHEN vol THEN 'volume' WHEN numbered < 2 AND row_number() OVER (PARTITION BY conv_id, vol ORDER BY position) = 1 THEN 'primary' ELSE 'independent_attachment' END AS role, CASE WHEN vol AND NOT void THEN number END AS volume_order FROM d""")
def j07_attachment_roles(spark, sf):
    f = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("position"), F.when(F.col("role") == "user", (F.col("turn") + F.col("conv_id")) % 5).alias("number"))
    return T.assign_attachments(f, "conv_id")


@query(with_ledgers("delivery_row", sql="SELECT version_id, row_number, CASE WHEN title LIKE '%7' THEN 'own' WHEN role IN ('primary', 'volume') THEN status END AS status FROM delivery_row"))
def j08_metadata_inheritance(spark, sf):
    r = ledger(spark, sf, "delivery_row")
    status = F.when(F.col("title").endswith("7"), "own").when(F.col("role").isin("primary", "volume"), F.col("status"))
    return r.select("version_id", "row_number", status.alias("status"))


@query(with_ledgers("delivery_row", "override", "resource", "version", sql="""
    WITH m AS (SELECT r.id AS resource_id, r.source_id, v.id AS version_id FROM resource r LEFT JOIN override o ON o.resource_id = r.id JOIN version v ON v.id = coalesce(o.version_id, r.current_version_id) AND v.resource_id = r.id),
    f AS (SELECT m.source_id, x.sha, x.kind, min(x.title) AS name FROM m JOIN (SELECT version_id, markdown_hash AS sha, 'markdown' AS kind, title FROM delivery_row UNION ALL SELECT version_id, original_hash, 'original', title FROM delivery_row WHERE original_hash IS NOT NULL) x ON x.version_id = m.version_id GROUP BY 1, 2, 3)
    SELECT source_id, kind, count(*) AS files, min(name) AS first_name FROM f GROUP BY 1, 2"""))
def j09_j10_snapshot_files(spark, sf):
    """The mapping that a snapshot freezes, and its file closure with one name for each file."""
    from docloom.operators.joins import effective_versions

    m = effective_versions(ledger(spark, sf, "resource"), ledger(spark, sf, "override"), ledger(spark, sf, "version")).select("source_id", "version_id")
    r = ledger(spark, sf, "delivery_row")
    both = r.select("version_id", F.explode(F.array(F.struct(F.col("markdown_hash").alias("sha"), F.lit("markdown").alias("kind")), F.struct(F.col("original_hash").alias("sha"), F.lit("original").alias("kind")))).alias("f"), "title")
    files = m.join(both.where("f.sha IS NOT NULL"), "version_id").groupBy("source_id", "f.sha", "f.kind").agg(F.min("title").alias("name"))
    return files.groupBy("source_id", "kind").agg(F.count(F.lit(1)).alias("files"), F.min("name").alias("first_name"))


@query(with_ledgers("run", sql="WITH l AS (SELECT *, lead(run_seq) OVER (PARTITION BY source_id ORDER BY id) AS next FROM run) SELECT id, CASE WHEN status <> 'running' THEN status WHEN next IS NOT NULL THEN 'abandoned' ELSE 'running' END AS status FROM l"))
def j12_supersede(spark, sf):
    """A running attempt with a later run of its source is abandoned."""
    from pyspark.sql.window import Window

    later = F.lead("run_seq").over(Window.partitionBy("source_id").orderBy("id"))
    return ledger(spark, sf, "run").select("id", F.when(F.col("status") != "running", F.col("status")).when(later.isNotNull(), "abandoned").otherwise("running").alias("status"))


@query(with_ledgers("run", sql="SELECT id, CASE WHEN reason = 'interrupted' THEN 'retryable' WHEN attempt_epoch >= max_attempts OR reason <> 'child_process_failed' THEN 'failed' ELSE 'retryable' END AS status FROM run"))
def j14_terminal_status(spark, sf):
    return ledger(spark, sf, "run").select("id", T.terminal_status(F.col("reason"), F.col("attempt_epoch") >= F.col("max_attempts")).alias("status"))


@query(with_ledgers("task", sql="SELECT run_id, CASE WHEN count(error) > 0 THEN 'failed' ELSE 'complete' END AS status FROM task GROUP BY run_id"))
def j13_run_finalisation(spark, sf):
    from docloom.operators.accounting import run_status

    return run_status(ledger(spark, sf, "task"), "run_id")


@query(with_ledgers("acquisition", sql="SELECT id, CASE WHEN state = 'archived' AND outcome = 'ok' THEN 'archived' WHEN e = 'interrupted' THEN 'interrupted' WHEN e IN ('request_budget_exceeded', 'deadline_exceeded') THEN 'truncated' ELSE 'failed' END AS route FROM (SELECT *, CASE id % 4 WHEN 0 THEN 'interrupted' WHEN 1 THEN 'request_budget_exceeded' WHEN 2 THEN 'deadline_exceeded' ELSE 'http_500' END AS e FROM acquisition)"))
def j15_fetch_route(spark, sf):
    a = ledger(spark, sf, "acquisition")
    e = F.element_at(F.array(*[F.lit(x) for x in ("interrupted", "request_budget_exceeded", "deadline_exceeded", "http_500")]), (F.col("id") % 4 + 1).cast("int"))
    return a.select("id", T.fetch_route(F.col("state"), F.col("outcome"), e).alias("route"))


@query(with_ledgers("task", "task_input", sql="""SELECT t.id, 'required_input_failed:' || m.error AS error FROM task t LEFT JOIN (SELECT i.target_id, min_by(q.error, i.position) AS error FROM task_input i JOIN task q ON q.id = i.request_id WHERE q.error IS NOT NULL GROUP BY 1) m ON m.target_id = t.id WHERE t.kind = 'target'"""))
def j16_required_input(spark, sf):
    t = ledger(spark, sf, "task")
    return T.first_failed_input(t.where("kind = 'target'").select("id"), ledger(spark, sf, "task_input"), t)


@query(with_ledgers("task", sql="SELECT id, CASE WHEN state IN ('pending', 'archived') THEN 'skipped' ELSE state END AS state, CASE WHEN state IN ('pending', 'archived') THEN 'document_budget_exceeded' ELSE error END AS error FROM task WHERE kind = 'target'"))
def j17_close_targets(spark, sf):
    t, open_ = ledger(spark, sf, "task").where("kind = 'target'"), F.col("state").isin("pending", "archived")
    return t.select("id", F.when(open_, "skipped").otherwise(F.col("state")).alias("state"), F.when(open_, "document_budget_exceeded").otherwise(F.col("error")).alias("error"))


@query("SELECT c_custkey AS id, 1 + CASE WHEN sha256(c_mktsegment) <> sha256(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'OTHER' END) THEN 1 ELSE 0 END AS generation FROM customer")
def j18_config_generation(spark, sf):
    other = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise("OTHER")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (1 + (F.sha2("c_mktsegment", 256) != F.sha2(other, 256)).cast("int")).alias("generation"))


@query(with_ledgers("task", sql="SELECT id, count(*) OVER w <= 30 AND sum(id % 13) OVER w <= 150 AS allowed FROM task WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS UNBOUNDED PRECEDING)"))
def j19_budgets(spark, sf):
    t = ledger(spark, sf, "task").withColumn("bytes", F.col("id") % 13)
    return T.within_budget(t, "run_id", "seq", {"1": 30, "bytes": 150}).select("id", "allowed")


@query(with_ledgers("run", "source", sql="""SELECT r.id, CASE WHEN r.attempt_epoch >= r.max_attempts THEN 'attempts_exhausted' WHEN r.generation <> s.generation THEN 'source_generation_changed' WHEN s.paused THEN 'source_paused' WHEN s.write_seq > r.run_seq THEN 'run_superseded' END AS error FROM run r JOIN source s ON s.id = r.source_id"""))
def b07_fencing(spark, sf):
    return T.eligibility(ledger(spark, sf, "run"), ledger(spark, sf, "source"))


@query(with_ledgers("task", "task_input", sql="SELECT i.target_id, i.request_id, a.event_type IN ('view', 'click', 'purchase') AND a.user_id % 20 = t.run_id AS eligible FROM task_input i JOIN task t ON t.id = i.target_id JOIN events a ON a.event_id = i.request_id"))
def b08_eligible_input(spark, sf):
    a = ledger(spark, sf, "acquisition").select(F.col("id").alias("request_id"), "state", "outcome", F.col("run_id").alias("_run"))
    t = ledger(spark, sf, "task").select(F.col("id").alias("target_id"), "run_id")
    joined = ledger(spark, sf, "task_input").join(t, "target_id").join(a, "request_id")
    return joined.select("target_id", "request_id", ((F.col("state") == "archived") & (F.col("outcome") == "ok") & (F.col("_run") == F.col("run_id"))).alias("eligible"))
