"""Readers of the base tables, and ledgers derived from them for operators that need a state machine's history."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Ledgers in SQL that Spark and DuckDB share; {name} is a base table.
_TASK_ERRORS = "CASE event_id % 8 WHEN 0 THEN 'interrupted' WHEN 1 THEN 'request_budget_exceeded' WHEN 2 THEN 'network_failed' WHEN 3 THEN 'http_500' WHEN 4 THEN 'required_input_failed:http_404' WHEN 5 THEN 'quality_check_failed:vision' WHEN 6 THEN 'page_limit_exceeded' ELSE 'xpath_invalid' END"
LEDGERS: dict[str, str] = {
    "task": f"""
        SELECT event_id AS id, user_id % 20 AS run_id, event_id AS seq,
            CASE WHEN event_id % 3 = 0 THEN 'target' ELSE 'request' END AS kind,
            CASE event_type WHEN 'view' THEN 'done' WHEN 'click' THEN 'archived' WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'skipped' ELSE 'failed' END AS state,
            CASE WHEN event_type = 'error' THEN {_TASK_ERRORS} END AS error, value AS seconds, ts,
            concat('n', CAST(user_id % 4 AS STRING)) AS namespace, CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('k', CAST(event_id % 97 AS STRING)) END AS external_key
        FROM {{events}}""",
    "task_input": "SELECT event_id AS target_id, event_id + 1 + o.n AS request_id, o.n AS position FROM {events} CROSS JOIN (SELECT 0 AS n UNION ALL SELECT 1 AS n UNION ALL SELECT 3 AS n) o WHERE event_id % 3 = 0",
    "acquisition": """
        SELECT event_id AS id, concat('dd-', CAST(user_id % 12 AS STRING)) AS source_id, user_id % 20 AS run_id, concat('q', CAST(user_id AS STRING), event_type) AS request_key,
            CASE WHEN event_id % 5 <> 0 THEN event_id - 1 END AS parent_id,
            CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'redirect' ELSE 'retry' END AS parent_relation,
            CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 301 ELSE 200 END AS http_status,
            CASE WHEN event_type = 'error' THEN 'failed' ELSE 'archived' END AS state,
            CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'ok' ELSE 'blocked' END AS outcome,
            md5(CAST(event_id % 500 AS STRING)) AS archive_ref, ts AS acquired_at, value AS seconds
        FROM {events}""",
    "delivery": """
        SELECT CAST(floor(event_id / 200) AS BIGINT) AS run_seq, user_id AS resource_id, event_id AS seq,
            CASE WHEN CAST(floor(event_id / 200) AS BIGINT) % 5 = 4 THEN 'reparse' ELSE 'collect' END AS mode,
            concat('i', CAST(CAST(floor(event_id / 7) AS BIGINT) % 2 AS STRING)) AS input_fp, concat('p', CAST(CAST(floor(event_id / 1500) AS BIGINT) AS STRING)) AS parser_fp,
            concat('c', CAST(CAST(floor(event_id / 7) AS BIGINT) % 2 AS STRING), CASE WHEN event_id % 11 = 0 THEN 'x' ELSE '' END) AS content_hash,
            CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'document_body_missing' END AS failed_code, ts AS observed_at
        FROM {events}""",
    "run": """
        SELECT o_orderkey AS id, concat('dd-', CAST(o_custkey % 40 AS STRING)) AS source_id,
            CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'complete' ELSE 'running' END AS status,
            CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate END AS completed_at,
            CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS truncated, o_orderkey % 7 AS attempt_epoch, 5 AS max_attempts, o_custkey % 3 AS generation, o_orderkey % 100 AS run_seq,
            CASE WHEN o_orderkey % 6 = 0 THEN 'interrupted' WHEN o_orderkey % 6 = 1 THEN 'child_process_failed' ELSE 'parse_failed' END AS reason
        FROM {orders}""",
    "source": "SELECT concat('dd-', CAST(c_custkey AS STRING)) AS id, c_custkey % 3 AS generation, c_custkey % 11 = 0 AS paused, (c_custkey * 7) % 100 AS write_seq FROM {customer} WHERE c_custkey < 40",
    "resource": "SELECT c_custkey AS id, c_nationkey AS source_id, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey * 10 % 1500 END AS current_version_id, c_acctbal AS next_check FROM {customer}",
    "version": "SELECT o_orderkey AS id, o_custkey AS resource_id, o_orderdate AS created_at, o_orderstatus AS reason FROM {orders}",
    "override": "SELECT o_custkey AS resource_id, max(o_orderkey) AS version_id FROM {orders} WHERE o_orderkey % 10 = 0 GROUP BY o_custkey",
    "delivery_row": """
        SELECT l_orderkey AS version_id, l_linenumber AS row_number, concat('row ', CAST(l_partkey AS STRING)) AS title,
            CASE WHEN l_linenumber = 1 THEN 'primary' WHEN l_returnflag = 'R' THEN 'volume' ELSE 'independent_attachment' END AS role,
            CASE WHEN l_returnflag = 'R' THEN l_linenumber END AS volume_order, md5(CAST(l_partkey AS STRING)) AS markdown_hash,
            CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE md5(CAST(l_suppkey AS STRING)) END AS original_hash, l_shipdate AS acquired_at, l_linestatus AS status
        FROM {lineitem}""",
    "receipt": """
        SELECT concat('e', CAST(user_id % 6 AS STRING)) AS engine, CASE event_id % 4 WHEN 0 THEN 'zh' WHEN 1 THEN 'en' WHEN 2 THEN 'vi' ELSE 'fr' END AS language, 96 + 24 * (user_id % 3) AS dpi,
            CAST(floor(event_id / 4) AS BIGINT) % 5 AS page_id, CAST(floor(event_id / 20) AS BIGINT) % 3 AS repetition, CASE WHEN event_type = 'error' AND event_id % 31 = 0 THEN 'failed' ELSE 'ok' END AS status,
            value AS total_seconds, event_id % 7 AS errors, 40 + event_id % 5 AS reference_characters, md5(CAST(event_id % 3 AS STRING)) AS output_sha
        FROM {events}""",
    "point": "SELECT vec_id AS id, concat('l', CAST(label AS STRING)) AS language, CAST(floor(abs(embedding[0]) * 1000) AS BIGINT) AS cer, CAST(floor(abs(embedding[1]) * 1000) AS BIGINT) AS seconds FROM {embeddings}",
    "link": """
        SELECT page_id, CASE page_id % 8 WHEN 0 THEN url WHEN 1 THEN replace(url, 'https://', 'HTTPS://User:pw@') WHEN 2 THEN concat(replace(url, '#top', ''), '?Session_Id=9&x=1') WHEN 3 THEN replace(url, '.com/', '.COM:443/')
            WHEN 4 THEN 'mailto:a@b.example' WHEN 5 THEN concat(replace(replace(url, '#top', ''), '?', ';jsessionid=A1?'), '&utm_medium=m&q=%C3%A9+1') WHEN 6 THEN replace(url, '.org/', '.org:8080/') ELSE replace(url, '/en/', '/en/../en/doc?docid=17&n=') END AS url
        FROM {pages}""",
}
#: Ledgers whose splitting differs between the engines: (Spark, DuckDB).
SPLIT_LEDGERS: dict[str, tuple[str, str]] = {
    "block": (
        "SELECT doc_id AS document_id, b.n AS block_no, CAST(floor(b.n / 4) AS BIGINT) AS page_idx, CASE b.n % 5 WHEN 3 THEN 'table' WHEN 1 THEN 'header' WHEN 4 THEN 'image' ELSE 'text' END AS type, b.t AS text, b.n * 37 % 100 AS y0 FROM {documents} LATERAL VIEW posexplode(split(text, '\\n')) b AS n, t",
        "SELECT doc_id AS document_id, n AS block_no, CAST(floor(n / 4) AS BIGINT) AS page_idx, CASE n % 5 WHEN 3 THEN 'table' WHEN 1 THEN 'header' WHEN 4 THEN 'image' ELSE 'text' END AS type, t AS text, n * 37 % 100 AS y0 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS n FROM {documents})",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A ledger derived from base tables."""
    text = LEDGERS.get(name) or SPLIT_LEDGERS[name][0]
    bases = {b: table(spark, sf_dir, b) for b in re.findall(r"\{(\w+)\}", text)}
    return spark.sql(text, **bases)


def with_ledgers(*names: str, sql: str) -> str:
    """DuckDB SQL with the named ledgers before it."""
    parts = []
    for name in names:
        text = LEDGERS.get(name) or SPLIT_LEDGERS[name][1]
        text = re.sub(r"embedding\[(\d)\]", lambda m: f"embedding[{int(m[1]) + 1}]", text)
        parts.append(f"{name} AS ({re.sub(r'[{](\w+)[}]', r'\1', text)})")
    head = "WITH RECURSIVE " + ", ".join(parts)
    body = sql.strip()
    return f"{head}, {body[5:]}" if body.upper().startswith("WITH ") else f"{head} {body}"
