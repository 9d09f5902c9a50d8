"""Registered quality gates, classes and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions.text import GARBLED
from docloom.operators import scoring as S
from docloom.plans.base import query
from docloom.sources.tables import ledger, table, with_ledgers


#: Bodies that some pages get in place of their own or before it, so that every class occurs.
_BODIES = """CASE page_id % 23 WHEN 1 THEN '%PDF-1.4 x' WHEN 2 THEN ' {"a":1}' WHEN 3 THEN '<script>var a="_waf_ab12"</script>' WHEN 4 THEN concat('<title>登录 - site</title>', html) WHEN 5 THEN '<script>go()</script><p>short</p>' WHEN 6 THEN '<p>x</p>'
    WHEN 7 THEN '<form><input name=q></form><p>a page that asks for a name and shows no more than these few words of text before it does</p>' WHEN 8 THEN concat('<p>访问过于频繁</p>', html) WHEN 9 THEN '<title>404 - 错误</title><p>nothing is here that anyone could read</p>' WHEN 10 THEN concat('<input type="password">', html) ELSE html END"""


@query(f"""SELECT page_id, CASE WHEN page_id % 17 = 0 THEN 'HTTP_ERROR' WHEN regexp_matches(html, '(?i)["'']_waf_[a-f0-9]+["'']') THEN 'ACCESS_RESTRICTED' WHEN html LIKE '\\%PDF%' ESCAPE '\\' THEN 'PDF' WHEN regexp_matches(html, '^\\s*[{{\\[]') THEN 'ACCESSIBLE_JSON'
        WHEN regexp_matches(title || ' ' || left(visible, 1200), '(?i){"|".join(S.CHALLENGES)}') THEN 'ACCESS_RESTRICTED' WHEN length(visible) < 3000 AND regexp_matches(title || ' ' || visible, '(?i){"|".join(S.ERRORS)}') THEN 'SOFT_ERROR'
        WHEN regexp_matches(html, '(?i)type=["'']?password') OR regexp_matches(title, '(?i)^.{{0,10}}(?:登录|login|sign in).{{0,20}}$') THEN 'SKIP_INPUT' WHEN length(visible) < 80 AND (contains(html, '<script') OR contains(lower(html), 'javascript')) THEN 'JS_SHELL'
        WHEN length(visible) < 40 THEN 'EMPTY' WHEN contains(html, '<input') AND length(visible) < 2500 AND len(regexp_extract_all(html, '<a ')) < 15 THEN 'SKIP_INPUT' ELSE 'ACCESSIBLE_HTML' END AS class
    FROM (SELECT page_id, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>', '', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS visible
        FROM (SELECT page_id, {_BODIES} AS html FROM pages))""")
def k01_page_class(spark, sf):
    """All pages, some with bodies of other classes."""
    p = table(spark, sf, "pages").withColumn("html", F.expr(_BODIES)).withColumn("title", F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    visible = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("html", "(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>", ""), "<[^>]*>", " "), r"\s+", " "))
    p = p.withColumn("visible", visible)
    scripts, inputs, links = F.regexp_count("html", F.lit("<script")), F.regexp_count("html", F.lit("<input")), F.regexp_count("html", F.lit("<a "))
    status = F.when(F.col("page_id") % 17 == 0, 500).otherwise(200)
    return p.select("page_id", S.page_class(F.col("title"), F.col("visible"), scripts, inputs, links, status, F.col("html")).alias("class"))


_PAGES = "SELECT doc_id AS document_id, n AS page, (doc_id * 7 + n * 31) % 400 AS native_text_chars, (doc_id * 13 + n * 5) % 30 / 1000.0 AS ink_ratio FROM documents, (SELECT unnest(range(1, 4)) AS n)"


#: Texts of blocks with marks that only the Vietnamese rules look for.
_MARKED = "CASE document_id % 6 WHEN 0 THEN concat(text, 'µ©§µ') WHEN 1 THEN concat(text, repeat('漢', 12)) WHEN 2 THEN concat('āēī', text) WHEN 3 THEN concat(text, ' Nơi nhận') WHEN 4 THEN concat(text, ' nơi nhận TM. x') ELSE text END"


def _gate_sql(vietnamese: bool) -> str:
    count = lambda expr: f"coalesce(sum({expr}) FILTER (texty), 0)"
    more = f""", {count(f"length(text) - length(translate(text, '{GARBLED}', ''))")} AS garbled, {count("len(regexp_extract_all(text, '[㐀-鿿豈-﫿]'))")} AS cjk, {count(f"length(text) - length(translate(text, '{S.FOREIGN}', ''))")} AS odd,
        coalesce(bool_or(regexp_matches(upper(text), 'NƠI NHẬN|NOI NHAN')) FILTER (texty), false) AS recipient, coalesce(bool_or(regexp_matches(upper(text), '{S.SIGNATURES}')) FILTER (texty), false) AS signed"""
    early = "CASE WHEN garbled >= 4 THEN 'legacy_vietnamese_font_garbled' END, CASE WHEN cjk >= 12 AND cjk / greatest(ocr, 1) >= 0.02 THEN 'non_vietnamese_garbage' END, CASE WHEN odd >= 3 THEN 'foreign_diacritic_garbage' END,"
    late = "CASE WHEN recipient AND NOT signed THEN 'signature_block_missing' END,"
    return with_ledgers("block", sql=f"""
    WITH b AS (SELECT *, page_idx + CASE WHEN min(page_idx) OVER (PARTITION BY document_id) = 0 THEN 1 ELSE 0 END AS page, type IN ('text', 'header', 'list', 'table') AS texty FROM (SELECT document_id, block_no, page_idx, type, {_MARKED if vietnamese else 'text'} AS text, y0 / 100.0 AS y0 FROM block)),
    r AS (SELECT *, CASE WHEN texty AND trim(text) <> '' THEN CAST(CAST(y0 AS DOUBLE) + 0.08 < lag(CAST(y0 AS DOUBLE)) OVER (PARTITION BY document_id, page, texty AND trim(text) <> '' ORDER BY block_no) AS INTEGER) END AS back FROM b),
    m AS (SELECT document_id, page, coalesce(sum(length(text)) FILTER (texty), 0) + greatest(count(*) FILTER (texty) - 1, 0) AS ocr, count(*) FILTER (type = 'table') AS tables, coalesce(sum(length(trim(text))) FILTER (type = 'table'), 0) AS table_chars,
        count(*) FILTER (type = 'table' AND length(trim(text)) >= 120) AS flat, count(*) FILTER (texty AND trim(text) <> '') AS positions, coalesce(sum(back), 0) AS reversals {more if vietnamese else ''} FROM r GROUP BY 1, 2),
    u AS (SELECT document_id, min(page_idx) NOT IN (0, 1) OR max(page) > 3 AS unreliable FROM b GROUP BY 1),
    p AS ({_PAGES}), j AS (SELECT p.*, u.unreliable, coalesce(m.ocr, 0) AS ocr, coalesce(m.tables, 0) AS tables, coalesce(m.table_chars, 0) AS table_chars, coalesce(m.flat, 0) AS flat, coalesce(m.positions, 0) AS positions, coalesce(m.reversals, 0) AS reversals,
        {'coalesce(m.garbled, 0) AS garbled, coalesce(m.cjk, 0) AS cjk, coalesce(m.odd, 0) AS odd, coalesce(m.recipient, false) AS recipient, coalesce(m.signed, false) AS signed,' if vietnamese else ''}
        native_text_chars < 30 AND ink_ratio > 0.003 AS scan, ink_ratio < 0.012 AND native_text_chars < 20 AND coalesce(m.ocr, 0) < 20 AS blank FROM p LEFT JOIN m ON m.document_id = p.document_id AND m.page = p.page LEFT JOIN u ON u.document_id = p.document_id)
    SELECT document_id, page, array_to_string(list_filter([CASE WHEN scan AND ocr < 30 AND NOT blank THEN 'scan_page_with_little_ocr_text' END, CASE WHEN blank THEN 'low_ink_blank_page_candidate' WHEN ink_ratio >= 0.006 AND ocr < 20 THEN 'nonblank_page_without_ocr_text' END,
        CASE WHEN native_text_chars >= 180 AND ocr < greatest(30, floor(native_text_chars * 0.15)) THEN 'native_text_page_with_little_ocr_text' END, CASE WHEN ink_ratio < 0.0015 AND ocr > 50 THEN 'blank_page_with_spurious_text' END, {early if vietnamese else ''}
        CASE WHEN tables > 0 AND table_chars < 20 THEN 'table_content_missing' END, CASE WHEN flat > 0 THEN 'table_structure_missing' END, CASE WHEN positions >= 8 AND reversals >= 3 THEN 'reading_order_unstable' END, {late if vietnamese else ''}
        CASE WHEN page = 1 AND unreliable AND ocr < 20 THEN 'page_1_blocks_missing_with_unreliable_mapping' END], lambda x: x IS NOT NULL), ',') AS reasons FROM j""")


@query(_gate_sql(False))
def k02_page_gate(spark, sf):
    return _gated(spark, sf).select("document_id", "page", F.array_join("reasons", ",").alias("reasons"))


@query(_gate_sql(True))
def k02_page_gate_vietnamese(spark, sf):
    """The reasons that only Vietnamese documents have, too."""
    return _gated(spark, sf, vietnamese=True).select("document_id", "page", F.array_join("reasons", ",").alias("reasons"))


def _expected(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"))).alias("page"))
    d = d.withColumn("native_text_chars", (F.col("document_id") * 7 + F.col("page") * 31) % 400).withColumn("ink_ratio", ((F.col("document_id") * 13 + F.col("page") * 5) % 30) / 1000.0)
    return d.withColumn("suspected_scan", (F.col("native_text_chars") < 30) & (F.col("ink_ratio") > 0.003))


def _document_reasons(spark, sf):
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), "text")
    return S.document_reasons(ledger(spark, sf, "block"), texts, _expected(spark, sf))


def _gated(spark, sf, vietnamese: bool = False):
    blocks = ledger(spark, sf, "block").withColumn("y0", F.col("y0") / 100.0)
    if vietnamese:
        blocks = blocks.withColumn("text", F.expr(_MARKED))
    m = S.page_measures(blocks, vietnamese)
    pages = _expected(spark, sf).join(m, ["document_id", "page"], "left").na.fill(0)
    return S.page_gate(pages.join(_document_reasons(spark, sf), "document_id", "left"), vietnamese)


_WARN = "('low_ink_blank_page_candidate', 'isolated_replacement_character', 'signature_block_missing', 'reading_order_unstable')"


@query(f"""SELECT document_id, CASE WHEN max(own) > 0 THEN 'legacy_font_encoding_recovery' WHEN max(hard) > 0 THEN 'vision_reparse_pages' WHEN max(n) > 0 THEN 'accept_with_warning' ELSE 'accept_ocr' END AS route, CAST(sum(n) + max(own) AS BIGINT) AS reason_count
    FROM (SELECT g.document_id, CASE WHEN k.unreliable THEN 1 ELSE 0 END AS own, len(list_filter(string_split(reasons, ','), lambda x: x <> '')) AS n, len(list_filter(string_split(reasons, ','), lambda x: x <> '' AND x NOT IN {_WARN})) AS hard
        FROM ({_gate_sql(False)}) g JOIN ({with_ledgers("block", sql="SELECT document_id, min(page_idx) NOT IN (0, 1) OR max(page_idx) + CASE WHEN min(page_idx) = 0 THEN 1 ELSE 0 END > 3 AS unreliable FROM block GROUP BY 1")}) k ON k.document_id = g.document_id) GROUP BY 1""")
def k03_document_route(spark, sf):
    """Routes of documents from their pages and from what the whole document says."""
    return S.document_route(_gated(spark, sf), _document_reasons(spark, sf))


@query(f"""SELECT doc_id, CASE WHEN g >= 8 AND g / greatest(length(text), 1) >= 0.002 THEN 'legacy_font_encoding_recovery' WHEN r >= 3 THEN 'vision_reparse_pages' WHEN r > 0 THEN 'accept_with_warning' ELSE 'accept' END AS route, CAST(g AS BIGINT) AS garbled
    FROM (SELECT *, length(text) - length(translate(text, '{GARBLED}', '')) AS g, length(text) - length(replace(text, chr(65533), '')) AS r FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text || repeat('µ©§', 3) WHEN 1 THEN text || chr(65533) WHEN 2 THEN repeat(chr(65533), 3) || text ELSE text END AS text FROM documents))""")
def k04_text_check(spark, sf):
    t = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.repeat(F.lit("µ©§"), 3))).when(F.col("doc_id") % 5 == 1, F.concat("text", F.lit("�"))).when(F.col("doc_id") % 5 == 2, F.concat(F.lit("���"), "text")).otherwise(F.col("text"))
    return S.text_check(table(spark, sf, "documents").select("doc_id", t.alias("text")), vietnamese=True).select("doc_id", "route", "garbled")


@query(with_ledgers("block", sql="SELECT document_id, count(DISTINCT page_idx) AS pages, min(page_idx) = 0 AS zero_based, min(page_idx) NOT IN (0, 1) OR max(page_idx) + CASE WHEN min(page_idx) = 0 THEN 1 ELSE 0 END > 3 AS unreliable FROM block GROUP BY 1"))
def k05_page_index(spark, sf):
    low, high = F.min("page_idx"), F.max("page_idx")
    return ledger(spark, sf, "block").groupBy("document_id").agg(F.count_distinct("page_idx").alias("pages"), (low == 0).alias("zero_based"), (~low.isin(0, 1) | (high + (low == 0).cast("int") > 3)).alias("unreliable"))


_SHOWN = """CASE p_partkey % 7 WHEN 0 THEN 'ACCESSIBLE_PDF' WHEN 1 THEN 'JS_SHELL' WHEN 2 THEN 'SKIP_INPUT' WHEN 3 THEN 'HTTP_ERROR' WHEN 4 THEN 'ACCESSIBLE_JSON' ELSE 'ACCESSIBLE_HTML' END"""


@query(f"""SELECT p_partkey AS id, CASE WHEN p_partkey % 31 = 0 THEN 'C' WHEN p_partkey % 29 = 0 THEN 'X' WHEN outcome NOT IN ('ACCESSIBLE_HTML', 'ACCESSIBLE_PDF', 'ACCESSIBLE_JSON', 'SKIP_INPUT', 'JS_SHELL') THEN 'F'
        WHEN outcome = 'ACCESSIBLE_PDF' OR p_size % 5 = 0 OR (p_size % 3 = 0 AND p_size % 2 = 0) THEN 'A' WHEN outcome = 'JS_SHELL' OR p_size % 4 > 2 OR p_size % 11 = 0 THEN 'E' WHEN outcome = 'SKIP_INPUT' THEN 'D' WHEN p_size % 2 = 1 THEN 'B' ELSE 'G' END AS class
    FROM (SELECT *, {_SHOWN} AS outcome FROM part)""")
def k08_source_class(spark, sf):
    """Classes from evidence derived from parts; some sources have a reviewed class."""
    size, key = F.col("p_size"), F.col("p_partkey")
    evidence = {
        "noise": key % 29 == 0, "outcome": F.col("outcome"), "article_blocks": F.when(size % 5 == 0, 1).otherwise(0),
        "detail_outcome": F.when(size % 3 == 0, F.lit("ACCESSIBLE_HTML")).otherwise("UNKNOWN"), "detail_blocks": F.when(size % 2 == 0, 2).otherwise(0),
        "templates": size % 4, "iframes": F.when(size % 11 == 0, 1).otherwise(0), "candidates": size % 2, "override": F.when(key % 31 == 0, "C"),
    }
    return table(spark, sf, "part").withColumn("outcome", F.expr(_SHOWN)).select(key.alias("id"), S.source_class(evidence).alias("class"))


@query(with_ledgers("receipt", sql="""
    WITH p AS (SELECT engine, language, dpi, page_id, median(total_seconds) AS m, count(DISTINCT repetition) AS n, bool_and(status = 'ok') AS ok, max((repetition, errors, reference_characters)) AS s FROM receipt GROUP BY 1, 2, 3, 4)
    SELECT engine, language, dpi, round(sum(m), 4) AS seconds, CASE WHEN bool_and(ok) THEN round(sum(s[2]) / sum(s[3]), 8) END AS cer, min(n) AS minimum_repeats, bool_and(ok) AS eligible,
        CASE WHEN bool_and(ok) AND min(n) >= 3 THEN 'replicated' WHEN bool_and(ok) THEN 'screened' ELSE 'failed' END AS stage FROM p GROUP BY 1, 2, 3"""))
def k11_d14_d15_recognition_scores(spark, sf):
    return S.repeat_scores(ledger(spark, sf, "receipt"), 3)


@query(with_ledgers("receipt", sql="SELECT engine, language, page_id, count(DISTINCT output_sha) AS outputs, count(DISTINCT output_sha) = 1 AS steady FROM receipt GROUP BY 1, 2, 3"))
def k12_repeat_determinism(spark, sf):
    n = F.count_distinct("output_sha")
    return ledger(spark, sf, "receipt").groupBy("engine", "language", "page_id").agg(n.alias("outputs"), (n == 1).alias("steady"))


@query("SELECT d.doc_id, sha256(d.text) <> sha256(CASE WHEN d.doc_id % 6 = 0 THEN d.text || ' ' ELSE d.text END) AS drifted FROM documents d")
def k13_output_drift(spark, sf):
    d = table(spark, sf, "documents")
    frozen = d.select("doc_id", F.sha2(F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text")), 256).alias("sha"))
    return d.select("doc_id", F.sha2("text", 256).alias("now")).join(frozen, "doc_id").select("doc_id", (F.col("now") != F.col("sha")).alias("drifted"))


@query(with_ledgers("block", sql="SELECT document_id, CASE WHEN n = 0 THEN 'native' WHEN n < pages THEN 'hybrid' ELSE 'full' END AS pipeline FROM (SELECT doc_id AS document_id, count(*) AS pages, count(*) FILTER ((doc_id * 7 + p * 31) % 400 < 30 AND (doc_id * 13 + p * 5) % 30 > 3) AS n FROM documents, (SELECT unnest(range(1, 4)) AS p) GROUP BY 1)"))
def j20_k07_ocr_pipeline(spark, sf):
    pages = _gated(spark, sf)
    n = F.count_if(F.col("suspected_scan"))
    return pages.groupBy("document_id").agg(F.when(n == 0, "native").when(n < F.count(F.lit(1)), "hybrid").otherwise("full").alias("pipeline"))


def _neighbours(spark, sf):
    """Each benchmark passage with the next one's text."""
    a = table(spark, sf, "benchmark").select("item_id", "text")
    return a.join(a.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other")), "item_id")


# DuckDB's distance is one of bytes: letters of two bytes stand as control characters there.
_LETTERS = "àáäçèéêíñóöùúüßÀÁÄÇÈÉÊÍÑÓÖÚÜ"
_BYTES = " || ".join(f"chr({c})" for c in [*range(1, 9), 11, 12, *range(14, 32)])


@query(f"WITH t AS (SELECT item_id, translate(text, '{_LETTERS}', {_BYTES}) AS text FROM benchmark) SELECT a.item_id, CAST(levenshtein(a.text, b.text) AS INTEGER) AS distance FROM t a JOIN t b ON b.item_id = a.item_id + 1")
def h28_levenshtein(spark, sf):
    """Whole benchmark passages."""
    return _neighbours(spark, sf).select("item_id", F.levenshtein("text", "other").alias("distance"))


@query()
def h27_semi_global_alignment(spark, sf):
    """Whole benchmark passages against the whole documents that share their number."""
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("reference"))
    d = table(spark, sf, "documents").select("doc_id", "text")
    return b.join(d, "doc_id").select("doc_id", S.align_udf()("reference", "text").alias("a")).select("doc_id", "a.*")


@query()
def h26_edit_script(spark, sf):
    """Whole benchmark passages."""
    return _neighbours(spark, sf).select("item_id", F.explode(S.edit_script_udf()("text", "other")).alias("e")).select("item_id", "e.*")


@query()
def c17_mapped_spans(spark, sf):
    """C17: the middle third of each passage, mapped into the next one's text by their alignment."""
    n = F.char_length("text")
    p = _neighbours(spark, sf).withColumn("first", F.floor(n / 3).cast("int")).withColumn("last", F.floor(n * 2 / 3).cast("int"))
    return p.select("item_id", S.mapped_span_udf()("text", "other", "first", "last").alias("m")).select("item_id", "m.*")
