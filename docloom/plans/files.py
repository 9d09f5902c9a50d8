"""Registered container, robots and file queries."""

from __future__ import annotations

import io
import zipfile
import zlib

import pandas as pd
from pyspark.sql import functions as F

from docloom.functions import identity as I
from docloom.functions.text import LEGACY, LETTERS, STRONG, legacy_fonts, recover_legacy
from docloom.operators import containers as K
from docloom.operators.pdf import pdf_pages
from docloom.plans.base import query
from docloom.session import place
from docloom.sources import archive, sinks
from docloom.sources.tables import ledger, table, with_ledgers


def _zipped():
    """A UDF that puts a text and a nested archive into one archive: input for the container scan."""

    @F.pandas_udf("binary")
    def run(name: pd.Series, text: pd.Series) -> pd.Series:
        def one(n, t):
            inner, outer = io.BytesIO(), io.BytesIO()
            with zipfile.ZipFile(inner, "w") as z:
                z.writestr("deep.txt", t[:50])
            with zipfile.ZipFile(outer, "w") as z:
                z.writestr(f"{n}.txt", t)
                z.writestr("__MACOSX/x.txt", "no")
                z.writestr("nested.zip", inner.getvalue())
            return outer.getvalue()

        return pd.Series([one(n, t) for n, t in zip(name, text)])

    return run


@query("SELECT doc_id, path, 'txt' AS kind, sha256(body) AS sha FROM (SELECT doc_id, source || '.txt' AS path, text AS body FROM documents UNION ALL SELECT doc_id, 'nested.zip!/deep.txt', left(text, 50) FROM documents) WHERE body <> ''")
def a11_i09_zip_members(spark, sf):
    @F.pandas_udf("array<struct<path:string,kind:string,sha:string>>")
    def scan(body: pd.Series) -> pd.Series:
        import hashlib

        return pd.Series([[{"path": p, "kind": k, "sha": hashlib.sha256(b).hexdigest()} for p, k, b in K.zip_members(x, 1 << 27)[0]] for x in body])

    d = table(spark, sf, "documents").where("text <> ''").select("doc_id", _zipped()("source", "text").alias("body"))
    return d.select("doc_id", F.explode(scan("body")).alias("m")).select("doc_id", "m.*")


@query("""SELECT n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN '## ' || replace(n_name, '_', '\\_') || chr(10) || chr(10) || 'Nation ' || n_nationkey || chr(10) || chr(10) || '| key | region |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n_nationkey || ' | ' || n_regionkey || ' |' || chr(10)
    ELSE '## ' || replace(n_name, '_', '\\_') || chr(10) || chr(10) || '| key | region |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n_nationkey || ' | ' || n_regionkey || ' |' || chr(10) END AS markdown FROM nation""")
def h20_office_markdown(spark, sf):
    """Word documents with a heading, a paragraph and a table, and workbooks with a titled sheet."""

    @F.pandas_udf("string")
    def run(key: pd.Series, name: pd.Series, region: pd.Series) -> pd.Series:
        return pd.Series([K.docx_markdown(_document(k, n, r)) if k % 2 == 0 else K.xlsx_markdown(_workbook(k, n, r)) for k, n, r in zip(key, name, region)])

    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), run("n_nationkey", "n_name", "n_regionkey").alias("markdown"))


def _pdf(text: str, lines: int = 50) -> bytes:
    """A PDF of a text, ``lines`` lines a page: deflated content in 16-bit codes of a font with a map to characters."""
    found = text.split("\n")
    pages = [found[i : i + lines] for i in range(0, len(found), lines)]
    cmap = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <FFFF> <0000> endbfrange"
    kids = b" ".join(b"%d 0 R" % (5 + 2 * i) for i in range(len(pages)))
    objects = [b"<</Type/Catalog/Pages 2 0 R>>", b"<</Type/Pages/Kids[" + kids + b"]/Count %d/Resources<</Font<</F1 3 0 R>>>>>>" % len(pages), b"<</Type/Font/Subtype/Type0/Encoding/Identity-H/ToUnicode 4 0 R>>", b"<</Length %d>>stream\n%s\nendstream" % (len(cmap), cmap)]
    for i, page in enumerate(pages):
        shown = b" T* ".join(b"<" + line.encode("utf-16-be").hex().encode() + b"> Tj" for line in page)
        body = zlib.compress(b"BT /F1 10 Tf 12 TL 72 720 Td " + shown + b" ET")
        objects += [b"<</Type/Page/Parent 2 0 R/Contents %d 0 R>>" % (6 + 2 * i), b"<</Length %d/Filter/FlateDecode>>stream\n%s\nendstream" % (len(body), body)]
    return b"%PDF-1.7\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i + 1, o) for i, o in enumerate(objects)) + b"trailer<</Root 1 0 R>>\n%%EOF"


@query("SELECT doc_id, CAST(ceil(len(string_split(text, chr(10))) / 50.0) AS INTEGER) AS pages, sha256(text) AS sha FROM documents WHERE text IS NOT NULL")
def h20_pdf_text(spark, sf):
    """All documents as PDF files of 50 lines a page, and the text that their pages show."""

    @F.pandas_udf("array<string>")
    def read(text: pd.Series) -> pd.Series:
        return pd.Series([pdf_pages(_pdf(t)) for t in text])

    d = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", read("text").alias("p"))
    return d.select("doc_id", F.size("p").alias("pages"), F.sha2(F.array_join("p", "\n"), 256).alias("sha"))


def _members(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def _document(key: int, name: str, region: int) -> bytes:
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    row = lambda cells: "<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{c}</w:t></w:r></w:p></w:tc>" for c in cells) + "</w:tr>"
    body = f'<w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>{name}</w:t></w:r></w:p><w:p><w:r><w:t>Nation </w:t></w:r><w:r><w:t>{key}</w:t></w:r></w:p><w:tbl>{row(["key", "region"])}{row([key, region])}</w:tbl>'
    return _members({"word/document.xml": f"<w:document {w}><w:body>{body}</w:body></w:document>"})


def _workbook(key: int, name: str, region: int) -> bytes:
    s, r = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sheet = f'<worksheet {s}><sheetData><row><c t="s"><v>0</v></c><c t="inlineStr"><is><t>region</t></is></c></row><row><c><v>{key}</v></c><c><v>{region}</v></c></row></sheetData></worksheet>'
    rels = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>'
    return _members({"xl/workbook.xml": f'<workbook {s} {r}><sheets><sheet name="{name}" sheetId="1" r:id="r1"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": rels, "xl/sharedStrings.xml": f"<sst {s}><si><t>key</t></si></sst>", "xl/worksheets/sheet1.xml": sheet})


KINDS = ["pdf", "docx", "xlsx", "zip", "doc", "xls", "rtf", "html", "xml", "json", "txt", "unknown"]


@query("SELECT page_id, [" + ", ".join(f"'{k}'" for k in KINDS) + "][page_id % 12 + 1] AS kind FROM pages")
def h17_detected_kinds(spark, sf):
    """The page's title inside a body of each kind, and the kind that its bytes tell; no hint says which."""
    ole = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
    makers = {
        "pdf": lambda t: b"%" + b"x" * 50 + b"\n" + _pdf(t),
        "docx": lambda t: _document(1, "n", 2),
        "xlsx": lambda t: _workbook(1, "n", 2),
        "zip": lambda t: _members({"a.txt": t}),
        "doc": lambda t: ole + t.encode() + "WordDocument".encode("utf-16-le"),
        "xls": lambda t: ole + t.encode() + "Workbook".encode("utf-16-le"),
        "rtf": lambda t: b"{\\rtf1 " + t.encode() + b"}",
        "html": lambda t: b"\xef\xbb\xbf <!-- " + t.encode() + b" -->\n<!DOCTYPE html><p>",
        "xml": lambda t: b"<?xml version='1.0'?><a>" + t.encode() + b"</a>",
        "json": lambda t: b' {"a": 1}',
        "txt": lambda t: b"- " + t.encode(),
        "unknown": lambda t: b"\x00\x01" + t.encode(),
    }

    @F.pandas_udf("string")
    def kind(page: pd.Series, title: pd.Series) -> pd.Series:
        return pd.Series([K.detect(makers[KINDS[p % 12]](t or "")) for p, t in zip(page, title)])

    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf, "pages").select("page_id", kind("page_id", title).alias("kind"))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE NOT (url LIKE '%/en/%' AND url NOT LIKE '%page=%') END AS allowed FROM pages")
def b09_robots(spark, sf):
    policy = "User-agent: *\nDisallow: /en/\nAllow: /en/*page=\n"

    @F.pandas_udf("boolean")
    def allowed(status: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([K.robots_allow(policy, int(s), p) for s, p in zip(status, path)], dtype=object)

    status = F.when(F.col("page_id") % 4 == 0, 404).when(F.col("page_id") % 4 == 1, 503).otherwise(200)
    return table(spark, sf, "pages").select("page_id", allowed(status, F.regexp_extract("url", "^https?://[^/]*(/.*)$", 1)).alias("allowed"))


@query("SELECT doc_id, sha256(text) AS sha, CASE WHEN doc_id % 2 = 0 THEN 'utf-8' ELSE 'utf-16-le' END AS charset FROM documents")
def h18_charset_decode(spark, sf):
    @F.pandas_udf("struct<text:string,charset:string>")
    def decode(body: pd.Series, charset: pd.Series) -> pd.DataFrame:
        out = []
        for b, c in zip(body, charset):
            for name in (c, "utf-8"):
                try:
                    out.append((b.decode(name), name))
                    break
                except (LookupError, UnicodeDecodeError, TypeError):
                    continue
            else:
                out.append((b.decode("utf-8", "replace"), "utf-8-replace"))
        return pd.DataFrame(out, columns=["text", "charset"])

    d = table(spark, sf, "documents")
    body = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "utf-8")).otherwise(F.encode("text", "utf-16le"))
    claim = F.when(F.col("doc_id") % 2 == 0, "no-such-charset").otherwise("utf-16-le")
    return d.select("doc_id", decode(body, claim).alias("d")).select("doc_id", F.sha2("d.text", 256).alias("sha"), "d.charset")


@query("SELECT n_nationkey AS id, '## ' || n_name || chr(10) || chr(10) || 'Nation ' || n_nationkey || ' of region ' || n_regionkey || '.' || chr(10) AS markdown FROM nation")
def h23_gazette_xml(spark, sf):
    from docloom.functions.text import mapped

    xml = F.concat(F.lit("<RULE><SUBJECT>"), F.col("n_name"), F.lit("</SUBJECT><PRTPAGE P='1'/><P>Nation <E>"), F.col("n_nationkey"), F.lit("</E> of region "), F.col("n_regionkey"), F.lit(".</P></RULE>"))
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), mapped(K.gazette_markdown)(F.encode(xml, "utf-8")).alias("markdown"))


@query(with_ledgers("acquisition", sql="SELECT run_id, count(*) AS receipts, sum(CASE WHEN state = 'archived' THEN 1 ELSE 0 END) AS archived FROM acquisition GROUP BY 1"))
def a14_receipts(spark, sf):
    a = ledger(spark, sf, "acquisition")
    counts = a.groupBy("run_id").agg(F.count(F.lit(1)).alias("receipts"), F.count_if(F.col("state") == "archived").alias("archived"))
    r = sinks.receipts(a.select("run_id").distinct(), counts)
    return r.select("run_id", "receipt.counts.receipts", "receipt.counts.archived")


@query("SELECT o_orderkey AS id, o_orderkey % 3 <> 0 AS frozen_equal FROM orders")
def i06_equal_but_for_keys(spark, sf):
    """Rows compared without the keys that may change."""
    o = table(spark, sf, "orders")
    old = F.struct(F.col("o_custkey"), F.col("o_orderstatus"))
    new = F.struct(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"), F.col("o_orderstatus"))
    return o.select(F.col("o_orderkey").alias("id"), (old == new).alias("frozen_equal"))


@query(with_ledgers("task_input", sql="""
    WITH o AS (SELECT target_id, list(request_id ORDER BY position) AS old FROM task_input GROUP BY 1)
    SELECT target_id, array_to_string(list_concat(old, list_filter([target_id + 1, target_id + 9], lambda x: NOT list_contains(old, x))), ',') AS inputs FROM o"""))
def j03_amend_inputs(spark, sf):
    """New inputs behind the old ones, each once, old positions kept."""
    i = ledger(spark, sf, "task_input").groupBy("target_id").agg(F.array_sort(F.collect_list(F.struct("position", "request_id"))).alias("s"))
    old = F.transform("s", lambda x: x["request_id"])
    new = F.array(F.col("target_id") + 1, F.col("target_id") + 9)
    merged = F.concat(old, F.filter(new, lambda x: ~F.array_contains(old, x)))
    return i.select("target_id", F.array_join(merged, ",").alias("inputs"))


@query(with_ledgers("version", sql="SELECT v.resource_id, v.id AS version_id, r.archive_ref FROM version v JOIN (SELECT md5(CAST(n AS VARCHAR)) AS archive_ref, n FROM (SELECT unnest(range(0, 500)) AS n)) r ON r.n = v.id % 700"))
def a10_reparse_inputs(spark, sf):
    """A10: the archived inputs of current versions, read again without a network."""
    cas = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("archive_ref"))
    wanted = ledger(spark, sf, "version").select("resource_id", F.col("id").alias("version_id"), F.md5((F.col("id") % 700).cast("string")).alias("archive_ref"))
    return wanted.join(cas, "archive_ref").select("resource_id", "version_id", "archive_ref")


#: Options that steer planning only and so stay out of fingerprints (fixed values of this library).
PLANNING = ["per_page", "max_pages", "budget"]


@query("""SELECT c_custkey, sha256('{"algorithm":"docloom.fingerprint.v1","kind":"options","value":{"nation":"' || c_nationkey || '","segment":' || CAST(to_json(c_mktsegment) AS VARCHAR) || '}}') AS options_hash,
    sha256('{"algorithm":"docloom.delivery-replay.v1","payload":{"segment":' || CAST(to_json(c_mktsegment) AS VARCHAR) || '},"target":"t' || c_custkey || '"}') AS replay_key FROM customer""")
def g09_g12_g13_option_hashes(spark, sf):
    """A hash of the options that matter, keys in order; G12: the key of a changed payload."""
    options = F.create_map(F.lit("segment"), I.scalar("c_mktsegment"), F.lit("per_page"), F.lit("50"), F.lit("nation"), I.scalar(F.col("c_nationkey").cast("string")), F.lit("budget"), F.lit("9"))
    kept = F.map_entries(F.map_filter(options, lambda k, _: ~k.isin(PLANNING)))
    pairs = F.array_sort(F.transform(kept, lambda e: F.concat(I.scalar(e["key"]), F.lit(":"), e["value"])))
    value = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    replay = I.replay_key(F.concat(F.lit("t"), F.col("c_custkey").cast("string")), I.members({"segment": I.scalar("c_mktsegment")}))
    return table(spark, sf, "customer").select("c_custkey", I.tagged("options", value).alias("options_hash"), replay.alias("replay_key"))


@query("SELECT conv_id, CASE role WHEN 'user' THEN 'issuer' WHEN 'assistant' THEN 'title' END AS field, min_by(text, turn) AS value FROM conversations WHERE role IN ('user', 'assistant') GROUP BY 1, 2")
def h11_label_fields(spark, sf):
    """Labels to fields by a dictionary; the first value of a field wins."""
    names = spark.createDataFrame([("user", "issuer"), ("assistant", "title")], "role string, field string")
    joined = table(spark, sf, "conversations").join(F.broadcast(names), "role")
    return joined.groupBy("conv_id", "field").agg(F.min(F.struct("turn", "text")).alias("m")).select("conv_id", "field", F.col("m.text").alias("value"))


@query("SELECT page_id, page_id % 3 = 0 AS legacy, CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS fonts FROM pages")
def h14_rtf_fonts(spark, sf):
    """Legacy fonts that an RTF head declares."""
    head = F.concat(F.lit("{\\rtf1{\\fonttbl{\\f0 Arial;}{\\f1 "), F.when(F.col("page_id") % 3 == 0, ".VnTime").otherwise("Times"), F.lit(";}}"))
    fonts = legacy_fonts(head)
    return table(spark, sf, "pages").select("page_id", (F.size(fonts) > 0).alias("legacy"), F.size(fonts).alias("fonts"))


@query("""SELECT doc_id, sha256(CASE WHEN doc_id % 2 = 0 THEN array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN regexp_matches(x, '[ĂăĐđĨĩŨũƠơƯưẠ-ỹ]') THEN x ELSE translate(x, '""" + LEGACY + "', '" + LETTERS + """') END), chr(10))
    WHEN length(text) - length(translate(text, '""" + STRONG + """', '')) >= 3 THEN array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN regexp_matches(x, '[ĂăĐđĨĩŨũƠơƯưẠ-ỹ]') THEN x ELSE translate(x, '""" + LEGACY + "', '" + LETTERS + """') END), chr(10)) ELSE text END) AS sha FROM documents""")
def h13_h14_recovery_by_fonts(spark, sf):
    """H13 with the evidence of H14: every second document declares a legacy font."""
    head = F.concat(F.lit("{\\rtf1{\\fonttbl{\\f0 "), F.when(F.col("doc_id") % 2 == 0, ".VnTimeH").otherwise("Arial"), F.lit(";}}"))
    return table(spark, sf, "documents").select("doc_id", F.sha2(recover_legacy(F.col("text"), F.size(legacy_fonts(head)) > 0), 256).alias("sha"))


@query(with_ledgers("task", sql="SELECT id, CASE error WHEN 'network_failed' THEN 'no connection' WHEN 'http_500' THEN 'server error' WHEN 'interrupted' THEN 'stopped' ELSE 'other: ' || error END AS detail FROM task WHERE error IS NOT NULL"))
def k09_failure_details(spark, sf):
    """K9: error codes to texts by a dictionary."""
    texts = spark.createDataFrame([("network_failed", "no connection"), ("http_500", "server error"), ("interrupted", "stopped")], "error string, text string")
    failed = ledger(spark, sf, "task").where("error IS NOT NULL")
    return failed.join(F.broadcast(texts), "error", "left").select("id", F.coalesce("text", F.concat(F.lit("other: "), F.col("error"))).alias("detail"))


@query("SELECT doc_id, doc_id % 3 = 0 AS valid FROM documents")
def l05_digest_predicate(spark, sf):
    sha = F.sha2("text", 256)
    value = F.when(F.col("doc_id") % 3 == 0, sha).when(F.col("doc_id") % 3 == 1, F.upper(F.concat(F.lit("A"), F.substring(sha, 2, 63)))).otherwise(F.substring(sha, 1, 63))
    return table(spark, sf, "documents").select("doc_id", value.rlike("^[0-9a-f]{64}$").alias("valid"))


@query("SELECT 'p' || user_id || '/' || CAST(floor(event_id / 500) AS BIGINT) AS request_url, CAST(row_number() OVER (PARTITION BY user_id, floor(event_id / 500) ORDER BY event_id) - 1 AS INTEGER) AS position, 'd' || event_id AS document_number, event_type AS type FROM events")
def a07_json_list(spark, sf):
    """List responses built from events, a page for each 500 ids of a user, read by the JSON list adapter."""
    from docloom.sources.adapters import adapter

    e = table(spark, sf, "events").withColumn("page", F.concat(F.lit("p"), F.col("user_id"), F.lit("/"), F.floor(F.col("event_id") / 500)))
    item = F.struct("event_id", F.struct(F.concat(F.lit("d"), F.col("event_id")).alias("document_number"), F.col("event_type").alias("type")).alias("r"))
    bodies = e.groupBy("page").agg(F.array_sort(F.collect_list(item)).alias("s")).select(F.col("page").alias("request_url"), F.to_json(F.struct(F.transform("s", lambda x: x["r"]).alias("results"))).alias("body"))
    return adapter("json_list").parse(bodies).select("request_url", "position", "document_number", "type")


@query(with_ledgers("delivery_row", sql="SELECT doc_id, md5(CAST(doc_id AS VARCHAR)) AS sha256, length(text) AS size FROM documents WHERE md5(CAST(doc_id AS VARCHAR)) IN (SELECT markdown_hash FROM delivery_row WHERE version_id % 2 = 0 UNION SELECT original_hash FROM delivery_row WHERE version_id % 2 = 0)"))
def a13_file_bodies(spark, sf):
    """The stored bodies that a closure (of the even versions) names, all at once."""
    from docloom.operators.snapshots import file_bodies

    stored = table(spark, sf, "documents").select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("sha256"), F.char_length("text").alias("size"))
    return file_bodies(stored, ledger(spark, sf, "delivery_row").where("version_id % 2 = 0"))


@query("SELECT sha256(text) AS sha256, octet_length(encode(text)) AS byte_size, min(doc_id % 2) = 1 AS stored FROM documents WHERE text IS NOT NULL GROUP BY 1, 2")
def a06_archive_put(spark, sf):
    """All documents are stored where those with even ids are already; each digest once."""
    d = table(spark, sf, "documents").select("doc_id", F.encode("text", "utf-8").alias("body"))
    held = archive.Archive(spark, place(spark, "archive"))
    held.put(d.where("doc_id % 2 = 0"))
    return held.put(d)


@query("""WITH held AS (SELECT DISTINCT sha256(text) AS sha FROM documents WHERE doc_id % 5 <> 0), r AS (SELECT doc_id, sha256(text) AS sha, octet_length(encode(text)) AS n, CASE WHEN doc_id % 7 = 0 THEN 'failed' ELSE 'archived' END AS state FROM documents WHERE text IS NOT NULL),
    e AS (SELECT r.*, CASE WHEN state <> 'archived' THEN 'input_not_archived' WHEN sha NOT IN (SELECT sha FROM held) THEN 'archive_body_missing' WHEN n > 8000 THEN 'archive_body_too_large' END AS error FROM r)
    SELECT doc_id, CASE WHEN error IS NULL THEN sha END AS sha, error FROM e""")
def l03_archived_inputs(spark, sf):
    """L3, A10: what an adapter may read of its inputs, where every seventh failed and every fifth was never stored."""
    d = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.encode("text", "utf-8").alias("body"))
    context = archive.Context(archive.Archive(spark, place(spark, "archive")))
    context.store(d.where("doc_id % 5 <> 0"))
    refs = d.select("doc_id", F.sha2("body", 256).alias("archive_ref"), F.when(F.col("doc_id") % 7 == 0, "failed").otherwise("archived").alias("state"))
    return context.archive.get(refs, 8000).select("doc_id", F.sha2("body", 256).alias("sha"), "error")


_CELLS = "chr(10) || chr(10) || '| key | region |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || c_custkey || ' | ' || c_nationkey || ' |'"


@query(f"""SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'docx' WHEN 1 THEN 'xlsx' WHEN 3 THEN 'zip' END AS kind,
    CASE c_custkey % 4 WHEN 0 THEN '## ' || c_name || chr(10) || chr(10) || 'Nation ' || c_custkey || {_CELLS} || chr(10) WHEN 1 THEN '## ' || c_name || {_CELLS} || chr(10)
        WHEN 3 THEN '## c' || c_custkey || chr(10) || chr(10) || '## ' || c_name || chr(10) || chr(10) || 'Nation ' || c_custkey || {_CELLS} || chr(10) END AS markdown,
    CASE WHEN c_custkey % 4 = 3 THEN 'in/c' || c_custkey || '.docx' WHEN c_custkey % 4 < 2 THEN '' END AS members, CASE WHEN c_custkey % 4 = 2 THEN 'unsupported_document_type' END AS error FROM customer""")
def l04_isolated_extraction(spark, sf):
    """L4: word documents, workbooks, archives of documents and unreadable bodies, read in processes of their own."""

    @F.pandas_udf("binary")
    def body(key: pd.Series, name: pd.Series, nation: pd.Series) -> pd.Series:
        makers = [_document, _workbook, lambda *_: b"\x00\x01", lambda k, n, r: _members({f"in/c{k}.docx": _document(k, n, r)})]
        return pd.Series([makers[k % 4](k, n, r) for k, n, r in zip(key, name, nation)])

    bodies = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), body("c_custkey", "c_name", "c_nationkey").alias("body"))
    return archive.extract(bodies).select("id", "kind", "markdown", F.array_join("members", ",").alias("members"), "error")
