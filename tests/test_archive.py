"""The archive, extraction in child processes, an adapter's context, integrity rules and catalog joins."""

from __future__ import annotations

import os

import pytest

from docloom.operators import integrity
from docloom.sources import archive as A


def test_bodies_are_stored_once_and_read_whole(spark, tmp_path):
    held = A.Archive(spark, f"file://{tmp_path}/cas")
    bodies = lambda *b: spark.createDataFrame([(x,) for x in b], "body binary")
    assert held.get(spark.createDataFrame([("00", "archived")], "archive_ref string, state string")).first().error == "archive_body_missing"
    first = held.put(bodies(b"one", b"one", None, b""))
    again = held.put(bodies(b"two", b"one"))
    assert sorted(r.stored for r in first.collect()) == [True, True]
    told = {r.sha256: r.stored for r in again.collect()}
    assert sorted(told.values()) == [False, True]
    assert held._stored().count() == 3
    assert held.put(bodies()).count() == 0


def test_reads_tell_why_there_is_no_body(spark, tmp_path):
    import hashlib

    held = A.Archive(spark, f"file://{tmp_path}/cas")
    held.put(spark.createDataFrame([(b"good",), (b"longer body",)], "body binary"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    spark.createDataFrame([(sha(b"bad"), 3, bytearray(b"BAD"), sha(b"bad")[:1])], A.Archive.schema).write.mode("append").partitionBy("folder").parquet(held.path)
    refs = [(1, sha(b"good"), "archived"), (2, sha(b"longer body"), "archived"), (3, sha(b"bad"), "archived"), (4, sha(b"good"), "failed"), (5, sha(b"none"), "archived"), (6, sha(b"good"), None), (7, None, "archived")]
    got = {r.id: (r.error, r.body) for r in held.get(spark.createDataFrame(refs, "id int, archive_ref string, state string"), 8).collect()}
    assert got[1] == (None, bytearray(b"good"))
    assert {i: e for i, (e, b) in got.items() if b is None} == {2: "archive_body_too_large", 3: "archive_body_corrupt", 4: "input_not_archived", 5: "archive_body_missing", 6: "input_not_archived", 7: "archive_body_missing"}


def test_extraction_equals_direct_reading(spark):
    import io
    import zipfile

    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("b.txt", "second * text")
        z.writestr("a.html", "<html><body><h1>T</h1><p>first</p></body></html>")
    cases = [b"plain\n\ntext", b"", b"   ", b"\x00\x01", b"<html><body><p>x</p></body></html>", b"{\\rtf1 rich}", packed.getvalue(), b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", b"PK\x03\x04broken", None]
    rows = spark.createDataFrame([(i, b, None) for i, b in enumerate(cases)] + [(90, None, "input_not_archived")], "id int, body binary, error string")
    got = {r.id: r for r in A.extract(rows).collect()}
    for i, b in enumerate(cases[:-1]):
        want = A.answer(b)
        assert (got[i].kind, got[i].markdown, got[i].members, got[i].error) == (want.get("kind"), want.get("markdown"), want.get("members"), want.get("error")), i
    assert got[6].members == ["a.html", "b.txt"] and got[6].markdown.startswith("## a\n\n# T") and "second \\* text" in got[6].markdown
    assert [got[i].error for i in (1, 2, 3, 7)] == ["extracted_text_empty", "extracted_text_empty", "unsupported_document_type", "unsupported_document_type"]
    assert got[9].error == "extraction_input_missing" and got[90].error == "input_not_archived"


def test_a_lost_child_is_one_rows_error():
    worker = A.Worker(20, 2 << 30, 1 << 20)
    try:
        assert worker(b"one", "")["markdown"] == "one\n"
        os.kill(worker.child.pid, 9)
        worker.child.wait()
        assert worker(b"two", "")["error"] == "child_process_failed"
        assert worker(b"three", "")["markdown"] == "three\n"
        worker.seconds = 0
        worker.close()
        assert worker(b"four", "")["error"] == "extraction_timeout"
        worker.seconds, worker.most_result = 20, 64
        assert worker(b"x" * 1000, "")["error"] == "extraction_result_too_large"
        assert worker(b"five", "")["markdown"] == "five\n"
    finally:
        worker.close()


def test_a_childs_memory_is_bounded(spark):
    rows = spark.createDataFrame([(1, b"<html><body>" + b"<p>x</p>" * 3_000_000 + b"</body></html>"), (2, b"small")], "id int, body binary").coalesce(1)
    got = {r.id: r.error for r in A.extract(rows, memory=400 << 20).select("id", "error").collect()}
    assert got[1] in ("extraction_memory_exceeded", "child_process_failed") and got[2] is None
    assert A.extract(rows, most_bytes=100).where("id = 1").first().error == "document_too_large"


def test_context(spark, tmp_path):
    context = A.Context(A.Archive(spark, f"file://{tmp_path}/cas"), "vi-VN", max_depth=2)
    refs = context.store(spark.createDataFrame([("tài liệu".encode(),)], "body binary"))
    from pyspark.sql import functions as F

    read = context.read(refs.select(F.col("sha256").alias("archive_ref"), F.lit("archived").alias("state")))
    judged = context.text_quality(context.extract(read.drop("byte_size")))
    assert [(r.markdown, r.route) for r in judged.collect()] == [("tài liệu\n", "accept")]
    tasks = spark.createDataFrame([(0,), (1,), (2,), (None,)], "depth int")
    assert sorted(r.depth for r in context.follow_links(tasks).collect()) == [0, 1]
    context.mode = "recheck"
    assert context.follow_links(tasks).count() == 0


def test_mutations_know_nulls(spark):
    before = spark.createDataFrame([(1, None, "x"), (2, "a", None), (3, "b", "y"), (4, "c", "z")], "id int, value string, seen string")
    after = spark.createDataFrame([(1, "", "x"), (2, "a", "later"), (4, "c", "z"), (5, "new", "n")], "id int, value string, seen string")
    got = {(r.key, r.why) for r in integrity.mutations(before, after, "id", ["seen"]).collect()}
    assert got == {("1", "changed"), ("3", "deleted")}
    assert integrity.mutations(before, before, "id").count() == 0


def test_snapshot_rules(spark):
    snapshots = spark.createDataFrame([("a", True, 2, 1), ("b", False, 0, 0), ("c", False, 1, 0), ("d", True, 1, 1)], "id string, sealed boolean, resource_count long, version_count long")
    items = spark.createDataFrame([("a", 1, 9), ("a", 2, 9), ("b", 1, 3), ("d", 1, 1), ("d", 2, 2)], "snapshot_id string, resource_id int, version_id int")
    assert {(r.key, r.why) for r in integrity.snapshot_counts(snapshots, items).collect()} == {("c", "counted_before_closing"), ("d", "counters_differ")}
    later = spark.createDataFrame([("a", 1, 8), ("b", 1, 4), ("d", 1, 1), ("d", 2, 2), ("d", 3, None)], "snapshot_id string, resource_id int, version_id int")
    assert {(r.key, r.why) for r in integrity.closed_mappings(items, later, snapshots).collect()} == {("a/1", "changed"), ("a/2", "deleted"), ("d/3", "inserted")}
    log = spark.createDataFrame([(1, None, "a"), (2, "a", "a"), (3, "a", "b"), (4, "b", "zz")], "sequence int, before string, after string")
    assert {(r.key, r.why) for r in integrity.publications(log, snapshots).collect()} == {("2", "unchanged"), ("3", "snapshot_not_sealed"), ("4", "snapshot_not_sealed")}


@pytest.mark.parametrize("prefix, names", [("old_", ["old_a", "old_a", "old_f"]), ("no", [])])
def test_leftovers_keep_both_kinds(spark, prefix, names):
    objects = spark.createDataFrame([("old_a",), ("x",), (None,)], "name string")
    routines = spark.createDataFrame([("old_f",), ("old_a",)], "name string")
    assert sorted(r.name for r in integrity.leftovers(objects, routines, prefix).collect()) == names


def _stream(head: bytes, body: bytes) -> bytes:
    return b"<<" + head + b"/Length %d>>stream\r\n%s\nendstream" % (len(body), body)


def _file(content: bytes, *more: bytes, trailer: bytes = b"") -> bytes:
    objects = [b"<</Type/Catalog/Pages 2 0 R>>", b"<</Type/Pages/Kids[3 0 R 2 0 R]>>", b"<</Type/Page/Contents[4 0 R]/Resources 5 0 R>>", _stream(b"", content), *more]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj %s endobj\n" % (i + 1, o) for i, o in enumerate(objects)) + b"trailer <</Root 1 0 R" + trailer + b">>"


FONTS = b"<</Font<</A 6 0 R/B 7 0 R>>/XObject<</X 8 0 R>>>>", b"<</Type/Font/Subtype/Type1/Encoding<</BaseEncoding/WinAnsiEncoding/Differences[65/uni0110/x]>>>>", b"<</Type/Font/Subtype/Type0>>", _stream(b"/Subtype/Form", b"BT /A 9 Tf 0 5 Td (form) Tj ET")


@pytest.mark.parametrize(
    "content, text",
    [
        (rb"BT /A 9 Tf 10 700 Td (one \(1\)) Tj 0 -12 Td (two\\ (nested)) Tj ET", "one (1)\ntwo\\ (nested)"),
        (b"BT /A 9 Tf 14 TL (a) Tj T* T* (b) Tj (c) ' 1 2 (d) \" ET", "a\n\nb\nc\nd"),
        (rb"BT /A 9 Tf [(wo) -20 (rd) -400 (next)] TJ 30 0 Td (same line) Tj ET", "word next same line"),
        (rb"BT /A 9 Tf 1 0 0 1 0 90 Tm <414243> Tj % a comment (not) Tj" + b"\n1 0 0 1 0 80 Tm (\\101\\351) Tj ET", "\u0110xC\n\u0110\u00e9"),
        (b"BT /B 9 Tf <00410042> Tj ET", "\ufffd\ufffd"),
        (b"q BI /W 1 /H 1 ID \x00(]] EI Q BT /A 9 Tf (after) Tj ET /X Do", "after\nform"),
        (b"BT /A 9 Tf (unfinished", ""),
        (b"", ""),
    ],
)
def test_pdf_text(content, text):
    from docloom.operators.pdf import pdf_pages

    assert pdf_pages(_file(content, *FONTS)) == [text]


def test_pdf_filters_packed_objects_and_refusals():
    import base64
    import zlib

    from docloom.operators.pdf import PdfError, pdf_pages

    shown = b"BT /A 9 Tf (text) Tj ET"
    more = [b"<</Font<</A 6 0 R>>>>", b"<</Type/Font/Subtype/Type1>>"]
    for head, body in ((b"/Filter/FlateDecode", zlib.compress(shown)), (b"/Filter[/ASCII85Decode/FlateDecode]", base64.a85encode(zlib.compress(shown)) + b"~>"), (b"/Filter/AHx", shown.hex().encode() + b">"), (b"/Filter/Fl/DecodeParms<</Predictor 12/Columns 23>>", zlib.compress(b"\x02" + shown))):
        later = b"\n4 0 obj " + _stream(head, body) + b" endobj"  # a later object replaces the first
        assert pdf_pages(_file(b"BT /A 9 Tf (old) Tj ET", *more) + later) == ["text"], head
    inside = [b"<</Type/Catalog/Pages 2 0 R>> ", b"<</Type/Pages/Kids [3 0 R]/Resources<</Font<</A 6 0 R>>>>>> ", b"<</Type/Page/Contents 4 0 R>>"]
    places = b" ".join(b"%d %d" % (i + 1, sum(map(len, inside[:i]))) for i in range(3)) + b" "
    packed = _stream(b"/Type/ObjStm/N 3/First %d/Filter/FlateDecode" % len(places), zlib.compress(places + b"".join(inside)))
    objects = b"%PDF-1.5 4 0 obj " + _stream(b"", shown) + b" endobj 9 0 obj " + packed + b" endobj"
    assert pdf_pages(objects) == ["text"]
    broken = _file(shown, *more).replace(b"/Length 23", b"/Length 9")
    assert pdf_pages(broken) == ["text"]
    for data, why in ((_file(shown, *more, trailer=b"/Encrypt 9 0 R"), "pdf_encrypted"), (b"no", "pdf_invalid"), (b"%PDF-1.4 nothing", "pdf_invalid"), (_file(b"", *more) + b"\n4 0 obj " + _stream(b"/Filter/LZWDecode", b"x") + b" endobj", "pdf_filter_unsupported")):
        with pytest.raises(PdfError, match=why):
            pdf_pages(data)
    assert A.answer(_file(shown, *more))["markdown"] == "text\n" and A.answer(b"%PDF-1.4 nothing")["error"] == "pdf_invalid"


def test_commands_on_archived_bodies(spark, tmp_path, capsys):
    from pyspark.sql import functions as F

    from docloom.cli import main

    held = A.Archive(spark, f"file://{tmp_path}/cas")
    body = b'{"results":[{"document_number":"7","title":" A  b ","type":"t"}],"next_page_url":null}'
    refs = held.put(spark.createDataFrame([(body,)], "body binary")).select(F.col("sha256").alias("archive_ref"), F.lit("archived").alias("state"), F.lit("https://a.org/x").alias("request_url"))
    refs.write.parquet(f"file://{tmp_path}/refs")
    place = lambda n: f"file://{tmp_path}/{n}"
    assert main(["reparse", held.path, place("refs"), place("rows"), "json_list", "--options", '{"max_pages": 2}']) == 0
    assert [(r.document_number, r.title, r.error) for r in spark.read.parquet(place("rows")).collect()] == [("7", "A b", None)]
    assert main(["reparse", held.path, place("refs"), place("no"), "json_list", "--options", "["]) == 1 and main(["reparse", held.path, place("refs"), place("no"), "none"]) == 1
    assert main(["extract", held.path, place("refs"), place("texts")]) == 0
    assert [r.error for r in spark.read.parquet(place("texts")).collect()] == ["unsupported_document_type"]
