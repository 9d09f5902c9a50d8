"""Snapshots, publications, pages, configurations and sinks."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from docloom.operators import snapshots as S
from docloom.sources import config as C
from docloom.sources import sinks

GOOD = {"id": "dd-001", "entry_urls": ["https://a.org/x", "https://a.org/x"], "allowed_hosts": ["a.org"], "scope": "tests only", "archive_approved": True}


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('snapshots')}"
    resources = spark.createDataFrame([(i, i % 3, i * 10) for i in range(12)], "id long, source_id long, current_version_id long")
    versions = spark.createDataFrame([(i * 10, i) for i in range(12)] + [(7, 2), (8, 99)], "id long, resource_id long")
    overrides = spark.createDataFrame([(2, 7), (3, 8)], "resource_id long, version_id long")
    rows = spark.createDataFrame([(v, n, f"t{v}", f"m{v}{n}", None if n else f"o{v}") for v in [*range(0, 120, 10), 7, 8] for n in range(2)], "version_id long, row_number long, title string, markdown_hash string, original_hash string")
    for name in ("a", "b"):
        S.create(f"{root}/{name}", resources, overrides, versions, rows)
    assert S.publish(spark, f"{root}/log", "a", f"{root}/a") and not S.publish(spark, f"{root}/log", "a", f"{root}/a")
    return root


def test_counters(spark, published):
    told = spark.read.parquet(f"{published}/a/counters").first()
    assert (told.sources, told.resources, told.versions, told.rows) == (3, 11, 11, 22)  # 3's override is another's version
    assert S.verify(spark, f"{published}/a")
    with pytest.raises(C.ConfigError, match="snapshot_is_closed"):
        S.create(f"{published}/a", *[spark.range(0)] * 4)
    assert 7 in {r.version_id for r in spark.read.parquet(f"{published}/a/items").collect()}


def test_pages_stay_on_their_snapshot(spark, published):
    log, seen, cursor = f"{published}/log", [], None
    first = S.page(spark, published, log, "me", None, 5)
    assert S.publish(spark, log, "b", f"{published}/b") and S.published(spark, log) == "b"
    while True:
        got = S.page(spark, published, log, "me", None, 5, cursor) if cursor else first
        assert got["snapshot_id"] == "a"
        seen += [(r["source_id"], r["resource_id"], r["row_number"]) for r in got["items"]]
        cursor = got["next_cursor"]
        if not cursor:
            break
    assert seen == sorted(set(seen)) and len(seen) == 22
    with pytest.raises(C.ConfigError, match="invalid_cursor"):
        S.page(spark, published, log, "you", None, 5, first["next_cursor"])
    with pytest.raises(C.ConfigError, match="invalid_arguments"):
        S.page(spark, published, log, "me", None, 0)
    assert {r["source_id"] for r in S.page(spark, published, log, "me", [1], 100)["items"]} == {1}


def test_changed_tables_do_not_verify(spark, published, tmp_path):
    import shutil

    root = published.removeprefix("file://")
    shutil.copytree(f"{root}/a", tmp_path / "a")
    rows = spark.read.parquet(f"{root}/a/rows")
    changed = rows.withColumn("title", F.when(F.col("row_number") == 1, "other").otherwise(F.col("title")))  # all counts stay
    changed.write.mode("overwrite").parquet(str(tmp_path / "a/rows"))
    assert not S.verify(spark, str(tmp_path / "a")) and S.verify(spark, f"{published}/a")
    with pytest.raises(C.ConfigError, match="snapshot_not_verified"):
        S.publish(spark, str(tmp_path / "log"), "a", str(tmp_path / "a"))


def test_closure_bodies_must_be_there(spark, tmp_path):
    import hashlib

    sha = lambda x: hashlib.sha256(x).hexdigest()
    resources = spark.createDataFrame([(1, 1, 10)], "id long, source_id long, current_version_id long")
    versions = spark.createDataFrame([(10, 1)], "id long, resource_id long")
    rows = spark.createDataFrame([(10, 0, "t", sha(b"m"), sha(b"o"))], "version_id long, row_number long, title string, markdown_hash string, original_hash string")
    S.create(f"{tmp_path}/s", resources, spark.createDataFrame([], "resource_id long, version_id long"), versions, rows)
    bodies = lambda *b: spark.createDataFrame([(sha(k), bytearray(v)) for k, v in b], "sha256 string, body binary")
    assert S.verify(spark, f"{tmp_path}/s", bodies((b"m", b"m"), (b"o", b"o")))
    assert not S.verify(spark, f"{tmp_path}/s", bodies((b"m", b"m"))) and not S.verify(spark, f"{tmp_path}/s", bodies((b"m", b"m"), (b"o", b"x")))


def test_cursors_have_a_proof_and_a_life_time():
    now = [100.0]
    c = S.Cursors(b"secret", 60, clock=lambda: now[0])
    cursor = c.issue({"snapshot": "a", "after": [1, 2]})
    assert c.read(cursor)["after"] == [1, 2]
    for forged in (cursor[:-6] + "AAAAAA", "", "x", S.Cursors(b"other", 60, clock=lambda: now[0]).issue({"snapshot": "a"})):
        with pytest.raises(C.ConfigError, match="invalid_cursor"):
            c.read(forged)
    now[0] = 161.0
    with pytest.raises(C.ConfigError, match="expired_cursor"):
        c.read(cursor)


def test_configurations(tmp_path):
    assert C.parse(GOOD).entry_urls == ["https://a.org/x"]
    for change, code in [({"id": "x"}, "invalid_source_id"), ({"archive_approved": False}, "source_archive_approval_required"), ({"entry_urls": ["https://b.org/"]}, "source_out_of_scope"), ({"nope": 1}, "unknown_config_key"), ({"blocked_patterns": ["("]}, "invalid_regex"), ({"allowed_path_prefixes": ["/a/../b"]}, "invalid_path_scope"), ({"budget": {"requests": 0}}, "invalid_budget"), ({"fields": {"t": {}}}, "field_rule_needs_one_source"), ({"host_path_scopes": {"b.org": ["/"]}}, "invalid_host_path_scope")]:
        with pytest.raises(C.ConfigError, match=code):
            C.parse({**GOOD, **change})
    path = tmp_path / "c.yaml"
    path.write_text("id: dd-001\nid: dd-002\n")
    with pytest.raises(C.ConfigError, match="duplicate_config_key"):
        C.load(str(path))
    path.write_text(json.dumps(GOOD))
    assert C.load(str(path)).id == "dd-001"


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, ["a", 'b"'], None)], "id long, l array<string>, n string")
    sinks.write_csv(d, f"file://{tmp_path}/csv")
    assert spark.read.option("header", True).option("escape", '"').csv(f"file://{tmp_path}/csv").first().l == '["a","b\\""]'
    sinks.write_json(d, f"file://{tmp_path}/json")
    assert json.loads(spark.read.text(f"file://{tmp_path}/json").first()[0]) == {"id": 1, "l": ["a", 'b"'], "n": None}
    names = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    (tmp_path / "w.tsv").write_text(f'{names}\n4\t1\t1\t1\t1\t0\t0\t0\t9\t9\t-1\t\n5\t1\t1\t1\t1\t1\t2\t3\t4\t5\t9.5\t"q\n')
    assert [tuple(r) for r in sinks.read_words(spark, f"file://{tmp_path}/w.tsv").collect()] == [('"q', 2, 3, 6, 8)]
    (tmp_path / "i.md").write_text("## One\n| a | b |\n| --- | --- |\n| 1 | 2 |\n## Two\n| 3 | 4 |\n")
    assert [(r.section, r.cells) for r in sinks.read_inventory(spark, f"file://{tmp_path}/i.md").orderBy("line").collect()] == [("One", ["a", "b"]), ("One", ["1", "2"]), ("Two", ["3", "4"])]
    spark.range(3).createOrReplaceTempView("docloom_view")
    assert sinks.catalog(spark).where(F.col("name") == "docloom_view").count() == 1


def test_adapters(spark):
    from docloom.sources.adapters import adapter

    body = '{"results":[{"document_number":"1","title":"t","type":"Rule"}],"next_page_url":"https://a.org/2"}'
    d = spark.createDataFrame([("https://a.org/1", body)], "request_url string, body string")
    a = adapter("json_list", max_pages=2)
    assert [(r.locator, r.document_number) for r in a.parse(d).collect()] == [("/results/0", "1")]
    assert [r.request_url for r in a.next_requests(d, 0).collect()] == ["https://a.org/2"] and not a.next_requests(d, 1).collect()
    h = spark.createDataFrame([("https://a.org/", '<a href="/doc/7">Seven</a><a href="/list?2">Next</a><a href="https://b.org/x">Out</a>')], "request_url string, body string")
    b = adapter("html_list", detail="/doc/[0-9]+$")
    assert [(r.locator, r.title) for r in b.parse(h).collect()] == [("https://a.org/doc/7", "Seven")]
    assert [r.request_url for r in b.next_requests(h, 0).collect()] == ["https://a.org/list?2"]
    for name, options, code in [("nope", {}, "unknown_adapter"), ("json_list", {"x": 1}, "invalid_adapter_options")]:
        with pytest.raises(C.ConfigError, match=code):
            adapter(name, **options)


def test_postback_adapter_and_rechecks(spark):
    from docloom.sources.adapters import adapter

    page = "<form method=post action='l.aspx'><input name=v value=1><table><tr><td><a href='d?docid=7'>x</a></td></tr><tr><td><span>3</span><a href=\"javascript:__doPostBack('g','Page$4')\">4</a></td></tr></table></form>"
    a = adapter("postback_list")
    r = spark.createDataFrame([("https://h.org/a/", page), ("https://h.org/b/", "<p>")], "request_url string, body string")
    assert [tuple(x) for x in a.parse(r).collect()] == [("https://h.org/a/", 0, "https://h.org/a/d?docid=7", "7")]
    assert [(x.request_url, x.form, x.number) for x in a.next_requests(r, 0).collect()] == [("https://h.org/a/l.aspx", {"v": "1", "__EVENTTARGET": "g", "__EVENTARGUMENT": "Page$4"}, 4)]
    due = spark.createDataFrame([("n", "k", "https://h.org/1", "https://h.org/1?r"), ("n", "m", "https://h.org/2", None)], "namespace string, external_key string, public_url string, recheck_url string")
    assert [(x.identity.external_key, x.request_url, x.role, x.error) for x in a.plan_recheck(due).collect()] == [("k", "https://h.org/1?r", "detail", None), ("m", None, "detail", "recheck_locator_unsupported")]
    rows = spark.createDataFrame([("u", 0, "l", " a  b "), ("u", 1, "l", "x" * 4001), ("u", 2, "l", "")], "request_url string, position int, locator string, title string")
    assert [(x.title, x.error) for x in a.build(rows).orderBy("position").collect()] == [("a b", None), (None, "invalid_document_title"), (None, None)]
    for name, options in (("json_list", {"max_pages": "3"}), ("json_list", {"other": 1}), ("postback_list", {"x": 1}), ("html_list", {})):
        with pytest.raises(C.ConfigError, match="invalid_adapter_options"):
            adapter(name, **options)


def test_snapshots_are_listed_and_inspected(spark, published):
    assert S.snapshots(spark, published) == ["a", "b"] and S.snapshots(spark, f"{published}/none") == []
    told = S.inspect(spark, f"{published}/a")
    assert told["rows"] == 22 and told["verified"] is True and told["rows_low"]
    with pytest.raises(C.ConfigError, match="snapshot_not_closed"):
        S.inspect(spark, f"{published}/none")


def test_command_line(capsys, tmp_path):
    from docloom.cli import main

    path = tmp_path / "c.yaml"
    path.write_text(json.dumps({**GOOD, "id": "bad"}))
    assert main(["check-config", str(path)]) == 1 and main(["queries"]) == 0
    assert "j04_version_timeline" in capsys.readouterr().out
