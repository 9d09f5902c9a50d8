"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from docloom.plans import registry


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "NULL" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    got = registry.queries()[name](spark, sf)
    want = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.columns, [[str(v)[:19] if "time" in type(v).__name__ else v for v in r] for r in got.collect()]) == _rows(names, [[str(v)[:19] if "time" in type(v).__name__ else v for v in r] for r in want.fetchall()])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0


def test_field_rules_read_references_as_their_sql(spark, tmp_path):
    """Titles cut inside a reference, and references besides ``&amp;``, in headings and in titles of pages."""
    said = ["a &amp; b", "cut &amp", "cut &am", "cut &", "&quot;x&quot; &lt;y&gt; &#65; &copy", "&amp;quot; &amp;amp; &&amp;&"]
    rows = [(3 * i + k, f"https://h.org/{i}", f'<html lang="en"><head><title>{t} T</title></head><body><h1>{t}</h1><p>x</p></body></html>') for i, t in enumerate(said) for k in range(3)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = registry.queries()["h09_h10_field_rules"](spark, str(tmp_path))
    want = con.execute(registry.oracle_sql()["h09_h10_field_rules"])
    assert _rows(got.columns, got.collect()) == _rows([d[0] for d in want.description], want.fetchall())
    assert {r.page_id: r.title for r in got.collect()}[4] == "cut &amp"
