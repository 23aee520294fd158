"""Queries of the package against their DuckDB statements."""

import duckdb
import pytest

from assayloom.llm import queries, sql

SF = "/root/testdata/sf0.01"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(str(r[i]) for i in order) for r in rows))


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_statement(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        db.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = db.sql(sql.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())


def test_links_of_pages(spark):
    page = lambda i, url, head: (i, url, f"<html>{head}</html>")
    rows = [
        page(1, "http://a.net/x", "<link rel='canonical'\n href='http://www.shop.com/de/1'>"), page(2, "http://www.shop.com/de/1", ""),
        page(3, "http://b.net/", '<meta http-equiv="refresh" content="0; url=/next">'), page(4, "http://b.net/next", '<link rel=canonical href=//c.org/>'),
        page(5, "http://d.net/q?x#y", '<link\nhref="z" rel="canonical">'), page(6, None, "<link rel=canonical href=//c.org/>"), (7, "HTTP://A.net/x?", None),
        page(8, "http://e.net/1", "<link rel=canonical href='http://a.net/x'>"), page(8, "http://e.net/1", ""), page(9, "no host", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = queries.judge_urls(pages, queries.URL_RULES)
    db = duckdb.connect()
    db.register("pages", pages.toArrow())
    want = db.sql(sql.OP1)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())
    verdict = {r["page_id"]: (r["verdict"], r["by"]) for r in got.collect()}
    assert verdict[1] == ("block", "alias") and verdict[8] == ("block", "alias") and verdict[3] == ("allow", "alias")
