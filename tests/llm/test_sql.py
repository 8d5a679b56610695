"""The queries with SQL agree with DuckDB on the smallest tables and on a table of odd rows."""

import os

import duckdb
import pytest

from terraloom.llm import queries

DATA = "/root/testdata/sf0.001"


def same(spark, folder, name):
    c = duckdb.connect()
    for t in os.listdir(folder):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from read_parquet('{folder}/{t}{'/*.parquet' if os.path.isdir(f'{folder}/{t}') else ''}')")
    want = c.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    df = queries.queries()[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    rows = df.select(*columns).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want.fetchall(), key=str)
    return rows


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    assert same(spark, DATA, name)


@pytest.mark.parametrize("name", ["op9_line_dedup", "op9_line_dedup_shared"])
def test_sql_of_odd_pages(spark, tmp_path, name):
    """Null, empty and scheme-less rows, repeated pages, a line on every page and one on a third of one host."""
    foot, third = "shared footer that stands on all pages", "a block that a third of the pages of one host hold"
    html = lambda i, h: f"<p>{foot}</p><br>own words {h} {i}\n" + (third if h == "a.org" and i % 3 == 0 else "menu")
    data = [(100 * n + i, f"http://{h}/{i}", html(i, h)) for n, h in enumerate(["a.org", "b.org", "c.org"]) for i in range(30)]
    data += data[:3] + [(900, None, html(1, "x")), (901, "http://a.org/", None), (902, "", ""), (None, "no scheme", "<p></p>\n \n"), (904, None, "x" * 70000)]
    spark.createDataFrame(data, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = same(spark, str(tmp_path), name)
    assert len(rows) == len(data)
    assert sum(r.n_dropped for r in rows) >= 90


@pytest.mark.parametrize("name", ["op9_line_dedup", "op9_line_dedup_shared"])
def test_sql_of_no_pages(spark, tmp_path, name):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert same(spark, str(tmp_path), name) == []
