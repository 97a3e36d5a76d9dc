"""Every registered query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from gleaner.plans.driver import QUERIES
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = rows_of(cols, [tuple(r) for r in df.collect()])
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert got == rows_of(ocols, res.fetchall())


def test_every_query_is_registered_with_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_signals_are_not_vacuous(spark):
    lines = E.queries()["stat_lines"](spark, SF)
    for c in ("is_record", "is_percentage", "is_odds", "is_total"):
        assert 0 < lines.where(c).count() < lines.count(), c
    words = E.queries()["promo_words"](spark, SF)
    assert len({r.post.split(" ", 1)[1] for r in words.where("promo").collect()}) >= 8
    drafts = E.queries()["curation_drafts"](spark, SF)
    assert {r.draft_type for r in drafts.collect()} == {"single", "thread"}
    run = {r.outcome: r["count"] for r in E.queries()["curation_run"](spark, SF).groupBy("outcome").count().collect()}
    assert set(run) == {"duplicate", "excluded", "failed", "processed"}
    rungs = {r.body_source for r in E.queries()["body_ladder_main"](spark, SF).collect()}
    assert rungs == {"feed", "main", "article", "missing"} | rungs & {"page"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "point_no", "point"]
    assert df.count() > 0
