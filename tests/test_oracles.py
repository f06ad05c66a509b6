"""Every registered query against its SQL on the smallest tables, and the shape of some plans."""

import re

import pytest

import __spark_entry__ as entry
import compare
from webcorpus.operators import analytics
from webcorpus.plans import fixtures as fx
from webcorpus.plans import oracle
from webcorpus.plans import queries as plans

SF = "/root/testdata/sf0.001"
QUERIES, SQL = plans.all_queries(), oracle.all_sql()


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert compare.differences(QUERIES[name](spark, SF), db, SQL[name]) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10 and rows[0].value >= rows[-1].value


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_query_pairs_everything_with_everything(spark):
    lazy = [n for n in QUERIES if not re.search("sink|source|stream|resume|store|override|list|ddl", n)]
    for name in lazy:
        plan = physical(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name


def test_reports_read_only_their_columns(spark, folder):
    fx.articles(spark, SF).write.parquet(folder + "/store")
    store = spark.read.parquet(folder + "/store")

    def read(frame):
        return set(re.findall(r"ReadSchema: struct<([^>]*)>", physical(frame)))

    assert read(analytics.domain_top10(store)) == {"url:string"}
    assert read(analytics.daily_trend(store)) == {"crawled_at:timestamp"}
    assert "TakeOrderedAndProject" in physical(analytics.domain_top10(store))
    detail = physical(analytics.article_detail(store, 5))
    assert "EqualTo(id,5)" in detail
    page = analytics.article_page(store)
    assert "content_md" not in physical(page).split("Subquery", 1)[1].split("ReadSchema")[-1]
