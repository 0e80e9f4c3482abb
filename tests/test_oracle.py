"""Every query against an independent SQL engine on the smallest tables."""

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from caseweave.operators import cohort, match, search, summaries
from caseweave.plans.bindings import Bindings
from caseweave.plans.oracle import oracle_sql
from caseweave.plans.queries import QUERIES
from caseweave.sources.requests import list_objects

FOLDER = "/root/testdata/sf0.001"
TABLES = [p.stem for p in sorted(Path(FOLDER).glob("*.parquet"))] if Path(FOLDER).exists() else []

pytestmark = pytest.mark.skipif(not TABLES, reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    answer = duck.execute(contract.oracle_sql()[name])
    sql_columns = [c[0] for c in answer.description]
    assert sorted(sql_columns) == columns
    place = [sql_columns.index(c) for c in columns]
    want = ordered([[r[i] for i in place] for r in answer.fetchall()])
    assert ordered(df.select(*columns).collect()) == want


def test_object_listing(spark):
    files = list_objects(spark, FOLDER, "*.parquet")
    assert {r.uri.split("/")[-1] for r in files.collect()} == {f"{t}.parquet" for t in TABLES}


@pytest.fixture(scope="module")
def bound(spark):
    return Bindings(spark, FOLDER)


def test_every_row_is_a_case_and_every_branch_occurs(bound):
    size = bound.table("documents").count() + bound.table("pages").count()
    assert bound.cases.count() == bound.quality.count() == size
    whole = bound.cases.join(
        bound.table("documents").withColumnRenamed("doc_id", "service_request_id"), "service_request_id"
    )
    assert whole.filter(F.startswith("request_details", "text")).count() == whole.count() == 200
    strata = {r.stratum for r in cohort.eligible(bound.quality).select("stratum").distinct().collect()}
    assert strata == {"text", "image"}
    drawn = cohort.stratified_cohort(bound.quality, 10, 42)
    assert drawn.groupBy("stratum").count().agg(F.max("count")).first()[0] == 10
    fallback = cohort.fallback_ids(bound.quality, bound.cohort)
    assert 0 < fallback.count() < size
    made = summaries.case_summaries(
        summaries.text_source_of_cases(bound.cases, bound.cohort), bound.photo_summaries
    )
    sources = {r.summary_source for r in made.select("summary_source").distinct().collect()}
    assert sources == {"text", "image", "none"}


def test_tiers_are_disjoint_and_unique(spark, bound):
    precise = match.best_same_label(bound.given_candidates, 0.75)
    overall = match.best_overall(bound.given_candidates, precise, 0.75)
    ids = [r[0] for r in precise.unionByName(overall).select("service_request_id").collect()]
    assert len(ids) == len(set(ids))
    assert bound.given_candidates.groupBy("service_request_id").count().agg(
        F.max("count")).first()[0] == search.fv.NEIGHBOURS


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "service_request_id" and df.count() > 0
