"""Every query against its SQL twin, and what the plans look like."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from larder.plans import catalogue, inputs
from larder.plans.oracle import ORACLE
from larder.plans.queries import QUERIES

FOLDER = os.environ.get("LARDER_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert compare(QUERIES[name](spark, FOLDER), db, ORACLE[name]) == []


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_few_columns_and_push_filters(spark):
    text = plan(catalogue.sold(inputs.prices(spark, FOLDER), inputs.products(spark, FOLDER)))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in text
    text = plan(QUERIES["upsert_composite"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in text


def test_family_ranks_are_cut_before_the_shuffle(spark):
    text = plan(QUERIES["families_per_step"](spark, FOLDER))
    assert "row_number(), 80, Partial" in text


def test_medians_have_one_way_without_hints(spark):
    df = QUERIES["price_ref"](spark, FOLDER)
    text = df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in text and "Union" not in text


def test_prices_of_last_lines_take_one_hash_shuffle(spark):
    text = plan(QUERIES["price_index"](spark, FOLDER)).split("Initial Plan")[-1]
    assert text.count("hashpartitioning") == 1 and "SortAggregate" not in text and text.count("FileScan") == 1


def test_roll_up_reads_prices_once(spark):
    cells = catalogue.sold(inputs.prices(spark, FOLDER), inputs.products(spark, FOLDER))
    assert plan(cells).count("FileScan") == 2
    rolled = plan(QUERIES["catalogue_rollup"](spark, FOLDER))
    assert "lineitem" not in rolled and "part.parquet" not in rolled
