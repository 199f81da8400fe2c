"""Plan shapes that decide whether a query survives large data."""

import contextlib
import io

import pytest

import __spark_entry__ as registry
from plinth.operators.latest import latest_per_key
from plinth.plans import queries as q
from plinth.sources import given

SF = "/root/testdata/sf0.001"
WRITES = {  # queries that land files or run streams before they return
    "csv_positional_read", "ingest_with_lineage", "delta_append", "list_files", "csv_error_modes", "append_stream",
    "stream_upsert", "stream_daily_revenue",
}


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(registry.warehouse_queries()) - WRITES))
def test_no_query_forms_pairs_or_runs_python(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_latest_per_key_is_reduced_before_the_shuffle(spark):
    text = plan(latest_per_key(given.table(spark, SF, "lineitem"), ["l_orderkey"], ["l_shipdate"]))
    assert text.count("WindowGroupLimit") >= 2


def test_top_per_month_is_reduced_before_the_shuffle(spark):
    assert plan(q.topk_per_month(spark, SF)).count("WindowGroupLimit") >= 2


def test_ranking_is_a_top_k_not_a_sort(spark):
    assert "TakeOrderedAndProject" in plan(q.top10_restaurants(spark, SF))


def test_kpis_read_only_their_columns_and_push_the_filter(spark):
    text = plan(q.yearly_revenue(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text
    assert "l_shipdate" not in text and "o_totalprice" not in text


def test_items_are_summed_before_they_meet_their_orders(spark):
    """Two shuffles of items at most: partial sums by order, then the join on the same key."""
    tree = plan(q.yearly_revenue(spark, SF)).split("(1) ")[0]
    assert tree.index("HashAggregate") < tree.index("Join")
    assert "count(distinct" not in tree.lower()
