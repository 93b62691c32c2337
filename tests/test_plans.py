"""Plans that must hold at scale: pushdown, pruning, no needless exchange, no Python."""

import pytest
from pyspark.sql import functions as F

from emberlog import LogTable
from emberlog.operators.ordering import newest_per_index
from emberlog.plans import QUERIES
from emberlog.plans.registry import table

WRITERS = {n for n in QUERIES if n.startswith("sink_")} | {"import_bundle", "import_array", "stream_search"}


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_search_and_time_range_reach_the_scan(spark, sf_dir):
    shown = plan(QUERIES["export_errors"](spark, sf_dir))
    assert "EqualTo(event_type,error)" in shown and "GreaterThan(value,50.0)" in shown
    assert "GreaterThanOrEqual(ts,2024-01-10" in shown and "LessThanOrEqual(ts,2024-01-20" in shown
    assert "props" not in shown and "user_id" not in shown
    assert "TakeOrderedAndProject" in shown and "Exchange" not in shown


@pytest.mark.parametrize(
    "query, pushed",
    [
        ("event_type:(error OR click)", "Or(EqualTo(event_type,error),EqualTo(event_type,click))"),
        ("event_type:err*", "StringStartsWith(event_type,err)"),
        ("user_id:[3 TO 9]", "LessThanOrEqual(user_id,9)"),
        ({"bool": {"filter": [{"term": {"event_type": "error"}}, {"exists": {"field": "value"}}]}}, "IsNotNull(value)"),
        ({"terms": {"user_id": [1, "2"]}}, "In(user_id, [1,2])"),
    ],
)
def test_leaves_reach_the_scan(spark, sf_dir, query, pushed):
    shown = plan(LogTable(table(spark, sf_dir, "events"), "ts").search(query).df)
    assert pushed in shown.split("PushedFilters")[1].splitlines()[0]


def test_hot_index_is_cut_before_and_spread_over_the_exchange(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("_index", F.lit("hot"))
    shown = plan(newest_per_index(df, "ts", 5, ["event_id"]))
    assert shown.count("WindowGroupLimit") >= 4
    assert "__slice" in shown


def test_related_rows_are_made_distinct_then_semi_joined(spark, sf_dir):
    shown = plan(QUERIES["dsl_has_child"](spark, sf_dir))
    assert "LeftSemi" in shown and "HashAggregate" in shown


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_and_no_product(spark, sf_dir, name):
    shown = plan(QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert banned not in shown


def test_bucketed_relations_are_not_shuffled(spark, sf_dir, tmp_path):
    from emberlog.functions.fields import Fields, Relation
    from emberlog.operators.dsl import compile_query
    from emberlog.sources import sinks

    sinks.write_related(table(spark, sf_dir, "orders"), "rel_orders", "o_orderkey", 4, str(tmp_path / "o"))
    sinks.write_related(table(spark, sf_dir, "lineitem"), "rel_lines", "l_orderkey", 4, str(tmp_path / "l"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.table("rel_orders")
        relation = Relation(spark.table("rel_lines"), here="o_orderkey", there="l_orderkey")
        clause = {"has_child": {"type": "line", "query": {"range": {"l_quantity": {"gt": 48}}}}}
        found = orders.where(compile_query(Fields.of(orders, relations={"line": relation}), clause).matches)
        assert "Exchange" not in plan(found) and "LeftSemi" in plan(found)
        expected = table(spark, sf_dir, "lineitem").where("l_quantity > 48").select("l_orderkey").distinct().count()
        assert found.count() <= expected and found.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE rel_orders")
        spark.sql("DROP TABLE rel_lines")
