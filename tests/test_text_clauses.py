"""Phrases with slop, words over several fields, and options nobody knows."""

import itertools

import pytest
from pyspark.sql import functions as F

from emberlog.functions.fields import Fields
from emberlog.operators import aggregations
from emberlog.operators.dsl import QueryError, compile_query

TEXTS = ["a b c", "b a c", "a x b", "a x x b c", "c b a", "a a b", "a", "b x x x a", "a b a", None, "", "a-b, C!"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(k, t, t and t[::-1]) for k, t in enumerate(TEXTS)], "id int, t string, r string")


def near(text, words, slop):
    tokens = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    places = [[i for i, t in enumerate(tokens) if t == w] for w in words]
    for pick in itertools.product(*places):
        moved = [i - k for k, i in enumerate(pick)]
        if len(set(pick)) == len(pick) and max(moved) - min(moved) <= slop:
            return True
    return False


@pytest.mark.parametrize("words", ["a b", "b a", "a b c", "a a", "a b a"])
def test_slop_is_the_moves_of_all_words(spark, rows, words):
    hits = rows.select("id", *[
        F.coalesce(compile_query(Fields.of(rows, ["t"]), {"match_phrase": {"t": {"query": words, "slop": n}}}).matches, F.lit(False)).alias(f"s{n}") for n in range(5)
    ]).collect()
    for r in hits:
        assert [r[f"s{n}"] for n in range(5)] == [near(TEXTS[r.id], words.split(), n) for n in range(5)], (TEXTS[r.id], words)


@pytest.mark.parametrize("clause, expected", [
    ({"multi_match": {"query": "alpha zeta", "fields": ["a", "b"], "type": "cross_fields", "operator": "and"}}, [1]),
    ({"multi_match": {"query": "alpha zeta", "fields": ["a", "b"], "operator": "and"}}, []),
    ({"multi_match": {"query": "alpha beta eta", "fields": ["a", "b"], "minimum_should_match": 2}}, [1, 2]),
    ({"multi_match": {"query": "alpha beta eta", "fields": ["a", "b"], "minimum_should_match": "100%"}}, []),
    ({"multi_match": {"query": "gamma beta", "fields": ["a"], "type": "phrase", "slop": 2}}, [2]),
    ({"query_string": {"query": "alpha zeta beta", "fields": ["a", "b"], "minimum_should_match": 3}}, [1]),
    ({"query_string": {"query": "alpha zeta beta", "fields": ["a", "b"], "minimum_should_match": "-1"}}, [1, 2]),
])
def test_words_over_fields(spark, clause, expected):
    df = spark.createDataFrame([(1, "alpha beta", "zeta"), (2, "alpha beta gamma", None), (3, None, "eta")], "id int, a string, b string")
    found = df.where(compile_query(Fields.of(df, ["a", "b"]), clause).matches)
    assert sorted(r.id for r in found.collect()) == expected


@pytest.mark.parametrize("clause", [
    {"match_phrase": {"t": {"query": "a", "slap": 1}}}, {"match_phrase_prefix": {"t": {"query": "a", "slop": 1}}},
    {"multi_match": {"query": "a", "fields": ["t"], "fuzziness": 1}}, {"multi_match": {"query": "a", "fields": ["t"], "type": "no_fields"}},
    {"query_string": {"query": "a", "lenient": True}}, {"query_string": {"query": "a AND b", "minimum_should_match": 1}},
])
def test_unknown_options_of_clauses_raise(spark, rows, clause):
    with pytest.raises(QueryError):
        compile_query(Fields.of(rows, ["t"]), clause)


@pytest.mark.parametrize("agg", [
    {"terms": {"field": "id", "sise": 1}}, {"terms": {"field": "id", "include": 5}}, {"histogram": {"field": "id", "interval": 1, "zone": 1}},
    {"date_histogram": {"field": "at", "calendar_interval": "day", "timezone": "UTC"}}, {"date_histogram": {"field": "at", "calendar_interval": "2d"}},
    {"date_histogram": {"field": "at"}}, {"date_histogram": {"field": "at", "fixed_interval": "day"}}, {"avg": {"field": "id", "script": "x"}}, {"range": {"field": "id", "range": []}},
    {"percentiles": {"field": "id", "percent": [1]}}, {"filters": {"filters": {}, "other_bucket": True}},
])
def test_unknown_options_of_aggregations_raise(spark, agg):
    df = spark.sql("SELECT 1 AS id, timestamp'2024-01-01 00:00:00' AS at")
    with pytest.raises(QueryError):
        aggregations.aggregate(df, {"x": agg})


def test_hours_that_come_twice_are_two_buckets(spark):
    df = spark.sql("SELECT timestamp_seconds(1730602800 + 1800 * id) AS at FROM range(12)")  # 2024-11-03, 23:00 to 04:30 in New York
    aggs = {"h": {"date_histogram": {"field": "at", "calendar_interval": "hour", "time_zone": "America/New_York", "min_doc_count": 0}}}
    assert [r.doc_count for r in aggregations.aggregate(df, aggs)["h"].collect()] == [2] * 6
    half = {"h": {"date_histogram": {"field": "at", "fixed_interval": "1h", "time_zone": "Asia/Kolkata"}}}
    assert [r.doc_count for r in aggregations.aggregate(df, half)["h"].orderBy("h").collect()] == [1, 2, 2, 2, 2, 2, 1]


def test_empty_buckets_have_zero_sums_and_no_averages(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 41.0), ("y", 25.0)], "k string, v double")
    aggs = {"k": {"terms": {"field": "k"}, "aggs": {"h": {"histogram": {"field": "v", "interval": 10, "min_doc_count": 0}, "aggs": {
        "s": {"sum": {"field": "v"}}, "a": {"avg": {"field": "v"}}, "t": {"stats": {"field": "v"}},
    }}}}}
    got = [(r.k, r.h, r.doc_count, r.s, r.a, r.t_count, r.t_min) for r in aggregations.aggregate(df, aggs)["k>h"].orderBy("k", "h").collect()]
    assert got == [("x", 0, 1, 1.0, 1.0, 1, 1.0), *[("x", h, 0, 0.0, None, 0, None) for h in (10, 20, 30)], ("x", 40, 1, 41.0, 41.0, 1, 41.0), ("y", 20, 1, 25.0, 25.0, 1, 25.0)]
