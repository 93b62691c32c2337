import pytest

from emberlog.functions.fields import Fields
from emberlog.operators.aggregations import aggregate
from emberlog.operators.dsl import QueryError

ROWS = [
    ("a", "x", 1, ["p", "q"]), ("a", "x", 2, ["p"]), ("a", "y", 3, []), ("b", "x", 10, ["p", "p"]), ("b", "z", 20, None),
    ("c", "x", None, ["q"]), (None, "x", 5, ["q"]),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "kind string, sub string, n int, tags array<string>")


def rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


def test_an_aggregation_may_be_called_like_its_field(df):
    found = aggregate(df, {"kind": {"terms": {"field": "kind"}, "aggs": {"n": {"sum": {"field": "n"}}}}})["kind"]
    assert rows(found, "kind", "doc_count", "n") == [("a", 3, 6), ("b", 2, 30), ("c", 1, None)]


def test_order_size_missing_and_minimum(df):
    def kinds(**body):
        metric = {"top": {"max": {"field": "n"}}}
        return [r[0] for r in rows(aggregate(df, {"k": {"terms": {"field": "kind", **body}, "aggs": metric}})["k"], "k")]

    assert kinds(size=2) == ["a", "b"]
    assert kinds(order={"_key": "desc"}) == ["c", "b", "a"]
    assert kinds(order={"top": "desc"}, size=1) == ["b"]
    assert kinds(missing="?") == ["a", "b", "?", "c"]
    assert kinds(min_doc_count=2) == ["a", "b"]


def test_array_values_count_once_per_row(df):
    assert rows(aggregate(df, {"t": {"terms": {"field": "tags"}}})["t"], "t", "doc_count") == [("p", 3), ("q", 3)]


def test_every_level_has_its_own_frame_and_metrics(df):
    found = aggregate(df, {"kind": {
        "terms": {"field": "kind", "size": 2},
        "aggs": {
            "mean": {"avg": {"field": "n"}},
            "sub": {"terms": {"field": "sub", "size": 1}, "aggs": {"top": {"max": {"field": "n"}}}},
            "size": {"range": {"field": "n", "ranges": [{"key": "low", "to": 3}, {"key": "high", "from": 3}]}},
        },
    }})
    assert rows(found["kind"], "kind", "doc_count", "mean") == [("a", 3, 2.0), ("b", 2, 15.0)]
    assert sorted(rows(found["kind>sub"], "kind", "sub", "doc_count", "top")) == [("a", "x", 2, 2), ("b", "x", 1, 10)]
    assert sorted(rows(found["kind>size"], "kind", "size", "doc_count")) == [
        ("a", "high", 1), ("a", "low", 2), ("b", "high", 2), ("b", "low", 0),
    ]


def test_three_levels(df):
    found = aggregate(df, {"f": {
        "filters": {"filters": {"small": {"range": {"n": {"lt": 5}}}, "none": {"term": {"kind": "zzz"}}}},
        "aggs": {"k": {"terms": {"field": "kind"}, "aggs": {"s": {"terms": {"field": "sub"}}}}},
    }})
    assert sorted(rows(found["f"], "f", "doc_count")) == [("none", 0), ("small", 3)]
    assert sorted(rows(found["f>k>s"], "f", "k", "s", "doc_count")) == [("small", "a", "x", 2), ("small", "a", "y", 1)]


def test_one_filter(df):
    body = {"odd": {"filter": {"terms": {"n": [1, 3, 5]}}, "aggs": {"kinds": {"cardinality": {"field": "kind", "exact": True}}}}}
    assert rows(aggregate(df, body)["odd"], "odd", "doc_count", "kinds") == [(True, 3, 1)]


def test_histograms(spark, df):
    found = aggregate(df, {"h": {"histogram": {"field": "n", "interval": 5, "offset": 1}}})["h"]
    assert rows(found, "h", "doc_count") == [(1, 4), (6, 1), (16, 1)]
    times = spark.sql("SELECT explode(array(0L, 59999L, 60000L, 90061000L)) AS startTimeMillis")
    body = {"m": {"date_histogram": {"field": "startTimeMillis", "fixed_interval": "1m"}}}
    assert [(str(a), b) for a, b in rows(aggregate(times, body, Fields.of(times))["m"], "m", "doc_count")] == [
        ("1970-01-01 00:00:00", 2), ("1970-01-01 00:01:00", 1), ("1970-01-02 01:01:00", 1),
    ]


@pytest.mark.parametrize("body", [
    {"a": {"nope": {}}}, {"a": {"avg": {"field": "absent"}}}, {"a": {"terms": {"field": "kind"}, "avg": {"field": "n"}}},
    {"a": {"terms": {"field": "absent"}}}, {"a": {"range": {"field": "absent", "ranges": []}}},
])
def test_broken_bodies(df, body):
    with pytest.raises(QueryError):
        aggregate(df, body)
