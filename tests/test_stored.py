"""Stored queries: the index against the predicates themselves."""

import math
import random

import pytest
from pyspark.sql import functions as F

from emberlog import LogTable
from emberlog.functions.fields import Fields
from emberlog.operators import relations, stored
from emberlog.operators.dsl import QueryError, compile_query


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(24)
    words = ["disk", "full", "of", "fire", "user", "login", "failed"]
    data = [
        (
            k, rng.choice([None, " ".join(rng.choices(words, k=rng.randint(0, 5)))]), rng.choice([None, "a", "b", "c", "disk"]),
            rng.choice([None, 0.0, -0.0, 1.5, -2.25, 1e-310, 1e308, math.inf, -math.inf, math.nan, 4.0, rng.uniform(-10, 10)]),
            rng.choice([None, 0, 7, -7, 2**62, -(2**63), rng.randint(-50, 50)]), f"2024-01-{rng.randint(1, 28):02d} 10:00:00",
        )
        for k in range(300)
    ]
    df = spark.createDataFrame(data, "id long, message string, kind string, value double, n long, at string")
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


def random_query(rng, depth=2):
    leaves = [
        lambda: {"term": {"kind": rng.choice(["a", "b", "z"])}},
        lambda: {"terms": {"kind": rng.choices(["a", "b", "c", "z"], k=rng.randint(0, 3))}},
        lambda: {"match": {"message": {"query": rng.choice(["disk full", "fire", "!!", "Login user"]), "operator": rng.choice(["or", "and"])}}},
        lambda: {"match_phrase": {"message": rng.choice(["disk full", "of fire", "user"])}},
        lambda: {"range": {"value": {rng.choice(["gt", "gte"]): rng.choice([-3, 0, 1.5, 4, "x"]), rng.choice(["lt", "lte"]): rng.choice([0, 1.5, 5, 1e308])}}},
        lambda: {"range": {"value": {rng.choice(["gt", "lt"]): rng.choice([-2.25, 0, 1.5])}}},
        lambda: {"range": {"n": {rng.choice(["gt", "gte"]): rng.choice([-7, 0.5, -50]), rng.choice(["lt", "lte"]): rng.choice([7, 6.5, 2**62, 2**70])}}},
        lambda: {"term": {"n": rng.choice([7, "7", 7.5, "x", 2**62])}},
        lambda: {"range": {"at": {"gte": f"2024-01-{rng.randint(1, 28):02d}", "lt": "2024-01-20"}}},
        lambda: {"exists": {"field": rng.choice(["message", "value", "nothing"])}},
        lambda: {"wildcard": {"kind": "*i*"}},
        lambda: {"term": {"nothing": 1}},
        lambda: {"match_all": {}},
    ]
    if depth and rng.random() < 0.6:
        some = lambda: [random_query(rng, depth - 1) for _ in range(rng.randint(0, 2))]
        return {"bool": {"must": some(), "must_not": some(), "should": some()}}
    return rng.choice(leaves)()


def test_index_and_predicates_agree(spark, rows, monkeypatch):
    rng = random.Random(1)
    queries = {f"q{k}": random_query(rng) for k in range(150)}
    fields = Fields.of(rows, ["message"])
    index, whole = stored.index_of(fields, queries)
    assert len(whole) < 60 and len({r[0] for r in index}) > 60
    few = sorted((r.id, r.query_id) for r in relations.percolate(rows, queries, fields).select("id", "query_id").collect())
    monkeypatch.setattr(stored, "QUERIES_PER_ARRAY", 20)
    got = sorted((r.id, r.query_id) for r in relations.percolate(rows, queries, fields).select("id", "query_id").collect())
    assert got == few
    hits = rows.select("id", *[F.coalesce(compile_query(fields, q).matches, F.lit(False)).alias(n) for n, q in queries.items()]).collect()
    assert got == sorted((r.id, n) for r in hits for n in queries if r[n])


def test_rows_alike_in_all_columns_stay(spark, monkeypatch):
    monkeypatch.setattr(stored, "QUERIES_PER_ARRAY", 0)
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "kind string")
    queries = {"one": {"bool": {"should": [{"term": {"kind": "a"}}, {"terms": {"kind": ["a", "b"]}}]}}}
    assert relations.percolate(df, queries).count() == 4
    assert relations.percolate(df, {}).count() == 0


def test_plan_has_no_predicate_per_query(spark, rows):
    queries = {f"q{k}": {"bool": {"must": [{"term": {"kind": f"k{k}"}}, {"range": {"value": {"gt": k}}}]}} for k in range(5000)}
    found = relations.percolate(rows, {**queries, "hit": {"term": {"kind": "a"}}}, Fields.of(rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "k4999" not in plan
    assert found.count() == rows.where("kind = 'a'").count()


@pytest.mark.parametrize("value", [0.0, 5e-324, 1e-310, 2.0**-1022, 0.1, 0.5, 1.0, 1.5, 2.0, 1023.999, 2.0**52, 1e300, 1e308, math.inf])
def test_order_of_doubles_is_one(spark, value):
    both = [value, -value, math.nextafter(value, 0), math.nextafter(value, math.inf)]
    df = spark.createDataFrame([(v,) for v in both], "v double").select("v", stored._ordered_column(F.col("v")).alias("o"))
    assert [r.o for r in df.collect()] == [stored._ordered(v) for v in both]
    assert stored._ordered(both[2]) <= stored._ordered(value) <= stored._ordered(both[3])


def test_percolate_in_a_body(spark):
    queries = spark.createDataFrame([
        (1, '{"match": {"message": "disk"}}', "x"), (2, '{"query": {"range": {"size": {"gte": 5}}}}', "x"), (3, '{"wildcard": {"host": "web*"}}', "y"),
        (4, '{"term": {"user.name": "eve"}}', "y"), (5, None, "x"),
    ], "id long, query string, team string")
    logs = LogTable(queries, "ts", ("message",), ("id",))

    def ids(clause):
        return sorted(r.id for r in logs.search({"query": clause}).df.collect())

    document = {"message": "Disk full", "size": 7, "host": "web-1", "user": {"name": "eve"}, "gone": None}
    assert ids({"percolate": {"field": "query", "document": document}}) == [1, 2, 3, 4]
    assert ids({"percolate": {"field": "query", "documents": [{"message": "x disk"}, {"size": 4}]}}) == [1]
    assert ids({"bool": {"must": {"percolate": {"field": "query", "document": document}}, "must_not": {"term": {"team": "x"}}}}) == [3, 4]
    assert ids({"bool": {"must_not": {"percolate": {"field": "query", "document": document}}}}) == [5]
    for bad in ({"field": "query"}, {"field": "query", "document": document, "index": "i"}):
        with pytest.raises(QueryError):
            logs.search({"percolate": bad})


def test_conditions_that_most_rows_fulfil_are_joined_with_a_range(spark):
    """Queries share a range so often that the kind of row seems rarer; rows of that kind must still not meet them all."""
    rows = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, "error").otherwise("view").alias("kind"), F.col("id").cast("double").alias("price"))
    queries = {f"q{k}": {"bool": {"filter": [{"term": {"kind": "error"}}, {"range": {"price": {"gte": 10 + k / 1000, "lt": 12}}}]}} for k in range(300)}
    queries |= {f"r{k}": {"range": {"price": {"gte": 10 + k / 1000, "lt": 12}}} for k in range(300)}
    fields = Fields.of(rows)
    index, _ = stored.index_of(fields, queries)
    assert {r[1] for r in index if r[0].startswith("q")} == {stored.AND.join(["kind", "price"])}
    got = relations.percolate(rows, queries, fields)
    # 11 meets the 300 ranges, 10 one of each sort.
    assert got.count() == 302 and got.where("kind = 'error'").count() == 2
