import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import Fields
from emberlog.operators.dsl import Body, QueryError, compile_query
from emberlog.operators.predicates import like_pattern
from emberlog.operators.search import search_predicate

ROWS = [
    (1, "ERROR", "Payment failed for order 17", 500, "prod", ["a", "b"], {"app": "shop"}),
    (2, "WARN", "payment retried", 350, "prod", ["b"], {"app": "web"}),
    (3, "INFO", "Order accepted", 20, "dev", [], {"app": "shop"}),
    (4, None, None, None, None, None, None),
    (5, "ERROR", "100% of the disk_full", 900, "stage", ["c"], {}),
]
SCHEMA = (
    "id int, level string, message string, duration long, `kubernetes.namespace` string, tags array<string>,"
    " labels map<string,string>"
)


@pytest.fixture(scope="module")
def logs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    tag = F.struct(F.col("duration").alias("http@status_code"), F.col("level").alias("lvl"))
    return df.withColumn("tag", tag).cache()


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def find(logs, text, **kwargs):
    return ids(logs.where(search_predicate(Fields.of(logs, ["message"]), text, **kwargs)))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", [1, 2, 3, 4, 5]),
        ("*", [1, 2, 3, 4, 5]),
        ("level:ERROR", [1, 5]),
        ("level:error", []),
        ("message:PAYMENT", [1, 2]),
        ("message:pay", []),
        ('message:"of the"', [5]),
        ('message:"payment order"', []),
        ("level:(ERROR OR WARN)", [1, 2, 5]),
        ("level:(ERROR WARN)", [1, 2, 5]),
        ("level:ERROR AND kubernetes.namespace:(prod OR dev)", [1]),
        ("level:ERROR AND NOT kubernetes.namespace:prod", [5]),
        ("NOT level:ERROR", [2, 3, 4]),
        ("level:ERROR NOT duration:>600", [1]),
        ("level:WARN OR level:ERROR AND duration:>600", [2, 5]),
        ("(level:WARN OR level:ERROR) AND duration:>600", [5]),
        ("((level:WARN) OR (level:ERROR AND (duration:<=500)))", [1, 2]),
        ("duration:>350", [1, 5]),
        ("duration:>=350", [1, 2, 5]),
        ("duration:<350.5", [2, 3]),
        ("duration:[20 TO 350]", [2, 3]),
        ("duration:{20 TO 350}", []),
        ("duration:[400 TO *]", [1, 5]),
        ("duration:>word", []),
        ("duration:abc", []),
        ("level:*", [1, 2, 3, 5]),
        ("level:E*R", [1, 5]),
        ("level:?NFO", [3]),
        ("message:*100%*", [5]),
        (r"tag.http\@status_code:500", [1]),
        (r"tag.http\@status_code:>=500", [1, 5]),
        ("tag.lvl:INFO", [3]),
        ("tags:b", [1, 2]),
        ("labels.app:shop", [1, 3]),
        ("no_such_field:1", []),
        ("NOT no_such_field:1", [1, 2, 3, 4, 5]),
        ("payment", [1, 2]),
        ("order failed", [1, 3]),
        ("order && failed", [1]),
        ('"order accepted" || level:WARN', [2, 3]),
    ],
)
def test_search_strings(logs, text, expected):
    assert find(logs, text) == expected


def test_default_operator(logs):
    assert find(logs, "order failed", default_operator="AND") == [1]


@pytest.mark.parametrize("text", ["level:ERROR AND", "AND level:ERROR", "(level:ERROR", "level:ERROR)", "NOT", "a OR OR b"])
def test_broken_strings(logs, text):
    with pytest.raises(ValueError):
        find(logs, text)


@pytest.mark.parametrize(
    "text", ["level:ERROR", "duration:>100", "message:payment AND level:ERROR", "tags:b OR labels.app:web", "level:*", "NOT level:WARN"]
)
def test_a_query_and_its_opposite_cover_all_rows(logs, text):
    assert sorted(find(logs, text) + find(logs, f"NOT ({text})")) == [1, 2, 3, 4, 5]


def test_like_pattern():
    assert like_pattern("a*b?c") == "a%b_c"
    assert like_pattern("50%_x") == r"50\%\_x"
    assert like_pattern(r"a\*b") == "a*b"


def match(logs, clause, **kwargs):
    return ids(logs.where(compile_query(Fields.of(logs, ["message"], **kwargs), clause).matches))


@pytest.mark.parametrize(
    "clause, expected",
    [
        ({"match_all": {}}, [1, 2, 3, 4, 5]),
        ({"match": {"message": "payment accepted"}}, [1, 2, 3]),
        ({"match": {"message": {"query": "payment failed", "operator": "and"}}}, [1]),
        ({"match": {"message": {"query": "payment failed order", "minimum_should_match": 2}}}, [1]),
        ({"match_phrase": {"message": "payment RETRIED"}}, [2]),
        ({"match_phrase_prefix": {"message": "payment fai"}}, [1]),
        ({"multi_match": {"query": "ERROR", "fields": ["level", "message"]}}, [1, 5]),
        ({"multi_match": {"query": "ERROR", "fields": ["lev*"]}}, [1, 5]),
        ({"query_string": {"query": "payment", "default_field": "message"}}, [1, 2]),
        ({"query_string": "level:WARN"}, [2]),
        ({"simple_query_string": {"query": "payment + -failed", "fields": ["message"]}}, [2]),
        ({"simple_query_string": {"query": 'accept* | "of the"', "fields": ["message"]}}, [3, 5]),
        ({"term": {"level": "ERROR"}}, [1, 5]),
        ({"term": {"level": {"value": "error", "case_insensitive": True}}}, [1, 5]),
        ({"term": {"duration": "500"}}, [1]),
        ({"terms": {"level": ["WARN", "INFO"]}}, [2, 3]),
        ({"terms": {"level": []}}, []),
        ({"range": {"duration": {"gte": 20, "lt": 500}}}, [2, 3]),
        ({"range": {"duration": {"gt": 99999999999999999999}}}, []),
        ({"range": {"duration": {"lt": 99999999999999999999}}}, [1, 2, 3, 5]),
        ({"exists": {"field": "level"}}, [1, 2, 3, 5]),
        ({"exists": {"field": "tags"}}, [1, 2, 5]),
        ({"exists": {"field": "nothing"}}, []),
        ({"prefix": {"level": "ER"}}, [1, 5]),
        ({"wildcard": {"level": {"value": "e*", "case_insensitive": True}}}, [1, 5]),
        ({"regexp": {"level": "ERR|WARN"}}, [2]),
        ({"fuzzy": {"level": "EROR"}}, [1, 5]),
        ({"fuzzy": {"message": {"value": "paymnt", "fuzziness": 1}}}, [1, 2]),
        ({"bool": {"must": {"term": {"level": "ERROR"}}}}, [1, 5]),
        ({"bool": {"must_not": [{"term": {"level": "ERROR"}}]}}, [2, 3, 4]),
        ({"bool": {"should": [{"term": {"level": "WARN"}}, {"term": {"level": "INFO"}}]}}, [2, 3]),
        ({"bool": {"must": [{"match_all": {}}], "should": [{"term": {"level": "WARN"}}]}}, [1, 2, 3, 4, 5]),
        ({"bool": {"should": [{"term": {"level": "ERROR"}}, {"range": {"duration": {"gt": 600}}},
                              {"term": {"tags": "c"}}], "minimum_should_match": "67%"}}, [5]),
        ({"bool": {}}, [1, 2, 3, 4, 5]),
        ({"nested": {"path": "tag", "query": {"term": {"tag.lvl": "WARN"}}}}, [2]),
    ],
)
def test_clauses(logs, clause, expected):
    assert match(logs, clause) == expected


@pytest.mark.parametrize(
    "clause",
    [{"nope": {}}, {}, {"term": {"a": 1, "b": 2}}, {"bool": {"mustt": []}}, {"match": {"message": {"query": "x", "slop": 1}}},
     {"has_child": {"type": "x", "query": {"match_all": {}}}}],
)
def test_broken_clauses(logs, clause):
    with pytest.raises(QueryError):
        match(logs, clause)


def test_nested_needs_one_element_to_hold_everything(spark):
    schema = T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("items", T.ArrayType(T.StructType([
            T.StructField("qty", T.IntegerType()), T.StructField("name", T.StringType()),
        ]))),
    ])
    df = spark.createDataFrame([(1, [(5, "x"), (50, "y")]), (2, [(50, "x")]), (3, None)], schema)
    both = {"bool": {"must": [{"range": {"items.qty": {"gt": 10}}}, {"term": {"items.name": "x"}}]}}
    assert match(df, {"nested": {"path": "items", "query": both}}) == [2]
    # Outside `nested`, each condition may hold in another element.
    assert match(df, both) == [1, 2]
    assert match(df, {"bool": {"must_not": {"nested": {"path": "items", "query": both}}}}) == [1, 3]


def test_variant_fields(spark):
    df = spark.sql("SELECT id, parse_json(doc) AS doc FROM VALUES (1, '{\"a\":{\"b\":5},\"s\":\"x\"}'), (2, '{\"s\":\"y\"}') t(id, doc)")
    assert match(df, {"range": {"doc.a.b": {"gt": 4}}}) == [1]
    assert match(df, {"terms": {"doc.s": ["y", "z"]}}) == [2]
    assert match(df, {"exists": {"field": "doc.a"}}) == [1]


def test_bodies():
    assert Body.of({"term": {"a": 1}}).query == {"term": {"a": 1}}
    full = Body.of('{"query": {"match_all": {}}, "sort": [{"a": "desc"}], "size": 3, "_source": ["a"]}')
    assert (full.sort, full.size, full.source) == ([{"a": "desc"}], 3, ["a"])
    assert Body.of({"aggregations": {"x": {"avg": {"field": "a"}}}}).query is None
    for broken in ({"unknown": 1}, {"sort": ["a"]}, {"term": {"a": 1}, "match": {"a": 1}}):
        with pytest.raises(QueryError):
            Body.of(broken)


def test_scores(logs):
    fields = Fields.of(logs, ["message"])

    def score(clause):
        hit = compile_query(fields, clause)
        return {r.id: r.s for r in logs.where(hit.matches).select("id", hit.score.alias("s")).collect()}

    assert score({"match": {"message": {"query": "payment failed", "boost": 2}}}) == {1: 4.0, 2: 2.0}
    assert score({"bool": {"must": {"term": {"level": "ERROR"}}, "should": {"term": {"duration": 900}}}}) == {1: 1.0, 5: 2.0}
    first = score({"function_score": {"query": {"term": {"level": "ERROR"}}, "random_score": {"seed": 3, "field": "id"}}})
    again = score({"function_score": {"query": {"term": {"level": "ERROR"}}, "random_score": {"seed": 3, "field": "id"}}})
    other = score({"function_score": {"query": {"term": {"level": "ERROR"}}, "random_score": {"seed": 4, "field": "id"}}})
    assert first == again != other and all(0 <= s < 1 for s in first.values())
    factor = {"field": "duration", "factor": 0.01, "missing": 0}
    low = score({"function_score": {"query": {"match_all": {}}, "field_value_factor": factor, "min_score": 5}})
    assert low == {1: 5.0, 5: 9.0}


def test_related_tables(spark):
    from emberlog.functions.fields import Relation

    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    children = spark.createDataFrame([(1, 5), (1, 6), (2, 1)], "parent int, qty int")
    related = {"child": Relation(children, here="id", there="parent")}
    has = {"has_child": {"type": "child", "query": {"range": {"qty": {"gt": 4}}}}}
    assert match(parents, has, relations=related) == [1]
    assert match(parents, {"bool": {"must_not": has}}, relations=related) == [2, 3]
    assert match(parents, {"bool": {"should": [has, {"term": {"name": "c"}}]}}, relations=related) == [1, 3]
    anything = {"type": "child", "query": {"match_all": {}}}
    assert match(parents, {"has_child": {**anything, "min_children": 2}}, relations=related) == [1]
    assert match(parents, {"has_child": {**anything, "max_children": 1}}, relations=related) == [2]
    with pytest.raises(QueryError):
        match(parents, {"has_child": {**anything, "least": 2}}, relations=related)
    listed = spark.createDataFrame([("a",), ("a",), ("zz",)], "v string")
    assert match(parents, {"terms": {"name": listed}}) == [1]
