import json

import pytest

from emberlog import LogTable
from emberlog.operators.dsl import QueryError
from emberlog.plans import QUERIES
from emberlog.plans.registry import table


def test_kind_decides_time_field_and_view(spark):
    df = spark.sql("SELECT 1L AS startTimeMillis, current_timestamp() AS `@timestamp`, 'x' AS traceID, 'y' AS spanID")
    assert LogTable(df).time_field == "@timestamp" and LogTable(df).kind == "generic"
    named = LogTable(df, name="jaeger-span-*")
    assert (named.kind, named.time_field) == ("jaeger", "startTimeMillis")
    assert named.auto_view().df.columns[0] == "startTimeMillis"
    assert LogTable(df, name="filebeat-1").auto_view().df.columns[1] == "kubernetes.namespace"
    assert LogTable(df).auto_view().df.columns == df.columns
    dated = spark.sql("SELECT 'a' AS timestamp, date'2024-01-01' AS day")
    assert LogTable(dated).time_field == "day"


def test_similar_documents_as_a_query(spark, sf_dir):
    documents = LogTable(table(spark, sf_dir, "documents"), "ts", ("text",), ("doc_id",))
    clause = {"more_like_this": {"fields": ["text"], "like": [{"_id": 1}, {"_id": 3}]}}
    expected = sorted(r.doc_id for r in QUERIES["dsl_more_like_this"](spark, sf_dir).collect())
    assert sorted(r.doc_id for r in documents.search(json.dumps(clause)).df.collect()) == expected
    seed = documents.df.where("doc_id = 1").first().text
    by_text = documents.search({"more_like_this": {"like": seed}}).df
    by_id = documents.search({"more_like_this": {"like": [{"_id": 1}]}}).df
    # A copy of the text in the table is similar to itself; the row called by id is left out.
    assert {r.doc_id for r in by_text.collect()} - {r.doc_id for r in by_id.collect()} == {1}
    assert documents.search({"more_like_this": {"like": "zzzz zzzz"}}).df.isEmpty()
    either = documents.search({"bool": {"should": [clause, {"term": {"doc_id": 1}}]}})
    assert sorted(r.doc_id for r in either.df.collect()) == sorted([1, *expected])
    neither = documents.search({"bool": {"must_not": clause}})
    assert neither.df.count() == documents.df.count() - len(expected)
    nameless = LogTable(table(spark, sf_dir, "documents"), "ts", ("text",))
    assert nameless.search({"more_like_this": {"like": seed}}).df.count() == by_text.count()
    for bad in ({"like": [{"_id": 1}]}, {"like": "x", "slop": 1}, {}):
        with pytest.raises(QueryError):
            nameless.search({"more_like_this": bad})


def test_similar_documents_by_several_fields_and_settings(spark):
    rows = [(k, f"alpha beta {'gamma' if k % 2 else 'delta'}", "omega psi" if k < 4 else None) for k in range(8)]
    logs = LogTable(spark.createDataFrame(rows, "id long, a string, b string"), "ts", ("a", "b"), ("id",))

    def ids(**body):
        body = {"like": "gamma OMEGA the the", "min_term_freq": 1, "min_doc_freq": 1, **body}
        return sorted(r.id for r in logs.search({"more_like_this": body}).df.collect())

    assert ids(minimum_should_match=1) == [0, 1, 2, 3, 5, 7] and ids(minimum_should_match=2) == [1, 3]
    assert ids(fields=["a"]) == [1, 3, 5, 7] and ids(stop_words=["gamma"]) == [0, 1, 2, 3] == ids(unlike="gamma")
    assert ids(min_word_length=6) == [] == ids(max_doc_freq=3) == ids(min_term_freq=2) and ids(max_word_length=4, like="psi gamma") == [0, 1, 2, 3]
    assert ids(like=[{"_id": 0}], fields=["b"], include=True) == [0, 1, 2, 3] and ids(like=[{"_id": 0}], fields=["b"]) == [1, 2, 3]
    assert ids(fields=["no such field"]) == []


def test_scores_and_sort_of_a_request(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'disk full'), (2, 'disk'), (3, 'full of disk full') t(id, message)")
    logs = LogTable(df, "ts", ("message",), ("id",))
    body = {"query": {"match": {"message": "full of disk"}}, "sort": ["_score"], "size": 2}
    assert [(r.id, r._score) for r in logs.search(body).top().df.collect()] == [(3, 3.0), (1, 2.0)]
    assert "_score" not in logs.search({"match": {"message": "disk"}}).df.columns
    assert "_score" in logs.search({"match": {"message": "disk"}}, with_score=True).df.columns
    with pytest.raises(ValueError):
        logs.aggregate()


def test_stored_queries(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') t(id, v)")
    many = {f"q{i}": {"term": {"v": "a" if i % 2 else "zzz"}} for i in range(450)}
    found = LogTable(df, "ts").percolate(many).df
    assert found.count() == 225 and {r.id for r in found.select("id").distinct().collect()} == {1}


def test_options_of_a_request(spark):
    df = spark.sql(
        "SELECT id, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS at, concat('u', id % 3) AS user_id, id AS secret FROM range(48)"
    )
    logs = LogTable(df, "at", (), ("id",))
    ids = lambda clause: sorted(r.id for r in logs.search(clause).df.collect())
    day = {"gte": "2024-01-02", "lt": "2024-01-03"}
    assert ids({"range": {"at": day}}) == list(range(24, 48))
    assert ids({"range": {"at": {**day, "time_zone": "+02:00"}}}) == list(range(22, 46))
    assert ids({"range": {"at": {**day, "time_zone": "America/New_York"}}}) == list(range(29, 48))
    assert ids({"range": {"at": {"gte": 1704150000, "format": "epoch_second"}}}) == list(range(23, 48))
    for wrong in ({"gtee": 5}, {"gte": 1, "format": "dd/MM"}, {"gte": "2024-01-01", "time_zone": "Nowhere/Land"}):
        with pytest.raises(QueryError):
            logs.search({"range": {"at": wrong}})
    page = logs.search({"query": {"match_all": {}}, "size": 3, "from": 2, "track_total_hits": True})
    assert [r.id for r in page.top().df.collect()] == [45, 44, 43]
    for source, columns in (("id", ["id"]), (["id", "at"], ["id", "at"]), ({"excludes": ["secret"]}, ["id", "at", "user_id"])):
        assert logs.search({"query": {"match_all": {}}, "_source": source}).export().columns == columns


def test_tables_without_a_time_field(spark):
    logs = LogTable(spark.sql("SELECT id, 'i' AS _index FROM range(20)"), tie_break=("id",))
    assert [r.id for r in logs.top(3).df.collect()] == [0, 1, 2]
    assert sorted(r.id for r in logs.sample(2).df.collect()) == [0, 1]
    with pytest.raises(ValueError, match="no time field"):
        logs.between("2024-01-01")
    assert logs.between().df.count() == 20
