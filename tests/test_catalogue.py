import pytest
from pyspark.sql import functions as F

from emberlog.functions import classify as C
from emberlog.operators import catalogue as cat
from emberlog.operators import filters
from emberlog.operators.field_view import field_view

SCHEMA = "index string, field string, type string, pos int"


def catalogue(spark, indices):
    rows = []
    for index, fields in indices.items():
        items = fields.items() if isinstance(fields, dict) else ((f, None) for f in fields)
        rows += [(index, field, kind, pos) for pos, (field, kind) in enumerate(items)]
    return spark.createDataFrame(rows, SCHEMA)


def test_kinds(spark):
    cases = {
        "old-filebeat-7": (["note"], "kubernetes"),
        "shop-3": (["price", "kubernetes.container.name", "kubernetes.pod.name"], "kubernetes"),
        "one-field": (["price", "kubernetes.container.name"], "generic"),
        "eu-jaeger-dump": (["note"], "jaeger"),
        "shop-4": (["operationName", "SERVICENAME", "traceID", "price"], "jaeger"),
        "two-of-five": (["operationName", "traceID"], "generic"),
        "till": (["price", "note", "clerk"], "generic"),
        "weeks-1": (["a"], "kubernetes"),
        "k8s-traces": (["a"], "kubernetes"),
    }
    found = cat.detect_kind(catalogue(spark, {k: v[0] for k, v in cases.items()}))
    assert {r["index"]: r["kind"] for r in found.collect()} == {k: v[1] for k, v in cases.items()}


def test_time_fields(spark):
    cases = {
        "k8s-1": ({"@timestamp": "date", "message": "text"}, "@timestamp", True),
        "jaeger-1": ({"startTimeMillis": "date", "startTime": "date"}, "startTimeMillis", True),
        "jaeger-2": ({"startTimeMillis": "long", "startTime": "date"}, "startTime", True),
        "plain-1": ({"timestamp": "date", "message": "text"}, "timestamp", True),
        "plain-2": ({"timestamp": None}, "timestamp", True),
        "plain-3": ({"created": "date", "updated": "date"}, "created", True),
        "plain-4": ({"message": "text"}, "@timestamp", False),
        "jaeger-3": ({"message": "text"}, "startTimeMillis", False),
    }
    df = catalogue(spark, {k: v[0] for k, v in cases.items()})
    found = {r["index"]: (r.time_field, r.has_date) for r in cat.time_column(df).collect()}
    assert found == {k: (v[1], v[2]) for k, v in cases.items()}
    warned = {r["index"] for r in cat.index_health(df).collect() if r.warnings}
    assert warned == {"plain-4", "jaeger-3"}


ENTITY_CASES = [
    (
        ["fleet.namespace", "labels.fleet@namespace", "fleet.pod.name", "rollout_deployment", "gateway.service.name",
         "lastOperation"],
        {"namespace": ["fleet.namespace", "labels.fleet@namespace"], "pod": ["fleet.pod.name"],
         "deployment": ["rollout_deployment"], "service": ["gateway.service.name"], "operation": ["lastOperation"]},
    ),
    # Within one pattern the order of the fields stays.
    (
        ["service", "pod", "operation", "worker.namespace", "labels.worker@namespace", "namespace"],
        {"namespace": ["worker.namespace", "labels.worker@namespace", "namespace"], "pod": ["pod"],
         "service": ["service"], "operation": ["operation"]},
    ),
    (["cart_pod", "billing.service", "namespace"],
     {"namespace": ["namespace"], "pod": ["cart_pod"], "service": ["billing.service"]}),
    (["dc1_namespace_name", "dc1_pod_name", "dc1_deployment_name"],
     {"namespace": ["dc1_namespace_name"], "pod": ["dc1_pod_name"], "deployment": ["dc1_deployment_name"]}),
    (["emitter.serviceName", "emitter.label.dc@namespace@name", "emitter.label.dc@pod@name", "lastOperation", "requestID"],
     {"service": ["emitter.serviceName"], "namespace": ["emitter.label.dc@namespace@name"],
      "pod": ["emitter.label.dc@pod@name"], "operation": ["lastOperation"]}),
    # A whole-name match comes before a match of the beginning.
    (["ournamespace", "namespaces", "b.namespace.name"],
     {"namespace": ["ournamespace", "b.namespace.name", "namespaces"]}),
]


def test_entities_of_many_indices_and_of_one_schema(spark):
    df = catalogue(spark, {f"i{n}": fields for n, (fields, _) in enumerate(ENTITY_CASES)})
    found = {}
    for r in cat.entity_mapping(df).collect():
        found.setdefault(r["index"], {})[r.entity] = list(r.fields)
    for n, (fields, expected) in enumerate(ENTITY_CASES):
        assert found[f"i{n}"] == expected
        mine = {e: filters.entity_candidates(fields, e) for e in filters.ENTITIES}
        assert {e: names for e, names in mine.items() if names} == expected


def test_lookalikes(spark):
    df = catalogue(spark, {"a": ["app_g", "app_a", "app_b", "app_c", "app_d", "app_e", "k8s", "x"], "b": ["deployment"]})
    found = {(r["index"], r.entity): list(r.similar) for r in cat.similar_fields(df).collect()}
    assert found[("a", "deployment")] == ["app_a", "app_b", "app_c", "app_d", "app_e"]
    assert found[("a", "container")] == ["k8s"] and found[("a", "pod")] == []
    assert ("b", "deployment") not in found
    names = ["app_b", "x", "app_a"]
    lines = filters.filter_warnings(
        ["kubernetes.zone", "old_podlist", "my_service_map"],
        {"namespace": ["kubernetes.zone"]},
        {"namespace": "n", "pod": "till-7", "service": "s", "container": "c"}, "kubernetes",
    )
    assert lines == [
        "Kubernetes pod filter 'till-7' cannot be applied - no suitable pod field found in kubernetes logs."
        " Available similar fields: old_podlist",
        "Kubernetes container filter 'c' cannot be applied - no suitable container field found in kubernetes logs."
        " Available similar fields: kubernetes.zone",
        "OTEL service filter 's' cannot be applied - no suitable service field found in kubernetes logs."
        " Available similar fields: my_service_map",
    ]
    assert filters.unmapped_entities(names, {}, {"deployment": "d"}) == {"deployment": ["app_a", "app_b"]}


def test_mapping_from_documents(spark):
    docs = [
        '{"id": "x1", "provided_name": "p", "uid": 1, "version": 2, "message": "a message", "timestamp": "2023-01-01"}',
        '{"id": "x2", "data@json": "{}", "f1": "v", "f2": 123, "f3": true, "f4": 1.5, "obj": {"a": 1}, "list": [1]}',
        '{"f1": 7, "f2": 1.25, "startTimeMillis": 1, "none": null, "f4": null, "code": "é' + "é" * 26 + '"}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], "d string").select(F.parse_json("d").alias("doc"))
    found = {r.field: (r.type, r.format) for r in cat.infer_mapping(df).collect()}
    expected = {
        "id": "keyword", "message": "text", "timestamp": "date", "data@json": "object", "f1": "keyword",
        "f2": "double", "f3": "boolean", "f4": "double", "obj": "object", "list": "keyword", "none": "keyword",
        "code": "text",
    }
    assert found.pop("startTimeMillis") == ("date", "epoch_millis")
    assert found == {k: (v, None) for k, v in expected.items()}
    strict = {r.field: r.type for r in cat.infer_mapping(df, strict=True).collect()}
    assert strict["startTimeMillis"] == "long" and strict["timestamp"] == "keyword"


def test_mapping_of_a_table(spark):
    df = spark.createDataFrame([("k", "two words", 1, 2.5, True, None)], "a string, b string, c long, d double, e boolean, f string")
    found = {r.field: r.type for r in cat.infer_table_mapping(df).collect()}
    assert found == {"a": "keyword", "b": "text", "c": "long", "d": "double", "e": "boolean", "f": "keyword"}


def test_catalogue_of_nested_documents(spark):
    df = spark.sql("SELECT 'i' AS _index, parse_json('{\"a\":{\"b\":{\"c\":{\"e\":{\"f\":1}}}},\"d\":[{\"x\":1},{\"y\":{\"z\":true}}]}') AS doc")
    found = {r.field: r.type for r in cat.catalogue_of_documents(df).collect()}
    assert found == {
        "a": "object", "a.b": "object", "a.b.c": "object", "a.b.c.e": "object", "a.b.c.e.f": "long",
        "d": "nested", "d.x": "long", "d.y": "object", "d.y.z": "boolean",
    }


def test_catalogue_of_odd_documents(spark):
    docs = [
        ("i", r'{"q\"u":"a","b\\":{"c":"two words"},"e\\\"":1,"dot.ted":{"x.y":null},"_":"\\"}'),
        ("i", '{"q\\"u":5,"n":[],"m":[[{"z":1.5}],[{"z":"s"}]],"o":{},"p":[1,"two"],"q":[{"r":[{"s":true}]}]}'),
        ("i", '{"n":[{"k":"' + "x" * 51 + '"},{"k":"x"}],"k":"' + "x" * 50 + '","esc":"' + "\\n" * 50 + '"}'),
        ("j", '{"n":{"k":1}}'), ("j", '{"n":{"k":2.5}}'), ("j", "[1]"), ("j", "5"), ("j", "null"), ("j", "{}"),
        ("j", '{"caf\\u00e9":"' + "é" * 26 + '","日本":{"é":"' + "é" * 25 + '"},",":"a b,",":n":"ends with ,","x":",{","t":[true,false]}'),
    ]
    texts = spark.createDataFrame(docs, "_index string, doc string")
    spaced = texts.withColumn("doc", F.regexp_replace("doc", r'([{,\[:])(["{\[0-9])', "$1\n  $2"))
    variants = texts.withColumn("doc", F.parse_json("doc"))
    for df in (texts.union(spark.createDataFrame([("i", "{no json"), ("k", None)], texts.schema)), variants, spaced.where("doc NOT LIKE '%ends with%' AND _index = 'j'").union(texts.where("doc LIKE '%ends with%' OR _index = 'i'"))):
        check_odd_documents(df)


def check_odd_documents(df):
    found = {(r["index"], r.field): r.type for r in cat.catalogue_of_documents(df).collect()}
    assert found == {
        ("i", 'q"u'): "keyword", ("i", "b\\"): "object", ("i", "b\\.c"): "text", ("i", 'e\\"'): "long", ("i", "dot.ted"): "object",
        ("i", "dot.ted.x.y"): "keyword", ("i", "_"): "keyword", ("i", "n"): "nested", ("i", "n.k"): "text", ("i", "m"): "keyword",
        ("i", "m.z"): "keyword", ("i", "o"): "object", ("i", "p"): "keyword", ("i", "q"): "nested", ("i", "q.r"): "nested",
        ("i", "q.r.s"): "boolean", ("i", "k"): "keyword", ("i", "esc"): "keyword", ("j", "n"): "object", ("j", "n.k"): "double",
        ("j", "café"): "text", ("j", "日本"): "object", ("j", "日本.é"): "keyword", ("j", ","): "keyword", ("j", ":n"): "keyword",
        ("j", "x"): "keyword", ("j", "t"): "keyword",
    }


def test_catalogue_of_documents_with_dates(spark):
    df = spark.sql("SELECT 'i' AS _index, to_variant_object(named_struct('at', timestamp'2024-01-01 00:00:00', 'day', array(named_struct('d', date'2024-01-01')), 's', 'x y')) AS doc")
    found = {r.field: r.type for r in cat.catalogue_of_documents(df).collect()}
    assert found == {"at": "date", "day": "nested", "day.d": "date", "s": "text"}


def test_catalogue_of_tables(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('name', 'x') AS pod, array(named_struct('k', 1L)) AS tags, current_timestamp() AS ts")
    found = [(r.field, r.type) for r in cat.catalogue_of_tables({"t": df}).orderBy("pos").collect()]
    assert found == [
        ("id", "integer"), ("pod", "object"), ("pod.name", "keyword"), ("tags", "nested"), ("tags.k", "long"), ("ts", "date"),
    ]


@pytest.mark.parametrize(
    "field, kind, label, view_type, colors",
    [
        ("kubernetes.pod.uid", "keyword", "Pod UID", "string", None),
        ("kubernetes.labels.app", "keyword", "app", "string", None),
        ("kubernetes.container.image", "keyword", "Image", "string", None),
        ("kubernetes.replica_set", "keyword", "Replica Set", "string", None),
        ("tags.component", "keyword", "component", "string", None),
        ("process.tags.ip", "keyword", "ip", "string", None),
        ("db.type", "keyword", "DB Type", "string", None),
        ("rpc.service_name", "keyword", "RPC Service Name", "string", None),
        ("duration", "long", "Duration (μs)", "float", "duration"),
        ("span.kind", "keyword", "Kind", "string", "span_kind"),
        ("tags.error", "keyword", "Error", "boolean", "error"),
        ("request_count", "long", None, "int", "count"),
        ("request_count", "keyword", None, "string", None),
        ("response_time", "double", None, "float", "latency"),
        ("status", "keyword", None, "string", "status"),
        ("active", "boolean", None, "boolean", "boolean"),
    ],
)
def test_view_columns(spark, field, kind, label, view_type, colors):
    row = field_view(catalogue(spark, {"i": {field: kind}})).first()
    assert (row.label, row.view_type, row.colors) == (label, view_type, colors)


def test_color_classes(spark):
    df = spark.createDataFrame([("error", 99_999, 404, "true"), ("Trace", 1_000_000, 600, None)], "l string, d long, s int, e string")
    got = df.select(
        C.color_class(F.col("l"), C.SEVERITY), C.color_class(F.col("d"), C.DURATION_MICROS),
        C.color_class(F.col("s"), C.HTTP_STATUS), C.color_class(F.col("e"), C.ERROR_FLAG),
    ).collect()
    assert [tuple(r) for r in got] == [("red", "green", "orange", "red"), ("blue", "red", None, None)]
