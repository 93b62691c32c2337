import json

from pyspark.sql import functions as F

from emberlog import LogTable
from emberlog.operators import reshape
from emberlog.operators.views import COMBINED, PRESETS, View, view_named
from emberlog.sources import importer, sinks


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


def test_field_lists():
    assert reshape.parse_fields("a, b:c , d:, :x, e:f:g,") == (["a", "b", "d", "e"], {"b": "c", "e": "f:g"})
    assert reshape.parse_fields("") == ([], {})
    names = ["a.x", "a.y", "b"]
    assert reshape.pick_names(names, ["a.*", "!a.y"]) == ["a.x"]
    assert reshape.pick_names(names, ["!b"]) == ["a.x", "a.y"]
    assert reshape.pick_names(names, ["b", "missing", "a.x"]) == ["b", "a.x"]


def test_canonical_fields(spark):
    df = spark.createDataFrame(
        [(1, "", "s2", "n", "keep"), (2, "s1", "s2", None, "keep"), (3, None, "", "m", "")],
        "id int, first string, second string, ns string, pod string",
    )
    mapping = {"service": ["first", "second"], "namespace": ["ns"], "pod": ["pod"], "container": ["absent"]}
    got = rows(reshape.canonical_fields(df, mapping))
    assert got == [
        {"id": 1, "first": "", "second": None, "pod": "keep", "service": "s2", "namespace": "n"},
        {"id": 2, "first": None, "second": "s2", "pod": "keep", "service": "s1", "namespace": None},
        {"id": 3, "first": None, "second": "", "pod": None, "service": None, "namespace": "m"},
    ]


def test_envelope_never_overwrites(spark):
    df = spark.createDataFrame(
        [("a", "own", None, "host1", 1), (None, None, "2024-01-01T00:00:00Z", "", 5)],
        "id string, message string, timestamp string, h string, n long",
    )
    given = {"id": F.lit("new"), "message": F.lit("text"), "timestamp": F.lit("2023-05-05").cast("timestamp"), "host": "h", "count": "n"}
    got = rows(reshape.envelope(df, given).drop("h", "n"))
    assert {"id": "a", "message": "own", "timestamp": "2023-05-05T00:00:00Z", "host": "host1", "count": None} in got
    assert {"id": "new", "message": "text", "timestamp": "2024-01-01T00:00:00Z", "host": None, "count": 5} in got
    stamped = df.withColumn("@timestamp", F.lit("x")).drop("timestamp")
    assert "timestamp" not in reshape.envelope(stamped, given).columns


def test_json_fields(spark):
    df = spark.createDataFrame([('{"a":1}', "[1", 5)], "`x@json` string, `y@input` string, z int")
    got = reshape.parse_json_fields(df).select(
        F.to_json("`x@json`").alias("x"), F.to_json("`y@input`").alias("y"), "z"
    ).first()
    assert tuple(got) == ('{"a":1}', '"[1"', 5)


def test_views(spark):
    assert COMBINED.names() == [
        "@timestamp", "traceID", "spanID", "serviceName", "operationName", "duration", "error",
        "kubernetes.namespace", "kubernetes.pod.name", "kubernetes.container.name", "message", "level",
    ]
    assert PRESETS["k8s"] is PRESETS["filebeat"] and view_named("both") is COMBINED
    assert view_named("kubernetes").names()[0] == "timestamp"
    assert view_named("kubernetes", preset=True).names()[0] == "@timestamp"
    df = spark.createDataFrame([("7", "x", "")], "Pid string, `host_Hostname` string, message string")
    got = reshape.apply_view(df, view_named("syslog")).first()
    assert (got.pid, got.hostname, got.message, got.tag) == (7, "x", None, None)
    bad = spark.createDataFrame([("seven",)], "pid string")
    assert reshape.apply_view(bad, view_named("syslog")).first().pid is None
    own = View.of([{"name": "level", "style": "bold", "color_options": {"red": "BAD"}}])
    assert tuple(reshape.apply_view(spark.sql("SELECT 'bad' AS level"), own, colors=True).first()) == ("bad", "red")


def test_export_chain(spark):
    df = spark.createDataFrame(
        [(1, 1704067200000, "api", "ERROR"), (2, 1704070800000, "", "WARN"), (3, None, "web", "INFO")],
        "id int, startTimeMillis long, serviceName string, level string",
    )
    table = LogTable(df, tie_break=("id",))
    assert table.time_field == "startTimeMillis"
    got = [tuple(r) for r in table.export("id, timestamp, service, serviceName:svc, level:severity", limit=2).collect()]
    assert got == [(2, "2024-01-01T01:00:00Z", None, "", "WARN"), (1, "2024-01-01T00:00:00Z", "api", "api", "ERROR")]
    assert set(table.export().columns) == {"id", "startTimeMillis", "timestamp", "service", "level"}
    sourced = table.search({"query": {"match_all": {}}, "_source": ["id"], "size": 1})
    assert [tuple(r) for r in sourced.export().collect()] == [(2,)]
    assert [r.id for r in table.between("2024-01-01T00:30:00Z").df.collect()] == [2]
    assert table.warnings(pod="x", service="y") == [
        "Kubernetes pod filter 'x' cannot be applied - no suitable pod field found in generic logs"
    ]


def test_query_and_time_range_stay_apart(spark):
    """A `should` stays required when a time range or an entity is added."""
    df = spark.sql("SELECT * FROM VALUES (1, 'a', timestamp_ntz'2024-01-01'), (2, 'b', timestamp_ntz'2024-01-01') t(id, service, ts)")
    table = LogTable(df, "ts").search('{"bool": {"should": [{"term": {"service": "a"}}]}}')
    assert [r.id for r in table.between("2023-12-31", "2024-01-02").df.collect()] == [1]
    assert [r.id for r in table.where_entity(service="*").df.collect()] == [1]


def test_reference_style_bundle_file(spark, tmp_path):
    bundle = {
        "metadata": {"host": "h", "sample_size": 2},
        "indices": {
            "logs-1": {
                "name": "logs-1",
                "settings": {"index": {"uuid": "u", "number_of_shards": "1", "creation_date": "0"}, "other": 1},
                "mappings": {"properties": {"uid": {"type": "keyword"}, "message": {"type": "text"}}, "dynamic": True},
                "documents": [{"id": 1, "uid": "x", "data@json": '{"k": 2}'}, {"id": 2, "data@json": "nope"}],
                "count": 9,
            },
            "logs-2": {"name": "logs-2", "settings": {}, "mappings": {}},
        },
        "data": [{"id": 3}],
    }
    path = tmp_path / "bundle.json"
    path.write_text(json.dumps(bundle, indent=2))
    (tmp_path / "other.json").write_text('[{"id": 1}]')
    bundles = importer.read_bundle(spark, str(tmp_path))
    assert bundles.count() == 1
    shown = {r["_index"]: r for r in importer.bundle_indices(bundles).select(
        "_index", F.to_json(F.to_variant_object("settings")).alias("s"), F.to_json(F.to_variant_object("mappings")).alias("m"), "count"
    ).collect()}
    assert json.loads(shown["logs-1"].s) == {"index": {"number_of_shards": "1"}, "other": 1}
    assert json.loads(shown["logs-1"].m) == {"properties": {"message": {"type": "text"}}, "dynamic": True}
    assert shown["logs-1"]["count"] == 9
    documents = importer.bundle_documents(bundles).select("_index", importer.clean_document(F.col("doc")).alias("doc"))
    got = sorted(json.loads(r.doc)["id"] for r in documents.select(F.to_json("doc").alias("doc")).collect())
    assert got == [1, 2]
    parsed = {json.loads(r.d)["id"]: json.loads(r.d) for r in documents.select(F.to_json("doc").alias("d")).collect()}
    assert parsed[1] == {"id": 1, "data@json": {"k": 2}} and parsed[2]["data@json"] == "nope"
    data = importer.bundle_data(bundles).select("_index", F.try_variant_get("doc", "$.id", "int").alias("id"))
    assert sorted(map(tuple, data.collect())) == [("logs-1", 3), ("logs-2", 3)]


def test_document_files_and_names(spark, tmp_path):
    path = tmp_path / "My_Traces.v1.json"
    path.write_text('[\n {"id": 1},\n {"id": 2}\n]')
    documents = importer.read_documents(spark, str(path), array=True)
    named = importer.with_file_index(documents, "2024-01-31")
    assert sorted(map(tuple, named.select("id", "_index").collect())) == [
        (1, "my-traces.v1-2024-01-31"), (2, "my-traces.v1-2024-01-31"),
    ]


def test_index_is_appended_to_unless_forced(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "i")
    sinks.write_index(df, path)
    sinks.write_index(df, path)
    assert spark.read.parquet(path).count() == 6
    sinks.write_index(df, path, force=True)
    assert spark.read.parquet(path).count() == 3


def test_import_of_files_into_indices(spark, tmp_path):
    root = str(tmp_path / "indices")
    (tmp_path / "Old_Traces.json").write_text('[{"id": 1, "version": 3}, {"id": 2, "note": "two words"}]')
    mapping = importer.import_file(spark, str(tmp_path / "Old_Traces.json"), root, "2024-01-31")
    assert {(r._index, r.field, r.type) for r in mapping.collect()} == {
        ("old-traces-2024-01-31", "id", "keyword"), ("old-traces-2024-01-31", "note", "text"),
    }
    bundle = {"indices": {"a": {"documents": [{"x": 1}]}, "b": {"documents": []}}, "data": [{"x": 2}]}
    (tmp_path / "bundle.json").write_text(json.dumps(bundle))
    for force, expected in ((False, 3), (False, 6), (True, 3)):
        importer.import_file(spark, str(tmp_path / "bundle.json"), root, "2024-01-31", force)
        stored = spark.read.json(root)
        assert stored.where("_index IN ('a', 'b')").count() == expected
        assert stored.where("_index = 'old-traces-2024-01-31'").count() == 2


def test_bundle_round_trip(spark, tmp_path):
    df = spark.sql(
        "SELECT concat('i', id % 2) AS _index, id, named_struct('k', id) AS obj,"
        " timestamp_ntz'2024-01-01 00:00:00.123456' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts FROM range(9)"
    )
    sinks.write_bundle(df, str(tmp_path / "b"), "ts", 2, ["id"], metadata={"pattern": "i*"})
    bundles = importer.read_bundle(spark, str(tmp_path / "b"), whole_file=False)
    totals = {r["_index"]: r["count"] for r in importer.bundle_indices(bundles).collect()}
    assert totals == {"i0": 5, "i1": 4}
    first = json.loads(bundles.select(F.to_json("metadata").alias("m")).first().m)
    assert first["pattern"] == "i*" and first["sample_size"] == 2
    mapping = json.loads(bundles.select(F.to_json(F.map_values("indices")[0]["mappings"]).alias("m")).first().m)
    assert mapping["properties"]["obj"] == {"type": "object", "properties": {"k": {"type": "long"}}}
    doc = F.col("doc")
    got = importer.bundle_documents(bundles).select(
        "_index", F.try_variant_get(doc, "$.id", "int").alias("id"), F.try_variant_get(doc, "$.ts", "string").alias("ts")
    )
    assert sorted((r._index, r.id) for r in got.collect()) == [("i0", 6), ("i0", 8), ("i1", 5), ("i1", 7)]
    assert got.where("id = 8").first().ts == "2024-01-01T00:00:08.123456"


def test_csv_of_nested_rows(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, named_struct('b', 'x') AS a, array(1, 2) AS l, map('k', 'v') AS m")
    sinks.write_csv(df, str(tmp_path / "c"))
    row = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).first()
    assert row.asDict() == {"id": "1", "a.b": "x", "l": "[1,2]", "m": '{"k":"v"}'}


def test_partitioned_index_is_rebalanced(spark, tmp_path):
    df = spark.range(1000).withColumn("_index", F.when(F.col("id") < 900, "hot").otherwise("cold")).repartition(8)
    sinks.write_index(df, str(tmp_path / "i"), partition_by=["_index"])
    stored = spark.read.parquet(str(tmp_path / "i"))
    assert stored.count() == 1000
    files = list((tmp_path / "i").glob("_index=*/*.parquet"))
    assert len(files) <= 4


def test_records_with_a_label_map(spark):
    labels = {"fleet.namespace": "north", "shelf-life-of-item": "9 days", "note": "from a label"}
    df = spark.createDataFrame([(41, "crate opened", labels)], "crate int, note string, Tags map<string,string>")
    got = reshape.select_fields(df, ["Tags.shelf-life-of-item", "note"], {"Tags.shelf-life-of-item": "life"})
    assert got.first().asDict() == {"life": "9 days", "note": "crate opened"}
    wide = reshape.expand_labels(df, "Tags", ["fleet.namespace", "note", "absent"])
    assert wide.first().asDict() == {"crate": 41, "note": "crate opened", "fleet.namespace": "north", "absent": None}
    assert [r.crate for r in LogTable(wide, "ts").where_entity(namespace="north").df.collect()] == [41]
