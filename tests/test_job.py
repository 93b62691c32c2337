import json

import pytest

from emberlog import job


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("indices")
    for day in (1, 2, 3):
        rows = spark.sql(
            f"SELECT id, concat('message ', id) AS message, if(id % 2 = 0, 'ERROR', 'INFO') AS level,"
            f" concat('ns-', id % 3) AS kubernetes_namespace_name,"
            f" timestamp_ntz'2024-01-0{day} 00:00:00' + make_interval(0, 0, 0, 0, id) AS timestamp FROM range(10)"
        )
        rows.write.parquet(str(folder / f"app-2024.01.0{day}"))
    return folder


def run(*argv):
    job.main(list(map(str, argv)))


def test_export_to_csv(spark, root, tmp_path):
    run("export", "--root", root, "--index", "app-*", "--query", "level:ERROR AND message:message", "--from", "2024-01-02",
        "--to", "2024-01-02T23:59:59Z", "--namespace", "ns-0", "--fields", "id,level:severity,namespace", "--format", "csv",
        "--output", tmp_path / "out", "--tie-break", "id")
    got = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert got.columns == ["id", "severity", "namespace"]
    assert [tuple(r) for r in got.collect()] == [("6", "ERROR", "ns-0"), ("0", "ERROR", "ns-0")]


def test_export_of_a_body_with_limit_and_view(spark, root, tmp_path, capsys):
    body = tmp_path / "q.json"
    body.write_text(json.dumps({"query": {"bool": {"must": [{"match": {"level": "INFO"}}]}}, "size": 4}))
    run("export", "--root", root, "--index", "app-2024.01.03", "--query-file", body, "--view", "kubernetes",
        "--output", tmp_path / "out", "--pod", "x")
    got = spark.read.json(str(tmp_path / "out"))
    assert got.count() == 4 and {r.level for r in got.collect()} == {"INFO"}
    assert got.agg({"timestamp": "max"}).first()[0] == "2024-01-03 09:00:00"
    assert "Kubernetes pod filter 'x' cannot be applied" in capsys.readouterr().err


def test_export_of_aggregations(spark, root, tmp_path):
    run("export", "--root", root, "--index", "app-*", "--output", tmp_path / "out",
        "--query", '{"aggs": {"levels": {"terms": {"field": "level"}}, "ids": {"max": {"field": "id"}}}}')
    levels = {r.levels: r.doc_count for r in spark.read.json(str(tmp_path / "out" / "levels")).collect()}
    assert levels == {"ERROR": 15, "INFO": 15}
    assert spark.read.json(str(tmp_path / "out" / "metrics")).first().ids == 9


def test_sample_and_import(spark, root, tmp_path):
    run("sample", "--root", root, "--index", "app-*", "--sample-size", 2, "--output", tmp_path / "s")
    documents = spark.read.json(str(tmp_path / "s" / "documents"))
    assert documents.groupBy("_index").count().where("count = 2").count() == 3
    metadata = spark.read.json(str(tmp_path / "s" / "metadata")).first()
    assert (metadata["count"], metadata.pattern, metadata.sample_size) == (10, "app-*", 2)
    (tmp_path / "one.json").write_text('[{"id": 5}]')
    run("import", "--samples", tmp_path / "one.json", "--root", tmp_path / "in", "--day", "2024-02-01")
    assert spark.read.json(str(tmp_path / "in")).first()["_index"] == "one-2024-02-01"


def test_sample_import_export(spark, root, tmp_path):
    run("sample", "--root", root, "--index", "app-*", "--sample-size", 7, "--output", tmp_path / "s")
    run("import", "--samples", tmp_path / "s", "--root", tmp_path / "in", "--force")
    run("export", "--root", tmp_path / "in", "--index", "app-*", "--input-format", "imported", "--time-field", "timestamp",
        "--fields", "id,level,_index", "--output", tmp_path / "out")
    got = spark.read.json(str(tmp_path / "out"))
    assert got.count() == 21 and got.select("_index").distinct().count() == 3


def test_files_are_judged_one_by_one(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.json").write_text('[\n {"id": 1},\n {"id": 2}\n]')
    (folder / "b.json").write_text('{"id": 3}\n\n{"id": 4}\n')
    (folder / "c.json").write_text(json.dumps({"indices": {"x": {"documents": [{"id": 5}], "mappings": {"properties": {"id": {"type": "keyword"}}}}}, "data": [{"id": 6}]}))
    run("import", "--samples", folder, "--root", tmp_path / "in", "--day", "2024-02-01")
    from emberlog.sources.importer import scan_imported

    got = {(r._index, r.id) for r in scan_imported(spark, str(tmp_path / "in"), "*").collect()}
    assert got == {("a-2024-02-01", "1"), ("a-2024-02-01", "2"), ("b-2024-02-01", "3"), ("b-2024-02-01", "4"), ("x", "5"), ("x", "6")}
    (folder / "d.json").write_text('{"id": ')
    with pytest.raises(ValueError, match="d.json"):
        run("import", "--samples", folder, "--root", tmp_path / "in2")


def test_fields_that_a_given_mapping_leaves_out_stay(spark, tmp_path):
    doc = {"id": 5, "level": "INFO", "took": 1.5}
    (tmp_path / "b.json").write_text(json.dumps({"indices": {"x": {"documents": [doc], "mappings": {"properties": {"id": {"type": "keyword"}}}}}}))
    run("import", "--samples", tmp_path / "b.json", "--root", tmp_path / "in", "--day", "2024-02-01")
    from emberlog.sources.importer import scan_imported

    assert scan_imported(spark, str(tmp_path / "in"), "x").first().asDict() == {"_index": "x", "id": "5", "level": "INFO", "took": 1.5}


def test_export_from_date_partitions(spark, tmp_path):
    rows = spark.sql(
        "SELECT id, 'm' AS message, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id) AS timestamp,"
        " date_add(date'2024-01-01', CAST(id AS INT)) AS index_date FROM range(10)"
    )
    rows.write.partitionBy("index_date").parquet(str(tmp_path / "in" / "logs-1"))
    run("export", "--root", tmp_path / "in", "--index", "logs-*", "--from", "2024-01-04", "--to", "2024-01-05",
        "--date-partition", "index_date", "--fields", "id,_index", "--output", tmp_path / "out")
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "out")).select("id", "_index").orderBy("id").collect()] == [
        (3, "logs-1"), (4, "logs-1"),
    ]


def test_a_line_of_a_bundle_holds_many_documents_whatever_the_limit(spark, tmp_path):
    from emberlog.sources import importer, sinks

    rows = spark.range(3000).selectExpr("'logs' as _index", "id", "timestamp_ntz'2024-01-01' as t")
    sinks.write_bundle(rows, str(tmp_path / "bundle"), "t", 2_000_000_000, ["id"])
    assert spark.read.text(str(tmp_path / "bundle")).count() <= 3
    assert importer.documents_of(spark, str(tmp_path / "bundle"), "2024-01-31").count() == 3000
    sinks.write_bundle(rows, str(tmp_path / "small"), "t", 10, ["id"])
    assert importer.documents_of(spark, str(tmp_path / "small"), "2024-01-31").count() == 10


def test_an_import_reads_its_source_once_and_leaves_nothing_hidden(spark, tmp_path):
    from emberlog.sources import importer

    source, root = tmp_path / "logs.json", tmp_path / "root"
    source.write_text('{"n": 1.0, "code": "a"}\n{"n": 2, "uid": "x"}\n')
    for force in (False, False, True):
        mapping = importer.import_file(spark, str(source), str(root), "2024-01-31", force)
        # Before, the names of the indices were worked out again from the source whenever the mapping was read.
        assert not [name for name in mapping.inputFiles() if name.endswith("/logs.json")]
        assert sorted((r.field, r.type) for r in mapping.collect())[0] == ("code", "keyword")
        assert not list(root.glob(".cleaned*"))
