import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from emberlog import LogTable
from emberlog.operators.ordering import newest_bulk, newest_per_index, sample_with_total
from emberlog.sources import indices

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


def column(spark, names, build):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    return dict(df.select("name", build(F.col("name"))).collect())


def test_dates_in_names(spark):
    cases = {
        "logstash-2024.01.15": "2024-01-15",
        "filebeat-2024-01-15": "2024-01-15",
        "logs-2024.01": "2024-01-01",
        "logs-2024-01": "2024-01-01",
        "logs20240115": "2024-01-15",
        "jaeger-span-2024.01.15": "2024-01-15",
        "logs-2024.13.45": None,
        "system-logs": None,
    }
    assert column(spark, cases, lambda n: indices.index_date(n).cast("string")) == cases
    ends = {"logs-2024.01": "2024-02-01", "logs20240131": "2024-02-01", "x": None}
    assert column(spark, ends, lambda n: indices.index_end(n).cast("string")) == ends


@pytest.mark.parametrize(
    "name, frm, to, inside",
    [
        ("logstash-2024.01.15", "2024-01-10", "2024-01-20", True),
        ("logstash-2024.01.05", "2024-01-10", "2024-01-20", False),
        ("logstash-2024.01.25", "2024-01-10", "2024-01-20", False),
        ("logstash-2024.01.05", None, "2024-01-20", True),
        ("logstash-2024.01.25", "2024-01-10", None, True),
        ("logstash-2024.01.15", None, None, True),
        ("system-logs", "2024-01-10", "2024-01-20", True),
        ("logs-2024.01", "2024-01-10", None, False),
    ],
)
def test_names_in_range(spark, name, frm, to, inside):
    build = lambda n: indices.dated_in_range(indices.index_date(n), frm, to, NOW)
    assert column(spark, [name], build) == {name: inside}


def test_patterns():
    names = ["b-1", "a-2", "a-1", ".a-0", "axb"]
    assert indices.resolve_indices(names, "a-*") == ["a-1", "a-2"]
    assert indices.resolve_indices(names, "*") == ["a-1", "a-2", "axb", "b-1"]
    assert indices.resolve_indices(names, "a.*") == []
    assert indices.resolve_indices(names, "other") == ["other"]


def test_folders_of_a_pattern(spark, tmp_path):
    for name, rows in {"logs-2024.01.01": [(1, "a")], "logs-2024.01.02": [(2, "b")], "web-1": [(3, "c")]}.items():
        spark.createDataFrame(rows, "id int, v string").write.parquet(str(tmp_path / name))
    found = indices.scan_folders(spark, str(tmp_path), "logs-*")
    assert sorted(map(tuple, found.select("_index", "id").collect())) == [("logs-2024.01.01", 1), ("logs-2024.01.02", 2)]
    union = indices.scan_pattern({"a-1": found.select("id"), "a-2": found.select("v"), "b": found}, "a-*")
    assert union.count() == 4 and set(union.columns) == {"_index", "id", "v"}


def _skewed(spark, rows=6000):
    """One index holds most rows; times repeat and are sometimes missing."""
    rng = random.Random(5)
    data = []
    for i in range(rows):
        name = "hot" if rng.random() < 0.7 else f"i{rng.randrange(5)}"
        at = None if rng.random() < 0.02 else datetime(2024, 1, 1 + rng.randrange(20), rng.randrange(24))
        data.append((name, i, at))
    return data, spark.createDataFrame(data, "_index string, id int, ts timestamp_ntz").repartition(7)


def _newest_of_each(data, limit):
    expected = set()
    for name in {row[0] for row in data}:
        mine = [row for row in data if row[0] == name]
        mine.sort(key=lambda r: (r[2] is None, -(r[2] or datetime(1970, 1, 1)).timestamp(), r[1]))
        expected.update((name, row[1]) for row in mine[:limit])
    return expected


def test_sample_of_a_hot_index_matches_brute_force(spark):
    data, df = _skewed(spark)
    for slices in (1, 3, None):
        got = newest_per_index(df, "ts", 25, ["id"], slices=slices)
        assert {(r._index, r.id) for r in got.collect()} == _newest_of_each(data, 25)
    totals = {(r._index, r.total) for r in sample_with_total(df, "ts", 25, ["id"]).collect()}
    assert totals == {(n, sum(1 for r in data if r[0] == n)) for n in {r[0] for r in data}}


@pytest.mark.parametrize("limit", [1001, 4150, 9000])
def test_large_samples_have_the_plan_of_small_ones(spark, limit):
    data, df = _skewed(spark)
    got = newest_per_index(df, "ts", limit, ["id"])
    assert got.columns == df.columns
    shown = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in shown  # the plan of small samples
    assert {(r._index, r.id) for r in got.collect()} == _newest_of_each(data, limit)


def test_pruned_scan_equals_full_scan_with_filter(spark, tmp_path):
    _, df = _skewed(spark)
    path = str(tmp_path / "t")
    df.withColumn("index_date", F.to_date("ts")).write.partitionBy("index_date").parquet(path)
    stored = spark.read.parquet(path)
    plain = LogTable(stored, "ts").between("2024-01-05T06:00:00Z", "2024-01-09T12:00:00Z").df
    pruned = LogTable(stored, "ts", date_partition="index_date").between("2024-01-05T06:00:00Z", "2024-01-09T12:00:00Z").df
    assert sorted(r.id for r in plain.collect()) == sorted(r.id for r in pruned.collect())
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(index_date" in plan and "2024-01-05" in plan


@pytest.mark.parametrize("limit", [1, 25, 700, 5000, 5990, 6000, 9000])
def test_bulk_limit_matches_brute_force(spark, limit):
    data, df = _skewed(spark)
    data.sort(key=lambda r: (r[2] is None, -(r[2] or datetime(1970, 1, 1)).timestamp(), r[1]))
    got = [r.id for r in newest_bulk(df, "ts", limit, ["id"]).select("id").collect()]
    assert got == [row[1] for row in data[:limit]]


def test_bulk_limit_on_epoch_millis(spark):
    df = spark.range(1000).select("id", (F.lit(1704067200000) + F.col("id") * 137).alias("startTimeMillis"))
    assert [r.id for r in newest_bulk(df, "startTimeMillis", 600).select("id").collect()] == list(range(999, 399, -1))
    table = LogTable(df)
    assert table.top(1_500_000).df.count() == 1000
