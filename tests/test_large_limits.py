"""First N rows for large N: ranges of the order against sorting everything."""

import math
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.operators import ordering
from emberlog.operators.ordering import Key

SCHEMA = "g string, t timestamp_ntz, s string, v double, n long, d date, b boolean, c decimal(9,2)"


@pytest.fixture(autouse=True)
def few_ranges(monkeypatch):
    monkeypatch.setattr(ordering, "RANGES", 16)
    monkeypatch.setattr(ordering, "LOOKED_AT", 128)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(9)
    data = [
        (
            rng.choices([None, "small", "hot"], [1, 2, 20])[0], rng.choice([None, *(datetime(2024, 1, k, 5) for k in range(1, 9))]), rng.choice([None, "", "a", "ab", "aé", "b", "ba"]),
            rng.choice([None, math.nan, math.inf, -math.inf, 0.0, -1.5, rng.uniform(-9, 9)]), rng.choice([None, 0, -1, 2**63 - 1, -(2**63), rng.randint(-99, 99)]),
            rng.choice([None, date(2024, 1, rng.randint(1, 5))]), rng.choice([None, True, False]), rng.choice([None, Decimal("1.50"), Decimal("-2.25")]),
        )
        for _ in range(900)
    ]
    return spark.createDataFrame(data + data[:50] + [data[0]] * 400, SCHEMA)


def orders():
    return [
        [Key(F.col("t"), True, False), Key(F.col("s"))], [Key(F.col("s"), True, True), Key(F.col("v"), True, False)], [Key(F.col("v"), False, False)],
        [Key(F.col("n"), True, False), Key(F.col("d"), True, True)], [Key(F.col("b"), True, False), Key(F.col("c"), True, False), Key(F.col("d"))], [],
    ]


@pytest.mark.parametrize("which", range(6))
@pytest.mark.parametrize("limit", [1, 675, 5000])
def test_first_rows_of_any_order(spark, rows, which, limit):
    keys = orders()[which]
    names = [f"k{i}" for i in range(len(keys))]
    shown = lambda df: [str(r) for r in df.select(*[k.column.alias(n) for n, k in zip(names, keys)] or [F.lit(1)]).collect()]
    got = ordering.first_rows_spread(rows, keys, limit)
    assert shown(got) == shown(rows.orderBy(*[k.sorted() for k in keys] or [F.lit(1)]).limit(limit))
    # Rows that are wholly alike are taken as often as they are there, never more.
    assert got.exceptAll(rows).count() == 0 and got.count() == min(limit, 1350)


@pytest.mark.parametrize("which", [0, 1, 5])
@pytest.mark.parametrize("limit", [30, 700])
def test_first_rows_of_every_group(spark, rows, which, limit):
    keys = orders()[which]
    got = ordering.first_rows_per_group(rows, F.col("g"), keys, limit)
    assert got.columns == rows.columns and got.exceptAll(rows).count() == 0
    for g in (None, "small", "hot"):
        own = rows.where(F.col("g").eqNullSafe(F.lit(g)))
        mine = got.where(F.col("g").eqNullSafe(F.lit(g)))
        wanted = own.orderBy(*[k.sorted() for k in keys] or [F.lit(1)]).limit(limit)
        for df in (mine, wanted):
            assert df.count() == min(limit, own.count())
        columns = [k.column for k in keys] or [F.lit(1)]
        assert sorted(map(str, mine.select(*columns).collect())) == sorted(map(str, wanted.select(*columns).collect()))


def test_rows_with_maps_and_no_hash_of_their_own(spark):
    df = spark.range(200).select(F.create_map(F.lit("k"), "id").alias("m"), (F.col("id") % 3).alias("n"))
    got = ordering.first_rows_spread(df, [Key(F.col("n"))], 100)
    assert got.schema["m"].dataType == T.MapType(T.StringType(), T.LongType(), False) and got.count() == 100
    assert [r.n for r in got.collect()] == [0] * 67 + [1] * 33


def test_nothing_runs_while_the_plan_is_built(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "building")
    ordering.first_rows_spread(rows, [Key(F.col("t"), True, False)], 10)
    ordering.first_rows_per_group(rows, F.col("g"), [Key(F.col("t"), True, False)], 10)
    assert not tracker.getJobIdsForGroup("plans")
    spark.sparkContext.setJobGroup("rest", "")


def test_no_task_merges_the_rows_of_a_large_sample(spark, rows):
    found = ordering.newest_per_index(rows.withColumnRenamed("g", "_index"), "t", ordering.LARGE_LIMIT + 1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in plan and found.count() == 1350


def test_places_in_the_order_are_found_by_generated_code(spark, rows):
    ranged = ordering._ranged(rows, [Key(F.col("n"), True, False)]).where("__range < 3")
    plan = ranged._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and len(plan) < 100_000  # no search by lambdas, none copied into the filter
    whole = ordering._ranged(rows, [Key(F.col("n"), True, False)]).orderBy("__order").select("__range").collect()
    assert [r[0] for r in whole] == sorted(r[0] for r in whole) and len({r[0] for r in whole}) == 16
