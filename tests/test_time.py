from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from emberlog.functions.timeexpr import normalize_time, resolve_range, resolve_time, rfc3339

NOW = datetime(2024, 3, 31, 15, 42, 7, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("now", "2024-03-31T15:42:07"),
        ("now-24h", "2024-03-30T15:42:07"),
        ("now-7d", "2024-03-24T15:42:07"),
        ("now-1M", "2024-02-29T15:42:07"),
        ("now+1y", "2025-03-31T15:42:07"),
        ("now/d", "2024-03-31T00:00:00"),
        ("now-1d/d", "2024-03-30T00:00:00"),
        ("now/w", "2024-03-25T00:00:00"),
        ("now/M", "2024-03-01T00:00:00"),
        ("now/h", "2024-03-31T15:00:00"),
        ("2023-01-01||+1M/d", "2023-02-01T00:00:00"),
        ("2023-01-01T00:00:00Z", "2023-01-01T00:00:00"),
        ("2023-01-01T02:00:00+02:00", "2023-01-01T00:00:00"),
        ("2023-01-01", "2023-01-01T00:00:00"),
        ("2023-01-01 10:30:00", "2023-01-01T10:30:00"),
        ("2023-01-01 10:30:00 UTC", "2023-01-01T10:30:00"),
        ("1640995200", "2022-01-01T00:00:00"),
        ("1640995200000", "2022-01-01T00:00:00"),
    ],
)
def test_bounds(text, expected):
    assert resolve_time(text, NOW) == datetime.fromisoformat(expected).replace(tzinfo=timezone.utc)


@pytest.mark.parametrize("text", ["invalid-time", "now-5x", "12", "2023", "2023-13-01", "20230101"])
def test_unsupported_bounds(text):
    with pytest.raises(ValueError):
        resolve_time(text, NOW)


def test_range_must_not_be_reversed():
    assert resolve_range(None, None) == (None, None)
    assert resolve_range("now-1h", None, NOW)[1] is None
    with pytest.raises(ValueError):
        resolve_range("2023-01-02", "2023-01-01")


def test_normalize_column(spark):
    cases = {
        "2023-01-01T00:00:00Z": "2023-01-01T00:00:00Z",
        "2023-01-01T00:00:00.123+01:00": "2022-12-31T23:00:00Z",
        "2023-01-01T05:06:07": "2023-01-01T05:06:07Z",
        "2023-01-01": "2023-01-01T00:00:00Z",
        "2023-01-01 10:11:12": "2023-01-01T10:11:12Z",
        "2023-01-01 10:11:12 MST": "2023-01-01T10:11:12Z",
        "1640995200": "2022-01-01T00:00:00Z",
        "1640995200000": "2022-01-01T00:00:00Z",
        "1000000000": None,
        "12": None,
        "2023-13-01": None,
        "2023": None,
        "invalid": None,
        "99999999999999999999999": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = dict(df.select("t", rfc3339(normalize_time(F.col("t")))).collect())
    assert got == cases
