"""Aggregation bodies: metrics, buckets, buckets within buckets.

Every bucket kind is a grouping key, every metric an aggregate over it, so one
level of a body is one `groupBy().agg()` with map-side combining.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import Fields, quoted
from emberlog.functions.timeexpr import resolve_time, time_literal
from emberlog.operators import predicates as P
from emberlog.operators.dsl import QueryError, compile_query

DEFAULT_BUCKETS = 10
DEFAULT_PERCENTS = (1, 5, 25, 50, 75, 95, 99)
_CALENDAR = {
    "1s": "second", "second": "second", "1m": "minute", "minute": "minute", "1h": "hour", "hour": "hour",
    "1d": "day", "day": "day", "1w": "week", "week": "week", "1M": "month", "month": "month",
    "1q": "quarter", "quarter": "quarter", "1y": "year", "year": "year",
}
_FIXED_MILLIS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def _sub(spec: dict) -> dict:
    return spec.get("aggs") or spec.get("aggregations") or {}


def _kind(spec: dict) -> tuple[str, dict]:
    kinds = [k for k in spec if k not in ("aggs", "aggregations", "meta")]
    if len(kinds) != 1:
        raise QueryError(f"an aggregation has exactly one kind, got {kinds}")
    _checked(kinds[0], spec[kinds[0]])
    return kinds[0], spec[kinds[0]]


# Options of every kind; those after the bar change no bucket and no value.
_OPTIONS = {
    "terms": "field size order min_doc_count include exclude missing | shard_size shard_min_doc_count show_term_doc_count_error execution_hint collect_mode value_type",
    "histogram": "field interval offset min_doc_count extended_bounds hard_bounds missing | keyed",
    "date_histogram": "field calendar_interval fixed_interval interval time_zone offset min_doc_count extended_bounds hard_bounds missing | keyed format",
    "range": "field ranges missing | keyed", "filters": "filters | keyed",
    "cardinality": "field missing exact | precision_threshold", "percentiles": "field missing percents accuracy exact | keyed tdigest hdr",
    **{kind: "field missing" for kind in ("avg", "sum", "min", "max", "value_count", "stats")},
}


def _checked(kind: str, body: dict) -> None:
    if kind in _OPTIONS and set(body) - set(_OPTIONS[kind].replace("|", " ").split()):
        raise QueryError(f"unknown option of {kind}: {sorted(set(body) - set(_OPTIONS[kind].split()))}")


def _column(fields: Fields, body: dict) -> Column:
    field = fields.find(body["field"])
    if field is None:
        raise QueryError(f"no field {body['field']!r}")
    if "missing" in body:
        return F.coalesce(field.column, F.lit(body["missing"]))
    return field.column


# ----------------------------------------------------------------- metrics


def metric_columns(fields: Fields, name: str, kind: str, body: dict, guard: Column | None = None) -> list[Column]:
    """The output columns of one metric, named after the metric, over the rows `guard` lets in."""
    value = _column(fields, body)
    if guard is not None:
        value = F.when(guard, value)
    one = {
        "avg": lambda: F.avg(value),
        "sum": lambda: F.sum(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "value_count": lambda: F.count(value),
        # Sketches merge in any order and size; exact counts need every distinct value shuffled.
        "cardinality": lambda: F.count_distinct(value) if body.get("exact") else F.approx_count_distinct(value),
    }
    if kind in one:
        return [one[kind]().alias(name)]
    if kind == "stats":
        return [
            F.count(value).alias(f"{name}_count"),
            F.min(value).alias(f"{name}_min"),
            F.max(value).alias(f"{name}_max"),
            F.avg(value).alias(f"{name}_avg"),
            F.sum(value).alias(f"{name}_sum"),
        ]
    if kind == "percentiles":
        # A mergeable sketch: rank error is at most rows / accuracy.
        percents = body.get("percents", DEFAULT_PERCENTS)
        shares = [percent / 100 for percent in percents]
        if body.get("exact"):
            found = F.percentile(value, F.array(*map(F.lit, shares)))
        else:
            found = F.percentile_approx(value, shares, int(body.get("accuracy", 10_000)))
        return [F.get(found, k).alias(f"{name}_{str(percent).replace('.', '_')}") for k, percent in enumerate(percents)]
    raise QueryError(f"unknown aggregation {kind!r}")


_METRICS = {"avg", "sum", "min", "max", "value_count", "cardinality", "stats", "percentiles"}


# ----------------------------------------------------------------- buckets


def _key(name: str) -> Column:
    """The bucket key of a level on the rows, apart from any field of the same name."""
    return quoted(f"__{name}")


def _keys(names: list[str]) -> list[Column]:
    return [_key(name).alias(name) for name in names]


def _range_label(bounds: dict) -> str:
    return bounds.get("key") or f"{bounds.get('from', '*')}-{bounds.get('to', '*')}"


def _bucket_key(fields: Fields, kind: str, body: dict) -> Column:
    if kind == "terms":
        return _column(fields, body)
    if kind == "histogram":
        step, offset = body["interval"], body.get("offset", 0)
        return F.floor((_column(fields, body) - F.lit(offset)) / F.lit(step)) * F.lit(step) + F.lit(offset)
    if kind == "date_histogram":
        return _time_bucket(fields, body)
    raise QueryError(f"unknown aggregation {kind!r}")


_UNIT_MILLIS = {"second": 1000, "minute": 60_000, "hour": 3_600_000}


def _millis(text: str) -> int:
    """`6h`, `-1d`, `+30m`."""
    found = re.fullmatch(r"([+-]?)(\d+)(ms|s|m|h|d)", str(text))
    if not found:
        raise QueryError(f"no interval: {text!r}")
    return int(found[1] + found[2]) * _FIXED_MILLIS[found[3]]


@dataclass(frozen=True)
class Buckets:
    """Buckets of a time: by calendar in a zone, or of a fixed width; `offset` milliseconds later than usual.

    Days and more are cut in local time; hours and less in world time, at the zone's full hours, so that an
    hour that comes twice has two buckets.
    """

    unit: str | None
    step: int | None
    zone: str
    offset: int

    @classmethod
    def of(cls, body: dict) -> Buckets:
        interval = body.get("calendar_interval") or body.get("fixed_interval") or body.get("interval")
        unit = _CALENDAR.get(interval) if "fixed_interval" not in body else None
        if interval is None or (unit is None and "calendar_interval" in body):
            raise QueryError(f"unknown interval {interval!r}")
        step = _UNIT_MILLIS.get(unit) if unit else _millis(interval)
        return cls(None if step else unit, step, str(body.get("time_zone", "UTC")), _millis(body.get("offset", "0ms")))

    def _local(self, at: Column) -> Column:
        return at if self.zone == "UTC" else F.from_utc_timestamp(at, self.zone)

    def _world(self, at: Column) -> Column:
        return at if self.zone == "UTC" else F.to_utc_timestamp(at, self.zone)

    def _moved(self, at: Column, millis: int) -> Column:
        return at if not millis else F.timestamp_micros(F.unix_micros(at) + millis * 1000)

    def key(self, at: Column) -> Column:
        """The start of the bucket of a timestamp."""
        if self.unit:
            return self._world(self._moved(F.date_trunc(self.unit, self._moved(self._local(at), -self.offset)), self.offset))
        into = F.pmod(F.unix_millis(self._local(at)) - self.offset, F.lit(self.step))
        return F.timestamp_millis(F.unix_millis(at) - into)

    def between(self, first: Column, last: Column) -> Column:
        """The starts of all buckets from one to another."""
        if self.unit:
            low, high = (self._moved(self._local(x), -self.offset) for x in (first, last))
            starts = F.sequence(low, high, F.expr("INTERVAL 3 MONTH" if self.unit == "quarter" else f"INTERVAL 1 {self.unit.upper()}"))
            return F.array_distinct(F.transform(starts, lambda x: self._world(self._moved(x, self.offset))))
        return F.transform(F.sequence(F.unix_millis(first), F.unix_millis(last), F.lit(self.step).cast("bigint")), F.timestamp_millis)


def _instants(fields: Fields, body: dict) -> tuple[Column, T.DataType]:
    field = fields.find(body["field"])
    at = F.timestamp_millis(field.column) if field.epoch_millis else field.column.cast("timestamp")
    if "missing" in body:
        at = F.coalesce(at, _instant(fields, body["missing"]))
    return at, field.dtype


def _instant(fields: Fields, value) -> Column:
    return time_literal(resolve_time(value, fields.now), T.TimestampType())


def _time_bucket(fields: Fields, body: dict) -> Column:
    if fields.find(body["field"]) is None:
        raise QueryError(f"no field {body['field']!r}")
    at, dtype = _instants(fields, body)
    bucket = Buckets.of(body).key(at)
    return bucket.cast("timestamp_ntz") if isinstance(dtype, T.TimestampNTZType) else bucket


def _within(fields: Fields, kind: str, body: dict) -> Column:
    """Rows whose value lies in the `hard_bounds`, ends included."""
    bounds = body.get("hard_bounds") or {}
    if kind == "date_histogram":
        value, bound = _instants(fields, body)[0], lambda v: _instant(fields, v)
    else:
        value, bound = _column(fields, body), F.lit
    tests = [value >= bound(bounds["min"])] if "min" in bounds else []
    return P.all_of(tests + ([value <= bound(bounds["max"])] if "max" in bounds else []))


def _listed_terms(key: Column, body: dict) -> Column:
    """Terms that `include` lets in and `exclude` doesn't keep out: lists of values, or patterns for whole terms."""

    def among(wanted) -> Column:
        if isinstance(wanted, (list, tuple)):
            return key.cast("string").isin(*[str(v).lower() if isinstance(v, bool) else str(v) for v in wanted]) if wanted else P.never()
        if not isinstance(wanted, str):
            raise QueryError(f"terms are let in by a list or a pattern, not {wanted!r}")
        return key.cast("string").rlike(f"^(?:{wanted})$")

    tests = [among(body["include"])] if "include" in body else []
    return P.all_of(tests + ([~among(body["exclude"])] if "exclude" in body else []))


def _dense(counted: DataFrame, fields: Fields, outer: list[str], name: str, kind: str, body: dict, zero: list[str]) -> DataFrame:
    """Buckets without rows too, from the first to the last within each bucket of the level above, or between the `extended_bounds`."""
    key, bounds = quoted(name), body.get("extended_bounds") or {}
    low, high = F.min(key), F.max(key)
    if kind == "histogram":
        step, offset = body["interval"], body.get("offset", 0)
        number = lambda v: F.floor((F.lit(v) - F.lit(offset)) / F.lit(step))
        place = F.round((key - F.lit(offset)) / F.lit(step)).cast("bigint")
        low, high = F.min(place), F.max(place)
        if "min" in bounds:
            low, high = F.least(low, number(bounds["min"])), F.greatest(high, number(bounds["max"]) if "max" in bounds else low)
        elif "max" in bounds:
            high = F.greatest(high, number(bounds["max"]))
        ends = counted.groupBy(*map(quoted, outer)).agg(low.alias("__low"), high.alias("__high")).where("__low is not null")
        starts = F.transform(F.sequence("__low", "__high"), lambda k: (k * F.lit(step) + F.lit(offset)).cast(counted.schema[name].dataType))
    else:
        buckets, dtype = Buckets.of(body), counted.schema[name].dataType
        low, high = low.cast("timestamp"), high.cast("timestamp")
        if "min" in bounds:
            low = F.least(low, buckets.key(_instant(fields, bounds["min"])))
        if "max" in bounds:
            high = F.greatest(high, buckets.key(_instant(fields, bounds["max"])))
        ends = counted.groupBy(*map(quoted, outer)).agg(low.alias("__low"), high.alias("__high")).where("__low <= __high")
        starts = F.transform(buckets.between(F.col("__low"), F.col("__high")), lambda k: k.cast(dtype))
    every = ends.select(*map(quoted, outer), F.explode(starts).alias(name))
    full = every.join(counted, [*outer, name], "left")
    return full.select(*[F.coalesce(quoted(c), F.lit(0)).alias(c) if c == "doc_count" or c in zero else quoted(c) for c in counted.columns])


def _zero_columns(metrics: dict) -> list[str]:
    """Metrics that are 0, not missing, where there are no rows."""
    names = []
    for name, spec in metrics.items():
        kind, _ = _kind(spec)
        names += [name] if kind in ("sum", "value_count", "cardinality") else [f"{name}_count", f"{name}_sum"] if kind == "stats" else []
    return names


def _labelled(fields: Fields, kind: str, body: dict) -> list[tuple[object, Column]]:
    """Label and condition of every bucket, for kinds that list their buckets."""
    if kind == "filter":
        return [(True, compile_query(fields, body).matches)]
    if kind == "filters":
        given = body["filters"]
        listed = given.items() if isinstance(given, dict) else ((str(i), q) for i, q in enumerate(given))
        return [(label, compile_query(fields, q).matches) for label, q in listed]
    field = fields.find(body["field"])
    if field is None:
        raise QueryError(f"no field {body['field']!r}")
    ends = (("from", "gte"), ("to", "lt"))
    return [
        (
            _range_label(bounds),
            P.range_of(field, {op: bounds[end] for end, op in ends if bounds.get(end) is not None}, fields.now)
            & field.column.isNotNull(),
        )
        for bounds in body["ranges"]
    ]


_LISTED = {"range", "filters", "filter"}
_BUCKETS = {"terms", "histogram", "date_histogram"} | _LISTED


def aggregate(df: DataFrame, aggs: dict, fields: Fields | None = None) -> dict[str, DataFrame]:
    """One DataFrame per bucket aggregation, plus `metrics` for all plain metrics together.

    Buckets within buckets are named by their path, `outer>inner`, and have the keys of
    every level as columns.
    """
    fields = fields or Fields.of(df)
    frames: dict[str, DataFrame] = {}
    metrics = []
    for name, spec in aggs.items():
        kind, body = _kind(spec)
        if kind in _METRICS:
            metrics.extend(metric_columns(fields, name, kind, body))
        elif kind in _BUCKETS:
            _buckets(df, fields, [], None, name, spec, frames)
        else:
            raise QueryError(f"unknown aggregation {kind!r}")
    if metrics:
        frames["metrics"] = df.agg(*metrics)
    return frames


def _buckets(
    rows: DataFrame, fields: Fields, outer: list[str], kept: DataFrame | None, name: str, spec: dict, frames: dict
) -> None:
    """Adds the frame of one bucket aggregation and of those below it.

    `outer` names the levels above, whose keys `rows` has as columns; `kept` holds
    the buckets of the level above where that level was cut to size.
    """
    kind, body = _kind(spec)
    below = {n: s for n, s in _sub(spec).items() if _kind(s)[0] in _BUCKETS}
    metrics = {n: s for n, s in _sub(spec).items() if n not in below}
    counted = (_listed if kind in _LISTED else _grouped)(rows, fields, outer, name, kind, body, metrics)
    if kept is not None:
        counted = counted.join(kept.select(*[quoted(k) for k in outer]), outer, "left_semi")
    if int(body.get("min_doc_count", 1)) > 1:
        counted = counted.where(F.col("doc_count") >= int(body["min_doc_count"]))
    if kind in ("histogram", "date_histogram") and str(body.get("min_doc_count", 1)) == "0":
        counted = _dense(counted, fields, outer, name, kind, body, _zero_columns(metrics))
    cut = _cut(counted, outer, name, kind, body)
    frames[">".join([*outer, name])] = cut
    if not below:
        return
    if kind in _LISTED:
        labels = F.array(*[F.when(holds, F.lit(label)) for label, holds in _labelled(fields, kind, body)])
        keyed = rows.withColumn(f"__{name}", F.explode(F.array_compact(labels)))
    else:
        keyed = _with_key(rows, fields, name, kind, body)
    cut_above = kind == "terms" or kept is not None or int(body.get("min_doc_count", 1)) > 1
    for inner, inner_spec in below.items():
        _buckets(keyed, fields, [*outer, name], cut if cut_above else None, inner, inner_spec, frames)


def _with_key(rows: DataFrame, fields: Fields, name: str, kind: str, body: dict) -> DataFrame:
    key = _bucket_key(fields, kind, body)
    found = fields.find(body["field"])
    if kind == "terms" and found is not None and isinstance(found.dtype, T.ArrayType):
        key = F.explode(F.array_distinct(key))
    if "hard_bounds" in body:
        rows = rows.where(_within(fields, kind, body))
    keyed = rows.withColumn(f"__{name}", key).where(_key(name).isNotNull())
    return keyed.where(_listed_terms(_key(name), body)) if {"include", "exclude"} & set(body) else keyed


def _metrics_of(fields: Fields, metrics: dict, guard: Column | None = None) -> list[Column]:
    wanted = []
    for name, spec in metrics.items():
        kind, body = _kind(spec)
        wanted.extend(metric_columns(fields, name, kind, body, guard))
    return wanted


def _grouped(rows, fields, outer, name, kind, body, metrics) -> DataFrame:
    keyed = _with_key(rows, fields, name, kind, body)
    counts = F.count(F.lit(1)).alias("doc_count")
    return keyed.groupBy(*_keys([*outer, name])).agg(counts, *_metrics_of(fields, metrics))


def _listed(rows, fields, outer, name, kind, body, metrics) -> DataFrame:
    """Buckets that are listed in the request: one conditional aggregate each, so rows are
    neither copied nor shuffled by bucket, and empty buckets count zero."""
    wanted, shown = [], []
    for i, (label, holds) in enumerate(_labelled(fields, kind, body)):
        columns = [F.count_if(holds).alias("doc_count"), *_metrics_of(fields, metrics, holds)]
        wanted.append(F.struct(*columns).alias(f"__{i}"))
        shown.append(F.struct(F.lit(label).alias(name), F.col(f"__{i}.*")))
    return rows.groupBy(*_keys(outer)).agg(*wanted).select(*[quoted(k) for k in outer], F.inline(F.array(*shown)))


def _cut(counted: DataFrame, outer: list[str], name: str, kind: str, body: dict) -> DataFrame:
    """Buckets in order; `terms` keep the first `size`, within each bucket of the level above.

    The window runs over finished buckets, never over rows.
    """
    if kind != "terms":
        return counted if kind in _LISTED else counted.orderBy(*[quoted(k) for k in [*outer, name]])
    size = int(body.get("size", DEFAULT_BUCKETS))
    order = _terms_order(name, body)
    if not outer:
        return counted.orderBy(*order).limit(size)
    rank = F.row_number().over(Window.partitionBy(*[quoted(k) for k in outer]).orderBy(*order))
    return counted.withColumn("__rank", rank).where(F.col("__rank") <= size).drop("__rank")


def _terms_order(name: str, body: dict) -> list[Column]:
    """Largest bucket first and equal ones by key, unless `order` says otherwise."""
    order = body.get("order", {"_count": "desc"})
    keys = []
    for by, direction in (order.items() if isinstance(order, dict) else [p for o in order for p in o.items()]):
        column = F.col("doc_count") if by == "_count" else quoted(name) if by == "_key" else quoted(by)
        keys.append(column.desc() if direction == "desc" else column.asc())
    return keys + [quoted(name).asc()]


def total_hits(df: DataFrame) -> DataFrame:
    """The exact number of rows."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def totals_per_index(df: DataFrame, index: str = "_index") -> DataFrame:
    """Rows per index and, under `_all`, over all of them (a roll-up of the finished counts)."""
    key = Fields.of(df).find(index).column
    counts = df.groupBy(key.alias("_index")).agg(F.count(F.lit(1)).alias("n"))
    rolled = counts.rollup("_index").agg(F.sum("n").alias("total"), F.grouping_id().alias("all"))
    label = F.when(F.col("all") == 1, F.lit("_all")).otherwise(F.col("_index"))
    return rolled.select(label.alias("_index"), "total")
