"""Queries on aggregations, order, limits and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from emberlog.functions.fields import Fields
from emberlog.logtable import LogTable
from emberlog.operators import aggregations, catalogue, ordering
from emberlog.operators.dsl import Body
from emberlog.plans.adapters import SQL_EVENTS_LOG, events_log
from emberlog.plans.registry import query, table
from emberlog.session import spread
from emberlog.sources import indices


@query("SELECT user_id AS users, count(*) AS doc_count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def agg_terms(spark, d):
    return aggregations.aggregate(table(spark, d, "events"), {"users": {"terms": {"field": "user_id"}}})["users"]


@query("SELECT round(avg(value), 6) AS avg_value FROM events")
def agg_avg(spark, d):
    found = aggregations.aggregate(table(spark, d, "events"), {"avg_value": {"avg": {"field": "value"}}})["metrics"]
    return found.select(F.round("avg_value", 6).alias("avg_value"))


@query("""
SELECT 'status_codes' AS agg, o_orderstatus AS bucket, count(*) AS doc_count, CAST(NULL AS DOUBLE) AS metric
FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'avg_price', NULL, NULL, round(avg(o_totalprice), 4) FROM orders
UNION ALL SELECT 'max_price', NULL, NULL, round(max(o_totalprice), 4) FROM orders
""")
def agg_multi(spark, d):
    found = aggregations.aggregate(table(spark, d, "orders"), {
        "status_codes": {"terms": {"field": "o_orderstatus"}},
        "avg_price": {"avg": {"field": "o_totalprice"}},
        "max_price": {"max": {"field": "o_totalprice"}},
    })
    buckets = found["status_codes"].select(
        F.lit("status_codes").alias("agg"), F.col("status_codes").alias("bucket"), "doc_count",
        F.lit(None).cast("double").alias("metric"),
    )
    metrics = found["metrics"].select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("agg"), F.lit(None).cast("string").alias("bucket"),
                 F.lit(None).cast("bigint").alias("doc_count"), F.round(n, 4).alias("metric"))
        for n in ("avg_price", "max_price")
    ])))
    return buckets.unionByName(metrics)


@query("""
SELECT event_type AS kinds, count(*) AS doc_count, round(sum(value), 4) AS total FROM events
WHERE value > 20 AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3
""")
def agg_filtered(spark, d):
    body = {
        "query": {"range": {"value": {"gt": 20}}},
        "aggs": {"kinds": {"terms": {"field": "event_type", "size": 3}, "aggs": {"total": {"sum": {"field": "value"}}}}},
    }
    found = LogTable(table(spark, d, "events"), "ts").search(body).between("2024-01-10", "2024-01-20").aggregate()["kinds"]
    return found.withColumn("total", F.round("total", 4))


@query("SELECT count(*) AS total FROM lineitem")
def agg_total(spark, d):
    return aggregations.total_hits(table(spark, d, "lineitem"))


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT _index, count(*) AS total FROM events_log GROUP BY _index UNION ALL SELECT '_all', count(*) FROM events_log
""")
def agg_sample_total(spark, d):
    return aggregations.totals_per_index(events_log(spark, d))


@query("""
SELECT count(l_quantity) AS qty_count, min(l_quantity) AS qty_min, max(l_quantity) AS qty_max,
       round(avg(l_quantity), 6) AS qty_avg, round(sum(l_quantity), 2) AS qty_sum,
       round(sum(l_extendedprice), 2) AS revenue, min(l_discount) AS cheapest, count(l_tax) AS taxed
FROM lineitem
""")
def agg_stats(spark, d):
    found = aggregations.aggregate(table(spark, d, "lineitem"), {
        "qty": {"stats": {"field": "l_quantity"}},
        "revenue": {"sum": {"field": "l_extendedprice"}},
        "cheapest": {"min": {"field": "l_discount"}},
        "taxed": {"value_count": {"field": "l_tax"}},
    })["metrics"]
    return found.withColumns({
        "qty_avg": F.round("qty_avg", 6), "qty_sum": F.round("qty_sum", 2), "revenue": F.round("revenue", 2),
    })


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds FROM events")
def agg_cardinality(spark, d):
    return aggregations.aggregate(table(spark, d, "events"), {
        "users": {"cardinality": {"field": "user_id", "exact": True}},
        "kinds": {"cardinality": {"field": "event_type", "exact": True}},
    })["metrics"]


@query("""
SELECT event_type AS kinds, count(*) AS doc_count, quantile_disc(value, 0.25) AS value_25,
       quantile_disc(value, 0.5) AS value_50, quantile_disc(value, 0.99) AS value_99
FROM events GROUP BY 1
""")
def agg_percentiles(spark, d):
    # Rank error is rows / accuracy: below one rank up to a million rows per bucket.
    percentiles = {"percentiles": {"field": "value", "percents": [25, 50, 99], "accuracy": 1_000_000}}
    aggs = {"kinds": {"terms": {"field": "event_type"}, "aggs": {"value": percentiles}}}
    return aggregations.aggregate(table(spark, d, "events"), aggs)["kinds"]


@query("SELECT floor(l_extendedprice / 10000) * 10000 AS price, count(*) AS doc_count FROM lineitem GROUP BY 1")
def agg_histogram(spark, d):
    aggs = {"price": {"histogram": {"field": "l_extendedprice", "interval": 10000}}}
    found = aggregations.aggregate(table(spark, d, "lineitem"), aggs)["price"]
    return found.select(F.col("price").cast("double").alias("price"), "doc_count")


@query("""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS doc_count, round(avg(value), 6) AS value
FROM events GROUP BY 1
""")
def agg_date_histogram(spark, d):
    aggs = {"day": {"date_histogram": {"field": "ts", "calendar_interval": "day"}, "aggs": {"value": {"avg": {"field": "value"}}}}}
    found = aggregations.aggregate(table(spark, d, "events"), aggs)["day"]
    return found.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "doc_count", F.round("value", 6).alias("value"))


@query("""
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS at, count(*) AS doc_count
FROM events GROUP BY 1
""")
def agg_fixed_histogram(spark, d):
    aggs = {"at": {"date_histogram": {"field": "ts", "fixed_interval": "6h"}}}
    found = aggregations.aggregate(table(spark, d, "events"), aggs)["at"]
    return found.select(F.date_format("at", "yyyy-MM-dd HH:mm").alias("at"), "doc_count")


@query("""
WITH local AS (SELECT event_type AS kinds, date_trunc('day', timezone('America/New_York', timezone('UTC', ts + INTERVAL 50 DAY)) - INTERVAL 6 HOUR) AS day, value
               FROM events WHERE event_id % 150 = 1 AND event_type IN ('error', 'click')),
days AS (SELECT kinds, unnest(generate_series(min(day), greatest(max(day), TIMESTAMP '2024-03-25'), INTERVAL 1 DAY)) AS day FROM local GROUP BY kinds)
SELECT kinds, strftime(timezone('UTC', timezone('America/New_York', day + INTERVAL 6 HOUR)), '%Y-%m-%d %H:%M') AS day,
       count(value) AS doc_count, round(coalesce(sum(value), 0), 4) AS total
FROM days LEFT JOIN local USING (kinds, day) GROUP BY kinds, days.day
""")
def agg_dense_days(spark, d):
    """Days of a zone, over the change of its clocks, from six in the morning; days without rows too, up to a given one."""
    at = (F.col("ts") + F.expr("INTERVAL 50 DAY")).alias("at")
    events = table(spark, d, "events").where("event_id % 150 = 1").select("event_type", at, "value")
    day = {"date_histogram": {
        "field": "at", "calendar_interval": "day", "time_zone": "America/New_York", "offset": "+6h", "min_doc_count": 0,
        "extended_bounds": {"max": "2024-03-25T14:00:00Z"},
    }, "aggs": {"total": {"sum": {"field": "value"}}}}
    aggs = {"kinds": {"terms": {"field": "event_type", "include": "er.*|click|view", "exclude": ["view"]}, "aggs": {"day": day}}}
    found = aggregations.aggregate(events, aggs)["kinds>day"]
    return found.select("kinds", F.date_format("day", "yyyy-MM-dd HH:mm").alias("day"), "doc_count", F.round("total", 4).alias("total"))


@query("""
WITH wide AS (SELECT floor((l_quantity - 1) / 0.5) AS b FROM lineitem WHERE l_quantity IN (3, 7, 12) AND l_quantity >= 5),
every AS (SELECT unnest(generate_series(8, 28)) AS b)
SELECT every.b * 0.5::DOUBLE + 1 AS size, count(wide.b) AS doc_count FROM every LEFT JOIN wide USING (b) GROUP BY 1
""")
def agg_dense_histogram(spark, d):
    sizes = table(spark, d, "lineitem").where("l_quantity IN (3, 7, 12)").select("l_quantity")
    aggs = {"size": {"histogram": {
        "field": "l_quantity", "interval": 0.5, "offset": 1, "min_doc_count": 0, "extended_bounds": {"min": 5, "max": 15}, "hard_bounds": {"min": 5},
    }}}
    return aggregations.aggregate(sizes, aggs)["size"].select(F.col("size").cast("double").alias("size"), "doc_count")


@query("""
SELECT coalesce(CASE WHEN event_id % 3 > 0 THEN event_type END, 'none') AS kinds, count(*) AS doc_count FROM events
WHERE NOT coalesce(CASE WHEN event_id % 3 > 0 THEN event_type END, 'none') IN ('view') GROUP BY 1
""")
def agg_terms_missing(spark, d):
    events = table(spark, d, "events").select(F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("kind"))
    return aggregations.aggregate(events, {"kinds": {"terms": {"field": "kind", "missing": "none", "exclude": "v.*"}}})["kinds"]


@query("""
SELECT label AS bands, count(*) AS doc_count FROM events,
  (VALUES ('low', NULL, 25.0), ('25.0-75.0', 25.0, 75.0), ('50.0-*', 50.0, NULL)) b(label, lo, hi)
WHERE (lo IS NULL OR value >= lo) AND (hi IS NULL OR value < hi) GROUP BY 1
""")
def agg_range(spark, d):
    ranges = [{"key": "low", "to": 25.0}, {"from": 25.0, "to": 75.0}, {"from": 50.0}]
    return aggregations.aggregate(table(spark, d, "events"), {"bands": {"range": {"field": "value", "ranges": ranges}}})["bands"]


@query("""
SELECT 'errors' AS parts, count(*) AS doc_count, round(max(value), 4) AS top FROM events WHERE event_type = 'error'
UNION ALL SELECT 'large', count(*), round(max(value), 4) FROM events WHERE value > 80
""")
def agg_filters(spark, d):
    aggs = {"parts": {
        "filters": {"filters": {"errors": {"term": {"event_type": "error"}}, "large": {"range": {"value": {"gt": 80}}}}},
        "aggs": {"top": {"max": {"field": "value"}}},
    }}
    found = aggregations.aggregate(table(spark, d, "events"), aggs)["parts"]
    return found.withColumn("top", F.round("top", 4))


@query("""
WITH pairs AS (SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS doc_count,
                      round(avg(o_totalprice), 4) AS price FROM orders GROUP BY 1, 2),
outer_top AS (SELECT priority FROM pairs GROUP BY 1 ORDER BY sum(doc_count) DESC, 1 LIMIT 3)
SELECT * FROM pairs WHERE priority IN (SELECT priority FROM outer_top)
QUALIFY row_number() OVER (PARTITION BY priority ORDER BY doc_count DESC, status) <= 2
""")
def agg_sub_terms(spark, d):
    aggs = {"priority": {
        "terms": {"field": "o_orderpriority", "size": 3},
        "aggs": {"status": {"terms": {"field": "o_orderstatus", "size": 2}, "aggs": {"price": {"avg": {"field": "o_totalprice"}}}}},
    }}
    found = aggregations.aggregate(table(spark, d, "orders"), aggs)["priority>status"]
    return found.withColumn("price", F.round("price", 4))


# ------------------------------------------------------------ order and limits


@query("SELECT event_id, ts FROM events ORDER BY ts DESC NULLS LAST, event_id")
def sort_default(spark, d):
    events = LogTable(table(spark, d, "events"), "ts", tie_break=("event_id",))
    return events.df.orderBy(*events.order()).select("event_id", "ts")


@query("""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority, o_totalprice DESC NULLS LAST, o_orderkey
""")
def sort_custom(spark, d):
    body = Body.of({"query": {"match_all": {}}, "sort": ["o_orderpriority", {"o_totalprice": {"order": "desc"}}]})
    orders = LogTable(table(spark, d, "orders"), "o_orderdate", tie_break=("o_orderkey",), body=body)
    return orders.df.orderBy(*orders.order()).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("""
SELECT _index, id FROM (
  SELECT 'events' AS _index, event_id AS id, ts AS "time", value FROM events
  UNION ALL SELECT 'orders', o_orderkey, o_orderdate, NULL FROM orders)
ORDER BY value DESC NULLS LAST, "time" DESC NULLS LAST, _index, id
""")
def sort_unmapped(spark, d):
    events = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("time"), "value")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("time"))
    both = indices.scan_pattern({"events": events, "orders": orders}, "*")
    spec = [{"startTimeMillis": {"order": "desc", "unmapped_type": "boolean"}}, {"value": "desc"}, {"time": "desc"}, "_index", "id"]
    return both.orderBy(*ordering.sort_columns(Fields.of(both), spec)).select("_index", "id")


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_returnflag FROM lineitem
ORDER BY l_returnflag DESC NULLS LAST, CASE WHEN l_quantity > 10 THEN l_quantity END NULLS FIRST, l_shipdate, l_orderkey NULLS LAST,
  l_linenumber NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_extendedprice NULLS LAST
LIMIT (SELECT count(*) // 2 FROM lineitem)
""")
def sort_bulk(spark, d):
    """Half of all rows by a sort of the request, with few values of the first key and nulls in the second; no task merges them."""
    lines = spread(table(spark, d, "lineitem")).withColumn("size", F.when(F.col("l_quantity") > 10, F.col("l_quantity")))
    body = Body.of({"query": {"match_all": {}}, "sort": [{"l_returnflag": "desc"}, {"size": {"order": "asc", "missing": "_first"}}, "l_shipdate"]})
    ties = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    found = LogTable(lines, "l_shipdate", tie_break=ties, body=body).bulk(lines.count() // 2)
    return found.df.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag")


@query("""
WITH log AS (SELECT CASE WHEN event_id % 10 = 0 THEN 'small' WHEN event_id % 97 = 0 THEN NULL ELSE 'large' END AS _index,
                    event_id, CASE WHEN event_id % 13 > 0 THEN date_trunc('hour', ts) END AS hour FROM events)
SELECT _index, event_id, hour FROM log QUALIFY row_number() OVER (PARTITION BY _index ORDER BY hour DESC NULLS LAST, event_id)
  <= (SELECT count(*) * 9 // 20 FROM events)
""")
def sample_large(spark, d):
    """Half of an index that holds nine tenths of all rows, hours of many rows each, without a task that ranks it."""
    events, n = table(spark, d, "events").select("event_id", "ts"), F.col("event_id")
    name = F.when(n % 10 == 0, "small").when(n % 97 == 0, None).otherwise("large")
    at = F.when(n % 13 > 0, F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    log = spread(events).select(name.alias("_index"), "event_id", at.alias("hour"))
    keys = ordering.newest_keys(Fields.of(log), "hour", ["event_id"])
    return ordering.first_rows_per_group(log, F.col("_index"), keys, events.count() * 9 // 20)


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC NULLS LAST, event_id LIMIT 500")
def topk(spark, d):
    return ordering.newest(table(spark, d, "events"), "ts", tie_break=["event_id"]).select("event_id", "ts", "value")


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT _index, id, "@timestamp" FROM events_log
QUALIFY row_number() OVER (PARTITION BY _index ORDER BY "@timestamp" DESC NULLS LAST, id) <= 20
""")
def sample_per_index(spark, d):
    log = events_log(spark, d).select("_index", "id", "`@timestamp`")
    return ordering.newest_per_index(log, "@timestamp", 20, ["id"])


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT _index, id, count(*) OVER (PARTITION BY _index) AS total FROM events_log
QUALIFY row_number() OVER (PARTITION BY _index ORDER BY "@timestamp" DESC NULLS LAST, id) <= 10
""")
def sample_with_total(spark, d):
    log = events_log(spark, d).select("_index", "id", "`@timestamp`")
    return ordering.sample_with_total(log, "@timestamp", 10, ["id"]).select("_index", "id", "total")


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT _index, id, service FROM events_log
WHERE "@timestamp" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15' AND "kubernetes.namespace" = 'ns-1'
QUALIFY row_number() OVER (PARTITION BY _index ORDER BY "@timestamp" DESC NULLS LAST, id) <= 10
""")
def sample_filtered(spark, d):
    log = LogTable(events_log(spark, d), tie_break=("id",))
    found = log.between("2024-01-05", "2024-01-15").where_entity(namespace="ns-1").sample(10)
    return found.df.select("_index", "id", "service")


_UNION_FIELDS = {
    "events": "event_id ts user_id event_type value props",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS field, count({name}) AS docs FROM {of}" for of, names in _UNION_FIELDS.items() for name in names.split()
))
def fields_union(spark, d):
    """All fields of two indices and how many documents have each."""
    frames = {name: table(spark, d, name) for name in ("events", "orders")}
    counted = [frame.agg(*[F.count(c).alias(c) for c in frame.columns]) for frame in frames.values()]
    listed = [
        counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("docs")) for c in counts.columns])))
        for counts in counted
    ]
    found = reduce(lambda a, b: a.unionByName(b), listed)
    names = catalogue.catalogue_of_tables(frames).select("field").distinct()
    return names.join(found, "field", "left")
