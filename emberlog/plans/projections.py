"""Queries on field selection, canonical fields and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.operators import reshape
from emberlog.operators.views import COMBINED, view_named
from emberlog.plans.adapters import (
    SQL_EVENTS_LOG, SQL_EVENTS_MILLIS, SQL_SPANS, events_log, events_millis, spans,
)
from emberlog.plans.registry import query, table


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def select_fields(spark, d):
    return reshape.select_fields(table(spark, d, "orders"), ["o_orderkey", "o_totalprice", "o_orderdate"])


@query("SELECT l_shipdate, l_extendedprice, l_orderkey, l_linenumber FROM lineitem")
def select_glob(spark, d):
    patterns = ["l_ship*", "l_*price", "l_tax", "l_order*", "l_line*", "!l_tax", "!*status"]
    return reshape.select_fields(table(spark, d, "lineitem"), patterns)


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal FROM customer")
def select_alias(spark, d):
    names, aliases = reshape.parse_fields("c_custkey:id, c_name : name, c_acctbal:")
    return reshape.select_fields(table(spark, d, "customer"), names, aliases)


@query("""
WITH joined AS (
  SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_name END AS primary_service,
         s_name AS serviceName, c_mktsegment AS "kubernetes.namespace"
  FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey)
SELECT c_custkey, CASE WHEN primary_service = '' THEN '' END AS primary_service,
       CASE WHEN coalesce(primary_service, '') <> '' THEN "serviceName" END AS "serviceName",
       coalesce(nullif(primary_service, ''), "serviceName") AS service, "kubernetes.namespace" AS namespace
FROM joined
""")
def canonical_coalesce(spark, d):
    key = F.col("c_custkey") % 3
    customers = table(spark, d, "customer").select(
        "c_custkey",
        F.when(key == 0, "").when(key == 1, F.col("c_name")).alias("primary_service"),
        F.col("c_mktsegment").alias("kubernetes.namespace"),
    )
    suppliers = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("serviceName"))
    joined = customers.join(suppliers, F.col("c_custkey") == F.col("s_suppkey"), "left").drop("s_suppkey")
    mapping = {"namespace": ["kubernetes.namespace"], "service": ["primary_service", "serviceName"]}
    return reshape.canonical_fields(joined, mapping)


@query("""
SELECT event_id, event_type, user_id, CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE props END AS message,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
       CASE WHEN event_type <> 'click' THEN event_type END AS severity,
       CASE WHEN user_id > 1 THEN user_id END AS count
FROM events
""")
def envelope(spark, d):
    events = table(spark, d, "events")
    rows = events.select(
        "event_id", "event_type", "user_id", "ts", "props",
        F.when(F.col("event_type") == "error", "failed").alias("message"),
    )
    filled = reshape.envelope(rows, {
        "id": F.col("event_id").cast("string"),
        "message": "props",
        "timestamp": "ts",
        "severity": F.when(F.col("event_type") == "click", "").otherwise(F.col("event_type")),
        "count": "user_id",
    })
    return filled.drop("ts", "props")


@query(f"""
WITH {SQL_EVENTS_MILLIS}
SELECT id, "startTimeMillis", strftime(make_timestamp("startTimeMillis" * 1000), '%Y-%m-%dT%H:%M:%SZ') AS timestamp
FROM events_millis
""")
def millis_to_timestamp(spark, d):
    return reshape.millis_to_timestamp(events_millis(spark, d).select("id", "startTimeMillis"))


@query("""
SELECT o_orderkey, o_custkey AS "customer.key", o_orderpriority AS "customer.order.priority",
       o_orderstatus AS "customer.order.status"
FROM orders
""")
def flatten(spark, d):
    order = F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    customer = F.struct(F.col("o_custkey").alias("key"), order.alias("order"))
    return reshape.flatten(table(spark, d, "orders").select("o_orderkey", customer.alias("customer")))


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT strftime("@timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp, "kubernetes.namespace" AS namespace,
       CAST(NULL AS VARCHAR) AS pod, CAST(NULL AS VARCHAR) AS container, service, event_type AS operation,
       duration, level AS span_kind, CASE level WHEN 'ERROR' THEN TRUE WHEN 'WARN' THEN FALSE END AS error,
       CASE WHEN duration < 100000 THEN 'green' WHEN duration < 500000 THEN 'yellow'
            WHEN duration < 1000000 THEN 'orange' ELSE 'red' END AS duration_color,
       CAST(NULL AS VARCHAR) AS span_kind_color,
       CASE level WHEN 'ERROR' THEN 'red' WHEN 'WARN' THEN 'green' END AS error_color
FROM events_log
""")
def view_otel(spark, d):
    log = events_log(spark, d)
    adapted = log.select(
        F.col("`@timestamp`").alias("timestamp"), F.col("`kubernetes.namespace`"), F.col("service").alias("serviceName"),
        F.col("event_type").alias("operationName"), "duration", F.col("level").alias("span_kind"),
        F.when(F.col("level") == "ERROR", "true").when(F.col("level") == "WARN", "false").alias("error"),
    )
    return reshape.apply_view(adapted, view_named("otel"), colors=True)


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT strftime("@timestamp", '%H:%M:%S.%g') AS start_time, CAST(user_id AS VARCHAR) AS trace_id,
       CAST(id AS VARCHAR) AS span_id, service, event_type AS operation, 'GET' AS http_method,
       CAST(http_status AS INTEGER) AS http_status, '/' || event_type AS http_url, CAST(NULL AS VARCHAR) AS http_route,
       CAST(NULL AS VARCHAR) AS http_user_agent, CAST(duration AS DOUBLE) AS duration, level = 'ERROR' AS error,
       "kubernetes.namespace" AS namespace, CAST(NULL AS VARCHAR) AS pod, CAST(NULL AS VARCHAR) AS container
FROM events_log
""")
def view_otel_http(spark, d):
    log = events_log(spark, d)
    adapted = log.select(
        F.col("`@timestamp`").alias("start_time"), F.col("`kubernetes.namespace`"), F.col("user_id").alias("trace_id"),
        F.col("id").alias("span-id"), "service", F.col("event_type").alias("operation"), "duration",
        F.lit("GET").alias("tag.http@method"), F.col("http_status").cast("string").alias("tag.http_status"),
        F.concat(F.lit("/"), F.col("event_type")).alias("tag.http@url"), (F.col("level") == "ERROR").alias("error"),
    )
    return reshape.apply_view(adapted, view_named("otel.http"))


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT strftime("@timestamp", '%H:%M:%S.%g') AS start_time, CAST(user_id AS VARCHAR) AS trace_id,
       CAST(id AS VARCHAR) AS span_id, service, event_type AS operation, 'json' AS db_system,
       "kubernetes.namespace" AS db_name, "props@json" AS db_statement, CAST(NULL AS VARCHAR) AS db_operation,
       CAST(user_id AS VARCHAR) AS db_user, CAST(duration AS DOUBLE) AS duration, CAST(NULL AS BOOLEAN) AS error,
       CAST(NULL AS VARCHAR) AS namespace, CAST(NULL AS VARCHAR) AS pod, CAST(NULL AS VARCHAR) AS container
FROM events_log
""")
def view_otel_db(spark, d):
    log = events_log(spark, d)
    adapted = log.select(
        F.col("`@timestamp`").alias("start_time"), F.col("user_id").alias("trace_id"), F.col("id").alias("span_id"),
        "service", F.col("event_type").alias("operation"), "duration", F.lit("json").alias("tag.db@system"),
        F.col("`kubernetes.namespace`").alias("tag.db@name"), F.col("`props@json`").alias("tag.db@statement"),
        F.col("user_id").alias("tag.db@user"),
    )
    return reshape.apply_view(adapted, view_named("otel.db"))


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT strftime("@timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp, service AS hostname, event_type AS program,
       CAST(user_id AS INTEGER) AS pid, level AS severity, CAST(NULL AS VARCHAR) AS facility, "props@json" AS message,
       CAST(NULL AS VARCHAR) AS tag, "kubernetes.namespace" AS namespace, CAST(NULL AS VARCHAR) AS pod,
       CAST(NULL AS VARCHAR) AS container,
       CASE level WHEN 'ERROR' THEN 'red' WHEN 'INFO' THEN 'blue' WHEN 'DEBUG' THEN 'blue' END AS severity_color
FROM events_log
""")
def view_syslog(spark, d):
    adapted = events_log(spark, d).select(
        F.col("`@timestamp`").alias("timestamp"), F.col("service").alias("host.Hostname"),
        F.col("event_type").alias("program"), F.col("user_id").cast("string").alias("pid"),
        F.col("level").alias("severity"), F.col("`props@json`").alias("message"), F.col("`kubernetes.namespace`"),
    )
    return reshape.apply_view(adapted, view_named("syslog"), colors=True)


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT strftime("@timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp, "kubernetes.namespace" AS namespace,
       'pod-' || CAST(user_id AS VARCHAR) AS pod, service AS container, "props@json" AS message, level,
       CAST(NULL AS VARCHAR) AS node, event_type AS deployment
FROM events_log
""")
def view_kubernetes(spark, d):
    kubernetes = F.struct(
        F.struct(F.concat(F.lit("pod-"), F.col("user_id")).alias("name")).alias("pod"),
        F.struct(F.col("service").alias("name")).alias("container"),
    )
    adapted = events_log(spark, d).select(
        "`@timestamp`", F.col("`kubernetes.namespace`").alias("kubernetes_namespace_name"),
        kubernetes.alias("kubernetes"), F.col("`props@json`").alias("message"), "level",
        F.col("event_type").alias("kubernetes_deployment_name"),
    )
    return reshape.apply_view(adapted, view_named("kubernetes"))


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT strftime("@timestamp", '%Y-%m-%d %H:%M:%S') AS "@timestamp", "kubernetes.namespace",
       'pod-' || CAST(user_id AS VARCHAR) AS "kubernetes.pod.name", service AS "kubernetes.container.name",
       "props@json" AS message, level, CAST(NULL AS VARCHAR) AS "kubernetes.node.name",
       event_type AS "kubernetes.deployment.name", CAST(NULL AS VARCHAR) AS "cloud.provider", 'eu' AS "cloud.region",
       CAST(NULL AS VARCHAR) AS "agent.type",
       CASE level WHEN 'ERROR' THEN 'red' WHEN 'WARN' THEN 'yellow' WHEN 'INFO' THEN 'green' ELSE 'blue' END AS level_color
FROM events_log
""")
def view_kubernetes_preset(spark, d):
    named = [
        F.struct(F.concat(F.lit("pod-"), F.col("user_id")).alias("name")).alias("pod"),
        F.struct(F.col("service").alias("name")).alias("container"),
        F.struct(F.col("event_type").alias("name")).alias("deployment"),
        F.col("`kubernetes.namespace`").alias("namespace"),
    ]
    adapted = events_log(spark, d).select(
        "`@timestamp`", F.struct(*named).alias("kubernetes"), F.col("`props@json`").alias("message"), "level",
        F.struct(F.lit("eu").alias("region")).alias("cloud"),
    )
    return reshape.apply_view(adapted, view_named("k8s", preset=True), colors=True)


@query(f"""
WITH {SQL_EVENTS_MILLIS}
SELECT strftime(make_timestamp("startTimeMillis" * 1000), '%H:%M:%S.%g') AS "startTimeMillis",
       strftime(make_timestamp("startTimeMillis" * 1000), '%H:%M:%S.%g') AS "startTime", CAST(user_id AS VARCHAR) AS "traceID", CAST(id AS VARCHAR) AS "spanID",
       service AS "serviceName", event_type AS "operationName", CAST(duration AS DOUBLE) AS duration,
       CAST(NULL AS VARCHAR) AS "span.kind", level = 'ERROR' AS error, CAST(http_status AS INTEGER) AS "http.status_code",
       CAST(NULL AS VARCHAR) AS "http.method", CAST(NULL AS VARCHAR) AS "http.url"
FROM events_millis
""")
def view_jaeger(spark, d):
    # `startTime` has no column of its own and takes the one whose name starts with it.
    adapted = events_millis(spark, d).select(
        "startTimeMillis", F.col("user_id").alias("traceID"), F.col("id").alias("spanID"),
        F.struct(F.col("service").alias("serviceName")).alias("process"), F.col("event_type").alias("operationName"),
        "duration", (F.col("level") == "ERROR").alias("error"), F.col("http_status").alias("tag.http.status_code"),
    )
    return reshape.apply_view(adapted, view_named("jaeger", preset=True))


@query(f"""
WITH {SQL_EVENTS_LOG}, {SQL_SPANS}
SELECT strftime("@timestamp", '%Y-%m-%d %H:%M:%S') AS "@timestamp", CAST(NULL AS VARCHAR) AS "traceID",
       CAST(NULL AS VARCHAR) AS "spanID", service AS "serviceName", CAST(NULL AS VARCHAR) AS "operationName",
       CAST(duration AS DOUBLE) AS duration, CAST(NULL AS BOOLEAN) AS error, "kubernetes.namespace",
       CAST(NULL AS VARCHAR) AS "kubernetes.pod.name", CAST(NULL AS VARCHAR) AS "kubernetes.container.name",
       "props@json" AS message, level
FROM events_log
UNION ALL
SELECT NULL, "traceID", "spanID", NULL, NULL, NULL, NULL, NULL, NULL, NULL, message, NULL FROM spans
""")
def view_combined(spark, d):
    logs = events_log(spark, d).select(
        "`@timestamp`", F.col("service").alias("serviceName"), "duration", "`kubernetes.namespace`",
        F.col("`props@json`").alias("message"), "level",
    )
    return reshape.combine_views([logs, spans(spark, d)], COMBINED)


@query("SELECT p_partkey, p_name FROM part")
def import_drop_attrs(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    stored = parts.withColumns({
        "provided_name": F.col("p_name"), "uid": F.col("p_partkey"), "version": F.lit(1),
    })
    return reshape.drop_bookkeeping(stored)


@query("""
SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS BIGINT) END AS k,
       CASE WHEN event_id % 50 = 0 THEN 'not {json' END AS kept
FROM events
""")
def parse_json_field(spark, d):
    text = F.when(F.col("event_id") % 50 == 0, "not {json").otherwise(F.col("props"))
    parsed = reshape.parse_json_fields(table(spark, d, "events").select("event_id", text.alias("props@json")))
    value = F.col("`props@json`")
    return parsed.select(
        "event_id",
        F.try_variant_get(value, "$.k", "bigint").alias("k"),
        F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).alias("kept"),
    )
