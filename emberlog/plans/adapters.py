"""The given tables as log, trace and document indices.

Every adapter has its SQL twin, used by the reference SQL of the queries.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.plans.registry import table

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)

INDEX_PREFIX = {
    "error": "app-logs-", "signup": "filebeat-", "purchase": "jaeger-span-", "view": "shop-", "click": "web-",
}
LEVEL = {"error": "ERROR", "signup": "WARN", "purchase": "INFO", "view": "DEBUG", "click": "TRACE"}
SPAN_KIND = {"user": "CLIENT", "assistant": "SERVER", "system": "INTERNAL"}

# The fields of an index, by the event type it is made from: (field, index type).
INDEX_FIELDS = {
    "error": (
        ("@timestamp", "keyword"), ("message", "text"), ("source", "text"), ("host", "text"), ("level", "keyword"),
    ),
    "signup": (
        ("@timestamp", "date"), ("kubernetes_namespace_name", "keyword"), ("kubernetes_pod_name", "keyword"),
        ("kubernetes_container_name", "keyword"), ("log_level", "keyword"), ("message", "text"),
        ("kubernetes_labels", None), ("kubernetes_labels.app", "keyword"),
    ),
    "purchase": (
        ("startTime", "long"), ("@timestamp", "date"), ("serviceName", "keyword"), ("operationName", "keyword"),
        ("traceID", "text"), ("spanID", "text"), ("duration", "long"), ("tags.http.method", "keyword"),
        ("http.status_code", "integer"), ("rpc.peer_service", "keyword"),
    ),
    "view": (
        ("startTimeMillis", "date"), ("traceID", "keyword"), ("spanID", "keyword"), ("operationName", "keyword"),
        ("duration", "long"), ("process", None), ("process.serviceName", "keyword"),
        ("process.tag.k8s@namespace@name", "keyword"), ("process.tag.k8s@pod@name", "keyword"),
        ("tag.http@status_code", "long"), ("error", "boolean"),
    ),
    "click": (
        ("message", "text"), ("level", "keyword"), ("ingested", "date"), ("kubernetes", None),
        ("kubernetes.namespace", "keyword"), ("kubernetes.pod", None), ("kubernetes.pod.name", "keyword"),
        ("kubernetes.deployment.name", "keyword"), ("kubernetes.labels.app_name", "keyword"),
        ("expires", "date"), ("retry_count", "integer"), ("bytes", "scaled_float"), ("client_ip", "ip"),
    ),
}


def mapped(column: Column, mapping: dict[str, str]) -> Column:
    result = F
    for key, value in mapping.items():
        result = result.when(column == key, F.lit(value))
    return result


def sql_case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return events.select(
        F.concat(mapped(kind, INDEX_PREFIX), F.date_format("ts", "yyyy.MM.dd")).alias("_index"),
        F.col("ts").alias("@timestamp"),
        F.col("event_id").alias("id"),
        "event_type",
        "user_id",
        "value",
        mapped(kind, LEVEL).alias("level"),
        F.concat(F.lit("svc-"), F.col("user_id") % 7).alias("service"),
        F.concat(F.lit("ns-"), F.col("user_id") % 3).alias("kubernetes.namespace"),
        F.round(F.col("value") * 2500).cast("bigint").alias("duration"),
        (k * 4 + 200).alias("http_status"),
        F.col("props").alias("props@json"),
    )


SQL_EVENTS_LOG = f"""
events_log AS (
  SELECT {sql_case('event_type', INDEX_PREFIX)} || strftime(ts, '%Y.%m.%d') AS _index,
         ts AS "@timestamp", event_id AS id, event_type, user_id, value,
         {sql_case('event_type', LEVEL)} AS level,
         'svc-' || CAST(user_id % 7 AS VARCHAR) AS service,
         'ns-' || CAST(user_id % 3 AS VARCHAR) AS "kubernetes.namespace",
         CAST(round(value * 2500) AS BIGINT) AS duration,
         200 + 4 * CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS BIGINT) AS http_status,
         props AS "props@json"
  FROM events)"""


def events_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_log(spark, sf_dir)
    return log.withColumn("startTimeMillis", F.unix_millis(F.col("`@timestamp`").cast("timestamp"))).drop("@timestamp")


SQL_EVENTS_MILLIS = SQL_EVENTS_LOG + """,
events_millis AS (
  SELECT * EXCLUDE ("@timestamp"), epoch_us("@timestamp") // 1000 AS "startTimeMillis" FROM events_log)"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        F.col("conv_id").cast("string").alias("traceID"),
        F.concat_ws("-", "conv_id", "turn").alias("spanID"),
        F.when(F.col("turn") > 0, F.concat_ws("-", "conv_id", F.col("turn") - 1)).alias("parentSpanID"),
        mapped(F.col("role"), SPAN_KIND).alias("span_kind"),
        F.col("text").alias("message"),
    )


SQL_SPANS = f"""
spans AS (
  SELECT CAST(conv_id AS VARCHAR) AS "traceID",
         CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS "spanID",
         CASE WHEN turn > 0 THEN CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR) END AS "parentSpanID",
         {sql_case('role', SPAN_KIND)} AS span_kind, text AS message
  FROM conversations)"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The field catalogue of all indices that have events, one index per type and day."""
    kind = F.col("event_type")
    seen = (
        table(spark, sf_dir, "events")
        .select(kind, F.date_format("ts", "yyyy.MM.dd").alias("day"))
        .distinct()
        .select(kind, F.concat(mapped(kind, INDEX_PREFIX), "day").alias("index"))
    )
    lists = F
    for name, fields in INDEX_FIELDS.items():
        listed = F.array(*[
            F.struct(F.lit(f).alias("field"), F.lit(t).cast("string").alias("type")) for f, t in fields
        ])
        lists = lists.when(kind == name, listed)
    exploded = seen.select("index", F.posexplode(lists).alias("pos", "entry"))
    return exploded.select("index", "entry.field", "entry.type", "pos")


def _sql_values() -> str:
    rows = []
    for kind, fields in INDEX_FIELDS.items():
        for pos, (name, type_) in enumerate(fields):
            shown = "NULL" if type_ is None else f"'{type_}'"
            rows.append(f"('{kind}', '{name}', {shown}, {pos})")
    return ", ".join(rows)


SQL_CATALOGUE = f"""
catalogue AS (
  SELECT {sql_case('s.event_type', INDEX_PREFIX)} || s.day AS index, f.field, CAST(f.type AS VARCHAR) AS type, f.pos
  FROM (SELECT DISTINCT event_type, strftime(ts, '%Y.%m.%d') AS day FROM events) s
  JOIN (VALUES {_sql_values()}) f(event_type, field, type, pos) ON f.event_type = s.event_type)"""

# Tokens of a text, as a list.
SQL_TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"


def sql_tokens(column: str) -> str:
    return SQL_TOKENS.format(column)


def sql_joined(column: str) -> str:
    """Tokens separated and enclosed by one space, for phrase tests."""
    return f"(' ' || array_to_string({sql_tokens(column)}, ' ') || ' ')"
