"""Queries on time rendering, classes and index profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.functions import classify as C
from emberlog.functions import timeexpr
from emberlog.operators import catalogue as cat
from emberlog.operators.field_view import field_view as view_columns
from emberlog.plans.adapters import (
    SPAN_KIND, SQL_CATALOGUE, SQL_EVENTS_LOG, catalogue, events_log, mapped, sql_case,
)
from emberlog.plans.registry import query, table
from emberlog.session import spread


# What the classes are expected to be, apart from what the operators hold.
WANT_SEVERITY = {
    "red": "ERROR|FATAL|CRITICAL", "yellow": "WARN|WARNING", "green": "INFO|INFORMATION|SUCCESS", "blue": "DEBUG|TRACE",
    "gray": "UNKNOWN",
}
WANT_SYSLOG = {
    "red": "ERROR|ALERT|EMERG|CRIT", "yellow": "WARNING", "green": "NOTICE", "blue": "DEBUG|INFO", "gray": "UNKNOWN",
}
WANT_SPAN_KIND = {"blue": "CLIENT", "green": "SERVER", "yellow": "PRODUCER", "orange": "CONSUMER", "purple": "INTERNAL"}
WANT_TIME_FIELDS = {
    "kubernetes": "@timestamp timestamp time date created_at",
    "jaeger": "startTimeMillis startTime @timestamp timestamp time date",
    "generic": "@timestamp timestamp time date created_at log_time event_time",
}


def _words(column: str, options) -> str:
    whens = "".join(
        f" WHEN {column} IN ({', '.join(repr(w) for w in rule.split('|'))}) THEN '{color}'" for color, rule in options.items()
    )
    return f"CASE{whens} END"


# ----------------------------------------------------------------------- time


@query("""
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE strftime(
    CASE WHEN event_id % 6 = 2 THEN date_trunc('day', ts) ELSE ts END, '%Y-%m-%dT%H:%M:%SZ') END AS normalized
FROM events
""")
def normalize_time(spark, d):
    ts = F.col("ts")
    instant = ts.cast("timestamp")
    form = F.col("event_id") % 6
    text = (
        F.when(F.col("event_id") % 97 == 0, "invalid")
        .when(form == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(form == 3, F.unix_seconds(instant).cast("string"))
        .when(form == 4, F.unix_millis(instant).cast("string"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    mixed = table(spark, d, "events").select("event_id", text.alias("text"))
    return mixed.select("event_id", timeexpr.rfc3339(timeexpr.normalize_time(F.col("text"))).alias("normalized"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def format_rfc3339(spark, d):
    return table(spark, d, "events").select("event_id", timeexpr.rfc3339(F.col("ts")).alias("at"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_time, strftime(ts, '%H:%M:%S.%g') AS clock FROM events")
def format_display(spark, d):
    ts = F.col("ts")
    return table(spark, d, "events").select(
        "event_id", timeexpr.display_datetime(ts).alias("full_time"), timeexpr.display_clock(ts).alias("clock")
    )


# -------------------------------------------------------------------- classes


@query(f"WITH {SQL_EVENTS_LOG} SELECT id, level, {_words('level', WANT_SEVERITY)} AS color FROM events_log")
def classify_severity(spark, d):
    return events_log(spark, d).select("id", "level", C.color_class(F.col("level"), C.SEVERITY).alias("color"))


@query(f"WITH {SQL_EVENTS_LOG} SELECT id, level, {_words('level', WANT_SYSLOG)} AS color FROM events_log")
def classify_syslog(spark, d):
    return events_log(spark, d).select("id", "level", C.color_class(F.col("level"), C.SYSLOG_SEVERITY).alias("color"))


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT id, CASE WHEN duration >= 1000000 THEN 'red' WHEN duration >= 500000 THEN 'orange'
                WHEN duration >= 100000 THEN 'yellow' ELSE 'green' END AS color
FROM events_log
""")
def classify_duration(spark, d):
    return events_log(spark, d).select("id", C.color_class(F.col("duration"), C.DURATION_MICROS).alias("color"))


@query("""
SELECT color, count(*) AS n FROM (
  SELECT CASE WHEN l_extendedprice / 10 <= 1000 THEN 'green' WHEN l_extendedprice / 10 <= 5000 THEN 'yellow' ELSE 'red' END AS color
  FROM lineitem) GROUP BY 1
""")
def classify_latency(spark, d):
    color = C.color_class(F.col("l_extendedprice") / 10, C.LATENCY)
    return table(spark, d, "lineitem").groupBy(color.alias("color")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_custkey, CASE WHEN n * 60 > 1000 THEN 'red' WHEN n * 60 > 100 THEN 'yellow' ELSE 'green' END AS color,
       CASE WHEN n > 100 THEN 'red' WHEN n > 10 THEN 'yellow' ELSE 'green' END AS small
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
""")
def classify_count(spark, d):
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "o_custkey",
        C.color_class(F.col("n") * 60, C.COUNT).alias("color"),
        C.color_class(F.col("n"), C.COUNT_SMALL).alias("small"),
    )


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT id, http_status, CASE http_status // 100 WHEN 2 THEN 'green' WHEN 3 THEN 'yellow' WHEN 4 THEN 'orange'
       WHEN 5 THEN 'red' END AS color
FROM events_log
""")
def classify_http_status(spark, d):
    return events_log(spark, d).select(
        "id", "http_status", C.color_class(F.col("http_status"), C.HTTP_STATUS).alias("color")
    )


_STATUS = {"F": "completed", "O": "Running", "P": "PENDING"}


@query(f"""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'blue' WHEN 'P' THEN 'yellow' END AS color FROM orders
""")
def classify_status(spark, d):
    word = mapped(F.col("o_orderstatus"), _STATUS)
    return table(spark, d, "orders").select("o_orderkey", C.color_class(word, C.STATUS_WORD).alias("color"))


@query(f"""
SELECT conv_id, turn, {_words(f"({sql_case('role', SPAN_KIND)})", WANT_SPAN_KIND)} AS color FROM conversations
""")
def classify_span_kind(spark, d):
    kind = mapped(F.col("role"), SPAN_KIND)
    return table(spark, d, "conversations").select("conv_id", "turn", C.color_class(kind, C.SPAN_KIND).alias("color"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'red' ELSE 'green' END AS color FROM events")
def classify_error(spark, d):
    flag = F.col("event_type") == "error"
    return table(spark, d, "events").select("event_id", C.color_class(flag, C.ERROR_FLAG).alias("color"))


# ------------------------------------------------------------- index profiles

_SQL_KIND = f"""{SQL_CATALOGUE},
kinds AS (
  SELECT index, CASE
      WHEN regexp_matches(lower(index), 'filebeat|kubernetes|k8s|eks|gke|aks') THEN 'kubernetes'
      WHEN count(DISTINCT lower(field)) FILTER (WHERE lower(field) IN
        ('kubernetes.namespace', 'kubernetes.pod.name', 'kubernetes.container.name')) >= 2 THEN 'kubernetes'
      WHEN regexp_matches(lower(index), 'jaeger|span|trace|otel|apm') THEN 'jaeger'
      WHEN count(DISTINCT lower(field)) FILTER (WHERE lower(field) IN
        ('traceid', 'spanid', 'servicename', 'operationname', 'starttime')) >= 3 THEN 'jaeger'
      ELSE 'generic' END AS kind
  FROM catalogue GROUP BY index),
candidates(kind, field, rank) AS (VALUES
  {', '.join(f"('{kind}', '{name}', {i})" for kind, names in WANT_TIME_FIELDS.items() for i, name in enumerate(names.split()))}),
times AS (
  SELECT k.index, k.kind, arg_min(c.field, coalesce(r.rank, 1000 + c.pos)) AS found
  FROM kinds k LEFT JOIN catalogue c ON c.index = k.index
  LEFT JOIN candidates r ON r.kind = k.kind AND r.field = c.field
  WHERE c.type = 'date' OR (c.type IS NULL AND r.rank IS NOT NULL) GROUP BY 1, 2),
profiled AS (
  SELECT k.index, k.kind, coalesce(t.found, CASE k.kind WHEN 'jaeger' THEN 'startTimeMillis' ELSE '@timestamp' END)
    AS time_field, t.found IS NOT NULL AS has_date
  FROM kinds k LEFT JOIN times t ON t.index = k.index)"""


@query(f"WITH {_SQL_KIND} SELECT index, kind FROM kinds")
def detect_kind(spark, d):
    return cat.detect_kind(catalogue(spark, d))


@query(f"WITH {_SQL_KIND} SELECT index, kind, time_field, has_date FROM profiled")
def time_column(spark, d):
    return cat.time_column(catalogue(spark, d))


@query(f"""
WITH {_SQL_KIND}
SELECT p.index, p.kind, p.time_field, p.has_date, count(DISTINCT c.field) AS field_count
FROM profiled p JOIN catalogue c ON c.index = p.index GROUP BY ALL
""")
def inspect(spark, d):
    return cat.inspect_indices(catalogue(spark, d))


@query(f"""
WITH {_SQL_KIND}
SELECT index, CASE WHEN has_date THEN ''
  ELSE 'No date field found in index ''' || index || '''. Time-based queries may not work correctly.; '
    || 'No timestamp field detected. Using default ''@timestamp''.' END AS warnings
FROM profiled
UNION ALL
SELECT 'empty-' || lower(r_name), 'No date field found in index ''empty-' || lower(r_name)
  || '''. Time-based queries may not work correctly.; No timestamp field detected. Using default ''@timestamp''.; '
  || 'No fields found in index mapping. Index may be empty or misconfigured.' FROM region
""")
def index_health(spark, d):
    """Indices with fields, and one per region that has none."""
    fields = catalogue(spark, d)
    empty = table(spark, d, "region").select(F.concat(F.lit("empty-"), F.lower("r_name")).alias("index"))
    found = cat.index_health(fields, fields.select("index").union(empty))
    return found.select("index", F.array_join("warnings", "; ").alias("warnings"))


@query("""
WITH docs AS (SELECT 'documents' AS _index, doc_id, text, lang, source, n_chars FROM documents)
SELECT 'documents' AS _index, 'doc_id' AS field, 'keyword' AS type UNION ALL
SELECT 'documents', 'text', CASE WHEN max(CAST(strlen(text) > 50 OR contains(text, ' ') AS INT)) = 1 THEN 'text' ELSE 'keyword' END FROM docs UNION ALL
SELECT 'documents', 'lang', CASE WHEN max(CAST(strlen(lang) > 50 OR contains(lang, ' ') AS INT)) = 1 THEN 'text' ELSE 'keyword' END FROM docs UNION ALL
SELECT 'documents', 'source', CASE WHEN max(CAST(strlen(source) > 50 OR contains(source, ' ') AS INT)) = 1 THEN 'text' ELSE 'keyword' END FROM docs UNION ALL
SELECT 'documents', 'n_chars', 'long' UNION ALL
SELECT DISTINCT 'props-' || event_type, 'k', 'long' FROM events
""")
def infer_mapping(spark, d):
    documents = cat.infer_table_mapping(table(spark, d, "documents")).select(F.lit("documents").alias("_index"), "field", "type")
    props = table(spark, d, "events").select(
        F.concat(F.lit("props-"), "event_type").alias("_index"), F.try_parse_json("props").alias("doc")
    )
    return documents.unionByName(cat.infer_mapping(props, keys=("_index",)).select("_index", "field", "type"))


_SQL_JSON_FIELDS = [
    ("level", "keyword"), ("msg", "text"), ("user", "object"), ("user.id", "long"), ("user.vip", "boolean"), ("value", "double"),
    ("a", "object"), ("a.b", "object"), ("a.b.c", "object"), ("a.b.c.d", "object"), ("a.b.c.d.e", "object"), ("a.b.c.d.e.f", "long"),
    ("items", "nested"), ("items.sku", "keyword"), ("items.n", "long"), ("grid", "keyword"), ("grid.x", "text"), ("k.v", "object"),
    ("k.v.w.u", "boolean"),
]


@query(f"""
SELECT e.event_type AS index, f.field, f.type FROM (SELECT DISTINCT event_type FROM events) e,
  (VALUES {', '.join(f"('{n}', '{t}')" for n, t in _SQL_JSON_FIELDS)}) f(field, type)
WHERE f.field <> 'user.vip' OR e.event_type IN ('purchase', 'signup')
""")
def fields_catalogue(spark, d):
    """Fields found in schemaless documents, per index."""
    vip = F.when(F.col("event_type").isin("purchase", "signup"), F.col("user_id") > 50)
    deep = F.col("event_id").alias("f")
    for name in "edcba":
        deep = F.struct(deep).alias(name)
    items = F.array(F.struct(F.lit("s").alias("sku"), F.lit(None).cast("bigint").alias("n")), F.struct(F.lit("t").alias("sku"), F.col("user_id").alias("n")))
    document = F.struct(
        deep, items.alias("items"), F.upper("event_type").alias("level"), F.concat(F.lit("user did "), "event_type").alias("msg"),
        F.struct(F.col("user_id").alias("id"), vip.alias("vip")).alias("user"), (F.col("value") + 0.001).alias("value"),
        # Arrays in arrays, with unlike values of one field, and names that hold dots.
        F.array(F.array(F.struct(F.lit("x").alias("x")), F.struct(F.lit('a "b" c').alias("x"))), F.array(F.struct(F.lit("\\").alias("x")))).alias("grid"),
        F.struct((F.col("value") > 50).alias("w.u")).alias("k.v"),
    )
    docs = spread(table(spark, d, "events").select("event_id", "event_type", "user_id", "value")).select(
        F.col("event_type").alias("_index"), F.to_json(document).alias("doc")
    )
    return cat.catalogue_of_documents(docs).select("index", "field", "type")


@query(f"""
WITH {SQL_CATALOGUE}
SELECT index, field, pos, CASE WHEN type IN ('text', 'keyword') THEN 'string' WHEN type IN ('long', 'integer', 'short', 'byte') THEN 'int'
  WHEN type IN ('double', 'float', 'half_float', 'scaled_float') THEN 'float' WHEN type = 'boolean' THEN 'boolean'
  WHEN type = 'object' THEN 'struct' WHEN type = 'nested' THEN 'array' ELSE 'string' END AS view_type
FROM catalogue
""")
def map_types(spark, d):
    return cat.map_types(catalogue(spark, d)).select("index", "field", "pos", "view_type")


_SQL_ENTITIES = f"""{SQL_CATALOGUE},
named AS (SELECT *, translate(lower(field), '_@-', '...') AS name FROM catalogue),
entities(entity) AS (VALUES ('namespace'), ('pod'), ('deployment'), ('container'), ('service'), ('operation')),
ranked AS (
  SELECT index, entity, field, min(pos) AS pos, min(CASE
      WHEN suffix(name, entity) THEN 0 WHEN suffix(name, '.' || entity || '.name') THEN 1
      WHEN suffix(name, '.' || entity) THEN 2 WHEN suffix(name, entity || 'name') THEN 3
      WHEN starts_with(name, entity) THEN 4 END) AS rank
  FROM named, entities GROUP BY 1, 2, 3),
mapping AS (
  SELECT index, entity, string_agg(field, ',' ORDER BY rank, pos) AS fields
  FROM ranked WHERE rank IS NOT NULL GROUP BY 1, 2)"""


@query(f"WITH {_SQL_ENTITIES} SELECT index, entity, fields FROM mapping WHERE entity = 'service'")
def entity_candidates(spark, d):
    found = cat.entity_candidates(catalogue(spark, d), "service")
    return found.select("index", "entity", F.array_join("fields", ",").alias("fields"))


@query(f"WITH {_SQL_ENTITIES} SELECT index, entity, fields FROM mapping")
def entity_mapping(spark, d):
    found = cat.entity_mapping(catalogue(spark, d))
    return found.select("index", "entity", F.array_join("fields", ",").alias("fields"))


@query(f"""
WITH {_SQL_ENTITIES},
words(entity, word) AS (VALUES ('namespace', 'namespace'), ('pod', 'pod'), ('deployment', 'deployment'), ('deployment', 'app'),
  ('deployment', 'k8s'), ('deployment', 'kubernetes'), ('container', 'container'), ('container', 'k8s'),
  ('container', 'kubernetes'), ('service', 'service'), ('operation', 'operation')),
missing AS (
  SELECT i.index, e.entity FROM (SELECT DISTINCT index FROM catalogue) i, entities e
  WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE m.index = i.index AND m.entity = e.entity)),
alike AS (
  SELECT DISTINCT m.index, m.entity, c.field FROM missing m JOIN words w ON w.entity = m.entity
  JOIN catalogue c ON c.index = m.index AND contains(lower(c.field), w.word)),
kept AS (SELECT * FROM alike QUALIFY row_number() OVER (PARTITION BY index, entity ORDER BY field) <= 5)
SELECT m.index, m.entity, coalesce(string_agg(k.field, ',' ORDER BY k.field), '') AS similar
FROM missing m LEFT JOIN kept k ON k.index = m.index AND k.entity = m.entity GROUP BY 1, 2
""")
def similar_fields(spark, d):
    found = cat.similar_fields(catalogue(spark, d))
    return found.select("index", "entity", F.array_join("similar", ",").alias("similar"))


@query(rf"""
WITH {SQL_CATALOGUE}, last AS (SELECT index, field, pos, replace(list_last(string_split(field, '.')), '_', ' ') AS part FROM catalogue)
SELECT index, field, pos, array_to_string(list_transform(regexp_extract_all(part, '[\pL\pN_]+|[^\pL\pN_]+'),
  lambda w: upper(left(w, 1)) || substr(w, 2)), '') AS label
FROM last
""")
def field_labels(spark, d):
    return catalogue(spark, d).select("index", "field", "pos", cat.field_label(F.col("field")).alias("label"))


@query(rf"""
WITH {SQL_CATALOGUE}
SELECT index, field, pos, CASE WHEN starts_with(field, 'kubernetes.') THEN 'kubernetes'
  WHEN regexp_matches(field, 'traceID|spanID|parentSpanID|operationName|serviceName|startTimeMillis|startTime|duration|span\.kind|error')
    OR regexp_matches(field, '^(tags\.|process\.tags\.|logs\[|references\[|http\.|db\.|rpc\.)') THEN 'trace'
  ELSE 'plain' END AS role
FROM catalogue
""")
def field_roles(spark, d):
    return catalogue(spark, d).select("index", "field", "pos", cat.field_role(F.col("field")).alias("role"))


# What every field of the test catalogue is shown as, by field name and type.
_VIEW = [
    ("@timestamp", "keyword", "plain", None, "string", "yyyy-MM-dd HH:mm:ss", None),
    ("@timestamp", "date", "plain", None, "string", "yyyy-MM-dd HH:mm:ss", None),
    ("message", "text", "plain", None, "string", None, None),
    ("source", "text", "plain", None, "string", None, None),
    ("host", "text", "plain", None, "string", None, None),
    ("level", "keyword", "plain", None, "string", None, "severity"),
    ("log_level", "keyword", "plain", None, "string", None, "severity"),
    ("kubernetes_namespace_name", "keyword", "plain", None, "string", None, None),
    ("kubernetes_pod_name", "keyword", "plain", None, "string", None, None),
    ("kubernetes_container_name", "keyword", "plain", None, "string", None, None),
    ("kubernetes_labels", None, "plain", None, "string", None, None),
    ("kubernetes_labels.app", "keyword", "plain", None, "string", None, None),
    ("startTime", "long", "trace", "Start Time", "int", "HH:mm:ss.SSS", None),
    ("serviceName", "keyword", "trace", "Service", "string", None, None),
    ("operationName", "keyword", "trace", "Operation", "string", None, None),
    ("traceID", "text", "trace", "Trace ID", "string", None, None),
    ("spanID", "text", "trace", "Span ID", "string", None, None),
    ("traceID", "keyword", "trace", "Trace ID", "string", None, None),
    ("spanID", "keyword", "trace", "Span ID", "string", None, None),
    ("duration", "long", "trace", "Duration (μs)", "float", None, "duration"),
    ("tags.http.method", "keyword", "trace", "Method", "string", None, None),
    ("http.status_code", "integer", "trace", "Status", "int", None, "http_status"),
    ("rpc.peer_service", "keyword", "trace", "RPC Peer Service", "string", None, None),
    ("startTimeMillis", "date", "trace", "Start Time", "string", "HH:mm:ss.SSS", None),
    ("process", None, "plain", None, "string", None, None),
    ("process.serviceName", "keyword", "trace", "Service", "string", None, None),
    ("process.tag.k8s@namespace@name", "keyword", "plain", None, "string", None, None),
    ("process.tag.k8s@pod@name", "keyword", "plain", None, "string", None, None),
    ("tag.http@status_code", "long", "plain", None, "int", None, "status"),
    ("error", "boolean", "trace", "Error", "boolean", None, "error"),
    ("ingested", "date", "plain", None, "string", "yyyy-MM-dd HH:mm:ss", None),
    ("expires", "date", "plain", None, "string", "yyyy-MM-dd HH:mm:ss", None),
    ("kubernetes", None, "plain", None, "string", None, None),
    ("kubernetes.namespace", "keyword", "kubernetes", "Namespace", "string", None, None),
    ("kubernetes.pod", None, "kubernetes", "Pod", "string", None, None),
    ("kubernetes.pod.name", "keyword", "kubernetes", "Pod", "string", None, None),
    ("kubernetes.deployment.name", "keyword", "kubernetes", "Deployment", "string", None, None),
    ("kubernetes.labels.app_name", "keyword", "kubernetes", "app_name", "string", None, None),
    ("retry_count", "integer", "plain", None, "int", None, "count"),
    ("bytes", "scaled_float", "plain", None, "float", None, None),
    ("client_ip", "ip", "plain", None, "string", None, None),
]


def _sql_rows(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in rows)


@query(f"""
WITH {SQL_CATALOGUE}, shown(field, type, role, label, view_type, date_format, colors) AS (VALUES {_sql_rows(_VIEW)})
SELECT c.index, c.field, c.pos, s.role, s.label, s.view_type, s.date_format, s.colors
FROM catalogue c JOIN shown s ON s.field = c.field AND s.type IS NOT DISTINCT FROM c.type
""")
def field_view(spark, d):
    return view_columns(catalogue(spark, d))


@query("""
SELECT p_partkey, 'brand=' || p_brand || ',size=' || CAST(p_size AS VARCHAR) AS kept FROM part
""")
def clean_settings(spark, d):
    settings = F.create_map(
        F.lit("brand"), F.col("p_brand"), F.lit("uuid"), F.col("p_name"), F.lit("version"), F.lit("1"),
        F.lit("creation_date"), F.lit("0"), F.lit("size"), F.col("p_size").cast("string"), F.lit("uid"), F.lit("u"),
        F.lit("provided_name"), F.col("p_name"),
    )
    entries = F.array_sort(F.map_entries(cat.clean_settings(settings)))
    shown = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return table(spark, d, "part").select("p_partkey", shown.alias("kept"))
