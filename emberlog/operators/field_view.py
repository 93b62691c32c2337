"""View columns derived from a catalogue: label, type, format and colour rule per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.operators.catalogue import _any, field_label, field_role, map_types, title_case

# Fixed values.  Rules are tried in order: (how, words, result).  `how` is equals,
# contains or starts; a result that starts with "-" is the name without that prefix.
KUBERNETES_LABELS = (
    ("contains", ("namespace",), "Namespace"),
    ("contains", ("pod.name",), "Pod"),
    ("contains", ("pod.uid",), "Pod UID"),
    ("contains", ("container.name",), "Container"),
    ("contains", ("container.image",), "Image"),
    ("contains", ("node.name",), "Node"),
    ("contains", ("deployment.name",), "Deployment"),
    ("starts", ("kubernetes.labels.",), "-kubernetes.labels."),
    ("starts", ("kubernetes.annotations.",), "-kubernetes.annotations."),
    ("contains", ("container.id",), "Container ID"),
    ("contains", ("container.runtime",), "Runtime"),
    ("contains", ("agent.hostname",), "Agent Host"),
    ("contains", ("agent.type",), "Agent"),
    ("contains", ("agent.version",), "Version"),
)
TRACE_LABELS = (
    ("contains", ("traceID",), "Trace ID"),
    ("contains", ("spanID",), "Span ID"),
    ("contains", ("parentSpanID",), "Parent ID"),
    ("contains", ("serviceName",), "Service"),
    ("contains", ("operationName",), "Operation"),
    ("equals", ("duration",), "Duration (μs)"),
    ("equals", ("startTimeMillis", "startTime"), "Start Time"),
    ("contains", ("span.kind",), "Kind"),
    ("contains", ("error",), "Error"),
    ("contains", ("http.status_code",), "Status"),
    ("contains", ("http.method",), "Method"),
    ("contains", ("http.url",), "URL"),
    ("starts", ("tags.",), "-tags."),
    ("starts", ("process.tags.",), "-process.tags."),
    ("contains", ("db.statement",), "DB Query"),
    ("contains", ("db.type",), "DB Type"),
)
TRACE_COLORS = (
    ("contains", ("traceID", "spanID", "serviceName", "operationName"), None),
    ("equals", ("duration",), "duration"),
    ("equals", ("startTimeMillis", "startTime"), None),
    ("contains", ("span.kind",), "span_kind"),
    ("contains", ("error",), "error"),
    ("contains", ("http.status_code",), "http_status"),
)
# The rules of a plain field stop at the first match, with or without a colour rule.
PLAIN_COLORS = (
    ("equals", ("timestamp", "@timestamp"), None),
    ("contains", ("level",), "severity"),
    ("equals", ("severity",), "severity"),
    ("equals", ("message", "msg"), None),
    ("contains", ("host",), None),
    ("equals", ("source",), None),
    ("contains", ("app",), None),
    ("contains", ("id", "uuid"), None),
    ("contains", ("count", "number"), "count"),
    ("contains", ("duration", "time"), "latency"),
    ("contains", ("status",), "status"),
    ("contains", ("error", "exception", "url", "uri", "ip", "address"), None),
)
_NEEDS_TYPE = {"count": ("int",), "latency": ("int", "float")}


def _holds(field: Column, how: str, words: tuple[str, ...]) -> Column:
    if how == "equals":
        return field.isin(*words)
    return _any(field.contains(w) if how == "contains" else field.startswith(w) for w in words)


def _label(field: Column, rules) -> Column:
    label = F
    for how, words, result in rules:
        value = field.substr(F.lit(len(result)), F.length(field)) if result.startswith("-") else F.lit(result)
        label = label.when(_holds(field, how, words), value)
    return label


def _color(field: Column, view_type: Column, rules) -> Column:
    color = F
    for how, words, result in rules:
        value = F.lit(result)
        if result in _NEEDS_TYPE:
            value = F.when(view_type.isin(*_NEEDS_TYPE[result]), value)
        color = color.when(_holds(field, how, words), value)
    return color


def field_view(catalogue: DataFrame) -> DataFrame:
    """One view column per catalogue row: role, label, view type, format, colour rule."""
    field, view_type, role = F.col("field"), F.col("view_type"), F.col("role")
    typed = map_types(catalogue).withColumn("role", field_role(field))
    whole_name = title_case(F.replace(field, F.lit("_"), F.lit(" ")))
    rpc = F.concat(F.lit("RPC "), title_case(F.replace(field.substr(F.lit(5), F.length(field)), F.lit("_"), F.lit(" "))))
    label = (
        F.when(role == "kubernetes", _label(field, KUBERNETES_LABELS).otherwise(field_label(field)))
        .when(
            role == "trace",
            _label(field, TRACE_LABELS).when(field.startswith("rpc."), rpc).otherwise(whole_name),
        )
    )
    shown_type = (
        F.when((role == "trace") & (field == "duration"), "float")
        .when((role == "trace") & _leads_to(field, "error"), "boolean")
        .when((role == "trace") & _leads_to(field, "http_status"), "int")
        .otherwise(view_type)
    )
    plain_color = _color(field, view_type, PLAIN_COLORS).when(F.col("type") == "boolean", F.lit("boolean"))
    color = F.when(role == "trace", _color(field, view_type, TRACE_COLORS)).when(role == "plain", plain_color)
    clock = (role == "trace") & field.isin("startTimeMillis", "startTime")
    stamped = (role == "plain") & (field.isin("timestamp", "@timestamp") | ((F.col("type") == "date") & ~_ruled(field)))
    return typed.select(
        "index", "field", "pos", "role",
        label.alias("label"),
        shown_type.alias("view_type"),
        F.when(clock, "HH:mm:ss.SSS").when(stamped, "yyyy-MM-dd HH:mm:ss").alias("date_format"),
        color.alias("colors"),
    )


def _leads_to(field: Column, color: str) -> Column:
    return F.coalesce(_color(field, F.lit("int"), TRACE_COLORS) == color, F.lit(False))


def _ruled(field: Column) -> Column:
    return _any(_holds(field, how, words) for how, words, _ in PLAIN_COLORS)
