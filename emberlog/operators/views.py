"""Named views: which columns a log kind is shown with, and how they are typed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from emberlog.functions import classify as C
from emberlog.functions.timeexpr import DISPLAY_CLOCK, DISPLAY_DATETIME


@dataclass(frozen=True)
class ViewColumn:
    name: str
    type: str = "string"
    label: str = ""
    date_format: str | None = None
    colors: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class View:
    columns: tuple[ViewColumn, ...]

    @classmethod
    def of(cls, columns: list[dict]) -> View:
        """A view of one's own, from dicts: name and, if wanted, type, label, date_format, color_options."""
        known = ("name", "type", "label", "date_format")
        return cls(tuple(
            ViewColumn(**{k: c[k] for k in known if k in c}, colors=c.get("color_options", {})) for c in columns
        ))

    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def only(self, *names: str) -> tuple[ViewColumn, ...]:
        return tuple(c for c in self.columns if c.name in names)


# The columns of every view, in order.
_TIME = ViewColumn("timestamp", label="Time", date_format=DISPLAY_DATETIME)
_START = ViewColumn("start_time", label="Start Time", date_format=DISPLAY_CLOCK)
_TRACE = ViewColumn("trace_id", label="Trace ID")
_SPAN = ViewColumn("span_id", label="Span ID")
_NAMESPACE = ViewColumn("namespace", label="Namespace")
_POD = ViewColumn("pod", label="Pod")
_CONTAINER = ViewColumn("container", label="Container")
_MESSAGE = ViewColumn("message", label="Message")
_LEVEL = ViewColumn("level", label="Level", colors=C.SEVERITY)
_SERVICE = ViewColumn("service", label="Service")
_OPERATION = ViewColumn("operation", label="Operation")
_DURATION = ViewColumn("duration", "float", "Duration (μs)", colors=C.DURATION_MICROS)
_ERROR = ViewColumn("error", "boolean", "Error", colors=C.ERROR_FLAG)

KUBERNETES = View((
    _TIME, _NAMESPACE, _POD, _CONTAINER, _MESSAGE, _LEVEL,
    ViewColumn("node", label="Node"),
    ViewColumn("deployment", label="Deployment"),
))
OTEL = View((
    ViewColumn("timestamp", label="Timestamp", date_format=DISPLAY_DATETIME),
    _NAMESPACE, _POD, _CONTAINER, _SERVICE, _OPERATION,
    ViewColumn("duration", "duration", "Duration (μs)", colors=C.DURATION_MICROS),
    ViewColumn("span_kind", label="Kind", colors=C.SPAN_KIND),
    _ERROR,
))
OTEL_HTTP = View((
    _START, _TRACE, _SPAN, _SERVICE, _OPERATION,
    ViewColumn("http_method", label="Method"),
    ViewColumn("http_status", "int", "Status", colors=C.HTTP_STATUS),
    ViewColumn("http_url", label="URL"),
    ViewColumn("http_route", label="Route"),
    ViewColumn("http_user_agent", label="User Agent"),
    _DURATION, _ERROR, _NAMESPACE, _POD, _CONTAINER,
))
OTEL_DB = View((
    _START, _TRACE, _SPAN, _SERVICE, _OPERATION,
    ViewColumn("db_system", label="DB System"),
    ViewColumn("db_name", label="Database"),
    ViewColumn("db_statement", label="Statement"),
    ViewColumn("db_operation", label="DB Operation"),
    ViewColumn("db_user", label="DB User"),
    _DURATION, _ERROR, _NAMESPACE, _POD, _CONTAINER,
))
SYSLOG = View((
    _TIME,
    ViewColumn("hostname", label="Hostname"),
    ViewColumn("program", label="Program"),
    ViewColumn("pid", "integer", "PID"),
    ViewColumn("severity", label="Severity", colors=C.SYSLOG_SEVERITY),
    ViewColumn("facility", label="Facility"),
    _MESSAGE,
    ViewColumn("tag", label="Tag"),
    _NAMESPACE, _POD, _CONTAINER,
))
KUBERNETES_WIDE = View((
    ViewColumn("@timestamp", label="Time", date_format=DISPLAY_DATETIME),
    ViewColumn("kubernetes.namespace", label="Namespace"),
    ViewColumn("kubernetes.pod.name", label="Pod"),
    ViewColumn("kubernetes.container.name", label="Container"),
    _MESSAGE, _LEVEL,
    ViewColumn("kubernetes.node.name", label="Node"),
    ViewColumn("kubernetes.deployment.name", label="Deployment"),
    ViewColumn("cloud.provider", label="Cloud Provider"),
    ViewColumn("cloud.region", label="Region"),
    ViewColumn("agent.type", label="Agent"),
))
JAEGER = View((
    ViewColumn("startTimeMillis", label="Start Time", date_format=DISPLAY_CLOCK),
    ViewColumn("startTime", label="Start Time", date_format=DISPLAY_CLOCK),
    ViewColumn("traceID", label="Trace ID"),
    ViewColumn("spanID", label="Span ID"),
    ViewColumn("serviceName", label="Service"),
    ViewColumn("operationName", label="Operation"),
    _DURATION,
    ViewColumn("span.kind", label="Kind", colors=C.SPAN_KIND),
    _ERROR,
    ViewColumn("http.status_code", "int", "Status", colors=C.HTTP_STATUS),
    ViewColumn("http.method", label="Method"),
    ViewColumn("http.url", label="URL"),
))
COMBINED = View(
    KUBERNETES_WIDE.only("@timestamp")
    + JAEGER.only("traceID", "spanID", "serviceName", "operationName", "duration", "error")
    + KUBERNETES_WIDE.only(
        "kubernetes.namespace", "kubernetes.pod.name", "kubernetes.container.name", "message", "level"
    )
)

VIEWS = {
    "kubernetes": KUBERNETES,
    "otel": OTEL,
    "otel.http": OTEL_HTTP,
    "otel.db": OTEL_DB,
    "syslog": SYSLOG,
}
PRESETS = {
    "kubernetes": KUBERNETES_WIDE, "k8s": KUBERNETES_WIDE, "filebeat": KUBERNETES_WIDE,
    "jaeger": JAEGER, "traces": JAEGER, "tracing": JAEGER,
    "combined": COMBINED, "both": COMBINED,
}


def view_named(name: str, preset: bool = False) -> View:
    first, second = (PRESETS, VIEWS) if preset else (VIEWS, PRESETS)
    if name not in first and name not in second:
        raise KeyError(f"no view {name!r}, known: {sorted({*VIEWS, *PRESETS})}")
    return first.get(name) or second[name]
