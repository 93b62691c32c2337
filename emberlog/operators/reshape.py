"""Reshaping rows for output: field selection, canonical fields, envelopes, views."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.classify import color_class
from emberlog.functions.fields import Field, Fields, quoted
from emberlog.functions.timeexpr import rfc3339
from emberlog.operators.filters import entity_candidates, leaf_names
from emberlog.operators.views import View

# Attributes of a stored index that are not document content.
BOOKKEEPING = ("provided_name", "uid", "version")
JSON_SUFFIXES = ("@json", "@input")

VIEW_TYPES = {
    "string": "string",
    "int": "int",
    "integer": "int",
    "float": "double",
    "boolean": "boolean",
    "duration": "bigint",
}


def parse_fields(text: str) -> tuple[list[str], dict[str, str]]:
    """`"a, b:alias"` as field names and renames; an empty alias renames nothing."""
    names, aliases = [], {}
    for part in text.split(","):
        name, _, alias = (piece.strip() for piece in part.partition(":"))
        if not name:
            continue
        names.append(name)
        if alias:
            aliases[name] = alias
    return names, aliases


def pick_names(names: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """The names a list of patterns selects: `*`/`?` globs, `!` leaves out."""
    wanted = [p for p in patterns if not p.startswith("!")] or ["*"]
    banned = [p[1:] for p in patterns if p.startswith("!")]
    chosen = dict.fromkeys(n for p in wanted for n in names if n == p or fnmatch.fnmatchcase(n, p))
    return [n for n in chosen if not any(fnmatch.fnmatchcase(n, b) for b in banned)]


def select_fields(df: DataFrame, patterns: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Selected fields in the order asked for, renamed where an alias is given.

    A name is a column of `df` or a path into its structs, maps and variants; globs and
    `!` work on columns and struct members.  Unknown names are left out.
    """
    aliases = aliases or {}
    fields = Fields.of(df)
    known = dict.fromkeys(df.columns + [n for n in leaf_names(df.schema) if n in patterns])
    known.update(dict.fromkeys(n for n in patterns if n[:1] != "!" and fields.find(n) is not None))
    chosen = pick_names(list(known), patterns)
    return df.select(*[fields.find(n).column.alias(aliases.get(n, n)) for n in chosen])


def expand_labels(df: DataFrame, labels: str, names: Sequence[str]) -> DataFrame:
    """Keys of a label map as columns of their own; a column the row already has wins."""
    own = {name: quoted(name) for name in df.columns if name != labels}
    for name in names:
        label = F.try_element_at(quoted(labels), F.lit(name))
        own[name] = F.coalesce(own[name], label) if name in own else label
    return df.select(*[column.alias(name) for name, column in own.items()])


def flatten(df: DataFrame) -> DataFrame:
    """Struct members as columns with dotted names; arrays and maps stay whole."""
    fields = Fields.of(df)
    leaves = [
        found
        for found in map(fields.find, leaf_names(df.schema))
        if not isinstance(found.dtype, T.StructType)
    ]
    return df.select(*[leaf.column.alias(leaf.name) for leaf in leaves])


def _filled(field: Field) -> Column:
    """The value, with the empty string as null."""
    if isinstance(field.dtype, T.StringType):
        return F.nullif(field.column, F.lit(""))
    return field.column


def canonical_fields(df: DataFrame, mapping: Mapping[str, Sequence[str]], keep: Iterable[str] = ()) -> DataFrame:
    """Adds a column per entity from the first candidate that has a value.

    The winning candidate is emptied in that row; a candidate that cannot lose (it is
    the only one) is dropped.  A candidate already called like the entity stays, and so
    do the columns named in `keep`.
    """
    keep = set(keep)
    fields = Fields.of(df)
    added: dict[str, Column] = {}
    emptied: dict[str, Column] = {}
    dropped: list[str] = []
    for entity, names in mapping.items():
        found = [f for f in map(fields.find, names) if f is not None]
        if not found:
            continue
        same = len({f.dtype.simpleString() for f in found}) == 1
        values = [_filled(f) if same else _filled(f).cast("string") for f in found]
        added[entity] = F.coalesce(*values)
        for i, candidate in enumerate(found):
            if candidate.name == entity or candidate.name in keep or candidate.name not in df.columns:
                continue
            if len(found) == 1:
                dropped.append(candidate.name)
                continue
            lost = F.lit(False)
            for earlier in found[:i]:
                lost = lost | _filled(earlier).isNotNull()
            won = ~lost & _filled(candidate).isNotNull()
            current = emptied.get(candidate.name, candidate.column)
            emptied[candidate.name] = F.when(~won, current)
    columns = {name: quoted(name) for name in df.columns if name not in dropped}
    columns.update(emptied)
    columns.update(added)
    return df.select(*[column.alias(name) for name, column in columns.items()])


def envelope(df: DataFrame, given: Mapping[str, str | Column]) -> DataFrame:
    """Fills id, timestamp, message, severity, source, host and count from `given`.

    Existing values are never replaced; severity, source and host only arrive where
    non-empty, count only above 1, and timestamp only in rows without a time of their own.
    """
    sources = {k: quoted(v) if isinstance(v, str) else v for k, v in given.items()}
    columns = {name: quoted(name) for name in df.columns}

    def fill(name: str, value: Column):
        columns[name] = F.coalesce(columns[name], value) if name in columns else value

    for name in ("id", "message"):
        if name in sources:
            fill(name, sources[name])
    if "timestamp" in sources:
        value = rfc3339(sources["timestamp"])
        if "@timestamp" in columns:
            value = F.when(columns["@timestamp"].isNull(), value)
        if "@timestamp" not in columns or "timestamp" in columns:
            fill("timestamp", value)
    for name in ("severity", "source", "host"):
        if name in sources:
            fill(name, F.nullif(sources[name], F.lit("")))
    if "count" in sources:
        fill("count", F.when(sources["count"] > 1, sources["count"]))
    return df.select(*[column.alias(name) for name, column in columns.items()])


def millis_to_timestamp(df: DataFrame) -> DataFrame:
    """`timestamp` (RFC 3339) from columns whose name ends in `millis`, which stay."""
    found = [n for n in df.columns if n.lower().endswith("millis")]
    if not found:
        return df
    times = [rfc3339(F.timestamp_millis(quoted(n).try_cast("bigint"))) for n in found]
    existing = [quoted("timestamp").cast("string")] if "timestamp" in df.columns else []
    return df.withColumn("timestamp", F.coalesce(*existing, *times))


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(*BOOKKEEPING)


def parse_json_fields(df: DataFrame) -> DataFrame:
    """Text columns ending in `@json` or `@input` as variants; text that is not JSON stays text."""
    columns = []
    for member in df.schema.fields:
        column = quoted(member.name)
        if member.name.endswith(JSON_SUFFIXES) and isinstance(member.dataType, T.StringType):
            column = F.coalesce(F.try_parse_json(column), column.cast("variant")).alias(member.name)
        columns.append(column)
    return df.select(*columns)


def _conform(field: Field, target: str, date_format: str | None) -> Column:
    if date_format and isinstance(field.dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(field.column, date_format)
    if date_format and field.epoch_millis and isinstance(field.dtype, T.IntegralType):
        return F.date_format(F.timestamp_millis(field.column), date_format)
    value = _filled(field)
    if isinstance(field.dtype, T.StringType) and target != "string":
        return value.try_cast(target)
    return value.cast(target)


def apply_view(df: DataFrame, view: View, colors: bool = False) -> DataFrame:
    """The columns of a view, each from the first field that can supply it, else null.

    A field supplies a column if it has its name (any case) or matches it as an entity.
    With `colors`, columns that have colour rules get a `<name>_color` column.
    """
    fields = Fields.of(df)
    names = [n for n in leaf_names(df.schema) if not isinstance(fields.find(n).dtype, (T.StructType, T.ArrayType))]
    out = []
    for column in view.columns:
        exact = [n for n in names if n.lower() == column.name.lower()]
        candidates = list(dict.fromkeys(exact + entity_candidates(names, column.name)))
        target = VIEW_TYPES[column.type]
        values = [_conform(fields.find(n), target, column.date_format) for n in candidates]
        value = F.coalesce(*values) if values else F.lit(None).cast(target)
        out.append(value.alias(column.name))
        if colors and column.colors:
            out.append(color_class(value, column.colors).alias(f"{column.name}_color"))
    return df.select(*out)


def combine_views(frames: Iterable[DataFrame], view: View) -> DataFrame:
    """Rows of several sources under one view; each source is conformed before the union."""
    conformed = [apply_view(frame, view) for frame in frames]
    result = conformed[0]
    for frame in conformed[1:]:
        result = result.unionByName(frame)
    return result
