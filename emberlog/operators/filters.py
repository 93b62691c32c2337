"""Filters every export and sample applies: time range, entities, both with a query."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from emberlog.functions.fields import Fields
from emberlog.functions.timeexpr import resolve_range
from emberlog.operators import predicates as P

# Entities, and the suffix patterns a field name is matched by, best first.
ENTITIES = ("namespace", "pod", "deployment", "container", "service", "operation")
ENTITY_SUFFIXES = ("{0}", ".{0}.name", ".{0}", "{0}name")

# Words that make a field look like an entity that has no field of its own.
LOOKALIKE_WORDS = {
    "namespace": ("namespace",),
    "pod": ("pod",),
    "deployment": ("deployment", "app", "k8s", "kubernetes"),
    "container": ("container", "k8s", "kubernetes"),
    "service": ("service",),
    "operation": ("operation",),
}

# Warning texts.
NOT_APPLIED = "{origin} {entity} filter '{value}' cannot be applied - no suitable {entity} field found in {kind} logs"
LOOKALIKES = ". Available similar fields: {fields}"


def time_range(fields: Fields, time_field: str, frm=None, to=None) -> Column:
    """Both ends inclusive, either may be open."""
    lo, hi = resolve_range(frm, to, fields.now)
    bounds = {op: value for op, value in (("gte", lo), ("lte", hi)) if value is not None}
    return P.range_of(fields.find(time_field), bounds, fields.now)


def normalize_name(name: str) -> str:
    return name.lower().translate(str.maketrans("_@-", "..."))


def entity_candidates(names: Iterable[str], entity: str) -> list[str]:
    """Fields of one schema that may hold an entity, best pattern first."""
    wanted = normalize_name(entity)
    names = list(names)
    found: dict[str, None] = {}
    for suffix in ENTITY_SUFFIXES:
        found.update(dict.fromkeys(n for n in names if normalize_name(n).endswith(suffix.format(wanted))))
    found.update(dict.fromkeys(n for n in names if normalize_name(n).startswith(wanted)))
    return list(found)


def leaf_names(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of a schema, a struct before its members."""
    names = []
    for member in schema.fields:
        names.append(prefix + member.name)
        if isinstance(member.dataType, T.StructType):
            names.extend(leaf_names(member.dataType, f"{prefix}{member.name}."))
    return names


def entity_mapping(df: DataFrame) -> dict[str, list[str]]:
    """Entity -> fields of `df` that may hold it; structs themselves do not qualify."""
    fields = Fields.of(df)
    names = [n for n in leaf_names(df.schema) if not isinstance(fields.find(n).dtype, T.StructType)]
    return {entity: entity_candidates(names, entity) for entity in ENTITIES}


def entity_predicate(fields: Fields, candidates: Iterable[str], value: str) -> Column:
    """`value` in any of the candidate fields: a phrase, or a wildcard where it has `*`/`?`."""
    found = [fields.find(name) for name in candidates]
    if any(mark in value for mark in "*?"):
        return P.any_of(P.wildcard(f, value) for f in found)
    return P.any_of(P.match_phrase(f, value, now=fields.now) for f in found)


def entity_filters(fields: Fields, mapping: Mapping[str, list[str]], wanted: Mapping[str, str]) -> Column:
    """All given entities must match; an entity without any field is not applied."""
    unknown = set(wanted) - set(ENTITIES)
    if unknown:
        raise ValueError(f"unknown entity {sorted(unknown)}")
    return P.all_of(
        entity_predicate(fields, mapping[entity], wanted[entity])
        for entity in ENTITIES
        if wanted.get(entity) and mapping.get(entity)
    )


def unmapped_entities(names: Iterable[str], mapping: Mapping[str, list[str]], wanted: Mapping[str, str]) -> dict:
    """Entities asked for that no field holds -> up to five fields that look alike."""
    lookalikes = {}
    for entity in ENTITIES:
        if wanted.get(entity) and not mapping.get(entity):
            words = LOOKALIKE_WORDS[entity]
            lookalikes[entity] = sorted(n for n in set(names) if any(w in n.lower() for w in words))[:5]
    return lookalikes


def filter_warnings(
    names: Iterable[str], mapping: Mapping[str, list[str]], wanted: Mapping[str, str], kind: str = "generic"
) -> list[str]:
    """One line per entity filter that cannot be applied."""
    lines = []
    for entity, alike in unmapped_entities(names, mapping, wanted).items():
        origin = "OTEL" if entity in ("service", "operation") else "Kubernetes"
        line = NOT_APPLIED.format(origin=origin, entity=entity, value=wanted[entity], kind=kind)
        lines.append(line + (LOOKALIKES.format(fields=", ".join(alike)) if alike else ""))
    return lines
