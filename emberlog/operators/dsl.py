"""Query bodies given as dicts, turned into predicates.

`compile_query` handles the `query` part, clause by clause; `Body` splits a request
into query, sort, aggregations, field list and size.
"""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import Fields
from emberlog.operators import predicates as P
from emberlog.operators import stored
from emberlog.operators.search import search_predicate
from emberlog.operators.similar import Terms, similar


@dataclass(frozen=True)
class Hit:
    """Which rows a clause matches, and the score of a row it matches."""

    matches: Column
    score: Column


class QueryError(ValueError):
    pass


def compile_query(fields: Fields, query: dict) -> Hit:
    if not isinstance(query, dict) or len(query) != 1:
        raise QueryError(f"a query is a dict with exactly one clause, got {query!r}")
    ((name, body),) = query.items()
    if name not in CLAUSES:
        raise QueryError(f"unknown clause {name!r}")
    return CLAUSES[name](fields, body)


def _one_field(name: str, body: dict, value_key: str):
    """`{field: value}` or `{field: {value_key: value, option: ...}}`."""
    options = {k: v for k, v in body.items() if k in ("boost", "case_insensitive", "_name")}
    named = {k: v for k, v in body.items() if k not in options}
    if len(named) != 1:
        raise QueryError(f"{name} takes exactly one field, got {sorted(named)}")
    ((field, value),) = named.items()
    if isinstance(value, dict):
        options.update({k: v for k, v in value.items() if k != value_key})
        if value_key not in value:
            raise QueryError(f"{name} on {field!r} needs {value_key!r}")
        value = value[value_key]
    return field, value, options


def _boost(options: dict) -> Column:
    return F.lit(float(options.get("boost", 1.0)))


def _as_list(value) -> list:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def _weighted(name: str) -> tuple[str, float]:
    field, _, boost = name.partition("^")
    return field, float(boost or 1.0)


def _expand(fields: Fields, names) -> list[tuple[str, float]]:
    """Field names of a multi-field clause; `*` patterns stand for columns."""
    out = []
    for name in _as_list(names):
        field, boost = _weighted(name)
        if any(mark in field for mark in "*?"):
            out.extend((f, boost) for f in fields.schema.fieldNames() if fnmatch.fnmatchcase(f, field))
        else:
            out.append((field, boost))
    return out


# ------------------------------------------------------------------- text


def _scored_match(fields: Fields, name: str, value, operator: str = "or", boost: float = 1.0) -> Hit:
    field = fields.find(name)
    matches = P.match(field, value, operator, fields.now)
    if field is not None and field.text and not isinstance(field.dtype, T.ArrayType):
        return Hit(matches, P.match_count(field, value) * F.lit(boost))
    return Hit(matches, F.lit(boost))


def _match(fields: Fields, body: dict) -> Hit:
    name, value, options = _one_field("match", body, "query")
    unknown = set(options) - {"operator", "boost", "minimum_should_match", "_name"}
    if unknown:
        raise QueryError(f"unsupported match option {sorted(unknown)}")
    hit = _scored_match(fields, name, value, options.get("operator", "or"), float(options.get("boost", 1.0)))
    field, words = fields.find(name), list(dict.fromkeys(P.analyze(value)))
    wanted = _minimum(options.get("minimum_should_match"), len(words), 1)
    if field is not None and field.text and wanted > 1:
        return Hit(P.match_count(field, value) >= wanted, hit.score)
    return hit


def _match_all(fields: Fields, body: dict) -> Hit:
    return Hit(P.always(), _boost(body or {}))


def _known(name: str, options, allowed: str) -> None:
    unknown = set(options) - set(allowed.split())
    if unknown:
        raise QueryError(f"unknown {name} option {sorted(unknown)}")


def _match_phrase(fields: Fields, body: dict) -> Hit:
    name, value, options = _one_field("match_phrase", body, "query")
    _known("match_phrase", options, "slop boost _name")
    return Hit(P.match_phrase(fields.find(name), value, fields.now, slop=int(options.get("slop", 0))), _boost(options))


def _match_phrase_prefix(fields: Fields, body: dict) -> Hit:
    name, value, options = _one_field("match_phrase_prefix", body, "query")
    _known("match_phrase_prefix", options, "boost _name")
    return Hit(P.match_phrase(fields.find(name), value, fields.now, last_is_prefix=True), _boost(options))


def _multi_match(fields: Fields, body: dict) -> Hit:
    _known("multi_match", body, "query fields type operator tie_breaker minimum_should_match slop boost _name")
    kind, operator = body.get("type", "best_fields"), str(body.get("operator", "or")).lower()
    if kind not in ("best_fields", "most_fields", "cross_fields", "phrase", "phrase_prefix"):
        raise QueryError(f"unknown multi_match type {kind!r}")
    words = list(dict.fromkeys(P.analyze(body["query"])))
    wanted = len(words) if operator == "and" else max(_minimum(body.get("minimum_should_match"), len(words), 1), 1)
    named = [(fields.find(name), name, boost) for name, boost in _expand(fields, body["fields"])]
    if kind == "cross_fields":
        # Word by word: each may stand in another field.
        held = _total([F.when(P.any_of(P.match(f, w, now=fields.now) for f, _, _ in named), 1).otherwise(0) for w in words])
        return Hit(held >= wanted if words else P.never(), held.cast("double") * _boost(body))
    hits = []
    for field, name, boost in named:
        if kind in ("phrase", "phrase_prefix"):
            matches = P.match_phrase(field, body["query"], fields.now, kind == "phrase_prefix", int(body.get("slop", 0)))
            hits.append(Hit(matches, F.lit(boost)))
            continue
        hit = _scored_match(fields, name, body["query"], operator, boost)
        if operator != "and" and wanted > 1 and field is not None and field.text:
            hit = Hit(P.match_count(field, body["query"]) >= wanted, hit.score)
        hits.append(hit)
    return _best_of(hits, float(body.get("tie_breaker", 1.0 if kind == "most_fields" else 0.0)), _boost(body))


def _query_string(fields: Fields, body) -> Hit:
    body = {"query": body} if isinstance(body, str) else body
    _known("query_string", body, "query fields default_field default_operator minimum_should_match boost _name")
    names = [n for n, _ in _expand(fields, body.get("fields"))] or _as_list(body.get("default_field")) or None
    names = None if names == ["*"] else names
    operator = body.get("default_operator", "OR")
    if "minimum_should_match" in body and operator.upper() == "OR":
        words = body["query"].split()
        if not all(re.fullmatch(r"\w+", w) for w in words) or {"AND", "OR", "NOT"} & set(words):
            raise QueryError("minimum_should_match of query_string counts plain words")
        held = _total([F.when(search_predicate(fields, w, names, operator), 1).otherwise(0) for w in words])
        return Hit(held >= max(_minimum(body["minimum_should_match"], len(words), 1), 1) if words else P.never(), _boost(body))
    return Hit(search_predicate(fields, body["query"], names, operator), _boost(body))


_SIMPLE = re.compile(r'(?P<op>[+|])|(?P<neg>-?)(?:"(?P<phrase>[^"]*)"|(?P<word>[^\s+|"]+))')


def _simple_query_string(fields: Fields, body: dict) -> Hit:
    """`+` and, `|` or, `-` not, `"phrase"`, `prefix*`; read from left to right."""
    names = [n for n, _ in _expand(fields, body.get("fields"))]
    found = [fields.find(n) for n in names] if names else fields.text()
    default = P.all_of if body.get("default_operator", "or").lower() == "and" else P.any_of
    result, join = None, None
    for token in _SIMPLE.finditer(body["query"]):
        if token["op"]:
            join = P.all_of if token["op"] == "+" else P.any_of
            continue
        if token["phrase"] is not None:
            part = P.any_of(P.match_phrase(f, token["phrase"]) for f in found)
        elif token["word"].endswith("*") and len(token["word"]) > 1:
            part = P.any_of(P.match_phrase(f, token["word"][:-1], last_is_prefix=True) for f in found)
        else:
            part = P.any_of(P.match(f, token["word"]) for f in found)
        part = P.negate(part) if token["neg"] else part
        result = part if result is None else (join or default)([result, part])
        join = None
    return Hit(P.never() if result is None else result, _boost(body))


_TERM_SETTINGS = ("max_query_terms", "min_term_freq", "min_doc_freq", "max_doc_freq", "min_word_length", "max_word_length")


def _more_like_this(fields: Fields, body: dict) -> Hit:
    unknown = set(body) - {"fields", "like", "unlike", "minimum_should_match", "stop_words", "include", "boost", "_name", *_TERM_SETTINGS}
    if unknown:
        raise QueryError(f"unknown more_like_this option {sorted(unknown)}")
    if fields.rows is None:
        raise QueryError("more_like_this reads the whole table: it can't stand within a nested query")
    names = [n for n, _ in _expand(fields, body.get("fields"))] or [f.name for f in fields.text()]
    like, unlike = _as_list(body.get("like")), _as_list(body.get("unlike"))
    ids = [item["_id"] for item in like if isinstance(item, dict)]
    if not like or any(isinstance(item, dict) for item in unlike):
        raise QueryError("more_like_this takes texts or documents by _id as like, and texts as unlike")
    if ids and (fields.id_field is None or fields.find(fields.id_field) is None):
        raise QueryError("more_like_this names documents, but the table has no field that names its rows (tie_break)")
    settings = {key: int(body[key]) for key in _TERM_SETTINGS if key in body}
    matches, shared = similar(
        fields, names, ids, [x for x in like if isinstance(x, str)], unlike,
        Terms(stop_words=tuple(_as_list(body.get("stop_words"))), minimum_should_match=body.get("minimum_should_match", "30%"), **settings),
        bool(body.get("include", False)),
    )
    return Hit(matches, shared * _boost(body))


def _percolate(fields: Fields, body: dict) -> Hit:
    """Rows whose stored query, JSON text in `field`, matches one of the given documents."""
    unknown = set(body) - {"field", "document", "documents", "boost", "_name"}
    documents = body.get("documents") or _as_list(body.get("document"))
    if unknown or not documents or fields.rows is None:
        raise QueryError(f"percolate takes a field and documents, not within a nested query, got {sorted(body)}")
    field = fields.find(body["field"])
    if field is None:
        return Hit(P.never(), _boost(body))
    queries = stored.queries_of(fields.rows.select(field.column.alias("name"), field.column.alias("body")).distinct(), "name", "body")
    rows = stored.as_rows(fields.rows.sparkSession, documents)
    there = Fields.of(rows, fields.text_fields, now=fields.now)
    met = stored.percolate(rows, queries, there, "__stored", lambda f, q: compile_query(f, q).matches).select("__stored").distinct()
    return Hit(met.where(F.col("__stored") == field.column.cast("string").outer()).exists(), _boost(body))


# ------------------------------------------------------------- exact values


def _term(fields: Fields, body: dict) -> Hit:
    name, value, options = _one_field("term", body, "value")
    matches = P.term(fields.find(name), value, bool(options.get("case_insensitive")), fields.now)
    return Hit(matches, _boost(options))


def _terms(fields: Fields, body: dict) -> Hit:
    named = {k: v for k, v in body.items() if k not in ("boost", "_name")}
    ((name, values),) = named.items()
    field = fields.find(name)
    if isinstance(values, DataFrame):
        # A long list held as a one-column table: a semi join Spark sizes for itself.
        if field is None:
            return Hit(P.never(), _boost(body))
        listed = values.toDF("__listed").distinct()
        return Hit(listed.where(F.col("__listed") == field.column.outer()).exists(), _boost(body))
    return Hit(P.terms(field, values, fields.now), _boost(body))


# Date formats a range may name.
RANGE_FORMATS = ("strict_date_optional_time", "date_optional_time", "epoch_millis", "epoch_second")


def _range(fields: Fields, body: dict) -> Hit:
    named = {k: v for k, v in body.items() if k not in ("boost", "_name")}
    ((name, bounds),) = named.items()
    options = {"gte", "gt", "lte", "lt", "from", "to", "boost", "_name", "time_zone", "format", "include_lower", "include_upper"}
    if set(bounds) - options:
        raise QueryError(f"unknown range option {sorted(set(bounds) - options)}")
    known = {k: v for k, v in bounds.items() if k in ("gte", "gt", "lte", "lt")}
    for old, new, flag in (("from", "gte", "include_lower"), ("to", "lte", "include_upper")):
        if bounds.get(old) is not None:
            known.setdefault(new if bounds.get(flag, True) else new[:-1], bounds[old])
    if set(str(bounds.get("format", RANGE_FORMATS[0])).split("||")) - set(RANGE_FORMATS):
        raise QueryError(f"unsupported range format {bounds['format']!r}, known: {RANGE_FORMATS}")
    if "epoch_second" in str(bounds.get("format")):
        known = {k: datetime.fromtimestamp(int(v), timezone.utc) if re.fullmatch(r"-?\d+", str(v)) else v for k, v in known.items()}
    elif "epoch_millis" in str(bounds.get("format")):
        known = {k: datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=int(v)) if re.fullmatch(r"-?\d+", str(v)) else v for k, v in known.items()}
    if bounds.get("time_zone"):
        known = {k: _in_zone(v, bounds["time_zone"]) for k, v in known.items()}
    field = fields.find(name)
    return Hit(P.range_of(field, known, fields.now) if known else P.exists(field), _boost({**bounds, **body}))


def _in_zone(bound, zone: str):
    """A date or time without a zone of its own, read in `zone`; anything else as it is."""
    if not isinstance(bound, str) or not re.fullmatch(r"\d{4}-\d\d-\d\d([T ]\d\d:\d\d:\d\d(\.\d+)?)?", bound):
        return bound
    offset = re.fullmatch(r"([+-])(\d\d):?(\d\d)", zone)
    if offset:
        minutes = int(offset[1] + "1") * (60 * int(offset[2]) + int(offset[3]))
        where = timezone(timedelta(minutes=minutes))
    else:
        try:
            where = ZoneInfo(zone)
        except (ValueError, ZoneInfoNotFoundError) as error:
            raise QueryError(f"unknown time_zone {zone!r}") from error
    return datetime.fromisoformat(bound).replace(tzinfo=where)


def _exists(fields: Fields, body: dict) -> Hit:
    return Hit(P.exists(fields.find(body["field"])), _boost(body))


def _string_clause(name: str, leaf: Callable) -> Callable[[Fields, dict], Hit]:
    def clause(fields: Fields, body: dict) -> Hit:
        key = "wildcard" if name == "wildcard" and _holds_key(body, "wildcard") else "value"
        field, value, options = _one_field(name, body, key)
        return Hit(leaf(fields.find(field), value, bool(options.get("case_insensitive"))), _boost(options))

    return clause


def _holds_key(body: dict, key: str) -> bool:
    return any(isinstance(v, dict) and key in v for v in body.values())


def _fuzzy(fields: Fields, body: dict) -> Hit:
    name, value, options = _one_field("fuzzy", body, "value")
    matches = P.fuzzy(
        fields.find(name), value, options.get("fuzziness", "AUTO"), int(options.get("prefix_length", 0))
    )
    return Hit(matches, _boost(options))


# ---------------------------------------------------------------- compound


def _score_if(hit: Hit) -> Column:
    return F.when(hit.matches, hit.score).otherwise(F.lit(0.0))


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) if columns else F.lit(0.0)


def _minimum(setting, count: int, default: int) -> int:
    if setting is None:
        return default
    text = str(setting)
    if text.endswith("%"):
        share = int(text[:-1])
        return count * share // 100 if share >= 0 else count - count * -share // 100
    return int(text) if int(text) >= 0 else max(count + int(text), 0)


def _bool(fields: Fields, body: dict) -> Hit:
    unknown = set(body) - {"must", "filter", "must_not", "should", "minimum_should_match", "boost", "_name"}
    if unknown:
        raise QueryError(f"unknown bool part {sorted(unknown)}")
    must, needed, banned, should = (
        [compile_query(fields, q) for q in _as_list(body.get(part))]
        for part in ("must", "filter", "must_not", "should")
    )
    wanted = _minimum(
        body.get("minimum_should_match"), len(should), 0 if must or needed or not should else 1
    )
    parts = [hit.matches for hit in must + needed] + [P.negate(hit.matches) for hit in banned]
    if wanted == 1:
        parts.append(P.any_of(hit.matches for hit in should))
    elif wanted > 1:
        held = _total([F.when(hit.matches, 1).otherwise(0) for hit in should])
        parts.append(held >= wanted)
    score = _total([hit.score for hit in must] + [_score_if(hit) for hit in should])
    return Hit(P.all_of(parts), score * _boost(body))


def _constant_score(fields: Fields, body: dict) -> Hit:
    return Hit(compile_query(fields, body["filter"]).matches, _boost(body))


def _best_of(hits: list[Hit], tie_breaker: float, boost: Column) -> Hit:
    if not hits:
        return Hit(P.never(), boost)
    scores = [_score_if(hit) for hit in hits]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    score = best + F.lit(tie_breaker) * (_total(scores) - best)
    return Hit(P.any_of(hit.matches for hit in hits), score * boost)


def _dis_max(fields: Fields, body: dict) -> Hit:
    hits = [compile_query(fields, q) for q in _as_list(body["queries"])]
    return _best_of(hits, float(body.get("tie_breaker", 0.0)), _boost(body))


def _boosting(fields: Fields, body: dict) -> Hit:
    positive = compile_query(fields, body["positive"])
    negative = compile_query(fields, body["negative"])
    damped = F.when(negative.matches, F.lit(float(body["negative_boost"]))).otherwise(F.lit(1.0))
    return Hit(positive.matches, positive.score * damped * _boost(body))


_MODIFIERS = {
    "none": lambda x: x,
    "log": lambda x: F.log10(x),
    "log1p": lambda x: F.log10(x + 1),
    "log2p": lambda x: F.log10(x + 2),
    "ln": lambda x: F.ln(x),
    "ln1p": lambda x: F.log1p(x),
    "ln2p": lambda x: F.ln(x + 2),
    "square": lambda x: x * x,
    "sqrt": lambda x: F.sqrt(x),
    "reciprocal": lambda x: F.lit(1.0) / x,
}


def _function_value(fields: Fields, function: dict) -> Column:
    value = F.lit(1.0)
    if "field_value_factor" in function:
        spec = function["field_value_factor"]
        column = fields.find(spec["field"]).column.cast("double")
        if "missing" in spec:
            column = F.coalesce(column, F.lit(float(spec["missing"])))
        value = _MODIFIERS[spec.get("modifier", "none").lower()](column * F.lit(float(spec.get("factor", 1.0))))
    elif "random_score" in function:
        spec = function["random_score"]
        key = [fields.find(spec["field"]).column] if spec.get("field") else [
            F.struct(*[fields.find(f).column for f in fields.schema.fieldNames()])
        ]
        # A hash of the row and the seed: the same rows score the same on every run and retry.
        hashed = F.xxhash64(*key, F.lit(int(spec.get("seed", 0))))
        value = F.pmod(hashed, F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))
    elif set(function) - {"weight", "filter"}:
        raise QueryError(f"unsupported score function {sorted(function)}")
    return value * F.lit(float(function.get("weight", 1.0)))


_COMBINE = {
    "multiply": lambda a, b: a * b,
    "sum": lambda a, b: a + b,
    "max": lambda a, b: F.greatest(a, b),
    "min": lambda a, b: F.least(a, b),
    "avg": lambda a, b: (a + b) / 2,
    "replace": lambda a, b: b,
}


def _function_score(fields: Fields, body: dict) -> Hit:
    inner = compile_query(fields, body.get("query", {"match_all": {}}))
    listed = _as_list(body.get("functions")) or [
        {k: body[k] for k in ("field_value_factor", "random_score", "weight") if k in body}
    ]
    applied = []
    for function in listed:
        guard = compile_query(fields, function["filter"]).matches if "filter" in function else P.always()
        applied.append((guard, _function_value(fields, function), float(function.get("weight", 1.0))))
    factor = _join_functions(applied, body.get("score_mode", "multiply"))
    if "max_boost" in body:
        factor = F.least(factor, F.lit(float(body["max_boost"])))
    score = _COMBINE[body.get("boost_mode", "multiply")](inner.score, factor) * _boost(body)
    matches = inner.matches
    if "min_score" in body:
        matches = matches & (score >= F.lit(float(body["min_score"])))
    return Hit(matches, score)


def _join_functions(applied: list[tuple[Column, Column, float]], mode: str) -> Column:
    """One factor out of the functions whose filter holds; 1 where none does."""
    values = [F.when(guard, value) for guard, value, _ in applied]
    if mode == "first":
        return F.coalesce(*values, F.lit(1.0))
    if mode in ("max", "min"):
        pick = F.greatest if mode == "max" else F.least
        return F.coalesce(pick(*values) if len(values) > 1 else values[0], F.lit(1.0))
    if mode == "multiply":
        return reduce(lambda a, b: a * b, [F.coalesce(v, F.lit(1.0)) for v in values])
    total = _total([F.coalesce(v, F.lit(0.0)) for v in values])
    weight = _total([F.when(guard, F.lit(w)).otherwise(F.lit(0.0)) for guard, _, w in applied])
    if mode == "avg":
        return F.when(weight > 0, total / weight).otherwise(F.lit(1.0))
    if mode == "sum":
        return F.when(P.any_of(guard for guard, _, _ in applied), total).otherwise(F.lit(1.0))
    raise QueryError(f"unknown score_mode {mode!r}")


# ------------------------------------------------------- arrays and relations


def _nested(fields: Fields, body: dict) -> Hit:
    """All conditions hold in the same element of an array of structs."""
    field = fields.find(body["path"])
    if field is None:
        if body.get("ignore_unmapped"):
            return Hit(P.never(), F.lit(0.0))
        raise QueryError(f"no nested field {body['path']!r}")
    if isinstance(field.dtype, T.StructType):
        return compile_query(fields, body["query"])

    def holds(element: Column) -> Column:
        return compile_query(fields.inside(field.name, element, field.element_type), body["query"]).matches

    return Hit(F.exists(field.column, holds), _boost(body))


def _related(fields: Fields, body: dict, kind_key: str) -> Hit:
    kind = body.get(kind_key) or body.get("type")
    options = {kind_key, "type", "query", "boost", "_name", "min_children", "max_children", "ignore_unmapped", "score_mode", "score"}
    if set(body) - options:
        raise QueryError(f"unknown option {sorted(set(body) - options)}")
    relation = fields.relations.get(kind)
    if relation is None:
        if body.get("ignore_unmapped"):
            return Hit(P.never(), F.lit(0.0))
        raise QueryError(f"no relation {kind!r}, known: {sorted(fields.relations)}")
    there = replace(Fields.of(relation.df, relation.text_fields), now=fields.now)
    inner = compile_query(there, body["query"]).matches
    # Keys are made distinct before the exchange, so a key with very many rows is one row.
    key = there.find(relation.there).column.alias("__key")
    least, most = int(body.get("min_children", 1)), body.get("max_children")
    if kind_key == "type" and (least > 1 or most is not None):
        counted = relation.df.where(inner).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        keys = counted.where((F.col("__n") >= least) & (F.lit(True) if most is None else F.col("__n") <= int(most))).select("__key")
    else:
        keys = relation.df.where(inner).select(key).distinct()
    # An EXISTS: Spark plans a semi join, an anti join under NOT, a flag join under OR.
    tied = keys.where(F.col("__key") == fields.find(relation.here).column.outer())
    return Hit(tied.exists(), _boost(body))


CLAUSES: dict[str, Callable[[Fields, dict], Hit]] = {
    "match": _match,
    "match_all": _match_all,
    "match_phrase": _match_phrase,
    "match_phrase_prefix": _match_phrase_prefix,
    "multi_match": _multi_match,
    "query_string": _query_string,
    "simple_query_string": _simple_query_string,
    "term": _term,
    "terms": _terms,
    "range": _range,
    "exists": _exists,
    "prefix": _string_clause("prefix", P.prefix),
    "wildcard": _string_clause("wildcard", P.wildcard),
    "regexp": _string_clause("regexp", P.regexp),
    "fuzzy": _fuzzy,
    "bool": _bool,
    "constant_score": _constant_score,
    "dis_max": _dis_max,
    "function_score": _function_score,
    "boosting": _boosting,
    "nested": _nested,
    "has_child": lambda fields, body: _related(fields, body, "type"),
    "has_parent": lambda fields, body: _related(fields, body, "parent_type"),
    "percolate": _percolate,
    "more_like_this": _more_like_this,
}


@dataclass(frozen=True)
class Body:
    """A search request: what to match, how to order, what to return."""

    query: dict | None = None
    sort: list | None = None
    aggs: dict | None = None
    source: list | None = None
    size: int | None = None
    start: int = 0

    @classmethod
    def of(cls, body: dict | str) -> Body:
        """From a full request or a bare clause, as a dict or as JSON text."""
        body = json.loads(body) if isinstance(body, str) else dict(body)
        aggs = body.pop("aggs", None) or body.pop("aggregations", None)
        sort = body.pop("sort", None)
        source = _source_patterns(body.pop("_source", None))
        size = body.pop("size", None)
        start = int(body.pop("from", 0))
        query = body.pop("query", None)
        if query is None and len(body) == 1 and next(iter(body)) in CLAUSES:
            query = body
        elif set(body) - set(WITHOUT_EFFECT):
            raise QueryError(f"unknown query type {sorted(set(body) - set(WITHOUT_EFFECT))}")
        if query is None and aggs is None:
            raise QueryError("body has neither a query nor aggregations")
        return cls(query, None if sort is None else _as_list(sort), aggs, source, size, start)


# Keys of a request that change no row.
WITHOUT_EFFECT = ("track_total_hits", "track_scores", "highlight", "timeout", "version", "explain", "profile", "seq_no_primary_term")


def _source_patterns(source) -> list | None:
    """`_source` as a list of names and patterns, left-out ones with a `!`."""
    if source is None or source is True:
        return None
    if isinstance(source, dict):
        unknown = set(source) - {"includes", "include", "excludes", "exclude"}
        if unknown:
            raise QueryError(f"unknown _source option {sorted(unknown)}")
        kept = _as_list(source.get("includes", source.get("include"))) or ["*"]
        return kept + [f"!{name}" for name in _as_list(source.get("excludes", source.get("exclude")))]
    if source is False:
        raise QueryError("_source false leaves no field to export")
    return _as_list(source)
