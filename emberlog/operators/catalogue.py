"""Profiling of many indices at once over a field catalogue.

A catalogue has one row per field of an index: `index`, `field`, `type`, `pos`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import quoted
from emberlog.operators.filters import ENTITIES, ENTITY_SUFFIXES, LOOKALIKE_WORDS
from emberlog.operators.reshape import BOOKKEEPING, JSON_SUFFIXES

# What an index name or its fields say about the kind of log.
KUBERNETES_NAMES = ("filebeat", "kubernetes", "k8s", "eks", "gke", "aks")
KUBERNETES_FIELDS = ("kubernetes.namespace", "kubernetes.pod.name", "kubernetes.container.name")
KUBERNETES_FIELDS_NEEDED = 2
JAEGER_NAMES = ("jaeger", "span", "trace", "otel", "apm")
JAEGER_FIELDS = ("traceid", "spanid", "servicename", "operationname", "starttime")
JAEGER_FIELDS_NEEDED = 3

# Time fields to look for per kind, best first, and what to assume without any.
TIME_FIELDS = {
    "kubernetes": ("@timestamp", "timestamp", "time", "date", "created_at"),
    "jaeger": ("startTimeMillis", "startTime", "@timestamp", "timestamp", "time", "date"),
    "generic": ("@timestamp", "timestamp", "time", "date", "created_at", "log_time", "event_time"),
}
DEFAULT_TIME_FIELD = {"kubernetes": "@timestamp", "jaeger": "startTimeMillis", "generic": "@timestamp"}

# Index type -> view type; anything else is a string.
VIEW_TYPE_OF = {
    "text": "string", "keyword": "string",
    "long": "int", "integer": "int", "short": "int", "byte": "int",
    "double": "float", "float": "float", "half_float": "float", "scaled_float": "float",
    "boolean": "boolean", "date": "string", "object": "struct", "nested": "array",
}

# Warning texts.
NO_DATE_FIELD = "No date field found in index '%s'. Time-based queries may not work correctly."
NO_TIME_FIELD = "No timestamp field detected. Using default '@timestamp'."
NO_FIELDS = "No fields found in index mapping. Index may be empty or misconfigured."

# Settings of an index that belong to the cluster it came from.
CLUSTER_SETTINGS = ("provided_name", "uid", "uuid", "version", "creation_date")

# Names and prefixes of trace fields.
TRACE_NAME_PARTS = (
    "traceID", "spanID", "parentSpanID", "operationName", "serviceName",
    "startTimeMillis", "startTime", "duration", "span.kind", "error",
)
TRACE_PREFIXES = ("tags.", "process.tags.", "logs[", "references[", "http.", "db.", "rpc.")

INDEX_TYPES = {
    T.StringType: "keyword", T.LongType: "long", T.IntegerType: "integer", T.ShortType: "short",
    T.ByteType: "byte", T.DoubleType: "double", T.FloatType: "float", T.DecimalType: "scaled_float",
    T.BooleanType: "boolean", T.TimestampType: "date", T.TimestampNTZType: "date", T.DateType: "date",
    T.StructType: "object", T.MapType: "object", T.VariantType: "object",
}


def _any(predicates) -> Column:
    result = F.lit(False)
    for predicate in predicates:
        result = result | predicate
    return result


# ------------------------------------------------------- building a catalogue


def schema_rows(schema: T.StructType, text_fields=(), prefix: str = "") -> list[tuple[str, str]]:
    """(field, index type) of a schema, structs before their members."""
    rows = []
    for member in schema.fields:
        name, dtype = prefix + member.name, member.dataType
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        nested = isinstance(dtype, T.ArrayType) and isinstance(inner, T.StructType)
        kind = "nested" if nested else INDEX_TYPES.get(type(inner), "keyword")
        rows.append((name, "text" if name in text_fields else kind))
        if isinstance(inner, T.StructType):
            rows.extend(schema_rows(inner, text_fields, f"{name}."))
    return rows


def mapping_of(schema: T.StructType, text_fields=(), prefix: str = "") -> dict:
    """The index mapping of a table, as it is stored in a sample bundle."""
    kinds = dict(schema_rows(schema, text_fields, prefix))
    properties = {}
    for member in schema.fields:
        name, dtype = prefix + member.name, member.dataType
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        properties[member.name] = {"type": kinds[name]}
        if isinstance(inner, T.StructType):
            properties[member.name].update(mapping_of(inner, text_fields, f"{name}."))
    return {"properties": properties}


def catalogue_of_tables(tables: dict[str, DataFrame], text_fields=()) -> DataFrame:
    """Catalogue rows of tables whose schema is known; no table is read."""
    rows = [
        (name, field, kind, pos)
        for name, df in tables.items()
        for pos, (field, kind) in enumerate(schema_rows(df.schema, text_fields))
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "index string, field string, type string, pos int")


_OBJECT = "map<string,variant>"


def _members(value: Column) -> Column:
    """Entries of a JSON object, or of the objects in an array; none for any other value."""
    entries = F.map_entries(F.try_variant_get(value, "$", _OBJECT))
    none = F.array().cast("array<struct<key:string,value:variant>>")
    inside = F.transform(
        F.try_variant_get(value, "$", "array<variant>"),
        lambda x: F.coalesce(F.map_entries(F.try_variant_get(x, "$", _OBJECT)), none),
    )
    return F.coalesce(entries, F.flatten(inside), none)


def json_fields(docs: DataFrame, doc: str, keys: tuple[Column, ...] = ()) -> DataFrame:
    """Names and values of the top-level fields of JSON documents (variants)."""
    rows = docs.select(*keys, F.explode(_members(quoted(doc))).alias("entry"))
    names = rows.columns[:-1]
    return rows.select(*map(quoted, names), F.col("entry.key").alias("field"), F.col("entry.value").alias("value"))


def value_kind(value: Column) -> Column:
    """What a JSON value is: STRING, BIGINT, DECIMAL, OBJECT, ..., and PROSE for long text."""
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z_]+", 0)
    return F.when(kind != "STRING", kind).when(_prose(F.try_variant_get(value, "$", "string")), "PROSE").otherwise(kind)


# JSON value kind -> index type; anything else is a keyword.
TYPE_OF_KIND = {
    "PROSE": "text", "STRING": "keyword", "BIGINT": "long", "DECIMAL": "double", "DOUBLE": "double",
    "FLOAT": "double", "BOOLEAN": "boolean", "OBJECT": "object", "NESTED": "nested", "TIMESTAMP": "date", "TIMESTAMP_NTZ": "date",
    "DATE": "date",
}


def _type_of_kind(kind: Column) -> Column:
    result = F
    for name, index_type in TYPE_OF_KIND.items():
        result = result.when(kind == name, F.lit(index_type))
    return result.otherwise("keyword")


def _prose(text: Column) -> Column:
    """Long strings and strings with a space are prose; lengths count bytes."""
    return (F.octet_length(text) > 50) | text.contains(" ")


# Mixed types of one field: the one furthest left holds every value of the others.
TYPE_ORDER = ("text", "keyword", "nested", "object", "date", "double", "long", "boolean")


def _widest(kind: Column) -> Column:
    rank = F.array_position(F.array(*[F.lit(t) for t in TYPE_ORDER]), kind)
    return F.min_by(kind, rank)


def name_rule(field: Column) -> Column:
    """Index type a field name alone decides; null where the values decide."""
    lowered = F.lower(field)
    return (
        F.when(lowered.contains("time"), "date")
        .when(_any(field.endswith(s) for s in JSON_SUFFIXES), "object")
        .when(lowered.contains("id") | lowered.contains("name"), "keyword")
    )


def _field_types(entries: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One type per `keys` and field from (keys, field, value) rows.

    Rows are first counted down to the kinds seen per field, on the map side, so the
    exchanges carry a few rows per field whatever the number of documents.
    """
    return _types_of_kinds(entries.select(*keys, "field", value_kind(F.col("value")).alias("kind")).distinct(), keys)


def _types_of_kinds(seen: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The type that holds every kind seen of a field."""
    typed = seen.withColumn("type", F.when(F.col("kind") != "VOID", _type_of_kind(F.col("kind"))))
    return typed.groupBy(*keys, "field").agg(F.coalesce(_widest(F.col("type")), F.lit("keyword")).alias("type"))


def _with_name_rules(typed: DataFrame, strict: bool) -> DataFrame:
    kind = F.col("type") if strict else F.coalesce(name_rule(F.col("field")), F.col("type"))
    millis = (kind == "date") & (F.col("field") == "startTimeMillis")
    return typed.withColumns({"type": kind, "format": F.when(millis, "epoch_millis")})


def infer_mapping(docs: DataFrame, doc: str = "doc", keys: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Index types of the top-level fields of JSON documents (variants), over all rows.

    One row per field and per `keys`; `strict` ignores the rules on field names.
    """
    entries = json_fields(docs, doc, tuple(map(quoted, keys)))
    kept = entries.where(~F.col("field").isin(*BOOKKEEPING))
    return _with_name_rules(_field_types(kept, keys), strict)


def infer_table_mapping(df: DataFrame, strict: bool = False) -> DataFrame:
    """Index types of a table with a schema: only strings need their values read, in one pass."""
    names = [f.name for f in df.schema.fields if f.name not in BOOKKEEPING]
    types = {f.name: f.dataType for f in df.schema.fields}
    strings = [n for n in names if isinstance(types[n], T.StringType)]
    flags = [F.coalesce(F.bool_or(_prose(quoted(n))), F.lit(False)).alias(n) for n in strings]
    prose = df.agg(*(flags or [F.count(F.lit(1)).alias("rows")]))
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("field"),
            (F.when(quoted(n), "text").otherwise("keyword") if n in strings else F.lit(_index_type(types[n]))).alias("type"),
        )
        for n in names
    ])
    return _with_name_rules(prose.select(F.inline(rows)), strict)


def _index_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "long"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return "double"
    return "keyword" if isinstance(dtype, T.ArrayType) else INDEX_TYPES.get(type(dtype), "keyword")


# Bytes that UTF-8 never has, as characters: an escaped quote, an escaped backslash, the kind that follows a key.
_QUOTE, _BACKSLASH, _KIND = "\u00c1", "\u00f5", "\u00c0"
# A key and its colon; no closing quote opens one, as what follows it is one of the characters left out.
_KEY = rf'"(?![\s,:}}\]])([^"{_KIND}]*+)"\s*:\s*'
_SHORT = r'"(?:[^" \\]|\\u[0-9a-fA-F]{4}|\\[^u]){0,50}+"'
# Strings and arrays get their kind after the key: beside other values of the field they would hide its members or its type.
_MARKS = (
    (_KEY + _SHORT, f'"$1{_KIND}s":""'),
    (_KEY + '"[^"]++"', f'"$1{_KIND}p":""'),
    (_KEY + r"(?=\[)", f'"$1{_KIND}a":'),
)


def _document_shapes(docs: DataFrame, doc: str, index: Column) -> DataFrame:
    """(index, shape, dated): the distinct shapes of the documents, counted down on the map side.

    A shape is the schema of a document whose keys carry the kind of their value, so that unlike values
    of one field in an array don't merge, and prose differs from other strings; it is written in
    UTF-8 bytes, a character each, as lengths count bytes. `dated` is the schema of a document with dates and
    times, which its JSON text doesn't show.
    """
    value, dated = quoted(doc), F.lit(None).cast("string")
    if isinstance(docs.schema[doc].dataType, T.VariantType):
        text = F.to_json(value)
        schema = F.schema_of_variant(value)
        dated = F.when(schema.rlike(r"\b(TIMESTAMP|TIMESTAMP_NTZ|DATE)\b"), schema)
    else:
        text = F.when(value.contains("\\u"), F.to_json(F.try_parse_json(value))).otherwise(value)
    marked = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    marked = F.replace(F.replace(marked, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    for pattern, marks in _MARKS:
        marked = F.regexp_replace(marked, pattern, marks)
    marked = F.replace(F.replace(marked, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    shapes = docs.select(index.alias("index"), F.schema_of_variant(F.try_parse_json(marked)).alias("shape"), dated.alias("dated"))
    return shapes.distinct()


_NAME = "`((?:[^`]|``)*)`"
_SHAPE_TOKEN = rf"(?:{_NAME}: |\w+: )?(?:ARRAY<)*(?:OBJECT<|[A-Z_]+(?:\([0-9, ]*\))?)|>"


def _shape_fields(shape: Column) -> Column:
    """The fields a schema text of a variant names, as an array of (field, kind) with dotted names.

    A fold over its tokens keeps the name of every bracket that is open.
    """
    state = "struct<open:array<string>,fields:array<struct<field:string,kind:string>>>"
    tokens = F.regexp_extract_all(shape, F.lit(f"({_SHAPE_TOKEN})"), F.lit(1))

    def step(s: Column, token: Column) -> Column:
        opened, fields = s["open"], s["fields"]
        quoted_name = F.regexp_extract(token, f"^{_NAME}: ", 1)
        plain = F.regexp_extract(token, r"^(\w+): ", 1)
        name = F.when(plain != "", plain).otherwise(F.replace(quoted_name, F.lit("``"), F.lit("`")))
        named = token.startswith("`") | (plain != "")
        kind_at = F.instr(name, _KIND)
        label = F.when(kind_at > 0, F.substring(name, F.lit(1), kind_at - 1)).otherwise(name)
        above = F.coalesce(F.try_element_at(opened, F.lit(-1)), F.lit(""))
        path = F.when(~named, above).when(above == "", label).otherwise(F.concat(above, F.lit("."), label))
        type_text = F.regexp_extract(token, r"((?:ARRAY<)*(?:OBJECT<|[A-Z_]+)(?:\([0-9, ]*\))?)$", 1)
        kind = (
            F.when(name.endswith(_KIND + "p"), "PROSE").when(type_text.startswith("ARRAY<OBJECT<"), "NESTED")
            .when(type_text.rlike("^(ARRAY<)+VOID$"), "VOID")  # an empty array tells nothing
            .when(type_text.startswith("ARRAY<"), "ARRAY").otherwise(F.regexp_extract(type_text, "^[A-Z_]+", 0))
        )
        depth = F.length(type_text) - F.length(F.replace(type_text, F.lit("<"), F.lit("")))
        pushed = F.concat(opened, F.array_repeat(path, depth))
        told = F.when(named, F.concat(fields, F.array(F.struct(path.alias("field"), kind.alias("kind"))))).otherwise(fields)
        closed = token == ">"
        return F.struct(
            F.when(closed, F.slice(opened, F.lit(1), F.greatest(F.size(opened) - 1, F.lit(0)))).otherwise(pushed).alias("open"),
            F.when(closed, fields).otherwise(told).alias("fields"),
        ).cast(state)

    start = F.struct(F.array().cast("array<string>").alias("open"), F.array().cast("array<struct<field:string,kind:string>>").alias("fields"))
    return F.aggregate(tokens, start.cast(state), step, lambda s: s["fields"])


def catalogue_of_documents(docs: DataFrame, doc: str = "doc", index: str = "_index") -> DataFrame:
    """Catalogue of schemaless documents, JSON texts or variants: every dotted name found in any, members of arrays of objects too.

    One pass: documents become shapes, of which a few are left after counting on the map side, and the
    shapes are read as tables of fields. No schema reaches the driver. Texts that aren't JSON are
    left out. Arrays that mix objects and other values, which no index takes, count as keywords without members;
    so does prose under a name that starts with white space or one of `,:}]`.
    """
    shapes = _document_shapes(docs, doc, quoted(index))
    dates = F.filter(_shape_fields(F.coalesce("dated", F.lit(""))), lambda f: f["kind"].isin("TIMESTAMP", "TIMESTAMP_NTZ", "DATE"))
    fields = F.transform(
        _shape_fields(F.coalesce("shape", F.lit(""))),
        lambda f: F.struct(F.decode(F.encode(f["field"], "ISO-8859-1"), "UTF-8").alias("field"), f["kind"].alias("kind")),
    )
    named = shapes.select("index", fields.alias("fields"), dates.alias("dates"))
    known = F.filter("fields", lambda f: ~F.exists("dates", lambda d: d["field"] == f["field"]))
    found = named.select("index", F.inline(F.concat(known, "dates"))).distinct()
    pos = F.row_number().over(Window.partitionBy("index").orderBy("field")) - 1
    return _types_of_kinds(found, ("index",)).select("index", "field", "type", pos.alias("pos"))


# ------------------------------------------------------------- index profiles


def kind_of(names, index: str = "") -> str:
    """The kind of one index, from its name and field names."""
    lowered = {name.lower() for name in names}
    index = index.lower()
    if any(n in index for n in KUBERNETES_NAMES) or len(lowered & {*KUBERNETES_FIELDS}) >= KUBERNETES_FIELDS_NEEDED:
        return "kubernetes"
    if any(n in index for n in JAEGER_NAMES) or len(lowered & {*JAEGER_FIELDS}) >= JAEGER_FIELDS_NEEDED:
        return "jaeger"
    return "generic"


def _held(names: tuple[str, ...]) -> Column:
    """How many of `names` an index has among its fields, whatever the case."""
    lowered = F.lower("field")
    counted = F.lit(0)
    for name in names:
        counted = counted + F.coalesce(F.bool_or(lowered == name), F.lit(False)).cast("int")
    return counted


def _kind_of_index() -> Column:
    index = F.lower("index")
    return (
        F.when(_any(index.contains(n) for n in KUBERNETES_NAMES), "kubernetes")
        .when(F.col("k8s_fields") >= KUBERNETES_FIELDS_NEEDED, "kubernetes")
        .when(_any(index.contains(n) for n in JAEGER_NAMES), "jaeger")
        .when(F.col("trace_fields") >= JAEGER_FIELDS_NEEDED, "jaeger")
        .otherwise("generic")
    )


def _time_rank(kind: str) -> Column:
    """Rank of a catalogue row as a time field: listed names, then any date by position."""
    names = F.array(*[F.lit(n) for n in TIME_FIELDS[kind]])
    listed = F.array_position(names, F.col("field"))
    usable = F.col("type").isNull() | (F.col("type") == "date")
    return F.when((listed > 0) & usable, listed).when(F.col("type") == "date", F.lit(1000) + F.col("pos"))


def inspect_indices(catalogue: DataFrame) -> DataFrame:
    """Kind, time field, whether the index really has it, and number of fields, per index.

    Everything comes out of one grouping; the best time field is kept for every kind
    and the kind picks among them afterwards.
    """
    seen = catalogue.groupBy("index").agg(
        _held(KUBERNETES_FIELDS).alias("k8s_fields"),
        _held(JAEGER_FIELDS).alias("trace_fields"),
        F.count_distinct("field").alias("field_count"),
        *[F.min_by("field", _time_rank(kind)).alias(f"best_{kind}") for kind in TIME_FIELDS],
    ).withColumn("kind", _kind_of_index())
    found, default = F, F
    for kind in TIME_FIELDS:
        found = found.when(F.col("kind") == kind, F.col(f"best_{kind}"))
        default = default.when(F.col("kind") == kind, F.lit(DEFAULT_TIME_FIELD[kind]))
    return seen.select(
        "index", "kind", F.coalesce(found, default).alias("time_field"), found.isNotNull().alias("has_date"), "field_count"
    )


def detect_kind(catalogue: DataFrame) -> DataFrame:
    """kubernetes, jaeger or generic, per index."""
    return inspect_indices(catalogue).select("index", "kind")


def time_column(catalogue: DataFrame) -> DataFrame:
    """The time field per index, and whether the index really has it."""
    return inspect_indices(catalogue).select("index", "kind", "time_field", "has_date")


def index_health(catalogue: DataFrame, indices: DataFrame | None = None) -> DataFrame:
    """Warnings per index, in a fixed order; an index without warnings has an empty list.

    `indices`, a table with a column `index`, names indices that may have no field at all.
    """
    seen = inspect_indices(catalogue)
    if indices is not None:
        seen = indices.select("index").distinct().join(seen, "index", "left")
    named = F.format_string(NO_DATE_FIELD, F.col("index"))
    dated = F.coalesce("has_date", F.lit(False))
    checks = [
        (~dated, named),
        (~dated, F.lit(NO_TIME_FIELD)),
        (F.coalesce("field_count", F.lit(0)) == 0, F.lit(NO_FIELDS)),
    ]
    warnings = F.array_compact(F.array(*[F.when(broken, text) for broken, text in checks]))
    return seen.select("index", warnings.alias("warnings"))


# --------------------------------------------------------------- field rules


def map_types(catalogue: DataFrame) -> DataFrame:
    view_type = F
    for index_type, name in VIEW_TYPE_OF.items():
        view_type = view_type.when(F.col("type") == index_type, F.lit(name))
    return catalogue.withColumn("view_type", view_type.otherwise("string"))


def _entity_rank(entity: Column) -> Column:
    """Which pattern a field matches an entity by, from 0; null for none."""
    name = F.translate(F.lower("field"), "_@-", "...")
    rank = F
    for i, pattern in enumerate(ENTITY_SUFFIXES):
        before, after = pattern.split("{0}")
        rank = rank.when(name.endswith(F.concat(F.lit(before), entity, F.lit(after))), F.lit(i))
    return rank.when(name.startswith(entity), F.lit(len(ENTITY_SUFFIXES)))


def entity_mapping(catalogue: DataFrame, entities=ENTITIES) -> DataFrame:
    """Candidate fields per index and entity, best pattern first, then position."""
    rows = catalogue.withColumn("entity", F.explode(F.array(*[F.lit(e) for e in entities])))
    ranked = rows.withColumn("rank", _entity_rank(F.col("entity"))).where(F.col("rank").isNotNull())
    per_field = ranked.groupBy("index", "entity", "field").agg(
        F.min("rank").alias("rank"), F.min("pos").alias("pos")
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", "pos", "field")))
    return per_field.groupBy("index", "entity").agg(ordered["field"].alias("fields"))


def entity_candidates(catalogue: DataFrame, entity: str) -> DataFrame:
    return entity_mapping(catalogue, (entity,))


def similar_fields(catalogue: DataFrame, entities=ENTITIES) -> DataFrame:
    """Up to five look-alike fields for entities an index has no field for."""
    wanted = catalogue.select("index").distinct().withColumn(
        "entity", F.explode(F.array(*[F.lit(e) for e in entities]))
    )
    missing = wanted.join(entity_mapping(catalogue, entities), ["index", "entity"], "left_anti")
    lowered = F.lower("field")
    labels = F.array_compact(F.array(*[
        F.when(_any(lowered.contains(w) for w in LOOKALIKE_WORDS[e]), F.lit(e)) for e in entities
    ]))
    alike = catalogue.select("index", "field", F.explode(labels).alias("entity")).distinct()
    first_five = F.row_number().over(Window.partitionBy("index", "entity").orderBy("field")) <= 5
    kept = alike.withColumn("kept", first_five).where("kept")
    suggestions = kept.groupBy("index", "entity").agg(F.array_sort(F.collect_list("field")).alias("similar"))
    return missing.join(suggestions, ["index", "entity"], "left").select(
        "index", "entity", F.coalesce("similar", F.array().cast("array<string>")).alias("similar")
    )


def title_case(text: Column) -> Column:
    """Every run of letters, digits and underscores with a capital first; the rest of it as it is."""
    runs = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substring(run, F.lit(2), F.length(run)))), "")


def field_label(field: Column) -> Column:
    """Last part of the name, underscores as spaces, in title case."""
    return title_case(F.replace(F.element_at(F.split(field, r"\."), -1), F.lit("_"), F.lit(" ")))


def is_trace_field(field: Column) -> Column:
    return _any(field.contains(p) for p in TRACE_NAME_PARTS) | _any(field.startswith(p) for p in TRACE_PREFIXES)


def field_role(field: Column) -> Column:
    return (
        F.when(field.startswith("kubernetes."), "kubernetes").when(is_trace_field(field), "trace").otherwise("plain")
    )


def clean_settings(settings: Column) -> Column:
    """Index settings (a map) without what belongs to the cluster they came from."""
    return F.map_filter(settings, lambda key, _: ~key.isin(*CLUSTER_SETTINGS))


def clean_properties(properties: Column) -> Column:
    return F.map_filter(properties, lambda key, _: ~key.isin(*BOOKKEEPING))
