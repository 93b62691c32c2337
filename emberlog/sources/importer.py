"""Reading sample bundles and plain document files back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.catalogue import clean_properties, clean_settings, infer_mapping
from emberlog.operators.reshape import BOOKKEEPING
from emberlog.sources.indices import index_matches, is_visible

_INDEX = (
    "struct<name:string,settings:map<string,variant>,mappings:map<string,variant>,"
    "documents:array<variant>,count:bigint>"
)
BUNDLE = f"struct<metadata:variant,indices:map<string,{_INDEX}>,data:array<variant>>"


def read_bundle(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Bundles as rows, one per file, or one per line where each line is a bundle."""
    text = spark.read.text(path, wholetext=whole_file)
    bundle = F.from_json("value", BUNDLE)
    return text.select(bundle.alias("bundle")).where(F.size("bundle.indices") > 0).select("bundle.*")


def bundle_indices(bundles: DataFrame) -> DataFrame:
    """One row per index of a bundle, settings and mappings cleaned."""
    entries = bundles.select(F.explode("indices").alias("_index", "definition"))
    settings, mappings = F.col("definition.settings"), F.col("definition.mappings")
    return entries.select(
        "_index",
        _rewrite(settings, "index", clean_settings).alias("settings"),
        _rewrite(mappings, "properties", clean_properties).alias("mappings"),
        F.col("definition.count").alias("count"),
    )


def _rewrite(outer: Column, key: str, clean) -> Column:
    """A map with the object under `key` cleaned and everything else as it was."""

    def entry(name: Column, value: Column) -> Column:
        inner = F.try_variant_get(value, "$", "map<string,variant>")
        cleaned = F.to_variant_object(clean(inner))
        return F.when((name == key) & inner.isNotNull(), cleaned).otherwise(value)

    return F.transform_values(outer, entry)


def bundle_documents(bundles: DataFrame) -> DataFrame:
    """Documents of all indices: `_index` and the document as a variant."""
    entries = bundles.select(F.explode("indices").alias("_index", "definition"))
    return entries.select("_index", F.explode("definition.documents").alias("doc"))


def bundle_data(bundles: DataFrame) -> DataFrame:
    """Top-level data of a bundle, once for every index of the same bundle."""
    return bundles.select(F.map_keys("indices").alias("names"), F.explode("data").alias("doc")).select(
        F.explode("names").alias("_index"), "doc"
    )


def read_documents(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """A JSON Lines file, or with `array` files that hold one JSON array each."""
    return spark.read.option("multiLine", array).json(path)


def clean_document(doc: Column) -> Column:
    """A document (variant) without bookkeeping attributes, its JSON texts parsed."""
    members = F.map_filter(F.try_variant_get(doc, "$", "map<string,variant>"), lambda k, _: ~k.isin(*BOOKKEEPING))

    def parsed(key: Column, value: Column) -> Column:
        text = F.when(key.endswith("@json") | key.endswith("@input"), F.try_variant_get(value, "$", "string"))
        is_text = F.schema_of_variant(value) == "STRING"
        return F.coalesce(F.try_parse_json(F.when(is_text, text)), value)

    return F.to_variant_object(F.transform_values(members, parsed))


def index_name_from_file(path: Column, day: str | Column) -> Column:
    """Index name for a file: its base name in lower case, `_` as `-`, and the day."""
    base = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(base, r"\.[^.]*$", "")
    day = F.lit(day) if isinstance(day, str) else day
    return F.concat_ws("-", F.replace(F.lower(stem), F.lit("_"), F.lit("-")), day)


def with_file_index(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("_index", index_name_from_file(F.input_file_name(), day))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """What the files of a path hold: `file` and one JSON value (`doc`) per entry, arrays as their members.

    Each file is judged by itself: if every line is JSON it is read line by line, else as one
    document, which one task reads.  A file that is neither raises an error.
    """
    source = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file")

    def values(paths, whole: bool) -> DataFrame:
        text = spark.read.text(paths, wholetext=whole, recursiveFileLookup=True).select(source, "value")
        return text.where(F.trim(F.translate("value", "\r\n\t", "   ")) != "").withColumn("doc", F.try_parse_json("value"))

    # One row per file, as in the listing that the driver holds anyway.
    judged = values(path, False).groupBy("file").agg(F.count_if(F.col("doc").isNull()).alias("broken")).collect()
    by_line = [row.file for row in judged if not row.broken]
    by_file = [row.file for row in judged if row.broken]
    if not judged:
        raise ValueError(f"nothing to import in {path}")
    unread = [r.file for r in values(by_file, True).where("doc is null").select("file").collect()] if by_file else []
    if unread:
        raise ValueError(f"not JSON: {', '.join(sorted(unread))}")
    parts = [values(paths, whole) for paths, whole in ((by_line, False), (by_file, True)) if paths]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    members = F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))
    return both.select("file", F.explode(members).alias("doc"))


_SAMPLE_INDEX = r"/_index=([^/]+)/"


def _split_entries(entries: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """Documents (`_index`, `doc`), and what is said of indices (`_index`, `definition`)."""
    indices = F.try_variant_get("doc", "$.indices", "map<string,variant>")
    told = entries.select("file", "doc", indices.alias("indices"))
    named = F.regexp_extract("file", _SAMPLE_INDEX, 1)
    described = F.col("file").rlike("/metadata/part-[^/]*$")
    plain = told.where(F.col("indices").isNull() & ~described).select(
        F.when(named != "", F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B")))).otherwise(index_name_from_file(F.col("file"), day)).alias("_index"), "doc"
    )
    bundles = told.where(F.col("indices").isNotNull())
    definitions = bundles.select(F.explode("indices").alias("_index", "definition"))
    own = definitions.select("_index", F.explode(F.try_variant_get("definition", "$.documents", "array<variant>")).alias("doc"))
    shared = bundles.select(F.map_keys("indices").alias("names"), F.explode(F.try_variant_get("doc", "$.data", "array<variant>")).alias("doc")).select(F.explode("names").alias("_index"), "doc")
    sampled = told.where(described).select(F.try_variant_get("doc", "$.name", "string").alias("_index"), F.col("doc").alias("definition"))
    return plain.unionByName(own).unionByName(shared), definitions.unionByName(sampled)


def documents_of(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Cleaned documents of a file or folder and the index each belongs to: `_index`, `doc`.

    Bundles bring their indices, and their top-level data goes to all of them; samples keep an
    index per folder; any other file holds plain documents for the index named after the file.
    """
    found, _ = _split_entries(read_entries(spark, path), day)
    return found.select("_index", clean_document(F.col("doc")).alias("doc"))


def mappings_of(definitions: DataFrame) -> DataFrame:
    """`_index`, `field`, `type`, `format` of the mappings that come with indices, bookkeeping left out."""
    properties = F.try_variant_get("definition", "$.mappings.properties", "map<string,variant>")
    fields = definitions.select("_index", F.explode(clean_properties(properties)).alias("field", "its"))
    return fields.select(
        "_index", "field", F.coalesce(F.try_variant_get("its", "$.type", "string"), F.lit("object")).alias("type"),
        F.try_variant_get("its", "$.format", "string").alias("format"),
    ).distinct()


def import_file(spark: SparkSession, path: str, root: str, day: str, force: bool = False) -> DataFrame:
    """Loads a file or folder into its indices under `root`; returns the mapping per index.

    Documents are kept as JSON Lines, one partition per index, next to the mappings that came with
    them, which `scan_imported` applies; fields without one get an inferred type.  `force`
    replaces the indices of the file, their mappings too, and leaves all others alone; without it an index
    that is there keeps the types of its fields and only learns new fields.
    """
    found, definitions = _split_entries(read_entries(spark, path), day)
    cleaned = found.select("_index", clean_document(F.col("doc")).alias("doc"))
    # Parsed and cleaned once, for the documents and for their types.
    hidden = f"{root.rstrip('/')}/.cleaned-{uuid.uuid4().hex}"
    cleaned.write.parquet(f"{hidden}/documents")
    try:
        documents = spark.read.schema(cleaned.schema).parquet(f"{hidden}/documents")
        return _import_cleaned(spark, documents, mappings_of(definitions), root, force, f"{hidden}/mapping")
    finally:
        gone = spark._jvm.org.apache.hadoop.fs.Path(hidden)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def _import_cleaned(spark: SparkSession, documents: DataFrame, given: DataFrame, root: str, force: bool, hidden: str) -> DataFrame:
    """Writes cleaned documents (`_index`, `doc`) and the mapping of their indices; what it returns reads neither them nor `hidden`."""
    lines = documents.select("_index", F.to_json("doc").alias("value")).hint("rebalance", "_index")
    writer = lines.write.mode("overwrite" if force else "append").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_index").text(root)
    inferred = infer_mapping(documents, keys=("_index",)).select("_index", "field", "type", "format")
    mapping = given.unionByName(inferred.join(given.select("_index", "field").distinct(), ["_index", "field"], "left_anti"))
    known = None if force else _kept_mappings(spark, root)
    if known is not None:
        mapping = mapping.join(known.select("_index", "field").distinct(), ["_index", "field"], "left_anti")
    mapping.write.parquet(hidden)
    mapping = spark.read.schema(mapping.schema).parquet(hidden)
    # An entry per index: the ones of this import replace those before, all others stay.
    writer = mapping.repartition("_index").write.mode("overwrite" if force else "append").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_index").json(f"{root.rstrip('/')}/{MAPPINGS}")
    wanted = mapping.select("_index").distinct() if known is None else documents.select("_index").union(given.select("_index")).distinct()
    names = [[row[0]] for row in wanted.collect()]  # a name per index
    wanted = spark.createDataFrame(names, "_index string")
    return _kept_mappings(spark, root).join(wanted, "_index", "left_semi")


def _kept_mappings(spark: SparkSession, root: str) -> DataFrame | None:
    """`_index`, `field`, `type`, `format` of all imported indices; None before the first import."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{MAPPINGS}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    kept = spark.read.schema("field string, type string, format string, _index string").json(f"{root.rstrip('/')}/{MAPPINGS}")
    return kept.select("_index", "field", "type", "format")


# Starts with a dot: file listings of the indices leave it out.
MAPPINGS = ".mappings"

_COLUMN_TYPES = {
    "long": "bigint", "integer": "bigint", "short": "bigint", "byte": "bigint", "double": "double", "float": "double",
    "half_float": "double", "scaled_float": "double", "boolean": "boolean", "object": "variant", "nested": "variant",
}


def scan_imported(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Imported indices as one table: `_index` and a column per mapped field, typed by the mappings.

    A field that has two types in two indices takes the one that holds both, text at last.
    """
    mapping = _kept_mappings(spark, root)
    if mapping is None:
        raise ValueError(f"nothing was imported into {root}")
    wanted = mapping.where(index_matches(F.col("_index"), pattern) & is_visible(F.col("_index")))
    kinds: dict[str, set[str]] = {}
    for row in wanted.select("field", "type").distinct().collect():  # as many rows as a schema has
        kinds.setdefault(row.field, set()).add(_COLUMN_TYPES.get(row.type, "string"))
    if not kinds:
        raise ValueError(f"no imported index matches {pattern!r}")
    widest = {name: next(iter(k)) if len(k) == 1 else "double" if k == {"bigint", "double"} else "string" for name, k in kinds.items()}
    schema = ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in sorted(widest.items()))
    lines = spark.read.option("basePath", root).text(f"{root.rstrip('/')}/_index=*")
    chosen = lines.where(index_matches(F.col("_index").cast("string"), pattern) & is_visible(F.col("_index").cast("string")))
    return chosen.select(F.col("_index").cast("string"), F.from_json("value", schema).alias("doc")).select("_index", "doc.*")
