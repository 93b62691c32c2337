"""Indices as tables: patterns over names, dates in names, date pruning.

At scale keep one table partitioned by `_index` or `index_date`; the predicates here
then become partition filters.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import quoted
from emberlog.functions.timeexpr import resolve_range
from emberlog.operators import predicates as P

# Date layouts in index names, tried in this order; a month is its first day.
DATE_LAYOUTS = (
    (r"\d{4}\.\d{2}\.\d{2}", "yyyy.MM.dd"),
    (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"),
    (r"\d{4}\.\d{2}", "yyyy.MM"),
    (r"\d{4}-\d{2}", "yyyy-MM"),
    (r"\d{8}", "yyyyMMdd"),
)


def scan_index(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).load(path)


def resolve_indices(names, pattern: str) -> list[str]:
    """Index names a pattern stands for, sorted; without `*` the pattern is a name."""
    if "*" not in pattern:
        return [pattern]
    visible = (n for n in names if not n.startswith("."))
    escaped = pattern.replace("[", "[[]").replace("?", "[?]")
    return sorted(n for n in visible if fnmatch.fnmatchcase(n, escaped))


def scan_pattern(tables: Mapping[str, DataFrame], pattern: str) -> DataFrame:
    """The union of all tables a pattern names; columns a table lacks are null."""
    chosen = [n for n in resolve_indices(tables, pattern) if n in tables]
    if not chosen:
        raise KeyError(f"no index matches {pattern!r}")
    frames = [tables[n].withColumn("_index", F.lit(n)) for n in chosen]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Threads that ask for schemas at a time; each asks by a job of one task.
SCHEMA_READERS = 16


def scan_folders(spark: SparkSession, root: str, pattern: str, file_format: str = "parquet", merge_files: bool = False) -> DataFrame:
    """Indices kept as folders under `root`, all that a pattern names, as one table.

    One footer of each folder is read, by tasks, and with `merge_files` every footer. Folders with the same schema share a
    scan. A field that has two types in two indices takes the one that holds both: whole numbers a
    long, numbers a double, times a timestamp, structs the fields of both, and anything else text. Names that
    differ in case only are one field.
    """
    folders = _folders(spark, root, pattern)
    if not folders:
        raise ValueError(f"no index matches {pattern!r} in {root}")
    reader = spark.read.format(file_format).option("mergeSchema", merge_files)
    with ThreadPoolExecutor(SCHEMA_READERS) as pool:
        schemas = list(pool.map(lambda path: reader.load(path).schema, folders))
    classes: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in zip(folders, schemas):
        classes.setdefault(schema.json(), (schema, []))[1].append(path)
    whole = reduce(wider, [schema for schema, _ in classes.values()])
    frames = [_folder_rows(spark.read.format(file_format).schema(schema).load(paths), root, whole) for schema, paths in classes.values()]
    return reduce(DataFrame.unionByName, frames)


def _folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths of the folders a pattern names, in order; system indices only by their own name."""
    escaped = re.sub(r"([\[\]{}?\\])", r"\\\1", pattern)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{escaped}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    names = {status.getPath().getName(): status.getPath().toString() for status in found if status.isDirectory()}
    # A glob reads the path anew, so its own characters in a folder's name are escaped again.
    return [re.sub(r"([\[\]{}?*\\])", r"\\\1", names[n]) for n in sorted(names) if "*" not in pattern or not n.startswith(".")]


def _folder_rows(df: DataFrame, root: str, schema: T.StructType) -> DataFrame:
    # Paths are compared without scheme and host, which only one side may have.
    host = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    depth = len([part for part in re.sub(host, "", root).split("/") if part])
    path = F.regexp_replace(F.col("_metadata.file_path"), host, "")
    folder = F.element_at(F.filter(F.split(path, "/"), lambda part: part != ""), depth + 1)
    own = {f.name.lower(): f for f in df.schema.fields}
    columns = [
        as_type(quoted(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType).alias(f.name)
        if f.name.lower() in own else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    return df.select(*columns, F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))).alias("_index"))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name.lower(): f for f in a.fields}
        for f in b.fields:
            known = fields.get(f.name.lower())
            fields[f.name.lower()] = T.StructField(f.name if known is None else known.name, f.dataType if known is None else wider(known.dataType, f.dataType))
        return T.StructType(list(fields.values()))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if isinstance(a, times) and isinstance(b, times):
        ntz = not isinstance(a, T.TimestampType) and not isinstance(b, T.TimestampType)
        return T.TimestampNTZType() if ntz else T.TimestampType()
    return T.StringType()


def as_type(column: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """A column as a type that `wider` gave."""
    if own == wanted:
        return column
    if isinstance(own, T.StructType) and isinstance(wanted, T.StructType):
        members = {f.name.lower(): f for f in own.fields}
        parts = [
            as_type(column.getField(members[f.name.lower()].name), members[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in members else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: as_type(x, own.elementType, wanted.elementType))
    if isinstance(wanted, T.StringType) and isinstance(own, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(column)
    return column.cast(wanted)


def index_matches(index: Column, pattern: str) -> Column:
    """`_index` against a pattern; a trailing `*` is a prefix test the scan can prune by."""
    if "*" not in pattern:
        return index == pattern
    return index.like(P.like_pattern(pattern.replace("\\", "\\\\").replace("?", "\\?")))


def is_visible(index: Column) -> Column:
    """System indices start with a dot."""
    return ~index.startswith(".")


def _dated(index: Column, value_of) -> Column:
    candidates = []
    for regex, layout in DATE_LAYOUTS:
        found = F.regexp_extract(index, f"({regex})", 1)
        candidates.append(value_of(F.when(found != "", found), layout))
    return F.coalesce(*candidates)


def index_date(index: Column) -> Column:
    """The date in an index name; null without one."""
    return _dated(index, lambda text, layout: F.try_to_timestamp(text, F.lit(layout)).cast("date"))


def index_end(index: Column) -> Column:
    """The first day no longer covered by an index name: the next day or month."""

    def following(text: Column, layout: str) -> Column:
        start = F.try_to_timestamp(text, F.lit(layout)).cast("date")
        return F.date_add(start, 1) if "dd" in layout else F.add_months(start, 1)

    return _dated(index, following)


def dated_in_range(date: Column, frm=None, to=None, now=None) -> Column:
    """An index date, as midnight, within the range; undated indices are kept."""
    lo, hi = resolve_range(frm, to, now)
    at = date.cast("timestamp_ntz")
    inside = P.all_of(
        test
        for test in (
            None if lo is None else at >= F.lit(lo.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"),
            None if hi is None else at <= F.lit(hi.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"),
        )
        if test is not None
    )
    return date.isNull() | inside


def prune_by_date(df: DataFrame, frm=None, to=None, now=None, column: str = "index_date", months: bool = False) -> DataFrame:
    """Partitions that can hold rows of the range.

    `column` is the table's date partition: whole days are compared, so a range that
    starts at noon keeps that day.  With `months`, partitions hold whole months.
    """
    lo, hi = resolve_range(frm, to, now)
    date = quoted(column)
    tests = []
    if lo is not None:
        tests.append(date >= F.lit(lo.date().replace(day=1) if months else lo.date()))
    if hi is not None:
        tests.append(date <= F.lit(hi.date()))
    return df.where(date.isNull() | P.all_of(tests)) if tests else df
