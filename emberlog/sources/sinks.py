"""Writing results, samples and imported documents."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import Fields, quoted
from emberlog.operators.catalogue import mapping_of
from emberlog.operators.ordering import DEFAULT_SAMPLE, newest_per_index, sample_with_total
from emberlog.operators.reshape import flatten

# Documents in one line of a bundle; larger samples take several lines per index.
LINE_DOCUMENTS = 1_000

# Text files keep microseconds; pass the same options when reading them back.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines, one file per task."""
    df.write.mode(mode).options(**TEXT_TIMES).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header and rows; struct members become columns, arrays and maps JSON text."""
    flat = flatten(df)
    nested = (T.ArrayType, T.MapType, T.VariantType)
    columns = [
        F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, nested) else quoted(f.name)
        for f in flat.schema.fields
    ]
    writer = flat.select(*columns).write.mode(mode).options(**TEXT_TIMES)
    writer.option("header", True).option("escape", '"').csv(path)


def write_index(df: DataFrame, path: str, force: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Appends documents to an index; `force` replaces what is there.

    Partitioned writes are rebalanced first: files per partition follow its size, and a
    partition that holds most rows is split over many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[quoted(name) for name in partition_by])
    writer = df.write.mode("overwrite" if force else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_related(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """A parent or child table bucketed by the key it is related by.

    With both sides in the same number of buckets, `has_child` and `has_parent` join
    bucket by bucket and nothing is shuffled.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_sample(
    df: DataFrame, path: str, time_field: str, limit: int = DEFAULT_SAMPLE, tie_break=(), index: str = "_index",
    metadata: Mapping[str, str] | None = None, text_fields: Sequence[str] = (),
) -> None:
    """A sample of any size: documents per index as JSON Lines, and one metadata row per index.

    The metadata holds the mapping and settings of the index, so that an import restores its types.
    """
    key = Fields.of(df).find(index).column
    sample = newest_per_index(df, time_field, limit, tie_break, index)
    sample.write.options(**TEXT_TIMES).partitionBy(index).json(f"{path}/documents")
    totals = df.groupBy(key.alias("name")).agg(F.count(F.lit(1)).alias("count"))
    described = {"sample_size": F.lit(limit), "exported_at": F.current_timestamp()}
    described.update({name: F.lit(value) for name, value in (metadata or {}).items()})
    kept = T.StructType([f for f in df.schema.fields if f.name != index])
    described["mappings"] = F.parse_json(F.lit(json.dumps(mapping_of(kept, text_fields))))
    described["settings"] = F.struct(F.struct().alias("index"))
    line = F.struct("name", "count", *[column.alias(name) for name, column in described.items()])
    totals.select(F.to_json(line, dict(TEXT_TIMES)).alias("value")).write.text(f"{path}/metadata")


def write_bundle(
    df: DataFrame, path: str, time_field: str, limit: int = DEFAULT_SAMPLE, tie_break=(), index: str = "_index",
    metadata: Mapping[str, str] | None = None, text_fields: Sequence[str] = (),
) -> None:
    """A sample as bundle lines with the mapping, documents and row count of an index.

    A line holds about `LINE_DOCUMENTS` documents, so a large sample takes several lines of its index.
    """
    sample = sample_with_total(df, time_field, limit, tie_break, index, total="__total")
    key = Fields.of(sample).find(index).column
    content = [quoted(name) for name in df.columns if name != index]
    # as many lines as the index has documents for: a limit far above them would leave a line per document
    needed = F.greatest(F.ceil(F.least(F.col("__total"), F.lit(limit).cast("bigint")) / LINE_DOCUMENTS), F.lit(1).cast("bigint"))
    lines = F.pmod(F.xxhash64(*[F.to_json(F.struct(*content))]), needed)
    per_index = sample.groupBy(key.alias("name"), lines.alias("__line")).agg(
        F.collect_list(F.struct(*content)).alias("documents"), F.max("__total").alias("count")
    )
    kept = T.StructType([f for f in df.schema.fields if f.name != index])
    mapping = F.parse_json(F.lit(json.dumps(mapping_of(kept, text_fields))))
    described = {"sample_size": F.lit(limit), "exported_at": F.current_timestamp()}
    described.update({name: F.lit(value) for name, value in (metadata or {}).items()})
    definition = F.struct("name", F.struct().alias("settings"), mapping.alias("mappings"), "documents", "count")
    line = F.struct(
        F.struct(*[column.alias(name) for name, column in described.items()]).alias("metadata"),
        F.create_map("name", definition).alias("indices"),
    )
    per_index.select(F.to_json(line, dict(TEXT_TIMES)).alias("value")).write.text(path)
