"""The row-wise operators on streams: filter, reshape, write.

Predicates and projections hold no state, so they run on `readStream` frames as they
are; only offsets need a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from emberlog.functions.fields import Fields
from emberlog.operators.dsl import compile_query
from emberlog.operators.search import search_predicate


def read_index_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", **options
) -> DataFrame:
    """New files of an index folder, as they arrive."""
    return spark.readStream.format(file_format).schema(schema).options(**options).load(path)


def search_stream(stream: DataFrame, query: str | dict, text_fields: Iterable[str] = ()) -> DataFrame:
    fields = Fields.of(stream, text_fields)
    if isinstance(query, str):
        return stream.where(search_predicate(fields, query))
    return stream.where(compile_query(fields, query).matches)


def write_stream(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
