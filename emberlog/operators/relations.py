"""Operators that need whole tables rather than one row: stored queries, similar
documents, rows of one trace over several sources, fan-out to indices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions.fields import Fields, quoted
from emberlog.operators import predicates as P
from emberlog.operators import stored
from emberlog.operators.dsl import compile_query
from emberlog.operators.similar import Terms, similar


def percolate(df: DataFrame, queries: Mapping[str, dict] | DataFrame, fields: Fields | None = None, label: str = "query_id") -> DataFrame:
    """Every row once per stored query it matches; queries may be a table of names and bodies as JSON text."""
    fields = fields or Fields.of(df)
    if isinstance(queries, DataFrame):
        queries = stored.queries_of(queries, *queries.columns)
    return stored.percolate(df, queries, fields, label, lambda f, q: compile_query(f, q).matches)


def more_like_this(df: DataFrame, field: str | Sequence[str], like: Sequence, id_field: str, like_text: Sequence[str] = (), **settings) -> DataFrame:
    """Rows that share enough of the most telling words of the rows called `like` and of `like_text`."""
    names = [field] if isinstance(field, str) else list(field)
    matches, _ = similar(Fields.of(df, id_field=id_field), names, like, like_text, settings=Terms(**settings))
    return df.where(matches)


def fan_out(df: DataFrame, indices: Sequence[str] | DataFrame) -> DataFrame:
    """Every row once per target index.

    The index names travel with the rows as one array, so nothing is shuffled.
    """
    if isinstance(indices, DataFrame):
        name = quoted(indices.columns[0])
        targets: Column = indices.agg(F.array_sort(F.collect_set(name)).alias("names")).scalar()
    else:
        targets = F.array(*[F.lit(name) for name in indices])
    return df.withColumn("_index", F.explode(targets))


def trace_rows(sources: Mapping[str, DataFrame], trace_id: str, trace_field: str = "traceID") -> DataFrame:
    """All rows of one trace from several sources, tagged with their source.

    The filter runs on each source before the union, where it can be pushed to the scan.
    """
    parts = []
    for name, df in sources.items():
        fields = Fields.of(df)
        parts.append(df.where(P.term(fields.find(trace_field), trace_id)).withColumn("_source", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
