"""A table of log records and the chain of steps an export or sample is made of."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions.fields import Fields, Relation
from emberlog.operators import aggregations, filters, ordering, reshape
from emberlog.operators.catalogue import DEFAULT_TIME_FIELD, INDEX_TYPES, TIME_FIELDS, kind_of
from emberlog.operators.dsl import Body, compile_query
from emberlog.operators.relations import percolate as percolate_rows
from emberlog.operators.search import search_predicate
from emberlog.operators.views import View, view_named
from emberlog.sources.indices import prune_by_date


def time_field_of(df: DataFrame, kind: str = "generic") -> str:
    """The first time column of the kind's list that `df` has, else its first date column."""
    fields = Fields.of(df)
    own = [f.name for f in df.schema.fields]
    for name in dict.fromkeys([*TIME_FIELDS[kind], *own]):
        found = fields.find(name)
        if found is not None and (found.epoch_millis or INDEX_TYPES.get(type(found.dtype)) == "date"):
            return name
    return DEFAULT_TIME_FIELD[kind]


@dataclass(frozen=True)
class LogTable:
    """Steps return a new LogTable; `df` is the lazy result so far.

    `tie_break` names fields that make the time order unique, `date_partition` the date
    column the table is partitioned by, if any, and `name` the index or pattern it is.
    """

    df: DataFrame
    time_field: str | None = None
    text_fields: tuple[str, ...] = ()
    tie_break: tuple[str, ...] = ()
    now: datetime | None = None
    relations: Mapping[str, Relation] = field(default_factory=dict)
    entities: Mapping[str, list[str]] | None = None
    date_partition: str | None = None
    name: str = ""
    body: Body | None = None
    # Word counts kept by `similar.write_term_statistics`, for more_like_this.
    statistics: DataFrame | None = None

    def __post_init__(self):
        if self.time_field is None:
            object.__setattr__(self, "time_field", time_field_of(self.df, self.kind))

    @property
    def kind(self) -> str:
        """kubernetes, jaeger or generic."""
        return kind_of(filters.leaf_names(self.df.schema), self.name)

    @property
    def fields(self) -> Fields:
        names = [*self.tie_break, "_id"]
        return Fields.of(self.df, self.text_fields, now=self.now, relations=self.relations, id_field=names[0], statistics=self.statistics)

    def _where(self, predicate: Column) -> LogTable:
        return replace(self, df=self.df.where(predicate))

    # ------------------------------------------------------------ row filters

    def search(self, query: str | dict | None, with_score: bool = False) -> LogTable:
        """A search string, or a query body as a dict or as JSON text."""
        if query is None or (isinstance(query, str) and not query.lstrip().startswith("{")):
            return self._where(search_predicate(self.fields, query))
        body = Body.of(query)
        table = replace(self, body=body)
        if body.query is not None:
            hit = compile_query(self.fields, body.query)
            matched = self.df.where(hit.matches)
            if with_score or any("_score" in (s if isinstance(s, dict) else [s]) for s in body.sort or []):
                matched = matched.withColumn("_score", hit.score)
            table = replace(table, df=matched)
        return table

    def percolate(self, queries: Mapping[str, dict], label: str = "query_id") -> LogTable:
        """Every row once per stored query it matches."""
        return replace(self, df=percolate_rows(self.df, queries, self.fields, label))

    def between(self, frm=None, to=None) -> LogTable:
        """Rows of a time range, both ends included; whole date partitions are pruned first."""
        if frm is None and to is None:
            return self
        if self.fields.find(self.time_field) is None:
            raise ValueError(f"no time field {self.time_field!r}: give time_field to cut by time")
        table = self
        if self.date_partition:
            table = replace(self, df=prune_by_date(self.df, frm, to, self.now, self.date_partition))
        return table._where(filters.time_range(self.fields, self.time_field, frm, to))

    def entity_fields(self) -> Mapping[str, list[str]]:
        return self.entities if self.entities is not None else filters.entity_mapping(self.df)

    def where_entity(self, **wanted: str) -> LogTable:
        """namespace, pod, deployment, container, service, operation."""
        return self._where(filters.entity_filters(self.fields, self.entity_fields(), wanted))

    def warnings(self, **wanted: str) -> list[str]:
        """What `where_entity` would not apply, with fields that look alike."""
        names = filters.leaf_names(self.df.schema)
        return filters.filter_warnings(names, self.entity_fields(), wanted, self.kind)

    # ------------------------------------------------------- order and limits

    def keys(self) -> list[ordering.Key]:
        """The request's own sort, else newest first."""
        if self.body is not None and self.body.sort:
            score = F.col("_score") if "_score" in self.df.columns else None
            keys = ordering.sort_keys(self.fields, self.body.sort, score)
            return keys + [ordering.Key(self.fields.find(n).column, False, False) for n in self.tie_break]
        return ordering.newest_keys(self.fields, self.time_field, self.tie_break)

    def order(self) -> list[Column]:
        return [key.sorted() for key in self.keys()]

    def top(self, limit: int | None = None) -> LogTable:
        if limit is None:
            limit = self.body.size if self.body and self.body.size is not None else ordering.DEFAULT_LIMIT
        start = self.body.start if self.body else 0
        return replace(self, df=ordering.first_rows(self.df, self.order(), limit, start))

    def bulk(self, limit: int) -> LogTable:
        """The first `limit` rows for an export of many millions: cut by counts over ranges of the order, sorted in parts."""
        return replace(self, df=ordering.first_rows_spread(self.df, self.keys(), limit))

    def sample(self, limit: int = ordering.DEFAULT_SAMPLE, index: str = "_index", with_total: bool = False) -> LogTable:
        pick = ordering.sample_with_total if with_total else ordering.newest_per_index
        return replace(self, df=pick(self.df, self.time_field, limit, self.tie_break, index))

    # ----------------------------------------------------------------- output

    def canonical(self, keep: Iterable[str] = ()) -> LogTable:
        return replace(self, df=reshape.canonical_fields(self.df, self.entity_fields(), keep))

    def select(self, wanted: str) -> LogTable:
        """`"timestamp, level:severity"`: fields, entity names and renames."""
        names, aliases = reshape.parse_fields(wanted)
        df = self.df
        new = [e for e in filters.ENTITIES if e in names and e not in df.columns]
        if new:
            mapping = {e: self.entity_fields().get(e, []) for e in new}
            df = reshape.canonical_fields(df, mapping, keep=names)
        return replace(self, df=reshape.select_fields(df, names, aliases))

    def view(self, view: str | View, preset: bool = False, colors: bool = False) -> LogTable:
        chosen = view if isinstance(view, View) else view_named(view, preset)
        return replace(self, df=reshape.apply_view(self.df, chosen, colors))

    def auto_view(self, colors: bool = False) -> LogTable:
        """The preset for the kind the table's name tells; other tables stay as they are."""
        kind = kind_of((), self.name)
        return self if kind == "generic" else self.view(kind, preset=True, colors=colors)

    def aggregate(self, aggs: dict | None = None) -> dict[str, DataFrame]:
        """The given aggregations, or those of the request searched for."""
        wanted = aggs or (self.body.aggs if self.body else None)
        if not wanted:
            raise ValueError("no aggregations given")
        return aggregations.aggregate(self.df, wanted, self.fields)

    def export(self, fields: str | None = None, limit: int | None = None) -> DataFrame:
        """Newest rows, reshaped: readable time, canonical entities, selected fields.

        Without `fields`, the `_source` list of the request is used if it has one.
        """
        if fields is None and self.body and self.body.source:
            fields = ",".join(self.body.source)
        table = self.top(limit)
        table = replace(table, df=reshape.millis_to_timestamp(table.df))
        return table.select(fields).df if fields else table.canonical().df
