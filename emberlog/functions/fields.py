"""Field names of an index resolved against a DataFrame schema.

Names may hold dots, `@`, `-` and `/`.  A literal column of that name wins, then
a path through structs, maps, arrays of structs and variants.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_MILLIS_FIELDS = frozenset({"startTimeMillis"})


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Field:
    name: str
    column: Column
    dtype: T.DataType
    text: bool = False
    epoch_millis: bool = False

    @property
    def element_type(self) -> T.DataType:
        return self.dtype.elementType if isinstance(self.dtype, T.ArrayType) else self.dtype


@dataclass(frozen=True)
class Relation:
    """Rows of another table tied to this one: `here = there` on the key columns."""

    df: DataFrame
    here: str
    there: str
    text_fields: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Fields:
    """What a query needs to know about the rows it runs on."""

    schema: T.StructType
    text_fields: frozenset[str] = frozenset()
    epoch_millis: frozenset[str] = EPOCH_MILLIS_FIELDS
    now: datetime | None = None
    relations: Mapping[str, Relation] = field(default_factory=dict)
    root: Column | None = None
    prefix: str = ""
    # For clauses that look at the whole table: the table, what names its rows, stored word counts.
    rows: DataFrame | None = None
    id_field: str | None = None
    statistics: DataFrame | None = None

    @classmethod
    def of(cls, df: DataFrame, text_fields: Iterable[str] = (), **kwargs) -> Fields:
        return cls(df.schema, frozenset(text_fields), rows=df, **kwargs)

    def find(self, name: str) -> Field | None:
        """The field called `name`, or None where the index has no such field."""
        if self.prefix and name.startswith(self.prefix):
            name = name[len(self.prefix):]
        found = _walk(self.schema, self.root, name.split("."))
        if found is None:
            return None
        column, dtype = found
        full = self.prefix + name
        return Field(full, column, dtype, full in self.text_fields, full in self.epoch_millis)

    def inside(self, path: str, element: Column, schema: T.StructType) -> Fields:
        """The same query context within one element of the nested array `path`."""
        return replace(self, schema=schema, root=element, prefix=f"{path}.", relations={}, rows=None)

    def text(self) -> list[Field]:
        """Fields a bare word is looked up in: the text fields, else every string column."""
        named = [f for f in map(self.find, sorted(self.text_fields)) if f is not None]
        if named:
            return named
        return [
            self.find(self.prefix + f.name)
            for f in self.schema.fields
            if isinstance(f.dataType, T.StringType)
        ]


def _walk(struct: T.StructType, root: Column | None, parts: list[str]):
    by_name = {f.name: f for f in struct.fields}
    for end in range(len(parts), 0, -1):
        head = ".".join(parts[:end])
        member = by_name.get(head)
        if member is None:
            continue
        column = quoted(head) if root is None else root.getField(head)
        return _descend(column, member.dataType, parts[end:])
    return None


def _descend(column: Column, dtype: T.DataType, rest: list[str]):
    if not rest:
        return column, dtype
    if isinstance(dtype, T.StructType):
        return _walk(dtype, column, rest)
    if isinstance(dtype, T.MapType):
        return F.try_element_at(column, F.lit(".".join(rest))), dtype.valueType
    if isinstance(dtype, T.VariantType):
        path = "$" + "".join(f"['{part}']" for part in rest)
        return F.try_variant_get(column, path, "variant"), dtype
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        inner = _walk(dtype.elementType, column, rest)
        if inner is None or isinstance(inner[1], T.ArrayType):
            return inner
        return inner[0], T.ArrayType(inner[1])
    return None


def col_of(df: DataFrame, name: str) -> Column:
    """The column of `df` a field name stands for; an unknown name is an error."""
    found = Fields.of(df).find(name)
    if found is None:
        raise KeyError(f"no field {name!r} in {df.columns}")
    return found.column
