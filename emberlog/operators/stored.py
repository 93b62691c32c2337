"""Many stored queries over rows: an index of what each query requires picks candidates, the whole query is tested on those alone.

A query is taken apart into alternatives, each a list of conditions that all must hold. An alternative is found
by that condition which the fewest queries share: a value or word a row must have, or the cells of a range its value must lie in. The
conditions are rows of a table, so the plan is as small for ten thousand queries as for ten. A second condition with a value or
a bounded range joins the first in the key, as a condition that few queries share may still hold for most rows. What can't be taken apart
(patterns, fuzzy words, relations) is tested as before, a predicate per query.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import Field, Fields, quoted
from emberlog.functions.timeexpr import resolve_time
from emberlog.operators import predicates as P

#: More alternatives than this and a query is tested whole.
MOST_ALTERNATIVES = 64
#: Widths, as powers of two, of the cells that ranges are looked up by, and how many cells a range may take.
CELL_BITS = tuple(range(0, 64, 4))
MOST_CELLS = 33
#: Keys that two conditions may make together, and what stands between their parts.
MOST_PAIRS = 64
AND = "\x1f"

_INSTANTS = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Atom:
    """One condition: a value, a word or phrase of a text, a range of numbers or instants, or that there is a value.

    Ranges of doubles have `low` and `high`, those of whole numbers and instants `first` and `last`, all included.
    """

    field: str
    kind: str
    word: str | None = None
    low: float | None = None
    high: float | None = None
    first: int | None = None
    last: int | None = None
    negated: bool = False

    def no(self) -> Atom:
        return Atom(**{**self.__dict__, "negated": not self.negated})


class Whole(Exception):
    """The query has a part that no atom stands for."""


Alternatives = list[tuple[Atom, ...]]
NEVER: Alternatives = []
ALWAYS: Alternatives = [()]
MIN_LONG, MAX_LONG = -(1 << 63), (1 << 63) - 1


def alternatives(fields: Fields, query: dict) -> Alternatives:
    """The query as alternatives; raises `Whole` where it can't be taken apart."""
    ((name, body),) = query.items()
    if name in ("match_all",):
        return ALWAYS
    if name == "constant_score":
        return alternatives(fields, body["filter"])
    if name == "dis_max":
        return _any_of([alternatives(fields, q) for q in _listed(body["queries"])])
    if name == "bool":
        return _bool(fields, body)
    options = {k: v for k, v in body.items() if k not in ("boost", "_name")} if isinstance(body, dict) else {}
    if name == "exists":
        field = _field(fields, options["field"])
        return NEVER if field is None else [(Atom(field.name, "exists"),)]
    if len(options) != 1 or name not in ("term", "terms", "match", "match_phrase", "range"):
        raise Whole(name)
    ((path, value),) = options.items()
    field = _field(fields, path)
    if name == "terms":
        if not isinstance(value, (list, tuple)):
            raise Whole(name)
        return _any_of([_equal(field, v) for v in value])
    if name == "range":
        if set(value) - {"gte", "gt", "lte", "lt", "boost", "_name"}:
            raise Whole(name)
        return _range(field, value, fields.now)
    key = {"term": "value"}.get(name, "query")
    rest = {k for k in value if k not in (key, "boost", "_name", "operator")} if isinstance(value, dict) else set()
    if rest:
        raise Whole(name)
    operator = str(value.get("operator", "or")).lower() if isinstance(value, dict) else "or"
    value = value[key] if isinstance(value, dict) else value
    if name == "term" or field is None or not field.text:
        return _equal(field, value)
    words = P.analyze(value)
    if not words:
        return NEVER
    if name == "match_phrase":
        return [(Atom(field.name, "phrase", " ".join(words)),)]
    tokens = [(Atom(field.name, "token", w),) for w in dict.fromkeys(words)]
    return [tuple(a for t in tokens for a in t)] if operator == "and" else tokens


def _listed(value) -> list:
    return [] if value is None else list(value) if isinstance(value, (list, tuple)) else [value]


def _field(fields: Fields, name: str) -> Field | None:
    field = fields.find(name)
    if field is not None and (isinstance(field.dtype, (T.ArrayType, T.VariantType, T.MapType, T.StructType, T.DateType, T.BooleanType, T.DecimalType)) or field.epoch_millis):
        raise Whole(name)
    return field


def _equal(field: Field | None, value) -> Alternatives:
    if field is None or value is None:
        return NEVER
    if isinstance(field.dtype, T.StringType):
        return [(Atom(field.name, "value", str(value).lower() if isinstance(value, bool) else str(value)),)]
    return _range(field, {"gte": value, "lte": value}, None)


def _range(field: Field | None, bounds: dict, now: datetime | None) -> Alternatives:
    given = {op: bounds[op] for op in ("gte", "gt", "lte", "lt") if bounds.get(op) is not None}
    if field is None:
        return NEVER
    if not given:
        return [(Atom(field.name, "exists"),)]
    if isinstance(field.dtype, T.StringType):
        raise Whole("range of strings")
    if isinstance(field.dtype, T.FractionalType):
        low, high = -math.inf, math.inf
        for op, bound in given.items():
            number = P._number(bound)
            if number is None:
                return NEVER
            number = float(number)
            if op in ("gte", "gt"):
                low = max(low, math.nextafter(number, math.inf) if op == "gt" else number)
            else:
                high = min(high, math.nextafter(number, -math.inf) if op == "lt" else number)
        if isinstance(field.dtype, T.FloatType):
            raise Whole("floats")
        return [(Atom(field.name, "double", low=low, high=high),)] if low <= high else NEVER
    first, last = MIN_LONG, MAX_LONG
    for op, bound in given.items():
        if isinstance(field.dtype, _INSTANTS):
            try:
                at = resolve_time(bound, now)
            except ValueError:
                return NEVER
            delta = at.replace(tzinfo=at.tzinfo or timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
            number = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
        else:
            number = P._number(bound)
            if number is None:
                return NEVER
            if not float(number).is_integer():
                op, number = ("gte", math.ceil(number)) if op in ("gte", "gt") else ("lte", math.floor(number))
            number = int(number)
        if op in ("gte", "gt"):
            first = max(first, number + (op == "gt"))
        else:
            last = min(last, number - (op == "lt"))
    return [(Atom(field.name, "long", first=first, last=last),)] if first <= last else NEVER


def _bool(fields: Fields, body: dict) -> Alternatives:
    if set(body) - {"must", "filter", "must_not", "should", "minimum_should_match", "boost", "_name"}:
        raise Whole("bool")
    needed = [alternatives(fields, q) for q in [*_listed(body.get("must")), *_listed(body.get("filter"))]]
    should = [alternatives(fields, q) for q in _listed(body.get("should"))]
    wanted = body.get("minimum_should_match", 0 if needed or not should else 1)
    if str(wanted) not in ("0", "1"):
        raise Whole("minimum_should_match")
    if str(wanted) == "1":
        needed.append(_any_of(should))
    needed += [_negated(alternatives(fields, q)) for q in _listed(body.get("must_not"))]
    return _all_of(needed)


def _any_of(parts: list[Alternatives]) -> Alternatives:
    return _few(list(dict.fromkeys(a for part in parts for a in part)))


def _all_of(parts: list[Alternatives]) -> Alternatives:
    found = ALWAYS
    for part in parts:
        found = _few(list(dict.fromkeys((*a, *b) for a, b in product(found, part))))
    return found


def _negated(part: Alternatives) -> Alternatives:
    """None of the alternatives holds: of each, some condition doesn't."""
    return _all_of([[(atom.no(),) for atom in alternative] for alternative in part])


def _few(found: Alternatives) -> Alternatives:
    if len(found) > MOST_ALTERNATIVES:
        raise Whole("too many alternatives")
    return found


# ------------------------------------------------------------------- the index


def _ordered(value: float) -> int:
    """Doubles as whole numbers in the same order, in steps of a 2^20th of the value's power of two."""
    if value == 0:
        return 0
    mantissa, exponent = math.frexp(min(abs(value), 1e300))
    steps = (exponent + 1100) * (1 << 20) + math.floor((mantissa - 0.5) * (1 << 21))
    return steps if value > 0 else -steps


def _cells(first: int, last: int) -> list[str]:
    """The cells of one width that cover a range, the narrowest width that takes few of them."""
    for bits in CELL_BITS:
        a, b = first >> bits, last >> bits
        if b - a < MOST_CELLS:
            return [f"{bits}/{k}" for k in range(a, b + 1)]
    return [f"{CELL_BITS[-1]}/{k}" for k in range(first >> CELL_BITS[-1], (last >> CELL_BITS[-1]) + 1)]


#: Conditions that lead to rows; of equally shared ones the first kind.
_SEARCHED = ("value", "phrase", "token", "long", "double")


def keys_of(atom: Atom) -> list[tuple[str, str]]:
    """(field, key) pairs one of which every row has that fulfils the condition."""
    if atom.kind in ("value", "token"):
        return [(atom.field, atom.word)]
    if atom.kind == "phrase":
        return [(atom.field, max(atom.word.split(" "), key=len))]
    cells = _cells(atom.first, atom.last) if atom.kind == "long" else _cells(_ordered(atom.low), _ordered(atom.high))
    return [(atom.field, c) for c in cells]


def _single(fields: Fields, atom: Atom) -> bool:
    """A row has at most one key of a width for the condition."""
    return not fields.find(atom.field).text


def _bounded(atom: Atom) -> bool:
    if atom.kind == "double":
        return math.isfinite(atom.low) and math.isfinite(atom.high)
    return atom.kind != "long" or (atom.first > MIN_LONG and atom.last < MAX_LONG)


def index_of(fields: Fields, queries: Mapping[str, dict]) -> tuple[list[tuple], dict[str, dict]]:
    """(id, alternative, field, key, atoms) rows of the queries that come apart, and those that don't."""
    found, whole = [], {}
    for name, query in queries.items():
        try:
            found += [(name, alternative) for alternative in alternatives(fields, query)]
        except Whole:
            whole[name] = query
    keyed = [(name, alternative, [(a, keys_of(a)) for a in alternative if not a.negated and a.kind in _SEARCHED]) for name, alternative in found]
    # A key that many queries have tells little: rows with it would meet them all.
    used = Counter(key for _, _, atoms in keyed for _, keys in atoms for key in keys)
    rows = []
    for name, alternative, atoms in keyed:
        ranked = sorted(atoms, key=lambda ak: (max(used[k] for k in ak[1]), _SEARCHED.index(ak[0].kind)))
        keys = ranked[0][1] if ranked else [("", "")]
        if ranked and _single(fields, ranked[0][0]):
            others = [k for a, k in ranked[1:] if a.field != ranked[0][0].field and _single(fields, a) and _bounded(a) and len(k) * len(keys) <= MOST_PAIRS]
            keys = [tuple(map(AND.join, zip(*sorted(pair)))) for pair in product(keys, others[0])] if others else keys
        told = [dict(a.__dict__) for a in alternative]
        rows += [(name, field, key, told) for field, key in keys]
    return rows, whole


_INDEX = pa.schema([("__field", pa.string()), ("__key", pa.string()), ("__number", pa.int64())])
_ALTERNATIVES = pa.schema([
    ("__number", pa.int64()), ("__query", pa.string()),
    ("__atoms", pa.list_(pa.struct([
        ("field", pa.string()), ("kind", pa.string()), ("word", pa.string()), ("low", pa.float64()), ("high", pa.float64()),
        ("first", pa.int64()), ("last", pa.int64()), ("negated", pa.bool_()),
    ]))),
])


def _row_keys(named: Mapping[str, Field], name: str, searched: set[str]) -> Column:
    """The keys of a row that an index has for a field, or for two fields together."""
    if AND not in name:
        field = named[name]
        if field.text:
            return F.array_distinct(F.concat(P.tokens(field.column), F.array(field.column)))
        return F.array(*[_row_key(field, bits) for bits in _widths([field], searched)])
    pair = [named[n] for n in name.split(AND)]
    return F.array(*[F.concat(*[c for field, w in zip(pair, bits) for c in (_row_key(field, (w,)), F.lit(AND))][:-1]) for bits in _widths(pair, searched)])


def _widths(fields: Sequence[Field], searched: set[str]) -> list[tuple[int | None, ...]]:
    """The widths of cells that the keys have, one per field; None for a field of strings, which has none."""
    text = [isinstance(f.dtype, T.StringType) for f in fields]
    if all(text):
        return [(None,) * len(fields)]
    found = set()
    for key in searched:
        # The parts of numbers hold no separator; a string may.
        parts = [key] if len(fields) == 1 else key.rsplit(AND, 1) if text[0] else key.split(AND, 1)
        found.add(tuple(None if is_text else int(part.partition("/")[0]) for is_text, part in zip(text, parts)))
    return sorted(found, key=str)


def _row_key(field: Field, bits: tuple[int | None, ...]) -> Column:
    if isinstance(field.dtype, T.StringType):
        return field.column
    number = _long(field) if not isinstance(field.dtype, T.FractionalType) else _ordered_column(field.column)
    return F.concat(F.lit(f"{bits[0]}/"), F.shiftright(number, bits[0]).cast("string"))


def _long(field: Field) -> Column:
    if isinstance(field.dtype, _INSTANTS):
        return F.unix_micros(field.column.cast("timestamp"))
    return field.column.cast("bigint")


def _ordered_column(value: Column) -> Column:
    """As `_ordered`; NaN, which Spark orders last, as the largest."""
    size = F.least(F.abs(value), F.lit(1e300))
    exponent = F.floor(F.log2(size)) + 1
    # The logarithm may be off by one next to a power of two.
    exponent = exponent + F.when(size >= F.pow(F.lit(2.0), exponent), 1).when(size < F.pow(F.lit(2.0), exponent - 1), -1).otherwise(0)
    mantissa = F.when(exponent > -1000, size / F.pow(F.lit(2.0), exponent)).otherwise(size * F.pow(F.lit(2.0), F.lit(1000)) / F.pow(F.lit(2.0), exponent + 1000))
    steps = (exponent + 1100) * (1 << 20) + F.floor((mantissa - 0.5) * (1 << 21))
    signed = F.when(value > 0, steps).otherwise(-steps)
    return F.when(value == 0, F.lit(0).cast("bigint")).when(F.isnan(value), F.lit(_ordered(math.inf))).otherwise(signed)


# Predicates that share one generated array; all arrays are filled in the same pass. So few queries need no index.
QUERIES_PER_ARRAY = 200


def percolate(df: DataFrame, queries: Mapping[str, dict], fields: Fields, label: str, compiled: Callable[[Fields, dict], Column]) -> DataFrame:
    """Every row once per stored query it matches; `compiled` gives the predicate of a query that doesn't come apart.

    Those predicates are evaluated in one pass over the rows: arrays of matched names, which
    keep the generated code small, are joined and exploded once.
    """
    found, whole = by_index(df, fields, queries, label) if len(queries) > QUERIES_PER_ARRAY or not queries else (None, queries)
    if not whole:
        return found
    named, arrays = list(whole.items()), []
    for start in range(0, len(named), QUERIES_PER_ARRAY):
        chunk = named[start:start + QUERIES_PER_ARRAY]
        arrays.append(F.array(*[F.when(compiled(fields, q), F.lit(name)) for name, q in chunk]))
    hits = F.filter(F.concat(*arrays), lambda name: name.isNotNull())
    tested = df.withColumn(label, F.explode(hits))
    return tested if len(whole) == len(queries) else found.unionByName(tested)


def by_index(df: DataFrame, fields: Fields, queries: Mapping[str, dict], label: str) -> tuple[DataFrame, dict[str, dict]]:
    """Rows once per query they match, and the queries that were left out as they don't come apart.

    Rows meet the index by their words, values and cells, each of which they have once; a row that meets one
    query by several of them is told once, as its own number says. Queries without a key meet all rows.
    """
    rows, whole = index_of(fields, queries)
    spark = df.sparkSession
    if not rows:
        return df.where("false").withColumn(label, F.lit("")), whole
    told: dict[int, dict] = {}  # keys of one alternative share its list
    numbers = [told.setdefault(id(r[3]), {"__number": len(told), "__query": r[0], "__atoms": r[3]})["__number"] for r in rows]
    # Spark knows the size of an Arrow table, so rows need no shuffle to meet a small index.
    index = spark.createDataFrame(pa.Table.from_pylist([{"__field": r[1], "__key": r[2], "__number": n} for r, n in zip(rows, numbers)], _INDEX))
    whole_alternatives = spark.createDataFrame(pa.Table.from_pylist(list(told.values()), _ALTERNATIVES))
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    asked: dict[str, set[str]] = {}
    for _, field, key, _ in rows:
        asked.setdefault(field, set()).add(key)
    named = {n: fields.find(n) for n in {a["field"] for r in rows for a in r[3]}}
    keys = [F.array(F.struct(F.lit("").alias("f"), F.lit("").alias("k")))] if "" in asked else []
    columns = {}
    for n, (name, searched) in enumerate((n, s) for n, s in sorted(asked.items()) if n):
        columns[f"__keys{n}"] = _row_keys(named, name, searched)
        keys.append(_pairs(F.col(f"__keys{n}"), name))
    values = {kind: [] for kind in ("words", "texts", "doubles", "longs", "there")}
    for name, field in sorted(named.items()):
        there = F.lit(name)
        if isinstance(field.dtype, T.StringType):
            values["words"].append((there, field.column))
            if field.text:
                values["texts"].append((there, F.concat(F.lit(" "), F.array_join(P.tokens(field.column), " "), F.lit(" "))))
        elif isinstance(field.dtype, T.FractionalType):
            values["doubles"].append((there, field.column))
        else:
            values["longs"].append((there, _long(field)))
        values["there"].append((there, field.column.isNotNull()))
    typed = {"words": "string", "texts": "string", "doubles": "double", "longs": "bigint", "there": "boolean"}
    maps = {f"__{k}": (F.create_map(*[c for pair in v for c in pair]) if v else F.create_map()).cast(f"map<string,{typed[k]}>") for k, v in values.items()}
    # Only keys that some query asks for leave a row.
    met = numbered.withColumns(columns).withColumn("__met", F.explode(F.concat(*keys))).drop(*columns)
    joined = met.join(index, (F.col("__met.f") == F.col("__field")) & (F.col("__met.k") == F.col("__key"))).join(whole_alternatives, "__number")
    tested = joined.withColumns(maps).where(F.forall("__atoms", _holds))
    found = tested.select(*[quoted(c) for c in df.columns], "__row", F.col("__query").alias(label))
    alone = len(told) == len({r[0] for r in rows})  # an alternative meets a row once
    return (found if alone else found.dropDuplicates(["__row", label])).drop("__row"), whole


def _pairs(keys: Column, name: str) -> Column:
    none = F.array().cast("array<struct<f:string,k:string>>")
    return F.coalesce(F.transform(F.array_compact(keys), lambda k: F.struct(F.lit(name).alias("f"), k.alias("k"))), none)


def _holds(atom: Column) -> Column:
    """A condition on the values of its row; a field without a value fulfils none, and so all negated ones."""
    field, kind = atom["field"], atom["kind"]
    at = lambda m: F.try_element_at(F.col(m), field)
    met = (
        F.when(kind == "value", at("__words") == atom["word"])
        .when(kind.isin("token", "phrase"), F.contains(at("__texts"), F.concat(F.lit(" "), atom["word"], F.lit(" "))))
        .when(kind == "double", at("__doubles").between(atom["low"], atom["high"]) | (F.isnan(at("__doubles")) & (atom["high"] == float("inf"))))
        .when(kind == "long", at("__longs").between(atom["first"], atom["last"]))
        .otherwise(at("__there"))
    )
    return F.coalesce(met, F.lit(False)) != atom["negated"]


def as_rows(spark: SparkSession, documents: Sequence[dict]) -> DataFrame:
    """Documents of a request as rows, objects as structs; fields without a value are left out."""

    def row(value):
        if isinstance(value, dict):
            return Row(**{k: row(v) for k, v in value.items() if v is not None})
        return [row(v) for v in value] if isinstance(value, list) else value

    frames = [spark.createDataFrame([row(d)]) for d in documents]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def queries_of(stored: DataFrame, name: str, body: str) -> dict[str, dict]:
    """Stored queries from a table, a name and a body as JSON text each; they are read when the plan is made."""
    rows = stored.select(F.col(name).cast("string"), F.col(body)).where(F.col(body).isNotNull()).collect()
    return {r[0]: _clause(json.loads(r[1])) for r in rows}


def _clause(body: dict) -> dict:
    return body["query"] if set(body) == {"query"} else body
