"""Sorting, newest-N and newest-N-per-index."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import Fields, quoted

DEFAULT_LIMIT = 500
DEFAULT_SAMPLE = 100
# Fewest slices an index is ranked in.
SLICES = 64


@dataclass(frozen=True)
class Key:
    """One key of an order."""

    column: Column
    descending: bool = False
    nulls_first: bool = True

    def sorted(self) -> Column:
        if self.descending:
            return self.column.desc_nulls_first() if self.nulls_first else self.column.desc_nulls_last()
        return self.column.asc_nulls_first() if self.nulls_first else self.column.asc_nulls_last()


def newest_keys(fields: Fields, time_field: str, tie_break: Iterable[str] = ()) -> list[Key]:
    """Time descending, missing times last, then the tie-break fields; those alone in a table without the time field."""
    time = fields.find(time_field)
    return ([] if time is None else [Key(time.column, True, False)]) + [Key(fields.find(name).column, False, False) for name in tie_break]


def newest_first(fields: Fields, time_field: str, tie_break: Iterable[str] = ()) -> list[Column]:
    return [key.sorted() for key in newest_keys(fields, time_field, tie_break)]


def first_rows(df: DataFrame, order: list[Column], limit: int, start: int = 0) -> DataFrame:
    """`limit` rows from the `start`-th on; in no particular order where there are no sort keys."""
    rows = df.orderBy(*order) if order else df
    return (rows.offset(start) if start else rows).limit(limit)


def sort_columns(fields: Fields, spec: Iterable, score: Column | None = None) -> list[Column]:
    return [key.sorted() for key in sort_keys(fields, spec, score)]


def sort_keys(fields: Fields, spec: Iterable, score: Column | None = None) -> list[Key]:
    """Sort keys as given in a request; missing values last unless `missing: _first`.

    A key with `unmapped_type` is skipped where the field does not exist.
    """
    keys = []
    for item in spec:
        name, options = (item, {}) if isinstance(item, str) else next(iter(item.items()))
        options = {"order": options} if isinstance(options, str) else options
        if name == "_score":
            if score is not None:
                ascending = options.get("order") == "asc"
                keys.append(Key(score, not ascending, ascending))
            continue
        field = fields.find(name)
        if field is None:
            if "unmapped_type" in options:
                continue
            raise ValueError(f"cannot sort by {name!r}: no such field")
        descending = options.get("order", "asc").lower() == "desc"
        first = options.get("missing", "_last") == "_first"
        keys.append(Key(field.column, descending, first))
    return keys


def newest(df: DataFrame, time_field: str, limit: int = DEFAULT_LIMIT, tie_break: Iterable[str] = ()) -> DataFrame:
    """The newest rows.  Each task keeps its own newest `limit` before the merge."""
    return first_rows(df, newest_first(Fields.of(df), time_field, tie_break), limit)


def newest_bulk(df: DataFrame, time_field: str, limit: int, tie_break: Iterable[str] = ()) -> DataFrame:
    """Exactly the newest `limit` rows, in order, for limits too large to merge in one task."""
    return first_rows_spread(df, newest_keys(Fields.of(df), time_field, tie_break), limit)


# ------------------------------------------------------- first N for large N

# Rows are dealt over this many ranges of the order less one, and this many rows are looked at to find them.
RANGES = 1 << 8
LOOKED_AT = 8 * RANGES
# Limits up to this are merged in one task, or ranked per index.
LARGE_LIMIT = 20_000


def first_rows_spread(df: DataFrame, keys: list[Key], limit: int) -> DataFrame:
    """The first `limit` rows in the order of `keys`, sorted; nothing runs before the query does.

    Rows are counted per range of the order, the range that holds the last row wanted is found from the counts, and only
    the rows of that range are ranked. Which of the rows alike in all keys are taken is decided by their content.
    """
    ranged = _ranged(df, keys)
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    running = F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0))  # a row per range
    over = counts.withColumn("__last", running).where(F.col("__last") > limit)
    cut = over.agg(F.min_by(F.struct("__range", (limit - F.col("__last") + F.col("__n")).alias("left")), "__range").alias("cut")).scalar()
    before = ranged.where(cut.isNull() | (F.col("__range") < cut["__range"])).select(*map(quoted, df.columns))
    at = ranged.where(F.col("__range") == cut["__range"])
    found = before.unionByName(_ranked(df, at, [], cut["left"]))
    return found.orderBy(*[k.sorted() for k in keys]) if keys else found


def first_rows_per_group(df: DataFrame, group: Column, keys: list[Key], limit: int) -> DataFrame:
    """The first `limit` rows of every group; a group of any size is spread over the ranges of its rows."""
    ranged = _ranged(df, [Key(group), *keys]).withColumn("__group", F.struct(group.alias("g")))
    counts = ranged.groupBy("__group", "__range").agg(F.count(F.lit(1)).alias("__n"))
    running = F.sum("__n").over(Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, 0))
    over = counts.withColumn("__last", running).where(F.col("__last") > limit)
    # At most a row per group: its last range, and how many rows of that are wanted.
    cuts = over.groupBy("__group").agg(F.min_by(F.struct("__range", (limit - F.col("__last") + F.col("__n")).alias("left")), "__range").alias("__cut"))
    cut = ranged.join(cuts, "__group", "left")
    before = cut.where(F.col("__cut").isNull() | (F.col("__range") < F.col("__cut.__range"))).select(*map(quoted, df.columns))
    at = cut.where(F.col("__range") == F.col("__cut.__range"))
    return before.unionByName(_ranked(df, at, ["__group"], F.col("__cut.left")))


def _hashed(df: DataFrame) -> list[str]:
    """Columns that have a hash and can be grouped by."""
    whole = lambda t: not isinstance(t, (T.MapType, T.VariantType)) and all(
        whole(x) for x in ([f.dataType for f in t.fields] if isinstance(t, T.StructType) else [t.elementType] if isinstance(t, T.ArrayType) else [])
    )
    return [f.name for f in df.schema.fields if whole(f.dataType)]


def _ascending(key: Key, dtype: T.DataType) -> list[Column]:
    """Values whose plain order, nulls first, is the order of the key."""
    value = key.column
    if not key.descending:
        plain = value
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        plain = F.bitwise_not(F.unix_micros(value.cast("timestamp")))
    elif isinstance(dtype, T.DateType):
        plain = F.bitwise_not(F.unix_date(value))
    elif isinstance(dtype, T.IntegralType):
        plain = F.bitwise_not(value)
    elif isinstance(dtype, T.BooleanType):
        plain = ~value
    elif isinstance(dtype, T.DecimalType):
        plain = -value
    elif isinstance(dtype, T.FractionalType):
        plain = F.struct((~F.isnan(value)).alias("n"), (-value).alias("v"))  # no number is the largest
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        # The end sorts after every character, as a longer text comes first.
        plain = F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    else:
        raise ValueError(f"cannot sort by {dtype.simpleString()}")
    return [plain] if key.nulls_first and not key.descending else [value.isNull() != key.nulls_first, plain]


def _ranged(df: DataFrame, keys: list[Key]) -> DataFrame:
    """Rows with their place in the order, `__order`, and the number of the range they lie in, `__range`.

    The borders are rows with small hashes, so the same table has the same ones whenever they are computed, and they
    travel as one array. Rows alike in all keys lie in ranges by their hash.
    """
    types = df.select(*[k.column for k in keys]).schema.fields if keys else []
    parts = [part for key, field in zip(keys, types) for part in _ascending(key, field.dataType)]
    tie = F.xxhash64(*[quoted(c) for c in _hashed(df)])
    order = F.struct(*[part.alias(f"k{i}") for i, part in enumerate([*parts, tie])])
    placed = df.withColumn("__order", order)
    some = placed.select("__order").orderBy(F.xxhash64(F.col("__order")[f"k{len(parts)}"])).limit(LOOKED_AT)
    chosen = some.withColumn("__at", F.row_number().over(Window.orderBy("__order"))).where(F.col("__at") % (LOOKED_AT // RANGES) == 0)
    borders = chosen.agg(F.sort_array(F.collect_list("__order"))).scalar()

    # A projection per halving: the generated code does a comparison each, and no step is copied into the next.
    searched = placed.withColumn("__borders", borders).withColumn("__range", F.lit(0))
    step = RANGES // 2
    while step:
        border = F.get(F.col("__borders"), F.col("__range") + (step - 1))
        searched = searched.withColumn("__range", F.when(border < F.col("__order"), F.col("__range") + step).otherwise(F.col("__range")))
        step //= 2
    # Filters on generated columns stay above them; below, each would repeat the whole search twice per step.
    return searched.select(*map(quoted, df.columns), "__order", F.explode(F.array("__range")).alias("__range"))


def _ranked(df: DataFrame, rows: DataFrame, group: list[str], wanted: Column) -> DataFrame:
    """The first `wanted` rows of one range; rows alike in all columns are counted, not ranked."""
    columns = [quoted(c) for c in df.columns]
    rows = rows.withColumn("__wanted", wanted)
    over = Window.partitionBy(*group, "__range").orderBy("__order")
    if len(_hashed(df)) < len(df.columns):
        return rows.withColumn("__rank", F.row_number().over(over)).where(F.col("__rank") <= F.col("__wanted")).select(*columns)
    counted = rows.groupBy(*columns, *group, "__order", "__range", "__wanted").agg(F.count(F.lit(1)).alias("__n"))
    earlier = F.coalesce(F.sum("__n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = F.least(F.col("__n"), F.col("__wanted") - F.col("__earlier"))
    some = counted.withColumn("__earlier", earlier).where(F.col("__earlier") < F.col("__wanted"))
    return some.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), taken)).alias("__copy")).drop("__copy")


def newest_per_index(
    df: DataFrame,
    time_field: str,
    limit: int = DEFAULT_SAMPLE,
    tie_break: Iterable[str] = (),
    index: str = "_index",
    slices: int | None = None,
) -> DataFrame:
    """The newest `limit` rows of every index, in one job.

    One index may hold most rows, so ranking runs twice: first per index and input
    slice, which spreads a hot index over all tasks, then per index over the few rows
    left; where Spark can, it cuts to `limit` per key before each exchange.  Beyond `LARGE_LIMIT` an index is
    cut by counts over ranges of its rows instead, so no task ranks it.
    """
    fields = Fields.of(df)
    if limit > LARGE_LIMIT:
        return first_rows_per_group(df, fields.find(index).column, newest_keys(fields, time_field, tie_break), limit)
    order = newest_first(fields, time_field, tie_break) or [F.lit(0).asc()]
    key = fields.find(index).column
    slices = slices or max(SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = df.withColumn("__slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
    for keys in ([key, F.col("__slice")], [key]):
        ranked = sliced.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        sliced = ranked.where(F.col("__rank") <= limit).drop("__rank")
    return sliced.drop("__slice")


def sample_with_total(
    df: DataFrame,
    time_field: str,
    limit: int = DEFAULT_SAMPLE,
    tie_break: Iterable[str] = (),
    index: str = "_index",
    total: str = "total",
) -> DataFrame:
    """The sample of every index next to the row count of the whole index.

    The count is a separate aggregate that reads the index column only; counting
    in a window would shuffle every row.
    """
    key = Fields.of(df).find(index).column
    totals = df.groupBy(key.alias("__index")).agg(F.count(F.lit(1)).alias(total))
    sample = newest_per_index(df, time_field, limit, tie_break, index)
    return sample.join(totals, Fields.of(sample).find(index).column.eqNullSafe(F.col("__index"))).drop("__index")
