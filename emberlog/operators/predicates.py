"""Leaf predicates: one field, one condition, one Column.

A leaf that cannot hold (unknown field, literal of the wrong type) is false; a null
field makes a leaf null, which a filter drops.  `negate` is the only place that
turns null into false, so every other leaf stays in the shape Parquet can prune by.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.fields import Field
from emberlog.functions.timeexpr import epoch_millis, resolve_time, time_literal

# A token is a maximal run of these, compared in lower case.
TOKEN_CHARS = r"[\p{L}\p{N}_]"
_TOKEN = re.compile(r"\w+")


def never() -> Column:
    return F.lit(False)


def always() -> Column:
    return F.lit(True)


def negate(predicate: Column) -> Column:
    return ~F.coalesce(predicate, F.lit(False))


def all_of(predicates: Iterable[Column]) -> Column:
    found = list(predicates)
    return reduce(lambda a, b: a & b, found) if found else always()


def any_of(predicates: Iterable[Column]) -> Column:
    found = list(predicates)
    return reduce(lambda a, b: a | b, found) if found else never()


def _each(field: Field | None, test: Callable[[Column, T.DataType], Column]) -> Column:
    """`test` on the field's value, or on any element where the field is an array."""
    if field is None:
        return never()
    if isinstance(field.dtype, T.ArrayType):
        return F.exists(field.column, lambda x: test(x, field.element_type))
    return test(field.column, field.dtype)


def _literal(value, dtype: T.DataType, now: datetime | None = None) -> Column:
    """`value` as a literal of type `dtype`; a null literal where it does not convert."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        try:
            instant = resolve_time(value, now)
        except ValueError:
            return F.lit(None).cast(dtype)
        if isinstance(dtype, T.DateType):
            midnight = not (instant.hour or instant.minute or instant.second or instant.microsecond)
            return F.lit(instant.date()) if midnight else F.lit(None).cast(dtype)
        return time_literal(instant, dtype)
    if isinstance(dtype, T.StringType):
        return F.lit(str(value).lower() if isinstance(value, bool) else str(value))
    if isinstance(dtype, T.IntegralType):
        number = _number(value)
        whole = number is not None and float(number).is_integer()
        return F.lit(int(number) if whole else None).try_cast(dtype)
    return F.lit(value).try_cast(dtype)


def _number(value) -> float | int | None:
    if isinstance(value, bool):
        return None
    if isinstance(value, (int, float)):
        return value if math.isfinite(value) else None
    try:
        return int(str(value))
    except ValueError:
        pass
    try:
        number = float(str(value))
    except ValueError:
        return None
    return number if math.isfinite(number) else None


def _plain(column: Column, dtype: T.DataType, value) -> tuple[Column, T.DataType]:
    """A variant leaf read as the literal's own type; anything else as it is."""
    if not isinstance(dtype, T.VariantType):
        return column, dtype
    if isinstance(value, bool):
        target = T.BooleanType()
    elif _number(value) is not None:
        target = T.DoubleType()
    else:
        target = T.StringType()
    return F.try_variant_get(column, "$", target.simpleString()), target


def _string(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(column, "$", "string")
    return column.cast("string")


# ---------------------------------------------------------------- exact values


def term(field: Field | None, value, case_insensitive: bool = False, now=None) -> Column:
    def test(column, dtype):
        column, dtype = _plain(column, dtype, value)
        if case_insensitive and isinstance(dtype, T.StringType):
            return F.lower(column) == str(value).lower()
        return column == _literal(value, dtype, now)

    return _each(field, test)


def terms(field: Field | None, values: Iterable, now=None) -> Column:
    listed = list(values)
    if not listed:
        return never()

    def test(column, dtype):
        if isinstance(dtype, T.VariantType):
            typed = [(v, *_plain(column, dtype, v)) for v in listed]
            return any_of(plain == _literal(v, target, now) for v, plain, target in typed)
        return column.isin(*[_literal(v, dtype, now) for v in listed])

    return _each(field, test)


def exists(field: Field | None) -> Column:
    if field is None:
        return never()
    if isinstance(field.dtype, T.ArrayType):
        return F.size(field.column) > 0
    return field.column.isNotNull()


_COMPARE = {
    "gte": lambda a, b: a >= b,
    "gt": lambda a, b: a > b,
    "lte": lambda a, b: a <= b,
    "lt": lambda a, b: a < b,
}


def compare(field: Field | None, op: str, bound, now=None) -> Column:
    """One side of a range: `op` is gte, gt, lte or lt."""

    def test(column, dtype):
        column, dtype = _plain(column, dtype, bound)
        if field.epoch_millis and isinstance(dtype, T.IntegralType):
            try:
                return _COMPARE[op](column, F.lit(epoch_millis(resolve_time(bound, now))))
            except ValueError:
                pass
        if isinstance(dtype, T.IntegralType):
            return _compare_whole(column, dtype, op, _number(bound))
        if isinstance(dtype, T.DateType):
            return _compare_date(column, op, bound, now)
        return _COMPARE[op](column, _literal(bound, dtype, now))

    return _each(field, test)


def _compare_whole(column: Column, dtype: T.DataType, op: str, bound) -> Column:
    if bound is None:
        return never()
    if not float(bound).is_integer():
        # x > 1.5 is x >= 2, x < 1.5 is x <= 1: the column is compared in its own type.
        op, bound = ("gte", math.ceil(bound)) if op in ("gt", "gte") else ("lte", math.floor(bound))
    low, high = _WHOLE_LIMITS[dtype.typeName()]
    bound = int(bound)
    if bound < low or bound > high:
        holds = (bound < low) == (op in ("gt", "gte"))
        return column.isNotNull() if holds else never()
    return _COMPARE[op](column, F.lit(bound).cast(dtype))


_WHOLE_LIMITS = {
    name: (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)
    for name, bits in (("byte", 8), ("short", 16), ("integer", 32), ("long", 64))
}


def _compare_date(column: Column, op: str, bound, now) -> Column:
    try:
        instant = resolve_time(bound, now)
    except ValueError:
        return never()
    if instant.time() != datetime.min.time():
        # A date is its midnight: after 12:00 means a later date, before 12:00 the same date too.
        op = {"gte": "gt", "lt": "lte"}.get(op, op)
    return _COMPARE[op](column, F.lit(instant.date()))


def range_of(field: Field | None, bounds: dict, now=None) -> Column:
    """All given sides of a range, on one and the same element where the field is an array."""
    sides = {op: bounds[op] for op in _COMPARE if bounds.get(op) is not None}
    if sides and field is not None and isinstance(field.dtype, T.ArrayType):
        element = field.element_type
        return F.exists(field.column, lambda x: range_of(replace(field, column=x, dtype=element), sides, now))
    return all_of(compare(field, op, bound, now) for op, bound in sides.items())


# ------------------------------------------------------------ string patterns


def prefix(field: Field | None, value: str, case_insensitive: bool = False) -> Column:
    def test(column, dtype):
        column = _string(column, dtype)
        if case_insensitive:
            return F.lower(column).startswith(str(value).lower())
        return column.startswith(str(value))

    return _each(field, test)


def like_pattern(wildcard_value: str) -> str:
    """`*`/`?` wildcards as a LIKE pattern; `\\*`, `\\?` and `\\\\` are literal."""
    out = []
    for escaped, char in re.findall(r"\\(.)|(.)", wildcard_value, re.S):
        if char == "*":
            out.append("%")
        elif char == "?":
            out.append("_")
        else:
            literal = escaped or char
            out.append("\\" + literal if literal in "%_\\" else literal)
    return "".join(out)


def wildcard(field: Field | None, value: str, case_insensitive: bool = False) -> Column:
    pattern = like_pattern(str(value))

    def test(column, dtype):
        column = _string(column, dtype)
        return column.ilike(pattern) if case_insensitive else column.like(pattern)

    return _each(field, test)


def regexp(field: Field | None, value: str, case_insensitive: bool = False) -> Column:
    flags = "(?i)" if case_insensitive else ""
    return _each(field, lambda column, dtype: _string(column, dtype).rlike(f"{flags}^(?:{value})$"))


def fuzziness(value: str, setting="AUTO") -> int:
    """Edits allowed: AUTO is 0 up to length 2, 1 up to length 5, 2 beyond."""
    if str(setting).upper() == "AUTO":
        return 0 if len(value) <= 2 else 1 if len(value) <= 5 else 2
    return int(setting)


def fuzzy(field: Field | None, value: str, setting="AUTO", prefix_length: int = 0) -> Column:
    value = str(value)
    edits = fuzziness(value, setting)

    def near(word: Column) -> Column:
        close = F.levenshtein(word, F.lit(value), edits) >= 0
        if prefix_length:
            close = word.startswith(value[:prefix_length]) & close
        return close

    def test(column, dtype):
        column = _string(column, dtype)
        return F.exists(tokens(column), near) if field.text else near(column)

    return _each(field, test)


# ------------------------------------------------------------------ text match


def analyze(text) -> list[str]:
    """The tokens of a query text."""
    return _TOKEN.findall(str(text).lower())


def tokens(column: Column) -> Column:
    """The tokens of a column, in order."""
    return F.regexp_extract_all(F.lower(column), F.lit(f"({TOKEN_CHARS}+)"), F.lit(1))


def has_token(column: Column, words: Iterable[str]) -> Column:
    """Any of `words` is a token of `column`; no token array is built.

    The substring test is cheap and settles most rows before the regex runs.
    """
    lowered = F.lower(column)
    return any_of(lowered.contains(w) & lowered.rlike(_bounded(w)) for w in dict.fromkeys(words))


def has_phrase(column: Column, words: list[str], last_is_prefix: bool = False) -> Column:
    lowered = F.lower(column)
    between = r"[^\p{L}\p{N}_]+"
    adjacent = lowered.rlike(_bounded(between.join(words), open_end=last_is_prefix))
    return all_of([lowered.contains(w) for w in _longest_first(words)] + [adjacent])


def has_near(column: Column, words: list[str], slop: int) -> Column:
    """`words` stand in order, or are moved by no more than `slop` places altogether; two moves let neighbours change places.

    With the place of each word less its place in the phrase, a match has all of these within `slop`.
    Token arrays are built only for rows that have all the words.
    """
    distinct = list(dict.fromkeys(words))
    wanted = {w: [k for k, word in enumerate(words) if word == w] for w in distinct}

    def places(text: Column, word: str) -> Column:
        return F.filter(F.transform(text, lambda token, i: F.when(token == word, i)), lambda i: i.isNotNull())

    def from_start(start: Column, at: Column) -> Column:
        tests = []
        for n, word in enumerate(distinct):
            last = F.lit(-1)
            for k in wanted[word]:  # a place serves one word of the phrase
                last = F.array_min(_free(at[f"w{n}"], start + k, slop, last))
            tests.append(last.isNotNull())
        return all_of(tests)

    def in_text(at: Column) -> Column:
        starts = [F.transform(at[f"w{n}"], _less(k)) for n, word in enumerate(distinct) for k in wanted[word]]
        return F.exists(F.array_distinct(F.concat(*starts)), lambda start: from_start(start, at))

    near = F.exists(
        F.transform(F.array(tokens(column)), lambda text: F.struct(*[places(text, w).alias(f"w{n}") for n, w in enumerate(distinct)])), in_text
    )
    return all_of([has_token(column, [w]) for w in _longest_first(words)] + [near])


def _free(places: Column, first: Column, slop: int, last: Column) -> Column:
    return F.filter(places, lambda i: (i > last) & (i >= first) & (i <= first + slop))


def _less(k: int) -> Callable[[Column], Column]:
    return lambda i: i - k


def _longest_first(words: Iterable[str]) -> list[str]:
    """Long words are rare, so testing them first settles most rows at once."""
    return sorted(dict.fromkeys(words), key=len, reverse=True)


def _bounded(body: str, open_end: bool = False) -> str:
    """A regex for `body` between token borders."""
    return f"(?<!{TOKEN_CHARS}){body}" + ("" if open_end else f"(?!{TOKEN_CHARS})")


def match(field: Field | None, value, operator: str = "or", now=None) -> Column:
    """Text: any (`or`) or every (`and`) token of `value` occurs.  Otherwise equality."""
    if field is None or not field.text:
        return term(field, value, now=now)
    words = analyze(value)
    if not words:
        return never()

    def test(column, dtype):
        column = _string(column, dtype)
        if operator.lower() == "and":
            return all_of(has_token(column, [word]) for word in _longest_first(words))
        return has_token(column, words)

    return _each(field, test)


def match_count(field: Field | None, value) -> Column:
    """How many distinct tokens of `value` a text field holds."""
    found = [
        F.when(has_token(_string(field.column, field.dtype), [word]), 1).otherwise(0)
        for word in dict.fromkeys(analyze(value))
    ]
    return reduce(lambda a, b: a + b, found) if found else F.lit(0)


def match_phrase(field: Field | None, value, now=None, last_is_prefix: bool = False, slop: int = 0) -> Column:
    """Text: the tokens of `value` occur next to each other, or moved by `slop` places.  Otherwise equality."""
    if field is None or not field.text:
        return prefix(field, str(value)) if last_is_prefix else term(field, value, now=now)
    words = analyze(value)
    if not words:
        return never()
    if slop:
        return _each(field, lambda column, dtype: has_near(_string(column, dtype), words, slop))
    return _each(field, lambda column, dtype: has_phrase(_string(column, dtype), words, last_is_prefix))
