"""Search strings: `level:ERROR AND service:(api OR web) AND duration:>500`.

Leaves are picked out by pattern and turned into predicates; what is left of the
text is AND, OR, NOT and parentheses over them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column

from emberlog.functions.fields import Fields
from emberlog.operators import predicates as P

# Private-use marks stand for a quoted text or a finished predicate, by number.
_QUOTE, _DONE, _END = "\ue000", "\ue001", "\ue002"
_FIELD = r"(?P<field>(?:\\.|[^\s:()\\\ue000-\ue002])+):"
_GROUP = re.compile(_FIELD + r"\(")
_BRACKET = re.compile(r"\\.|[()]")
_LEAF = re.compile(
    rf"(?:{_FIELD}\s*)?(?P<value>[\[{{][^\]}}]*[\]}}]|[<>]=?\s*[^\s()]+|{_QUOTE}\d+{_END}|(?:\\.|[^\s()\ue000-\ue002])+)"
)
_RANGE = re.compile(r"([\[{])\s*(.+?)\s+TO\s+(.+?)\s*([\]}])")
_OPERATORS = {"AND": "AND", "OR": "OR", "NOT": "NOT", "&&": "AND", "||": "OR", "!": "NOT"}
_COMPARE = {">": "gt", ">=": "gte", "<": "lt", "<=": "lte"}


def search_predicate(
    fields: Fields,
    text: str | None,
    default_fields: list[str] | None = None,
    default_operator: str = "OR",
) -> Column:
    """The predicate a search string stands for; empty and `*` match everything."""
    text = (text or "").strip()
    if text in ("", "*", "*:*"):
        return P.always()
    quotes: list[str] = []
    done: list[Column] = []

    def keep(predicate: Column) -> str:
        done.append(predicate)
        return f" {_DONE}{len(done) - 1}{_END} "

    def quote(m: re.Match) -> str:
        quotes.append(re.sub(r"\\(.)", r"\1", m[1]))
        return f"{_QUOTE}{len(quotes) - 1}{_END}"

    def leaf(name: str | None, value: str) -> Column:
        names = [name] if name else default_fields
        if names is None:
            return P.any_of(_leaf(fields, f, value, quotes) for f in fields.text())
        return P.any_of(_leaf(fields, fields.find(_unescape(n)), value, quotes) for n in names)

    def leaves(part: str, name: str | None = None) -> str:
        def one(m: re.Match) -> str:
            if m["field"] is None and m["value"] in _OPERATORS:
                return m[0]
            return keep(leaf(m["field"] or name, m["value"]))

        pieces = re.split(rf"({_DONE}\d+{_END})", part)
        return "".join(p if p.startswith(_DONE) else _LEAF.sub(one, p) for p in pieces)

    def groups(part: str) -> str:
        """`field:(...)` up to the matching bracket becomes one predicate; the field holds in brackets inside."""
        while opened := _GROUP.search(part):
            depth, close = 1, None
            for m in _BRACKET.finditer(part, opened.end()):
                depth += {"(": 1, ")": -1}.get(m[0], 0)
                if depth == 0:
                    close = m
                    break
            if close is None:
                raise ValueError("a bracket is not closed in search string")
            part = part[: opened.start()] + keep(parse(part[opened.end() : close.start()], opened["field"])) + part[close.end() :]
        return part

    def parse(part: str, name: str | None = None) -> Column:
        part = leaves(groups(part), name)
        while True:
            reduced = re.sub(r"\(([^()]*)\)", lambda m: keep(_combine(m[1], done, default_operator)), part)
            if reduced == part:
                return _combine(part, done, default_operator)
            part = reduced

    return parse(re.sub(r'"((?:\\.|[^"\\])*)"', quote, text))


def _combine(flat: str, done: list[Column], default_operator: str) -> Column:
    """AND binds tighter than OR; NOT applies to the operand after it."""
    alternatives: list[list[Column]] = [[]]
    joined = negated = False
    for word in flat.split():
        if _OPERATORS.get(word) == "NOT":
            # `a NOT b` reads as `a AND NOT b`.
            joined, negated = True, not negated
        elif word in _OPERATORS:
            if not alternatives[-1] or negated:
                raise ValueError(f"misplaced {word} in search string")
            joined = True
            if _OPERATORS[word] == "OR":
                alternatives.append([])
        elif re.fullmatch(rf"{_DONE}\d+{_END}", word):
            predicate = done[int(word[1:-1])]
            if alternatives[-1] and not joined and default_operator.upper() == "OR":
                alternatives.append([])
            alternatives[-1].append(P.negate(predicate) if negated else predicate)
            joined = negated = False
        else:
            raise ValueError(f"unexpected {word!r} in search string")
    if joined or not all(alternatives):
        raise ValueError("incomplete search string")
    return P.any_of(P.all_of(part) for part in alternatives)


def _unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text)


def _leaf(fields: Fields, field, value: str, quotes: list[str]) -> Column:
    if value.startswith(_QUOTE):
        return P.match_phrase(field, quotes[int(value[1:-1])], now=fields.now)
    value = re.sub(rf"{_QUOTE}(\d+){_END}", lambda m: quotes[int(m[1])], value)
    ranged = _RANGE.fullmatch(value)
    if ranged:
        bounds = {}
        if ranged[2] != "*":
            bounds["gte" if ranged[1] == "[" else "gt"] = _unescape(ranged[2])
        if ranged[3] != "*":
            bounds["lte" if ranged[4] == "]" else "lt"] = _unescape(ranged[3])
        return P.range_of(field, bounds, fields.now) if bounds else P.exists(field)
    compared = re.fullmatch(r"([<>]=?)\s*(.+)", value)
    if compared:
        return P.compare(field, _COMPARE[compared[1]], _unescape(compared[2]), fields.now)
    if value == "*":
        return P.exists(field)
    if re.search(r"(?<!\\)[*?]", value):
        return P.wildcard(field, value)
    return P.match(field, _unescape(value), now=fields.now)
