"""Random query bodies against a row-by-row evaluation in plain Python."""

import random
import re
from fnmatch import fnmatchcase

from emberlog.functions.fields import Fields
from emberlog.operators.relations import percolate

WORDS = ["disk", "full", "of", "the", "order", "éa", "x_1", "Full"]
LEVELS = ["ERROR", "WARN", "INFO", "", None]


def random_rows(rng, count):
    rows = []
    for i in range(count):
        message = None if rng.random() < 0.15 else " - ".join(rng.choices(WORDS, k=rng.randint(0, 6)))
        duration = None if rng.random() < 0.15 else rng.randint(0, 12)
        tags = None if rng.random() < 0.15 else rng.choices(["a", "b", "c"], k=rng.randint(0, 3))
        rows.append((i, rng.choice(LEVELS), message, duration, tags))
    return rows


def random_query(rng, depth=3):
    if depth and rng.random() < 0.6:
        part = lambda: [random_query(rng, depth - 1) for _ in range(rng.randint(1, 3))]
        body = {name: part() for name in ("must", "filter", "must_not", "should") if rng.random() < 0.45}
        if "should" in body and rng.random() < 0.5:
            body["minimum_should_match"] = rng.randint(0, 3)
        return {"bool": body}
    word, level = rng.choice(WORDS), rng.choice(["ERROR", "WARN", "INFO", "NONE"])
    bounds = {op: rng.choice([rng.randint(0, 12), rng.randint(0, 11) + 0.5]) for op in rng.sample(["gt", "gte", "lt", "lte"], 2)}
    return rng.choice([
        {"term": {"level": level}},
        {"terms": {"level": rng.sample(["ERROR", "WARN", "x"], 2)}},
        {"term": {"tags": rng.choice("abz")}},
        {"term": {"duration": rng.choice([3, "4", "x", 2.5])}},
        {"range": {"duration": bounds}},
        {"exists": {"field": rng.choice(["level", "message", "duration", "tags", "absent"])}},
        {"prefix": {"level": level[:2]}},
        {"wildcard": {"level": rng.choice(["*R*", "?NFO", "W*N", ""])}},
        {"match": {"message": {"query": " ".join(rng.choices(WORDS, k=2)), "operator": rng.choice(["or", "and"])}}},
        {"match_phrase": {"message": " ".join(rng.choices(WORDS, k=2))}},
        {"match_phrase_prefix": {"message": f"{word} {rng.choice(['f', 'o', 'th'])}"}},
        {"match_all": {}},
    ])


def tokens(text):
    return re.findall(r"\w+", text.lower())


def run_of(words, wanted, last_is_prefix=False):
    for start in range(len(words) - len(wanted) + 1):
        part = words[start:start + len(wanted)]
        if part[:-1] == wanted[:-1] and (part[-1].startswith(wanted[-1]) if last_is_prefix else part[-1] == wanted[-1]):
            return True
    return False


def holds(row, query):
    ((name, body),) = query.items()
    if name == "match_all":
        return True
    if name == "bool":
        should = [holds(row, q) for q in body.get("should", [])]
        default = 1 if should and not body.get("must") and not body.get("filter") else 0
        return (
            all(holds(row, q) for q in body.get("must", []) + body.get("filter", []))
            and not any(holds(row, q) for q in body.get("must_not", []))
            and sum(should) >= body.get("minimum_should_match", default)
        )
    if name == "exists":
        value = row.get(body["field"])
        return bool(value) if isinstance(value, list) else value is not None
    ((field, spec),) = body.items()
    value = row.get(field)
    if value is None:
        return False
    if name == "term":
        if field == "duration":
            return str(value) == str(spec)
        return spec in value if isinstance(value, list) else value == spec
    if name == "terms":
        return value in spec
    if name == "range":
        compare = {"gt": value.__gt__, "gte": value.__ge__, "lt": value.__lt__, "lte": value.__le__}
        exact = {"gt": lambda b: value > b, "gte": lambda b: value >= b, "lt": lambda b: value < b, "lte": lambda b: value <= b}
        assert set(spec) <= set(compare)
        return all(exact[op](bound) for op, bound in spec.items())
    if name == "prefix":
        return value.startswith(spec)
    if name == "wildcard":
        return fnmatchcase(value, spec)
    if name == "match":
        wanted = set(tokens(spec["query"]))
        found = wanted & set(tokens(value))
        return found == wanted if spec["operator"] == "and" else bool(found)
    return run_of(tokens(value), tokens(spec), name == "match_phrase_prefix")


def test_random_bodies(spark):
    rng = random.Random(11)
    rows = random_rows(rng, 80)
    df = spark.createDataFrame(rows, "id int, level string, message string, duration int, tags array<string>").repartition(3)
    queries = {f"q{i}": random_query(rng) for i in range(250)}
    got = percolate(df, queries, Fields.of(df, ["message"])).select("id", "query_id")
    found = {(r.id, r.query_id) for r in got.collect()}
    names = ("id", "level", "message", "duration", "tags")
    expected = {
        (row[0], name) for row in rows for name, query in queries.items() if holds(dict(zip(names, row)), query)
    }
    wrong = found ^ expected
    assert not wrong, [(pair, queries[pair[1]], pair in found) for pair in sorted(wrong)[:3]]
