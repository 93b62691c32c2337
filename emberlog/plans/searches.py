"""Queries on search strings, query clauses and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.functions.fields import Fields, Relation
from emberlog.logtable import LogTable
from emberlog.operators import filters
from emberlog.operators.dsl import compile_query
from emberlog.operators.relations import more_like_this, percolate, trace_rows
from emberlog.operators.search import search_predicate
from emberlog.plans.adapters import (
    NOW, SQL_EVENTS_LOG, SQL_EVENTS_MILLIS, SQL_SPANS, events_log, events_millis, spans, sql_joined, sql_tokens,
)
from emberlog.operators.similar import read_term_statistics, write_term_statistics
from emberlog.plans.registry import query, table
from emberlog.session import folder, spread


def _search(df, text, text_fields=()):
    return df.where(search_predicate(Fields.of(df, text_fields), text))


def _match(df, clause, text_fields=(), **context):
    return df.where(compile_query(Fields.of(df, text_fields, **context), clause).matches)


def _scored(df, clause, text_fields=()):
    hit = compile_query(Fields.of(df, text_fields), clause)
    return df.where(hit.matches).withColumn("_score", F.round(hit.score, 6))


# -------------------------------------------------------------- search strings


@query("SELECT event_id, user_id FROM events WHERE event_type = 'error'")
def search_term(spark, d):
    return _search(table(spark, d, "events"), "event_type:error").select("event_id", "user_id")


@query(f"SELECT doc_id FROM documents WHERE {sql_joined('text')} LIKE '% of the %'")
def search_phrase(spark, d):
    return _search(table(spark, d, "documents"), 'text:"of the"', ["text"]).select("doc_id")


@query("""
SELECT o_orderkey FROM orders
WHERE (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND NOT (o_orderpriority = '5-LOW' AND o_totalprice > 100000)
""")
def search_bool(spark, d):
    text = '(o_orderstatus:F OR o_orderpriority:"1-URGENT") AND NOT (o_orderpriority:5-LOW AND o_totalprice:>100000)'
    return _search(table(spark, d, "orders"), text).select("o_orderkey")


@query("""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('3-MEDIUM')
  AND (o_custkey = 7 OR (o_custkey > 8 AND NOT (o_custkey = 10 OR o_custkey = 11)))
""")
def search_group(spark, d):
    text = "o_orderstatus:(F OR P) AND NOT o_orderpriority:(3-MEDIUM) AND o_custkey:(7 OR (>8 AND NOT (10 OR 11)))"
    return _search(table(spark, d, "orders"), text).select("o_orderkey", "o_orderstatus")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity >= 45 AND l_discount < 0.05 AND l_extendedprice BETWEEN 20000 AND 60000 AND l_linenumber > 2
  AND l_shipdate >= TIMESTAMP '1997-01-01'
""")
def search_range(spark, d):
    text = (
        "l_quantity:>=45 AND l_discount:<0.05 AND l_extendedprice:[20000 TO 60000] AND l_linenumber:>2.5"
        " AND l_shipdate:[1997-01-01 TO *]"
    )
    return _search(table(spark, d, "lineitem"), text).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%e_ r%g' OR p_brand LIKE 'Brand#1_'")
def search_wildcard(spark, d):
    return _search(table(spark, d, "part"), r"p_name:*e?\ r*g OR p_brand:Brand#1?").select("p_partkey", "p_name")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey <= 500")
def search_nested_path(spark, d):
    order = F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_custkey").alias("key")).alias("customer"))
    nested = table(spark, d, "orders").select("o_orderkey", order.alias("order"))
    return _search(nested, "order.status:F AND order.customer.key:<=500").select("o_orderkey")


@query(f"WITH {SQL_EVENTS_LOG} SELECT id, http_status FROM events_log WHERE http_status = 200 OR http_status >= 500")
def search_escaped_name(spark, d):
    log = events_log(spark, d).select("id", "http_status", F.struct(F.col("http_status").alias("http@status_code")).alias("tag"))
    text = r"tag.http\@status_code:200 OR tag.http\@status_code:>=500"
    return _search(log, text).select("id", "http_status")


@query("SELECT n_nationkey, n_name FROM nation")
def search_all(spark, d):
    return _search(table(spark, d, "nation"), "*").select("n_nationkey", "n_name")


@query(f"""
SELECT doc_id FROM documents
WHERE list_contains({sql_tokens('text')}, 'license') OR {sql_joined('text')} LIKE '% of the %'
""")
def search_bare(spark, d):
    return _search(table(spark, d, "documents"), 'License "of the"', ["text"]).select("doc_id")


# --------------------------------------------------------------- text clauses


@query(f"SELECT doc_id FROM documents WHERE list_has_any({sql_tokens('text')}, ['license', 'copyright'])")
def dsl_match(spark, d):
    return _match(table(spark, d, "documents"), {"match": {"text": "License, copyright!"}}, ["text"]).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE list_has_all({sql_tokens('text')}, ['license', 'the'])")
def dsl_match_and(spark, d):
    clause = {"match": {"text": {"query": "the license", "operator": "and"}}}
    return _match(table(spark, d, "documents"), clause, ["text"]).select("doc_id")


@query("SELECT r_regionkey, r_name FROM region")
def dsl_match_all(spark, d):
    return _match(table(spark, d, "region"), {"match_all": {}}).select("r_regionkey", "r_name")


@query(f"SELECT doc_id FROM documents WHERE {sql_joined('text')} LIKE '% of the %'")
def dsl_match_phrase(spark, d):
    return _match(table(spark, d, "documents"), {"match_phrase": {"text": "Of the"}}, ["text"]).select("doc_id")


@query(f"""
WITH docs AS (SELECT doc_id, {sql_tokens('text')} AS t FROM documents),
places AS (SELECT doc_id, generate_subscripts(t, 1) AS i, unnest(t) AS w FROM docs),
pairs AS (SELECT a.doc_id, abs((b.i - 1) - a.i) AS moved FROM places a JOIN places b ON a.doc_id = b.doc_id AND a.w = 'of' AND b.w = 'the' AND b.i BETWEEN a.i - 9 AND a.i + 9)
SELECT doc_id, moves FROM (VALUES (0), (1), (3)) s(moves), docs WHERE EXISTS (SELECT 1 FROM pairs p WHERE p.doc_id = docs.doc_id AND p.moved <= moves)
""")
def dsl_match_phrase_slop(spark, d):
    documents = spread(table(spark, d, "documents").select("doc_id", "text"))
    found = [_match(documents, {"match_phrase": {"text": {"query": "of the", "slop": n}}}, ["text"]).select("doc_id", F.lit(n).alias("moves")) for n in (0, 1, 3)]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(f"""
SELECT p_partkey, CAST(held AS DOUBLE) AS _score FROM (
  SELECT p_partkey, CAST(list_contains(a || b, 'red') AS INT) + CAST(list_contains(a || b, 'economy') AS INT) + CAST(list_contains(a || b, 'ring') AS INT) AS held
  FROM (SELECT p_partkey, {sql_tokens('p_name')} AS a, {sql_tokens('p_type')} AS b FROM part)) WHERE held >= 2
""")
def dsl_cross_fields(spark, d):
    """Words of which each may stand in another field, two of three."""
    clause = {"multi_match": {"query": "red economy ring", "fields": ["p_name", "p_type"], "type": "cross_fields", "minimum_should_match": 2}}
    return _scored(table(spark, d, "part"), clause, ["p_name", "p_type"]).select("p_partkey", "_score")


@query(f"SELECT doc_id FROM documents WHERE {sql_joined('text')} LIKE '% of th%'")
def dsl_match_phrase_prefix(spark, d):
    return _match(table(spark, d, "documents"), {"match_phrase_prefix": {"text": "of th"}}, ["text"]).select("doc_id")


@query(f"""
SELECT p_partkey FROM part
WHERE list_has_any({sql_tokens('p_name')}, ['red', 'economy']) OR list_has_any({sql_tokens('p_type')}, ['red', 'economy'])
""")
def dsl_multi_match(spark, d):
    clause = {"multi_match": {"query": "red ECONOMY", "fields": ["p_name^2", "p_type"]}}
    return _match(table(spark, d, "part"), clause, ["p_name", "p_type"]).select("p_partkey")


@query("SELECT event_id FROM events WHERE (event_type = 'error' OR value > 90) AND user_id < 20")
def dsl_query_string(spark, d):
    clause = {"query_string": {"query": "(event_type:error OR value:>90) AND user_id:<20"}}
    return _match(table(spark, d, "events"), clause).select("event_id")


@query(f"""
SELECT doc_id FROM documents
WHERE ({sql_joined('text')} LIKE '% of the %' AND NOT list_contains({sql_tokens('text')}, 'license'))
   OR {sql_joined('text')} LIKE '% copyr%'
""")
def dsl_simple_query_string(spark, d):
    clause = {"simple_query_string": {"query": '"of the" + -license | copyr*', "fields": ["text"]}}
    return _match(table(spark, d, "documents"), clause, ["text"]).select("doc_id")


# -------------------------------------------------------------- exact clauses


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'")
def dsl_term(spark, d):
    return _match(table(spark, d, "orders"), {"term": {"o_orderpriority": {"value": "2-HIGH"}}}).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def dsl_terms(spark, d):
    return _match(table(spark, d, "orders"), {"terms": {"o_orderpriority": ["1-URGENT", "2-HIGH"]}}).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def dsl_terms_table(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 9000").select("c_custkey")
    return _match(table(spark, d, "orders"), {"terms": {"o_custkey": rich}}).select("o_orderkey")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' AND l_quantity > 40
""")
def dsl_range(spark, d):
    clause = {"bool": {"filter": [
        {"range": {"l_shipdate": {"gte": "1997-01-01||-1y", "lt": "1997-01-01"}}},
        {"range": {"l_quantity": {"gt": "40"}}},
    ]}}
    return _match(table(spark, d, "lineitem"), clause).select("l_orderkey", "l_linenumber")


@query("SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL")
def dsl_exists(spark, d):
    labelled = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return _match(labelled, {"exists": {"field": "quality"}}).select("doc_id")


@query("SELECT p_partkey FROM part WHERE starts_with(p_name, 'small')")
def dsl_prefix(spark, d):
    return _match(table(spark, d, "part"), {"prefix": {"p_name": "small"}}).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_name ILIKE '%D_R%' OR p_name LIKE 's%t'")
def dsl_wildcard(spark, d):
    clause = {"bool": {"should": [
        {"wildcard": {"p_name": {"value": "*D?R*", "case_insensitive": True}}},
        {"wildcard": {"p_name": "s*t"}},
    ]}}
    return _match(table(spark, d, "part"), clause).select("p_partkey")


@query("SELECT page_id FROM pages WHERE regexp_full_match(url, 'https?://[a-z.]+/(en|fr)/\\d+\\?.*utm_source=.*')")
def dsl_regexp(spark, d):
    clause = {"regexp": {"url": r"https?://[a-z.]+/(en|fr)/\d+\?.*utm_source=.*"}}
    return _match(table(spark, d, "pages"), clause).select("page_id")


@query("SELECT event_id FROM events WHERE levenshtein(event_type, 'eror') <= 1")
def dsl_fuzzy(spark, d):
    return _match(table(spark, d, "events"), {"fuzzy": {"event_type": "eror"}}).select("event_id")


# ----------------------------------------------------------- compound clauses


@query("""
SELECT o_orderkey FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 200000 AND o_orderpriority <> '5-LOW'
""")
def dsl_bool(spark, d):
    clause = {"bool": {
        "must": {"match": {"o_orderstatus": "F"}},
        "filter": [{"range": {"o_totalprice": {"gte": 200000}}}],
        "must_not": [{"term": {"o_orderpriority": "5-LOW"}}],
    }}
    return _match(table(spark, d, "orders"), clause).select("o_orderkey")


@query("""
SELECT o_orderkey FROM orders
WHERE CAST(o_orderstatus = 'F' AS INT) + CAST(o_totalprice > 300000 AS INT) + CAST(o_orderpriority = '1-URGENT' AS INT) >= 2
""")
def dsl_bool_should(spark, d):
    clause = {"bool": {
        "should": [
            {"term": {"o_orderstatus": "F"}},
            {"range": {"o_totalprice": {"gt": 300000}}},
            {"term": {"o_orderpriority": "1-URGENT"}},
        ],
        "minimum_should_match": 2,
    }}
    return _match(table(spark, d, "orders"), clause).select("o_orderkey")


@query("SELECT o_orderkey, CAST(1.2 AS DOUBLE) AS _score FROM orders WHERE o_orderstatus = 'F'")
def dsl_constant_score(spark, d):
    clause = {"constant_score": {"filter": {"term": {"o_orderstatus": "F"}}, "boost": 1.2}}
    return _scored(table(spark, d, "orders"), clause).select("o_orderkey", "_score")


@query(f"""
SELECT p_partkey, round(greatest(a, b) + 0.3 * least(a, b), 6) AS _score FROM (
  SELECT p_partkey, CASE WHEN p_brand = 'Brand#2' THEN 1.5 ELSE 0.0 END::DOUBLE AS a,
    2.0::DOUBLE * (CAST(list_contains({sql_tokens('p_name')}, 'red') AS INT)
       + CAST(list_contains({sql_tokens('p_name')}, 'ring') AS INT)) AS b FROM part)
WHERE a > 0 OR b > 0
""")
def dsl_dis_max(spark, d):
    clause = {"dis_max": {"tie_breaker": 0.3, "queries": [
        {"term": {"p_brand": {"value": "Brand#2", "boost": 1.5}}},
        {"match": {"p_name": {"query": "red ring", "boost": 2}}},
    ]}}
    return _scored(table(spark, d, "part"), clause, ["p_name"]).select("p_partkey", "_score")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       round(5.0::DOUBLE * CASE WHEN l_discount > 0.05 THEN 3.0 * sqrt(l_quantity * 1.2) ELSE sqrt(l_quantity * 1.2) END, 6) AS _score
FROM lineitem WHERE l_returnflag = 'R'
""")
def dsl_function_score(spark, d):
    clause = {"function_score": {
        "query": {"term": {"l_returnflag": "R"}},
        "boost": "5",
        "functions": [
            {"field_value_factor": {"field": "l_quantity", "factor": 1.2, "modifier": "sqrt"}},
            {"filter": {"range": {"l_discount": {"gt": 0.05}}}, "weight": 3},
        ],
    }}
    return _scored(table(spark, d, "lineitem"), clause).select("l_orderkey", "l_linenumber", "l_partkey", "_score")


@query("""
SELECT event_id, TRUE AS in_range, TRUE AS repeatable, TRUE AS seeds_differ FROM events WHERE event_type = 'error'
""")
def dsl_random_score(spark, d):
    """Seeded random scores have no SQL twin; what is known of them has: the rows, the range, the same again for a seed, another for another."""
    events = table(spark, d, "events")
    hits = [
        compile_query(Fields.of(events), {"function_score": {
            "query": {"term": {"event_type": "error"}}, "random_score": {"seed": seed, "field": "event_id"},
        }})
        for seed in (7, 7, 8)
    ]
    scored = events.where(hits[0].matches).select("event_id", *[hit.score.alias(f"s{k}") for k, hit in enumerate(hits)])
    in_range = (F.col("s0") >= 0) & (F.col("s0") < 1)
    return scored.select("event_id", in_range.alias("in_range"), (F.col("s0") == F.col("s1")).alias("repeatable"), (F.col("s0") != F.col("s2")).alias("seeds_differ"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 0.2 ELSE 1.0 END::DOUBLE AS _score FROM events WHERE value >= 50
""")
def dsl_boosting(spark, d):
    clause = {"boosting": {
        "positive": {"range": {"value": {"gte": 50}}},
        "negative": {"term": {"event_type": "view"}},
        "negative_boost": 0.2,
    }}
    return _scored(table(spark, d, "events"), clause).select("event_id", "_score")


# ------------------------------------------------------ arrays and relations


@query(f"""
SELECT DISTINCT doc_id FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no
  FROM documents)
WHERE no > 2 AND list_contains({sql_tokens('line')}, 'license')
""")
def dsl_nested(spark, d):
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct((i + 1).alias("no"), line.alias("line")))
    documents = table(spark, d, "documents").select("doc_id", lines.alias("lines"))
    clause = {"nested": {"path": "lines", "query": {"bool": {"must": [
        {"range": {"lines.no": {"gt": 2}}}, {"match": {"lines.line": "license"}},
    ]}}}}
    return _match(documents, clause, ["lines.line"]).select("doc_id")


@query("""
SELECT o_orderkey FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48 AND l_returnflag = 'R')
""")
def dsl_has_child(spark, d):
    relation = Relation(table(spark, d, "lineitem"), here="o_orderkey", there="l_orderkey")
    clause = {"has_child": {"type": "lineitem", "query": {"bool": {"must": [
        {"range": {"l_quantity": {"gt": 48}}}, {"term": {"l_returnflag": "R"}},
    ]}}}}
    return _match(table(spark, d, "orders"), clause, relations={"lineitem": relation}).select("o_orderkey")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority = '1-URGENT')
""")
def dsl_has_parent(spark, d):
    relation = Relation(table(spark, d, "orders"), here="l_orderkey", there="o_orderkey")
    clause = {"has_parent": {"parent_type": "order", "query": {"term": {"o_orderpriority": "1-URGENT"}}}}
    lines = table(spark, d, "lineitem")
    return _match(lines, clause, relations={"order": relation}).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
SELECT event_id, 'errors' AS query_id FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, 'large' FROM events WHERE value > 95
UNION ALL SELECT event_id, 'quiet' FROM events WHERE NOT (event_type IN ('error', 'click')) AND value <= 5
UNION ALL SELECT event_id, 'user' FROM events WHERE user_id = 7
UNION ALL SELECT event_id, 'week' FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND ts <= TIMESTAMP '2024-01-31'
""")
def dsl_percolate(spark, d):
    events = table(spark, d, "events")
    stored = {
        "errors": {"term": {"event_type": "error"}},
        "large": {"range": {"value": {"gt": 95}}},
        "quiet": {"bool": {"must_not": {"terms": {"event_type": ["error", "click"]}},
                           "filter": {"range": {"value": {"lte": 5}}}}},
        "user": {"query_string": {"query": "user_id:7"}},
        "week": {"range": {"ts": {"gte": "now-7d", "lte": "now"}}},
    }
    return percolate(events, stored, Fields.of(events, now=NOW)).select("event_id", "query_id")


@query("""
WITH stored AS (SELECT o_orderkey % 5000 AS n, min(o_totalprice) AS lo, min(o_custkey) AS c FROM orders GROUP BY 1),
events2 AS (SELECT event_id, user_id, event_type, value * 5000 AS price FROM events)
SELECT e.event_id, s.n AS query_id FROM events2 e JOIN stored s ON
  CASE s.n % 3 WHEN 0 THEN e.price >= s.lo AND e.price < s.lo + 500
    WHEN 1 THEN e.user_id = s.c % 100 AND e.event_type <> 'view' AND e.price > s.lo
    ELSE (e.event_type = 'error' OR e.user_id = 7) AND e.price BETWEEN s.lo AND s.lo + 250 END
""")
def dsl_percolate_table(spark, d):
    """Thousands of stored queries from a table, as JSON text, over all events."""
    n, low, least = F.col("n"), F.col("lo"), F.col("c") % 100
    said = F.when(n % 3 == 0, F.format_string('{"range": {"price": {"gte": %s, "lt": %s}}}', low.cast("string"), (low + 500).cast("string"))).when(
        n % 3 == 1,
        F.format_string(
            '{"bool": {"must": [{"term": {"user_id": %s}}, {"range": {"price": {"gt": %s}}}], "must_not": {"match": {"event_type": "view"}}}}',
            least.cast("string"), low.cast("string"),
        ),
    ).otherwise(F.format_string(
        '{"bool": {"should": [{"term": {"event_type": "error"}}, {"term": {"user_id": 7}}], "minimum_should_match": 1, "filter": {"range": {"price": {"gte": %s, "lte": %s}}}}}',
        low.cast("string"), (low + 250).cast("string"),
    ))
    orders = table(spark, d, "orders").groupBy((F.col("o_orderkey") % 5000).alias("n")).agg(F.min("o_totalprice").alias("lo"), F.min("o_custkey").alias("c"))
    events = spread(table(spark, d, "events").select("event_id", "user_id", "event_type", "value")).withColumn("price", F.col("value") * 5000).drop("value")
    return percolate(events, orders.select(n.cast("string").alias("name"), said.alias("body"))).select("event_id", F.col("query_id").cast("bigint").alias("query_id"))


@query(f"""
WITH docs AS (SELECT doc_id, {sql_tokens('text')} AS tokens FROM documents),
seed AS (SELECT term, count(*) AS freq FROM (SELECT unnest(tokens) AS term FROM docs WHERE doc_id IN (1, 3))
         GROUP BY term HAVING count(*) >= 2),
df AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct(tokens)) AS term FROM docs)
       WHERE term IN (SELECT term FROM seed) GROUP BY term HAVING count(*) >= 5),
top AS (SELECT term FROM seed JOIN df USING (term)
        ORDER BY round(freq * ln((SELECT count(*) FROM docs)::DOUBLE / n), 9) DESC, term LIMIT 25)
SELECT doc_id FROM (
  SELECT doc_id, len(list_intersect(tokens, (SELECT list(term) FROM top))) AS shared FROM docs WHERE doc_id NOT IN (1, 3))
WHERE shared > 0 AND shared >= floor((SELECT count(*) FROM top) * 0.3)
""")
def dsl_more_like_this(spark, d):
    return more_like_this(spread(table(spark, d, "documents").select("doc_id", "text")), "text", [1, 3], "doc_id").select("doc_id")


@query(f"""
WITH words AS (
  SELECT 'p_name' AS field, p_partkey, unnest(list_distinct({sql_tokens('p_name')})) AS term FROM part
  UNION ALL SELECT 'p_type', p_partkey, unnest(list_distinct({sql_tokens('p_type')})) FROM part),
seed AS (
  SELECT field, term, count(*) AS freq FROM (
    SELECT 'p_name' AS field, unnest({sql_tokens('p_name')}) AS term FROM part WHERE p_partkey IN (3, 5)
    UNION ALL SELECT 'p_type', unnest({sql_tokens('p_type')}) FROM part WHERE p_partkey IN (3, 5)
    UNION ALL SELECT f, unnest(['red', 'ring', 'red']) FROM (VALUES ('p_name'), ('p_type')) t(f)) GROUP BY ALL),
df AS (SELECT field, term, count(*) AS n FROM words GROUP BY ALL HAVING count(*) >= 2),
top AS (SELECT field, term FROM seed JOIN df USING (field, term)
        ORDER BY round(freq * ln((SELECT count(*) FROM part)::DOUBLE / n), 9) DESC, term, field LIMIT 5),
hits AS (SELECT p_partkey, count(*) AS shared FROM words JOIN top USING (field, term) GROUP BY 1)
SELECT p_partkey, 2.0::DOUBLE * shared AS _score FROM part JOIN hits USING (p_partkey)
WHERE p_partkey NOT IN (3, 5) AND shared >= 2 AND p_brand <> 'Brand#1'
""")
def dsl_more_like_this_stored(spark, d):
    """Two fields, rows and a text, inside a bool, with word counts that were kept in two steps."""
    parts = table(spark, d, "part")
    path = folder(spark, "terms")
    write_term_statistics(parts.where("p_partkey % 3 > 0"), ["p_name", "p_type"], path)
    write_term_statistics(parts.where("p_partkey % 3 = 0"), ["p_name", "p_type"], path, append=True)
    clause = {"more_like_this": {
        "fields": ["p_name", "p_type"], "like": [{"_id": 3}, {"_id": 5}, "Red ring, red"], "min_term_freq": 1, "min_doc_freq": 2,
        "max_query_terms": 5, "minimum_should_match": 2, "boost": 2,
    }}
    body = {"query": {"bool": {"must": clause, "must_not": {"term": {"p_brand": "Brand#1"}}}}}
    stored = LogTable(parts, "ts", ("p_name", "p_type"), ("p_partkey",), statistics=read_term_statistics(spark, path))
    return stored.search(body, with_score=True).df.select("p_partkey", "_score")


@query(f"""
WITH {SQL_EVENTS_LOG}, {SQL_SPANS}
SELECT 'logs' AS _source, '7' AS "traceID", CAST(id AS VARCHAR) AS "spanID", "props@json" AS message
FROM events_log WHERE user_id = 7
UNION ALL SELECT 'traces', "traceID", "spanID", message FROM spans WHERE "traceID" = '7'
""")
def trace_investigation(spark, d):
    logs = events_log(spark, d).select(
        F.col("user_id").cast("string").alias("traceID"), F.col("id").cast("string").alias("spanID"),
        F.col("`props@json`").alias("message"), F.col("`@timestamp`"),
    )
    rows = trace_rows({"logs": logs, "traces": spans(spark, d)}, "7")
    return rows.orderBy(F.col("`@timestamp`").asc_nulls_last(), "spanID").select("_source", "traceID", "spanID", "message")


# -------------------------------------------------------------------- filters


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-12 06:30:00'")
def time_range(spark, d):
    events = table(spark, d, "events")
    return events.where(filters.time_range(Fields.of(events), "ts", "2024-01-10", "2024-01-12T06:30:00Z")).select("event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND ts <= TIMESTAMP '2024-01-30 18:00:00'")
def time_range_datemath(spark, d):
    events = table(spark, d, "events")
    inside = filters.time_range(Fields.of(events, now=NOW), "ts", "now-7d/d", "now-6h")
    return events.where(inside).select("event_id")


@query(f"""
WITH {SQL_EVENTS_MILLIS}
SELECT id, "startTimeMillis" FROM events_millis
WHERE "startTimeMillis" >= epoch_ms(TIMESTAMP '2024-01-05') AND "startTimeMillis" <= epoch_ms(TIMESTAMP '2024-01-06 12:00:00')
""")
def time_range_millis(spark, d):
    events = events_millis(spark, d)
    inside = filters.time_range(Fields.of(events), "startTimeMillis", "2024-01-05T00:00:00Z", "2024-01-06 12:00:00")
    return events.where(inside).select("id", "startTimeMillis")


@query(f"""
WITH {SQL_EVENTS_LOG} SELECT id FROM events_log WHERE "kubernetes.namespace" = 'ns-1' AND service = 'svc-3'
""")
def entity_filters(spark, d):
    log = LogTable(events_log(spark, d))
    return log.where_entity(namespace="ns-1", service="svc-3", pod="no such field").df.select("id")


@query(f"WITH {SQL_EVENTS_LOG} SELECT id FROM events_log WHERE service = 'svc-5'")
def entity_filter_single(spark, d):
    log = LogTable(events_log(spark, d), entities={"service": ["service"]})
    return log.where_entity(service="svc-5").df.select("id")


@query("""
SELECT c_custkey FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
WHERE c_name LIKE '%00042%' OR s_name LIKE '%00042%'
""")
def entity_filter_multi(spark, d):
    joined = table(spark, d, "customer").join(
        table(spark, d, "supplier"), F.col("c_custkey") == F.col("s_suppkey"), "left"
    )
    named = LogTable(joined, time_field="ts", entities={"service": ["c_name", "s_name"]})
    return named.where_entity(service="*00042*").df.select("c_custkey")


@query("""
SELECT event_id FROM events
WHERE (event_type = 'error' OR value > 90) AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AND user_id = 7
""")
def query_time_filters(spark, d):
    # The time range and filters are joined outside the query, so `should` stays required.
    body = {"query": {"bool": {"should": [{"term": {"event_type": "error"}}, {"range": {"value": {"gt": 90}}}]}}}
    events = LogTable(table(spark, d, "events"), "ts", entities={"service": ["user_id"]})
    return events.search(body).between("2024-01-10", "2024-01-20").where_entity(service="7").df.select("event_id")


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT id FROM events_log WHERE (level = 'ERROR' OR level = 'WARN') AND "kubernetes.namespace" = 'ns-2'
""")
def search_plus_filters(spark, d):
    return LogTable(events_log(spark, d)).search("level:ERROR OR level:WARN").where_entity(namespace="ns-2").df.select("id")
