"""Queries on reading, writing and importing indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.operators.ordering import newest_bulk
from emberlog.operators.relations import fan_out
from emberlog.plans.adapters import INDEX_PREFIX, NOW, SQL_EVENTS_LOG, events_log, sql_case
from emberlog.plans.registry import query, table
from emberlog.session import folder, spread
from emberlog.sources import importer, indices, sinks
from emberlog.streaming import search as streams


@query("SELECT event_id, event_type, user_id FROM events")
def scan_index(spark, d):
    return indices.scan_index(spark, f"{d}/events.parquet").select("event_id", "event_type", "user_id")


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT _index, id, user_id FROM events_log WHERE regexp_matches(_index, '^app-logs-2024\\.01\\.1.*$')
""")
def scan_pattern(spark, d):
    log = events_log(spark, d)
    return log.where(indices.index_matches(F.col("_index"), "app-logs-2024.01.1*")).select("_index", "id", "user_id")


@query("""
SELECT 'logs-events' AS _index, event_id AS id, event_type AS kind, value, CAST(NULL AS DOUBLE) AS price FROM events
UNION ALL
SELECT 'logs-orders', o_orderkey, o_orderstatus, NULL, o_totalprice FROM orders
""")
def scan_pattern_union(spark, d):
    events = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), "value")
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("kind"), F.col("o_totalprice").alias("price")
    )
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"))
    found = indices.scan_pattern({"logs-orders": orders, "logs-events": events, "web-pages": pages, ".logs": pages}, "logs-*")
    return found.select("_index", "id", "kind", "value", "price")


@query("""
SELECT CASE event_type WHEN 'error' THEN 'logs-a' WHEN 'click' THEN 'logs-b' ELSE 'logs+[c] 1' END AS _index, event_id AS id,
       CASE WHEN event_type = 'click' THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS code,
       CASE WHEN event_type = 'error' THEN CAST(user_id AS DOUBLE) ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN user_id WHEN event_type <> 'click' THEN event_id END AS part_n,
       CASE WHEN event_type NOT IN ('error', 'click') THEN 'x' END AS part_s
FROM events WHERE event_type <> 'view'
""")
def scan_folders(spark, d):
    """Folders that disagree on types, inside structs too, in one table; a system index and another name stay out."""
    events, root = table(spark, d, "events"), folder(spark, "folders")
    kind, n = F.col("event_type"), F.col("user_id")

    def put(name, where, *columns):
        sinks.write_index(events.where(where).select(F.col("event_id").alias("id"), *columns), f"{root}/{name}")

    put("logs-a", kind == "error", n.alias("code"), n.cast("int").alias("value"), F.struct(n.cast("int").alias("n")).alias("part"))
    put("logs-b", kind == "click", F.concat(F.lit("u"), n).alias("code"), "value")
    put("logs+[c] 1", ~kind.isin("error", "click", "view"), n.cast("int").alias("CODE"), "value", F.struct(F.lit("x").alias("s"), F.col("event_id").alias("n")).alias("part"))
    put(".logs", kind == "error", n.alias("code"))
    put("web", kind == "view", F.array(n).alias("code"))
    found = indices.scan_folders(spark, root, "*logs*")
    return found.select("_index", "id", "code", "value", F.col("part.n").alias("part_n"), F.col("part.s").alias("part_s"))


@query(f"""
WITH {SQL_EVENTS_LOG}
SELECT _index, id FROM (SELECT CASE WHEN user_id % 10 = 0 THEN '.sys' ELSE _index END AS _index, id FROM events_log)
WHERE left(_index, 1) <> '.'
""")
def scan_skip_system(spark, d):
    name = F.when(F.col("user_id") % 10 == 0, ".sys").otherwise(F.col("_index"))
    log = events_log(spark, d).select(name.alias("_index"), "id")
    return log.where(indices.is_visible(F.col("_index")))


@query("""
SELECT event_id, event_type FROM events
WHERE event_type = 'view' OR CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
""")
def prune_by_index_date(spark, d):
    # Undated indices (here: views) are kept, and so is the day the range starts in.
    dated = table(spark, d, "events").withColumn(
        "index_date", F.when(F.col("event_type") != "view", F.to_date("ts"))
    )
    pruned = indices.prune_by_date(dated, "2024-01-10T12:00:00Z", "2024-01-20")
    return pruned.select("event_id", "event_type")


_LAYOUTS = {"error": "yyyy.MM.dd", "signup": "yyyy-MM-dd", "purchase": "yyyy.MM", "view": "yyyyMMdd"}
_SQL_LAYOUTS = {"error": "%Y.%m.%d", "signup": "%Y-%m-%d", "purchase": "%Y.%m", "view": "%Y%m%d"}


@query(f"""
WITH names AS (
  SELECT DISTINCT event_type, {sql_case('event_type', INDEX_PREFIX)} ||
    CASE event_type {' '.join(f"WHEN '{k}' THEN strftime(ts, '{v}')" for k, v in _SQL_LAYOUTS.items())} ELSE 'all' END
    AS _index FROM events),
dated AS (
  SELECT _index, CAST(CASE event_type
    WHEN 'error' THEN strptime(right(_index, 10), '%Y.%m.%d') WHEN 'signup' THEN strptime(right(_index, 10), '%Y-%m-%d')
    WHEN 'purchase' THEN strptime(right(_index, 7) || '.01', '%Y.%m.%d')
    WHEN 'view' THEN strptime(right(_index, 8), '%Y%m%d') END AS DATE) AS index_date FROM names)
SELECT _index, strftime(index_date, '%Y-%m-%d') AS index_date,
       coalesce(index_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20', TRUE) AS in_range
FROM dated
""")
def index_date(spark, d):
    kind, stamp = F.col("event_type"), F
    for name, layout in _LAYOUTS.items():
        stamp = stamp.when(kind == name, F.date_format("ts", layout))
    prefix = F
    for name, text in INDEX_PREFIX.items():
        prefix = prefix.when(kind == name, text)
    names = table(spark, d, "events").select(F.concat(prefix, stamp.otherwise("all")).alias("_index")).distinct()
    date = indices.index_date(F.col("_index"))
    return names.select(
        "_index",
        date.cast("string").alias("index_date"),
        indices.dated_in_range(date, "2024-01-10", "2024-01-20", NOW).alias("in_range"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
LIMIT 50000
""")
def scan_limit_large(spark, d):
    # The size of the export is the feature: one distributed scan, no paging. Larger ones go through `bulk`.
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, d, "lineitem").select(*keys, "l_shipdate")
    return lines.orderBy(F.col("l_shipdate").desc_nulls_last(), *keys).limit(50_000)


@query("""
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC NULLS LAST, event_id
LIMIT (SELECT count(*) * 2 // 3 FROM events)
""")
def scan_limit_bulk(spark, d):
    """Two thirds of all rows as one export, without a merge in one task."""
    events = spread(table(spark, d, "events").select("event_id", "ts", "event_type"))
    return newest_bulk(events, "ts", events.count() * 2 // 3, ["event_id"])


_ALL_SQL = f"WITH {SQL_EVENTS_LOG} SELECT _index, id, event_type, value FROM events_log"


def _told(documents):
    doc = F.col("doc")
    return documents.select(
        "_index",
        F.try_variant_get(doc, "$.id", "bigint").alias("id"),
        F.try_variant_get(doc, "$.event_type", "string").alias("event_type"),
        F.try_variant_get(doc, "$.value", "double").alias("value"),
    )


@query(_ALL_SQL)
def import_bundle(spark, d):
    """All documents of every index as bundle lines, written and read back."""
    log = events_log(spark, d).select("_index", "@timestamp", "id", "event_type", "value", F.lit("x").alias("uid"))
    path = folder(spark, "bundle")
    sinks.write_bundle(log, path, "@timestamp", 2_000_000_000, ["id"])
    return _told(importer.documents_of(spark, path, "2024-01-31"))


@query("SELECT 'arrays-2024-01-31' AS _index, event_id AS id, event_type, value FROM events")
def import_array(spark, d):
    """Documents in JSON arrays of about a thousand, written and imported by their file's name."""
    events = table(spark, d, "events").select(F.col("event_id").alias("id"), "event_type", "value")
    # Row numbers within a task, so no array can grow past a thousand whatever the ids are.
    batch = F.floor(F.monotonically_increasing_id() / 1000)
    batches = events.select(batch.alias("batch"), F.struct("id", "event_type", "value").alias("doc")).groupBy(
        "batch"
    ).agg(F.collect_list("doc").alias("docs"))
    path = folder(spark, "array")
    batches.select(F.to_json("docs").alias("value")).write.text(path)
    return _told(importer.documents_of(spark, path, "2024-01-31")).withColumn("_index", F.lit("arrays-2024-01-31"))


@query("SELECT event_id AS id, event_type, value FROM events")
def import_jsonl(spark, d):
    """What the JSON sink writes, imported."""
    path = folder(spark, "lines")
    sinks.write_json(table(spark, d, "events").select(F.col("event_id").alias("id"), "event_type", "value"), path)
    return _told(importer.documents_of(spark, path, "2024-01-31")).drop("_index")


@query(f"WITH {SQL_EVENTS_LOG} SELECT _index, id, CAST(id AS VARCHAR) AS code, event_type, value FROM events_log")
def sample_import_roundtrip(spark, d):
    """A sample of everything, imported and scanned as a table; the code stays a keyword."""
    log = events_log(spark, d).select("_index", "@timestamp", "id", F.col("id").cast("string").alias("code"), "event_type", "value")
    path, root = folder(spark, "sample"), folder(spark, "imported")
    sinks.write_sample(log, path, "@timestamp", 2_000_000_000, ["id"])
    importer.import_file(spark, path, root, "2024-01-31")
    return importer.scan_imported(spark, root, "*").select("_index", "id", "code", "event_type", "value")


@query("""
SELECT 'events' AS _index, event_id AS id, CAST(user_id AS VARCHAR) AS code, NULL AS level FROM events WHERE event_type = 'error'
UNION ALL SELECT 'kept', event_id, CAST(user_id AS VARCHAR), event_type FROM events WHERE event_type <> 'error'
""")
def import_force_mapping(spark, d):
    """A forced import replaces an index with its mapping; without force an index keeps its types and learns new fields.

    `code` was a number at first: in `events` it comes back as the keyword of the second import, in `kept`, where it
    stays a keyword though later values are numbers, as text.
    """
    events, n = table(spark, d, "events"), F.col("user_id")
    root = folder(spark, "imported")

    def load(rows, name, code, force, *more):
        path = folder(spark, "bundle")
        kept = rows.select(F.lit(name).alias("_index"), F.col("event_id").alias("id"), code.alias("code"), *more)
        sinks.write_sample(kept, path, "no time", 2_000_000_000, ["id"])
        importer.import_file(spark, path, root, "2024-01-31", force)

    load(events, "events", n, False)
    load(events.where("event_type <> 'error' AND event_id % 2 = 0"), "kept", n.cast("string"), False, F.col("event_type").alias("level"))
    load(events.where("event_type <> 'error' AND event_id % 2 = 1"), "kept", n, False, F.col("event_type").alias("level"))
    load(events.where("event_type = 'error'"), "events", n.cast("string"), True)
    return importer.scan_imported(spark, root, "*").select("_index", "id", "code", "level")


@query("SELECT e.event_id, r.r_name AS _index FROM events e, region r WHERE r.r_name <> 'ASIA'")
def import_fanout(spark, d):
    targets = table(spark, d, "region").where("r_name <> 'ASIA'").select("r_name")
    return fan_out(table(spark, d, "events").select("event_id"), targets)


@query("SELECT * FROM events")
def sink_append(spark, d):
    events, path = table(spark, d, "events"), folder(spark, "append")
    sinks.write_index(events.where("event_type <> 'error'"), path)
    sinks.write_index(events.where("event_type = 'error'"), path)
    return spark.read.parquet(path)


@query("SELECT * FROM events WHERE event_type = 'error'")
def sink_overwrite(spark, d):
    events, path = table(spark, d, "events"), folder(spark, "overwrite")
    sinks.write_index(events.where("event_type <> 'error'"), path)
    sinks.write_index(events.where("event_type = 'error'"), path, force=True)
    return spark.read.parquet(path)


@query("""
WITH {events_log}, totals AS (SELECT _index, count(*) AS total FROM events_log GROUP BY _index)
SELECT s._index, s.id, s.event_type, s.value, t.total FROM (
  SELECT * FROM events_log
  QUALIFY row_number() OVER (PARTITION BY _index ORDER BY "@timestamp" DESC NULLS LAST, id) <= 5) s
JOIN totals t USING (_index)
""".format(events_log=SQL_EVENTS_LOG))
def sink_sample(spark, d):
    log = events_log(spark, d).select("_index", "@timestamp", "id", "event_type", "value")
    path = folder(spark, "sample")
    sinks.write_sample(log, path, "@timestamp", 5, ["id"])
    documents = spark.read.schema("id bigint, event_type string, value double, _index string").json(f"{path}/documents")
    metadata = spark.read.schema("name string, count bigint").json(f"{path}/metadata")
    joined = documents.join(metadata, F.col("_index") == F.col("name"))
    return joined.select("_index", "id", "event_type", "value", F.col("count").alias("total"))


@query("SELECT event_id, ts, event_type, value, props FROM events")
def sink_json(spark, d):
    events, path = table(spark, d, "events").select("event_id", "ts", "event_type", "value", "props"), folder(spark, "json")
    sinks.write_json(events, path)
    return spark.read.schema(events.schema).options(**sinks.TEXT_TIMES).json(path)


@query("SELECT event_id, ts, event_type, value, props FROM events")
def sink_csv(spark, d):
    events, path = table(spark, d, "events").select("event_id", "ts", "event_type", "value", "props"), folder(spark, "csv")
    sinks.write_csv(events, path)
    read = spark.read.schema(events.schema).options(**sinks.TEXT_TIMES)
    return read.option("header", True).option("escape", '"').csv(path)


@query(r"""
SELECT page_id, replace(lower(regexp_replace(list_last(string_split(url, '/')), '\.[^.]*$', '')), '_', '-')
       || '-2024-01-31' AS _index
FROM pages
""")
def index_name_from_file(spark, d):
    return table(spark, d, "pages").select(
        "page_id", importer.index_name_from_file(F.col("url"), "2024-01-31").alias("_index")
    )


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error' AND value > 50")
def stream_search(spark, d):
    """A search on a stream of files, run until all files are read, then read back."""
    schema = table(spark, d, "events").schema
    stream = streams.read_index_stream(spark, d, schema, pathGlobFilter="events.parquet")
    found = streams.search_stream(stream, "event_type:error AND value:>50").select("event_id", "user_id", "value")
    out, checkpoint = folder(spark, "stream"), folder(spark, "stream-checkpoint")
    streams.write_stream(found, out, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(found.schema).parquet(out)
