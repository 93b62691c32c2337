"""Secrets in texts, and weak credential parts that only count together. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = "(password|passwd|secret|token|api_?key)"
BASE = ("assign", "access", "hex")
WEAK = ("user", "weak", "endpoint")
KINDS = (*BASE, *WEAK)
#: What a part is in a credential.
ROLES = {"assign": "secret", "hex": "secret", "weak": "secret", "access": "name", "user": "name", "endpoint": "place"}
ASSIGN = f"(?i:{KEYS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
NAME = "(?<![A-Za-z0-9_])(?i:{})[\"']?\\x20*[:=]\\x20*[\"']?[^\\s\"',;]{{{},}}"
USER = NAME.format("user|user_?name|login|account|client_id", 2)
LOOSE = NAME.format("pwd|pass|pass_?phrase|key|auth|credential|pin", 4)
PLACE = "(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,30}://[^\\s\"'<>]+"
SCOPE = 200


def _has(text: Column, *needed: str) -> Column:
    found = F.lit(False)
    for x in needed:
        found = found | text.contains(x)
    return found


def _matches(text: Column, kind: str, pattern: str, needed: Column, least_group: int | None = None) -> Column:
    """Array of (kind, i, gap, length, kept): match i has `gap` code points before it since the last match's end."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda x: F.length(x) >= least_group) if least_group else F.transform(found, lambda x: F.lit(True))
    parts = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("length")))
    parts = F.zip_with(parts, kept, lambda p, k: F.struct(p["gap"].alias("gap"), p["length"].alias("length"), k.alias("kept")))
    full = F.transform(parts, lambda p, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), p["gap"].alias("gap"), p["length"].alias("length"), p["kept"].alias("kept")))
    return F.when(needed, full).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,length:int,kept:boolean>>"))


def find_secrets(docs: DataFrame, text: str = "text", id: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    Base kinds are reported wherever they match. A user name, a loose key or an endpoint is reported
    only when a part that completes it lies within `scope` characters: names and places need a
    secret, loose secrets need a name or a place. The nearest part of each role before and after is
    all an interval join has to know, so it is a running maximum of ends and minimum of starts over
    a document's parts and makes no pairs.
    A null text counts as empty (no spans). Repeated rows get a result each, ties of a start go by
    kind, a null id stays, an empty table gives no rows, other columns are ignored.
    """
    t = F.coalesce(F.col("t"), F.lit(""))
    assigns = _has(t, ":", "=")
    parts = F.concat(
        _matches(t, "assign", ASSIGN, assigns, 6),
        _matches(t, "access", ACCESS, _has(t, "AKIA")),
        _matches(t, "hex", HEX, F.length(t) >= 24),
        _matches(t, "user", USER, assigns),
        _matches(t, "weak", LOOSE, assigns),
        _matches(t, "endpoint", PLACE, _has(t, "://")),
    )
    rows = (
        docs.select(docs[id].alias("id"), docs[text].alias("t"))
        .withColumn("row", F.monotonically_increasing_id())  # tells repeated rows apart; never a shuffle key, as it may change when a task runs again
        .select("id", F.xxhash64(t).alias("text_key"), "row", F.explode_outer(parts).alias("p"))
        .select("id", "text_key", "row", "p.*")
        .repartition("id", "text_key")
    )
    key = ["id", "text_key", "row"]
    ends = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy(*key, "kind").orderBy("i"))
    role = F.element_at(F.create_map(*[F.lit(x) for k in KINDS for x in (KINDS.index(k), ROLES[k])]), F.col("kind"))
    placed = rows.withColumn("end", ends).withColumn("start", F.col("end") - F.col("length")).withColumn("role", role)
    order = Window.partitionBy(*key).orderBy("start", "kind")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*key).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)

    def near(which: str) -> Column:
        its = (F.col("role") == which) & F.col("kept")
        return F.coalesce(F.col("start") - F.max(F.when(its, F.col("end"))).over(before) <= scope, F.lit(False)) | F.coalesce(F.min(F.when(its, F.col("start"))).over(after) - F.col("end") <= scope, F.lit(False))

    strong = F.col("kind") < len(BASE)
    linked = F.when(F.col("role") == "secret", near("name") | near("place")).otherwise(near("secret"))
    held = placed.withColumn("near", linked).withColumn("shown", F.col("kept") & (strong | F.col("near")))
    told = F.struct("start", "kind", "end")
    names = F.array(*map(F.lit, KINDS))
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    count = lambda kind: F.count_if((F.col("kind") == KINDS.index(kind)) & F.col("kept"))
    return held.groupBy(*key).agg(
        *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(F.collect_list(F.when(F.col("shown") & strong, told))), 256).alias("base_sha256"),
        joined(F.collect_list(F.when(F.col("shown"), told))).alias("spans"),
        F.count_if(F.col("shown") & ~strong).alias("n_linked"),
    ).select(F.col("id").alias(id), *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_linked")
