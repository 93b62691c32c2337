"""Repeated passages: runs of lines cut at content-defined places, compared over all documents. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import staged

LONG_LINE = 50
EVERY = 2
SALTS = 16
#: Words from which a run of lines is a passage, whatever its line breaks.
PASSAGE = 50
#: The most frequent repeated runs, which are broadcast; any other has less than this share of all rows.
HOT = 1000
WORD = r"[^\x20\x09-\x0D]+"


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def with_chunks(rows: DataFrame, every: int, long_line: int) -> DataFrame:
    """Adds `lines` and `chunks`, an array of (no, start, size, long).

    A chunk starts before a line where the rolling hash of it and the line above is a multiple of
    `every`, so lines put in or taken out elsewhere don't move it. A line of `long_line` words or
    more is a chunk of its own.
    """
    marked = F.transform("lines", lambda x: F.struct(line_hash(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1 >= long_line).alias("long")))
    rolling = lambda above, own: (31 * above["h"] + own["h"]) % every == 0
    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: (i == 0) | F.get("marks", i)["long"] | F.get("marks", i - 1)["long"] | rolling(F.get("marks", i - 1), F.get("marks", i)))
    size = lambda s, k: F.coalesce(F.get("starts", k + 1), F.size("lines")) - s
    return (
        rows.withColumn("lines", F.split("t", "\n", -1)).withColumn("marks", marked).withColumn("starts", starts)
        .withColumn("chunks", F.transform("starts", lambda s, k: F.struct(k.alias("no"), s.alias("start"), size(s, k).alias("size"), F.get("marks", s)["long"].alias("long"))))
        .drop("marks", "starts")
    )


def _chunk_rows(docs: DataFrame, every: int, long_line: int) -> DataFrame:
    """A row per chunk that may go: several lines, or a long one."""
    cut = with_chunks(docs, every, long_line)
    which = F.filter("chunks", lambda c: (c["size"] > 1) | c["long"])
    return (
        cut.select("id", "text_key", "lines", F.explode(which).alias("c"))
        .select("id", "text_key", "c.no", "c.start", "c.size", F.array_join(F.slice("lines", F.col("c.start") + 1, F.col("c.size")), "\n").alias("chunk"))
        .where(F.trim(F.translate("chunk", "\n\r\t", "   ")) != "")
        .withColumn("hash", F.xxhash64("chunk"))
    )


def _runs(docs: DataFrame, passage: int) -> DataFrame:
    """(id, text_key, start, size, a, b): from and up to each line with words the shortest run of lines of `passage` words, with its hashes.

    These cover each run of that many words or more, whatever stands around it.
    """
    told = docs.withColumn("lines", F.split("t", "\n", -1))
    told = told.withColumn("of_word", F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i, F.regexp_count(x, F.lit(WORD)))))).withColumn("total", F.size("of_word"))
    told = told.where(F.col("total") >= passage).select("id", "text_key", "of_word", "total", F.transform("lines", lambda x: F.xxhash64(x)).alias("a"), F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("b"))
    line = lambda at: F.get("of_word", at)
    run = lambda first, last: F.shiftleft(line(first).cast("long"), 32) + line(last)
    begins = F.filter(F.sequence(F.lit(0), F.col("total") - passage), lambda at: (at == 0) | (line(at) != line(at - 1)))
    ends = F.filter(F.sequence(F.lit(passage - 1), F.col("total") - 1), lambda at: (at == F.col("total") - 1) | (line(at) != line(at + 1)))
    both = F.array_union(F.transform(begins, lambda at: run(at, at + (passage - 1))), F.transform(ends, lambda at: run(at - (passage - 1), at)))
    start = lambda r: F.shiftright(r, 32).cast("int")
    size = lambda r: (r - F.shiftleft(F.shiftright(r, 32), 32)).cast("int") - start(r) + 1
    named = lambda r: F.struct(start(r).alias("start"), size(r).alias("size"), F.xxhash64(F.slice("a", start(r) + 1, size(r))).alias("a"), F.xxhash64(F.lit(1), F.slice("b", start(r) + 1, size(r))).alias("b"))
    return told.withColumn("runs", both).select("id", "text_key", F.explode(F.transform("runs", named)).alias("r")).select("id", "text_key", "r.*")


def _repeated_runs(docs: DataFrame, passage: int) -> DataFrame:
    """(id, text_key, start, size) of the runs of `passage` words that stand at a smaller (id, text hash, line) too."""
    place = F.struct("id", "text_key", "start")
    repeats = staged(_runs(docs, passage).groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"), "run_repeats")
    hot = F.broadcast(repeats.orderBy(F.desc("n"), "a", "b").limit(HOT).select("a", "b", F.col("first").alias("hot")))
    known = _runs(docs, passage).join(hot, ["a", "b"], "left")
    # rows whose first is known are spread by place and meet nothing
    keyed = known.withColumn("key", F.when(F.col("hot").isNull(), F.col("a")).otherwise(F.xxhash64("text_key", "start"))).withColumn("b", F.when(F.col("hot").isNull(), F.col("b")))
    found = keyed.join(repeats.select(F.col("a").alias("key"), "b", "first"), ["key", "b"], "left")
    return found.where(~place.eqNullSafe(F.coalesce("hot", "first", place))).select("id", "text_key", "start", "size")


def dedup_lines(docs: DataFrame, text: str = "text", id: str = "doc_id", every: int = EVERY, long_line: int = LONG_LINE, salts: int = SALTS, passage: int | None = None) -> DataFrame:
    """All columns of `docs` with the text less its repeated chunks, plus n_lines and n_removed_lines.

    Of chunks with equal bytes the one of the smallest (id, text hash, place) stays and all others
    go, within a document too. Single short lines stay. Hashes only say which chunks to compare:
    chunks go when their bytes equal the first one's.
    With `passage`, each run of lines of that many words or more that stands at a smaller place goes
    as well, however it is cut into lines and chunks and whatever stands around it, also where it
    overlaps its first; such runs are compared by two 64-bit hashes of each line.
    The first pass shuffles hashes alone; chunk texts travel only for hashes found twice, spread over
    `salts` by document, as is the first occurrence of each.
    A null text stays null with 0 lines; empty lines count as lines; rows alike in id and text are
    one document, each gets the result; null ids come first in the order; an empty table gives no
    rows; other columns stay, also such with names used here inside.
    """
    base = docs.select(docs[id].alias("id"), F.coalesce(docs[text], F.lit("")).alias("t")).withColumn("text_key", F.xxhash64("t"))
    place = F.struct("id", "text_key", "no")
    hashed = _chunk_rows(base, every, long_line).select("id", "text_key", "no", "hash")
    repeats = staged(hashed.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("hash", "first"), "repeats")
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    rows = _chunk_rows(base, every, long_line).withColumn("salt", F.pmod("text_key", F.lit(salts)).cast("int"))
    found = staged(rows.join(repeats.select("hash", "first", spread), ["hash", "salt"]).withColumn("is_first", place.eqNullSafe(F.col("first"))), "found")
    firsts = found.where("is_first").dropDuplicates(["hash"]).select("hash", F.col("chunk").alias("first_chunk"), spread)
    gone = found.where("not is_first").join(firsts, ["hash", "salt"]).where("chunk = first_chunk")
    gone = gone.select("id", "text_key", "start", "size")
    if passage is not None:
        gone = gone.unionByName(_repeated_runs(base, passage))
    spans = F.collect_set(F.struct("start", "size"))
    per_doc = gone.groupBy("id", "text_key").agg(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))).alias("gone"))

    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = docs.select(own.alias("row"), docs[id].alias("id"), docs[text].alias("t")).withColumn("text_key", F.xxhash64(F.coalesce("t", F.lit("")))).alias("a")
    joined = whole.join(per_doc.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.text_key") == F.col("b.text_key")), "left")
    lines = joined.select("row", "t", "gone", F.split("t", "\n", -1).alias("lines"))
    kept = lines.withColumn("kept", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"))
    left = F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n"))
    n = F.when(F.col("t").isNull(), 0).otherwise(F.size("lines")).cast("long")
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("lines") - F.size("kept")).cast("long")
    return kept.select(*[left.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns], n.alias("n_lines"), removed.alias("n_removed_lines"))


#: The same for DuckDB, over `documents` with distinct ids.
DEDUP_SQL = f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, i, lines[i] AS line, len(lines) AS n,
         ('0x' || substr(md5(lines[i]), 1, 8))::BIGINT AS h,
         length(lines[i]) - length(replace(lines[i], ' ', '')) + 1 >= {LONG_LINE} AS long
  FROM split, unnest(range(1, len(lines) + 1)) AS u(i)),
marked AS (
  SELECT *, CASE WHEN i = 1 OR long OR lag(long) OVER w OR (31 * lag(h) OVER w + h) % {EVERY} = 0 THEN 1 ELSE 0 END AS starts
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY i) AS no FROM marked),
chunk AS (
  SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS size, bool_or(long) AS long
  FROM numbered GROUP BY doc_id, no),
gone AS (
  SELECT doc_id, no FROM (
    SELECT doc_id, no, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, no) AS k FROM chunk
    WHERE (size > 1 OR long) AND trim(translate(chunk, chr(10) || chr(13) || chr(9), '   ')) <> '')
  WHERE k > 1)
SELECT d.doc_id,
       coalesce(string_agg(n.line, chr(10) ORDER BY n.i) FILTER (WHERE g.no IS NULL), '') AS text,
       count(*) AS n_lines, count(g.no) AS n_removed_lines
FROM documents d JOIN numbered n ON n.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.no = n.no
GROUP BY d.doc_id
"""
