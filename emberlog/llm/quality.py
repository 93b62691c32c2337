"""Quality rules whose cut-offs follow each language and source. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import staged

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Measures with an upper fence, and the least distance the fence keeps from the median.
MEASURES = {"symbol_share": 0.05, "dup_line_share": 0.3, "repeat_share": 0.35, "word_length": 3.0, "loud_share": 0.1}
SKETCH_K = 4096
LEAST_DOCS = 50
REACH = 4.0
SALTS = 32


def text_measures(t: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts of one text, its words, and its lines that have a word."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": (F.length(t) - F.regexp_count(t, F.lit("[\\x20\\x09-\\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_loud": F.regexp_count(t, F.lit("[!?]")).cast("long"),
    }


def sorted_windows(words: Column) -> Column:
    """Every three-word window of an array of words as (hash, place), sorted: equal windows become neighbours."""
    three = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(words) >= 3, F.array_sort(three)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def repeated_words(words: Column, windows: Column) -> Column:
    """How many words stand in a window that has an equal neighbour; equal hashes are compared word by word."""

    def alike(a: Column, b: Column) -> Column:
        same = a["h"] == b["h"]
        for k in range(3):
            same = same & (F.get(words, a["i"] + k) == F.get(words, b["i"] + k))
        return F.coalesce(same, F.lit(False))

    at = F.transform(windows, lambda x, k: F.when(alike(x, F.get(windows, k - 1)) | alike(x, F.get(windows, k + 1)), x["i"]))
    return F.size(F.array_distinct(F.flatten(F.transform(F.filter(at, lambda i: i.isNotNull()), lambda i: F.array(i, i + 1, i + 2))))).cast("long")


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    base = docs.select(docs[id].alias("id"), docs[lang].alias("lang"), docs[source].alias("source"), F.coalesce(docs[text], F.lit("")).alias("t"))
    split = base.withColumn("words", F.filter(F.split("t", SPACE, -1), lambda w: w != "")).withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    counted = split.select("id", "lang", "source", "words", *(c.alias(n) for n, c in text_measures(F.col("t"), F.col("words"), F.col("lines")).items()))
    windows = counted.withColumn("windows", sorted_windows(F.col("words")))
    return windows.withColumn("n_repeat_words", repeated_words(F.col("words"), F.col("windows"))).drop("words", "windows").withColumns({
        "symbol_share": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
        "word_length": F.col("word_chars") / F.greatest("n_words", F.lit(1)),
        "loud_share": F.col("n_loud") / F.greatest("n_words", F.lit(1)),
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    })


def fences(rows: DataFrame, least_docs: int = LEAST_DOCS, reach: float = REACH, k: int = SKETCH_K) -> DataFrame:
    """lang, source, and an upper fence per measure: median + max(least distance, reach x (median - lower decile), reach x (upper quartile - median)).

    Sketches are built per language and source and merged upwards: a group of fewer than `least_docs`
    documents takes its language's fences, and those of all documents if that has too few as well.
    Only documents that pass the base rules shape the sketches.
    """
    sketch = lambda m: F.kll_sketch_agg_double(F.when(~F.col("base_failed"), F.col(m)), F.lit(k)).alias(m)
    groups = staged(rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n"), *map(sketch, MEASURES)), "sketches")
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(m).alias(m) for m in MEASURES)]

    def cut(df: DataFrame, keys: list[str], to: str) -> DataFrame:
        def fence(m: str) -> Column:
            low, mid, high = (F.kll_sketch_get_quantile_double(m, F.lit(q)) for q in (0.1, 0.5, 0.75))
            return mid + F.greatest(F.lit(MEASURES[m]), reach * (mid - low), reach * (high - mid))

        return df.select(*keys, F.struct(F.col("n"), *(F.when(F.col("n") > 0, fence(m)).alias(m) for m in MEASURES)).alias(to))

    own = cut(groups, ["lang", "source"], "own")
    by_lang = cut(groups.groupBy("lang").agg(*merged), ["lang"], "by_lang").withColumnRenamed("lang", "of_lang")
    overall = cut(groups.agg(*merged), [], "overall").select("overall.*").first()  # one row of numbers
    found = own.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")))
    pick = F.when(F.col("own.n") >= least_docs, F.col("own")).when(F.col("by_lang.n") >= least_docs, F.col("by_lang")).otherwise(F.struct(F.lit(overall["n"]).cast("long").alias("n"), *(F.lit(overall[m]).cast("double").alias(m) for m in MEASURES)))
    return found.select("lang", "source", pick.alias("f")).select("lang", "source", *(F.col(f"f.{m}").alias(f"max_{m}") for m in MEASURES))


def quality(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, reach: float = REACH, salts: int = SALTS) -> DataFrame:
    """One row per document: id, n_words, the base counts, the measures, base_failed, kept.

    kept is false for base_failed and for a measure above its group's fence (`fences`). The fences,
    one row per language and source, are repeated per salt, and a document takes one salt, so a
    source with a third of all rows is spread in the join.
    A null text has no words (base_failed); a null language or source is a group of its own; repeated
    rows get a result each; a null id stays; an empty table gives no rows; other columns are ignored.
    """
    rows = staged(measured(docs, id, text, lang, source), "measures")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "n_words", "word_chars"), F.lit(salts)))
    limits = fences(rows, least_docs, reach).withColumnsRenamed({"lang": "of_lang", "source": "of_source"}).withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    joined = salted.join(limits, (F.col("salt") == F.col("of_salt")) & F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    fine = ~F.col("base_failed")
    for m in MEASURES:
        fine = fine & F.coalesce(F.col(m) <= F.col(f"max_{m}"), F.lit(True))
    return joined.select(F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *MEASURES, "base_failed", fine.alias("kept"))
