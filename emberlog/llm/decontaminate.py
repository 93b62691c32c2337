"""Benchmark passages in training texts by a distributed positional inverted index."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import Memo, TermBits, ascii_lower_words, map_arrow, slices, staged

WINDOW = 13
SALTS = 32


def item_words(items: DataFrame, id: str, text: str) -> DataFrame:
    """(item, item_id, words) of every different test text that has a word; item is a key of the id and the text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                words = [[w.decode() for w in ascii_lower_words(x)] for x in rows["text"]]
                yield pa.RecordBatch.from_arrays([pa.array(rows["item"], pa.string()), pa.array(rows["item_id"], pa.string()), pa.array(words, pa.list_(pa.string()))], ["item", "item_id", "words"])

    told = items.select(items[id].cast("string").alias("item_id"), items[text].alias("text")).distinct()
    # the length keeps id and text apart, a null id has none
    key = F.sha2(F.concat(F.coalesce(F.length("item_id"), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce("item_id", F.lit("")), F.coalesce("text", F.lit(""))), 256)
    return map_arrow(told.select(key.alias("item"), "item_id", "text"), cut, "item string, item_id string, words array<string>").where("size(words) > 0")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of `terms` stands in the training texts, 0 included. Tasks count on their own first."""
    bits = TermBits(terms, "term")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = Memo(bits.__contains__), Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "n"])

        for batch in batches:
            for rows in slices(batch, "text"):
                for text in rows["text"]:
                    total.update(filter(wanted.__getitem__, ascii_lower_words(text)))
                if len(total) > 200_000:
                    yield told()
                    total.clear()
        yield told()

    counted = map_arrow(docs.select("text"), count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return terms.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def anchors(words: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, item_id, at, term, before, after, short): the places of each item to look up in the index.

    Every window takes the place of its rarest term, the first of equals; neighbouring windows mostly
    share it. A window with a term that no training text has needs no place. before and after are
    the item's words around the place, nearest first.
    """
    flat = words.select("item", "words", F.posexplode("words").alias("at", "term")).select("item", "at", "term").join(counts, "term")
    near = Window.partitionBy("item").orderBy("at").rowsBetween(0, window - 1)
    best = flat.withColumn("best", F.min(F.struct("n", "at")).over(near)).join(words, "item")
    chosen = best.where((F.col("at") == 0) | (F.col("at") + window <= F.size("words"))).where("best.n > 0")
    place = chosen.select("item", "item_id", F.col("best.at").alias("at"), "words").dropDuplicates(["item", "at"])
    return place.select(
        "item", "item_id", F.get("words", F.col("at")).alias("term"),
        *_around("words", F.col("at"), window), (F.size("words") < window).alias("short"),
    )


def _around(words: str, at: Column, window: int) -> tuple[Column, Column]:
    first = F.greatest(at - (window - 1), F.lit(0))
    return F.reverse(F.slice(words, first + 1, at - first)).alias("before"), F.slice(words, at + 2, window - 1).alias("after")


def postings(docs: DataFrame, places: DataFrame, window: int = WINDOW) -> DataFrame:
    """The index: (doc, n_words, term, at, before, after) for every place of a term in `places`, before and after as in `anchors`.

    Every document has a row without a term as well, for its number of words.
    """
    bits = TermBits(places, "term")
    reach = window - 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Memo(bits.__contains__)
        for batch in batches:
            for rows in slices(batch, "text"):
                out: list[tuple] = []
                for doc, key, text in zip(rows["id"], rows["text_key"], rows["text"]):
                    words = ascii_lower_words(text)
                    out.append((doc, key, len(words), None, None, None, None))
                    for at in [k for k, w in enumerate(words) if wanted[w]]:
                        before, after = words[max(0, at - reach) : at][::-1], words[at + 1 : at + 1 + reach]
                        out.append((doc, key, None, words[at].decode(), at, [w.decode() for w in before], [w.decode() for w in after]))
                if out:
                    kinds = (batch.schema.field("id").type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["id", "text_key", "n_words", "term", "at", "before", "after"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_arrow(docs, index, f"id {kind}, text_key long, n_words long, term string, at long, before array<string>, after array<string>")


def _alike(a: str, b: str) -> Column:
    """How many words two arrays share from their start."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("long")


def matches(index: DataFrame, places: DataFrame, window: int = WINDOW, salts: int = SALTS) -> DataFrame:
    """(id, text_key, item_id, from, to): training words from..to-1 that are a run of windows of the item.

    Lists of one term meet in a join on the term; a term that stands in very many documents is
    spread over `salts` by document. Offset-adjusted, both sides then show the words around the
    term, nearest first, and agree on the longest run; runs shorter than a window go.
    """
    spread = places.select("item_id", "term", F.col("before").alias("left"), F.col("after").alias("right"), "short", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    found = index.where("term is not null").withColumn("salt", F.pmod(F.xxhash64("text_key", "at"), F.lit(salts)).cast("int")).join(spread, ["term", "salt"])
    run = found.withColumn("l", _alike("before", "left")).withColumn("r", _alike("after", "right"))
    whole = F.when(F.col("short"), (F.col("l") == F.size("left")) & (F.col("r") == F.size("right"))).otherwise(F.col("l") + F.col("r") + 1 >= window)
    return run.where(whole).select("id", "text_key", "item_id", (F.col("at") - F.col("l")).alias("from"), (F.col("at") + F.col("r") + 1).alias("to"))


def proximity(docs: DataFrame, phrase: list[str], slop: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, from, to): places where the words of `phrase` stand in order with at most `slop` other words between the first and the last.

    The rarest word of the phrase is looked up; a sliding reach of len(phrase) + slop words around it is read.
    """
    spark = docs.sparkSession
    wanted = [w.lower() for w in phrase]
    terms = spark.createDataFrame([(w,) for w in sorted(set(wanted))], "term string")
    base = docs.select(docs[id].alias("id"), docs[text].alias("text")).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    counts = {r["term"]: r["n"] for r in term_counts(base, terms).collect()}  # as many rows as the phrase has words
    rare = min(range(len(wanted)), key=lambda k: counts[wanted[k]])
    reach = len(wanted) + slop
    index = postings(base, terms.where(F.col("term") == wanted[rare]), reach + 1).where(F.col("term") == wanted[rare])

    def follow(words: str, queue: list[str]) -> Column:
        """The least number of `words`, taken from the start, that has `queue` in order; null if none has."""
        at: Column = F.lit(0)
        for w in queue:
            rest = F.slice(words, at + 1, F.lit(reach))
            k = F.array_position(rest, w)
            at = F.when(k > 0, at + k)
        return at

    left, right = follow("before", wanted[:rare][::-1]), follow("after", wanted[rare + 1 :])
    spans = index.select("id", "text_key", (F.col("at") - left).alias("from"), (F.col("at") + right + 1).alias("to"))
    return spans.where(F.col("to") - F.col("from") <= reach).select(F.col("id").alias(id), "from", "to").distinct()


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, salts: int = SALTS) -> DataFrame:
    """One row per document and text: id, text_key, n_copies, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and aren't contaminated; items without words are never found;
    rows alike in id and text give one row with n_copies; a null id stays; without documents there are
    no rows, without items no hits; other columns are ignored. All texts of a repeated item_id count and
    it is one item; texts with a null item_id count as one item more, which items_sha256 leaves out. Words are not cut, a long text has all.
    """
    base = docs.select(docs[id].alias("id"), docs[text].alias("text")).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    words = staged(item_words(items, item_id, item_text), "items")
    counts = term_counts(base, words.select(F.explode("words").alias("term")).distinct())
    places = staged(anchors(words, staged(counts, "counts"), window), "places")
    index = staged(postings(base, places, window), "postings")
    hits = matches(index, places, window, salts)
    # the runs of a document, merged: a word counts once
    order = Window.partitionBy("id", "text_key").orderBy("from", "to")
    runs = hits.select("id", "text_key", "from", "to").distinct().withColumn("seen", F.coalesce(F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n_hit = runs.groupBy("id", "text_key").agg(F.sum(F.greatest(F.lit(0), F.col("to") - F.greatest("from", "seen"))).alias("n_hit"))
    found = hits.select("id", "text_key", "item_id").distinct().groupBy("id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.count("*").alias("n_items"))
    both = n_hit.alias("h").join(found.alias("f"), F.col("h.id").eqNullSafe(F.col("f.id")) & (F.col("h.text_key") == F.col("f.text_key"))).select("h.id", "h.text_key", "n_hit", "items", "n_items")
    sizes = index.where("term is null").groupBy("id", "text_key").agg(F.max("n_words").alias("n_words"), F.count("*").alias("n_copies"))
    all_rows = sizes.alias("s").join(both.alias("b"), F.col("s.id").eqNullSafe(F.col("b.id")) & (F.col("s.text_key") == F.col("b.text_key")), "left")
    n, none = F.coalesce("n_hit", F.lit(0)), F.array().cast("array<string>")
    return all_rows.select(
        F.col("s.id").alias(id), "s.text_key", "n_copies", "n_words", n.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"), ((n > 0) & (20 * n >= F.col("n_words"))).alias("contaminated"),
    )


def benchmark_hits(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`contamination` with one row per row of `docs`, without text_key."""
    found = contamination(docs, items, **options)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies")))).drop("copy", "n_copies", "text_key")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` whose text isn't contaminated, with all columns as they are."""
    bad = contamination(docs, items, text, id, **options).where("contaminated").select(F.col(id).alias("bad_id"), F.col("text_key").alias("bad_key"))
    same = docs[id].eqNullSafe(bad["bad_id"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == bad["bad_key"])
    return docs.join(bad, same, "left_anti")
