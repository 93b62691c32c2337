"""Similar documents: the most telling words of given rows and texts, and the rows that share enough of them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.fields import Field, Fields
from emberlog.operators import predicates as P


@dataclass(frozen=True)
class Terms:
    """Which words of the given rows and texts count; names and defaults as in a request."""

    max_query_terms: int = 25
    min_term_freq: int = 2
    min_doc_freq: int = 5
    max_doc_freq: int | None = None
    min_word_length: int = 0
    max_word_length: int = 0
    stop_words: tuple[str, ...] = ()
    minimum_should_match: str | int = "30%"

    def kept(self, term: Column) -> Column:
        tests = [term != ""]
        if self.min_word_length:
            tests.append(F.length(term) >= self.min_word_length)
        if self.max_word_length:
            tests.append(F.length(term) <= self.max_word_length)
        if self.stop_words:
            tests.append(~term.isin(*[w.lower() for w in self.stop_words]))
        return P.all_of(tests)

    def frequent(self, docs: Column) -> Column:
        least = docs >= self.min_doc_freq
        return least if self.max_doc_freq is None else least & (docs <= self.max_doc_freq)

    def needed(self, count: Column) -> Column:
        text = str(self.minimum_should_match)
        if text.endswith("%"):
            share = int(text[:-1])
            part = F.floor(count * abs(share) / 100)
            wanted = part if share >= 0 else count - part
        else:
            wanted = F.lit(int(text)) if int(text) >= 0 else count + int(text)
        return F.greatest(wanted, F.lit(1))


def words(column: Column) -> Column:
    """The tokens of a text, and perhaps an empty string; splitting is cheaper than extracting."""
    return F.split(F.lower(column), r"[^\p{L}\p{N}_]+")


# ------------------------------------------------------------- stored counts


def term_statistics(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """(field, term, docs): in how many rows each word of a field stands; a null term has the number of rows."""
    fields = list(fields)
    none = F.array().cast("array<string>")
    entries = F.concat(*[
        _named(F.concat(F.array(F.lit(None).cast("string")), F.array_remove(F.array_distinct(F.coalesce(words(f.column), none)), "")), f)
        for f in fields
    ])
    return df.select(F.inline(entries)).groupBy("field", "term").agg(F.count(F.lit(1)).alias("docs"))


def write_term_statistics(df: DataFrame, names: Sequence[str], path: str, append: bool = False) -> None:
    """Keeps the word counts of an index, sorted by word so that a look-up reads few row groups; rows added later append theirs."""
    fields = Fields.of(df)
    counts = term_statistics(df, [fields.find(n) for n in names])
    counts.repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.mode("append" if append else "overwrite").parquet(path)


def read_term_statistics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("field string, term string, docs bigint").parquet(path)


# ------------------------------------------------------------------ the clause


def similar(
    fields: Fields, names: Sequence[str], like: Sequence = (), like_text: Sequence[str] = (), unlike_text: Sequence[str] = (),
    settings: Terms | None = None, include: bool = False,
) -> tuple[Column, Column]:
    """Which rows share enough of the most telling words of the rows called `like` and of `like_text`, and how many words they share.

    Words are ranked, over all fields together, by frequency in those rows and texts times log(rows / rows with the word).
    Everything is part of the plan: nothing runs before the query does. The counts come from `fields.statistics` if
    there, else from one pass over the table that keeps, of each row, the words that the given rows and texts have;
    these, and the at most `max_query_terms` words sought, travel as arrays.
    """
    settings, rows = settings or Terms(), fields.rows
    found = [f for f in map(fields.find, names) if f is not None]
    if not found:
        return P.never(), F.lit(0)
    key = fields.find(fields.id_field).column if like else None
    spark = rows.sparkSession

    def texts_of(texts: Sequence[str]) -> list[DataFrame]:
        return [spark.range(1).select(F.lit(f.name).alias("field"), F.explode(words(F.lit(t))).alias("term")) for t in texts for f in found]

    parts = texts_of(like_text)
    if like:
        seeds = rows.where(key.isin(list(like)))
        parts += [seeds.select(F.lit(f.name).alias("field"), F.explode(words(f.column)).alias("term")) for f in found]
    seed_terms = (
        reduce(DataFrame.unionAll, parts).where(settings.kept(F.col("term")))
        .groupBy("field", "term").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= settings.min_term_freq)
    )
    if unlike_text:
        seed_terms = seed_terms.join(reduce(DataFrame.unionAll, texts_of(unlike_text)).distinct(), ["field", "term"], "left_anti")
    if fields.statistics is not None:
        stored = fields.statistics.where(F.col("field").isin([f.name for f in found]))
        counts = stored.where("term is not null").join(seed_terms.select("field", "term"), ["field", "term"], "left_semi")
        doc_freq = counts.groupBy("field", "term").agg(F.sum("docs").alias("docs"))
        total = stored.where((F.col("field") == found[0].name) & F.col("term").isNull()).agg(F.sum("docs")).scalar()
    else:
        none = F.array().cast("array<string>")
        seen = rows.select(*[F.coalesce(F.array_intersect(words(f.column), _terms_of(seed_terms, f)), none).alias(f"seen{k}") for k, f in enumerate(found)])
        entries = F.concat(*[_named(F.col(f"seen{k}"), f) for k, f in enumerate(found)])
        doc_freq = seen.select(F.inline(entries)).groupBy("field", "term").agg(F.count(F.lit(1)).alias("docs"))
        total = rows.agg(F.count(F.lit(1))).scalar()
    ranked = (
        seed_terms.join(doc_freq.where(settings.frequent(F.col("docs"))), ["field", "term"])
        .withColumn("weight", F.round(F.col("freq") * F.ln(total / F.col("docs")), 9))
        .orderBy(F.col("weight").desc(), F.col("term"), F.col("field")).limit(settings.max_query_terms)
    )
    shared = [F.coalesce(F.size(F.array_intersect(words(f.column), _terms_of(ranked, f))), F.lit(0)) for f in found]
    shared = reduce(lambda a, b: a + b, shared)
    enough = shared >= settings.needed(ranked.agg(F.count(F.lit(1))).scalar())
    return (enough if include or not like else enough & ~F.coalesce(key.isin(list(like)), F.lit(False))), shared


def _named(terms: Column, field: Field) -> Column:
    return F.transform(terms, lambda term: F.struct(F.lit(field.name).alias("field"), term.alias("term")))


def _terms_of(terms: DataFrame, field: Field) -> Column:
    return terms.where(F.col("field") == field.name).agg(F.collect_list("term")).scalar()
