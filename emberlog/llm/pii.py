"""Personal data in texts, and terms that give protected persons or machines away."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import Memo, TermBits, map_arrow, slices, staged

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]+")
DIGITS = re.compile("[^0-9]")
#: Words on each side of an entity that count as together with it.
REACH = 10
#: A term may tell less than 1 / ALPHA of the bits that an entity's own mention tells.
ALPHA = 1.25
#: A disclosing term is removed from 1 / BETA of those bits on, as it is as good as the mention; below it is generalised.
BETA = 1.02
LEAST_TEXTS = 3


def luhn(digits: str) -> bool:
    double = "0246813579"
    return sum(int(d) if k % 2 == 0 else int(double[int(d)]) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in KINDS, then start."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            spans.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.sub("", m[0])) <= 15]
    return spans


def entity(kind: str, found: str) -> str:
    """What a span stands for, however it is written."""
    return kind + ":" + (found.lower() if kind in ("email", "ip") else DIGITS.sub("", found))


def near_terms(text: str, spans: list[tuple[str, int, int]], reach: int) -> Iterator[tuple[str, str, int]]:
    """(term, entity, text's hash) for the words around every span, words inside spans left out."""
    key = zlib.crc32(text.encode()) if spans else 0
    taken = [(a, b) for _, a, b in spans]
    for kind, start, end in spans:
        left = [m for m in WORD.finditer(text, max(0, start - 40 * reach), start)][-reach:]
        right = [m for _, m in zip(range(reach), WORD.finditer(text, end, min(len(text), end + 40 * reach)))]
        for m in (*left, *right):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                yield m[0].lower(), entity(kind, text[start:end]), key


def pairs(docs: DataFrame, reach: int) -> DataFrame:
    """(term, entity, texts, n): how often a term stands near an entity, and in how many different texts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                total: Counter = Counter()
                for text in rows["text"]:
                    total.update(near_terms(text or "", base_spans(text or ""), reach))
                keys = list(total)
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int64()), pa.array(list(total.values()), pa.int64())], ["term", "entity", "near", "n"])

    found = map_arrow(docs.select("text"), find, "term string, entity string, near long, n long").groupBy("term", "entity", "near").agg(F.sum("n").alias("n"))
    return found.groupBy("term", "entity").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))


def term_totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, total): how often each term stands in all texts."""
    bits = TermBits(terms, "term")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Memo(lambda w: bits.__contains__(w.encode()))
        total: Counter[str] = Counter()
        for batch in batches:
            for rows in slices(batch, "text"):
                for text in rows["text"]:
                    total.update(filter(wanted.__getitem__, WORD.findall((text or "").lower())))
            if len(total) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "total"])
                total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["term", "total"])

    return map_arrow(docs.select("text"), count, "term string, total long").groupBy("term").agg(F.sum("total").alias("total")).join(terms, "term", "left_semi")


def disclosing_terms(docs: DataFrame, reach: int = REACH, alpha: float = ALPHA, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """(term, entity, bits, own_bits): terms that tell more of an entity than they may.

    Over all texts, own_bits = -log2 P(entity) is what an entity's mention tells, and
    bits = log2 P(entity | term) / P(entity) what the term tells of it; the term discloses the entity
    when bits >= own_bits / alpha. Counts are of words near mentions. A pair needs `least_texts`
    different texts, so exact copies of one text don't make its rare words suspicious.
    """
    near = pairs(docs, reach)
    known = staged(near, "pairs")
    mentions = staged(known.groupBy("entity").agg(F.sum("n").alias("near_entity")), "mentions")
    often = known.where(F.col("texts") >= least_texts)
    totals = term_totals(docs, often.select("term").distinct())
    all_near = mentions.agg(F.sum("near_entity")).first()[0] or 1  # one number
    told = often.join(totals, "term").join(mentions, "entity")
    own = -F.log2(F.col("near_entity") / F.lit(all_near))
    bits = F.log2(F.col("n") / F.greatest("total", "n")) + own
    return told.select("term", "entity", bits.alias("bits"), own.alias("own_bits")).where((F.col("own_bits") > 0) & (F.col("bits") >= F.col("own_bits") / alpha))


def find_pii(docs: DataFrame, text: str = "text", id: str = "doc_id", reach: int = REACH, alpha: float = ALPHA, beta: float = BETA, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """One row per document: id, text_key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms, n_removed, sanitised.

    spans has all base spans, then every occurrence of a disclosing term (`disclosing_terms`) that
    lies outside them, as kind:start:end in code points. The set of disclosing terms travels as a bit
    array of fixed size; what it lets through by chance goes in a join on the term.
    `sanitised` is the text with base spans generalised to their kind, and disclosing terms to their
    form or, the n_removed that tell 1 / `beta` of an entity's own bits or more, removed; it is null where
    no span is found, as the text stays, so that such texts don't travel.
    A null text counts as empty; repeated rows get a result each; a null id stays; an empty table
    gives no rows; other columns are ignored; whole texts are read.
    """
    base = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    told = disclosing_terms(base, reach, alpha, least_texts)
    terms = staged(told.groupBy("term").agg((F.max(F.col("bits") / F.col("own_bits")) >= 1 / beta).alias("remove")), "terms")
    bits = TermBits(terms, "term")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Memo(lambda w: bits.__contains__(w.lower().encode()))
        for batch in batches:
            for rows in slices(batch, "text"):
                out = []
                for doc, key, whole in zip(rows["id"], rows["text_key"], rows["text"]):
                    text = whole or ""
                    spans = base_spans(text)
                    n = Counter(k for k, _, _ in spans)
                    told = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
                    taken = [(a, b) for _, a, b in spans]
                    maybe = [m for m in WORD.finditer(text) if wanted[m[0]]] if any(map(wanted.__getitem__, WORD.findall(text))) else []
                    maybe = [(m[0].lower(), *m.span()) for m in maybe if not any(a < m.end() and m.start() < b for a, b in taken)]
                    out.append((doc, key, *(n[k] for k in KINDS), hashlib.sha256(told.encode()).hexdigest(), told, [{"term": t, "start": a, "end": b} for t, a, b in maybe], whole if spans or maybe else None))
                kinds = (batch.schema.field("id").type, pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["id", "text_key", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "maybe", "text"])

    kind = docs.schema[id].dataType.simpleString()
    found = staged(map_arrow(base.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit("")))), find, f"id {kind}, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, maybe array<struct<term:string,start:long,end:long>>, text string"), "spans")
    occurrences = found.where("size(maybe) > 0").select("id", "text_key", F.explode("maybe").alias("m")).select("id", "text_key", "m.*").distinct()
    sure = occurrences.join(terms, "term").groupBy("id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "remove"))).alias("terms"))
    told = F.transform("terms", lambda s: F.concat_ws(":", F.lit(TERM), s["start"], s["end"]))
    joined = found.alias("a").join(sure.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.text_key") == F.col("b.text_key")), "left")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.array_join(told, ","))
    many = lambda of: F.coalesce(F.size(of), F.lit(0)).cast("long")
    removed = F.filter("terms", lambda t: t["remove"])
    general = F.transform(F.filter("terms", lambda t: ~t["remove"]), lambda t: t["start"])
    columns = (F.col("a.id"), "a.text_key", *(f"n_{k}" for k in KINDS), "base_sha256", spans.alias("spans"), many("terms").alias("n_terms"), many(removed).alias("n_removed"))
    rows = joined.select(*columns, "text", F.coalesce(general, F.array().cast("array<long>")).alias("general"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = {f.name: f.type for f in batch.schema if f.name not in ("text", "general")} | {"sanitised": pa.string()}
            for part in slices(batch, "text"):
                texts = zip(part.pop("text"), part["spans"], part.pop("general"))
                part["sanitised"] = [sanitise(x, told, general) if told else None for x, told, general in texts]
                yield pa.RecordBatch.from_arrays([pa.array(part[c], t) for c, t in kinds.items()], list(kinds))

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_arrow(rows, clean, f"id {kind}, text_key long, {counts}, base_sha256 string, spans string, n_terms long, n_removed long, sanitised string").withColumnRenamed("id", id)


def form(word: str) -> str:
    """What a word is generalised to."""
    if word.isdigit():
        return "<number>"
    if any(map(str.isdigit, word)):
        return "<code>"
    return "<name>" if word[:1].isupper() else "<word>"


def sanitise(text: str, spans: str, general: Collection[int] = ()) -> str:
    """The text with base spans generalised to their kind, terms that start at a place in `general` to their form, and other terms removed.

    Of spans that overlap the first stays; what the next ones have beyond it goes, too.
    """
    out, at, general = [], 0, set(general)
    for kind, start, end in sorted(((k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)), key=lambda s: s[1:]):
        if start >= at:
            own = f"<{kind}>" if kind != TERM else form(text[start:end]) if start in general else ""
            out += [text[at:start], own]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise_documents(docs: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """All rows and columns of `docs` with the text as in `sanitised` of `find_pii`; cases as there."""
    found = find_pii(docs, text, id, **options).select(F.col(id).alias("id"), "text_key", "sanitised").dropDuplicates(["id", "text_key"]).alias("f")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("row"), docs[id].alias("id"), F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("text_key")).alias("d")
    both = rows.join(found, F.col("d.id").eqNullSafe(F.col("f.id")) & (F.col("d.text_key") == F.col("f.text_key")))
    cleaned = F.coalesce("sanitised", F.col("row").getField(text))
    return both.select(*[cleaned.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
