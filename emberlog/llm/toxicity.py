"""Toxicity by a weighted finite-state grammar over insults, threats, targets, negation and reported speech."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import Memo, map_arrow, slices

#: Labelled rows that the lexicon and the weights are learned from, at most (about); all are taken below that.
TRAINING_ROWS = 100_000
LEAST_DOCS = 5
#: How much likelier a stem is in toxic documents: to be an insult, and to be a doubtful word.
LEAST_RATIO, DOUBTFUL_RATIO = 60.0, 15.0
SHORTEST, LONGEST = 3, 8
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")

# Fixed word classes of the grammar, in the languages of the texts: threats, targets (English ones apart), words
# before an English verb, words that are a threat in English alone, negations, reports.
CLASSES = {
    "T": "kill hurt beat burn destroy stab shoot tuer frapper brûler töten schlagen verbrennen matar golpear quemar",
    "Q": "you your yourself he she they him her them this that these those",
    "P": "tu te toi vous il elle du dich euch ihr sie tú usted ellos",
    "E": "i we will would should shall must can may could ll gonna to please go and just",
    "D": "die",
    "N": "not no never nobody isn aren wasn don doesn ne pas jamais nicht kein keine nie nunca jamás",
    "R": "said says say told claims claimed wrote called quoted reported dit disait écrit sagte sagt schrieb dijo dice escribió",
}
OTHER, STOP, INSULT, THREAT, TARGET, NEGATION, REPORT, DOUBTFUL = ".", "|", "I", "T", "P", "N", "R", "W"
ENGLISH_TARGET, ENGLISH, ENGLISH_THREAT = "Q", "E", "D"
#: What the composed transducer writes: plain, targeted, negated, reported insults; plain, targeted, negated, reported threats; doubtful words.
FEATURES = ("I", "V", "i", "j", "T", "U", "t", "u", "W")
#: Symbols that a clause needs to match at all.
WEIGHED = (INSULT, THREAT, DOUBTFUL, ENGLISH_THREAT)
LEVELS = 3
#: log odds of the bias and of one level of each feature, where there are no labels to learn from
DEFAULT_WEIGHTS = (-3.0, 4.0, 5.0, 1.0, 1.5, 0.5, 4.0, 0.0, 0.5, 1.0)
Stems = tuple[frozenset[str], frozenset[str]]


class Transducer:
    """A deterministic transducer: step(state, symbol) gives the next state and the symbol written."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        """The composition: `other` reads what this one writes."""

        def step(state, symbol):
            mine, written = self.step(state[0], symbol)
            theirs, written = other.step(state[1], written)
            return (mine, theirs), written

        return Transducer((self.start, other.start), step)

    def table(self, alphabet: str) -> list[dict[str, tuple[int, str]]]:
        """All states that can be reached, numbered, each with its steps."""
        numbers, rows, queue = {self.start: 0}, [], [self.start]
        for state in queue:
            row = {}
            for symbol in alphabet:
                after, written = self.step(state, symbol)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    queue.append(after)
                row[symbol] = (numbers[after], written)
            rows.append(row)
        return rows


def marker(opener: str, reach: int | None, rewrite: dict[str, str]) -> Transducer:
    """Rewrites symbols that follow `opener` within `reach` tokens, or within the clause if reach is None."""

    def step(left: int, symbol: str) -> tuple[int, str]:
        if symbol == STOP:
            return 0, symbol
        if symbol == opener:
            return reach or 1, symbol
        return (left if reach is None else max(0, left - 1)), rewrite.get(symbol, symbol) if left else symbol

    return Transducer(0, step)


def english() -> Transducer:
    """Reads the English classes: an English threat counts right after an English target or a word that leads an English verb."""

    def step(leads: bool, symbol: str) -> tuple[bool, str]:
        written = {ENGLISH_TARGET: TARGET, ENGLISH: OTHER, ENGLISH_THREAT: THREAT if leads else OTHER}.get(symbol, symbol)
        return symbol in (ENGLISH_TARGET, ENGLISH), written

    return Transducer(False, step)


def after_target(reach: int) -> Transducer:
    """A target within `reach` tokens after a plain insult or threat makes it a targeted one: V or U, written where the target stands."""

    def step(state: tuple[int, str], symbol: str) -> tuple[tuple[int, str], str]:
        left, mark = state
        if symbol == TARGET and left:
            return (0, ""), mark
        if symbol in (INSULT, THREAT):
            return (reach, "V" if symbol == INSULT else "U"), symbol
        return ((left - 1, mark) if left > 1 and symbol != STOP else (0, "")), symbol

    return Transducer((0, ""), step)


def grammar() -> list[dict[str, tuple[int, str]]]:
    negated = marker(NEGATION, 3, {INSULT: "i", THREAT: "t"})
    reported = marker(REPORT, None, {INSULT: "j", THREAT: "u"})
    targeted = marker(TARGET, 4, {INSULT: "V", THREAT: "U"})
    alphabet = OTHER + STOP + INSULT + THREAT + TARGET + NEGATION + REPORT + DOUBTFUL + ENGLISH_TARGET + ENGLISH + ENGLISH_THREAT
    return english().then(negated).then(reported).then(targeted).then(after_target(2)).table(alphabet)


def symbols_of(stems: Stems) -> Memo:
    """The symbol of a token; stems, sure and doubtful ones, are beginnings of words, or whole words if they end in $."""
    fixed = {w: c for c, words in CLASSES.items() for w in words.split()}

    def symbol(token: str) -> str:
        if not token[0].isalpha():
            return STOP
        for some, its in zip(stems, (INSULT, DOUBTFUL)):
            if token + "$" in some or any(token[:k] in some for k in range(SHORTEST, min(LONGEST, len(token)) + 1)):
                return its
        return fixed.get(token, OTHER)

    return Memo(symbol)


def clause_levels(text: str | None, symbols: Memo, table: list[dict[str, tuple[int, str]]]) -> tuple[tuple[int, ...], int]:
    """A level from 0 to LEVELS for each of FEATURES over the text's clauses, and how many clauses matched."""
    line = "".join(map(symbols.__getitem__, TOKEN.findall(text.lower()))) if text else ""
    if not any(s in line for s in WEIGHED):
        return (0,) * len(FEATURES), 0
    found: Counter[str] = Counter()
    state, matched = 0, 0
    for clause in line.split(STOP):
        if any(s in clause for s in WEIGHED):
            written = []
            for s in clause:
                state, out = table[state][s]
                written.append(out)
            held = Counter(x for x in written if x in FEATURES)
            found += held
            matched += bool(held)
            state = 0
    return tuple(min(LEVELS, found[f]) for f in FEATURES), matched


def training_labels(labels: DataFrame, rows: int, id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """(label_id, label) of rows that aren't held out, about `rows` of them at most, chosen by hash."""
    known = labels.select(labels[id].alias("label_id"), labels[label].cast("int").alias("label")).dropna().where(~held_out("label_id"))
    known = known.groupBy("label_id").agg(F.max("label").alias("label"))
    total = known.count()
    share = min(1.0, rows / max(1, total))
    return known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20))))


def held_out(id: str) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    # at most TRAINING_ROWS pairs of numbers are broadcast
    return docs.join(F.broadcast(labels), F.col("id") == F.col("label_id")).select("text", "label")


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, pos, neg): different neighbourhoods of the word in toxic documents, and other documents that have it.

    Copies of one text bring each of its words with the same neighbours, so they count once.
    Tasks count on their own first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos: set[tuple[str, int]] = set()
        neg: Counter[str] = Counter()

        def told() -> pa.RecordBatch:
            words = [*(w for w, _ in pos), *neg]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([*(c for _, c in pos), *[None] * len(neg)], pa.int64()), pa.array([*[0] * len(pos), *neg.values()], pa.int64())], ["word", "near", "neg"])

        for batch in batches:
            for rows in slices(batch, "text"):
                for text, label in zip(rows["text"], rows["label"]):
                    tokens = TOKEN.findall((text or "").lower())
                    if label > 0:
                        around = zip(tokens, ["", *tokens], [*tokens[1:], ""])
                        pos.update((w, zlib.crc32(f"{a} {b}".encode())) for w, a, b in around if w[0].isalpha())
                    else:
                        neg.update({w for w in tokens if w[0].isalpha()})
                if len(pos) + len(neg) > 300_000:
                    yield told()
                    pos.clear()
                    neg.clear()
        yield told()

    counted = map_arrow(labelled, count, "word string, near long, neg long").groupBy("word", "near").agg(F.sum("neg").alias("neg"))
    return counted.groupBy("word").agg(F.count("near").alias("pos"), F.sum("neg").alias("neg"))


def candidate_stems(words: DataFrame, n_pos: int, n_neg: int, least_docs: int, least_ratio: float) -> dict[str, tuple[int, float]]:
    """Beginnings of words, and whole words, far likelier in toxic documents, with their neighbourhoods and how much likelier.

    As many as the bounded training rows can support.
    """
    longest = F.least(F.lit(LONGEST), F.length("word"))
    begins = F.when(longest >= SHORTEST, F.transform(F.sequence(F.lit(SHORTEST), longest), lambda k: F.substring(F.col("word"), F.lit(1), k))).otherwise(F.array().cast("array<string>"))
    stems = words.select(F.explode(F.concat(begins, F.array(F.concat("word", F.lit("$"))))).alias("stem"), "pos", "neg").groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ratio = ((F.col("pos") + 0.5) / (n_pos + 1)) / ((F.col("neg") + 0.5) / (n_neg + 1))
    told = stems.withColumn("ratio", ratio).where((F.col("pos") >= least_docs) & (F.col("ratio") >= least_ratio))
    return {r["stem"]: (r["pos"], r["ratio"]) for r in told.select("stem", "pos", "ratio").collect()}


def choose_stems(labelled: DataFrame, stems: dict[str, tuple[int, float]], least_docs: int, sure: float) -> Stems:
    """Stems that stand in texts of their own, and what else it takes to explain the toxic training documents.

    A stem whose neighbourhoods are hardly fewer than its documents is evidence by itself. Of the
    others, the one with most documents not explained yet is taken, the longer of equals, until none
    has `least_docs`: words that only come along in copies of a toxic text explain nothing new.
    Stems under the ratio `sure` are chosen on their own, as doubtful ones.
    """
    names, wanted = list(stems), frozenset(stems)
    number = {s: k for k, s in enumerate(names)}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                out = []
                for text in rows["text"]:
                    words = set(TOKEN.findall((text or "").lower()))
                    has = {w[:k] for w in words for k in range(SHORTEST, min(LONGEST, len(w)) + 1)} | {w + "$" for w in words}
                    out.append([number[s] for s in has & wanted])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], ["stems"])

    rows = [r["stems"] for r in map_arrow(labelled.where("label > 0").select("text"), found, "stems array<int>").where("size(stems) > 0").distinct().collect()]
    docs_of: dict[int, set[int]] = {}
    for d, has in enumerate(rows):
        for k in has:
            docs_of.setdefault(k, set()).add(d)

    def chosen_of(docs_of: dict[int, set[int]]) -> frozenset[str]:
        chosen: list[str] = []
        rank = lambda k: (len(docs_of[k]), len(names[k]), names[k])
        for k in sorted(docs_of, key=rank, reverse=True):
            own = stems[names[k]][0] >= max(2 * least_docs, 0.5 * len(docs_of[k]))
            if own and len(docs_of[k]) >= least_docs and not any(names[k].startswith(c) or c.startswith(names[k]) for c in chosen):
                chosen.append(names[k])
        explained = set().union(*(docs_of[number[c]] for c in chosen))
        docs_of = {k: rest for k, d in docs_of.items() if (rest := d - explained)}
        while docs_of and len(docs_of[k := max(docs_of, key=rank)]) >= least_docs:
            chosen.append(names[k])
            gone = docs_of[k]
            docs_of = {k: rest for k, d in docs_of.items() if (rest := d - gone)}
        return frozenset(chosen)

    certain = lambda k: stems[names[k]][1] >= sure
    return chosen_of({k: d for k, d in docs_of.items() if certain(k)}), chosen_of({k: d for k, d in docs_of.items() if not certain(k)})


def fit_weights(cells: list[tuple], ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic weights from (levels..., label, count); at most (LEVELS + 1) ** len(FEATURES) * 2 cells."""
    x = np.array([[1.0, *c[:-2]] for c in cells])
    y, n = np.array([c[-2] > 0 for c in cells], float), np.array([c[-1] for c in cells], float)
    w, hold = np.array(DEFAULT_WEIGHTS), np.array(DEFAULT_WEIGHTS)
    loss = lambda w: (n * np.logaddexp(0, np.where(y, -1, 1) * (x @ w))).sum() + ridge / 2 * ((w - hold) ** 2).sum()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (p - y)) + ridge * (w - hold))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def levels_of(rows: DataFrame, stems: Stems) -> DataFrame:
    """`rows` (with a column text) with their feature levels f0... and n_clauses in place of the text."""
    keep = [c for c in rows.columns if c != "text"]
    table = grammar()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = symbols_of(stems)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [clause_levels(t, symbols, table) for t in part["text"]]
                columns = [pa.array(part[c], batch.schema.field(c).type) for c in keep]
                columns += [pa.array([f[0][k] for f in found], pa.int32()) for k in range(len(FEATURES))] + [pa.array([f[1] for f in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *(f"f{k}" for k in range(len(FEATURES))), "n_clauses"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return map_arrow(rows, score, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"f{k} int" for k in range(len(FEATURES))), "n_clauses long"]))


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, least_docs: int = LEAST_DOCS, sure: float = LEAST_RATIO, doubtful: float = DOUBTFUL_RATIO) -> tuple[Stems, tuple[float, ...]]:
    """The sure and doubtful stems and the weights, from labelled documents that aren't held out."""
    known = training_labels(labels, rows)
    labelled = _with_labels(docs, known)
    sizes = {bool(r["toxic"]): r["count"] for r in known.groupBy((F.col("label") > 0).alias("toxic")).count().collect()}
    if not sizes.get(True):
        return (frozenset(), frozenset()), DEFAULT_WEIGHTS
    stems = choose_stems(labelled, candidate_stems(word_counts(labelled), sizes[True], sizes.get(False, 0), least_docs, doubtful), least_docs, sure)
    features = [f"f{k}" for k in range(len(FEATURES))]
    cells = [tuple(r) for r in levels_of(labelled, stems).groupBy(*features, "label").count().collect()]
    return stems, fit_weights(cells) if cells else DEFAULT_WEIGHTS


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, text_key, held_out, score, predicted, n_clauses.

    Insults are learned as beginnings of words from labelled rows outside the held-out fifth; tokens
    become symbols, the composed transducer marks each insult and threat in its clause as plain,
    targeted, negated or reported, and the weighted levels of those give the score. Scores see the
    text alone. Null and empty texts match nothing and get the score of no match; a null id counts as
    held out; repeated rows get a result each; without labels default weights and no insults are
    used; an empty table gives no rows; other columns are ignored.
    """
    base = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    stems, weights = learn(base, labels, **options)
    scored = levels_of(base.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit("")))), stems)
    z = F.lit(weights[0])
    for k, w in enumerate(weights[1:]):
        z = z + F.lit(w) * F.col(f"f{k}")
    done = scored.withColumn("score", 1 / (1 + F.exp(-z)))
    return done.select(F.col("id").alias(id), "text_key", held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that aren't predicted toxic, with all columns as they are; no row leaves its task."""
    base = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    stems, weights = learn(base, labels, **options)
    table, names = grammar(), docs.columns
    column = names.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = symbols_of(stems)
        for batch in batches:
            fine = []
            for value in batch.column(column):
                levels, _ = clause_levels(value.as_py(), symbols, table)
                fine.append(weights[0] + sum(w * x for w, x in zip(weights[1:], levels)) < 0)
            yield batch.filter(pa.array(fine, pa.bool_()))

    return map_arrow(docs, keep, docs.schema)
