"""Token counts of whole texts, huge ones in overlapping chunks that are spliced where both sides agree."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from emberlog.llm.common import map_arrow, slices

HUGE = 1 << 16
CHUNK = 1 << 14
OVERLAP = 256
AGREE = 4
#: White space for str.split() but not for the tokenizer.
ODD_WHITE = re.compile("[\x1c-\x1f]")
WORDS = re.compile("[^\t-\r ]+")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _counts(path: str) -> dict[str, int]:
    return {}


def words_of(text: str) -> list[str]:
    return WORDS.findall(text) if ODD_WHITE.search(text) else text.split()


def count_by_words(path: str, texts: list[str], limit: int = 700_000) -> list[int]:
    """Tokens of each text as the sum over its words.

    A tokenizer that drops white space never joins characters across it, so a word has the same
    tokens in every text; each distinct word is encoded once per worker.
    """
    seen, parts = _counts(path), [words_of(x) for x in texts]
    if len(seen) > limit:
        seen.clear()
    new = list(set().union(*parts).difference(seen))
    if new:
        seen.update(zip(new, map(len, tokenizer(path).encode_batch_fast(new, add_special_tokens=False))))
    return [sum(map(seen.__getitem__, words)) for words in parts]


def _encoded(path: str, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    e = tokenizer(path).encode(text[start:end], add_special_tokens=False)
    return [(start + a, start + b, i) for (a, b), i in zip(e.offsets, e.ids)]


def common_boundary(text: str, left: list[tuple], right: list[tuple], agree: int = AGREE) -> int | None:
    """A position after white space where tokens of both encodings start and the next `agree` are alike, or None.

    White space ends every token, so what stands before it doesn't depend on where the left chunk
    ends, nor what follows on where the right one starts.
    """
    at = {t[0]: k for k, t in enumerate(right)}
    for k in range(len(left) - agree, -1, -1):
        p = left[k][0]
        if right and p <= right[0][0]:
            return None
        if p in at and text[p - 1] in " \n\t\r" and left[k : k + agree] == right[at[p] : at[p] + agree]:
            return p
    return None


def count_by_chunks(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a huge text: chunks overlap, are spliced at a common boundary, and the overlap doubles until there is one."""
    total, start, floor = 0, 0, 0
    while True:
        edge, width = start + chunk, overlap
        if edge >= len(text):
            return total + sum(t[0] >= floor for t in _encoded(path, text, start, len(text)))
        while True:
            left = _encoded(path, text, start, min(edge + width, len(text)))
            if edge + width >= len(text):  # the rest is in the left chunk
                return total + sum(t[0] >= floor for t in left)
            right = _encoded(path, text, edge, edge + width)
            p = common_boundary(text, left, right)
            if p is not None:
                break
            width *= 2
        total += sum(floor <= t[0] < p for t in left)
        start, floor = edge, max(floor, p)


def token_counts(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", limit: int = 2048, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    `path` is a file for the library tokenizers whose pre-tokenizer drops white space. Nothing is
    shuffled; a task holds one slice of texts. A null text counts as empty (0, 0, false); a null id
    and repeated rows stay, one result each; an empty table gives no rows; other columns are ignored.
    Texts over `huge` characters are counted chunk by chunk and never encoded in one piece.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                texts = [x or "" for x in rows["text"]]
                short = iter(count_by_words(path, [x for x in texts if len(x) <= huge]))
                n = [next(short) if len(x) <= huge else count_by_chunks(path, x, chunk, overlap) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["id"], batch.schema.field("id").type), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    [id, "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return map_arrow(docs.select(docs[id].alias("id"), docs[text].alias("text")), count, f"`{id}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
