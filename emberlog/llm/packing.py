"""Documents as token pieces packed into sequences by bounded-space best fit."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import Memo, map_arrow, slices, staged
from emberlog.llm.token_counts import tokenizer

#: Characters that no engine takes for white space: between two of them a single blank starts a token.
SOLID = "!-~¡-ᙿ、-퟿"
BLANK = re.compile(f"(?<=[{SOLID}]) (?=[{SOLID}])")
SOLID_ENDS = re.compile(f"[{SOLID}](?:.*[{SOLID}])?", re.S)
SHARD = 100_000
FAN = 64
OPEN_BINS = 1024


class PartIds(Memo):
    """The ids, as little-endian unsigned 32-bit numbers, of a blank and a part; None if the part doesn't start and end solid.

    A byte-level tokenizer ends its token before a single blank between two solid characters and
    starts the next with it, so a part between such blanks has the same ids alone as in the text.
    Where the ids follow the order of merges, a table of ranks gives the same ids faster.
    """

    def __init__(self, path: str):
        super().__init__(lambda part: self.encode(" " + part) if SOLID_ENDS.fullmatch(part) else None, 700_000)
        self.tokenizer, self.ranks = tokenizer(path), ranks(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        if self.ranks and not any(x in text for x in self.special):
            return array("I", self.ranks.encode_ordinary(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def of(self, text: str) -> bytes:
        first, *parts = text.split(" ")
        if not parts:
            return self.encode(text)
        if SOLID_ENDS.fullmatch(first):
            try:
                return b"".join((self.encode(first), *map(self.__getitem__, parts)))
            except TypeError:  # a None: some blank doesn't stand between solid characters
                pass
        first, *parts = BLANK.split(text)
        return b"".join((self.encode(first), *(self[x] or self.encode(" " + x) for x in parts)))


def ranks(path: str):
    """A tiktoken encoding for a byte-level tokenizer whose merged tokens are numbered in merge order, else None."""
    import json

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    model, pre = said["model"], said["pre_tokenizer"] or {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", ())]
    if said["normalizer"] or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or [model["vocab"].get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    vocab = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(merges)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})


@lru_cache(maxsize=2)
def part_ids(path: str) -> PartIds:
    return PartIds(path)


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents over `capacity` ids are cut, the first piece takes the odd rest."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                out: list[tuple] = []
                for doc, text in zip(rows["doc_id"], rows["text"]):
                    ids = part_ids(path).of(text or "") + end
                    start, n = 0, len(ids) // 4
                    stop = n % capacity or capacity
                    piece = 0
                    while start < n:
                        out.append((doc, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                        start, stop, piece = stop, stop + capacity, piece + 1
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Online best fit with at most `most` open bins; a bit per free space says whether a bin has it.

    `add` gives the bins that close: full ones, and the fullest one when a new bin needs its place.
    """

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.bits, self.open, self.made = capacity, most, 0, 0, 0
        self.free: list[list[tuple[int, list]]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> tuple[int, list]:
        found = self.free[space].pop()
        if not self.free[space]:
            self.bits &= ~(1 << space)
        self.open -= 1
        return found

    def add(self, length: int, item: object) -> list[tuple[int, list]]:
        closed, fitting = [], self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number, items = self._take(space)
        else:
            if self.open >= self.most:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            space, (number, items) = self.capacity, (self.made, [])
            self.made += 1
        items.append((item, self.capacity - space))
        if space == length:
            closed.append((number, items))
        else:
            self.free[space - length].append((number, items))
            self.bits |= 1 << space - length
            self.open += 1
        return closed

    def rest(self) -> list[tuple[int, list]]:
        return [x for bins in self.free for x in bins]


def best_fit(items: DataFrame, shard: str, length: str, capacity: int, most: int, columns: list[str]) -> DataFrame:
    """`columns` of every item with sequence, offset and closed; each shard, sorted beforehand, is packed on its own."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now, schema = None, None, None

        def batch_of(bins: list, number: int, closed: bool) -> pa.RecordBatch:
            rows = [(*item, k, at, closed) for k, held in bins for item, at in held]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema)], [*columns, "sequence", "offset", "closed"])

        for batch in batches:
            schema = [*(batch.schema.field(c).type for c in columns), pa.int64(), pa.int64(), pa.bool_()]
            done, data = [], [batch.column(c).to_pylist() for c in columns]
            for which, n, *item in zip(batch.column(shard).to_pylist(), batch.column(length).to_pylist(), *data):
                if which != now:
                    if done:
                        yield batch_of(done, now, True)
                        done = []
                    if state and state.open:
                        yield batch_of(state.rest(), now, False)
                    state, now = BestFit(capacity, most), which
                done += state.add(n, item)
            if done:
                yield batch_of(done, now, True)
        if state and state.open:
            yield batch_of(state.rest(), now, False)

    kinds = {f.name: f.dataType.simpleString() for f in items.schema}
    return map_arrow(items, pack, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", sequence long, offset long, closed boolean")


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, open_bins: int = OPEN_BINS, shard_size: int = SHARD, fan: int = FAN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces are dealt by hash to shards of about `shard_size`, each packed by online best fit with
    `open_bins` open bins; what is open at a shard's end is packed again, `fan` shards together, as
    if a bin were a piece. Every part of a sequence starts where the one before ends.
    A null text counts as empty: one piece with the end id alone. Repeated rows are packed each; a
    null doc_id stays null; an empty table gives no rows; other columns are ignored.
    """
    pieces = staged(token_pieces(docs, path, capacity, end_id), "pieces")
    shards = max(1, -(-pieces.count() // shard_size))
    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.withColumn("mixed", mixed).withColumn("shard", F.pmod("mixed", F.lit(shards)))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "shard"]
    first = staged(best_fit(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "mixed", "doc_id", "piece"), "shard", "length", capacity, open_bins, columns).withColumnRenamed("sequence", "bin"), "packed")
    left = first.where("not closed").groupBy("shard", "bin").agg(F.sum("length").alias("fill")).withColumn("outer", F.expr(f"shard div {fan}"))
    outer = best_fit(
        left.repartition(-(-shards // fan), "outer").sortWithinPartitions("outer", F.xxhash64("shard", "bin"), "shard", "bin"),
        "outer", "fill", capacity, open_bins * fan, ["shard", "bin", "outer"],
    ).withColumnRenamed("offset", "base").drop("closed")
    plain = columns[:-1]
    whole = first.where("closed").select(*plain, F.expr("shard * 4294967296 + bin").alias("sequence_id"), "offset")
    joined = first.where("not closed").join(outer, ["shard", "bin"]).select(*plain, F.expr("4611686018427387904 + outer * 4294967296 + sequence").alias("sequence_id"), (F.col("base") + F.col("offset")).alias("offset"))
    return whole.unionByName(joined)
