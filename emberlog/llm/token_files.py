"""Token ids as entropy-coded files: a static range asymmetric numeral system over shared frequency tables.

A folder holds `table` (id, frequency) and `blocks`, Parquet whose rows are independent blocks in the
order of the ids. A block interleaves many lanes, so numpy codes a step of all lanes at once; it
carries the lanes' states at checkpoints, a checksum of itself and one of its ids, and decodes without
any other block.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlog.llm.common import Memo, cuts, map_arrow, staged, unstaged
from emberlog.llm.token_counts import tokenizer

#: Ids of a piece of a document, of a block (the piece that fills it may go beyond) and between checkpoints of a block.
PIECE, BLOCK, CHECKPOINT = 1 << 14, 1 << 20, 1 << 19
LANES = 2048
LOW = 1 << 31
HEAD = struct.Struct("<4sBBHIIIHII")  # magic, version, bits, lanes, ids, words, steps between checkpoints, checkpoints, crc32 of table, crc32 of ids
MAGIC = b"rANS"


class Table:
    """Frequencies of the ids that occur, scaled to sum 2^bits with at least 1 each; `slots` maps a slot to its id's place."""

    def __init__(self, ids: list[int], frequencies: list[int]):
        order = np.argsort(np.asarray(ids, dtype=np.int64))
        self.ids = np.asarray(ids, dtype=np.uint32)[order]
        self.freq = np.asarray(frequencies, dtype=np.uint64)[order]
        total = int(self.freq.sum())
        self.bits = max(total.bit_length() - 1, 0)
        if total and total != 1 << self.bits:
            raise ValueError("frequencies do not sum to a power of two")
        self.start = np.cumsum(self.freq) - self.freq
        self.crc = zlib.crc32(self.ids.tobytes() + self.freq.astype("<u4").tobytes())

    @classmethod
    def of_counts(cls, ids: list[int], counts: list[int]) -> Table:
        """Every id gets 1 and its share of the rest; what rounding leaves goes to the most frequent one."""
        if not ids:
            return cls([], [])
        bits = max(20, (len(ids) - 1).bit_length() + 2)
        rest, total = (1 << bits) - len(ids), sum(counts)
        freq = [1 + n * rest // total for n in counts]
        freq[max(range(len(ids)), key=lambda k: (counts[k], -ids[k]))] += (1 << bits) - sum(freq)
        return cls(ids, freq)

    @property
    def slots(self) -> np.ndarray:
        if not hasattr(self, "_slots"):
            self._slots = np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def places(self, ids: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_place"):
            self._place = np.full(int(self.ids[-1]) + 1, -1, dtype=np.int64)
            self._place[self.ids] = np.arange(len(self.ids))
        return self._place[ids]


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, checkpoint: int = CHECKPOINT) -> bytes:
    """The bytes of one block. Id k belongs to lane k % lanes; lanes are fewer in short blocks, whose states would outweigh them."""
    n = len(ids)
    lanes = max(1, min(lanes, n >> 6))
    steps, every = -(-n // lanes), max(1, checkpoint // lanes)
    place = table.places(ids) if n else np.empty(0, dtype=np.int64)
    freq, start = table.freq[place], table.start[place]
    shift, down, limit = np.uint64(table.bits), np.uint64(32), np.uint64(63 - table.bits)
    state = np.full(lanes, LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, bytes]] = []
    told = 0
    for step in reversed(range(steps)):
        f, at = freq[step * lanes : (step + 1) * lanes], start[step * lanes : (step + 1) * lanes]
        x = state[: len(f)]
        over = x >= f << limit
        if over.any():
            words.append(x[over].astype("<u4"))
            told += len(words[-1])
            x = np.where(over, x >> down, x)
        q = x // f
        state[: len(f)] = (q << shift) + (x - q * f) + at
        if step and step % every == 0:
            marks.append((step, told, state.tobytes()))
    marks.reverse()
    head = HEAD.pack(MAGIC, 1, table.bits, lanes, n, told, every, len(marks), table.crc, zlib.crc32(ids.astype("<u4").tobytes()))
    saved = b"".join(struct.pack("<II", step, told - left) + x for step, left, x in marks)
    body = head + state.tobytes() + saved + b"".join(w.tobytes() for w in reversed(words))
    return body + zlib.crc32(body).to_bytes(4, "little")


def decode_block(data: bytes, table: Table, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids [first, stop) of a block as unsigned 32-bit numbers, read from the last checkpoint before `first` on."""
    magic, version, bits, lanes, n, told, every, n_marks, crc, ids_crc = HEAD.unpack_from(data)
    if magic != MAGIC or version != 1 or zlib.crc32(data[:-4]) != int.from_bytes(data[-4:], "little"):
        raise ValueError("block is damaged")
    if crc != table.crc:
        raise ValueError("block was written with another table")
    stop = n if stop is None else min(stop, n)
    state = np.frombuffer(data, "<u8", lanes, HEAD.size).astype(np.uint64)
    marks_at, mark = HEAD.size + 8 * lanes, 8 + 8 * lanes
    words = np.frombuffer(data, "<u4", told, marks_at + n_marks * mark).astype(np.uint64)
    step, at = 0, 0
    k = min(first // lanes // every, n_marks)
    if k:
        step, at = struct.unpack_from("<II", data, marks_at + (k - 1) * mark)
        state = np.frombuffer(data, "<u8", lanes, marks_at + (k - 1) * mark + 8).astype(np.uint64)
    base, last = step * lanes, -(-stop // lanes)
    slots, freq, start = table.slots, table.freq, table.start
    shift, up, mask, low = np.uint64(bits), np.uint64(32), np.uint64((1 << bits) - 1), np.uint64(LOW)
    places = np.empty(max(0, last - step) * lanes, dtype=np.uint32)
    for s in range(step, last):
        m = min(lanes, n - s * lanes)
        x = state[:m]
        slot = x & mask
        place = slots[slot]
        places[(s - step) * lanes : (s - step) * lanes + m] = place
        x = freq[place] * (x >> shift) + slot - start[place]
        under = np.flatnonzero(x < low)
        if len(under):
            x[under] = (x[under] << up) | words[at : at + len(under)]
            at += len(under)
        state[:m] = x
    ids = table.ids[places[max(first - base, 0) : max(stop - base, 0)]]
    if first == 0 and stop == n and zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("ids differ from those that were written")
    return ids


def crc32_joined(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings in a row from the crc32 of each and the length of the second."""
    return _times(_power(length), first) ^ second


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo that of crc32, bit 31 being the constant term."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return product


@lru_cache(maxsize=4096)
def _power(length: int) -> int:
    """x to the power 8 * length."""
    square, result = 1 << 23, 1 << 31
    while length:
        if length & 1:
            result = _times(square, result)
        square, length = _times(square, square), length >> 1
    return result


#: Tokenizers of this form drop white space, lower the letters and cut the text by this pattern.
PLAIN_FORM = ("NFC", "Replace", "Lowercase"), r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE, LETTERS = r"\t-\r ", "a-zß-öø-ÿ"
#: Neither letters nor numbers nor white space; no character here or above changes in NFC when none but these are around.
SIGNS = r"!-/:-@\[-`{-~¡£§«°»¿–—‘-‚“-„•…€"
PLAIN = f"{LETTERS}A-ZÀ-ÖØ-Þ0-9{SIGNS}"
#: What PLAIN_FORM cuts off letters, in lower case, where a text has none but plain characters and white space.
CUTS = f"'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[{SIGNS}]+"
RUNS = re.compile(f"[{LETTERS}]+|{CUTS}")
ODD = f"[^{PLAIN}{WHITE}]"
#: Bytes of text whose ids are made at once.
SLICE = 1 << 22


class Recent(Memo):
    """A memo that, when full, sets its values aside and takes back those asked for again, so frequent keys are made once."""

    aside: dict = {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.aside = dict(self)
            self.clear()
        value = self.aside.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class TextIds:
    """Ids of texts, as unsigned numbers of `width` bytes.

    Words between white space have the same ids in every text. Where the tokenizer has the known form, plain
    texts are lowered and cut by its pattern in Arrow, each distinct run of letters or signs of a slice is looked
    up once, and numpy puts the ids in place. Other texts are cut into words, and those with an odd character go to the library.
    """

    def __init__(self, path: str, width: int):
        self.tokenizer, self.type, self.kind = tokenizer(path), np.dtype(f"<u{width}"), {2: "H", 4: "I"}[width]
        self.model = self.tokenizer.model
        self.odd = "|".join([ODD, *(re.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values())])
        self.has_odd = re.compile(self.odd).search
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        normal, pre = said["normalizer"] or {}, said["pre_tokenizer"] or {}
        form = tuple(x["type"] for x in normal.get("normalizers", ())), (pre.get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self.plain = form == PLAIN_FORM and said["model"]["type"] == "BPE"
        signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {b: chr(b) for b in signs} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in signs)}
        self.runs, self.words = Recent(self.of_run, 400_000), Recent(self.of_word, 200_000)

    def of_word(self, word: str) -> bytes:
        if self.plain and not self.has_odd(word):
            return b"".join(map(self.runs.__getitem__, RUNS.findall(word.lower())))
        return array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def of_run(self, run: str) -> bytes:
        known = run if run.isascii() else "".join(map(self.byte.__getitem__, run.encode()))
        return array(self.kind, [t.id for t in self.model.tokenize(known)]).tobytes()

    def of_parts(self, texts: pa.Array, known: Recent) -> list[np.ndarray]:
        """Ids of texts as those of their parts between white space, which `known` gives."""
        parts = pc.ascii_split_whitespace(texts)
        found = parts.flatten().dictionary_encode()
        each = list(map(known.__getitem__, found.dictionary.to_numpy(zero_copy_only=False)))
        ids = np.frombuffer(b"".join(each), self.type)
        lengths = np.fromiter(map(len, each), np.int64, len(each)) // self.type.itemsize
        starts, at = np.cumsum(lengths) - lengths, found.indices.to_numpy()
        n = lengths[at]
        ends = np.cumsum(n)
        places = np.repeat(starts[at] - ends + n, n)
        places += np.arange(len(places))
        stops = np.concatenate([[0], ends])[np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]
        return np.split(ids[places], stops[:-1])

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False) if self.plain else np.ones(len(texts), dtype=bool)
        apart = pc.replace_substring_regex(pc.utf8_lower(texts.filter(pa.array(~odd))), CUTS, r" \0 ")
        plain = iter(self.of_parts(apart, self.runs) if len(apart) else ())
        other = iter(self.of_parts(texts.filter(pa.array(odd)), self.words) if odd.any() else ())
        return [next(other if x else plain) for x in odd]


@lru_cache(maxsize=2)
def text_ids(path: str, width: int) -> TextIds:
    return TextIds(path, width)


def id_pieces(docs: DataFrame, path: str, end_id: int, width: int, piece: int = PIECE) -> DataFrame:
    """(doc_id, tie, row, piece, pieces, ids): the ids of each document and the end id, at most `piece` of them in a row."""
    end, size = end_id.to_bytes(width, "little"), piece * width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in cuts(batch, "text", SLICE):
                out: list[tuple] = []
                found = text_ids(path, width).of(rows.column("text"))
                for doc, tie, row, some in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "tie", "row")), found):
                    ids = some.tobytes() + end
                    n = -(-len(ids) // size)
                    out.extend((doc, tie, row, k, n, ids[k * size : (k + 1) * size]) for k in range(n))
                columns = list(zip(*out)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    ["doc_id", "tie", "row", "piece", "pieces", "ids"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.monotonically_increasing_id().alias("row"))
    return map_arrow(rows, cut, f"doc_id {kind}, tie long, row long, piece int, pieces int, ids binary")


def id_counts(pieces: DataFrame, width: int) -> DataFrame:
    """(id, n), counted in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                found = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width}"))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), dtype=np.int64)])
                total[: len(found)] += found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["id", "n"])

    return map_arrow(pieces.select("ids"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def blocks_of(pieces: DataFrame, table: Table, width: int, block: int, lanes: int, checkpoint: int) -> DataFrame:
    """Pieces in ascending order as blocks: one row each with its part, number, ids before it in the part, and the pieces inside."""
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, held, count, kinds = TaskContext.get().partitionId(), 0, 0, [], 0, None

        def made() -> pa.RecordBatch:
            ids = np.concatenate([np.frombuffer(x[-1], f"<u{width}") for x in held])
            docs, rows, places, of, parts = zip(*held)
            values = [[part], [number], [before], [len(ids)], [docs], [rows], [places], [of], [[len(x) // width for x in parts]], [encode_block(ids, table, lanes, checkpoint)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(kinds), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], ["part", "block", "before", "n_ids", "docs", "rows", "places", "of", "lengths", "data"])

        for batch in batches:
            kinds = batch.schema.field("doc_id").type
            for item in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "piece", "pieces", "ids"))):
                held.append(item)
                count += len(item[-1]) // width
                if count >= block:
                    yield made()
                    number, before, held, count = number + 1, before + count, [], 0
        if held:
            yield made()

    ordered = pieces.repartitionByRange("doc_id", "tie", "row", "piece").sortWithinPartitions("doc_id", "tie", "row", "piece")
    schema = f"part int, block int, before long, n_ids long, docs array<{kind}>, rows array<long>, places array<int>, of array<int>, lengths array<int>, data binary"
    return map_arrow(ordered.select("doc_id", "row", "piece", "pieces", "ids"), pack, schema)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int, piece: int = PIECE, block: int = BLOCK, lanes: int = LANES, checkpoint: int = CHECKPOINT) -> None:
    """Writes the ids of all documents, each followed by `end_id`, into `folder` in ascending order of doc_id.

    `path` is a file for the library tokenizers whose pre-tokenizer drops white space. Null ids come first; rows with one id are
    ordered by a hash of their text, equal rows stay and follow each other. A null text counts as empty, an empty
    table leaves an empty table and no blocks, other columns are ignored. Texts of any length are cut
    into pieces of `piece` ids, so a block never holds more than `block + piece` ids. Only the
    counts of ids, at most one per entry of the vocabulary, reach the driver.
    """
    width = 2 if max(tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    pieces = staged(id_pieces(docs, path, end_id, width, piece), "token-ids")
    counts = id_counts(pieces, width).orderBy("id").collect()
    table = Table.of_counts([r["id"] for r in counts], [r["n"] for r in counts])
    spark = docs.sparkSession
    known = pa.table({"id": pa.array(table.ids.astype(np.int64)), "frequency": pa.array(table.freq.astype(np.int64))})
    spark.createDataFrame(known.to_pandas(), "id long, frequency long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/table")
    blocks_of(pieces, table, width, block, lanes, checkpoint).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{folder}/blocks")
    unstaged(pieces)


def _read(spark: SparkSession, folder: str) -> tuple[Table, DataFrame]:
    rows = spark.read.parquet(f"{folder}/table").collect()  # at most one per entry of the vocabulary
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row per part: the ids in the parts before it.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return Table([r["id"] for r in rows], [r["frequency"] for r in rows]), blocks.join(base, "part")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its ids as unsigned 32-bit little-endian).

    Every block is decoded and checked on its own; documents cut into several pieces are put together from
    the checksums of their pieces, so no task holds a whole document.
    """
    table, blocks = _read(spark, folder)
    kind = blocks.schema["docs"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                at = {c: batch.column(c)[k].as_py() for c in ("base", "before", "docs", "rows", "places", "of", "lengths")}
                ids = memoryview(decode_block(batch.column("data")[k].as_py(), table).astype("<u4").tobytes())
                ends = np.cumsum(at["lengths"])
                starts = ends - at["lengths"]
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, ends)]
                kinds = batch.schema.field("docs").type.value_type
                columns = (at["docs"], kinds), (at["rows"], pa.int64()), (at["places"], pa.int32()), (at["of"], pa.int32()), (starts + at["base"] + at["before"], pa.int64()), (at["lengths"], pa.int64()), (crcs, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], ["doc_id", "row", "piece", "pieces", "start", "n_tokens", "ids_crc32"])

    pieces = map_arrow(blocks.select("base", "before", "docs", "rows", "places", "of", "lengths", "data"), decode, f"doc_id {kind}, row long, piece int, pieces int, start long, n_tokens long, ids_crc32 long")
    pieces = staged(pieces, "token-pieces")
    whole = pieces.where("pieces = 1").select("doc_id", "start", "n_tokens", "ids_crc32")

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = batch.to_pydict(), []
            for parts in rows["parts"]:
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = crc32_joined(crc, p["crc"], 4 * p["n"])
                out.append(crc)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(out, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = F.sort_array(F.collect_list(F.struct("piece", F.col("n_tokens").alias("n"), F.col("ids_crc32").alias("crc"))))
    cut = (
        pieces.where("pieces > 1").groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), parts.alias("parts"))
        .drop("row")
    )
    return whole.unionByName(map_arrow(cut, put_together, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"))


def read_ids(spark: SparkSession, folder: str, first: int, stop: int) -> DataFrame:
    """(at, ids): ids [first, stop) of all that is in the folder, one row per block touched, each decoded from its nearest checkpoint."""
    table, blocks = _read(spark, folder)
    start = F.col("base") + F.col("before")
    touched = blocks.select(start.alias("start"), "n_ids", "data").where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > first))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column("start").to_pylist(), batch.column("data").to_pylist()):
                ids = decode_block(data, table, max(0, first - at), stop - at)
                yield pa.RecordBatch.from_arrays([pa.array([max(first, at)], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["at", "ids"])

    return map_arrow(touched.select("start", "data"), decode, "at long, ids array<long>")
