"""Near duplicates: an exact Jaccard join of word shingles, pruned by an R-tree over count vectors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from emberlog.llm.common import map_arrow, slices, staged, text_key, unstaged

WORDS = 5
#: Links from NUMERATOR / DENOMINATOR of the union on.
NUMERATOR, DENOMINATOR = 3, 4
#: Coordinates of a count vector.
GROUPS = 128
#: Counts from here on are cut to this and bound nothing.
MOST = 32000
#: Finer groups, of whose counts only the last bit is kept.
FINE = 1024
#: Counters of the frequency sketch, and in a segment of it; slots of a bit array of sets.
COUNTERS, SEGMENT, SLOTS = 1 << 27, 1 << 16, 1 << 22
#: Parts that the sketch reaches the driver in, each about a megabyte at most.
FETCHES = 32
#: A fine counter is kept as one of four classes, up to these counts and above; coarse ones tell how far above.
CLASSES, COARSE = (1, 8, 64), 1 << 20
#: First sets of its blocks that a set is verified against before the tree looks for the rest.
STARS = 3
#: Nearest sets of each tile that are verified first, so that most components are whole before all are asked.
NEAREST = 2
#: Rows of a block or tile that are compared in one task.
TILE = 1000
MOST_SALTS = 1 << 20
FAN = 16
#: Bytes to random odd numbers, and the base of the rolling hash with its inverse modulo 2 ** 64.
BYTES = np.random.default_rng(20240131).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
#: Words that are hashed at once.
STRETCH = 1 << 18


class Powers:
    """BASE ** k and its inverse for k up to what was asked for so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 17)
            self.up, self.down = (np.concatenate(([np.uint64(1)], np.multiply.accumulate(np.full(size, b, np.uint64)))) for b in (BASE, INVERSE))
        return self.up[:n], self.down[:n]


def run_hashes(words: list[bytes], width: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of every run of `width` words, joined by blanks: a polynomial by differences of running sums.

    It doesn't depend on where a run stands.
    """
    data = np.frombuffer(b" ".join(words), np.uint8)
    up, down = powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * up[:-1], out=sums[1:])
    blanks = np.flatnonzero(data == 32)
    starts, ends = np.r_[0, blanks + 1], np.r_[blanks, len(data)]
    first = starts[: len(words) - width + 1]
    h = (sums[ends[width - 1 :]] - sums[first]) * down[first]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[str | None], powers: Powers, size: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct runs of `size` words; of the whole sequence if it is shorter.

    Texts are hashed together; a very long one goes by itself, stretch by stretch.
    """
    sets: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    words: list[bytes] = []
    of: list[tuple[int, int]] = []  # which text, and where its words start
    for k, text in enumerate(texts):
        own = text.encode().lower().split() if text else []  # bytes: A-Z alone change, and ASCII white space alone splits
        if len(own) > STRETCH:
            runs = [run_hashes(own[i : i + STRETCH + size - 1], size, powers) for i in range(0, len(own) - size + 1, STRETCH)]
            sets[k] = np.unique(np.concatenate(runs))
        elif len(own) >= size:
            of.append((k, len(words)))
            words += own
        elif own:
            sets[k] = run_hashes(own, len(own), powers)
    if of:
        starts = np.array([at for _, at in of])
        owner = np.repeat(np.arange(len(of)), np.diff(np.r_[starts, len(words)]))
        h = run_hashes(words, size, powers)
        inside = owner[: len(h)] == owner[size - 1 :]
        h, owner = h[inside], owner[: len(h)][inside]
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
        h, owner = h[new], owner[new]
        for (k, _), part in zip(of, np.split(h, np.searchsorted(owner, np.arange(1, len(of))))):
            sets[k] = part
    return sets


def set_name(shingles: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(shingles.tobytes()), ">i8")[0]) if len(shingles) else 0


def count_vector(shingles: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((shingles >> np.uint64(57)).astype(np.int64), minlength=GROUPS), MOST).astype(np.int16)


def odd_groups(shingles: np.ndarray) -> np.ndarray:
    """A bit per finer group, set if its count is odd. Where two sets' bits differ, at least one shingle is in one set alone."""
    counts = np.bincount((shingles >> np.uint64(40)).astype(np.int64) & (FINE - 1), minlength=FINE)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def profiles(docs: DataFrame, size: int) -> DataFrame:
    """Two sorts of rows: (id, text_key, set, n) per document, and (segment, slots, counts) of the task's frequency sketch."""
    names_of = ["id", "text_key", "set", "n", "segment", "slots", "counts"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, kept, held = Powers(), [], 0
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        id_kind = None

        def counted() -> pa.RecordBatch:
            """The counters of what is held, a row per segment: slots, and a byte each; a slot stands again for each further 255."""
            slots, times = np.unique(np.concatenate(kept), return_counts=True)
            again = -(-times // 255)
            first = np.r_[True, np.repeat(slots, again)[1:] != np.repeat(slots, again)[:-1]]
            value = np.where(first, np.repeat((times - 1) % 255 + 1, again), 255).astype(np.uint8)
            slots = np.repeat(slots, again)
            edges = np.searchsorted(slots, np.arange(0, COUNTERS + 1, SEGMENT))
            rows = [(k, slots[i:j].astype(np.uint16).tobytes(), value[i:j].tobytes()) for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
            none = [None] * len(rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((none, none, none, none, *zip(*rows)), (id_kind, *kinds))], names_of)

        for batch in batches:
            id_kind = batch.schema.field("id").type
            for rows in slices(batch, "text"):
                sets = shingle_sets(rows["text"], powers, size)
                for s in sets:
                    kept.append((s & np.uint64(COUNTERS - 1)).astype(np.uint32))
                    held += len(s)
                if held > 4_000_000:
                    yield counted()
                    kept.clear()
                    held = 0
                none = [None] * len(sets)
                columns = (rows["id"], rows["text_key"], list(map(set_name, sets)), list(map(len, sets)), none, none, none)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (id_kind, *kinds))], names_of)
        if held:
            yield counted()

    kind = docs.schema["id"].dataType.simpleString()
    return map_arrow(docs, read, f"id {kind}, text_key long, set long, n long, segment int, slots binary, counts binary")


def to_code(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes: exact under 128, then eight steps per doubling, rounded up so that no count gets lower."""
    big = np.maximum(counts, 128).astype(np.float64)
    return np.where(counts < 128, counts, np.minimum(255, 128 + np.ceil(8 * np.log2(big / 128)))).astype(np.uint8)


#: At least the count that a code stands for; the last stands for all that is higher.
OF_CODE = np.array([*range(128), *(int(np.ceil(128 * 2 ** (k / 8))) for k in range(127)), 1 << 40], dtype=np.int64)


class Sketch:
    """For a shingle, a class of how many documents have it and a count that isn't too low; of a fixed size.

    Fine counters tell rare shingles apart, two bits each; a coarse one has the highest code of all
    fine counters that share it, and says how often common ones are.
    """

    def __init__(self):
        # a bytearray is pickled without a copy
        self.bits, self.coarse = bytearray(COUNTERS // 4), np.zeros(COARSE, np.uint8)

    @property
    def fine(self) -> np.ndarray:
        return np.frombuffer(self.bits, np.uint8)

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = (shingles & np.uint64(COUNTERS - 1)).astype(np.int64)
        classes = self.fine[slots >> 2] >> (2 * (slots & 3)).astype(np.uint8) & 3
        codes = self.coarse[slots & (COARSE - 1)]
        counts = np.where(classes < 3, np.array([*CLASSES, 0], np.int64)[classes], OF_CODE[codes])
        return classes.astype(np.int64) << 8 | np.where(classes < 3, 0, codes), counts


def frequency_sketch(rows: DataFrame) -> Sketch:
    """The counters of all tasks added up, segment by segment."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(SEGMENT, np.int64)

        def told() -> pa.RecordBatch:
            classes = np.searchsorted(CLASSES, total).astype(np.uint8).reshape(-1, 4)
            fine = classes[:, 0] | classes[:, 1] << 2 | classes[:, 2] << 4 | classes[:, 3] << 6
            common = np.flatnonzero(total > CLASSES[-1])
            columns = ([now], [zlib.compress(fine.astype(np.uint8).tobytes(), 1)], [common.astype(np.uint16).tobytes()], [to_code(total[common]).tobytes()])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["segment", "fine", "common", "codes"])

        for batch in batches:
            for segment, slots, counts in zip(*(batch.column(c).to_pylist() for c in ("segment", "slots", "counts"))):
                if segment != now:
                    if now is not None:
                        yield told()
                    now, total = segment, np.zeros(SEGMENT, np.int64)
                total += np.bincount(np.frombuffer(slots, np.uint16), np.frombuffer(counts, np.uint8), SEGMENT).astype(np.int64)
        if now is not None:
            yield told()

    parts = rows.where("segment is not null").select("segment", "slots", "counts").repartition("segment").sortWithinPartitions("segment")
    # added up by all tasks at once, then fetched a partition at a time; their number stands, as a small table would come as a single one
    done = staged(map_arrow(parts, add, "segment int, fine binary, common binary, codes binary"), "segments", narrow=True)
    sketch = Sketch()
    for segment, fine, common, codes in done.repartition(FETCHES, "segment").toLocalIterator():
        sketch.bits[segment * SEGMENT // 4 : (segment + 1) * SEGMENT // 4] = zlib.decompress(fine)
        at = (segment * SEGMENT + np.frombuffer(common, np.uint16).astype(np.int64)) & (COARSE - 1)
        np.maximum.at(sketch.coarse, at, np.frombuffer(codes, np.uint8))
    unstaged(done)
    return sketch


def prefixes(docs: DataFrame, shared: Broadcast[Sketch], size: int, tile: int) -> DataFrame:
    """(shingle, salts, salt, set, n, most): the rarest shingles of each set, of which linked sets share at least one.

    Any order of shingles that is the same for all sets does; rare ones come first, by the sketch.
    Linked sets share 3/4 of the larger, so the first quarter and one are enough. The sketch never
    counts too low: a count of one means that no other set has the shingle, and `salts` parts hold
    about `tile` sets each at most. `most` is the size of the largest set that may link with this one
    if the shingle is the first in that order that both have: all they share is from there on.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = Powers(), set()
        for batch in batches:
            for rows in slices(batch, "text"):
                out: list[list[np.ndarray]] = [[], [], [], [], [], []]
                for s in shingle_sets(rows["text"], powers, size):
                    name = set_name(s)
                    if not len(s) or name in seen:
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(name)
                    ranks, counts = shared.value.of(s)
                    first = np.argsort(ranks, kind="stable")[: len(s) - -(-NUMERATOR * len(s) // DENOMINATOR) + 1]
                    place = np.flatnonzero(counts[first] > 1)
                    first, most = first[place], ((NUMERATOR + DENOMINATOR) * (len(s) - place) - NUMERATOR * len(s)) // NUMERATOR
                    salts = np.minimum(-(-counts[first] // tile), MOST_SALTS)
                    for column, values in zip(out, (s[first].view(np.int64), salts, name % salts, np.full(len(first), name), np.full(len(first), len(s)), most)):
                        column.append(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], ["shingle", "salts", "salt", "set", "n", "most"])

    return map_arrow(docs.select("text"), read, "shingle long, salts long, salt long, set long, n long, most long")


def slot_bits(slots: DataFrame) -> np.ndarray:
    """A bit array of fixed size with the bits in column `slot` set."""
    table = np.zeros(SLOTS // 64, np.int64)
    for word, bits in slots.groupBy(F.expr("slot div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")).collect():
        table[word] = bits
    return table.view(np.uint8)


def candidate_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(set, n, vector, odd, shingles) of every set in `wanted` (set, id), read from one document each where ids are distinct.

    A bit array of fixed size says which to build; it lets some others through, copies of one text
    without an id among them. Users make the rows distinct by set.
    """
    slot = lambda name, id: F.crc32(F.concat_ws(":", F.coalesce(id.cast("string"), F.lit("")), name.cast("string")).cast("binary")) % SLOTS
    shared = docs.sparkSession.sparkContext.broadcast(slot_bits(wanted.select(slot(F.col("set"), F.col("id")).alias("slot"))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for rows in slices(batch, "text"):
                out = []
                for id, s in zip(rows["id"], shingle_sets(rows["text"], powers, size)):
                    name = set_name(s)
                    k = zlib.crc32(f"{'' if id is None else id}:{name}".encode()) % SLOTS
                    if len(s) and shared.value[k >> 3] >> (k & 7) & 1:
                        out.append((name, len(s), count_vector(s), odd_groups(s), s.view(np.int64)))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int16()), pa.list_(pa.int64()), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["set", "n", "vector", "odd", "shingles"])

    return map_arrow(docs.select("id", "text"), read, "set long, n long, vector array<smallint>, odd array<long>, shingles array<long>")


def needed(shared: Column, total: Column) -> Column:
    return (NUMERATOR + DENOMINATOR) * shared >= NUMERATOR * total


def may_link(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes, then sums of coordinate minima, then finer groups odd in one set alone, allow a link."""
    a, b = vectors.toDF("a", "n_a", "v_a", "o_a"), vectors.toDF("b", "n_b", "v_b", "o_b")
    both = pairs.join(a, "a").join(b, "b").withColumn("total", F.col("n_a") + F.col("n_b"))
    bound = F.aggregate(F.zip_with("v_a", "v_b", lambda x, y: F.when(F.least(x, y) >= MOST, 1 << 24).otherwise(F.least(x, y).cast("int"))), F.lit(0), lambda t, x: t + x)
    differ = F.aggregate(F.zip_with("o_a", "o_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    fits = needed(bound, F.col("total")) & needed(F.col("total") - differ, 2 * F.col("total"))
    return both.where(F.when(needed(F.least("n_a", "n_b"), F.col("total")), fits).otherwise(F.lit(False))).select("a", "b", "total")


def sets_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(set, shingles) of the sets in `pairs` (a, b), and of some others that their bit array lets through."""
    slots = pairs.select(F.explode(F.array("a", "b")).alias("set")).select(F.expr(f"set & {SLOTS - 1}").alias("slot"))
    shared = sets.sparkSession.sparkContext.broadcast(slot_bits(slots))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column("set").to_numpy() & (SLOTS - 1)
            yield batch.filter(pa.array((shared.value[k >> 3] >> (k & 7).astype(np.uint8) & 1).astype(bool)))

    return map_arrow(sets.select("set", "shingles"), read, "set long, shingles array<long>")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, total) that link, by the sets themselves; sets in no pair aren't dealt out."""
    pairs = staged(pairs, "pairs", narrow=True)
    # by the exchange that the joins need anyway, copies of a set become one row
    one = sets_of(pairs, sets).groupBy("set").agg(F.first("shingles").alias("shingles"))
    both = pairs.join(one.toDF("a", "s_a"), "a").join(one.toDF("b", "s_b"), "b")
    return both.where(needed(F.size(F.array_intersect("s_a", "s_b")), F.col("total"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node that links (a, b) reach. Labels sink along links and jump to their own label's label."""
    edges = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges", narrow=True)
    labels = staged(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels", narrow=True)
    while True:
        near = edges.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near")).toDF("node", "near")
        lower = labels.join(near, "node").select("node", F.least("root", "near").alias("lower"), "root")
        jump = labels.toDF("lower", "jump")
        moved = lower.join(jump, "lower", "left").select("node", F.least("lower", F.coalesce("jump", "lower")).alias("root"), F.col("root").alias("was"))
        # counted while it is written
        changes = Observation()
        labels = staged(moved.observe(changes, F.count_if(F.col("root") != F.col("was")).alias("n")).select("node", "root"), "labels", narrow=True)
        if not changes.get["n"]:
            return labels


class CountTree:
    """A packed R-tree over count vectors. A node has the coordinate maxima and the size range of what is below it; points have their odd groups too."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, classes: np.ndarray, odd: np.ndarray):
        order = np.lexsort((vectors.argmax(axis=1), sizes))
        self.order, self.odd = order, odd[order].view(np.uint64)  # bits of signed numbers aren't counted as they stand
        level = (vectors[order], sizes[order], sizes[order], classes[order], classes[order])
        self.levels = [level]
        while len(level[1]) > 1:
            at = np.arange(0, len(level[1]), FAN)
            level = tuple(f.reduceat(x, at, axis=0) for f, x in zip((np.maximum, np.minimum, np.maximum, np.minimum, np.maximum), level))
            self.levels.append(level)

    def near(self, vector: np.ndarray, size: int, kind: int, odd: np.ndarray, top: int | None = None) -> np.ndarray:
        """Places of points of another class whose bound allows a link; the `top` with the highest share alone if given."""
        at = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            tops, least, most, low, high = (x[at] for x in self.levels[depth])
            fits = (DENOMINATOR * most >= NUMERATOR * size) & (NUMERATOR * least <= DENOMINATOR * size) & ((low != kind) | (high != kind))
            minima = np.minimum(tops, vector)
            bound = minima.sum(axis=1, dtype=np.int64) + (minima >= MOST).any(axis=1) * np.int64(1 << 24)
            fits &= (NUMERATOR + DENOMINATOR) * bound >= NUMERATOR * (size + least)
            at, bound = at[fits], bound[fits]
            if depth and len(at):
                at = (at[:, None] * FAN + np.arange(FAN)).ravel()
                at = at[at < len(self.levels[depth - 1][1])]
        total = size + self.levels[0][1][at]
        same = total - np.bitwise_count(self.odd[at] ^ odd.view(np.uint64)).sum(axis=1, dtype=np.int64)  # twice the overlap at most
        fits = (NUMERATOR + DENOMINATOR) * same >= 2 * NUMERATOR * total
        at, share = at[fits], same[fits] / total[fits]
        if top is not None and len(at) > top:
            at = at[np.argsort(-share, kind="stable")[:top]]
        return self.order[at]


def tile_pairs(rows: DataFrame, top: int | None) -> DataFrame:
    """(a, b): in each unit, pairs of an asking set and another of a different class that the tree lets through."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, told = None, [], set()

        def pairs_of() -> pa.RecordBatch:
            asks, sets, sizes, classes = (np.array(x) for x in zip(*((r[0], r[1], r[2], r[3]) for r in held)))
            vectors, odd = np.array([r[4] for r in held], np.int16), np.array([r[5] for r in held], np.int64)
            found = []
            if len(told) > 500_000:
                told.clear()
            if (~asks).any():
                kept = np.flatnonzero(~asks)
                tree = CountTree(vectors[kept], sizes[kept], classes[kept], odd[kept])
                for q in np.flatnonzero(asks):
                    own = int(sets[q])
                    for other in sets[kept[tree.near(vectors[q], int(sizes[q]), int(classes[q]), odd[q], top)]].tolist():
                        pair = (own, other) if own < other else (other, own)
                        if pair not in told:  # blocks of one task share many pairs
                            told.add(pair)
                            found.append(pair)
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shingle", "x", "y", "asks", "set", "n", "root", "vector", "odd")]
            for h, x, y, *row in zip(*columns):
                if (h, x, y) != now:
                    if held:
                        yield pairs_of()
                    now, held = (h, x, y), []
                held.append(row)
        if held:
            yield pairs_of()

    found = map_arrow(rows.repartition("shingle", "x", "y").sortWithinPartitions("shingle", "x", "y"), join, "a long, b long")
    return found.distinct()


def open_blocks(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of blocks whose sets aren't all connected yet, with the root of each; blocks with the same sets stand once."""
    named = blocks.select("shingle", "salts", "set").join(labels.toDF("set", "root"), "set", "left").select("shingle", "salts", "set", F.coalesce("root", "set").alias("root"))
    mixed = staged(named, "named", narrow=True)
    whole = mixed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.sum(F.xxhash64("set").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("size"))
    several = whole.where("low <> high").dropDuplicates(["sum", "size"]).select("shingle")
    inside = staged(mixed.join(several, "shingle"), "inside", narrow=True)
    unstaged(mixed)
    return inside


def remaining_pairs(inside: DataFrame, vectors: DataFrame, tile: int, top: int | None = None) -> DataFrame:
    """Candidate pairs of sets that share a prefix shingle but aren't connected yet, of `open_blocks`.

    In a block most sets are connected by now; the others ask all of it. Both sides are cut into
    tiles, and a tree over one tile answers the asking tile, with its `top` nearest alone if given.
    """
    main = inside.groupBy("shingle", "root").agg(F.count("*").alias("count")).groupBy("shingle").agg(F.max(F.struct("count", "root")).alias("m"), F.sum("count").alias("size"))
    tiles = main.select("shingle", F.col("m.root").alias("main"), F.expr(f"cast(ceil((size - m.count) / {tile}) as int)").alias("xs"), F.expr(f"cast(ceil(size / {tile}) as int)").alias("ys"))
    full = inside.join(staged(tiles, "tiles", narrow=True), "shingle").join(vectors, "set")
    x, y = F.pmod(F.xxhash64("set", F.lit(1)), F.col("xs")).cast("int"), F.pmod(F.xxhash64("set", F.lit(2)), F.col("ys")).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    same = ["set", "n", "root", "vector", "odd"]
    asking = full.where("root <> main").select("shingle", x.alias("x"), upto("ys").alias("y"), F.lit(True).alias("asks"), *same)
    asked = full.select("shingle", upto("xs").alias("x"), y.alias("y"), F.lit(False).alias("asks"), *same)
    return tile_pairs(asking.unionByName(asked), top)


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, root) with components that further links (a, b) join."""
    root = lambda side: labels.toDF(side, f"root_{side}")
    between = links.join(root("a"), "a", "left").join(root("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a <> b")
    over = components(between)
    risen = labels.join(over.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return staged(risen.unionByName(over.join(labels.select("node"), "node", "left_anti").select("node", "root")), "roots", narrow=True)


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = WORDS, tile: int = TILE) -> DataFrame:
    """One row per document: id, n_shingles, component_id, set (the name of its shingle set); see `grouped`."""
    return grouped(docs, text, id, size, tile).select(F.col("id").alias(id), "n_shingles", "component_id", "set")


def grouped(docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = WORDS, tile: int = TILE) -> DataFrame:
    """One row per document: id, text_key, n_shingles, component_id, set, root (the name of a set, one per component).

    Documents link when their sets of distinct `size`-word shingles share 3/4 of their union or more;
    component_id is the smallest id that links reach. All links between different sets that could
    join two components are found; equal sets are one set from the start.

    1. Each set gets a 64-bit name; a sketch of fixed size counts shingles over all documents.
    2. Blocks of sets that share one of their rarest quarter of shingles: no link lies outside.
    3. Each set is verified against the first sets of its blocks that it meets most, and components taken.
    4. Sets of a block that aren't in its main component ask a count-vector R-tree over the block,
       whose nodes are bounded by sums of coordinate minima and whose points by the parity of finer
       groups as well; surviving pairs are verified. The nearest alone go first, which joins most components, then all that is left.
    Blocks are salted by the sketch, hot ones cut into tiles; nothing is kept on one machine, and
    only fixed-size arrays reach the driver.

    Null and empty texts have no shingles and are linked with nothing; a text with fewer words is one
    shingle; rows alike get a result each; null ids are left out of the smallest id; an empty table
    gives no rows; other columns are ignored; whole texts are read.
    """
    base = docs.select(docs[id].alias("id"), docs[text].alias("text")).withColumn("text_key", text_key())
    keyed = staged(profiles(base, size), "profiles")
    sketch = docs.sparkSession.sparkContext.broadcast(frequency_sketch(keyed))
    rows = staged(keyed.where("segment is null").select("id", "text_key", "set", "n"), "names")
    unstaged(keyed)  # the counters of all tasks, many times the rows
    block = Window.partitionBy("shingle", "salt")
    by_size = block.orderBy("n", "set")
    smaller = by_size.rowsBetween(Window.unboundedPreceding, -1)
    # one exchange deals out blocks for all that follows: a set stands once in each, then meets the others
    once = prefixes(base, sketch, size, tile).withColumn("before", F.lag("set").over(by_size)).where(F.col("before").isNull() | (F.col("before") != F.col("set"))).drop("before")
    near = once.withColumn("larger", F.lead("n").over(by_size)).withColumn("reach", F.max("most").over(smaller)).withColumn("least", F.min("n").over(smaller))
    # in a block that isn't cut, a set links with none if the next larger one is too large for it, and no smaller one reaches up to it or all are too large
    met = (F.col("salts") > 1) | F.coalesce(F.col("larger") <= F.col("most"), F.lit(False)) | F.coalesce((F.col("reach") >= F.col("n")) & (F.col("least") <= F.col("most")), F.lit(False))
    left = near.where(met).withColumn("low", F.min("set").over(block)).withColumn("high", F.max("set").over(block)).withColumn("first", F.min(F.struct("n", "set", "most")).over(block))
    shared = staged(left.where("salts > 1 or low <> high").select("shingle", "salts", "salt", "set", "n", "most", "first"), "blocks")
    sketch.destroy()
    del sketch  # its value too
    fits = lambda n, most, other: (other["n"] <= most) & (n <= other["most"])
    heads = shared.where("salts > 1").select("shingle", "first").distinct().withColumn("head", F.min("first").over(Window.partitionBy("shingle")))
    stars = shared.where(fits(F.col("n"), F.col("most"), F.col("first"))).select(F.col("set").alias("a"), F.col("first.set").alias("b"))
    tops = heads.where(fits(F.col("first.n"), F.col("first.most"), F.col("head"))).select(F.col("first.set").alias("a"), F.col("head.set").alias("b"))
    met = stars.union(tops).where("a <> b").groupBy("a", "b").count()
    best = met.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("count"), "b"))).where(F.col("rank") <= STARS).select("a", "b")
    cut = shared.where("salts > 1").select("shingle", "salts", "set")
    several = cut.groupBy("shingle").agg(F.min("set").alias("low"), F.max("set").alias("high")).where("low <> high").select("shingle")
    blocks = shared.where("salts = 1").select("shingle", "salts", "set").unionByName(staged(cut.join(several, "shingle", "left_semi"), "cut", narrow=True))
    wanted = staged(blocks.select("set").distinct(), "wanted", narrow=True)
    holders = staged(rows.where("n > 0").join(wanted, "set", "left_semi").groupBy("set").agg(F.min("id").alias("id")), "holders", narrow=True)
    sets = staged(candidate_sets(base, holders, size), "sets")
    vectors = staged(sets.select("set", "n", "vector", "odd").dropDuplicates(["set"]), "vectors")
    roots = components(linked(may_link(best, vectors), sets))
    for top in (NEAREST, None):
        blocks = open_blocks(blocks, roots)  # those left of the last turn alone are asked again
        roots = joined(roots, linked(may_link(remaining_pairs(blocks, vectors, tile, top), vectors), sets))
    roots = roots.toDF("set", "root")
    per_set = rows.where("n > 0").groupBy("set").agg(F.min("id").alias("low"), F.count("*").alias("copies")).join(roots, "set", "left").where("copies > 1 or root is not null").withColumn("root", F.coalesce("root", "set"))
    lowest = per_set.groupBy("root").agg(F.min("low").alias("component_id"))
    of_set = staged(per_set.join(lowest, "root").select("set", "root", "component_id"), "components", narrow=True)
    found = rows.join(of_set, "set", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    return found.select("id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), "set", F.coalesce("root", "set").alias("root"))


def keep_one(docs: DataFrame, text: str = "text", id: str = "doc_id", size: int = WORDS, tile: int = TILE) -> DataFrame:
    """The rows of `docs` less near duplicates: of each component the row with the smallest id stays.

    Null ids come last; of a component's rows alike in id the first by text stays, whatever other
    components have that id; documents without words all stay. Tasks choose on their own first.
    """
    lowest = grouped(docs, text, id, size, tile).where((F.col("n_shingles") > 0) & F.col("id").eqNullSafe(F.col("component_id")))
    kept = staged(lowest.select(F.col("id").alias("kept_id"), F.col("text_key").alias("kept_key"), "root").distinct(), "kept")
    empty = F.trim(F.translate(F.coalesce(docs[text], F.lit("")), "\t\n\x0b\x0c\r", "     ")) == ""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    worded = docs.where(~empty).select(own.alias("row"), docs[id].alias("id"), docs[text].alias("text")).withColumn("text_key", text_key())
    left = worded.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key")))
    return left.groupBy("root").agg(F.min_by("row", "text").alias("row")).select("row.*").unionByName(docs.where(empty))
