"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a local session may go without a setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder of its own inside the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read back: its lineage ends here.

    With `narrow`, for tables that are small next to the corpus, a task takes several shuffle
    partitions, two tasks per core of the cluster, and so many files are written.
    """
    path = stage_path(df.sparkSession, name)
    if narrow:
        df = df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Removes the files of a frame that `staged` returned, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def workers_find_package(spark: SparkSession) -> None:
    """Workers started from now on find this package where the driver found it."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", ""):
        environment["PYTHONPATH"] = f"{ROOT}:{environment.get('PYTHONPATH', '')}".rstrip(":")


def give_back() -> None:
    """Hands memory that this process has freed back to the system, where the C library can (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow whose workers find this package where the driver found it.

    Workers outlive their tasks, beside the executor's heap; at the end of a task they give back what it freed.
    """
    workers_find_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from make(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def cuts(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about `size` characters of one column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(lengths):
        total += n
        if total >= size or i + 1 == len(lengths):
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0


def slices(batch: pa.RecordBatch, column: str, size: int = 1 << 20) -> Iterator[dict[str, list]]:
    """The rows of a batch in runs of about `size` characters of one column, nulls as they are."""
    return (rows.to_pydict() for rows in cuts(batch, column, size))


class Memo(dict):
    """A value per key, computed once; emptied when it holds `limit` keys."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")


def ascii_lower_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and all that isn't ASCII, A-Z in lower case, as UTF-8."""
    return WORD_BYTES.findall(text.encode().lower()) if text else []


class TermBits:
    """A set of terms as a bit array of fixed size: it has every term given, and some others by chance."""

    BITS = 1 << 22

    def __init__(self, terms: DataFrame, column: str):
        slot = (F.crc32(F.col(column).cast("binary")) % F.lit(self.BITS)).cast("long")
        words = (
            terms.select(slot.alias("slot")).where("slot is not null")
            .groupBy(F.expr("slot div 64").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))
        )  # at most BITS / 64 rows
        table = np.zeros(self.BITS // 64, dtype=np.int64)
        for word, bits in words.collect():
            table[word] = bits
        self.table = table.view(np.uint8).tobytes()

    def __contains__(self, term: bytes) -> bool:
        slot = zlib.crc32(term) % self.BITS
        return bool(self.table[slot >> 3] >> (slot & 7) & 1)
