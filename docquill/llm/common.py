"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

#: Text bytes that one numpy pass works on at a time, so that memory is bounded whatever the rows' lengths are.
PIECE_BYTES = 2 << 20


def settled(df: DataFrame, name: str, group: int = 0) -> DataFrame:
    """The rows written to the cluster's shared folder and read back.

    Later reads survive lost executors, and costly Python work is done once. Of rows of some MB a file is written and read whole
    otherwise; `group` names how many of them are to be in memory together, and they are compressed more.
    """
    path = work_path(df.sparkSession, name)
    options = {"parquet.block.row.count.limit": group, "compression": "zstd"} if group else {}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batch_bytes(spark: SparkSession, limit: int = 8 << 20) -> Iterator[None]:
    """Arrow batches of at most about so many bytes for what is written inside, whatever the rows' lengths are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def whole_files(spark: SparkSession, limit: int = 32 << 20) -> Iterator[None]:
    """Files of at most so many bytes aren't split among tasks by what is planned inside; a larger setting stays."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    number, unit = re.match(r"(\d+)([kmgtp]?)", before.strip().lower()).groups()
    spark.conf.set(name, str(max(limit, int(number) << 10 * " kmgtp".index(unit or " "))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def size_of(df: DataFrame) -> int:
    """Bytes of a settled table, as its files have them."""
    files = df.inputFiles()
    if not files:
        return 0
    folder = files[0].rsplit("/", 1)[0]
    return df.sparkSession.read.format("binaryFile").load(folder).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def small(df: DataFrame, limit: int = 8 << 20) -> DataFrame:
    """A settled table, marked for broadcast if its files have at most `limit` bytes; else joins shuffle it."""
    return F.broadcast(df) if size_of(df) <= limit else df


def text_of(column: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """True for the rows that no model learns from: crc32 of the id as text leaves 0. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about `limit` bytes of text; a longer row comes alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), dtype=np.int64)
        cut = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
        edges = [0, *cut.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(a, b - a)


def release() -> None:
    """Give memory that isn't in use back to the machine, so that a worker doesn't keep one task's peak for all later ones."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(work: Callable) -> Callable:
    """A task's function over batches that releases memory when it has ended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bits:
    """A bit vector with ranks from block counts and popcounts."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes().ljust((len(bits) // 64 + 1) * 8, b"\0"), np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
