"""What workers hold, and other small Spark helpers of the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import bound_batches, drop, save, scratch  # noqa: F401

#: Broadcast at most this many keys of a table whose size has been counted.
BROADCAST_KEYS = 1_000_000
#: Characters of a long text that are worked on at a time, where the work can be cut.
PART = 1 << 17


def small(spark: SparkSession, df: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """df with a broadcast hint if it has been counted to be small; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows inner-joined with groups on keys, where groups has each key once and its number of rows in `size`.

    `total` rows hold at most total / limit groups of more than `limit` rows, so the large groups are
    100,000 at most and are broadcast; a key of the shuffled rest has few rows.  rows is read twice.
    """
    limit = max(64, total // 100_000)
    large = groups.where(F.col(size) > limit)
    rest = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(groups.where(F.col(size) <= limit), keys)
    return rows.join(F.broadcast(large), keys).unionByName(rest)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (as long), text and more columns of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns of df that can be hashed: orders rows that have the same doc_id."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t])


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n (null doc_id: 0, a training row of every fold)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n, F.lit(0))


def relax(spark: SparkSession) -> None:
    """Ask the executors' JVMs to collect garbage, which makes them give heap back that they no longer need.

    For a stage whose memory is in Python workers, after one whose memory was in the heap: an executor's
    bound holds for both together.  A small job that costs each executor some tenths of a second.
    """
    n = max(1, spark.sparkContext.defaultParallelism)
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).collect()


# ---- workers --------------------------------------------------------------------------------------

_kept: list[Callable] = []


def kept(cached: Callable) -> Callable:
    """Marks an lru_cache of something large that a worker keeps from one partition of an operator to the next."""
    _kept.append(cached)
    return cached


def lean(work: Callable, *keep: Callable) -> Callable:
    """work(batches) that first drops what other operators keep in this worker, and gives free memory back at its end.

    Python workers live on from stage to stage, so an executor's memory would else hold what each of
    its workers ever needed.
    """

    def run(batches):
        _begin(keep)
        try:
            yield from work(batches)
        finally:
            release()

    return run


def _begin(keep: tuple[Callable, ...]) -> None:
    for cached in _kept:
        if cached not in keep:
            cached.cache_clear()


def release() -> None:
    """Give free memory back to the system (where the C library has a call for it)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


_BREAK = regex.compile(r"[^\p{L}\p{M}\p{N}_]")


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of about `size` characters that end between words; a single longer word is cut."""
    lo = 0
    while len(text) - lo > size:
        found = _BREAK.search(text, lo + size, lo + 2 * size)
        hi = found.end() if found else min(len(text), lo + 2 * size)
        yield text[lo:hi]
        lo = hi
    yield text[lo:] if lo else text
