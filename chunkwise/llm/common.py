"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the split of learned and held-out rows."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


#: Rows of an Arrow batch of whole texts; see ``short_batches``.
ARROW_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Documents are long: fewer rows to a batch keep an executor and its Python workers
    small. A setting of the session, lowered if it is higher."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)


_RESIDENT: dict[Hashable, object] = {}


def give_back() -> None:
    """Hand free memory of this Python worker back to the system. Workers outlive their
    tasks; what the allocators keep would add up over the stages of a pipeline."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def clean_after(batches: Iterator) -> Iterator:
    """The same items; memory is given back when they are through."""
    yield from batches
    give_back()


def resident(key: Hashable, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: one object at a time. A worker that
    turns to another operator, or another model, gives up what it kept before."""
    found = _RESIDENT.get(key)
    if found is None:
        _RESIDENT.clear()
        give_back()
        found = _RESIDENT[key] = make()
    return found


class WordCache:
    """Word -> value map of bounded size for one Python worker.

    Two generations of at most ``limit`` words: when the young one is full the
    old one is dropped and the young one becomes old. ``compute`` gets a list of
    unknown words and returns their values in order. Words longer than
    ``longest`` are computed each time and never kept.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], limit: int = 500_000, longest: int = 64):
        self.compute, self.limit, self.longest = compute, limit, longest
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def values(self, words: list[str]) -> list:
        """The value of every word, in order."""
        young = self.young
        got = list(map(young.get, words))
        if None not in got:
            return got
        missing = {w for w, v in zip(words, got, strict=True) if v is None}
        found = {w: v for w in missing if (v := self.old.get(w)) is not None}
        unknown = [w for w in missing if w not in found]
        if unknown:
            found.update(zip(unknown, self.compute(unknown), strict=True))
        if len(young) + len(found) > self.limit:
            self.old, self.young = young, {}
        self.young.update((w, v) for w, v in found.items() if len(w) <= self.longest)
        return [found[w] if v is None else v for w, v in zip(words, got, strict=True)]


#: How many buckets of ids ``in_buckets`` tells apart; it broadcasts at most so many numbers.
ID_BUCKETS = 1 << 20


def out_of_buckets(docs: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows that ``in_buckets`` leaves out."""
    return _bucketed(docs, key, ids, "left_anti")


def _bucketed(docs: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
    name = "__bucket"
    number = F.pmod(F.xxhash64(F.col(key)), F.lit(ID_BUCKETS)).cast("int")
    used = ids.select(number.alias(name)).distinct()
    return docs.withColumn(name, number).join(F.broadcast(used), name, how).select(docs.columns)


def in_buckets(docs: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """A superset of the rows whose ``key`` is among ``ids``, found without a shuffle of the rows."""
    return _bucketed(docs, key, ids, "left_semi")


def drop_ids(docs: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` isn't among ``ids`` (distinct, not null). Only rows in a
    bucket with such an id are shuffled."""
    clear = _bucketed(docs, key, ids, "left_anti")
    return clear.unionAll(in_buckets(docs, key, ids).join(ids, key, "left_anti").select(docs.columns))
