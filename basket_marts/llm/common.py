"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts.operators.joins import measured_bytes
from basket_marts.session import remove_folder, scratch_path

# A lookup is broadcast only when its measured size is below this; see `lookup_join`.
BROADCAST_BYTES = 8 * 1024 * 1024


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


_STORED: list[str] = []


def scratch_mark() -> int:
    """A mark for `keep_last_stored`."""
    return len(_STORED)


def keep_last_stored(spark: SparkSession, mark: int) -> None:
    """Remove all that was stored since a mark, but for what was stored last: the frames that it
    was made from have been read.
    """
    for path in _STORED[mark:-1]:
        remove_folder(spark, path)
    del _STORED[mark:-1]


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: it is computed once,
    its lineage ends, and a lost executor costs nothing that is needed again.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(frame.schema).parquet(path)


def lookup_join(rows: DataFrame, lookup: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join to a lookup, broadcast after its size was measured, else by shuffle.

    `lookup` is evaluated twice, so it should be stored or cheap. In the shuffle join a
    hot key on the left is split by adaptive execution, as nothing above needs it whole.
    """
    if measured_bytes(lookup) <= BROADCAST_BYTES:
        lookup = F.broadcast(lookup)
    return rows.join(lookup, on, how)


def row_key() -> Column:
    """One number for a row's doc_id and whole text, NULLs included."""
    return F.xxhash64("doc_id", "text")


def pack_rest(rows: DataFrame) -> DataFrame:
    """(doc_id, text, rest): all other columns in one, so that no name of theirs is in the
    way of an operator's own.
    """
    others = [F.col(f"`{c}`") for c in rows.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(None).cast("int")
    return rows.select("doc_id", "text", rest.alias("rest"))


def unpack_rest(packed: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """Undo `pack_rest`, with some columns replaced or, behind the others, added."""
    found = []
    for name in dict.fromkeys([*columns, *replaced]):
        own = F.col(name) if name in ("doc_id", "text") else F.col("rest").getField(name)
        found.append(replaced.get(name, own).alias(name))
    return packed.select(*found)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def code_points(text: str | Column) -> Column:
    """Length in code points, NULL counting as the empty text."""
    return F.coalesce(F.char_length(text), F.lit(0)).cast("bigint")


_CACHES: list = []


def remembered(make):
    """Make a value once per argument and Python worker, until `forget_remembered`."""
    cached = lru_cache(maxsize=2)(make)
    _CACHES.append(cached)
    return cached


def forget_remembered() -> None:
    """Drop what operators remembered in this Python worker: an early stage calls it, so that
    what the last one of an earlier run filled does not stay through all stages of the next.
    """
    for cached in _CACHES:
        cached.cache_clear()
    release_memory()


@lru_cache(maxsize=1)
def _c_library():
    return ctypes.CDLL(None)


def release_memory() -> None:
    """Give what Arrow and the C library hold free back to the system. A Python worker lives on
    for other tasks, and idle ones would add to an executor's memory in later stages.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(_c_library(), "malloc_trim", None)
    if trim is not None:  # glibc only
        trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about `size` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(
            zero_copy_only=False
        )
        ends, first = np.cumsum(lengths), 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(first, last - first)
            first = last
    release_memory()


@lru_cache(maxsize=2)
def library_tokenizer(path: str):
    """The tokenizer of a `.json` vocabulary file, loaded once per Python worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
