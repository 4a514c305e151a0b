"""What the operators share: reading inputs, storing steps, and framed column blobs.

Inputs may hold extra columns of any name: operators select the columns they name and join only
on columns of their own.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotterlake.session import materialize, scratch_path, ship_package  # noqa: F401  (used by the operators)

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Send the package to Python workers and bound Arrow batches of long texts by bytes."""
    ship_package(spark)
    spark.conf.set(BATCH_BYTES, str(8 << 20))


def texts(docs: DataFrame, *more: str | Column) -> DataFrame:
    """doc_id as long and text, a null text as the empty one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *more)


def crc_class(classes: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``classes``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % classes


def text_parts(docs: DataFrame, part_bytes: int) -> int:
    """How many parts of about ``part_bytes`` the texts fill, from one scan."""
    total = docs.select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, -(-int(total) // part_bytes))


def drop_stored(df: DataFrame) -> None:
    """Delete a table that ``materialize`` stored, once nothing that is still to run reads it."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that no table in use comes from.

    Its cleaner follows the driver's garbage collection, which may otherwise not happen for a long while.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


WORKER_CACHES: list[dict] = []  # what a Python worker keeps between tasks of one operator
_at_work: list[str] = []


def task_of(operator: str) -> Callable:
    """Decorates a function over a task's batches: what tasks of another operator left in the reused worker goes first.

    Caches are emptied, and memory that Arrow's and the C library's pools hold free is given back.
    """

    def decorate(run):
        @wraps(run)
        def wrapped(batches):
            from blotterlake.llm import common  # the worker's module, not what was pickled with the function

            common.start_task(operator)
            yield from run(batches)

        return wrapped

    return decorate


def start_task(operator: str) -> None:
    if _at_work == [operator]:
        return
    changed, _at_work[:] = bool(_at_work), [operator]
    if changed:
        for cache in WORKER_CACHES:
            cache.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Let Arrow's pool and the C library return the memory they hold free."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(work: Callable) -> Callable:
    """Decorates a function of one or two groups: what it held is given back before the worker takes the next or idles."""

    def run(*groups):
        try:
            return work(*groups)
        finally:
            give_back()

    # Spark looks at the number of arguments.
    return (lambda group: run(group)) if work.__code__.co_argcount == 1 else (lambda left, right: run(left, right))


def by_place(docs: DataFrame, *named: str) -> DataFrame:
    """All columns but ``named`` called c<place>, so that an operator's own names clash with none of them."""
    return docs.toDF(*[c if c in named else f"c{i}" for i, c in enumerate(docs.columns)])


def pack_columns(level: int = 1, **columns) -> bytes:
    """Arrow stream of equally long columns, compressed: one value to shuffle for many rows."""
    batch = pa.record_batch({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_columns(blob) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


def numpy_columns(blob, *names: str) -> list[np.ndarray]:
    found = unpack_columns(blob)
    return [found.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in names]


def byte_view(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary array without nulls, and the len + 1 offsets into them."""
    wide = strings.cast(pa.large_binary()) if not pa.types.is_large_binary(strings.type) else strings
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(wide) else np.empty(0, np.uint8)
    return flat, offsets - offsets[0] if len(wide) else np.zeros(1, np.int64)


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``most`` bytes of a string column each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        slot = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
        starts = np.concatenate((np.flatnonzero(np.diff(slot, prepend=-1)), [batch.num_rows]))
        for a, b in zip(starts.tolist(), starts[1:].tolist()):
            yield batch.slice(a, b - a)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + length)``."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)
