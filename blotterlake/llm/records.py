"""Token-ID output as length-delimited binary records with a separate offset index.

A shard file is a run of frames, little-endian::

    length   u64   bytes of the payload
    check    u32   masked CRC-32 of the eight length bytes
    payload        flags u8 (bit 0: ids are 4 bytes wide, bit 1: doc_id is null), doc_id i64, ids
    check    u32   masked CRC-32 of the payload
    end      u8    newline

The mask is the rotation and constant that record files commonly use, so that a checksum stored
in checksummed data is not taken for one.  The ranges of the shards are found first, from the sizes of the texts; frames are made where
the texts lie, and go compressed into the one shuffle without being stored before.
Shards hold ascending ranges of doc_id of about equal bytes, as estimated from the texts, however long texts are spread, and are
written by Spark's own file committer (hence the newline), so a task that is lost and run again leaves one
file.  ``index`` is a Parquet table: shard, offset, length, doc_id, n_tokens, ids_crc32, start.

Defined cases: a null text is empty and yields the end id alone; null doc_ids come first; rows that
repeat a doc_id are ordered by the first 64 characters of the text, then by a hash of it, equal rows are all kept; an empty table gives an empty index.
Extra columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blotterlake.llm.common import by_bytes, drop_stored, give_back, materialize, task_of, texts
from blotterlake.llm.tokens import encoder

SHARD_BYTES = 16 << 20  # of frames, as estimated from the texts; a shard is read as one value, so it stays small
HELD_WORDS = 1_000_000  # by an encoder; encoding tasks hold little else
KEY = ["doc_id", "prefix", "tie"]
FRAMES = "shard int, doc_id long, prefix string, tie long, size long, record binary"
FRAME_BYTES, FRAME_EXTRA = 0.75, 28  # a frame's size by its text's bytes: prose has 0.7 to 0.8 with 2-byte ids, a token to a byte 2
MASK_DELTA = 0xA282EAD8  # fixed value of the masked-checksum convention
PACKING = "zstd"  # of frames between tasks; shard files hold them plain
HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<Bq")
INDEX_SCHEMA = (
    "shard long, file string, offset long, length long, doc_id long, n_tokens long, "
    "ids_crc32 long, place long, before_in_shard long"
)


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record without its closing newline."""
    flags = (ids.dtype.itemsize == 4) | (doc_id is None) << 1
    payload = PAYLOAD.pack(flags, doc_id or 0) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    check = struct.pack("<I", masked(zlib.crc32(length)))
    return length + check + payload + struct.pack("<I", masked(zlib.crc32(payload)))


def read_frame(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids and the end of the frame at ``at``; ValueError if a check fails."""
    if at + HEAD.size > len(data):
        raise ValueError(f"record at {at} is cut off")
    length, check = HEAD.unpack_from(data, at)
    if check != masked(zlib.crc32(data[at : at + 8])):
        raise ValueError(f"length of the record at {at} is damaged")
    start, end = at + HEAD.size, at + HEAD.size + length
    if end + 5 > len(data):
        raise ValueError(f"record at {at} is cut off")
    payload = data[start:end]
    if int.from_bytes(data[end : end + 4], "little") != masked(zlib.crc32(payload)):
        raise ValueError(f"payload of the record at {at} is damaged")
    flags, doc_id = PAYLOAD.unpack_from(payload, 0)
    ids = np.frombuffer(payload, "<u4" if flags & 1 else "<u2", offset=PAYLOAD.size)
    return (None if flags & 2 else doc_id), ids, end + 5


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@task_of("record-unpack")
def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in by_bytes([batch], 0):
            pairs = zip(part.column(0), part.column(1).to_pylist())
            rows = [pa.decompress(r.as_buffer(), size, PACKING, asbytes=True) for r, size in pairs]
            yield pa.record_batch({"record": pa.array(rows, pa.binary())})


def shard_ends(docs: DataFrame, shard_bytes: int) -> list[tuple]:
    """The largest key of each shard but the last, ascending; one key ends several shards if the documents that have it fill them.

    Found before anything is encoded, from the texts' bytes, and by Spark, which samples rows for its ranges.  A document counts
    as one row for each time it holds the mean size, and one more, so equal shares of rows are at most ``shard_bytes`` but for
    the sampling's error and the estimate's: texts of a token to each byte make frames of 2.7 times that (2-byte ids).
    """
    sizes = texts(docs).select(*_key(), (FRAME_BYTES * F.octet_length("text") + FRAME_EXTRA).cast("long").alias("size"))
    # The number, stored, deals equal rows to several shards if they are many.
    stored = materialize(sizes.withColumn("row", F.monotonically_increasing_id()), "record-sizes")
    unit = int(stored.agg(F.avg("size")).first()[0] or 0) + 1
    weight = 1 + F.floor(F.col("size") / unit)
    parts = max(1, -(-int(stored.agg(F.sum(weight)).first()[0] or 0) * unit // shard_bytes))
    order = [*KEY, "row", "place"]
    weighted = stored.select(*KEY, "row", F.posexplode(F.array_repeat(F.lit(True), weight.cast("int"))).alias("place", "_"))
    dealt = weighted.select(*order).repartitionByRange(parts, *order).withColumn("shard", F.spark_partition_id())
    ends = dealt.groupBy("shard").agg(F.max(F.struct(*KEY)).alias("end")).collect()  # one row per shard file
    drop_stored(stored)
    return sorted(_ordered(*r.end) for r in ends)[:-1]


def _key() -> list[Column | str]:
    """What documents are ordered by, of a table of doc_id and text; equal texts of one doc_id are equal rows."""
    return ["doc_id", F.substring("text", 1, 64).alias("prefix"), F.xxhash64("text").alias("tie")]


def _ordered(doc_id: int | None, prefix: str, tie: int) -> tuple:
    return doc_id is not None, doc_id or 0, prefix, tie


class Dealer:
    """Shard numbers by key.  Rows whose key ends shards are dealt to these and the next in turn.

    Turns are counted per key, so in whatever order a task that is run again meets its rows, each shard gets as many of them.
    """

    def __init__(self, ends: Sequence[tuple], first: int):
        self.ends, self.first = ends, first
        self.turns: dict[tuple, int] = {}  # of keys that end shards, so no more than there are shards

    def shard(self, key: tuple) -> int:
        low, high = bisect_left(self.ends, key), bisect_right(self.ends, key)
        if low == high:
            return low
        turn = self.turns.get(key, self.first)
        self.turns[key] = turn + 1
        return low + turn % (high - low + 1)


def frames(docs: DataFrame, tokenizer: str, ends: Sequence[tuple] = ()) -> DataFrame:
    """A row per document: its shard, its compressed frame, the frame's size, and what documents of one doc_id are ordered by."""

    @task_of("record-frames")
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, dealer = encoder(tokenizer, HELD_WORDS), Dealer(ends, TaskContext.get().partitionId())
        for batch in by_bytes(batches, 1):
            ids, stops = words.texts(batch.column(1))
            keys = [batch.column(i).to_pylist() for i in (0, 2, 3)]
            rows = [frame(d, ids[a:b]) for d, a, b in zip(keys[0], stops, stops[1:])]
            give_back()  # what the encoder needed for these texts; it holds its words
            yield pa.record_batch({
                "shard": pa.array([dealer.shard(_ordered(*key)) for key in zip(*keys)], pa.int32()),
                "doc_id": batch.column(0), "prefix": batch.column(2), "tie": batch.column(3),
                "size": pa.array(map(len, rows), pa.int64()), "record": pa.array([pa.compress(r, PACKING, asbytes=True) for r in rows], pa.binary()),
            })

    doc_id, *rest = _key()
    return texts(docs).select(doc_id, "text", *rest).mapInArrow(encode, FRAMES)


def write_records(docs: DataFrame, path: str, tokenizer: str, *, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode all documents and write ``path``/data; rows are dealt to shards by doc_id ranges.

    The ranges are known before, so frames go from the task that makes them into the shuffle, and are held nowhere else.  For that,
    ``docs`` is read twice; if it is costly to compute, store it first.
    """
    ends = shard_ends(docs, shard_bytes)
    dealt = frames(docs, tokenizer, ends).repartitionById(len(ends) + 1, "shard").sortWithinPartitions(*KEY)
    records = dealt.select("record", "size").mapInArrow(_unpack, "record binary")
    # A text file of Spark's is the bytes of each value and the line end; the cast keeps all bytes.
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/data")


@task_of("record-scan")
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data, at, before, rows = memoryview(content.as_buffer()), 0, 0, []
            while at < len(data):
                doc_id, ids, end = read_frame(data, at)
                rows.append((shard, file, at, end - at, doc_id, len(ids), ids_crc32(ids), len(rows), before))
                at, before = end, before + len(ids)
            names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
            kinds = [pa.string() if f.endswith(" string") else pa.int64() for f in INDEX_SCHEMA.split(", ")]
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Read the record files of ``path`` back, check them, and write and return the offset index."""
    files = spark.read.format("binaryFile").load(f"{path}/data").select(
        F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long").alias("shard"),
        F.col("path").alias("file"), "content",
    )
    found = materialize(files.mapInArrow(_scan, INDEX_SCHEMA), "record-places")
    sizes = found.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))  # one row per shard file
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    index = found.join(offsets, "shard").withColumn("start", F.col("before") + F.col("before_in_shard"))
    index.drop("before", "before_in_shard").write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_shuffled(spark: SparkSession, path: str, *, seed: int) -> DataFrame:
    """doc_id and ids of all records in a random order fixed by ``seed``, read by offset.

    Tasks hold contiguous ranges of the shuffled index and seek in the shard files, so the files
    must be on storage that pyarrow's file systems open (local, S3, GCS, HDFS).
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        opened: dict[str, pa.NativeFile] = {}
        for batch in batches:
            ids, docs = [], []
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if file not in opened:
                    uri = file.replace("file:/", "file:///", 1) if not file.startswith("file://") else file
                    system, name = fs.FileSystem.from_uri(uri)
                    opened[file] = system.open_input_file(name)
                record = opened[file].read_at(length, offset)
                doc_id, found, _ = read_frame(memoryview(record), 0)
                docs.append(doc_id)
                ids.append(found.astype(np.int64))
            yield pa.record_batch({"doc_id": pa.array(docs, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64()))})
        for file in opened.values():
            file.close()

    index = spark.read.parquet(f"{path}/index")
    order = index.withColumn("order", F.xxhash64(F.lit(seed), "shard", "offset"))
    parts = max(1, index.rdd.getNumPartitions())
    return (
        order.repartitionByRange(parts, "order").sortWithinPartitions("order")
        .select("file", "offset", "length").mapInArrow(fetch, "doc_id long, ids array<long>")
    )


def token_records(docs: DataFrame, path: str, tokenizer: str, *, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write records and index below ``path``; returns the index."""
    write_records(docs, path, tokenizer, shard_bytes=shard_bytes)
    return write_index(docs.sparkSession, path)
