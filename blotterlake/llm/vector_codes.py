"""Vector code compression: product quantisation on whole numbers, entries found by GNAT.

Components become ``floor(SCALE * x)``; vectors are cut into ``PARTS`` equal parts, each position with a codebook of ``ENTRIES`` entries,
which start as the parts of the rows with the smallest ids.  In each round every part goes to its nearest entry, found by
the codebook's tree (``gnat``), and each entry becomes the floor of the mean of its parts.  Sums and counts are whole numbers, added up
in the task, then by Spark, so no order of adding changes them.  The driver and each task hold the codebooks and their trees only, whose size
is ENTRIES times the vector length, whatever the number of rows.

Defined cases: rows whose vector is null or holds null or non-finite components take no part; zero vectors do.  Vectors shorter than the
longest are filled up with zeros, and all to a multiple of ``PARTS``; an empty vector is all zeros.  Scaled components beyond the 32-bit-safe
bound of ``bound`` are set to it, so that squared distances stay exact in 64 bits.  Rows without an id come last in the order
of ids, rows that repeat an id are ordered by their stored bytes; both count like others.  With fewer rows than ENTRIES the codebooks
are that short; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from blotterlake.llm import gnat
from blotterlake.llm.common import materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SUMS = 16  # sums of neighbouring components that travel in one row


@dataclass(frozen=True)
class Codebooks:
    entries: np.ndarray  # parts x entries x components of a part, whole numbers
    trees: tuple[gnat.Node, ...]

    @staticmethod
    def of(entries: np.ndarray) -> Codebooks:
        return Codebooks(entries, tuple(gnat.build(part) for part in entries))

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def bound(width: int) -> int:
    """Largest component for which the squared distance of two vectors of that length fits 62 bits."""
    return (1 << (62 - max(width - 1, 0).bit_length()) // 2 - 1) - 1


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and the vector as little-endian 32-bit whole numbers, of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            value = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
            odd = np.concatenate(([0], np.cumsum(~np.isfinite(value))))
            ends = np.cumsum(sizes)
            usable = (odd[ends] == odd[ends - sizes]) & lists.is_valid().to_numpy(zero_copy_only=False)
            most = min(bound(int(sizes.max(initial=1))), (1 << 31) - 1)
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.clip(np.floor(np.where(np.isfinite(value), value, 0) * SCALE), -most, most).astype("<i4").tobytes()
            some = np.flatnonzero(usable)
            blobs = [whole[4 * a : 4 * b] for a, b in zip((ends - sizes)[some].tolist(), ends[some].tolist())]
            kept = pa.array(some)
            yield pa.record_batch([batch.column(0).take(kept), batch.column(1).take(kept), pa.array(blobs, pa.binary())], ["vec_id", "label", "vector"])

    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    schema = StructType([rows.schema["vec_id"], rows.schema["label"]]).add("vector", "binary")
    return rows.mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` whole numbers, filled up with zeros."""
    blobs = column.to_pylist()
    if any(len(b) != 4 * width for b in blobs):
        blobs = [b.ljust(4 * width, b"\0") for b in blobs]
    most = bound(width)
    return np.clip(np.frombuffer(b"".join(blobs), "<i4").reshape(len(blobs), width).astype(np.int64), -most, most)


def first_codebooks(rows: DataFrame, width: int, entries: int = ENTRIES) -> Codebooks:
    """The parts of the rows with the smallest ids."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).toArrow()
    start = _matrix(least.column("vector").combine_chunks(), width)
    return Codebooks.of(np.stack(np.split(start, PARTS, axis=1)))


def assign(books: Codebooks, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry number of each part of each vector, and its squared distance."""
    which, square = np.empty((len(vectors), PARTS), np.int64), np.empty((len(vectors), PARTS), np.int64)
    for part, mine in enumerate(np.split(vectors, PARTS, axis=1)):
        which[:, part], square[:, part], _ = gnat.nearest(books.trees[part], books.entries[part], mine)
    return which, square


def _part_sums(rows: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """part, entry, block of components, number of parts assigned and the sums of the block's components."""
    size = width // PARTS
    blocks = max(1, -(-size // SUMS))
    names = [f"s{i}" for i in range(SUMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, books.entries.shape[1]), np.int64)
        sums = np.zeros((*counts.shape, blocks * SUMS), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), width)
            which, _ = assign(books, vectors)
            for part, mine in enumerate(np.split(vectors, PARTS, axis=1)):
                counts[part] += np.bincount(which[:, part], minlength=counts.shape[1])
                order = np.argsort(which[:, part], kind="stable")
                met, at = np.unique(which[order, part], return_index=True)
                if size:
                    sums[part, met, :size] += np.add.reduceat(mine[order], at)
        part, entry = np.nonzero(counts)
        for block in range(blocks):
            some = sums[part, entry, block * SUMS : (block + 1) * SUMS]
            yield pa.record_batch({
                "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "block": pa.array(np.full(len(part), block, np.int32)),
                "n": pa.array(counts[part, entry]), **{c: pa.array(some[:, i]) for i, c in enumerate(names)},
            })

    schema = "part int, entry int, block int, n long, " + ", ".join(f"{c} long" for c in names)
    found = rows.select("vector").mapInArrow(run, schema)
    return found.groupBy("part", "entry", "block").agg(*[F.sum(c).alias(c) for c in ("n", *names)])


def _next(rows: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """Every used entry becomes the floor of the mean of its parts; at most parts x entries x blocks rows come back."""
    found = _part_sums(rows, books, width).toArrow()
    entries, size = books.entries.copy(), width // PARTS
    part, entry, block, n = (found.column(c).to_numpy() for c in ("part", "entry", "block", "n"))
    for i in range(SUMS):
        at = block * SUMS + i
        some = at < size
        entries[part[some], entry[some], at[some]] = np.floor_divide(found.column(f"s{i}").to_numpy()[some], n[some])
    return Codebooks.of(entries)


def fit(rows: DataFrame, *, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, int]:
    """Codebooks for a stored table of ``whole_vectors``, and the length all vectors are filled up to."""
    longest = (rows.agg(F.max(F.octet_length("vector"))).first()[0] or 0) // 4
    width = -(-longest // PARTS) * PARTS
    books = first_codebooks(rows, width, entries)
    for _ in range(rounds):
        books = _next(rows, books, width)
    return books, width


def encode(rows: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distances summed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, square = assign(books, _matrix(batch.column(2), width))
            codes = [row.tobytes().hex() for row in which.astype(np.uint8)]
            columns = [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(square.sum(1))]
            yield pa.record_batch(columns, ["vec_id", "label", "code", "error"])

    schema = StructType([rows.schema["vec_id"], rows.schema["label"]]).add("code", "string").add("error", "long")
    return rows.mapInArrow(run, schema)


def code_report(vectors: DataFrame) -> DataFrame:
    """Codes of all rows with their errors, the errors of their labels, and a digest of the codebooks.

    The labels' errors are joined back without a hint: few are broadcast by their stored size, many are sort-merged,
    where adaptive execution splits a hot label.
    """
    rows = materialize(whole_vectors(vectors), "whole-vectors")
    books, width = fit(rows)
    coded = materialize(encode(rows, books, width), "vector-codes")
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    totals = materialize(totals, "label-errors")
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
