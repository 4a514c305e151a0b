"""Line deduplication: lines that many documents hold stay in one of them.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased; keys under ``least_chars`` code
points are left alone.  Each document gives one row per key it holds: the key's 128-bit hash, the document and the places
of its lines.  The rows are range-partitioned by hash and, within a hash, by document from the largest id down, so a
line that a third of all documents hold is spread over many partitions.  Each partition is streamed in that order: the first
document of a hash keeps its lines, those after it lose them once ``least_docs`` documents are seen.  A hash at the edge of a partition may
go on in the next, so its rows are handed on undecided, and a table of at most two hashes per partition (and
those of over ``PENDING`` rows) decides them.  Texts are not shuffled for this: the result is
a zlib-compressed bitmap per document that loses lines, and texts meet their bitmap once.

Defined cases: a null or empty text is one empty line.  Documents are told apart by doc_id: rows that repeat an id count as one
document, and if it is the one that keeps a line, all of them keep it; rows without an id count as one document, smaller than any
other.  An empty table gives no rows.  Keys are equal if their 128-bit hashes are.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blotterlake.llm.common import by_bytes, materialize, texts

LEAST_CHARS = 40
LEAST_DOCS = 5
PENDING = 1 << 16  # rows of one hash that are held; a longer run is handed on undecided
WHITE = b" \t\n\v\f\r"
ENTRY = "hi long, lo long, doc_id long, text_hash long, n_lines int, places binary"
SLICE = 2 << 20


def keys_of(text: bytes, least_chars: int = LEAST_CHARS) -> tuple[dict[bytes, list[int]], int]:
    """Places of the lines of each key that is long enough, and the number of lines."""
    lines = text.split(b"\n")
    found: dict[bytes, list[int]] = {}
    for place, line in enumerate(lines):
        if len(line) < least_chars:
            continue
        key = line.strip(WHITE).lower()  # bytes: exactly A-Z
        if len(key) >= least_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= least_chars):
            found.setdefault(key, []).append(place)
    return found, len(lines)


def hashed_texts(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("text_hash", F.xxhash64("text"))


def line_entries(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per document and key: hash, document, number of lines, places as little-endian 32-bit integers."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, SLICE):
            hashes, places, owner, lines = [], [], [], []
            for row, text in enumerate(batch.column(1)):
                found, n_lines = keys_of(text.as_buffer().to_pybytes(), least_chars)
                hashes += map(xxhash.xxh3_128_digest, found)
                places += [np.array(p, "<u4").tobytes() for p in found.values()]
                owner += [row] * len(found)
                lines += [n_lines] * len(found)
            pair = np.frombuffer(b"".join(hashes), ">i8").reshape(-1, 2).astype(np.int64)
            row = pa.array(owner, pa.int64())
            yield pa.record_batch({
                "hi": pa.array(pair[:, 0]), "lo": pa.array(pair[:, 1]), "doc_id": batch.column(0).take(row),
                "text_hash": batch.column(2).take(row), "n_lines": pa.array(lines, pa.int32()), "places": pa.array(places, pa.binary()),
            })

    return hashed_texts(docs).mapInArrow(run, ENTRY)


def _changes(columns: list[pa.ChunkedArray]) -> np.ndarray:
    """Where a row differs from the one before in any of the columns; nulls equal nulls."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for column in columns:
        value = column.fill_null(0).to_numpy()
        out[1:] |= value[1:] != value[:-1]
        if column.null_count:
            null = column.is_null().to_numpy()
            out[1:] |= null[1:] != null[:-1]
    return out


def stream(batches: Iterator[pa.RecordBatch], least_docs: int, pending: int = PENDING) -> Iterator[pa.Table]:
    """From rows sorted by hash and then document: those that lose their lines, and the undecided (``open``).

    Held at any time: a batch, and up to ``pending`` rows of the hash that it ends with.
    """
    held: pa.Table | None = None  # rows of the last hash, not yet handed on
    key = None  # that hash if some of its rows were handed on
    first = True  # whether the first hash of the partition is still going on

    def out(rows: pa.Table, is_open: bool) -> pa.Table:
        return rows.append_column("open", pa.array(np.full(len(rows), is_open)))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        held = None
        new_key = _changes([rows.column("hi"), rows.column("lo")])
        starts = np.flatnonzero(new_key)
        hash_at = lambda i: (rows.column("hi")[i].as_py(), rows.column("lo")[i].as_py())
        begin = 0
        if first or key is not None:  # the leading rows go on with a hash that is handed on undecided
            end = int(starts[1]) if len(starts) > 1 else len(rows)
            if key is None or hash_at(0) == key:
                key = hash_at(0)
                yield out(rows.slice(0, end), True)
                begin = end
                if end == len(rows):
                    continue
            first, key = False, None
        last = int(starts[-1])  # this hash may go on
        if last > begin:
            part = rows.slice(begin, last - begin)
            run = np.cumsum(new_key[begin:last]) - 1
            new_doc = new_key[begin:last] | _changes([part.column("doc_id")])
            n_docs = np.bincount(run, new_doc)
            nth = np.cumsum(new_doc) - 1
            first_doc = nth[new_key[begin:last]][run]
            loses = (n_docs[run] >= least_docs) & (nth != first_doc)
            yield out(part.filter(pa.array(loses)), False)
        held = rows.slice(max(last, begin))
        if len(held) > pending:
            key = hash_at(last)
            yield out(held, True)
            held = None
    if held is not None:
        yield out(held, True)


def _lost_lines(docs: DataFrame, least_chars: int, least_docs: int, pending: int) -> DataFrame:
    """doc_id, text_hash, n_lines and places of the lines that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream(batches, least_docs, pending):
            yield from rows.to_batches()

    entries = materialize(line_entries(docs, least_chars), "line-entries")
    order = [F.col("hi"), F.col("lo"), F.col("doc_id").desc_nulls_last(), F.col("text_hash")]
    streamed = entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, ENTRY + ", open boolean")
    streamed = materialize(streamed, "line-decisions")
    undecided = streamed.where("open")
    holders = undecided.select("hi", "lo", "doc_id").distinct().groupBy("hi", "lo")
    holders = holders.agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper")).where(F.col("docs") >= least_docs)
    keepers = materialize(holders.select("hi", "lo", "keeper"), "line-keepers")  # few: the edges of partitions
    late = undecided.join(keepers, ["hi", "lo"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    columns = ["doc_id", "text_hash", "n_lines", "places"]
    return streamed.where("not open").select(*columns).union(late.select(*columns))


def pack_bitmap(n_lines: int, lost: list[bytes]) -> bytes:
    """Compressed bits of a document's lines, set for those that stay."""
    keep = np.ones(n_lines, bool)
    keep[np.frombuffer(b"".join(lost), "<u4")] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(
    docs: DataFrame, *, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, pending: int = PENDING
) -> DataFrame:
    """doc_id, text_hash, n_lines and keep_bitmap of the documents that lose lines, stored; all others keep every line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bitmaps = map(pack_bitmap, batch.column(2).to_pylist(), batch.column(3).to_pylist())
            columns = [*batch.columns[:3], pa.array(bitmaps, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "text_hash", "n_lines", "keep_bitmap"])

    lost = _lost_lines(docs, least_chars, least_docs, pending)
    # Rows that repeat an id and a text lose the same places, so a set of them is bounded by the text.
    of_document = lost.groupBy("doc_id", "text_hash").agg(F.min("n_lines").alias("n_lines"), F.collect_set("places").alias("lost"))
    return materialize(of_document.mapInArrow(run, "doc_id long, text_hash long, n_lines int, keep_bitmap binary"), "line-bitmaps")


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text and bitmap, null where every line stays."""
    named = bitmaps.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_text"), "keep_bitmap")
    same = (F.col("text_hash") == F.col("of_text")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
    return hashed_texts(docs).join(named, same, "left").select("doc_id", "text", "keep_bitmap")


def kept_text(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """What stays of a text, its number of lines, and how many go."""
    if bitmap is None:
        return text, text.count(b"\n") + 1, 0
    lines = text.split(b"\n")
    keep = unpack_bitmap(bitmap, len(lines))
    return b"\n".join(line for line, stays in zip(lines, keep.tolist()) if stays), len(lines), len(lines) - int(keep.sum())


def _apply(docs: DataFrame, bitmaps: DataFrame, schema: str, columns) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, SLICE):
            maps = batch.column(2).to_pylist()
            found = [kept_text(t.as_buffer().to_pybytes(), m) for t, m in zip(batch.column(1), maps)]
            yield pa.record_batch({"doc_id": batch.column(0), **columns(found)})

    return _with_bitmaps(docs, bitmaps).mapInArrow(run, schema)


def kept_texts(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id and the text of the lines that stay, joined by line ends."""
    values = lambda found: {"text": pa.array([kept for kept, _, _ in found], pa.binary()).cast(pa.string())}
    return _apply(docs, bitmaps, "doc_id long, text string", values)


def line_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what stays, for every document."""

    def values(found: list[tuple[bytes, int, int]]) -> dict[str, pa.Array]:
        return {
            "n_lines": pa.array([n for _, n, _ in found], pa.int64()), "n_dropped": pa.array([n for _, _, n in found], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(kept).hexdigest() for kept, _, _ in found]),
        }

    return _apply(docs, keep_bitmaps(docs, **options), "doc_id long, n_lines long, n_dropped long, kept_sha256 string", values)
