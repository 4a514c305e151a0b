"""Removal of byte strings that an earlier document has, by maximal repeats of suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller doc_id.

Suffixes are dealt by content.  The least hash of the ``GRAM``-byte grams in the first ``LENGTH`` bytes of a suffix is
its key, so suffixes that share that many bytes share a key; neighbouring suffixes mostly have the same one and
travel as one short string (a run).  Three rounds over stored chunks of documents:

1. Every chunk sends its distinct keys, and learns which of them two documents have.
2. It sends its runs with such keys.  Equal runs of a chunk go once, with their smallest document; the others are known to
   repeat.  So a passage that a third of all documents share is one string per chunk.
3. The runs of a key are one group.  Equal strings are repeats as they are.  Of a key with different strings all suffixes are put
   into an enhanced suffix array, its interval tree is scanned with a stack, and the intervals that differ in the byte
   to the left are the maximal repeat groups.  Each occurrence in a document that is not the group's
   smallest is removed, and the places go back to the chunks.

A key with over ``HOT_SUFFIXES`` suffixes is dealt again: each of its suffixes goes by a hash of its first ``LENGTH`` bytes.

Defined cases: a null text is empty (and stays null); texts under ``LENGTH`` bytes lose nothing; a null doc_id comes after all
others; rows with the same doc_id do not remove from each other; an empty table gives no rows.  Extra columns are
kept by ``remove_repeats`` and not read by ``repeat_report``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from blotterlake.llm.common import WORKER_CACHES, by_bytes, byte_view, free_shuffles, lean, materialize, numpy_columns, pack_columns, ranges, task_of, text_parts, texts
from blotterlake.llm.suffixes import common_prefixes, maximal_repeats, suffix_array

LENGTH = 50
GRAM = 20
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 6 << 20  # of text whose keys one bucket gets
HOT_SUFFIXES = 100_000
SEGMENT = 1 << 19
SUFFIXES = 1 << 15
SUFFIX_BYTES = 256  # what is compared of a suffix; at least LENGTH
LAST = np.iinfo(np.int64).max
REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(50).integers(1, 1 << 63, 256).astype(np.uint64)
_POWERS: dict[int, np.ndarray] = {}
WORKER_CACHES.append(_POWERS)


# ---- chunks -------------------------------------------------------------------------------


def stored_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of about ``chunk_bytes`` of text: chunk number and the documents as an Arrow stream."""
    at = docs.columns.index("text")

    @task_of("suffix_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, chunk = 0, TaskContext.get().partitionId() << 32
        for batch in by_bytes(batches, at, chunk_bytes // 4):
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(at))).as_py() or 0
            if size >= chunk_bytes:
                yield _chunk_row(chunk, held)
                held, size, chunk = [], 0, chunk + 1
        if held:
            yield _chunk_row(chunk, held)

    return materialize(docs.mapInArrow(run, "chunk long, body binary"), "text-chunks")


def _chunk_row(chunk: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    body = pack_columns(level=5, **{f"c{i}": c.combine_chunks() for i, c in enumerate(table.columns)})
    return pa.record_batch({"chunk": pa.array([chunk]), "body": pa.array([body], pa.binary())})


class Chunk:
    """The documents of a chunk: bytes, offsets, and doc_ids for comparison (null last)."""

    def __init__(self, body: pa.Buffer, id_at: int, text_at: int):
        self.table = pa.ipc.open_stream(body).read_all().combine_chunks()
        text = pc.fill_null(self.table.column(text_at).combine_chunks(), "")
        self.flat, self.offsets = byte_view(text)
        ids = self.table.column(id_at).cast(pa.int64()).combine_chunks()
        self.ids = pc.fill_null(ids, LAST).to_numpy(zero_copy_only=False)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Key, start, count of suffixes and document of each run, in text order."""
        parts = []
        sizes = np.diff(self.offsets)
        slot = (self.offsets[1:] - 1) // SEGMENT
        cuts = np.flatnonzero(np.diff(slot, prepend=-1)).tolist() + [len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if self.offsets[b] - self.offsets[a] >= LENGTH:
                parts.append(self._runs(a, b))
        empty = np.empty(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (empty.astype(np.uint64), empty, empty, empty)

    def _runs(self, a: int, b: int) -> tuple[np.ndarray, ...]:
        start = int(self.offsets[a])
        keys = least_grams(self.flat[start : self.offsets[b]])
        doc = np.repeat(np.arange(a, b), np.diff(self.offsets[a : b + 1]))
        whole = doc[: len(keys)] == doc[LENGTH - 1 :]  # the first LENGTH bytes are of one document
        doc = doc[: len(keys)]
        opens = whole.copy()
        opens[1:] &= (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1]) | ~whole[:-1]
        at = np.flatnonzero(opens)
        upto = np.concatenate(([0], np.cumsum(whole)))
        return keys[at], start + at, upto[np.append(at[1:], len(keys))] - upto[at], doc[at]


def least_grams(flat: np.ndarray) -> np.ndarray:
    """For each start of LENGTH bytes the least 48-bit hash of the grams within them.

    Least values lie near zero; they are mixed again, one to one, so that keys are even over their range.
    """
    power = lambda e: np.uint64(pow(_BASE, e, 1 << 64))
    # Hashes of 1, 2, 4, 8 and 16 bytes, each from two halves, and then of GRAM = 16 + 4.
    h1 = _BYTES[flat]
    h2 = h1[:-1] * power(1) + h1[1:]
    h4 = h2[:-2] * power(2) + h2[2:]
    h8 = h4[:-4] * power(4) + h4[4:]
    h16 = h8[:-8] * power(8) + h8[8:]
    n = len(flat) - GRAM + 1
    x = h16[:n] * power(4) + h4[16 : 16 + n]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x >>= np.uint64(16)
    width, reach = LENGTH - GRAM + 1, 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    x = np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x
    x = (x * np.uint64(0x9E3779B97F4A7C15)) & np.uint64((1 << 48) - 1)
    x ^= x >> np.uint64(24)
    return (x * np.uint64(0xBF58476D1CE4E5B9)) & np.uint64((1 << 48) - 1)


def content_hashes(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each stretch; works through the bytes by segments."""
    out = np.empty(len(starts), np.uint64)
    slot = starts // SEGMENT
    order = np.argsort(slot, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(slot[order], prepend=-1)), len(order))
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        some = order[a:b]
        base = int(slot[some[0]]) * SEGMENT
        at, n = starts[some] - base, lengths[some]
        part = _BYTES[flat[base : base + int((at + n).max())]]
        step, back = _powers(len(part) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * step[: len(part)], dtype=np.uint64)))
        out[some] = (sums[at + n] - sums[at]) * back[at]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ out >> np.uint64(29)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept by the worker."""
    if not _POWERS or len(_POWERS[0]) < size:
        size = max(size, SEGMENT + (1 << 17))
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            _POWERS[i] = np.cumprod(powers, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes:
    """The stretches one after another."""
    ends = np.cumsum(lengths)
    slot = ends // SEGMENT
    edges = np.append(np.flatnonzero(np.diff(slot, prepend=-1)), len(starts)).tolist()
    return b"".join(flat[ranges(starts[a:b], lengths[a:b])].tobytes() for a, b in zip(edges, edges[1:]))


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the 48-bit keys, so that sorted keys have sorted buckets."""
    return (((keys >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


# ---- round 1: which keys do two documents have ---------------------------------------------


def shared_keys(chunks: DataFrame, buckets: int, id_at: int, text_at: int, hot: int = HOT_SUFFIXES) -> DataFrame:
    """(chunk, bucket, shared): per distinct key of the chunk in order 0 (one document's), 1 (shared) or 2 (hot)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, _, count, doc = Chunk(body.as_buffer(), id_at, text_at).runs()
                order = np.argsort(keys, kind="stable")
                keys, doc, count = keys[order], doc[order], count[order]
                first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
                runs = np.diff(np.append(first, len(keys)))
                several = doc[first] != doc[first + runs - 1] if len(first) else np.empty(0, bool)
                suffixes = np.add.reduceat(count, first) if len(first) else count
                keys = keys[first]
                present, starts = np.unique(_buckets(keys, buckets), return_index=True)
                rows = []
                for a, b in zip(starts, np.append(starts[1:], len(keys))):
                    gap = np.diff(keys[a:b], prepend=np.uint64(0))  # small numbers, but for the first
                    head, gap = int(gap[0]), gap.copy()
                    gap[0] = 0
                    small = gap.astype(np.uint32) if gap.max() < 1 << 32 else gap
                    rows.append((head, pack_columns(gap=small, suffixes=suffixes[a:b].astype(np.uint32), several=several[a:b])))
                yield pa.record_batch({
                    "bucket": pa.array(present), "chunk": pa.array([number] * len(rows), pa.int64()),
                    "head": pa.array([h for h, _ in rows], pa.int64()), "keys": pa.array([k for _, k in rows], pa.binary()),
                })

    def decide(group: pa.Table) -> pa.Table:
        parts = []
        for head, blob in zip(group.column("head").to_pylist(), group.column("keys")):
            gap, suffixes, several = numpy_columns(blob.as_buffer(), "gap", "suffixes", "several")
            parts.append((np.cumsum(gap.astype(np.uint64)) + np.uint64(head), suffixes, several))
        keys = np.concatenate([k for k, _, _ in parts])
        known, which = np.unique(keys, return_inverse=True)
        chunks_with = np.bincount(which)
        local = np.bincount(which, np.concatenate([s for _, _, s in parts])) > 0
        suffixes = np.bincount(which, np.concatenate([n for _, n, _ in parts]))
        shared = np.where((chunks_with > 1) | local, np.where(suffixes > hot, 2, 1), 0).astype(np.uint8)[which]
        ends = np.cumsum([len(k) for k, _, _ in parts])[:-1]
        replies = [pack_columns(shared=x) for x in np.split(shared, ends)]
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"), "shared": pa.array(replies, pa.binary())})

    sent = chunks.mapInArrow(send, "bucket long, chunk long, head long, keys binary")
    return sent.groupBy("bucket").applyInArrow(decide, "chunk long, bucket long, shared binary")


# ---- round 2: runs with shared keys ---------------------------------------------------------


RUNS = "bucket long, chunk long, strings binary, places binary"


def shared_runs(chunks: DataFrame, shared: DataFrame, buckets: int, id_at: int, text_at: int) -> DataFrame:
    """Per bucket and chunk the distinct strings and their places in the smallest document.

    A negative bucket, -1 - chunk, holds the places of the chunk that repeat within it.
    """

    @lean
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        number = left.column("chunk")[0].as_py()
        chunk = Chunk(left.column("body")[0].as_buffer(), id_at, text_at)
        keys, start, count, doc = chunk.runs()
        known, which = np.unique(keys, return_inverse=True)
        flags = np.zeros(len(known), np.uint8)
        edges = np.searchsorted(_buckets(known, buckets), np.arange(buckets + 1))
        for bucket, blob in zip(right.column("bucket").to_pylist(), right.column("shared")):
            (flags[edges[bucket] : edges[bucket + 1]],) = numpy_columns(blob.as_buffer(), "shared")
        of_run = flags[which] if len(which) else np.empty(0, np.uint8)
        single = np.flatnonzero(of_run == 2)
        runs = np.flatnonzero(of_run == 1)
        key, start, count, doc = _with_hot(keys, start, count, doc, runs, single)
        length = count + LENGTH - 1
        content = content_hashes(chunk.flat, start, length)
        key[len(runs) :] = content[len(runs) :] >> np.uint64(16)
        return _run_rows(number, chunk, key, start, length, doc, content, buckets)

    return chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(send, RUNS)


def _with_hot(keys, start, count, doc, runs, hot) -> tuple[np.ndarray, ...]:
    """The runs as they are, then each suffix of the hot ones as a run of its own."""
    singles = ranges(start[hot], count[hot])
    return (
        np.concatenate((keys[runs], np.zeros(len(singles), np.uint64))), np.concatenate((start[runs], singles)),
        np.concatenate((count[runs], np.ones(len(singles), np.int64))), np.concatenate((doc[runs], np.repeat(doc[hot], count[hot]))),
    )


def _run_rows(number, chunk, key, start, length, doc, content, buckets) -> pa.Table:
    ids = chunk.ids[doc] if len(doc) else np.empty(0, np.int64)
    # Equal strings together, by key; in each the smallest document first.
    order = np.lexsort((start, ids, length, content, key))
    key, start, length, ids, content = (x[order] for x in (key, start, length, ids, content))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1]) | (length[1:] != length[:-1])
    first = np.flatnonzero(new)
    string = np.cumsum(new) - 1
    later = ids > ids[first][string] if len(first) else np.empty(0, bool)
    rows = {"bucket": [-1 - number], "chunk": [number], "strings": [None]}
    rows["places"] = [pack_columns(at=start[later].astype(np.uint32), n=length[later].astype(np.uint32))]
    at, n = start[first], length[first]
    flat = pa.py_buffer(gather(chunk.flat, at, n))
    strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(0, np.cumsum(n)).astype(np.int64).tobytes()), flat])
    sent = np.flatnonzero(~later)
    bucket = _buckets(key[first], buckets)
    present, starts = np.unique(bucket, return_index=True)
    for b, s, e in zip(present.tolist(), starts.tolist(), np.append(starts[1:], len(first)).tolist()):
        lo, hi = np.searchsorted(string[sent], [s, e])
        some = sent[lo:hi]
        rows["bucket"].append(b)
        rows["chunk"].append(number)
        # Rising numbers travel as differences, which are small.
        rows["strings"].append(pack_columns(level=5, gap=np.diff(key[first[s:e]], prepend=np.uint64(0)), text=strings.slice(s, e - s)))
        step = np.diff(string[some], prepend=s).astype(np.uint32)
        rows["places"].append(pack_columns(step=step, at=start[some].astype(np.uint32), doc=ids[some]))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds)})


# ---- round 3: repeats ---------------------------------------------------------------------


def repeat_groups(keys: np.ndarray, strings: pa.Array, least_doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """What maximal repeats cover of distinct strings that share a key: (string, offset, length).

    ``least_doc`` is each string's smallest document; strings are sorted by key.  Of every repeat group all
    occurrences outside its smallest document count.  A string that is alone under its key is not looked at here.
    """
    new = np.diff(keys, prepend=keys[:1] + np.uint64(1)) != 0
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1 if len(group) else np.empty(0, bool)
    some = np.flatnonzero(several)
    # Groups are independent: some at a time, so that one array holds about SUFFIXES of them.
    sizes = pc.binary_length(strings).to_numpy()[some].astype(np.int64)
    slot = (np.cumsum(np.maximum(sizes - LENGTH + 1, 0)) - 1) // SUFFIXES
    opens = np.concatenate(([True], group[some][1:] != group[some][:-1])) if len(some) else np.empty(0, bool)
    slot = slot[np.maximum.accumulate(np.where(opens, np.arange(len(some)), 0))]
    cuts = np.append(np.flatnonzero(np.diff(slot, prepend=-1)), len(some)).tolist()
    parts = [_repeats(some[a:b], strings, least_doc) for a, b in zip(cuts, cuts[1:])]
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (empty,) * 3


def _repeats(some: np.ndarray, strings: pa.Array, least_doc: np.ndarray) -> tuple[np.ndarray, ...]:
    flat, offsets = byte_view(strings.take(pa.array(some)))
    sizes = np.diff(offsets)
    suffixes = np.maximum(sizes - LENGTH + 1, 0)
    string = np.repeat(np.arange(len(some)), suffixes)
    starts = ranges(offsets[:-1], suffixes)
    # Longer repeats are covered by the suffixes that start further on in them.
    ends = np.minimum(offsets[1:][string], starts + SUFFIX_BYTES)
    order = suffix_array(flat.tobytes(), starts, ends)
    string, starts, ends = string[order], starts[order], ends[order]
    prefix = common_prefixes(flat, starts, ends)
    found = maximal_repeats(flat, starts, offsets[:-1][string], prefix, LENGTH, SUFFIX_BYTES)
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    docs = least_doc[some][string]
    covers = np.zeros(len(starts), np.int64)
    for depth, first, last in found:  # deeper intervals come first: an occurrence takes its longest repeat
        inside = slice(first, last + 1)
        later = docs[inside] > docs[inside].min()
        covers[inside] = np.where(later & (covers[inside] == 0), depth, covers[inside])
    at = np.flatnonzero(covers)
    string, begin, _, length = merged(string[at], starts[at], covers[at])
    return some[string], begin - offsets[:-1][string], length


def merged(owner: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, start, end and length of the unions of stretches that overlap or touch; starts rise with the owner."""
    if not len(start):
        return owner, start, start, length
    order = np.argsort(start, kind="stable")
    owner, start, end = owner[order], start[order], (start + length)[order]
    reach = np.maximum.accumulate(end)
    opens = np.ones(len(start), bool)
    opens[1:] = (start[1:] > reach[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(start)) - 1
    return owner[first], start[first], reach[last], reach[last] - start[first]


def removed_places(runs: DataFrame) -> DataFrame:
    """(chunk, places): what goes, as starts and lengths in the chunk's bytes."""

    @lean
    def find(group: pa.Table) -> pa.Table:
        kind = {"chunk": pa.int64(), "places": pa.binary()}
        if group.column("bucket")[0].as_py() < 0:
            return pa.table({c: group.column(c).cast(kind[c]) for c in kind})
        tables = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in group.column("strings")]
        keys = np.concatenate([np.cumsum(t.column("gap").to_numpy()) for t in tables])
        coded = pa.concat_arrays([t.column("text").combine_chunks() for t in tables]).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        places = [numpy_columns(b.as_buffer(), "step", "at", "doc") for b in group.column("places")]
        shift = np.concatenate(([0], np.cumsum([t.num_rows for t in tables])[:-1]))
        string = code[np.concatenate([np.cumsum(p[0], dtype=np.int64) + s for p, s in zip(places, shift)])]
        at = np.concatenate([p[1].astype(np.int64) for p in places])
        doc = np.concatenate([p[2] for p in places])
        chunk = np.repeat(group.column("chunk").to_numpy(), [len(p[0]) for p in places])
        distinct = len(coded.dictionary)
        least = np.full(distinct, LAST)
        np.minimum.at(least, string, doc)
        key = np.zeros(distinct, np.uint64)
        key[code] = keys
        sizes = pc.binary_length(coded.dictionary).to_numpy().astype(np.int64)
        whole = np.flatnonzero(doc > least[string])
        out = [(chunk[whole], at[whole], sizes[string[whole]])]
        by_key = np.argsort(key, kind="stable")
        of, offset, depth = repeat_groups(key[by_key], coded.dictionary.take(pa.array(by_key)), least[by_key])
        # Each repeat's places: the string's places in its smallest document (the others have gone already).
        of = by_key[of] if len(of) else of
        rest = np.flatnonzero(doc == least[string])
        rest = rest[np.argsort(string[rest], kind="stable")]
        begin = np.searchsorted(string[rest], of, "left")
        count = np.searchsorted(string[rest], of, "right") - begin
        place = rest[ranges(begin, count)]
        out.append((chunk[place], at[place] + np.repeat(offset, count), np.repeat(depth, count)))
        chunk, at, n = (np.concatenate(c) for c in zip(*out))
        order = np.argsort(chunk, kind="stable")
        numbers, first = np.unique(chunk[order], return_index=True)
        blobs = [pack_columns(at=at[p].astype(np.uint32), n=n[p].astype(np.uint32)) for p in np.split(order, first[1:]) if len(p)]
        return pa.table({"chunk": pa.array(numbers, pa.int64()), "places": pa.array(blobs, pa.binary())})

    return runs.groupBy("bucket").applyInArrow(find, "chunk long, places binary")


# ---- the result -----------------------------------------------------------------------------


def marked(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """One byte for each of ``size`` bytes: whether a stretch covers it."""
    _, first, last, _ = merged(np.zeros(len(at), np.int64), at, n)
    edges = np.stack((first, last), 1).ravel()
    return np.repeat(np.arange(len(edges) + 1) % 2 == 1, np.diff(edges, prepend=0, append=size))


def counts_at(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set before each of the offsets of the documents, of which the first is 0 and the last the end."""
    some = np.flatnonzero(np.diff(offsets))
    found = np.zeros(len(offsets), np.int64)
    if len(some):
        found[some + 1] = np.add.reduceat(flags.view(np.uint8), offsets[some], dtype=np.int64)
    return np.cumsum(found)


def _apply(docs: DataFrame, result: Callable[[Chunk, np.ndarray], pa.Table], schema: str | StructType, hot: int, chunk_bytes: int) -> DataFrame:
    """``result(chunk, gone)`` of every chunk; ``gone`` marks the bytes to remove."""
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")
    buckets = text_parts(docs.select("text"), BUCKET_BYTES)
    chunks = stored_chunks(docs, chunk_bytes)
    shared = materialize(shared_keys(chunks, buckets, id_at, text_at, hot), "shared-keys")
    free_shuffles(docs.sparkSession)
    gone = materialize(removed_places(shared_runs(chunks, shared, buckets, id_at, text_at)), "removed-places")
    free_shuffles(docs.sparkSession)

    @lean
    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left.column("body")[0].as_buffer(), id_at, text_at)
        places = [numpy_columns(blob.as_buffer(), "at", "n") for blob in right.column("places")]
        at, n = (np.concatenate([np.empty(0, np.int64), *(x.astype(np.int64) for x in column)]) for column in zip(*places)) if places else [np.empty(0, np.int64)] * 2
        return result(chunk, marked(at, n, len(chunk.flat)))

    return chunks.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(finish, schema)


def repeat_report(docs: DataFrame, *, hot: int = HOT_SUFFIXES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is kept, per document."""

    def report(chunk: Chunk, gone: np.ndarray) -> pa.Table:
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
        opens[inner] = gone[inner]  # spans end with their document
        removed, spans = counts_at(gone, chunk.offsets), counts_at(opens, chunk.offsets)
        kept = chunk.flat[~gone].tobytes()
        edge = (chunk.offsets - removed).tolist()
        hashes = [hashlib.sha256(kept[i:j]).hexdigest() for i, j in zip(edge, edge[1:])]
        return pa.table({
            "doc_id": chunk.table.column(0).cast(pa.int64()), "n_bytes": pa.array(np.diff(chunk.offsets)), "n_removed": pa.array(np.diff(removed)),
            "n_spans": pa.array(np.diff(spans)), "kept_sha256": pa.array(hashes, pa.string()),
        })

    return _apply(texts(docs), report, REPORT, hot, chunk_bytes)


def remove_repeats(docs: DataFrame, *, hot: int = HOT_SUFFIXES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents with repeats cut out of their texts, and ``n_chars``, if there, set to match.

    Where a cut falls inside a character, the rest of that character goes too.
    """
    schema, text_at = docs.schema, docs.columns.index("text")
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(chunk: Chunk, gone: np.ndarray) -> pa.Table:
        kept = chunk.flat[~gone].tobytes()
        edge = (chunk.offsets - counts_at(gone, chunk.offsets)).tolist()
        null = chunk.table.column(text_at).is_null().to_pylist()
        rows = [None if empty else kept[i:j].decode("utf-8", "ignore") for i, j, empty in zip(edge, edge[1:], null)]
        columns = list(chunk.table.columns)
        columns[text_at] = pa.array(rows, pa.string())
        if count_at is not None:
            columns[count_at] = pa.array([None if r is None else len(r) for r in rows], chunk.table.column(count_at).type)
        return pa.table(columns, names=names)

    names = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]  # any name may occur twice
    plain = docs.toDF(*names)
    out_schema = plain.schema
    result = _apply(plain, cut, out_schema, hot, chunk_bytes)
    return result.toDF(*[f.name for f in schema.fields])
