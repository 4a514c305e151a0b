"""Vector bin packing of examples into training sequences.

A sequence has room for so many tokens, segments and loss-bearing tokens at once.  An open
sequence takes, among the examples that fit, the one whose demand has the largest dot product with
the room left (each dimension as a share of its limit, weighted by the mean demand), until nothing
fits.  With ``cut`` a gap is then filled with the head of the largest waiting example, whose
rest waits on; so what is left open is one sequence per partition, which is cut at powers of two.
Where segments or loss run out first, as they do for short examples, a sequence that would be padded by over 1/``FULL``
of its room ends at a power of two and what is behind that waits on.

Packing is local to a partition of the input and streams through it: a bounded number of waiting
tokens is held, nothing is shuffled, no key or source gathers rows.

Defined cases: a null text is empty (the end id alone); null and repeated doc_ids are packed like
others, row by row; an example without tokens gets no piece; without ``cut`` an example over a limit is a
sequence of its own; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from blotterlake.llm.common import by_bytes, task_of, texts
from blotterlake.llm.tokens import encoder

FULL = 64
WAITING_TOKENS = 1 << 22  # packed down to a sixteenth of this whenever more wait
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, segment int, loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048


@dataclass
class Example:
    """What is left of an example: ids[start:] and the running count of loss-bearing tokens."""

    doc_id: int | None
    ids: np.ndarray
    loss: np.ndarray | None  # len(ids) + 1 running counts; None: all tokens but the first
    start: int = 0

    def loss_of(self, start: int, length: int) -> int:
        if self.loss is None:
            return length - (start == 0 and length > 0)
        return int(self.loss[start + length] - self.loss[start])

    def demand(self) -> tuple[int, int]:
        length = len(self.ids) - self.start
        return length, self.loss_of(self.start, length)

    def head(self, tokens: int, loss: int) -> int:
        """The longest prefix of what is left within ``tokens`` and ``loss``."""
        length = min(tokens, len(self.ids) - self.start)
        if self.loss is None:
            return min(length, loss + (self.start == 0))
        most = np.searchsorted(self.loss, self.loss[self.start] + loss, "right") - 1 - self.start
        return min(length, int(most))


@dataclass
class Packer:
    """Packs the examples of one partition; ``rows`` gathers the pieces."""

    limits: Limits
    cut: bool
    first_sequence: int
    keep_ids: bool = False
    rows: list[tuple] = field(default_factory=list)
    ids: list[np.ndarray] = field(default_factory=list)
    waiting: dict[tuple[int, int], list[Example]] = field(default_factory=dict)
    tokens_waiting: int = 0
    sequence: int = 0

    def emit(self, example: Example, length: int, offset: int, segment: int) -> None:
        piece = example.ids[example.start : example.start + length]
        crc = zlib.crc32(piece.astype("<u4").tobytes())
        self.rows.append((
            example.doc_id, example.start, length, crc, len(example.ids), self.first_sequence + self.sequence,
            offset, segment, example.loss_of(example.start, length),
        ))
        if self.keep_ids:
            self.ids.append(piece)
        example.start += length

    def add(self, example: Example) -> None:
        room = self.limits
        while True:
            length, loss = example.demand()
            if length == 0:
                return
            if length < room.tokens and loss <= room.loss_tokens:
                break
            whole = self.unpadded(example.head(room.tokens, room.loss_tokens)) if self.cut else length
            self.emit(example, whole, 0, 0)
            self.sequence += 1
        self.wait(example)
        if self.tokens_waiting > WAITING_TOKENS:
            self.pack(WAITING_TOKENS // 16)

    def unpadded(self, length: int) -> int:
        """How much of a sequence to keep: all if it is nearly full, else a power of two."""
        nearly = length >= self.limits.tokens - self.limits.tokens // FULL
        return length if nearly or not length else 1 << (length.bit_length() - 1)

    def wait(self, example: Example) -> None:
        demand = example.demand()
        if demand[0]:
            self.waiting.setdefault(demand, []).append(example)
            self.tokens_waiting += demand[0]

    def pack(self, leave: int) -> None:
        """Fill sequences until at most ``leave`` tokens wait; with 0 also the last, open one."""
        room = self.limits
        limit = np.array([room.tokens, room.segments, room.loss_tokens], float)
        while self.tokens_waiting > leave:
            # Demands seen more than once are one kind; kinds are sorted, so ties go to the smaller.
            kinds = sorted(self.waiting)
            demand = np.array([(t, 1, s) for t, s in kinds], np.int64).reshape(-1, 3)
            count = np.array([len(self.waiting[k]) for k in kinds])
            share = demand / limit
            value = share * (share * count[:, None]).sum(0) / count.sum() / limit
            new_kinds = 0
            while self.tokens_waiting > leave and count.any() and new_kinds < 512:
                new_kinds += self.fill(kinds, demand, count, value, leave == 0)

    def fill(self, kinds: list, demand: np.ndarray, count: np.ndarray, value: np.ndarray, last: bool) -> int:
        """Fill one sequence from the kinds; returns how many rests of new kinds now wait."""
        room = np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens])
        chosen: list[tuple[Example, int]] = []
        while room[0] and room[1]:
            upto = np.searchsorted(demand[:, 0], room[0], "right")
            fits = (demand[:upto, 2] <= room[2]) & (count[:upto] > 0)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, value[:upto] @ room, -1.0)))
            example = self.take(kinds[best])
            count[best] -= 1
            chosen.append((example, kinds[best][0]))
            room -= demand[best]
        rest = None
        while self.cut and rest is None and room[0] and room[1] and self.waiting:
            # The kinds at hand may be used up while rests of a new kind wait.
            largest = int(np.flatnonzero(count)[-1]) if count.any() else None
            kind = max(self.waiting) if largest is None else kinds[largest]
            length = self.waiting[kind][-1].head(int(room[0]), int(room[2]))
            if not length:
                break
            example = self.take(kind)
            if largest is not None:
                count[largest] -= 1
            chosen.append((example, length))
            room -= (length, 1, example.loss_of(example.start, length))
            if length < kind[0]:
                rest = example
        if self.cut and last and room[0] and rest is None and not self.waiting:
            self.close_at_powers(chosen)
            return 0
        size = sum(length for _, length in chosen)
        size = self.unpadded(size) if self.cut else size
        offset, rests = 0, 0
        for segment, (example, length) in enumerate(chosen):
            length = min(length, size - offset)
            if length:
                self.emit(example, length, offset, segment)
                offset += length
            if example.start < len(example.ids):
                self.wait(example)
                rests += length > 0
        self.sequence += 1
        return rests

    def take(self, kind: tuple[int, int]) -> Example:
        found = self.waiting[kind]
        example = found.pop()
        if not found:
            del self.waiting[kind]
        self.tokens_waiting -= kind[0]
        return example

    def close_at_powers(self, chosen: list[tuple[Example, int]]) -> None:
        """Sequences of falling power-of-two lengths, which need no padding."""
        left = sum(length for _, length in chosen)
        size, offset, segment = 1 << (left.bit_length() - 1) if left else 0, 0, 0
        for example, length in chosen:
            while length:
                some = min(length, size - offset)
                self.emit(example, some, offset, segment)
                offset, segment, length, left = offset + some, segment + 1, length - some, left - some
                if offset == size:
                    self.sequence += 1
                    size, offset, segment = 1 << (left.bit_length() - 1) if left else 0, 0, 0

    def drain(self) -> pa.RecordBatch:
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.int32() if f.endswith(" int") else pa.int64() for f in PIECES.split(", ")]
        columns = list(zip(*self.rows)) or [[] for _ in names]
        batch = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}
        if self.keep_ids:
            ends = np.concatenate(([0], np.cumsum([len(x) for x in self.ids], dtype=np.int64)))
            flat = np.concatenate([*self.ids, np.empty(0, np.uint16)]).astype(np.int32)
            batch["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        self.rows, self.ids = [], []
        return pa.record_batch(batch)


SLICE = 4 << 20  # bytes of text encoded at a time
HELD_WORDS = 1_000_000  # by an encoder; packing holds little else


def _schema(with_ids: bool) -> str:
    return PIECES + (", ids array<int>" if with_ids else "")


def _packer(limits: Limits, cut: bool, with_ids: bool) -> Packer:
    return Packer(limits, cut, TaskContext.get().partitionId() << 32, with_ids)


def pack_documents(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), *, with_ids: bool = False, held_words: int = HELD_WORDS,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """One row per piece of a document: where it starts in the document and where in a sequence.

    A document is its ids and the end id; all but its first token are loss-bearing.  ``with_ids``
    adds the piece's ids, so that the rows of a sequence by ``offset`` are its content.  ``held_words`` and ``slice_bytes`` bound
    what a worker holds, and change no result.
    """

    @task_of("packing")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = encoder(tokenizer, held_words), _packer(limits, True, with_ids)
        for batch in by_bytes(batches, 1, slice_bytes):
            ids, ends = words.texts(batch.column(1))
            for doc_id, a, b in zip(batch.column(0).to_pylist(), ends.tolist(), ends[1:].tolist()):
                packer.add(Example(doc_id, ids[a:b], None))
            yield packer.drain()
        packer.pack(0)
        yield packer.drain()

    return texts(docs).mapInArrow(run, _schema(with_ids))


def pack_examples(
    examples: DataFrame, limits: Limits = Limits(), *, id_col: str = "example_id", ids_col: str = "ids",
    loss_col: str | None = "loss", cut: bool = False, with_ids: bool = True,
) -> DataFrame:
    """The same for tokenised examples with a loss mask, as instruction data has.

    ``loss_col`` is an array of booleans as long as the ids (true: the token bears loss); null, or
    no column, stands for all tokens but the first.  Null ids are no tokens.
    """
    loss = F.col(loss_col).cast("array<boolean>") if loss_col else F.lit(None).cast("array<boolean>")
    rows = examples.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<long>").alias("ids"),
        loss.alias("loss"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _packer(limits, cut, with_ids)
        for batch in batches:
            for doc_id, ids, mask in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = np.array(ids or [], np.uint32)
                if mask is not None and len(mask) != len(found):
                    raise ValueError(f"example {doc_id}: {len(found)} ids but {len(mask)} loss flags")
                running = None if mask is None else np.concatenate(([0], np.cumsum([bool(m) for m in mask], dtype=np.int64)))
                packer.add(Example(doc_id, found, running))
            yield packer.drain()
        packer.pack(0)
        yield packer.drain()

    return rows.mapInArrow(run, _schema(with_ids))
