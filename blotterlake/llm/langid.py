"""Language identification by error-correcting output codes over n-gram classifiers.

Every language has a codeword; one binary classifier per bit tells the languages with that bit from those without
it, by the log-likelihood ratio of hashed byte bigrams and trigrams (languages weigh alike, so a language with most
of the documents does not pull the others).  All statistics come from all labelled documents: a table of
(language, bin) counts.  Decoding is loss-weighted: the distance of a codeword is the sum over bits of log(1 + exp(-y m)), y the
codeword's sign and m the margin, weighted by how well the bit's two sides are told apart.  The nearest codeword wins; if the
next one is nearly as near, the text is flagged ambiguous.

Defined cases: text that is null or has no letter is ``und`` with score 0, as is everything if nothing was learned;
one learned language is predicted with score 1; documents with a null lang are not learned from; null and repeated doc_ids are
rows like others; an empty table gives no rows.  Extra columns are kept by ``keep_known`` and not read elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blotterlake.llm.common import by_bytes, by_place, crc_class, materialize, task_of

BINS = 1 << 15
SCALE = 4096  # weights are whole multiples of 1 / SCALE, so sums do not depend on their order
SMOOTHING = 0.5
AMBIGUOUS = 0.05  # of the total bit weight, between the two nearest codewords
SLICE = 512 << 10  # bytes of text whose n-grams are held at a time
APART_ROWS = 512  # codewords compared with all others at a time
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
TO_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # bits x BINS, in units of 1 / SCALE
    bit_weight: np.ndarray


def normal_bytes(text: str) -> bytes:
    """Lower-case letters with single spaces between and around words."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(TO_SPACE).split()) + b" "


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the bigrams and trigrams at each byte, the texts' starts, and where each kind may start."""
    rows = [normal_bytes(t) for t in texts]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.frombuffer(b"".join(rows) + b"  ", np.uint8).astype(np.uint32)
    pair = flat[:-2] << np.uint32(8) | flat[1:-1]
    triple = pair << np.uint32(8) | flat[2:]
    mix = lambda code, salt: ((code + np.uint32(salt)) * np.uint32(2654435761)) >> np.uint32(32 - 15)
    starts = np.cumsum(sizes) - sizes
    ends = np.cumsum(sizes)
    two, three = np.ones(len(pair), bool), np.ones(len(pair), bool)
    two[ends - 1] = three[ends - 1] = three[np.maximum(ends - 2, starts)] = False
    return mix(pair, 1 << 25), mix(triple, 0), starts, np.stack([two, three])


def gram_counts(docs: DataFrame, label: str, text: str) -> DataFrame:
    """(language, bin, n): n-gram counts of the labelled rows, summed in the task before the shuffle."""

    @task_of("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in by_bytes(batches, 1, SLICE):
            labels = batch.column(0).to_pylist()
            two, three, starts, valid = grams(batch.column(1).to_pylist())
            of_text = np.repeat(np.arange(len(labels)), np.diff(np.append(starts, len(two))))
            names = sorted(set(labels))
            number = np.array([names.index(x) for x in labels])[of_text]
            for bins, may in ((two, valid[0]), (three, valid[1])):
                found = np.bincount(number[may] * BINS + bins[may], minlength=len(names) * BINS).reshape(-1, BINS)
                for name, row in zip(names, found):
                    counts[name] = counts.get(name, 0) + row
            if len(counts) > 64:  # many labels: hand over what is there
                yield from _count_rows(counts)
                counts = {}
        yield from _count_rows(counts)

    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(label).cast("string").alias("language"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "language string, bin int, n long").groupBy("language", "bin").agg(F.sum("n").alias("n"))


def _count_rows(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, row in counts.items():
        bins = np.flatnonzero(row)
        yield pa.record_batch({
            "language": pa.array([name] * len(bins), pa.string()), "bin": pa.array(bins.astype(np.int32)),
            "n": pa.array(row[bins].astype(np.int64)),
        })


def codewords(languages: int) -> np.ndarray:
    """All distinct splits for up to six languages; else the widest apart of seeded random codes."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 6:
        columns = np.arange(1, 1 << (languages - 1))
        return np.where(columns[None, :] >> np.arange(languages)[:, None] & 1, 1, -1).astype(np.int8)
    rng, best, width = np.random.default_rng(20), None, 16 + 4 * int(np.ceil(np.log2(languages)))
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, width))
        code = code[:, np.abs(code.sum(0, dtype=int)) < languages]
        least = _least_apart(code)
        if best is None or least > best[0]:
            best = (least, code)
    return best[1]


def _least_apart(code: np.ndarray) -> int:
    """Least number of bits in which two codewords differ."""
    least, whole = code.shape[1], code.astype(np.float32)
    for at in range(0, len(code), APART_ROWS):
        alike = whole[at : at + APART_ROWS] @ whole.T
        alike[np.arange(len(alike)), np.arange(at, at + len(alike))] = -code.shape[1]
        least = min(least, int(code.shape[1] - alike.max()) // 2)
    return least


def fit(docs: DataFrame, label: str = "lang", text: str = "text") -> Model:
    """Learn from all rows with a label and a text.

    The counts are made in one pass and stored; the driver takes in one language (a row of bins) at a time and holds what the
    model has: sums for each bit and bin.
    """
    counts = materialize(gram_counts(docs, label, text), "gram-counts")
    languages = tuple(sorted(r.language for r in counts.select("language").distinct().collect()))
    code = codewords(len(languages))
    with_bit, without = np.zeros((code.shape[1], BINS)), np.zeros((code.shape[1], BINS))
    rows = counts.groupBy("language").agg(F.collect_list(F.struct("bin", "n")).alias("bins")).orderBy("language")
    for signs, row in zip(code, rows.toLocalIterator(prefetchPartitions=False)):
        share = np.full(BINS, SMOOTHING)
        bins, n = (np.array(x) for x in zip(*row.bins))
        share[bins] += n
        share /= share.sum()
        with_bit[signs > 0] += share
        without[signs < 0] += share
    with_bit /= np.maximum((code > 0).sum(0), 1)[:, None]
    without /= np.maximum((code < 0).sum(0), 1)[:, None]
    ratio = np.log(with_bit / without)
    bit_weight = ((with_bit - without) * ratio).sum(1)
    total = bit_weight.sum() or 1.0
    return Model(languages, code, np.round(ratio * SCALE).astype(np.int32), bit_weight / total)


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    ambiguous = np.zeros(len(texts), bool)
    some = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
    if not some or not model.languages:
        return names, scores, ambiguous
    if len(model.languages) == 1:
        for i in some:
            names[i] = model.languages[0]
        scores[some] = 1.0
        return names, scores, ambiguous
    two, three, starts, valid = grams([texts[i] for i in some])
    n = np.add.reduceat(valid.sum(0), starts)
    margins = []
    for row in model.weights:
        at_byte = np.where(valid[0], row[two], 0).astype(np.int64) + np.where(valid[1], row[three], 0)
        margins.append(np.add.reduceat(at_byte, starts))
    margin = np.array(margins).T / SCALE / np.sqrt(n)[:, None]
    # Distance of every codeword: the loss of each bit's margin under the codeword's sign.
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None, :, :]) @ model.bit_weight
    order = np.argsort(loss, axis=1, kind="stable")
    nearest, second = (np.take_along_axis(loss, order[:, i : i + 1], 1)[:, 0] for i in (0, 1))
    share = np.exp(-(loss - nearest[:, None]))
    for at, i in enumerate(some):
        names[i] = model.languages[order[at, 0]]
    scores[some] = 1.0 / share.sum(1)
    ambiguous[some] = second - nearest < AMBIGUOUS
    return names, scores, ambiguous


def training_rows(docs: DataFrame) -> DataFrame:
    """Labelled documents outside the held-out class of crc32(doc_id as text) mod 4."""
    return docs.where((crc_class(4) != 2) & F.col("lang").isNotNull()).select("lang", "text")


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every document."""

    @task_of("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2, SLICE):
            names, scores, ambiguous = predict(model, batch.column(2).to_pylist())
            yield pa.record_batch({
                "doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(scores), "ambiguous": pa.array(ambiguous),
            })

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (crc_class(4) == 2).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """Documents in a language the model knows; those without one (``und``) go.  All columns as given."""
    at = docs.columns.index("text")
    plain = by_place(docs, "text").withColumn("text", F.col("text").cast("string"))

    @task_of("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, at, SLICE):
            names, _, _ = predict(model, batch.column(at).to_pylist())
            yield batch.filter(pa.array([name != UNKNOWN for name in names]))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
