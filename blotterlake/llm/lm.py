"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Texts are coded once into stored chunks: a dictionary of word hashes and one code per token.  Word counts over all
training documents are summed by hash bucket, and every chunk gets back the counts of its own words, so neither the
vocabulary nor the counts pass through one task or the driver.

The neural model predicts a class from the two classes before it: the most frequent words, the end, and one class
for all other words, which is shared out by their smoothed counts.  With context vectors r and output vectors q the score is
``(a1 * r[w1] + a2 * r[w2]) . q[w] + b[w]``.  Each task trains on its chunks with numpy against noise drawn from the
unigram distribution; the parameters of all tasks are averaged by tokens.  Because the score is a sum of one matrix
per context place, the normaliser of every possible context comes from one matrix product,
``exp(A1) diag(exp(b)) exp(A2)'``, so scores are exact log-probabilities.

Defined cases: a null text is empty (the end alone); null and repeated doc_ids are rows like others, a null id hashing as
the empty string; without training documents every count is 0 and the model is uniform; an empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from blotterlake.llm.common import by_bytes, crc_class, materialize, numpy_columns, pack_columns, text_parts, texts

CHUNK_BYTES = 12 << 20
WORDS = 1021  # most frequent words with a class of their own
START, END, RARE, FIRST_WORD = 0, 1, 2, 3
END_HASH = np.uint64(0)  # the end's entry in a dictionary; no word is hashed to it
WIDTH = 24
NOISE = 64
BATCH = 8192
RATE = 0.1
CHUNK_SCHEMA = "chunk long, docs binary, words binary, codes binary"
BUCKET_SCHEMA = "chunk long, bucket int, counts binary, top binary, tokens long, distinct long, ends long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# ---- coding and counting ------------------------------------------------------------------


def _coded(doc_ids: pa.Array, held_out: np.ndarray, text: pa.Array) -> tuple[bytes, bytes, bytes]:
    import xxhash

    whole = text.take(pa.array(np.arange(len(text)))).cast(pa.large_string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(whole))
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    found = lists.flatten().dictionary_encode()
    words = found.dictionary.cast(pa.large_binary()).to_pylist()
    codes = found.indices.to_numpy()
    of_doc = np.repeat(np.arange(len(counts)), counts)
    if b"" in words:  # white space at the edges of a text
        real = codes != words.index(b"")
        codes, of_doc = codes[real], of_doc[real]
    counts = np.bincount(of_doc, minlength=len(counts))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 7) or 1 for w in words), np.uint64, len(words))
    hashes = np.append(hashes, END_HASH)
    codes = np.insert(codes, np.cumsum(counts), len(words)).astype(np.uint32)
    training = np.repeat(~held_out, counts + 1)
    seen = np.bincount(codes[training], minlength=len(hashes))
    return (
        pack_columns(doc_id=doc_ids, held_out=held_out, n=counts + 1), pack_columns(hash=hashes, n=seen),
        pack_columns(code=codes),
    )


def coded_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, chunk = 0, TaskContext.get().partitionId() << 32

        def coded() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            doc_ids, held_out, text = (rows.column(i).combine_chunks() for i in range(3))
            blobs = _coded(doc_ids, held_out.to_numpy(zero_copy_only=False).astype(bool), text)
            names = ("docs", "words", "codes")
            return pa.record_batch({"chunk": pa.array([chunk]), **{n: pa.array([b], pa.binary()) for n, b in zip(names, blobs)}})

        for batch in by_bytes(batches, 2):
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(2))).as_py() or 0
            if size >= chunk_bytes:
                yield coded()
                held, size, chunk = [], 0, chunk + 1
        if held:
            yield coded()

    rows = texts(docs, (crc_class(5) == 1).alias("held_out")).select("doc_id", "held_out", "text")
    return rows.mapInArrow(run, CHUNK_SCHEMA)


def word_totals(chunks: DataFrame, buckets: int, words: int = WORDS) -> DataFrame:
    """Counts summed over all chunks, returned to every chunk; rows with a null chunk sum a bucket up."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes, n = numpy_columns(blob.as_buffer(), "hash", "n")
                bucket = (hashes % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                present, starts = np.unique(bucket[order], return_index=True)
                parts = np.split(order, starts[1:])
                yield pa.record_batch({
                    "bucket": pa.array(present), "chunk": pa.array([chunk] * len(present), pa.int64()),
                    "part": pa.array([pack_columns(hash=hashes[p], n=n[p]) for p in parts], pa.binary()),
                })

    def total(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        parts = [numpy_columns(b.as_buffer(), "hash", "n") for b in group.column("part")]
        hashes = np.concatenate([h for h, _ in parts])
        known, which = np.unique(hashes, return_inverse=True)
        sums = np.bincount(which, np.concatenate([n for _, n in parts]), len(known)).astype(np.int64)
        ends = np.cumsum([len(h) for h, _ in parts])[:-1]
        replies = [pack_columns(n=c) for c in np.split(sums[which], ends)]
        words_only = known != END_HASH
        best = np.lexsort((known[words_only], -sums[words_only]))[:words]
        top = pack_columns(hash=known[words_only][best], n=sums[words_only][best])
        blank = [None] * len(replies)
        return pa.table({
            "chunk": pa.array([*group.column("chunk").to_pylist(), None], pa.int64()),
            "bucket": pa.array([bucket] * (len(replies) + 1), pa.int32()),
            "counts": pa.array([*replies, None], pa.binary()), "top": pa.array([*blank, top], pa.binary()),
            "tokens": pa.array([*blank, int(sums.sum())], pa.int64()),
            "distinct": pa.array([*blank, int((sums > 0).sum())], pa.int64()),
            "ends": pa.array([*blank, int(sums[~words_only].sum())], pa.int64()),
        })

    parts = chunks.select("chunk", "words").mapInArrow(deal, "bucket int, chunk long, part binary")
    return parts.groupBy("bucket").applyInArrow(total, BUCKET_SCHEMA)


# ---- the model ----------------------------------------------------------------------------


@dataclass
class LogBilinear:
    """Classes: START (context only), END, RARE, then words in the order of ``hashes``."""

    hashes: np.ndarray  # sorted
    counts: np.ndarray  # training tokens per class
    tokens: int
    distinct: int
    context: np.ndarray = field(default=None)
    output: np.ndarray = field(default=None)
    place: np.ndarray = field(default=None)
    bias: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.context is None:
            size, rng = len(self.counts), np.random.default_rng(4)
            self.context = rng.normal(0, 0.3, (size, WIDTH))
            self.output = np.zeros((size, WIDTH))
            self.place = np.ones((2, WIDTH))
            self.bias = np.log(self.noise())

    def noise(self) -> np.ndarray:
        """Smoothed unigram distribution over classes; START is never predicted."""
        share = self.counts + 0.5
        share[START] = 1e-12
        return share / share.sum()

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        at_most = np.minimum(at, max(len(self.hashes) - 1, 0))
        own = self.hashes[at_most] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        return np.where(hashes == END_HASH, END, np.where(own, FIRST_WORD + at_most, RARE)).astype(np.int32)

    def parameters(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.output, self.place, self.bias)])

    def with_parameters(self, values: np.ndarray) -> LogBilinear:
        shapes = [x.shape for x in (self.context, self.output, self.place, self.bias)]
        cuts = np.split(values, np.cumsum([int(np.prod(s)) for s in shapes])[:-1])
        return LogBilinear(self.hashes, self.counts, self.tokens, self.distinct, *[c.reshape(s) for c, s in zip(cuts, shapes)])

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (previous, next) and (one before, next), and log normalisers by both contexts."""
        first = (self.context * self.place[0]) @ self.output.T
        second = (self.context * self.place[1]) @ self.output.T + self.bias
        second[:, START] = -np.inf  # not a prediction
        top1, top2 = first.max(1, keepdims=True), second.max(1, keepdims=True)
        sums = np.exp(first - top1) @ np.exp(second - top2).T
        return first, second, np.log(sums) + top1 + top2.T


def contexts(classes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each token, START beyond a text's beginning."""
    starts = np.cumsum(n) - n
    one = np.concatenate(([START], classes[:-1]))
    one[starts] = START
    two = np.concatenate(([START], one[:-1]))
    two[starts] = START
    return one, two


class Trainer:
    """Adagrad on the noise-contrastive objective; the noise of a batch is shared by its tokens."""

    def __init__(self, model: LogBilinear, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.noise = model.noise()
        self.log_noise = np.log(NOISE * self.noise)
        self.cumulative = np.cumsum(self.noise)
        self.slopes = [np.full(x.shape, 1e-4) for x in (model.context, model.output, model.place, model.bias)]

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        m = self.model
        size = len(m.counts)
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), size - 1)
        r1, r2, q = m.context[one], m.context[two], m.output[word]
        hidden = r1 * m.place[0] + r2 * m.place[1]
        against = m.output[drawn]
        data = 1 / (1 + np.exp((hidden * q).sum(1) + m.bias[word] - self.log_noise[word]))
        noise = -1 / (1 + np.exp(-(hidden @ against.T + m.bias[drawn] - self.log_noise[drawn])))
        slope = data[:, None] * q + noise @ against
        into = lambda at, rows: np.stack([np.bincount(at, rows[:, i], size) for i in range(WIDTH)], 1)
        context = into(one, slope * m.place[0]) + into(two, slope * m.place[1])
        output = into(word, data[:, None] * hidden) + into(drawn, noise.T @ hidden)
        place = np.stack([(slope * r1).sum(0), (slope * r2).sum(0)])
        bias = np.bincount(word, data, size) + np.bincount(drawn, noise.sum(0), size)
        for values, seen, up in zip((m.context, m.output, m.place, m.bias), self.slopes, (context, output, place, bias)):
            up = up / len(word)
            seen += up * up
            values += RATE * up / np.sqrt(seen)

    def chunk(self, classes: np.ndarray, n: np.ndarray, held_out: np.ndarray) -> int:
        one, two = contexts(classes, n)
        use = np.flatnonzero(np.repeat(~held_out, n))
        self.rng.shuffle(use)
        for at in range(0, len(use), BATCH):
            some = use[at : at + BATCH]
            self.step(one[some], two[some], classes[some])
        return len(use)


def train(chunks: DataFrame, model: LogBilinear) -> LogBilinear:
    """One pass over all training tokens; the tasks' parameters averaged by their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, tokens = None, 0
        for batch in batches:
            for chunk, docs, words, codes in zip(batch.column(0).to_pylist(), *(batch.column(i) for i in (1, 2, 3))):
                trainer = trainer or Trainer(model.with_parameters(model.parameters().copy()), chunk)
                held_out, n = numpy_columns(docs.as_buffer(), "held_out", "n")
                (hashes,) = numpy_columns(words.as_buffer(), "hash")
                (code,) = numpy_columns(codes.as_buffer(), "code")
                tokens += trainer.chunk(model.classes(hashes)[code], n, held_out.astype(bool))
        if tokens:
            values = trainer.model.parameters()
            yield pa.record_batch({
                "i": pa.array(np.arange(len(values), dtype=np.int32)), "value": pa.array(values * tokens),
                "weight": pa.array(np.full(len(values), float(tokens))),
            })

    rows = chunks.select("chunk", "docs", "words", "codes").mapInArrow(run, "i int, value double, weight double")
    means = rows.groupBy("i").agg((F.sum("value") / F.sum("weight")).alias("mean")).toArrow()
    values = model.parameters()
    values[means.column("i").to_numpy()] = means.column("mean").to_numpy()
    return model.with_parameters(values)


def shortlist(totals: DataFrame, words: int = WORDS) -> LogBilinear:
    """The untrained model over the most frequent words; reads one row per bucket and ``words`` counts."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                hashes, n = numpy_columns(blob.as_buffer(), "hash", "n")
                yield pa.record_batch({"hash": pa.array(hashes.view(np.int64)), "n": pa.array(n)})

    sums = totals.where("chunk is null")
    tokens, distinct, ends = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "distinct", "ends")]).first()
    top = sums.select("top").mapInArrow(unpack, "hash long, n long").where("n > 0").orderBy(F.desc("n"), "hash").limit(words).toArrow()
    hashes = top.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    own = top.column("n").to_numpy()[order].astype(float)
    rare = tokens - ends - own.sum()
    return LogBilinear(hashes[order], np.concatenate(([0.0, ends, rare], own)), tokens, distinct)


# ---- scoring ------------------------------------------------------------------------------

_TABLES: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables(model: LogBilinear) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = model.bias.tobytes()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = model.tables()
    return _TABLES[key]


def scored(chunks: DataFrame, totals: DataFrame, model: LogBilinear, buckets: int) -> DataFrame:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        doc_ids = pa.ipc.open_stream(left.column("docs")[0].as_buffer()).read_all().column("doc_id")
        held_out, n = numpy_columns(left.column("docs")[0].as_buffer(), "held_out", "n")
        (hashes,) = numpy_columns(left.column("words")[0].as_buffer(), "hash")
        (code,) = numpy_columns(left.column("codes")[0].as_buffer(), "code")
        counts = np.zeros(len(hashes), np.int64)
        bucket = (hashes % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b, blob in zip(right.column("bucket").to_pylist(), right.column("counts")):
            (counts[order[edges[b] : edges[b + 1]]],) = numpy_columns(blob.as_buffer(), "n")
        starts = np.cumsum(n) - n
        base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
        classes = model.classes(hashes)
        # A word without a class: the rare class, shared out by smoothed counts among such words.
        own_words = np.count_nonzero(model.counts[FIRST_WORD:]) + (model.counts[END] > 0)
        rare_words = model.distinct - own_words
        within = np.where(classes == RARE, np.log10((counts + 0.5) / (model.counts[RARE] + 0.5 * (rare_words + 1))), 0.0)
        by_token = classes[code]
        one, two = contexts(by_token, n)
        first, second, normal = _tables(model)
        log_p = (first[one, by_token] + second[two, by_token] - normal[one, two]) / np.log(10) + within[code]
        total = lambda x: pa.array(np.add.reduceat(x, starts) if len(starts) else x[:0])
        return pa.table({
            "doc_id": doc_ids.combine_chunks(), "held_out": pa.array(held_out.astype(bool)), "n_tokens": pa.array(n.astype(np.int64)),
            "n_known": total((counts > 0).astype(np.int64)[code]), "train_tokens": pa.array(np.full(len(n), model.tokens, np.int64)),
            "base_score": total(base[code]), "score": total(log_p),
        })

    replies = totals.where("chunk is not null").select("chunk", "bucket", "counts")
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(score, SCORES)


def score_documents(docs: DataFrame, *, chunk_bytes: int = CHUNK_BYTES, words: int = WORDS) -> DataFrame:
    """Base and model log10 probabilities of every document; learns from those not held out."""
    buckets = text_parts(texts(docs), chunk_bytes)
    chunks = materialize(coded_chunks(docs, chunk_bytes), "coded-chunks")
    totals = materialize(word_totals(chunks, buckets, words), "word-totals")
    model = train(chunks, shortlist(totals, words))
    return scored(chunks, totals, model, buckets)
