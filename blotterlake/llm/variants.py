"""Spelling variants: words one edit apart, found by pivotal grams.

The vocabulary is counted over all texts: in the task first, then by Spark.  A bigram is the rarer, the fewer words hold it.  A word's
*prefix* is its ``GRAMS * EDITS + 1`` rarest bigrams (and those as rare as the last of them); its *pivots* are two disjoint bigrams of the
prefix of least total frequency, chosen by dynamic programming.  One edit destroys one of two disjoint bigrams at most.  So of two words one
edit apart, the one whose prefix ends at the rarer bigram has a pivot that is in the other's prefix, at the same place from the start
or from the end.  The edit also leaves the first or the second half of the pivots' word whole, and that half is part of the key pivots and
prefixes meet by, which keeps the lists of common bigrams short.  Words that meet are verified by their edit distance.
A word has a bounded number of words one edit away (alphabet times length), so no list of near words grows with the table.

Forms (the most frequent near word, if at least ``RATIO`` times as frequent) lead to ever more frequent words, so they form trees of
logarithmic depth; roots are found by pointer jumping over stored tables.

Tables that grow with the vocabulary meet in merge joins.  Spark would size keys like the stored words they are made from, a
hundredth and less of what they fill in a broadcast, and forms at a tenth.

Defined cases: a null text has no words; a null doc_id counts as the empty text in the rule that deletes letters; rows that repeat an id
count each; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blotterlake.llm.common import by_bytes, materialize, texts

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
EDITS = 1
GRAMS = 2  # letters of a gram
DELETE_EVERY = 199
#: Short runs are no words even before a letter is deleted.
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
HELD_WORDS = 300_000
SLICE = 2 << 20


# ---- the vocabulary ---------------------------------------------------------------------------


def runs(text: bytes, doc_id: int | None) -> Iterator[tuple[str, int]]:
    """Words of a text with their counts; a run whose checksum with the id is a multiple of DELETE_EVERY loses a letter."""
    salt = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
    for run, n in Counter(RUN.findall(text.lower().decode("utf-8", "replace"))).items():  # bytes: exactly A-Z
        checksum = zlib.crc32(run.encode(), salt)
        if checksum % DELETE_EVERY == 0:
            at = checksum % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        yield run, n


def vocabulary(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of the words that occur often enough in all texts."""

    def counted(words: Counter) -> pa.RecordBatch:
        return pa.record_batch({"word": pa.array(list(words), pa.string()), "n": pa.array(list(words.values()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in by_bytes(batches, 1, SLICE):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in runs(text.as_buffer().to_pybytes(), doc_id):
                    words[word] += n
            if len(words) > HELD_WORDS:
                yield counted(words)
                words = Counter()
        yield counted(words)

    found = texts(docs).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- pivots and prefixes ----------------------------------------------------------------------


def gram_frequencies(words: DataFrame) -> dict[str, int]:
    """In how many places of the vocabulary each bigram stands; at most the square of the alphabet, so the driver may hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                grams.update(word[i : i + GRAMS] for i in range(len(word) - GRAMS + 1))
        yield pa.record_batch({"gram": pa.array(list(grams), pa.string()), "n": pa.array(list(grams.values()), pa.int64())})

    found = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {row.gram: row.n for row in found.collect()}


def prefix_places(word: str, rank: dict[str, int]) -> list[int]:
    """Places of the rarest ``GRAMS * EDITS + 1`` bigrams and of all as rare as the last of them, in ascending order."""
    ranks = [rank[word[i : i + GRAMS]] for i in range(len(word) - GRAMS + 1)]
    last = sorted(ranks)[: GRAMS * EDITS + 1][-1]
    return [i for i, r in enumerate(ranks) if r <= last]


def pivot_places(word: str, places: list[int], weight: dict[str, int]) -> list[int]:
    """``EDITS + 1`` disjoint bigrams of least total weight.

    ``best[k]`` is the least (weight, places) of k disjoint ones among the places so far; the list of the last GRAMS
    places' tables is what a bigram that overlaps none of them may go on from.
    """
    tables = [(-GRAMS, [(0, ())] + [None] * (EDITS + 1))]
    for place in places:
        before = next(table for at, table in reversed(tables) if at + GRAMS <= place)
        best, cost = list(tables[-1][1]), weight[word[place : place + GRAMS]]
        for k in range(1, EDITS + 2):
            if before[k - 1] is not None:
                taken = (before[k - 1][0] + cost, (*before[k - 1][1], place))
                best[k] = taken if best[k] is None else min(best[k], taken)
        tables.append((place, best))
    return list(tables[-1][1][EDITS + 1][1])


def _halves(word: str, length: int) -> tuple[str, str]:
    """The halves that a word near one of ``length`` letters shares with it: one of them at least."""
    return word[: length // 2], word[len(word) - (length - length // 2) :]


def gram_keys(words: DataFrame, grams: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Pivots and prefixes as (key, place, word, n); the key is of a bigram, a length and a half of the pivots' word."""
    import xxhash

    rank = {gram: i for i, gram in enumerate(sorted(grams, key=lambda g: (grams[g], g)))}

    def rows(batch: pa.RecordBatch, pivots: bool) -> pa.RecordBatch:
        keys, places, owner = [], [], []
        for at, word in enumerate(batch.column(0).to_pylist()):
            found = prefix_places(word, rank)
            found = pivot_places(word, found, grams) if pivots else found
            lengths = (len(word),) if pivots else range(max(len(word) - EDITS, LEAST_LENGTH), len(word) + EDITS + 1)
            for length in lengths:
                sides = [f"{length}{side}{half}|" for side, half in zip("<>", _halves(word, length))]
                for place in found:
                    gram = word[place : place + GRAMS]
                    keys += [xxhash.xxh64_intdigest(side + gram) for side in sides]
                    places += [place] * 2
                    owner += [at] * 2
        row = pa.array(owner, pa.int64())
        return pa.record_batch({
            "key": pa.array(np.array(keys, np.uint64).view(np.int64)), "place": pa.array(places, pa.int32()),
            "word": batch.column(0).take(row), "n": batch.column(1).take(row),
        })

    def keyed(pivots: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in by_bytes(batches, 0, 1 << 17):
                yield rows(batch, pivots)

        return words.select("word", "n").mapInArrow(run, "key long, place int, word string, n long")

    return keyed(True), keyed(False)


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other and other_n of every two words one edit apart, in both orders."""
    pivots, prefixes = gram_keys(words, gram_frequencies(words))
    prefixes = prefixes.toDF("key", "other_place", "other", "other_n")
    shift, longer = F.col("other_place") - F.col("place"), F.length("other") - F.length("word")
    in_place = (shift == 0) | (shift == longer)
    apart = F.levenshtein("word", "other", EDITS) == EDITS
    met = pivots.join(prefixes.hint("merge"), "key").where((F.abs(longer) <= EDITS) & in_place & apart)
    names = ("word", "n", "other", "other_n")
    turned = F.struct(*[F.col(c).alias(name) for c, name in zip(("other", "other_n", "word", "n"), names)])
    return met.select(F.explode(F.array(F.struct(*names), turned)).alias("pair")).select("pair.*").distinct()


# ---- forms and roots --------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """word and root from (word, form): forms followed to the last, twice as far in each round."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = state.join(further.hint("merge"), "root", "left")
        moved = materialize(joined.select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if moved.where("further is not null").isEmpty():
            return state
        state = moved.select("word", "root")


def spelling_variants(docs: DataFrame, *, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word that is frequent enough."""
    words = materialize(vocabulary(docs, least_count), "vocabulary")
    most = F.min(F.struct((-F.col("other_n")).alias("least"), "other")).alias("most")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), most)
    joined = words.join(near.hint("merge"), "word", "left")
    frequent = -F.col("most.least") >= ratio * F.col("n")
    found = joined.select(
        "word", F.when(frequent, F.col("most.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, -F.col("most.least")).alias("form_n"),
    )
    found = materialize(found, "near-words")
    last = roots(found.where("form is not null"))
    return found.join(last.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
