"""Fuzzy join: for each text the nearest key within a maximum edit distance.

Candidates come from an equi-join on exact blocking keys, never from all pairs:

* A key text of length L is cut into ``parts = 2d+2`` segments (``d+2`` when swaps count twice).  ``parts - 2`` edits
  leave two of them whole.  One of these is displaced in a text within reach by no more than the edits that the segments before and
  after it can hold (the pass-join argument of Li et al., VLDB 2011, with a swap counted as two substitutions).
* How many keys have a segment decides how it is used.  One that over ``HOT_BLOCK`` keys share does not bring texts and
  keys together by itself, but only with a second segment that both have: there is one.
* Key texts too short to cut share, with any text within reach, a string both can be reduced to
  by at most ``d`` deletions.  Such texts have at most ``parts - 1 + d`` characters, so the
  number of reductions has a fixed bound.

Every pair within the distance meets on at least one blocking key, so the result equals that of
comparing all pairs.  A pair is verified once, and only if the counts of its characters allow the distance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from blotterlake.functions.distance import osa_distance, possible_swaps
from blotterlake.session import materialize

HOT_BLOCK = 1000  # keys that share a segment, above which a second one is asked for


def _parts(max_distance: int, metric: str) -> int:
    if metric not in ("osa", "levenshtein"):
        raise ValueError(f"unknown metric {metric!r}")
    return (2 if metric == "osa" else 1) * max_distance + 2


def _segment_start(length: Column, index: Column, parts: int) -> Column:
    """Zero-based start of a segment; the last ``length % parts`` segments are one longer."""
    short = F.floor(length / parts).cast("int")
    longer = F.greatest(index - (parts - length % parts), F.lit(0))
    return index * short + longer


def _reductions(text: Column, max_distance: int) -> Column:
    """Distinct strings left after deleting up to ``max_distance`` characters."""

    def shorter(word: Column) -> Column:
        places = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word)))
        places = F.coalesce(places, F.array().cast("array<int>"))
        return F.transform(
            places,
            lambda i: F.concat(
                F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, F.length(word))
            ),
        )

    words = last = F.array(text)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(max_distance)),
        words,
        lambda found, _: F.array_union(found, F.flatten(F.transform(found, shorter))),
    ) if max_distance else last


def _reduction_blocks(text: Column, max_distance: int) -> Column:
    return F.transform(_reductions(text, max_distance), lambda r: F.xxhash64(F.lit("~"), r))


def _block(length: Column, index: Column, segment: Column) -> Column:
    return F.xxhash64(length, index, segment)


# Characters are counted by kind: letters of either case, digits, and space.
KINDS = [a + b for a, b in zip("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")] + ["0123456789", " "]
LEVELS = 7  # how many of a kind are told apart
PER_NUMBER = 7


def _letters(text: Column) -> Column:
    """Four numbers whose bits count characters by kind: n of a kind set its first min(n, 7) bits.

    An edit changes the count of two kinds by one at most, so two bits.
    """

    def bits(kind: str, place: int) -> Column:
        n = F.least(F.length(text) - F.length(F.translate(text, kind, "")), F.lit(LEVELS))
        ones = F.element_at(F.array(*[F.lit((1 << i) - 1).cast("bigint") for i in range(LEVELS + 1)]), n + 1)
        return F.shiftleft(ones, place * LEVELS)

    numbers = []
    for first in range(0, len(KINDS), PER_NUMBER):
        of_kinds = [bits(kind, i) for i, kind in enumerate(KINDS[first : first + PER_NUMBER])]
        numbers.append(reduce(lambda a, b: a.bitwiseOR(b), of_kinds))
    return F.array(*numbers)


def _may_be_near(left: Column, right: Column, max_distance: int) -> Column:
    """False only where the counts of characters rule the distance out."""
    changed = [F.bit_count(left[i].bitwiseXOR(right[i])) for i in range(4)]
    return sum(changed[1:], changed[0]) <= 2 * max_distance


def key_segments(keys: DataFrame, parts: int) -> DataFrame:
    """(key, key_letters, segment, block) of the keys that are long enough to cut."""
    rows = keys.where(F.length("key") >= parts).withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    length, i = F.length("key"), F.col("segment")
    start, end = (_segment_start(length, at, parts) for at in (i, i + 1))
    return rows.select("key", "key_letters", "segment", _block(length, i, F.substr("key", start + 1, end - start)).alias("block"))


def text_probes(texts: DataFrame, d: int, parts: int, *, surviving: bool = False) -> DataFrame:
    """(text, text_letters, key_length, segment, block): where each segment of keys of each length in reach may be.

    A segment that survives is displaced by the insertions less the deletions before it, of which there are ``d`` at most in all;
    so much for any that survives (``surviving``).  One of them has at most as many edits before it as it has
    segments before it, and likewise behind.
    """
    length = F.length("text")
    rows = texts.where(length + d >= parts).withColumn("key_length", F.explode(F.sequence(F.greatest(length - d, F.lit(parts)), length + d)))
    rows = rows.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    i, edits, longer_by = F.col("segment"), parts - 1, length - F.col("key_length")
    first, last = F.ceil((longer_by - d) / 2).cast("int"), F.floor((longer_by + d) / 2).cast("int")
    if not surviving:
        first, last = F.greatest(first, -i, longer_by - (edits - i)), F.least(last, i, longer_by + (edits - i))
    start = _segment_start(F.col("key_length"), i, parts)
    size = _segment_start(F.col("key_length"), i + 1, parts) - start
    rows = rows.withColumns({"start": start, "size": size, "first": F.greatest(first, -start), "last": F.least(last, length - size - start)})
    rows = rows.where("first <= last").withColumn("shift", F.explode(F.sequence("first", F.greatest("first", "last"))))
    piece = F.substr("text", F.col("start") + F.col("shift") + 1, F.col("size"))
    return rows.select("text", "text_letters", "key_length", "segment", _block(F.col("key_length"), i, piece).alias("block"))


def _split_hot(texts: DataFrame, probes: DataFrame, index: DataFrame, hot: DataFrame, d: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Probes and index with every hot block replaced by its pairs with each other segment that may have survived with it."""
    pair = F.xxhash64("block", "other").alias("block")
    segments = index.select("key", F.col("segment").alias("other_segment"), F.col("block").alias("other"))
    keys_split = index.join(hot, "block", "left_semi").join(segments, "key").where("segment <> other_segment")
    around = text_probes(texts, d, parts, surviving=True)
    around = around.select("text", "key_length", F.col("segment").alias("other_segment"), F.col("block").alias("other"))
    texts_split = probes.join(hot, "block", "left_semi").join(around, ["text", "key_length"]).where("segment <> other_segment")
    return (
        probes.join(hot, "block", "left_anti").select("text", "text_letters", "block").union(texts_split.select("text", "text_letters", pair)),
        index.join(hot, "block", "left_anti").select("key", "key_letters", "block").union(keys_split.select("key", "key_letters", pair)),
    )


def meeting_rows(texts: DataFrame, keys: DataFrame, *, max_distance: int, metric: str, hot_block: int = HOT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """The two sides of the join by ``block``: (text, text_letters, block) and (key, key_letters, block).

    Runs a job that looks for hot blocks among the keys' segments.
    """
    parts = _parts(max_distance, metric)
    spark = texts.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A text makes a few hundred probes, so the few bytes of input must not end in one task.
    dealt = texts.toDF("text").repartition(tasks, "text").withColumn("text_letters", _letters(F.col("text")))
    named = keys.toDF("key").withColumn("key_letters", _letters(F.col("key")))
    index, probes = key_segments(named, parts), text_probes(dealt, max_distance, parts)
    hot = index.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_block)
    hot = materialize(hot.select("block"), "hot-blocks")
    if hot.isEmpty():
        probes, index = probes.select("text", "text_letters", "block"), index.select("key", "key_letters", "block")
    else:
        probes, index = _split_hot(dealt, probes, index, hot, max_distance, parts)
    reduced = lambda column: F.explode(_reduction_blocks(F.col(column), max_distance)).alias("block")
    short_texts = dealt.where(F.length("text") < parts + max_distance).select("text", "text_letters", reduced("text"))
    short_keys = named.where(F.length("key") < parts).select("key", "key_letters", reduced("key"))
    return probes.union(short_texts), index.union(short_keys)


def candidate_pairs(
    texts: DataFrame, keys: DataFrame, *, max_distance: int, metric: str, hot_block: int = HOT_BLOCK
) -> DataFrame:
    """(text, key): the pairs to verify, each once; all within ``max_distance`` are among them.

    Both inputs have one column and distinct non-null values.  Pairs whose lengths or counts of
    characters differ too much for the distance are dropped where they meet.
    """
    probes, index = meeting_rows(texts, keys, max_distance=max_distance, metric=metric, hot_block=hot_block)
    near = _may_be_near(F.col("text_letters"), F.col("key_letters"), max_distance)
    close = F.abs(F.length("text") - F.length("key")) <= max_distance
    return probes.join(index, "block").where(close & near).select("text", "key").distinct()


def near_pairs(texts: DataFrame, keys: DataFrame, *, max_distance: int, metric: str) -> DataFrame:
    """(text, key, edits): every pair within ``max_distance``, and for ``osa`` also those that
    swaps could bring there, once each.  ``edits`` is the Levenshtein distance.
    """
    edits = F.levenshtein("text", "key", _parts(max_distance, metric) - 2)
    pairs = candidate_pairs(texts, keys, max_distance=max_distance, metric=metric)
    return pairs.select("text", "key", edits.alias("edits")).where("edits >= 0")


def fuzzy_match(
    texts: DataFrame, keys: DataFrame, *, max_distance: int = 4, metric: str = "osa"
) -> DataFrame:
    """Nearest key of each text that has one: (text, key, distance).

    Among keys at the least distance the alphabetically first is taken.
    """
    pairs = near_pairs(texts, keys, max_distance=max_distance, metric=metric)
    if metric == "osa":
        # A swap saves one edit, so a pair can only win when half its edits are no more than the
        # best Levenshtein distance of its text: few pairs need their swaps looked at.
        text, key, edits, reach = F.col("text"), F.col("key"), F.col("edits"), F.col("reach")
        best = F.min("edits").over(Window.partitionBy("text"))
        pairs = (
            pairs.withColumn("reach", F.least(best, F.lit(max_distance)))
            .where(edits <= reach * 2)
            .withColumn("swaps", F.when(edits > 1, possible_swaps(text, key)).otherwise(0))
            .where(edits - F.col("swaps") <= reach)
            .withColumn("edits", osa_distance(text, key, edits, F.col("swaps")))
            .where(edits <= max_distance)
        )
    nearest = F.min(F.struct("edits", "key")).alias("best")
    return pairs.groupBy("text").agg(nearest).select(
        "text", "best.key", F.col("best.edits").alias("distance")
    )
