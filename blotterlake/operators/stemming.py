"""Stemming by a dictionary of distinct words.

Spark has no stemmer, and a Python call per row would stem the same few words over and over.  Here every distinct
word is stemmed once; the words that change, with their stems, are a stored table that the texts' words are joined with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blotterlake.functions.stem import stem_words
from blotterlake.functions.text import clean_text
from blotterlake.operators.bayes import head_of
from blotterlake.session import materialize, plan_bytes

BROADCAST_BYTES = 16 << 20  # most bytes of the words that change, and their stems, to be broadcast whole
HEAD_WORDS = 200_000  # most frequent words of a larger dictionary, which are broadcast
DEALT_BYTES = 8 << 20  # stored bytes of texts whose words a task holds


def _words(text: Column) -> Column:
    return F.split(F.trim(text), r"\s+")


def word_stems(words: DataFrame) -> DataFrame:
    """word, n and stem of the distinct words of a column ``word``; n is how often they occur.

    Counted before anything is shuffled; Python sees each distinct word once.
    """
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("stem", stem_words(F.col("word")))


def stem_dictionary(words: DataFrame) -> DataFrame:
    """``word_stems`` of the words that differ from their stems."""
    return word_stems(words).where("stem <> word").select("word", "stem", "n")


def _folded(words: DataFrame, word: Column, name: str) -> DataFrame:
    """__row and ``name``: its words with their places."""
    return words.groupBy("__row").agg(F.collect_list(F.struct("__place", word.alias("word"))).alias(name))


def stem_texts(
    df: DataFrame, text_col: str, *, broadcast_bytes: int = BROADCAST_BYTES, head_words: int = HEAD_WORDS
) -> DataFrame:
    """The table with every word of ``text_col`` replaced by its stem; words are parted by single spaces.

    Runs two jobs: the rows are stored with a number each, and the dictionary is stored.  The texts are then dealt by
    number, once, and their words get their stems by a broadcast and are folded back where they lie.  The broadcast is
    of the words that change, if the dictionary's stored bytes allow it; else of the ``head_words`` words that occur most,
    changed or not, and only the others, of which none occurs more often than those, are joined in a shuffle.  Null
    texts stay null.
    """
    numbered = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "texts-to-stem")
    dealt = numbered.repartition(max(1, -(-plan_bytes(numbered) // DEALT_BYTES)), "__row")

    def exploded(rows: DataFrame) -> DataFrame:
        return rows.select("__row", F.posexplode(_words(F.col(text_col))).alias("__place", "word"))

    stems = materialize(word_stems(exploded(numbered).select("word")), "stems")
    changed = stems.where("stem <> word")
    share = changed.agg(F.coalesce(F.sum(F.octet_length("word") + F.octet_length("stem")), F.lit(0))).first()[0]
    if share <= broadcast_bytes:
        joined = exploded(dealt).join(F.broadcast(changed.select("word", "stem")), "word", "left")
        folded = _folded(joined, F.coalesce("stem", "word"), "__words")
    else:
        head = head_of(stems, -F.col("n"), F.lit(1), head_words).select("word", "stem")
        folded = _folded(exploded(dealt).join(F.broadcast(head), "word"), F.col("stem"), "__words")
        rare = exploded(numbered).join(F.broadcast(head.select("word")), "word", "left_anti")
        beside = _folded(rare.join(changed.select("word", "stem"), "word", "left"), F.coalesce("stem", "word"), "__rare")
        both = folded.join(beside, "__row", "full")
        none = F.array().cast(folded.schema["__words"].dataType)
        folded = both.select("__row", F.concat(F.coalesce("__words", none), F.coalesce("__rare", none)).alias("__words"))
    placed = F.transform(F.array_sort("__words"), lambda w: w["word"])
    texts = folded.select("__row", F.array_join(placed, " ").alias("__text"))
    kept = dealt.select("__row", *[F.col(f"`{c}`") for c in df.columns if c != text_col])
    joined = kept.join(texts, "__row", "left")
    return joined.select(*[F.col("__text").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])


def clean_texts(
    df: DataFrame, text_col: str, out_col: str = "text", *, stem: bool = True, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``out_col``: the cleaned text (``clean_text``), with its words stemmed unless ``stem`` is off."""
    cleaned = df.withColumn(out_col, clean_text(F.col(text_col), stem=False))
    return stem_texts(cleaned, out_col, broadcast_bytes=broadcast_bytes) if stem else cleaned
