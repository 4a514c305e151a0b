"""Complement Naive Bayes over word counts, kept as tables.

The model is two tables, one row per vocabulary word and one per label, so neither the
vocabulary nor the weights pass through the driver and no vocabulary limit is needed.

The weight of word t for label c is ``-ln((N_t - N_ct + a) / D_c)`` with ``N_t`` the word's count
over all labels, ``N_ct`` its count under c and ``D_c = N - N_c + a*V``.  Split into
``base_t + ln(D_c) + lift_ct``, only the lift depends on both, and it is zero for words never
seen under c.  A text's score for c is then

    sum(base) + words * ln(D_c) + sum(lift)

and every label none of whose words occur scores no better than the one with the largest
``D_c``.  The winner is thus found among the labels seen with the text's words and that one
default label, without a row for each (text, label).

Bases, lifts and ``ln(D_c)`` are whole multiples of 1 / ``UNIT``, so a score is a sum of whole numbers:
it is the same for any partitioning and any number of labels, and equal scores are equal exactly.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blotterlake.functions.keys import holdout_bucket
from blotterlake.functions.text import tokens
from blotterlake.session import materialize, plan_bytes
from blotterlake.sources import versions

UNIT = 10**9  # parts of one in which scores are counted: a text may have 100 million words
HOT_WORDS = 1000  # most frequent words of the scored texts, joined by a broadcast of their own
BROADCAST_BYTES = 16 << 20  # most stored bytes of a model's words to be broadcast whole
HEAD_PAIRS = 200_000  # (word, label) pairs of a larger model's most frequent words, which are broadcast


class NaiveBayesModel(NamedTuple):
    """``words``: word, base, lifts [(label, lift, log_d)]; ``labels``: label, log_d; numbers in ``UNIT``."""

    words: DataFrame
    labels: DataFrame


def training_pairs(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """Rows that have both a text and a label."""
    return df.dropna(subset=[text_col, label_col])


def train_test_split(
    df: DataFrame, *keys: str, train_tenths: int = 7, seed: int = 0, flag_col: str = "is_train"
) -> DataFrame:
    """Mark rows as training rows by a hash of ``keys``; repeatable in any layout."""
    bucket = holdout_bucket(*[F.col(k) for k in keys], seed=seed)
    return df.withColumn(flag_col, bucket < train_tenths)


def token_counts(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, word, n): how often each word occurs in each text."""
    words = df.select(key, F.explode(tokens(F.col(text_col))).alias("word"))
    return words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))


def label_word_counts(
    df: DataFrame, text_col: str, label_col: str, weight_col: str | None = None
) -> DataFrame:
    """(label, word, n) over training rows, each counted ``weight_col`` times.

    Rows with no word count under a null word, so that their label is not lost.
    """
    weight = F.col(weight_col) if weight_col else F.lit(1)
    rows = training_pairs(df, text_col, label_col).select(
        F.col(label_col).alias("label"),
        weight.cast("bigint").alias("n"),
        F.explode_outer(tokens(F.col(text_col))).alias("word"),
    )
    return rows.groupBy("label", "word").agg(F.sum("n").alias("n"))


def fit(
    df: DataFrame,
    text_col: str,
    label_col: str,
    *,
    weight_col: str | None = None,
    alpha: float = 1.0,
) -> NaiveBayesModel:
    """Fit on the rows that have text and label.

    Reads the rows once and stores the (label, word) counts, and from those the model's two tables.
    """
    counts = materialize(label_word_counts(df, text_col, label_col, weight_col), "nb-counts")
    n_words = F.sum(F.when(F.col("word").isNotNull(), F.col("n")).otherwise(0))
    vocabulary = counts.agg(F.count_distinct("word")).scalar()
    total = counts.agg(n_words).scalar()
    labels = counts.groupBy("label").agg(n_words.alias("n_label")).select(
        "label", _units(F.ln(total - F.col("n_label") + F.lit(alpha) * vocabulary)).alias("log_d")
    )
    log_all = F.ln(F.col("n_all") + alpha)
    words = (
        counts.where("word is not null")
        .join(labels, "label")
        .groupBy("word")
        .agg(F.sum("n").alias("n_all"), F.collect_list(F.struct("label", "n", "log_d")).alias("seen"))
        .select(
            "word",
            _units(-log_all).alias("base"),
            F.transform(
                "seen",
                lambda s: F.struct(
                    s["label"].alias("label"),
                    _units(log_all - F.ln(F.col("n_all") - s["n"] + alpha)).alias("lift"),
                    s["log_d"].alias("log_d"),
                ),
            ).alias("lifts"),
        )
    )
    return keep(NaiveBayesModel(words, labels))


def _units(value: Column) -> Column:
    return F.round(value * UNIT).cast("bigint")


def keep(model: NaiveBayesModel) -> NaiveBayesModel:
    """Run the fit once into stored tables."""
    return NaiveBayesModel(*[materialize(t, f"nb-{n}") for n, t in model._asdict().items()])


def save(model: NaiveBayesModel, path: str) -> None:
    """Write both tables into a new version of the model and publish it: readers never meet parts of two."""

    def write(folder: str) -> None:
        for name, table in model._asdict().items():
            table.write.parquet(f"{folder}/{name}")

    versions.publish(model.words.sparkSession, path, write)


def is_saved(spark: SparkSession, path: str) -> bool:
    return versions.current(spark, path) is not None


def load(spark: SparkSession, path: str) -> NaiveBayesModel:
    folder = versions.current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no model at {path}")
    return NaiveBayesModel(*[spark.read.parquet(f"{folder}/{n}") for n in NaiveBayesModel._fields])


def weights(model: NaiveBayesModel) -> DataFrame:
    """(label, word, weight) for the pairs seen in training."""
    return model.words.select("word", "base", F.explode("lifts").alias("l")).select(
        "l.label", "word", ((F.col("base") + F.col("l.log_d") + F.col("l.lift")) / UNIT).alias("weight")
    )


def word_counts(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, word, n): ``token_counts`` and for each row one with a null word and no count."""
    words = F.concat(tokens(F.coalesce(F.col(text_col), F.lit(""))), F.array(F.lit(None).cast("string")))
    exploded = df.select(key, F.explode(words).alias("word"))
    return exploded.groupBy(key, "word").agg(F.count("word").alias("n"))


def frequent_words(counts: DataFrame, most: int = HOT_WORDS) -> DataFrame:
    """The words that most texts have: any other is in under 1 / ``most`` of the rows of ``counts``."""
    found = counts.where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("rows"))
    return found.orderBy(F.col("rows").desc(), "word").limit(most).select("word")


def head_of(table: DataFrame, rank: Column, size: Column, most: int) -> DataFrame:
    """The rows of least ``rank``, as many as ``size`` sums to at most ``most`` over; rows of equal rank stay together.

    One value is found from a table of the distinct ranks, so nothing is sorted and no row passes through the driver.
    """
    sizes = table.groupBy(rank.alias("rank")).agg(F.sum(size.cast("bigint")).alias("size"))
    so_far = F.sum("size").over(Window.orderBy("rank"))
    last = sizes.withColumn("so_far", so_far).where(F.col("so_far") <= most).agg(F.max("rank")).first()[0]
    return table.where(F.lit(False) if last is None else rank <= last)


def _sums(hits: DataFrame, key: str, *more: str) -> DataFrame:
    """(key, label, lift, log_d, base, n_words) of rows of n occurrences of a word; the null label has a text's totals."""
    spread = hits.select(key, *more, "n", "base", F.explode("entries").alias("l"))
    return spread.groupBy(key, *more, F.col("l.label").alias("label")).agg(
        F.sum(F.col("l.lift") * F.col("n")).alias("lift"),
        F.max("l.log_d").alias("log_d"),
        F.sum(F.col("base") * F.col("n")).alias("base"),
        F.sum(F.when(F.col("base").isNotNull(), F.col("n")).otherwise(0)).alias("n_words"),
        F.sum("n").alias("n"),
    )


def _label_sums(
    model_words: DataFrame, df: DataFrame, key: str, text_col: str, broadcast_bytes: int, head_pairs: int
) -> DataFrame:
    """``_sums`` of each text's words in the model, in one row or more for a (key, label); a null label for each text.

    Words that a broadcast knows are summed where the texts lie and shuffled as sums.  The broadcast is the
    model, if it is of up to ``broadcast_bytes``; else its most frequent words with ``head_pairs`` labels in all.  The
    other words are counted and stored with the sums; the most frequent of these, known or not, are joined by a
    bounded broadcast, and only what is left meets the model in a shuffle, in which no word has many rows.
    """
    whole = plan_bytes(model_words) <= broadcast_bytes
    # A null entry per word carries the text's totals; the empty word, at the end of each text, has no other.
    total = F.array(F.lit(None).cast(model_words.schema["lifts"].dataType.elementType))
    model_words = model_words.select("word", "base", F.concat(total, "lifts").alias("entries"))
    head = model_words if whole else head_of(model_words, F.col("base"), F.size("entries") - 1, head_pairs)
    end = df.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(None).cast("bigint").alias("base"), total.alias("entries"))
    words = F.concat(tokens(F.coalesce(F.col(text_col), F.lit(""))), F.array(F.lit("")))
    exploded = df.select(key, F.explode(words).alias("word")).withColumn("n", F.when(F.col("word") != "", 1).otherwise(0))
    known = F.broadcast(head.union(end))
    if whole:
        return _sums(exploded.join(known, "word"), key)
    found = exploded.join(known, "word", "left")
    missed = F.when(F.col("entries").isNull(), F.col("word")).alias("missed")
    sums = _sums(found.select(key, missed, "n", "base", F.coalesce("entries", total).alias("entries")), key, "missed")
    stored = materialize(sums, "nb-sums")
    rest = stored.where("missed is not null").select(key, F.col("missed").alias("word"), "n")
    hot = materialize(frequent_words(rest), "nb-hot-words")
    by_broadcast = rest.join(F.broadcast(hot.join(model_words, "word", "left")), "word")
    by_shuffle = rest.join(F.broadcast(hot), "word", "left_anti").join(model_words, "word")
    columns = [key, "n", "base", "entries"]
    other = _sums(by_broadcast.select(columns).union(by_shuffle.select(columns)), key)
    return stored.where("missed is null").drop("missed").union(other)


def predict(
    model: NaiveBayesModel,
    df: DataFrame,
    key: str,
    text_col: str,
    *,
    output_col: str = "prediction",
    broadcast_bytes: int = BROADCAST_BYTES,
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """(key, prediction, score) for every row; ``key`` must be unique.

    Words outside the vocabulary are ignored.  A text with no known word, and a tie, go to the first label in
    sorted order.  One row per label seen with a word of the text is compared, whatever the number of labels.
    """
    widest = F.min_by("label", F.struct(-F.col("log_d"), F.col("label")))
    default_label = model.labels.agg(widest).scalar()
    default_log_d = model.labels.agg(F.max("log_d")).scalar()
    first_label = model.labels.agg(F.min("label")).scalar()
    sums = _label_sums(model.words, df, key, text_col, broadcast_bytes, head_pairs)
    per_label = sums.groupBy(key, "label").agg(
        F.sum("lift").alias("lift"), F.max("log_d").alias("log_d"), F.sum("base").alias("base"), F.sum("n_words").alias("n_words")
    )
    is_total = F.col("label").isNull()
    per_text = per_label.groupBy(key).agg(
        F.max(F.when(is_total, F.col("base"))).alias("base"),
        F.max(F.when(is_total, F.col("n_words"))).alias("n_words"),
        F.collect_list(F.when(~is_total, F.struct("label", "lift", "log_d"))).alias("seen"),
    )

    def rank(label: Column, log_d: Column, lift: Column) -> Column:
        score = F.col("base") + F.col("n_words") * log_d + lift
        return F.struct((-score).alias("cost"), label.alias("label"))

    candidates = F.transform("seen", lambda s: rank(s["label"], s["log_d"], s["lift"]))
    default = F.array(rank(default_label, default_log_d, F.lit(0).cast("bigint")))
    best = per_text.select(key, "n_words", F.array_min(F.concat(candidates, default)).alias("best"))
    empty = F.col("n_words") == 0
    return best.select(
        key,
        F.when(empty, first_label).otherwise(F.col("best.label")).alias(output_col),
        F.when(empty, F.lit(0.0)).otherwise(-F.col("best.cost") / UNIT).alias("score"),
    )
