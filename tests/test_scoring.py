"""Stemming by dictionary, and Naive Bayes scores that depend on no order."""

import random

import pytest
from pyspark.sql import functions as F

from blotterlake.functions.stem import stem_word
from blotterlake.operators import bayes, stemming
from blotterlake.session import materialize

from test_classify import textbook_scores

TEXTS = ["stolen vehicles", "", None, "running runner runs", "the  trespassing", "vehicles vehicles", " ties cries ", "x" * 300, "straße cafés"]


def stems(text):
    return None if text is None else " ".join(map(stem_word, text.split()))


@pytest.mark.parametrize("size", [1 << 30, 0])
def test_words_are_stemmed_in_place(spark, size):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame(rows, "n int, text string, word string").repartition(5)
    found = stemming.stem_texts(df, "text", broadcast_bytes=size)
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect())) == sorted((n, stems(t), w) for n, t, w in rows)


def test_long_texts_and_hot_words(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("walk", "talk", "theft", "batteri", "generous") for b in ("s", "ing", "ed", "ly", "")]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([3, 4000])))) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, text string")
    found = {r.id: r.text for r in stemming.stem_texts(df, "text", broadcast_bytes=0).collect()}
    assert found == {i: stems(t) for i, t in rows}


def test_python_sees_each_distinct_word_once(spark):
    df = spark.range(2000).selectExpr("id", "concat('walking dogs number ', id % 3) AS text")
    plan = stemming.clean_texts(df, "text", "clean")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "stems" in plan
    words = df.select(F.explode(F.split("text", " ")).alias("word"))
    found = {r.word: (r.stem, r.n) for r in stemming.stem_dictionary(words).collect()}
    assert found == {"walking": ("walk", 2000), "dogs": ("dog", 2000)}


@pytest.mark.parametrize("head", [0, 3, 1 << 20])
def test_words_in_or_beside_the_head_are_stemmed_alike(spark, head):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame(rows, "n int, text string").repartition(5)
    found = stemming.stem_texts(df, "text", broadcast_bytes=0, head_words=head)
    assert sorted(map(tuple, found.collect())) == sorted((n, stems(t)) for n, t in rows)


def test_frequent_words_without_a_change_are_not_shuffled(spark):
    """Words that are their own stems and fill the texts are joined by broadcast, too, and folded where they lie."""
    df = spark.createDataFrame([(i, "de la " * 500 + f"walking dogs{i}s") for i in range(20)], "id int, text string")
    found = stemming.stem_texts(df, "text", broadcast_bytes=0, head_words=3)
    head = next(d for d in found.inputFiles() if "/stems-" in d).rsplit("/", 1)[0]
    ranked = spark.read.parquet(head).orderBy(F.desc("n"), "word").limit(3).collect()
    assert [(r.word, r.stem, r.n) for r in ranked] == [("de", "de", 10_000), ("la", "la", 10_000), ("walking", "walk", 20)]
    assert {r.text for r in found.collect()} == {"de la " * 500 + f"walk {stem_word(f'dogs{i}s')}" for i in range(20)}


def test_no_rows_have_no_stems(spark):
    assert stemming.clean_texts(spark.createDataFrame([], "id int, text string"), "text", "clean").collect() == []


# ---- Naive Bayes ------------------------------------------------------------------------------


def train_rows(labels, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [(" ".join(rng.choices(words, k=rng.randrange(1, 9))), f"label{i % labels:03d}", 1 + i % 3) for i in range(4 * labels)]


@pytest.mark.parametrize("labels", [1, 64, 65])
@pytest.mark.parametrize("size", [1 << 30, 0])
def test_any_number_of_labels(spark, labels, size):
    train = train_rows(labels)
    model = bayes.fit(spark.createDataFrame(train, "text string, label string, n int"), "text", "label", weight_col="n")
    texts = [t for t, _, _ in train_rows(20, seed=2)] + ["", "nothing known", "w1"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in bayes.predict(model, rows, "id", "text", broadcast_bytes=size).collect():
        scores = textbook_scores(train, texts[r.id])
        label = min(scores, key=lambda c: (-round(scores[c], 7), c))
        assert (r.prediction, round(r.score, 6)) == (label, round(scores[label], 6))


def test_scores_of_a_million_words_are_the_same_in_every_layout(spark):
    rng = random.Random(9)
    train = train_rows(65)
    model = bayes.fit(spark.createDataFrame(train, "text string, label string, n int"), "text", "label", weight_col="n")
    texts = [" ".join(rng.choices([f"w{i}" for i in range(60)], k=n)) for n in (1_000_000, 300_000, 5)] + ["w1 w2", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = [
        sorted(map(tuple, bayes.predict(model, rows.repartition(parts), "id", "text", broadcast_bytes=size).collect()))
        for parts, size in ((1, 1 << 30), (7, 1 << 30), (3, 0))
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 5


@pytest.mark.parametrize("pairs", [0, 9, 1 << 20])
def test_words_in_or_beside_the_head_score_alike(spark, pairs):
    train = train_rows(5)
    model = bayes.fit(spark.createDataFrame(train, "text string, label string, n int"), "text", "label", weight_col="n")
    texts = [f"{t} unseen unseen" for t, _, _ in train_rows(10, seed=3)] + ["", None, "unseen"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    whole = bayes.predict(model, rows, "id", "text")
    parts = bayes.predict(model, rows, "id", "text", broadcast_bytes=0, head_pairs=pairs)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect())) and parts.count() == len(texts)
    sizes = model.words.select("word", "base", "lifts", F.size("lifts").alias("size"))
    head = bayes.head_of(sizes, F.col("base"), F.col("size"), pairs)
    assert (head.agg(F.sum("size")).first()[0] or 0) <= pairs


def test_frequent_words_are_stored_as_sums(spark):
    """A large model's frequent words leave a row per (text, label), not one per (text, word)."""
    words = [f"w{i}" for i in range(200)]
    model = bayes.fit(spark.createDataFrame([(" ".join(words), c) for c in "ab"], "text string, label string"), "text", "label")
    rows = spark.range(50).select("id", F.lit(" ".join(words)).alias("text"))
    found = bayes.predict(model, rows, "id", "text", broadcast_bytes=0)
    stored = {f.rsplit("/", 1)[0] for f in found.inputFiles() if "/nb-" in f} - {f.rsplit("/", 1)[0] for f in model.words.inputFiles()}
    assert sum(spark.read.parquet(f).count() for f in stored) <= 50 * 3
    assert found.count() == 50


def test_equal_labels_tie_exactly(spark):
    train = spark.createDataFrame([("red car", "b"), ("red car", "a"), ("bus", "c")], "text string, label string")
    model = bayes.fit(train, "text", "label")
    long = spark.createDataFrame([(1, "red " * 99_991 + "car"), (2, "car")], "id int, text string")
    for size in (1 << 30, 0):
        assert {r.prediction for r in bayes.predict(model, long, "id", "text", broadcast_bytes=size).collect()} == {"a"}


def test_frequent_and_missing_words_fill_no_partition(spark):
    """On a Zipf table, what is left for the shuffle join has no word with over 1/50 of the rows."""
    rng = random.Random(6)
    words, weights = [f"z{i}" for i in range(3000)], [1 / (i + 1) for i in range(3000)]
    texts = [" ".join(rng.choices(words, weights, k=30)) for _ in range(400)] + [""] * 300
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    counts = materialize(bayes.word_counts(rows, "id", "text"), "zipf")
    hot = bayes.frequent_words(counts, 100)
    rest = counts.where("word is not null").join(hot, "word", "left_anti")
    n, share = rest.count(), rest.groupBy("word").count().agg(F.max("count")).first()[0]
    assert n > 2000 and share <= 0.02 * n
    sizes = rest.repartition(40, "word").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes <= 0.06 * n  # 1/40 each, and no more than chance adds
    assert counts.where("word is null").count() == 700 and "z0" in {r.word for r in hot.collect()}
