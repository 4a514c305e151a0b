"""Fuzzy join, rules, Naive Bayes and the cascade."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from blotterlake.config import Settings
from blotterlake.functions.stem import stem_word
from blotterlake.functions.text import clean_text
from blotterlake.operators import bayes, lookups
from blotterlake.operators.fuzzy import candidate_pairs, fuzzy_match, meeting_rows, text_probes
from blotterlake.operators.lookups import attach_resolved, pivot_charges, unpivot_charges
from blotterlake.operators.quality import (
    accuracy, binary_confusion, confusion_cells, confusion_matrix, confusion_pairs, coverage_report,
)
from blotterlake.operators.rules import apply_rules
from blotterlake.plans import classify as cascade
from blotterlake.session import materialize, scratch_path
from blotterlake.sources import tables, versions


def edits(a, b, swaps=True):
    """Distance by its definition, for checking."""
    table = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            options = [
                table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i - 1] != b[j - 1]),
            ]
            if swaps and i > 1 and j > 1 and a[i - 2 : i] == b[j - 2 : j][::-1]:
                options.append(table[i - 2, j - 2] + 1)
            table[i, j] = min(options)
    return table[len(a), len(b)]


def nearest(texts, keys, d, swaps=True):
    out = set()
    for t in texts:
        distance, key = min((edits(t, k, swaps), k) for k in keys)
        if distance <= d:
            out.add((t, key, distance))
    return out


def match(spark, texts, keys, **options):
    one = lambda values: spark.createDataFrame([(v,) for v in values], "v string")
    return {tuple(r) for r in fuzzy_match(one(texts), one(keys), **options).collect()}


@pytest.mark.parametrize("metric", ["osa", "levenshtein"])
@pytest.mark.parametrize("d", [0, 2, 4])
def test_blocked_match_equals_all_pairs(spark, metric, d):
    rnd = random.Random(d)
    word = lambda n: "".join(rnd.choice("abcd ") for _ in range(n))
    keys = sorted({word(rnd.randint(0, 22)) for _ in range(80)})

    def damaged(text):
        chars = list(text)
        for _ in range(rnd.randint(0, 6)):
            at = rnd.randint(0, max(len(chars) - 2, 0))
            kind = rnd.randint(0, 3)
            if kind == 0:
                chars.insert(at, rnd.choice("abcde"))
            elif chars and kind == 1:
                chars.pop(at)
            elif chars and kind == 2:
                chars[at] = rnd.choice("abcde")
            else:
                chars[at : at + 2] = chars[at : at + 2][::-1]
        return "".join(chars)

    texts = sorted({damaged(rnd.choice(keys)) for _ in range(150)} | {word(rnd.randint(0, 12)) for _ in range(30)})
    got = match(spark, texts, keys, max_distance=d, metric=metric)
    assert got == nearest(texts, keys, d, metric == "osa")


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.sets(st.text("ab|é", max_size=20), min_size=1, max_size=12),
    st.sets(st.text("ab|é", max_size=20), min_size=1, max_size=12),
)
def test_blocked_match_property(spark, texts, keys):
    assert match(spark, sorted(texts), sorted(keys), max_distance=3) == nearest(texts, keys, 3)


def test_match_goldens(spark):
    keys = ["retail theft", "simple battery", "simple battary", "armed robbery of a person"]
    texts = ["reatil theft", "simple battxry", "armed robbery of x prsn", "unlike any of these", ""]
    assert match(spark, texts, keys) == {
        ("reatil theft", "retail theft", 1),
        ("simple battxry", "simple battary", 1),  # tie: alphabetically first
        ("armed robbery of x prsn", "armed robbery of a person", 3),
    }


def test_distance_four_matches_and_five_does_not(spark):
    key = "criminal trespass to land"
    assert match(spark, ["criminal trespass to l", "criminal trespass to xxxx"], [key]) == {
        ("criminal trespass to l", key, 3), ("criminal trespass to xxxx", key, 4),
    }
    assert match(spark, ["criminal trespass txxxxxd"], [key]) == set()


def test_match_without_broadcast(spark):
    """The same result when Spark may not broadcast the key side."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts, keys = [f"possession of item {i}x" for i in range(60)], [f"possession of item {i}" for i in range(60)]
        assert match(spark, texts, keys) == nearest(texts, keys, 4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(
    "word,stem",
    [
        ("consistency", "consist"), ("knackeries", "knackeri"), ("knightly", "knight"), ("hopping", "hop"),
        ("hoping", "hope"), ("generously", "generous"), ("happily", "happili"), ("ties", "tie"),
        ("cries", "cri"), ("gas", "gas"), ("kiwis", "kiwi"), ("dying", "die"), ("controlling", "control"),
        ("batteries", "batteri"), ("trespassing", "trespass"), ("yearly", "year"), ("say", "say"), ("by", "by"),
    ],
)
def test_stems(word, stem):
    assert stem_word(word) == stem


def test_clean_text_golden(spark):
    df = spark.createDataFrame(
        [("  The CAFÉ's 25 doors, in-line with abc1 & #9",), ("",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(clean_text(F.col("t"), stem=False)).collect()]
    assert got == ["cafe doors in line abc1", "", None]  # a hyphenated word is one word
    assert df.select(clean_text(F.lit("stolen vehicles")).alias("x")).first().x == "stolen vehicl"


def test_rules_first_wins_and_keeps_known(spark):
    df = spark.createDataFrame(
        [("CTA - x", None, None), ("CTA - y", "Theft", None), ("other", None, None), ("cta - z", None, None)],
        "description string, micro string, macro string",
    )
    rules = (("CTA - ", "Nuisance", "Other"), ("CTA", "Second", "Second"))
    got = {r.description: (r.micro, r.macro) for r in apply_rules(df, rules).collect()}
    assert got == {
        "CTA - x": ("Nuisance", "Other"), "CTA - y": ("Theft", "Other"), "other": (None, None),
        "cta - z": (None, None),
    }


TRAIN = [
    ("red car car", "b", 2), ("red bus", "a", 1), ("bus bus stop", "a", 3), ("", "c", 4), (None, "a", 9),
    ("red", None, 9),
]


def textbook_scores(rows, text):
    """Complement Naive Bayes straight from its definition."""
    rows = [(t, c, n) for t, c, n in rows if t is not None and c is not None]
    counts = {c: {} for _, c, _ in rows}
    for t, c, n in rows:
        for w in t.split():
            counts[c][w] = counts[c].get(w, 0) + n
    vocabulary = sorted({w for c in counts.values() for w in c})
    out = {}
    for c in sorted(counts):
        rest = {w: 1 + sum(counts[o].get(w, 0) for o in counts if o != c) for w in vocabulary}
        total = sum(rest.values())
        out[c] = sum(-math.log(rest[w] / total) for w in text.split() if w in rest)
    return out


@pytest.mark.parametrize("size", [1 << 30, 0])
def test_naive_bayes_against_definition(spark, size):
    train = spark.createDataFrame(TRAIN, "text string, label string, n int")
    texts = ["red car", "bus", "stop red", "unknown words", "", "bus stop red car", "car unknown"]
    model = bayes.fit(train, "text", "label", weight_col="n")
    said = bayes.predict(
        model, spark.createDataFrame([(t,) for t in texts], "text string").withColumn("id", F.col("text")),
        "id", "text", broadcast_bytes=size,
    )
    got = {r.id: (r.prediction, round(r.score, 6)) for r in said.collect()}
    assert set(got) == set(texts)
    for t in texts:
        scores = textbook_scores(TRAIN, t)
        label = min(scores, key=lambda c: (-round(scores[c], 9), c))
        assert got[t] == (label, round(scores[label], 6)), t


def test_weighted_rows_equal_repeated_rows(spark):
    pairs = spark.createDataFrame([("red car", "x", 3), ("bus stop", "y", 2)], "text string, label string, n int")
    repeated = pairs.select("text", "label", F.explode(F.sequence(F.lit(1), "n")))
    a = bayes.weights(bayes.fit(pairs, "text", "label", weight_col="n")).orderBy("word").collect()
    b = bayes.weights(bayes.fit(repeated, "text", "label")).orderBy("word").collect()
    assert a == b


def test_model_is_reused_until_overwritten(spark):
    path = scratch_path(spark, "model-test")
    train = spark.createDataFrame([("red car", "x"), ("bus", "y")], "text string, label string")
    bayes.save(bayes.keep(bayes.fit(train, "text", "label")), path)
    rows = spark.createDataFrame([(1, "bus")], "id int, text string")
    assert bayes.predict(bayes.load(spark, path), rows, "id", "text").first().prediction == "y"


SMALL = Settings(slots=2, stem=False)
CROSSWALK = [
    ("retail theft", "Theft", "Property", False, 1),
    ("armed robbery", "Robbery", "Violent", True, 2),
    ("simple battery", "Battery", "Violent", True, 3),
    ("retail theft", "Shoplifting", "Property", False, 4),
    (None, "Nuisance", "Other", None, 5),
]
CHARGES = [
    (1, "retail theft", "armed robbery"), (2, "retial theft", None), (3, "CTA - loud", "simple battery"),
    (4, None, None), (5, "robbery while armed and masked", "retail theft"), (6, "armed robbery", None),
    (7, "simple battery", "simple batery"), (8, "something else altogether", None),
]


@pytest.fixture(scope="module")
def small(spark):
    crosswalk = spark.createDataFrame(
        CROSSWALK,
        "description string, micro_category string, macro_category string, police_related boolean, line_no int",
    )
    df = spark.createDataFrame(
        CHARGES, "arrest_id bigint, charge_1_description string, charge_2_description string"
    )
    classified, result = cascade.classify(df, crosswalk, SMALL)
    return df, classified, result


def test_cascade_methods(small):
    resolved = {r.description: r for r in small[2].resolved.collect()}
    assert {d: r.micro_method for d, r in resolved.items()} == {
        "retail theft": "direct", "armed robbery": "direct", "simple battery": "direct",
        "retial theft": "fuzzy", "simple batery": "fuzzy", "CTA - loud": "rule",
        "robbery while armed and masked": "nlp", "something else altogether": "nlp",
    }
    assert resolved["retail theft"].micro == "Shoplifting"  # last row wins
    assert resolved["retial theft"].micro == "Shoplifting"
    # Macro is looked up from the final micro, so the rule's own macro does not stay.
    assert (resolved["CTA - loud"].micro, resolved["CTA - loud"].macro) == ("Nuisance", "Other")
    assert resolved["CTA - loud"].police_method == "nlp"
    assert all(r.micro is not None and r.police is not None for r in resolved.values())


def test_both_ways_to_write_back_agree(spark, small):
    df, classified, result = small
    columns = sorted(classified.columns)
    for ids in (F.col("arrest_id"), F.lit(7), F.when(F.col("arrest_id") % 2 == 0, 1), F.lit(None).cast("bigint")):
        rows = df.withColumn("arrest_id", ids)
        ways = [
            attach_resolved(rows, result.resolved, Settings(slots=2, broadcast_bytes=size)).select(columns)
            for size in (1 << 30, 0)
        ]
        one, other = (sorted(map(str, way.collect())) for way in ways)
        assert one == other and len(one) == len(CHARGES)
    assert classified.count() == len(CHARGES)
    empty = classified.where("arrest_id = 4").first()
    assert all(empty[c] is None for c in columns if c != "arrest_id")


def test_spread_join_equals_plain_join(spark, monkeypatch):
    monkeypatch.setattr(lookups, "HOT_KEYS", 2)
    keys = ["hot"] * 50 + ["warm"] * 5 + ["cold", "unknown", None]
    df = spark.createDataFrame(list(enumerate(keys)), "id bigint, k string")
    lookup = spark.createDataFrame(
        [("hot", None, 50), ("warm", "w", 5), ("cold", "c", 1), ("unused", "u", 0)], "k string, v string, n int"
    )
    spread = lookups.join_spread(df, lookup, "k", F.col("n"), spread_by="id").select("id", "k", "v")
    plain = df.join(lookup, "k", "left").select("id", "k", "v")
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_coverage_counts_every_slot_once(small):
    report = coverage_report(small[2].resolved, SMALL).collect()
    for target in ("micro", "police"):
        assert sum(r.n for r in report if r.target == target and r.slot == 1) == 7
        assert sum(r.n for r in report if r.target == target and r.slot == 2) == 4


def test_unpivot_then_pivot_is_identity(spark, small):
    df = small[0].where("arrest_id <> 4")
    back = pivot_charges(unpivot_charges(df, SMALL), ["description"], SMALL)
    assert sorted(map(tuple, back.select(df.columns).collect()), key=str) == sorted(
        map(tuple, df.collect()), key=str
    )


def test_nothing_left_to_map_is_fine(spark):
    crosswalk = spark.createDataFrame(
        [("a charge", "M", "N", True)],
        "description string, micro_category string, macro_category string, police_related boolean",
    )
    df = spark.createDataFrame([(1, "a charge")], "arrest_id bigint, charge_1_description string")
    classified, _ = cascade.classify(df, crosswalk, Settings(slots=1, stem=False))
    assert classified.first().charge_1_description_category_macro == "N"
    # and with nothing known at all, values stay null
    unknown = spark.createDataFrame([(1, "zzzzzzzzzzzzzzzzzzzz")], df.schema)
    classified, _ = cascade.classify(unknown, crosswalk, Settings(slots=1, stem=False))
    assert classified.first().charge_1_description_category_micro is None


def test_split_on_description_keeps_copies_together(spark):
    df = spark.range(200).selectExpr("id as arrest_id", "concat('d', id % 10) as charge_1_description")
    rows = cascade.describe(df, Settings(slots=1, split_on="description")).collect()
    assert all((r.n_train == 0) != (r.n_test == 0) for r in rows)
    mixed = cascade.describe(df, Settings(slots=1)).collect()
    assert sum(r.n_train for r in mixed) + sum(r.n_test for r in mixed) == 200


def test_stored_run_is_reused(spark):
    crosswalk = spark.createDataFrame(
        [("a charge", "M", "N", True)],
        "description string, micro_category string, macro_category string, police_related boolean",
    )
    schema = "arrest_id bigint, charge_1_description string, arrest_year int"
    df = spark.createDataFrame([(1, "a charge", 2020)], schema)
    out, models = scratch_path(spark, "run"), scratch_path(spark, "models")
    options = Settings(slots=1, stem=False)
    first = cascade.run_classify(
        spark, df, crosswalk, out, options, model_folder=models, shared_csv=scratch_path(spark, "csv")
    )
    again = cascade.run_classify(spark, df.limit(0), crosswalk, out, options)
    assert first.collect() == again.collect()
    assert bayes.is_saved(spark, f"{models}/micro")


def test_a_half_written_model_is_never_read(spark, monkeypatch):
    """Words of one fit and labels of another must never be read as one model."""
    path = scratch_path(spark, "half")
    fit = lambda *rows: bayes.fit(spark.createDataFrame(rows, "text string, label string"), "text", "label")
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_announce", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            bayes.save(fit(("one two", "A"), ("three", "B")), path)
    assert not bayes.is_saved(spark, path)
    bayes.save(fit(("one two", "X"), ("three", "Y")), path)
    reader = bayes.load(spark, path)
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_announce", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            bayes.save(fit(("four", "P"), ("five", "Q")), path)
    assert {r.label for r in bayes.load(spark, path).labels.collect()} == {"X", "Y"}
    bayes.save(fit(("one two", "V"), ("three", "W")), path)
    assert {r.label for r in bayes.weights(bayes.load(spark, path)).collect()} == {"V", "W"}
    assert {r.label for r in bayes.weights(reader).collect()} == {"X", "Y"}  # a reader that has begun goes on


def test_accuracy_and_matrices(spark):
    df = spark.createDataFrame(
        [("a.b", "a.b", 3), ("a.b", "c", 1), ("c", "c", 2)], "label string, prediction string, n int"
    )
    row = accuracy(df, weight_col="n").first()
    assert (row.n_correct, row.n, round(row.accuracy, 6)) == (5, 6, 0.833333)
    pairs = confusion_pairs(df, weight_col="n")
    odd = pairs.union(spark.createDataFrame([("c", 'new, "z"', 4)], pairs.schema))
    cells = {(r.label, r.prediction): r.n for r in confusion_cells(odd).collect()}
    assert len(cells) == 9 and cells["a.b", "c"] == 1 and cells['new, "z"', "c"] == 0
    assert sum(cells.values()) == 10  # a label seen only as a prediction is not dropped
    path = scratch_path(spark, "matrix")
    tables.write_matrix_csv(confusion_matrix(confusion_cells(odd)), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert back.columns == ["label", "a.b", "c", 'new, "z"'] and back.count() == 3
    flags = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "label int, prediction int")
    assert tuple(binary_confusion(flags).first()) == (1, 1, 0, 2)


def test_materialize_survives_in_shared_folder(spark):
    stored = materialize(spark.range(5).toDF("x"), "test")
    assert stored.count() == 5 and "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_fuzzy_pairs_are_verified_once_and_few(spark):
    """On charge-like names: each pair once, far fewer than a length filter leaves."""
    words = ["theft", "assault", "battery", "robbery", "burglary", "fraud", "arson", "trespass", "simple", "armed", "retail", "domestic"]
    names = [f"{a} {b}" for a in words for b in words]
    texts = [n.replace("e", "3", 1) for n in names] + ["theft", "tehft", "arsn", "fraud x"]
    df = lambda values: spark.createDataFrame([(v,) for v in dict.fromkeys(values)], "s string")
    keys = names + ["theft", "arson", "dui"]
    pairs = [tuple(r) for r in candidate_pairs(df(texts), df(keys), max_distance=4, metric="osa").collect()]
    by_length = sum(abs(len(a) - len(b)) <= 4 for a in set(texts) for b in set(keys))
    assert len(pairs) == len(set(pairs)) and len(pairs) < by_length / 4


@pytest.mark.parametrize("metric,d", [("osa", 2), ("osa", 4), ("levenshtein", 3)])
def test_hot_segments_lose_no_pair(spark, metric, d):
    """Keys with a long common beginning; every segment that three keys share counts as hot."""
    rnd = random.Random(d)
    word = lambda n: "".join(rnd.choice("abcde ") for _ in range(n))
    keys = sorted({"attempted possession of " + word(rnd.randint(0, 9)) for _ in range(60)} | {word(rnd.randint(0, 30)) for _ in range(40)})
    texts = set()
    for _ in range(150):
        chars = list(rnd.choice(keys))
        for _ in range(rnd.randint(0, d + 1)):
            at = rnd.randint(0, max(len(chars) - 1, 0))
            chars[at : at + rnd.choice([0, 1, 2])] = rnd.choice(["", "x", "e", "".join(chars[at : at + 2][::-1])])
        texts.add("".join(chars))
    texts = sorted(texts)
    df = lambda values: spark.createDataFrame([(v,) for v in values], "s string")
    pairs = [tuple(r) for r in candidate_pairs(df(texts), df(keys), max_distance=d, metric=metric, hot_block=3).collect()]
    near = {(t, k) for t in texts for k in keys if edits(t, k, metric == "osa") <= d}
    assert near <= set(pairs) and len(pairs) == len(set(pairs))


def test_a_hot_segment_brings_few_rows_together(spark):
    """300 keys and texts that share their first segment: by it alone all would meet, with a second one few do."""
    rnd = random.Random(1)
    tail = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(33))
    keys = [f"possession {tail()}" for _ in range(300)]
    texts = [k[:-3] + "zzz" for k in keys[:100]] + [f"possession {tail()}" for _ in range(200)]
    df = lambda values: spark.createDataFrame([(v,) for v in values], "s string")

    def met(hot_block):
        probes, index = meeting_rows(df(texts), df(keys), max_distance=2, metric="levenshtein", hot_block=hot_block)
        return probes.join(index, "block").count()

    assert met(1000) >= 300 * 300 and met(50) <= 300 * 10


def test_probes_of_a_text_are_bounded(spark):
    """By the lengths in reach, the segments and their places: no probe for each key."""
    text = "criminal trespass to state supported land"
    probes = lambda surviving: text_probes(
        spark.createDataFrame([(text, [0, 0, 0, 0])], "text string, text_letters array<bigint>"), 4, 10, surviving=surviving
    ).count()
    assert probes(False) <= 9 * 10 * 5 and probes(False) <= probes(True) <= 9 * 10 * 5
