"""Language identification and language-model scoring: held-out quality and plain counts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from blotterlake.llm import langid, lm
from blotterlake.llm.queries import QUERIES

from .conftest import as_documents, odd_rows, sample_rows

BIG = "/root/testdata/sf0.01"


def remainder(doc_id, classes):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % classes


def test_held_out_accuracy(spark):
    found = QUERIES["op6_language_id"](spark, BIG)
    rows = found.join(spark.read.parquet(f"{BIG}/documents.parquet"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang]
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def test_prediction_sees_only_text(spark, odd):
    model = langid.fit(langid.training_rows(spark.read.parquet(f"{BIG}/documents.parquet")))
    a = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(odd, model).collect()}
    b = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(odd.drop("lang", "source").repartition(1), model).collect()}
    assert a == b


def test_languages_of_odd_rows(odd, no_documents):
    model = langid.fit(langid.training_rows(odd))
    found = langid.identify(odd, model).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        text = next(x[1] for x in odd_rows() if x[0] == r.doc_id) if r.doc_id is not None else "some"
        letters = text is not None and any(c.isalpha() for c in text)
        assert (r.lang_pred == "und") == (not letters) and r.lang_pred in {"und", *model.languages}
        assert letters or r.score == 0
    kept = langid.keep_known(odd, model)
    assert kept.schema == odd.schema
    assert kept.count() == sum(r.lang_pred != "und" for r in found)
    nothing = langid.fit(langid.training_rows(no_documents))
    assert nothing.languages == () and langid.identify(no_documents, nothing).collect() == []
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_one_language(spark, odd):
    model = langid.fit(as_documents(spark, [(1, "only words", "xx", "a", 0)]))
    assert {(r.lang_pred, r.score) for r in langid.identify(odd, model).collect()} == {("xx", 1.0), ("und", 0.0)}


def test_codewords_are_apart():
    for languages, least in ((2, 1), (4, 4), (6, 16), (9, 8), (40, 8)):
        code = langid.codewords(languages).astype(int)
        apart = (code.shape[1] - code @ code.T) // 2
        assert len(np.unique(code, axis=0)) == languages and apart[~np.eye(languages, dtype=bool)].min() >= least
        assert (np.abs(code.sum(0)) < languages).all()


def test_ambiguity_is_flagged(spark):
    """Half a text of one language and half of another lies between their codewords."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    model = langid.fit(langid.training_rows(docs))
    texts = {lang: [r.text for r in docs.where(f"lang = '{lang}' and n_chars between 400 and 3000").limit(20).collect()] for lang in ("en", "de")}
    mixed = [a[:300] + " " + b[: 30 * k] for a, b in zip(texts["en"], texts["de"]) for k in range(4, 14)]
    _, scores, ambiguous = langid.predict(model, mixed)
    _, clear, none = langid.predict(model, texts["en"] + texts["de"])
    assert ambiguous.sum() > none.sum() and scores.mean() < clear.mean()


# ---- language model -------------------------------------------------------------------------


def plain_tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def expected_base(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        if remainder(doc_id, 5) != 1:
            counts.update(plain_tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text, *_ in rows:
        tokens = plain_tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        out.append((doc_id, remainder(doc_id, 5) == 1, len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return out


def check_base(rows, found):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    expected, found = sorted(expected_base(rows), key=key), sorted(map(tuple, found), key=key)
    assert len(expected) == len(found)
    for e, f in zip(expected, found):
        assert e[:5] == f[:5] and f[5] == pytest.approx(e[5], rel=1e-9) and math.isfinite(f[6]) and f[6] <= 1e-9


def test_scores_of_whole_table(spark):
    found = QUERIES["op4_lm_scores"](spark, BIG).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()]
    check_base(rows, found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # better than word counts on unseen text


@pytest.mark.parametrize("chunk_bytes", [12 << 20, 20_000])
def test_scores_of_odd_rows(odd, chunk_bytes):
    check_base(odd_rows(), lm.score_documents(odd, chunk_bytes=chunk_bytes, words=20).collect())


def test_scores_without_training(spark, no_documents):
    assert lm.score_documents(no_documents).collect() == []
    held = next(i for i in range(100) if remainder(i, 5) == 1)
    (row,) = lm.score_documents(as_documents(spark, [(held, "a b", "en", "a", 0)])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(row.score)


def test_probabilities_are_normalised():
    rng = np.random.default_rng(0)
    model = lm.LogBilinear(np.arange(1, 30).astype(np.uint64), rng.integers(1, 50, 32).astype(float), 500, 40)
    model.output = rng.normal(0, 1, model.output.shape)
    first, second, normal = model.tables()
    for one, two in ((0, 0), (5, 0), (7, 31), (2, 1)):
        scores = first[one] + second[two] - normal[one, two]
        assert np.exp(scores).sum() == pytest.approx(1.0)
        hidden = model.context[one] * model.place[0] + model.context[two] * model.place[1]
        direct = hidden @ model.output.T + model.bias
        assert scores[3] - scores[4] == pytest.approx(direct[3] - direct[4])


def test_training_learns_a_pattern():
    """a -> b -> c -> a ...: the model must come to prefer the next letter."""
    classes = np.array([3 + i % 3 for i in range(6000)] + [lm.END], np.int32)
    counts = np.array([0, 1, 1, 2000, 2000, 2000], float)
    model = lm.LogBilinear(np.array([1, 2, 3], np.uint64), counts, 6001, 4)
    trainer = lm.Trainer(model, 1)
    for _ in range(60):
        trainer.chunk(classes, np.array([len(classes)]), np.array([False]))
    first, second, normal = model.tables()
    for last in (3, 4, 5):
        before, after = 3 + (last - 4) % 3, 3 + (last - 2) % 3
        assert np.exp(first[last, after] + second[before, after] - normal[last, before]) > 0.8
