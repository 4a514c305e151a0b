import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from blotterlake.llm.common import prepare

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def ready(spark):
    prepare(spark)


def sample_rows():
    """Documents of the smallest table as tuples."""
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    return [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows]


def odd_rows():
    """Nulls, empty, blank, letterless, one-word and very long texts, copies, near copies, repeated rows and ids."""
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "Épée", "straße", "niño", "wörld", "x", "42", "--"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long_text = prose(60), prose(30_000)
    texts = [
        None, "", " \t\n", "...", "word", "two words", "ÀÉ́ ﬁ İ", "a\x00b \x1c c d", shared, "Start. " + shared + " tail one",
        "Other\n" + shared + "\r\nanother end", long_text, long_text, long_text + " more", prose(40), "Und " * 700, "<|endoftext|> <|ENDOFTEXT|> it's",
        "z" * 5000,
    ]
    rows = [(10 * i, t, [None, "en", "de"][i % 3], [None, "a", "B", "é"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, shared, "en", "a", len(shared)), (None, "no id", None, None, 5), (80, shared, "de", "a", len(shared))]
    return rows + [rows[8], rows[4], (-5, prose(200), "en", "a", 0), (1 << 60, prose(200) + shared, "de", "a", 0)]


def as_documents(spark, rows, parts=3):
    """With extra columns whose names operators use inside."""
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(parts)
    for name in ("size", "bits", "key", "hash", "chunk", "part", "bucket", "source_size", "fingerprint", "kept_id", "kept_text", "kept_rows", "of_bits", "__mix_source", "__mix_size", "__mix_hash", "__mix_plan", "__mix_row", "c0", "c7", "held_out", "shard"):
        df = df.withColumn(name, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def odd(spark):
    return as_documents(spark, odd_rows())


@pytest.fixture(scope="session")
def no_documents(spark):
    return as_documents(spark, [], 1)
