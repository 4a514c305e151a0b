"""The pipeline's stages, each on its own input, against plain versions."""

from collections import Counter, defaultdict

import corpus_pipeline
import __spark_entry__ as contract
from blotterlake.llm.queries import QUERIES

from .conftest import DOCUMENTS, SF, as_documents, odd_rows, sample_rows
from .test_mixing_syncmers import expected_targets, words
from .test_simhash_suffix import brute_repeats, encoded, plain_components, plain_fingerprint
from .test_tokens_records_packing import check_pieces
from blotterlake.llm.packing import Limits


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_registered():
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


def as_rows(df):
    return [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in df.collect()]


def test_stages_one_by_one(spark):
    docs = spark.createDataFrame(sample_rows(), DOCUMENTS)
    columns = docs.columns
    spoken = stage("language ID")(spark, docs, SF)
    assert spoken.columns == columns
    rows = as_rows(spoken)
    assert Counter(rows) == Counter(r for r in sample_rows() if any(c.isalpha() for c in r[1] or ""))

    single = stage("SimHash near-dedup")(spark, spoken, SF)
    label = plain_components([plain_fingerprint(r[1]) for r in rows])
    least = defaultdict(list)
    for r, root in zip(rows, label):
        least[root].append(r)
    expected = [min(group) for group in least.values()]
    assert single.columns == columns and Counter(as_rows(single)) == Counter(expected)

    rows = as_rows(single)
    cut = stage("suffix-array dedup")(spark, single, SF)
    want = {d: kept.decode("utf-8", "ignore") for d, *_, kept in brute_repeats(encoded(rows))}
    assert cut.columns == columns and {r[0]: r[1] for r in as_rows(cut)} == want and cut.count() == len(want)

    rows = as_rows(cut)
    mixed = stage("mixing sources to target weights")(spark, cut, SF)
    size, target = expected_targets(rows)
    longest, sums = defaultdict(int), defaultdict(int)
    for r in rows:
        longest[r[3]] = max(longest[r[3]], words(r[1]))
    copies = Counter(as_rows(mixed))
    assert mixed.columns == columns and max(copies.values()) <= 3 and set(copies) <= set(rows)
    for r, n in copies.items():
        sums[r[3]] += n * words(r[1])
    assert all(abs(sums[s] - target[s]) <= 0.5 * longest[s] + 1 for s in size)

    packed = stage("packing")(spark, mixed, SF).collect()
    padding, _ = check_pieces(as_rows(mixed), packed, Limits(), with_ids=True)
    assert padding == 0


def test_pipeline_of_odd_rows(spark, odd, no_documents):
    for docs in (odd, no_documents):
        columns = docs.columns
        for name, run in corpus_pipeline.STAGES:
            docs = run(spark, docs, SF)
            if name != "packing":
                assert docs.columns == columns
        pieces = docs.collect()
    assert pieces == []


def test_run(spark):
    found = contract.queries()["pipeline"](spark, SF).collect()
    assert found and {"doc_id", "sequence_id", "offset", "ids"} <= set(found[0].asDict())


def test_columns_of_any_name_come_through(spark):
    """Columns called as the operators' own are kept with their values."""
    docs = as_documents(spark, sample_rows()[:40])
    extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    for name in ("language ID", "SimHash near-dedup", "suffix-array dedup", "mixing sources to target weights"):
        kept = stage(name)(spark, docs, SF)
        assert kept.columns == docs.columns
        assert {tuple(r) for r in kept.select(*[f"`{c}`" for c in extra]).distinct().collect()} == {("extra",) * len(extra)}
