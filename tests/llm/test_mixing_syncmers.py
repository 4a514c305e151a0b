"""Mixing and fingerprints against plain Python."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from blotterlake.llm import mixing, syncmers
from blotterlake.llm.queries import QUERIES

from .conftest import SF, as_documents, odd_rows, sample_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return len(WORD.findall(text or ""))


def expected_targets(rows):
    size = defaultdict(int)
    for _, text, _, source, _ in rows:
        size[source] += words(text)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(size.values())
    while True:
        rest = total - sum(3 * size[s] for s in full)
        share = sum(weight[s] for s in size if s not in full)
        target = {s: 3.0 * size[s] if s in full else rest * weight[s] / share for s in size}
        over = {s for s in size if s not in full and target[s] > 3 * size[s]}
        if not over:
            return size, target
        full |= over


def check_mix(rows, found):
    size, target = expected_targets(rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size) for r in found) == sorted(
        (r[0] is not None, r[0] or 0, words(r[1])) for r in rows
    )
    sums, count = defaultdict(int), defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        sums[r.source] += r.taken
        count[r.source] += 1
    for source in size:
        assert abs(sums[source] - target[source]) <= 0.5 + count[source]  # equal rows share a rest by whole words


def test_mix_query(spark):
    found = QUERIES["op7_mixing"](spark, SF).collect()
    check_mix(sample_rows(), found)
    again = QUERIES["op7_mixing"](spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_mix_of_odd_rows(odd, no_documents):
    check_mix(odd_rows(), mixing.taken(odd).collect())
    assert mixing.taken(no_documents).collect() == []


def test_mix_with_small_sources_that_fill_up(spark):
    rows = [(i, "w " * (1 + i % 7), "en", s, 0) for i, s in enumerate("aaabbbbbbbbbbbbbbbbbbbbbbbbbbbbccdddddd" * 20)]
    check_mix(rows, mixing.taken(as_documents(spark, rows)).collect())


def test_equal_rows_share_a_boundary(spark):
    rows = [(1, "one two three", "en", "a", 13)] * 50 + [(2, "w " * 500, "en", "b", 0)]
    check_mix(rows, mixing.taken(as_documents(spark, rows)).collect())


def test_mixed_documents_keep_columns_and_targets(odd):
    mixed = mixing.mix_documents(odd)
    assert mixed.schema == odd.schema
    copies = defaultdict(int)
    for r in mixed.collect():
        copies[(r.doc_id, r.text, r.source)] += 1
    taken = defaultdict(int)
    for r in mixing.taken(odd).join(odd.select("doc_id", "text", F.col("source").alias("s")), "doc_id").collect():
        if r.size and r.doc_id is not None and r.source == r.s and words(r.text) == r.size:
            taken[(r.doc_id, r.text, r.source)] = max(taken[(r.doc_id, r.text, r.source)], int(r.taken / r.size + 0.5))
    unique = [r for r in odd_rows() if [x[0] for x in odd_rows()].count(r[0]) == 1 and r[1] and words(r[1])]
    assert unique and all(copies[(r[0], r[1], r[3])] == taken[(r[0], r[1], r[3])] for r in unique)


# ---- fingerprints ---------------------------------------------------------------------------


def ring_of(rows):
    """Text that each key's document sees next, in descending doc_id; null ids last."""
    key = lambda d: syncmers.NO_ID if d is None else d
    least = {}
    for doc_id, text, *_ in rows:
        least[key(doc_id)] = least.get(key(doc_id), []) + [text or ""]
    order = sorted(least, reverse=True)
    return {k: least[order[(i + 1) % len(order)]] for i, k in enumerate(order)}, key


def check_prints(rows, found):
    ring, key = ring_of(rows)
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[(doc_id, len(text or ""))].append(text or "")
    assert len(found) == len(rows)
    of_text = {}
    for r in found:
        expected = set()
        for text in texts[(r.doc_id, r.n_chars)]:
            third = len(text) // 3
            for after in ring[key(r.doc_id)]:
                expected.add(hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest())
        assert r.edited_sha256 in expected
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(texts[(r.doc_id, r.n_chars)]) == 1:
            (text,) = texts[(r.doc_id, r.n_chars)]
            assert of_text.setdefault(text, r.fingerprint) == r.fingerprint
    return of_text


def test_fingerprint_query(spark):
    found = QUERIES["op8_fingerprints"](spark, SF).collect()
    check_prints(sample_rows(), found)
    long_ones = [r for r in found if r.n_chars > 600]
    assert len(long_ones) > 50
    assert sum(r.near_edited > 0.5 for r in long_ones) > 0.9 * len(long_ones)
    assert sum(r.near_next < 0.2 for r in long_ones) > 0.9 * len(long_ones)


def test_fingerprints_of_odd_rows(spark, odd, no_documents):
    prints = check_prints(odd_rows(), syncmers.fingerprints(odd).collect())
    assert len(set(prints.values())) == len({t.strip() for t in prints})  # white space at the edges is no unit
    assert syncmers.fingerprints(no_documents).collect() == []
    (alone,) = syncmers.fingerprints(as_documents(spark, [(3, "one two three four five six seven", "en", "a", 0)], 1)).collect()
    assert alone.near_next == 1.0


def test_anchors_do_not_depend_on_context(spark):
    passage = " ".join(f"w{i * 37 % 101}" for i in range(80))
    docs = as_documents(spark, [(1, passage, "en", "a", 0), (2, "before it all " + passage + " after", "en", "a", 0)])
    rows = syncmers.anchors(docs).collect()
    first = {(r.place, r.anchor) for r in rows if r.doc_id == 1}
    second = {(r.place, r.anchor) for r in rows if r.doc_id == 2}
    assert first and {(p + 3, a) for p, a in first} <= second


def test_closed_syncmers_by_brute_force(spark):
    text = " ".join(f"t{i * i % 23}" for i in range(60))
    units = text.split(" ")
    hashes = {r.u: r.h for r in spark.createDataFrame([(u,) for u in set(units)], "u string").select("u", F.xxhash64("u").alias("h")).collect()}
    expected = set()
    for i in range(len(units) - syncmers.K + 1):
        window = [hashes[u] for u in units[i : i + syncmers.K]]
        if min(window) in (window[0], window[-1]):
            expected.add(i)
    assert {r.place for r in syncmers.anchors(as_documents(spark, [(1, text, "en", "a", 0)])).collect()} == expected
