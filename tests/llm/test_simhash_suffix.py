"""SimHash components and suffix deduplication against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from blotterlake.llm import bktree, simhash, suffix_dedup
from blotterlake.llm.components import components
from blotterlake.llm.queries import QUERIES
from blotterlake.llm.suffixes import common_prefixes, intervals, maximal_repeats, suffix_array

from .conftest import SF, as_documents, odd_rows, sample_rows

# ---- SimHash ------------------------------------------------------------------------------


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(grams))


def plain_components(values):
    """Least index of each value's component under links of two bits or fewer."""
    bits = np.array(values, np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 2
    label = np.arange(len(bits))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def check_components(rows, found):
    prints = [plain_fingerprint(r[1]) for r in rows]
    label = plain_components(prints)
    least = {}
    for (doc_id, *_), root in zip(rows, label):
        least[root] = min([d for d in (least.get(root), doc_id) if d is not None], default=None)
    expected = [(r[0], f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, label)]
    key = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_simhash_query(spark):
    check_components(sample_rows(), QUERIES["op5_simhash"](spark, SF).collect())


def test_simhash_of_odd_rows(odd, no_documents):
    check_components(odd_rows(), simhash.near_duplicates(odd).drop("text_hash").collect())
    assert simhash.near_duplicates(no_documents).collect() == []
    kept = simhash.keep_one(odd)
    assert kept.schema == odd.schema
    found = simhash.near_duplicates(odd).collect()
    groups = {(r.component_id, r.fingerprint if r.component_id is None else "") for r in found}
    ids = sorted(repr(r.doc_id) for r in kept.collect())
    assert ids == sorted(repr(i) for i, _ in groups) and ids.count("None") == 1  # one row for each, also of repeated rows


@pytest.mark.parametrize("hot_group", [4096, 2])
def test_chains_and_hot_groups(spark, hot_group):
    rng, values = np.random.default_rng(1), []
    for seed in rng.integers(0, 1 << 63, 12).tolist():
        for _ in range(60):
            values.append(seed)
            for _ in range(int(rng.integers(1, 4))):
                seed ^= 1 << int(rng.integers(0, 64))
    values = list(dict.fromkeys(values))
    label = plain_components(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "bits long")
    roots = {r.u: r.v for r in components(simhash.links(df, 2, hot_group)).collect()}
    groups = {}
    for v, root in zip(signed, label):
        groups.setdefault(root, set()).add(roots.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_links_across_batches(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BATCH_ROWS", 5)
    df = spark.createDataFrame([(i * 8 + 3,) for i in range(64)], "bits long").coalesce(1)
    roots = {r.u: r.v for r in components(simhash.links(df)).collect()}
    assert len(roots) == 63 and len(set(roots.values())) == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**64 - 1)), unique=True, max_size=60), st.integers(0, 20))
def test_tree_search_finds_all_within_radius(items, radius):
    items.sort()
    groups = np.array([g for g, _ in items], np.int64)
    values = np.array([v for _, v in items], np.uint64)
    forest = bktree.build(groups, values)
    query, node = bktree.search(forest, values, forest.root, radius)
    near = (np.bitwise_count(values[:, None] ^ values[None, :]) <= radius) & (groups[:, None] == groups[None, :])
    assert sorted(zip(query.tolist(), node.tolist())) == sorted(map(tuple, np.argwhere(near).tolist()))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 200) if i % 50 != 49] + [(7, 7)]
    found = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: i // 50 * 50 for i in range(200) if i % 50}


# ---- suffix arrays ------------------------------------------------------------------------


def brute_repeats(docs):
    """docs: (id or None, bytes).  Bytes covered by 50 that also start in a document with a smaller id."""
    last = float("inf")
    rank = lambda d: last if d is None else d
    first = {}
    for doc_id, data in docs:
        for p in range(len(data) - 49):
            window = data[p : p + 50]
            first[window] = min(first.get(window, last), rank(doc_id))
    out = []
    for doc_id, data in docs:
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < rank(doc_id):
                gone[p : p + 50] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def encoded(rows):
    return [(r[0], (r[1] or "").encode()) for r in rows]


def test_suffix_query(spark):
    expected = [r[:5] for r in brute_repeats(encoded(sample_rows()))]
    assert in_order(QUERIES["op3_suffix_dedup"](spark, SF).collect()) == in_order(expected)


@pytest.mark.parametrize("hot,chunk_bytes", [(100_000, 8 << 20), (2, 60_000), (100_000, 60_000)])
def test_suffix_report_of_odd_rows(odd, hot, chunk_bytes):
    rows = [r for r in odd_rows() if len(r[1] or "") < 100_000]
    expected = [r[:5] for r in brute_repeats(encoded(rows))]
    few = odd.where("text is null or length(text) < 100000")
    found = suffix_dedup.repeat_report(few, hot=hot, chunk_bytes=chunk_bytes)
    assert in_order(found.collect()) == in_order(expected)


def test_suffix_of_very_long_copies(odd):
    """The three longest texts are copies: nothing of the second and third but a tail stays."""
    found = {r.doc_id: r for r in suffix_dedup.repeat_report(odd).collect() if r.n_bytes > 100_000}
    first, second, third = (found[k] for k in sorted(found))
    assert first.n_removed == 0 and second.n_removed == second.n_bytes and third.n_removed == second.n_bytes
    assert (second.n_spans, third.n_spans) == (1, 1)


def test_suffix_of_nothing(no_documents):
    assert suffix_dedup.repeat_report(no_documents).collect() == []
    assert suffix_dedup.remove_repeats(no_documents).schema == no_documents.schema


def test_nested_and_overlapping_passages(spark):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcd", np.uint8)
    pieces = [letters[rng.integers(0, 4, n)].tobytes().decode() for n in (49, 50, 51, 70, 90, 120)]
    rows = []
    for i in range(60):
        parts = [pieces[j][rng.integers(0, 20) :] for j in rng.integers(0, 6, 4)] + [chr(97 + int(rng.integers(4))) * 3]
        rows.append((int(rng.integers(0, 30)), "".join(parts), "en", "a", 0))
    expected = [r[:5] for r in brute_repeats(encoded(rows))]
    for hot in (100_000, 3):
        found = suffix_dedup.repeat_report(as_documents(spark, rows), hot=hot, chunk_bytes=2000)
        assert in_order(found.collect()) == in_order(expected)


def test_periodic_and_long_repeats(spark):
    """Texts of one repeated word in many lengths, and passages longer than what is compared of a suffix."""
    rng = np.random.default_rng(6)
    long = "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 900))
    rows = [(int(rng.integers(0, 40)), f"{'Und ' * int(n)}{'x' * int(n % 3)}", "de", "a", 0) for n in rng.integers(10, 300, 25)]
    rows += [(100 + i, long[a:b] + str(i), "en", "a", 0) for i, (a, b) in enumerate([(0, 900), (100, 700), (0, 400), (350, 900), (1, 899), (644, 900)])]
    expected = [r[:5] for r in brute_repeats(encoded(rows))]
    for hot in (100_000, 500):
        found = suffix_dedup.repeat_report(as_documents(spark, rows), hot=hot, chunk_bytes=9000)
        assert in_order(found.collect()) == in_order(expected)


def test_removed_texts_keep_columns(odd):
    few = odd.where("text is null or length(text) < 100000")
    rows = [r for r in odd_rows() if len(r[1] or "") < 100_000]
    cut = suffix_dedup.remove_repeats(few)
    assert cut.columns == few.columns and [f.dataType for f in cut.schema] == [f.dataType for f in few.schema]
    expected = sorted(repr((r[0], None if row[1] is None else r[5].decode("utf-8", "ignore"))) for r, row in zip(brute_repeats(encoded(rows)), rows))
    found = cut.collect()
    assert sorted(repr((r.doc_id, r.text)) for r in found) == expected
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.chunk == "extra" for r in found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=14), min_size=1, max_size=5), st.integers(1, 4))
def test_interval_tree_gives_all_maximal_repeats(texts, least):
    data = "".join(texts).encode()
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    string = np.repeat(np.arange(len(texts)), np.diff(bounds))
    starts, ends, first = np.arange(len(data)), bounds[1:][string], bounds[:-1][string]
    order = suffix_array(data, starts, ends)
    starts, ends, first = starts[order], ends[order], first[order]
    flat = np.frombuffer(data, np.uint8)
    prefix = common_prefixes(flat, starts, ends)
    found = set()
    for depth, a, b in maximal_repeats(flat, starts, first, prefix, least, 1 << 30):
        word = data[starts[a] : starts[a] + depth]
        found.add((word, tuple(sorted(starts[a : b + 1].tolist()))))
    # Brute force: a repeat is maximal if its occurrences differ to the left and to the right.
    places = {}
    for s, text in enumerate(texts):
        for i in range(len(text)):
            for j in range(i + least, len(text) + 1):
                places.setdefault(text[i:j].encode(), []).append((s, i, j))
    expected = set()
    for word, at in places.items():
        left = {texts[s][i - 1] if i else (s, "start") for s, i, _ in at}
        right = {texts[s][j] if j < len(texts[s]) else (s, "end") for s, _, j in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            expected.add((word, tuple(sorted(int(bounds[s]) + i for s, i, _ in at))))
    # Equal suffixes at the ends of different strings are one interval.
    assert found == expected
    assert all(d >= least and a < b for d, a, b in intervals(prefix, least))
