"""Line deduplication, vector codes and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from blotterlake.llm import gnat, variants, vector_codes
from blotterlake.llm.line_dedup import keep_bitmaps, kept_texts, line_report, pack_bitmap, stream, unpack_bitmap
from tests.llm.conftest import as_documents, odd_rows

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- line deduplication -----------------------------------------------------------------------


def plain_lines(rows):
    """(doc_id, n_lines, n_dropped, sha) of every row; an id of None is one document below all others."""
    rank = lambda i: -math.inf if i is None else i
    key = lambda line: line.strip(" \t\n\v\f\r").translate(A_TO_Z)
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(rank(doc_id))
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        stays = [x for x in lines if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == rank(doc_id)]
        digest = hashlib.sha256("\n".join(stays).encode()).hexdigest()
        out.append((str(doc_id), len(lines), len(lines) - len(stays), digest))
    return sorted(out)


def found_lines(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def line_rows():
    rng = random.Random(3)
    common = [f"Common line number {i} that is long enough to count" for i in range(6)]
    common += ["ÄÖÜ é" * 8, "x" * 39, "y" * 40, "é" * 20, "İ" * 40]
    rows = []
    for i in range(60):
        lines = [rng.choice(common) for _ in range(rng.randrange(6))] + [f"own line {i} {j} " * 4 for j in range(rng.randrange(3))]
        rng.shuffle(lines)
        lines = [rng.choice(["", "  ", "\t", "\r"]) + (x.upper() if rng.random() < 0.3 and x.isascii() else x) + rng.choice(["", " ", "\r", "\x0b"]) for x in lines]
        rows.append((i * 3, "\n".join(lines), "en", "a", 0))
    rows += [rows[7], rows[7], (21, rows[9][1], "en", "a", 0), (None, rows[5][1], "en", "a", 0), (None, rows[6][1], None, None, 0)]
    return rows + [(1000, (common[0] + "\n") * 3000, "en", "a", 0), (1001, "\n" * 50 + (common[0] + "\n") * 2, "en", "a", 0), (None, common[0], "en", "a", 0)]


def test_lines_equal_a_plain_version(spark):
    rows = line_rows() + odd_rows()
    assert found_lines(line_report(as_documents(spark, rows))) == plain_lines(rows)
    assert sum(r[2] for r in plain_lines(rows)) > 3100


def test_lines_do_not_depend_on_partitions_or_on_what_a_task_holds(spark):
    rows = line_rows()
    docs = as_documents(spark, rows, 7)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found_lines(line_report(docs, pending=2)) == plain_lines(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_no_documents_have_no_lines(no_documents):
    assert found_lines(line_report(no_documents)) == []


def test_bitmaps_and_texts(spark):
    rows = line_rows()
    docs = as_documents(spark, rows)
    bitmaps = keep_bitmaps(docs)
    texts = kept_texts(docs, bitmaps).collect()
    digests = sorted((str(r.doc_id), hashlib.sha256(r.text.encode()).hexdigest()) for r in texts)
    assert digests == sorted((r[0], r[3]) for r in plain_lines(rows))
    assert {str(r.doc_id) for r in bitmaps.collect()} == {r[0] for r in plain_lines(rows) if r[2]}
    assert bitmaps.where("doc_id = 1001").count() == 0  # the largest id that holds the line keeps all of its lines


@given(st.integers(1, 300), st.data())
def test_bitmap_round_trip(n, data):
    lost = data.draw(st.sets(st.integers(0, n - 1)))
    bits = unpack_bitmap(pack_bitmap(n, [np.array(sorted(lost), "<u4").tobytes()]), n)
    assert set(np.flatnonzero(~bits).tolist()) == lost and len(bits) == n


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 6))), max_size=60), st.integers(1, 9), st.integers(0, 8), st.integers(1, 4))
def test_stream_decides_or_hands_on(pairs, size, pending, least):
    rows = sorted(pairs, key=lambda p: (p[0], p[1] is None, -(p[1] or 0)))
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64())])
    table = pa.table([[k for k, _ in rows], [0] * len(rows), [d for _, d in rows], list(range(len(rows)))], schema=schema)
    out = [r for t in stream(iter(table.to_batches(max_chunksize=size)), least, pending) for r in t.to_pylist()]
    undecided = {r["hi"] for r in out if r["open"]}
    documents = {k: list(dict.fromkeys(d for q, d in rows if q == k)) for k, _ in rows}
    assert {r["row"] for r in out if r["open"]} == {i for i, (k, _) in enumerate(rows) if k in undecided}
    lost = {i for i, (k, d) in enumerate(rows) if k not in undecided and len(documents[k]) >= least and d != documents[k][0]}
    assert {r["row"] for r in out if not r["open"]} == lost
    if rows:
        assert undecided >= {rows[0][0], rows[-1][0]}


# ---- vector codes -----------------------------------------------------------------------------


def plain_nearest(entries, queries):
    away = ((queries[:, None, :].astype(object) - entries[None, :, :].astype(object)) ** 2).sum(2)
    which = [min(range(len(entries)), key=lambda j: (row[j], j)) for row in away]
    return which, [int(row[j]) for row, j in zip(away, which)]


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10**6), st.integers(1, 90), st.integers(1, 5), st.sampled_from([1, 3, 50, 10**5, 2**28]))
def test_gnat_finds_the_nearest_and_first_entry(seed, size, width, spread):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-spread, spread + 1, (size, width))
    queries = np.concatenate((rng.integers(-spread, spread + 1, (20, width)), entries[:5]))
    which, square, _ = gnat.nearest(gnat.build(entries), entries, queries)
    assert (which.tolist(), square.tolist()) == plain_nearest(entries, queries)


def test_gnat_rules_out_most_of_clustered_entries():
    rng = np.random.default_rng(0)
    centres = rng.integers(-10_000, 10_000, (16, 4))
    entries = np.repeat(centres, 16, 0) + rng.integers(-50, 51, (256, 4))
    queries = entries[rng.integers(0, 256, 500)] + rng.integers(-5, 6, (500, 4))
    which, square, taken = gnat.nearest(gnat.build(entries), entries, queries)
    assert (which.tolist(), square.tolist()) == plain_nearest(entries, queries)
    assert taken < 0.3 * 256 * 500


def test_roots_are_rounded_outwards():
    n = np.array([0, 1, 2, 3, 4, 8, 9, 10, 2**52 - 1, 2**52, 2**62 - 1])
    assert gnat.root_down(n).tolist() == [math.isqrt(x) for x in n.tolist()]
    assert gnat.root_up(n).tolist() == [math.isqrt(x - 1) + 1 if x else 0 for x in n.tolist()]


VECTORS = "vec_id long, embedding array<float>, label string, code string, part int"


def plain_codes(rows, entries=256):
    """The contract in plain Python: [(vec_id, code, error, label_error, digest)]."""
    kept = [(i, v, c) for i, v, c, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    whole = [(i, [math.floor(1024 * x) for x in v] + [0] * (width - len(v)), c) for i, v, c in kept]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    size = width // 4
    parts = [[v[p * size : (p + 1) * size] for _, v, _ in whole] for p in range(4)]
    books = [[list(v) for v in mine[:entries]] for mine in parts]
    best = lambda book, v: min((sum((a - b) ** 2 for a, b in zip(e, v)), j) for j, e in enumerate(book))
    for _ in range(4):
        for book, mine in zip(books, parts):
            groups = defaultdict(list)
            for v in mine:
                groups[best(book, v)[1]].append(v)
            for j, members in groups.items():
                book[j] = [sum(column) // len(members) for column in zip(*members)]
    coded = [[best(book, v) for v in mine] for book, mine in zip(books, parts)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = [sum(coded[p][k][0] for p in range(4)) for k in range(len(whole))]
    of_label = Counter()
    for (_, _, c), e in zip(whole, errors):
        of_label[c] += e
    return sorted((str(i), "".join(f"{coded[p][k][1]:02x}" for p in range(4)), errors[k], of_label[c], digest) for k, (i, _, c) in enumerate(whole))


def found_codes(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def vector_rows(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    values = rng.normal(0, 0.01, (n, dim)).astype(np.float32)
    return [(int(i), [float(x) for x in v], [None, "a", "b"][i % 3]) for i, v in enumerate(values)]


def test_codes_equal_a_plain_version(spark):
    rows = vector_rows(330, 8)
    odd = [
        (None, [0.1] * 8, None), (5, [0.25] * 8, "a"), (5, [-0.25] * 8, None), (1001, None, "a"), (1002, [], "b"), (1003, [0.0] * 8, "c"),
        (1004, [float("nan")] + [0.0] * 7, "a"), (1005, [float("inf")] * 8, "a"), (1006, [None] * 8, "a"), (1007, [0.5] * 6, "b"), rows[3], rows[3],
    ]
    rows = rows + odd
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], VECTORS).repartition(5)
    assert found_codes(vector_codes.code_report(df)) == plain_codes(rows)


def test_codes_of_few_rows_ties_and_empty_tables(spark):
    rows = [(i, [float(i % 2)] * 4, "a") for i in range(10)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], VECTORS).repartition(3)
    assert found_codes(vector_codes.code_report(df)) == plain_codes(rows)
    assert vector_codes.code_report(df.limit(0)).count() == 0
    only_empty = spark.createDataFrame([(1, [], None, "x", 1)], VECTORS)
    assert found_codes(vector_codes.code_report(only_empty)) == plain_codes([(1, [], None)])


def test_huge_components_stay_exact(spark):
    rows = [(1, [3e38, -3e38, 1.0, 2.0], "a", "x", 1), (2, [0.0, 0.0, 1.0, 2.0], "a", "x", 1)]
    found = found_codes(vector_codes.code_report(spark.createDataFrame(rows, VECTORS)))
    assert [r[1] for r in found] == ["00" * 4, "01010000"] and all(r[2] == 0 for r in found)


# ---- spelling variants ------------------------------------------------------------------------


def plain_vocabulary(rows):
    words = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def plain_variants(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if one_apart(w, x)]
        most = min(near, key=lambda x: (-words[x], x), default=None)
        form = most if most is not None and words[most] >= 5 * n else None
        out[w] = [w, form, None, n, len(near), words[form] if form else None]
    for row in out.values():
        root = row[0]
        while out[root][1]:
            root = out[root][1]
        row[2] = root
    return sorted(map(tuple, out.values()), key=str)


def found_variants(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def variant_rows():
    rng = random.Random(5)
    letters = "abcdeé÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "bbbbbbbb"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.15)), len(base) - 1)]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice([rng.choice(letters), ""]) + w[at + rng.choice([0, 1]) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words), "en", "a", 0))
    chain = " ".join(["zzquart"] * 130 + ["zzquarts"] * 26 + ["zzquartsy"] * 5)
    return rows + [(None, rows[0][1], "en", "a", 0), rows[1], rows[1], (5000, chain, "en", "a", 0)]


def test_variants_equal_a_plain_version(spark):
    rows = variant_rows() + odd_rows()
    plain = plain_variants(plain_vocabulary(rows))
    assert found_variants(variants.spelling_variants(as_documents(spark, rows))) == plain
    assert sum(r[4] for r in plain) > 200 and any(r[1] and r[2] != r[1] for r in plain)


def test_no_documents_have_no_words(no_documents):
    assert variants.spelling_variants(no_documents).count() == 0


@settings(deadline=None, max_examples=200)
@given(st.text("abc", min_size=6, max_size=14))
def test_pivots_are_the_cheapest_disjoint_bigrams(word):
    weight = {a + b: 1 + (ord(a) * 7 + ord(b) * 3) % 11 for a in "abc" for b in "abc"}
    rank = {g: i for i, g in enumerate(sorted(weight, key=lambda g: (weight[g], g)))}
    places = variants.prefix_places(word, rank)
    cost = lambda a, b: weight[word[a : a + 2]] + weight[word[b : b + 2]]
    a, b = variants.pivot_places(word, places, weight)
    assert b - a >= 2 and cost(a, b) == min(cost(x, y) for x in places for y in places if y - x >= 2)


def test_all_words_one_edit_apart_meet(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("abá") for _ in range(rng.randrange(6, 9))) for _ in range(700)} | {"a" * n for n in range(6, 12)}
    df = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n long").repartition(3)
    found = {(r.word, r.other) for r in variants.near_words(df).collect()}
    assert found == {(a, b) for a in words for b in words if one_apart(a, b)}


def test_roots_of_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w20")]
    found = variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {(r.word, r.root) for r in found} == {(w, "w37") for w, _ in chain}


def test_tables_of_words_are_not_broadcast(spark, monkeypatch):
    """Small as the stored words are here, Spark would broadcast what is made of them, at any size under its threshold."""
    plans, store = [], variants.materialize

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(variants, "materialize", stored)
    plans.append(variants.spelling_variants(as_documents(spark, variant_rows()))._jdf.queryExecution().executedPlan().toString())
    joins = [found for plan in plans for found in re.findall(r"(\w+Join) \[(\w+)#", plan)]
    assert {key for _, key in joins} == {"key", "root", "word"}
    assert {kind for kind, _ in joins} == {"SortMergeJoin"}


@pytest.mark.parametrize("report", [line_report, variants.spelling_variants])
def test_extra_columns_change_nothing(spark, report):
    rows = odd_rows()
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = plain.select("*", *[F.lit("x").alias(c) for c in ("word", "n", "hi", "lo", "text_hash", "places", "keep_bitmap", "of_id", "open")])
    assert sorted(map(str, report(extra).collect())) == sorted(map(str, report(plain).collect()))
