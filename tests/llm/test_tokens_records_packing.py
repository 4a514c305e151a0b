"""Token ids, record files and packing against the tokenizers library used plainly."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from blotterlake.llm import packing, records
from blotterlake.llm.common import by_bytes, scratch_path
from blotterlake.llm.queries import QUERIES
from blotterlake.llm.tokens import WordEncoder, default_tokenizer, encoder

from .conftest import SF, odd_rows, sample_rows

PATH = default_tokenizer()


def plain(text):
    return encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_word_encoding_is_whole_text_encoding(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, ends = encoder(PATH).texts(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [plain(t) for t in texts]


def test_slices_of_a_batch_are_encoded_alike():
    texts = [r[1] or "" for r in odd_rows()]
    batch = pa.record_batch({"text": pa.array(texts)})
    found = []
    for part in by_bytes(iter([batch]), 0, 1000):
        ids, ends = encoder(PATH).texts(part.column(0))
        found += [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert found == [plain(t) for t in texts]


class Asked:
    """A tokenizer that notes each call that encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, []

    def encode(self, text, **more):
        self.calls.append(text)
        return self.tokenizer.encode(text, **more)

    def encode_batch_fast(self, texts, **more):
        self.calls += texts
        return self.tokenizer.encode_batch_fast(texts, **more)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)


def encoded(words, texts):
    ids, ends = words.texts(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_words_that_end_in_signs_share_calls():
    words = WordEncoder(PATH)
    words.tokenizer = Asked(words.tokenizer)
    texts = [" ".join(f"schö{a}{b}ß{sign}" for a in "abcdefghijñ" for b in "klmnopqé") for sign in (".", ",", "***")]
    assert encoded(words, texts) == [plain(t) for t in texts]
    assert len(words.tokenizer.calls) <= 5  # the stems, and each of the signs; a call per word before


def test_frequent_words_are_kept_when_the_memory_is_full():
    words = WordEncoder(PATH)
    words.held_words = 40
    words.tokenizer = Asked(words.tokenizer)
    for turn in range(30):
        rare = "".join(chr(97 + int(d)) for d in str(1000 + turn))
        texts = [f"often über, met. {rare}a {rare}b, {rare}c.", "", f"{rare}é!"]
        assert encoded(words, texts) == [plain(t) for t in texts]
        assert len(words.memory) <= 40 + 14  # and what one call adds
    assert sum("often" in text.split() for text in words.tokenizer.calls) == 1  # once more each time the memory was full, before
    for held in (0, 1, 2):  # hardly room for anything
        words.held_words = held
        assert encoded(words, texts) == [plain(t) for t in texts]
        assert encoded(words, texts[::-1]) == [plain(t) for t in texts[::-1]]


# Letters whose lower case or composed form ends in a mark, which the tokenizer joins to signs after it; letters of other scripts; marks.
@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aZéßİ\u0958\u0915\u093c\u0307\u0345ǅΣ中ᄀ\u11a8ª²७'s!.,;:*#$&% \u00a0\u2028", max_size=30), max_size=4), st.integers(0, 30))
def test_letters_and_signs_of_any_script(texts, held):
    words = WORDS
    words.held_words = held
    assert encoded(words, texts) == [plain(t) for t in texts]


WORDS = WordEncoder(PATH)


def expected_index(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out, start = [], 0
    for doc_id, text, *_ in ordered:
        ids = plain(text)
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("rows", [odd_rows(), []], ids=["odd", "empty"])
def test_records_round_trip(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("shard", F.lit(1))
    path = scratch_path(spark, "records")
    index = records.token_records(docs, path, PATH, shard_bytes=40_000)
    found = index.select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected_index(rows)
    shuffled = [(r.doc_id, tuple(r.ids)) for r in records.read_shuffled(spark, path, seed=3).collect()]
    assert Counter(shuffled) == Counter((r[0], tuple(plain(r[1]))) for r in rows)
    if rows:
        again = [(r.doc_id, tuple(r.ids)) for r in records.read_shuffled(spark, path, seed=4).collect()]
        assert again != shuffled and Counter(again) == Counter(shuffled)


def test_records_query_in_doc_order(spark):
    found = QUERIES["op9_token_records"](spark, SF).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected_index(sample_rows())


def test_damaged_records_are_found():
    good = records.frame(7, np.array([5, 6, 49000], np.uint16)) + b"\n"
    doc_id, ids, end = records.read_frame(memoryview(good), 0)
    assert (doc_id, ids.tolist(), end) == (7, [5, 6, 49000], len(good))
    assert records.read_frame(memoryview(records.frame(None, np.array([], np.uint32)) + b"\n"), 0)[0] is None
    for at in range(len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(memoryview(bytes(bad)), 0)
    with pytest.raises(ValueError):
        records.read_frame(memoryview(good[:-1]), 0)


def check_pieces(rows, found, limits, with_ids=False):
    """Every id of every row in exactly one piece, sequences gapless and within all limits."""
    wanted = Counter((r[0], tuple(plain(r[1]))) for r in rows)
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
        assert r.length > 0
        if with_ids:
            assert crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(r.loss_tokens for r in pieces) <= limits.loss_tokens
        padding += limits.tokens - at if at & (at - 1) else 0
    for doc_id, pieces in by_doc.items():
        texts = [ids for (d, ids), n in wanted.items() if d == doc_id for _ in range(n)]
        covered = Counter()
        for r in pieces:
            same = [i for i, ids in enumerate(texts) if len(ids) == r.doc_tokens and crc(ids[r.start : r.start + r.length]) == r.ids_crc32]
            assert same
            covered[r.doc_tokens] += r.length
        assert covered == Counter({n: n * c for n, c in Counter(map(len, texts)).items()})
    assert set(by_doc) == {r[0] for r in rows}
    return padding, len(sequences)


def test_packing_of_documents(spark, odd, no_documents):
    limits = packing.Limits(tokens=256, segments=3, loss_tokens=250)
    found = packing.pack_documents(odd, PATH, limits, with_ids=True).collect()
    check_pieces(odd_rows(), found, limits, with_ids=True)
    assert packing.pack_documents(no_documents, PATH).collect() == []


def test_packing_query_leaves_no_padding(spark):
    found = QUERIES["op1_packing"](spark, SF).collect()
    padding, sequences = check_pieces(sample_rows(), found, packing.Limits())
    assert padding == 0 and sequences > 1


def test_packing_of_instructions_keeps_examples_whole(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        n = int(rng.integers(1, 90))
        rows.append((i, rng.integers(0, 9, n).tolist(), (rng.random(n) < rng.random()).tolist()))
    rows += [(400, None, None), (401, [], []), (402, [1] * 130, None), (403, [2] * 50, [True] * 50)]
    df = spark.createDataFrame(rows, "example_id long, ids array<int>, loss array<boolean>").coalesce(1)
    limits = packing.Limits(tokens=100, segments=5, loss_tokens=40)
    found = packing.pack_examples(df, limits).collect()
    lengths = {r[0]: len(r[1] or []) for r in rows}
    assert {r.doc_id: r.length for r in found} == {k: n for k, n in lengths.items() if n}
    sequences = defaultdict(list)
    for r in found:
        assert r.start == 0 and list(r.ids) == rows[r.doc_id][1]
        mask = rows[r.doc_id][2]
        assert r.loss_tokens == (sum(mask) if mask is not None else r.length - 1)
        sequences[r.sequence_id].append(r)
    over = 0
    for pieces in sequences.values():
        sums = sum(r.length for r in pieces), len(pieces), sum(r.loss_tokens for r in pieces)
        if sums[0] > 100 or sums[2] > 40:
            assert len(pieces) == 1  # an example over a limit is alone
            over += 1
        assert sums[1] <= 5
    assert over >= 2
    # No fewer sequences than the tightest dimension asks for, and not many more.
    least = max(sum(lengths.values()) / 100, sum(r.loss_tokens for r in found) / 40)
    assert len(sequences) < 1.35 * least + over


def test_a_wrong_loss_mask_is_an_error(spark):
    df = spark.createDataFrame([(1, [1, 2], [True])], "example_id long, ids array<int>, loss array<boolean>")
    with pytest.raises(Exception, match="2 ids but 1 loss flags"):
        packing.pack_examples(df).collect()


@pytest.mark.parametrize("tokens", [1, 5, 10, 20, 31, 40])
def test_short_examples_are_packed_without_much_padding(tokens):
    """Segments, not tokens, run out first."""
    limits = packing.Limits()
    packer = packing.Packer(limits, True, 0)
    for i in range(20_000):
        packer.add(packing.Example(i, np.full(tokens, i % 7, np.uint16), None))
    packer.pack(0)
    lengths, pieces, placed = Counter(), Counter(), defaultdict(list)
    for doc_id, start, length, _, _, sequence, offset, _, _ in sorted(packer.rows, key=lambda r: (r[5], r[6])):
        assert offset == lengths[sequence]
        lengths[sequence] += length
        pieces[sequence] += 1
        placed[doc_id] += range(start, start + length)
    assert len(placed) == 20_000 and all(sorted(p) == list(range(tokens)) for p in placed.values())
    assert max(pieces.values()) <= limits.segments and max(lengths.values()) <= limits.tokens
    padding = sum(limits.tokens - n for n in lengths.values() if n & (n - 1))
    assert padding < 0.02 * 20_000 * tokens
    assert len(lengths) < 2.1 * 20_000 / limits.segments * max(1, limits.segments * tokens / limits.tokens) + 16


def test_examples_whose_loss_runs_out_first_are_cut_at_powers_of_two():
    limits = packing.Limits(tokens=256, segments=8, loss_tokens=40)
    packer, rng = packing.Packer(limits, True, 0), np.random.default_rng(5)
    for i in range(2000):
        n = int(rng.integers(0, 90))
        mask = rng.random(n) < rng.random()
        packer.add(packing.Example(i, np.zeros(n, np.uint16), np.concatenate(([0], np.cumsum(mask)))))
    packer.pack(0)
    lengths, loss = Counter(), Counter()
    for row in packer.rows:
        lengths[row[5]] += row[2]
        loss[row[5]] += row[8]
    assert max(loss.values()) <= 40 and max(lengths.values()) <= 256
    assert all(n & (n - 1) == 0 or n >= 256 - 256 // packing.FULL for n in lengths.values())


def test_shards_hold_about_equal_bytes_where_long_texts_lie_together(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "ab " * int(rng.integers(1, 20))) for i in range(6000)] + [(6000 + i, "cd ef " * 15_000) for i in range(60)]
    rows += [(None, "gh " * 2000)] * 300  # equal rows and no ids
    path = scratch_path(spark, "records")
    index = records.token_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, PATH, shard_bytes=400_000)
    assert index.count() == len(rows)
    assert [r.doc_id for r in index.orderBy("start").collect()] == [None] * 300 + list(range(6060))
    sizes = [r.bytes for r in index.groupBy("shard").agg(F.sum("length").alias("bytes")).collect()]
    assert max(sizes) <= 2 * 400_000 and len(sizes) <= 3 * sum(sizes) / 400_000


def test_frames_are_compressed_between_tasks(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('the ', repeat(concat('time of year ', id, ' '), 300)) AS text")
    stored, sizes = records.frames(docs, default_tokenizer()), ("sum(length(record))", "sum(size)")
    held, plain = stored.selectExpr(*sizes).first()
    assert held < 0.7 * plain


def test_frames_are_stored_nowhere_before_the_shards(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(map(str, rng.integers(0, 100_000, 300)))) for i in range(400)]
    held, store = [], records.materialize

    def stored_bytes(df, name):
        stored = store(df, name)
        files = [Path(f.removeprefix("file:")) for f in stored.inputFiles()]
        held.append(sum(f.stat().st_size for f in files))
        return stored

    monkeypatch.setattr(records, "materialize", stored_bytes)
    path = scratch_path(spark, "records")
    records.write_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, PATH, shard_bytes=200_000)
    written = [f.stat().st_size for f in Path(path.removeprefix("file:"), "data").glob("part-*")]
    assert len(written) > 2 and sum(written) > 400 * 300 * 2 and sum(held) < 0.1 * sum(written)


def test_rows_that_end_shards_are_dealt_alike_in_any_order():
    key = records._ordered
    ends = [key(None, "a", 0), key(3, "b", 1), key(3, "b", 1), key(3, "b", 1), key(9, "é", -2)]
    keys = [key(None, "", 5)] + [key(3, "b", 1)] * 11 + [key(3, "a", 7), key(3, "b", 2), key(9, "é", -3), key(9, "é", -2), key(10, "", 0)] * 2
    dealt = [Counter((k, dealer.shard(k)) for k in order) for order in (keys, keys[::-1], sorted(keys)) for dealer in [records.Dealer(ends, 2)]]
    assert dealt[0] == dealt[1] == dealt[2]
    assert sorted(n for (k, _), n in dealt[0].items() if k == ends[1]) == [2, 3, 3, 3]
    shards = [shard for _, shard in sorted(dealt[0])]
    assert shards == sorted(shards) and set(shards) == set(range(6))


def test_texts_of_one_doc_id_are_in_order_over_shards(spark):
    rows = [(7, f"{i % 90:03d} " + "ab cd " * 50) for i in range(900)] + [(None, "x " * 40)] * 500 + [(8, None)] * 200
    path = scratch_path(spark, "records")
    index = records.token_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, PATH, shard_bytes=20_000)
    found = index.select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected_index(rows)
    assert index.select("shard").distinct().count() > 10
