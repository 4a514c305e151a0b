"""SimHash near-duplicates: fingerprints, links within a Hamming radius by BK-trees, components.

Only distinct fingerprints are compared.  Two of them within ``radius`` bits agree in two of radius + 2 blocks of
bits, so each goes to one shard group per pair of blocks, and a task builds the BK-trees of its groups and
searches them for every member.  A group over ``HOT_GROUP`` is dealt again by pairs of blocks of its other bits, after which
a group holds at most 2^16 distinct values.  (The trees stay with the groups that need them rather than being
broadcast: all trees together grow with the corpus, so a broadcast of them has no bound.)
A task reports a link from each member to the least one it is connected with, not all pairs.

Defined cases: a null text is empty; no words give fingerprint zero, which is linked like any other; a text of fewer
than ``SHINGLE`` words is one shingle; rows with null doc_ids have a component but cannot name it, and are null there
if no row of it has an id; repeated rows share a fingerprint; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from blotterlake.llm.bktree import build, least_linked, search
from blotterlake.llm.common import by_bytes, by_place, materialize, task_of, texts
from blotterlake.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
HOT_GROUP = 4096
BATCH_ROWS = 1 << 18  # rows a task links at a time, besides one group


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased words: a bit is set if it is in over half of the shingles' XXH64."""
    import xxhash

    words = text.lower().split()  # bytes: exactly ASCII letters and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    grams = map(joined.__getitem__, map(slice, starts.tolist(), ends))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(ends))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = np.add.reduce(bits, axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text, and the 64 bits as a signed long."""

    @task_of("simhash")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            found = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column(1)]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.record_batch({"doc_id": batch.column(0), "text_hash": batch.column(2), "bits": pa.array(values)})

    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, bits long")


def _pairs(value: Column, width: int, at: int, blocks: int) -> list[Column]:
    """One key per pair of ``blocks`` blocks of the ``width`` bits of ``value`` from bit ``at`` up."""
    edges = [at + width * i // blocks for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned(value, a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])
    ]
    return [F.xxhash64(F.lit(i), F.lit(j), parts[i], parts[j]) for i, j in combinations(range(blocks), 2)]


def grouped(distinct: DataFrame, radius: int, hot_group: int) -> DataFrame:
    """(shard, bits): every two fingerprints within ``radius`` share a shard."""
    blocks = radius + 2
    first = F.posexplode(F.array(*_pairs(F.col("bits"), 64, 0, blocks)))
    rows = distinct.select("bits", first.alias("pair", "shard"))
    hot = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > hot_group)
    hot = materialize(hot.select(F.col("shard").alias("hot_shard")), "hot-shards")
    if hot.isEmpty():
        return rows.select("shard", "bits")
    # The other bits of a hot group, from which two more blocks must agree.
    edges = [64 * i // blocks for i in range(blocks + 1)]
    rest = None
    for pair, used in enumerate(combinations(range(blocks), 2)):
        packed, width = F.lit(0).cast("long"), 0
        for i in (i for i in range(blocks) if i not in used):
            size = edges[i + 1] - edges[i]
            part = F.shiftrightunsigned("bits", edges[i]).bitwiseAND((1 << size) - 1)
            packed, width = packed.bitwiseOR(F.shiftleft(part, width)), width + size
        keys = F.array(*_pairs(packed, width, 0, blocks))
        rest = F.when(F.col("pair") == pair, keys) if rest is None else rest.when(F.col("pair") == pair, keys)
    split = rows.join(hot, F.col("shard") == F.col("hot_shard"), "left")
    more = F.when(F.col("hot_shard").isNull(), F.array(F.lit(0).cast("long"))).otherwise(rest)
    dealt = split.select("shard", "bits", F.explode(more).alias("more"))
    return dealt.select(F.xxhash64("shard", "more").alias("shard"), "bits")


def links(distinct: DataFrame, radius: int = RADIUS, hot_group: int = HOT_GROUP) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within ``radius``."""

    def linked(shards: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        values = bits.view(np.uint64)
        forest = build(shards, values)
        query, node = search(forest, values, forest.root, radius)
        label = least_linked(len(values), query, node)
        some = np.flatnonzero(label != np.arange(len(label)))
        return pa.record_batch({"u": pa.array(bits[some]), "v": pa.array(bits[label[some]])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += batch.num_rows
            if rows < BATCH_ROWS:
                continue
            shards, bits = (np.concatenate(c) for c in zip(*held))
            last = int(np.searchsorted(shards, shards[-1], "left"))  # the last group may go on
            if last:
                yield linked(shards[:last], bits[:last])
            held, rows = [(shards[last:], bits[last:])], 0
        if held:
            yield linked(*(np.concatenate(c) for c in zip(*held)))

    shards = grouped(distinct, radius, hot_group)
    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "u long, v long")


def _rooted(
    docs: DataFrame, shingle: int, radius: int, hot_group: int
) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, stored; and of each distinct one the least of its component (root) and the least doc_id that has it."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(prints.groupBy("bits").agg(F.min("doc_id").alias("least_doc")), "distinct-fingerprints")
    roots = components(links(distinct, radius, hot_group))
    rooted = distinct.join(roots, F.col("bits") == F.col("u"), "left")
    return prints, rooted.select(F.col("bits").alias("of_bits"), "least_doc", F.coalesce("v", "bits").alias("root"))


def near_duplicates(
    docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, hot_group: int = HOT_GROUP
) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id that links reach; and a hash of the text."""
    prints, rooted = _rooted(docs, shingle, radius, hot_group)
    named = rooted.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    of_bits = rooted.join(named, "root").select("of_bits", "component_id")
    return prints.join(of_bits, F.col("bits") == F.col("of_bits")).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id", "text_hash"
    )


def keep_one(
    docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, hot_group: int = HOT_GROUP
) -> DataFrame:
    """One row of each component: of the document with the smallest doc_id; all columns as given.

    A document without an id stays only where no document of its component has one, and of several such the one of the text
    with the least hash.  Of rows that repeat the id and text that stay, one stays; which of them is not defined where
    their other columns differ.
    """
    prints, rooted = _rooted(docs, shingle, radius, hot_group)
    rows = prints.groupBy("bits", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "rows")
    least = rows.groupBy("bits").agg(F.min(row).alias("least")).join(rooted, F.col("bits") == F.col("of_bits"))
    least = least.groupBy("root").agg(F.min("least").alias("least"))
    kept = least.select(F.col("least.doc_id").alias("kept_id"), F.col("least.text_hash").alias("kept_text"), F.col("least.rows").alias("kept_rows"))
    kept = materialize(kept, "kept-documents")
    plain = by_place(docs, "doc_id", "text")
    of_text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (of_text == F.col("kept_text"))
    once = plain.join(kept.where("kept_rows = 1"), same, "left_semi")
    repeated = materialize(kept.where("kept_rows > 1"), "kept-repeats")  # few: its size lets the join be a broadcast
    again = plain.join(repeated, same).dropDuplicates(["kept_id", "kept_text"])
    return once.union(again.select(*plain.columns)).toDF(*docs.columns)
