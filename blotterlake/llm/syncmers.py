"""Document fingerprints from closed syncmers; DataFrame functions only.

The units of a text are its words, or its characters if it has fewer than ``K`` words.  A k-mer
is ``K`` units in a row; its inner substrings are single units, ordered by their hash.  The k-mer is
chosen if a least inner unit lies at its first or last place.  That depends on the k-mer alone, not on its
neighbours, so an edit disturbs only the k-mers it touches.  The fingerprint is the sketch of the
``SKETCH`` least distinct hashes of chosen k-mers, over the whole text; ``anchors`` gives all with their places.

Defined cases: a null text is empty; a text of fewer than ``K`` units has one anchor, the hash of all of them, so
equal texts have equal fingerprints in every case; a null doc_id counts as the smallest long (after all others in
descending order); documents that share a doc_id are all reported and the least of their texts is what the document
before them sees; one document alone is its own next; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from blotterlake.llm.common import materialize, texts

K = 5
SKETCH = 128
NO_ID = -(1 << 63)
SPACES = r"[\x20\x09-\x0D]+"


def _hashes(text: Column) -> Column:
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    units = F.when(F.size(words) >= K, words).otherwise(F.split(text, ""))
    return F.transform(units, lambda u: F.xxhash64(u))


def _places(hashes: Column) -> Column:
    """0-based places of the closed syncmers."""
    last = F.size(hashes) - K

    def at_edge(i: Column) -> Column:
        inner = F.least(*[F.get(hashes, i + j) for j in range(1, K - 1)])
        return F.least(F.get(hashes, i), F.get(hashes, i + (K - 1))) <= inner

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), at_edge)).otherwise(F.array().cast("array<int>"))


def _anchor(hashes: Column, place: Column) -> Column:
    return F.xxhash64(*[F.get(hashes, place + j) for j in range(K)]).bitwiseAND(0xFFFFFFFF)


def with_sketch(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add the sketch of a text column: its least anchors in ascending order, 32 bits each."""
    hashes, places = f"{out}_h", f"{out}_p"
    df = df.withColumn(hashes, _hashes(F.col(text_col)))
    df = df.withColumn(places, _places(F.col(hashes)))
    whole = F.array(F.xxhash64(hashes).bitwiseAND(0xFFFFFFFF))
    found = F.transform(places, lambda i: _anchor(F.col(hashes), i))
    least = F.slice(F.array_sort(F.array_distinct(found)), 1, SKETCH)
    return df.withColumn(out, F.when(F.size(places) > 0, least).otherwise(whole)).drop(hashes, places)


def as_string(sketch: Column) -> Column:
    return F.concat_ws("", F.transform(sketch, lambda a: F.lpad(F.lower(F.hex(a)), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Share of anchors two texts have in common (Dice), estimated from the least of their union."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    share = F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)
    return 2.0 * share / (1.0 + share)


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, place (in units) and anchor of every closed syncmer, for positional matching."""
    rows = texts(docs).withColumn("hashes", _hashes(F.col("text")))
    rows = rows.select("doc_id", "hashes", F.explode(_places(F.col("hashes"))).alias("place"))
    return rows.select("doc_id", "place", _anchor(F.col("hashes"), F.col("place")).alias("anchor"))


def neighbours(ids: DataFrame) -> DataFrame:
    """For distinct keys with ``n``: the keys next and previous in descending order, in a ring, and the previous n.

    Keys are range-sorted and numbered by range; what is next across a range's edge comes from a
    table with one row per range.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ids.repartitionByRange(parts, F.col("key").desc()).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "ordered-keys")
    edges = dealt.groupBy("part").agg(
        F.max("key").alias("first_key"), F.min("key").alias("last_key"), F.min_by("n", "key").alias("last_n")
    )
    order = Window.orderBy("part")
    ring = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select(
        F.col("part").alias("edge_part"),
        F.coalesce(F.lead("first_key").over(order), F.first("first_key").over(ring)).alias("next_first"),
        F.coalesce(F.lag("last_key").over(order), F.last("last_key").over(ring)).alias("previous_last"),
        F.coalesce(F.lag("last_n").over(order), F.last("last_n").over(ring)).alias("previous_n"),
    )
    within = Window.partitionBy("part").orderBy(F.col("key").desc())
    return dealt.join(edges, F.col("part") == F.col("edge_part")).select(
        "key", F.coalesce(F.lead("key").over(within), F.col("next_first")).alias("next_key"),
        F.coalesce(F.lag("key").over(within), F.col("previous_last")).alias("previous_key"),
        F.coalesce(F.lag("n").over(within), F.col("previous_n")).alias("previous_n"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text, of its edited text, and their likeness; see the module's cases.

    The edited text has the last third of its characters replaced by the first as many of the next
    document in descending doc_id.  The texts are shuffled once, and heads and sketches go to the document before.
    """
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "text")
    ids = rows.groupBy("key").agg(F.max(F.length("text")).alias("n"))
    ring = materialize(neighbours(ids).select(
        F.col("key").alias("ring_key"), "previous_key", F.floor(F.col("previous_n") / 3).cast("int").alias("asked")
    ), "document-ring")
    base = with_sketch(rows, "text", "sketch")
    placed = base.join(ring, F.col("key") == F.col("ring_key"))
    heads = placed.select(
        F.col("previous_key").alias("to_key"), F.expr("substring(text, 1, asked)").alias("head"),
        F.col("sketch").alias("next_sketch"),
    ).groupBy("to_key").agg(F.min(F.struct("head", "next_sketch")).alias("next"))
    joined = placed.join(heads, F.col("key") == F.col("to_key"), "left")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next.head", F.lit(1), third))
    out = joined.select("key", "text", "sketch", F.col("next.next_sketch").alias("next_sketch"), edited.alias("edited"))
    out = with_sketch(out, "edited", "edited_sketch")
    return out.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
