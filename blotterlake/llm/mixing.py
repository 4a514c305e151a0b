"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only.

Each document has a 64-bit hash.  A source takes all its documents a whole number of times, and
once more those below its hash threshold.  The threshold comes from token sums by (source, leading
12 hash bits): the bucket in which the running sum passes the budget is the boundary bucket, and
only its documents are summed again by the next 12 bits, until it holds one document.  Nothing is
sorted.  The boundary document takes the rest of the budget as a part of one more copy (documents
that agree in 60 bits, equal rows in effect, share it by size), so a source meets its target to a word or two.

Targets: the sources in code point order, null last, weigh 5, 2, 1 in turn and share the total; a target stops at
``most`` times its source's size and the excess goes to the others by weight.  That is one water level:
``sum(min(weight * level, cap)) = total``, read off the sources sorted by cap / weight.

Defined cases: a null text has size 0; a null source is a source; null and repeated doc_ids are hashed with
the text; a source of size 0 has target 0; an empty table gives no rows.  Extra columns are not read by
``mixing_plan`` and ``taken`` and are kept by ``mix_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from blotterlake.llm.common import by_place, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
DIGIT_BITS, LEVELS = 12, 5


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and the hash that decides who is taken."""
    source, size, hashed = _sized_columns()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), size.alias("size"), hashed.alias("hash")
    )


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size and target, one row per source; windows here see sources only."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighed = sources.select("source", "source_size", weight.cast("double").alias("weight")).withColumn(
        "cap", F.col("source_size") * F.lit(float(most))
    ).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    above = order.rowsBetween(0, Window.unboundedFollowing)
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    levels = weighed.withColumns({"place": F.row_number().over(order), "level": left / F.sum("weight").over(above)})
    # The first source that is not full at the level which the sources from it on would share.
    open_level = F.min_by("level", F.when(F.col("level") <= F.col("full_at"), F.col("place"))).over(everywhere)
    reach = F.coalesce(open_level * F.col("weight"), F.col("cap"))
    return levels.select("source", "source_size", F.least(reach, F.col("cap")).alias("target"))


def _prefix(level: int, hash_col: str = "hash") -> Column:
    return F.shiftrightunsigned(hash_col, 64 - DIGIT_BITS * level)


def mixing_plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source: whole copies of everything, and the threshold of the partial one.

    ``rows`` is a stored table of ``sized``; each level reads of it what the boundary buckets hold.
    """
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    cut = targets(rows, weights, most).withColumn("whole", whole).withColumns({
        "rest": goal - whole * F.col("source_size"), "bound": F.lit(0).cast("long"),
        "cell_size": F.col("source_size"), "cell_docs": F.lit(2).cast("long"), "level": F.lit(0),
    })
    cut = materialize(cut, "mix-targets")
    for level in range(1, LEVELS + 1):
        here = cut.where("cell_docs > 1 and cell_size > 0").select(
            F.col("source").alias("cut_source"), "bound", "rest"
        )
        inside = F.col("source").eqNullSafe(F.col("cut_source"))
        if level > 1:
            inside &= _prefix(level - 1) == F.col("bound")
        cells = rows.join(here, inside).groupBy("cut_source", _prefix(level).alias("cell")).agg(
            F.sum("size").alias("cell_size"), F.count(F.lit(1)).alias("cell_docs"), F.first("rest").alias("rest")
        )
        before = Window.partitionBy("cut_source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("earlier", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
        passes = (F.col("earlier") <= F.col("rest")) & (F.col("rest") < F.col("earlier") + F.col("cell_size"))
        found = cells.where(passes).select(
            "cut_source", F.col("cell").alias("new_bound"), (F.col("rest") - F.col("earlier")).alias("new_rest"),
            F.col("cell_size").alias("new_size"), F.col("cell_docs").alias("new_docs"), F.lit(level).alias("new_level"),
        )
        fresh = {"bound": "new_bound", "rest": "new_rest", "cell_size": "new_size", "cell_docs": "new_docs", "level": "new_level"}
        cut = cut.join(found, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
            "source", "source_size", "target", "whole", *[F.coalesce(F.col(n), F.col(o)).alias(o) for o, n in fresh.items()]
        )
        cut = materialize(cut, "mix-cut")
        if cut.where("cell_docs > 1 and cell_size > 0").isEmpty():
            break
    return cut


def _taken(size: Column, hash_col: str) -> Column:
    """Words taken of a document, given the plan's columns of its source."""
    prefixes = [F.lit(0).cast("long"), *[_prefix(level, hash_col) for level in range(1, LEVELS + 1)]]
    prefix = F.element_at(F.array(*prefixes), F.col("level") + 1)
    part = F.when(prefix < F.col("bound"), size).when(
        (prefix == F.col("bound")) & (F.col("cell_size") > 0),
        F.floor(F.col("rest").cast("decimal(38,0)") * size / F.col("cell_size")).cast("long"),
    )
    return F.col("whole") * size + F.coalesce(part, F.lit(0))


def taken(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target and words taken of every document."""
    rows = materialize(sized(docs), "mix-sizes")
    plan = mixing_plan(rows, weights, most).withColumnRenamed("source", "cut_source")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
        "doc_id", "source", "size", "source_size", "target", _taken(F.col("size"), "hash").alias("taken")
    )


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The documents as often as the mix takes them, to the nearest whole copy; columns as given."""
    rows = materialize(sized(docs), "mix-sizes")
    plan = mixing_plan(rows, weights, most)
    plan = plan.select(F.struct(*plan.columns).alias("__mix_plan"))
    docs, names = by_place(docs, "doc_id", "text", "source"), docs.columns
    with_size = docs.withColumns({"__mix_" + c: f for c, f in zip(("source", "size", "hash"), _sized_columns())})
    joined = with_size.join(plan, F.col("__mix_source").eqNullSafe(F.col("__mix_plan.source")), "left")
    flat = joined.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__mix_row"), "__mix_size", "__mix_hash", "__mix_plan.*"
    )
    copies = F.round(F.try_divide(_taken(F.col("__mix_size"), "__mix_hash"), F.col("__mix_size"))).cast("int")
    repeated = flat.select(
        "__mix_row", F.explode(F.array_repeat(F.lit(0), F.coalesce(copies, F.lit(1)))).alias("__mix_copy")
    )
    return repeated.select("__mix_row.*").toDF(*names)


def _sized_columns() -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [
        F.col("source").cast("string"), F.regexp_count(text, F.lit(WORD)).cast("long"),
        F.xxhash64(F.col("doc_id").cast("long"), text),
    ]
