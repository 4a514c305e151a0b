"""Nearest neighbours by a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of vec_id.  A shard's graph is over its distinct vectors, so
that equal ones do not use up each other's links and the search's places, and is one row of flat arrays: vectors, the ``k`` + 1 smallest
ids of each (no answer needs more), and per layer the members, neighbour offsets and neighbours.  Candidates for a node's neighbours are all
members of its layer (a shard is small enough for a blocked matrix product); of them the diverse ones are kept, and links run
both ways.  Blocks of queries meet every shard by an equi-join on the shard number, descend from the top layer and
search the lowest with ``ef`` open candidates; each shard returns its ``k`` nearest, and the shards' answers are merged.  A
shard whose graph gives fewer than ``k`` is scanned exactly.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components take no part, nor do null vec_ids; of rows
that repeat a vec_id the least vector counts; queries meet only vectors of their own length; ties go to the smaller vec_id; an
empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from blotterlake.llm.common import materialize, ranges

SHARD_ROWS = 8192
LINKS = 16  # kept on upper layers, twice as many on the lowest
CANDIDATES = 64
DECIDE = 128  # nodes whose candidates are weighed against each other at a time
EF = 160
BLOCK = 256  # queries that travel together
GRAPH = "dim int, shard long, ids binary, id_offsets binary, vectors binary, layers array<struct<members: binary, offsets: binary, neighbours: binary>>"
FOUND = "query_id long, vec_id long, score double"


# ---- one shard ----------------------------------------------------------------------------


def _diverse(near: np.ndarray, distances: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """For nodes with candidates in ascending distance: those closer to the node than to any kept one, then the nearest others.

    Rows are nodes; all of them decide on their first candidate, then on their second, and so on.
    """
    points = vectors[near]
    squares = (points**2).sum(2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    to_kept, kept = np.full(near.shape, np.inf), np.zeros(near.shape, bool)
    for i in range(near.shape[1]):
        keep = (to_kept[:, i] > distances[:, i]) & (kept.sum(1) < most)
        kept[keep, i] = True
        to_kept[keep] = np.minimum(to_kept[keep], between[keep, i])
    first = np.argsort(~kept, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, first, 1)


def _layer(members: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour offsets and neighbours (as places among ``members``)."""
    points = vectors[members]
    squares = (points**2).sum(1)
    count = min(CANDIDATES, len(members) - 1)
    out: list[list[int]] = [[] for _ in members]
    for at in range(0, len(members), 1024):
        block = points[at : at + 1024]
        distance = squares[None, :] - 2 * block @ points.T + squares[at : at + 1024, None]
        distance[np.arange(len(block)), np.arange(at, at + len(block))] = np.inf
        if not count:
            break
        near = np.argpartition(distance, count - 1, axis=1)[:, :count]
        value = np.take_along_axis(distance, near, 1)
        order = np.lexsort((near, value), axis=1)
        near, value = np.take_along_axis(near, order, 1), np.take_along_axis(value, order, 1)
        for i in range(0, len(block), DECIDE):
            out[at + i : at + i + DECIDE] = _diverse(near[i : i + DECIDE], value[i : i + DECIDE], points, most).tolist()
    links = [set(x) for x in out]
    for i, near in enumerate(out):
        for j in near:
            links[j].add(i)
    for i, near in enumerate(links):
        if len(near) > 2 * most:  # back links of a hub: the nearest stay
            some = np.array(sorted(near))
            away = ((points[some] - points[i]) ** 2).sum(1)
            links[i] = set(some[np.argsort(away, kind="stable")[: 2 * most]].tolist())
    sizes = np.array([len(x) for x in links])
    flat = np.array([j for x in links for j in sorted(x)], np.int32)
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), flat


def build_graph(ids: np.ndarray, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Layers from the lowest up: members (places in ``vectors``), offsets, neighbours."""
    rng = np.random.default_rng(len(ids))
    level = np.floor(-np.log(1 - rng.random(len(ids))) / np.log(LINKS)).astype(int)
    layers = []
    for height in range(int(level.max()) + 1):
        members = np.flatnonzero(level >= height)
        layers.append((members.astype(np.int32), *_layer(members, vectors, LINKS if height else 2 * LINKS)))
    return layers


def distinct_vectors(ids: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct vectors, offsets into ids, and of ascending ``ids`` the ``most`` first of each."""
    vectors = vectors + 0.0  # no negative zeros
    seen: dict[bytes, int] = {}
    owner = np.array([seen.setdefault(v.tobytes(), len(seen)) for v in vectors])
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner)
    starts = np.cumsum(counts) - counts
    kept = order[np.arange(len(ids)) - np.repeat(starts, counts) < most]
    return vectors[order[starts]], np.concatenate(([0], np.cumsum(np.minimum(counts, most)))).astype(np.int64), ids[kept]


def search_graph(layers: list, vectors: np.ndarray, query: np.ndarray, ef: int) -> np.ndarray:
    """Places of about ``ef`` near vectors."""
    at = int(layers[-1][0][0])
    away = lambda places: ((vectors[places] - query) ** 2).sum(1)
    best = float(away([at])[0])
    for members, offsets, neighbours in reversed(layers[1:]):
        while True:
            i = int(np.searchsorted(members, at))
            near = members[neighbours[offsets[i] : offsets[i + 1]]]
            if not len(near):
                break
            distances = away(near)
            nearest = int(distances.argmin())
            if distances[nearest] >= best:
                break
            at, best = int(near[nearest]), float(distances[nearest])
    _, offsets, neighbours = layers[0]
    seen = np.zeros(len(vectors), bool)
    seen[at] = True
    open_, kept = [(best, at)], [(-best, at)]
    while open_:
        distance, node = heapq.heappop(open_)
        if len(kept) == ef and distance > -kept[0][0]:
            break
        near = neighbours[offsets[node] : offsets[node + 1]]
        near = near[~seen[near]]
        if not len(near):
            continue
        seen[near] = True
        distances = away(near)
        if len(kept) == ef:
            closer = distances < -kept[0][0]
            near, distances = near[closer], distances[closer]
        for value, place in zip(distances.tolist(), near.tolist()):
            if len(kept) < ef:
                heapq.heappush(kept, (-value, place))
                heapq.heappush(open_, (value, place))
            elif value < -kept[0][0]:
                heapq.heapreplace(kept, (-value, place))
                heapq.heappush(open_, (value, place))
    return np.array([place for _, place in kept])


# ---- in Spark -----------------------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector as doubles, one row per id, of the vectors that take part."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _dealt(rows: DataFrame, per_group: int, name: str) -> DataFrame:
    """Add a number below the count of groups that the vectors of a length need, and that count."""
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / per_group).alias(f"{name}s"))
    return rows.join(sizes, "dim").withColumn(name, F.pmod(F.xxhash64("vec_id", F.lit(name)), F.col(f"{name}s")))


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS, k: int = 10) -> DataFrame:
    """One row per shard, stored; for answers of up to ``k`` rows."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        ids, vectors = group.column("vec_id").to_numpy(), _matrix(group.column("vector"))
        vectors, id_offsets, ids = distinct_vectors(ids, vectors, k + 1)
        layers = [
            {"members": m.tobytes(), "offsets": o.tobytes(), "neighbours": n.tobytes()} for m, o, n in build_graph(np.arange(len(vectors)), vectors)
        ]
        kind = pa.list_(pa.struct([("members", pa.binary()), ("offsets", pa.binary()), ("neighbours", pa.binary())]))
        return pa.table({
            "dim": pa.array([vectors.shape[1]], pa.int32()), "shard": group.column("shard").slice(0, 1),
            "ids": pa.array([ids.tobytes()], pa.binary()), "id_offsets": pa.array([id_offsets.tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "layers": pa.array([layers], kind),
        })

    dealt = _dealt(rows, shard_rows, "shard").select("dim", "shard", "vec_id", "vector")
    shards = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("n")).agg(F.sum("n")).first()[0] or 1
    # A stated number of partitions, as adaptive execution would join shards, which are work more than bytes, into one task.
    dealt = dealt.repartition(4 * int(shards), "dim", "shard")
    return materialize(dealt.groupBy("dim", "shard").applyInArrow(build, GRAPH), "graph-shards")


def nearest(rows: DataFrame, queries: DataFrame, *, k: int = 10, ef: int = EF, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and Euclidean distance of the ``k`` nearest rows found for each query.

    Both are tables of ``usable``; a row with the query's id is not its candidate.
    """
    graphs = build_index(rows, shard_rows, k)

    def block(group: pa.Table) -> pa.Table:
        vectors = _matrix(group.column("vector"))
        return pa.table({
            "dim": pa.array([vectors.shape[1]], pa.int32()), "query_ids": pa.array([group.column("vec_id").to_numpy().tobytes()], pa.binary()),
            "query_vectors": pa.array([vectors.tobytes()], pa.binary()),
        })

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                id_offsets = np.frombuffer(row["id_offsets"], np.int64)
                vectors = np.frombuffer(row["vectors"]).reshape(len(id_offsets) - 1, -1)
                place = np.repeat(np.arange(len(vectors)), np.diff(id_offsets))  # of each id
                layers = [
                    (np.frombuffer(x["members"], np.int32), np.frombuffer(x["offsets"], np.int64), np.frombuffer(x["neighbours"], np.int32))
                    for x in row["layers"]
                ]
                asked = np.frombuffer(row["query_ids"], np.int64)
                out_q, out_v, out_s = [], [], []
                for query_id, query in zip(asked, np.frombuffer(row["query_vectors"]).reshape(len(asked), -1)):
                    near = search_graph(layers, vectors, query, max(ef, k + 1))
                    whole = len(near) >= min(k + 1, len(vectors))
                    near = ranges(id_offsets[near], id_offsets[near + 1] - id_offsets[near])
                    near = near[ids[near] != query_id]
                    if len(near) < k or not whole:  # a small shard, or a part of the graph without a way in
                        near = np.flatnonzero(ids != query_id)
                    score = np.sqrt(((vectors[place[near]] - query) ** 2).sum(1))
                    best = np.lexsort((ids[near], score))[:k]
                    out_q.append(np.full(len(best), query_id))
                    out_v.append(ids[near[best]])
                    out_s.append(score[best])
                yield pa.record_batch({
                    "query_id": pa.array(np.concatenate(out_q)), "vec_id": pa.array(np.concatenate(out_v)), "score": pa.array(np.concatenate(out_s)),
                })

    blocks = _dealt(queries, BLOCK, "block").groupBy("dim", "block").applyInArrow(block, "dim int, query_ids binary, query_vectors binary")
    shards = graphs.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    asked = blocks.join(shards, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    pairs = asked.select("dim", "shard", "query_ids", "query_vectors").join(graphs, ["dim", "shard"])
    # Each pair of a block and a shard is a unit of work of its own.
    found = pairs.mapInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_rows(rows: DataFrame, every: int = 100) -> DataFrame:
    return rows.where(F.pmod("vec_id", F.lit(every)) == 0)
