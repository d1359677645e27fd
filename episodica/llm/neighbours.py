"""Approximate nearest neighbours by a permutation index: pivot orders, inverted files, footrule, exact rerank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.sources.shared import store

SAMPLED = 2048


def usable(vector: Column) -> Column:
    """Vectors that are not null or zero and hold finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors with one more component, so that the largest inner product is the smallest angle."""
    scaled = vectors / longest
    return np.concatenate([scaled, np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1, keepdims=True), 0))], axis=1)


def choose_pivots(rows: DataFrame, pivots: int, longest: float) -> np.ndarray:
    """Up to 256 different lifted vectors out of the 2,048 rows with the smallest hashes: a bounded sample."""
    sample = rows.select("id", "vector", F.xxhash64("id", F.lit("pivot")).alias("_h")).orderBy("_h", "id").limit(SAMPLED).collect()
    unique = np.unique(np.array([r.vector for r in sample], float), axis=0)
    order = np.random.default_rng(5).permutation(len(unique))[: min(pivots, 256)]
    return lifted(unique[order], longest)


def pivot_ranks(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rank of every pivot in each vector's order of pivots, nearest first."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    ranks = np.empty(order.shape, np.uint8)
    np.put_along_axis(ranks, order, np.broadcast_to(np.arange(order.shape[1], dtype=np.uint8), order.shape), axis=1)
    return ranks


def packed(rows: DataFrame, blocks: int, dimension: int) -> DataFrame:
    """One row per block: its ids and vectors as bytes, by rising id.  Ids are dealt to blocks by hash."""

    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        vectors = table["vector"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(ids), dimension)
        order = np.lexsort((*vectors.T[::-1], ids))
        return pa.table({"block": table["block"][:1], "ids": pa.array([ids[order].tobytes()], pa.binary()), "vectors": pa.array([vectors[order].tobytes()], pa.binary())})

    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", F.col("vector").cast("array<double>").alias("vector"))
    return dealt.groupBy("block").applyInArrow(run, "block long, ids binary, vectors binary")


def nearest(
    vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    pivots: int = 256, consulted: int = 64, share: float = 0.04, least: int = 256, block: int = 16384, query_block: int = 1024,
) -> DataFrame:
    """Per row that ``queries`` holds for, its ``k`` nearest others: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Nearness is the inner product in double precision, largest first, ties to the smaller id.  Each vector is
    represented by the order of up to 256 pivots around it.  The rows are dealt to blocks; a block's inverted files
    hold, per pivot, the pivot's rank in each of its vectors.  A query opens the files of its ``consulted`` nearest
    pivots, adds up the footrule distances of ranks, and reranks the ``share`` of the block (``least`` rows at least)
    with the smallest sums by exact inner products.  Every block gives its own nearest, so k are found wherever k
    rows exist; the blocks' results are merged.

    Blocks of queries meet blocks of rows by an equality join on the block number.  Vectors that are null, zero, hold
    null or non-finite components, have a null id, or have another length than most take no part.  Rows with the
    query's id are no candidates; other repeated rows are rows of their own.  Without usable rows there is no result.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), queries.alias("asked"))
    rows = store(rows.where(F.col("id").isNotNull() & usable(F.col("vector"))), "vectors")
    empty = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return vectors.sparkSession.createDataFrame([], empty)
    dimension = int(lengths[0].d)
    rows = rows.where(F.size("vector") == dimension)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, asked, longest = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asked"), 1)), F.sqrt(F.max(square))).first()
    if not asked:
        return vectors.sparkSession.createDataFrame([], empty)
    anchors = choose_pivots(rows, pivots, longest)
    turns = -(-asked // query_block)
    index = store(packed(rows, -(-n // block), dimension), "index")
    asks = store(packed(rows.where("asked"), turns, dimension).toDF("turn", "query_ids", "query_vectors"), "queries")
    meetings = index.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long")))).join(asks, "turn")

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                turn, ids, data, query_ids, query_data = (batch.column(c)[r].as_py() for c in ("turn", "ids", "vectors", "query_ids", "query_vectors"))
                yield meet(turn, ids, data, query_ids, query_data)

    def meet(turn, ids, data, query_ids, query_data):
        ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
        own, asking = (np.frombuffer(x, np.float64).reshape(-1, dimension) for x in (data, query_data))
        files = np.ascontiguousarray(pivot_ranks(lifted(own, longest), anchors).T).astype(np.int16)
        unit = asking / np.sqrt((asking * asking).sum(axis=1, keepdims=True))
        ranks = pivot_ranks(np.concatenate([unit, np.zeros((len(unit), 1))], axis=1), anchors)
        place = np.arange(len(ids))
        take = min(len(ids), max(least, int(np.ceil(share * len(ids)))) + 1)
        out = [[], [], [], []]
        for q in range(len(query_ids)):
            footrule = np.zeros(len(ids), np.int32)
            for pivot in np.flatnonzero(ranks[q] < consulted):
                footrule += np.abs(files[pivot] - np.int16(ranks[q, pivot]))
            # equal sums in order of id
            close = np.argpartition(footrule.astype(np.int64) * len(ids) + place, take - 1)[:take]
            close = np.sort(close[ids[close] != query_ids[q]])
            scores = (own[close] * asking[q]).sum(axis=1)
            best = np.lexsort((ids[close], -scores))[:k]
            out[0].append(np.full(len(best), q))
            out[1].append(np.full(len(best), query_ids[q]))
            out[2].append(ids[close[best]])
            out[3].append(scores[best])
        columns = [np.full(sum(map(len, out[0])), turn), *(np.concatenate(x) for x in out)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["turn", "place", "query_id", "vec_id", "score"])

    found = meetings.mapInArrow(run, "turn long, place long, query_id long, vec_id long, score double")
    order = W.partitionBy("turn", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
