"""Hard negatives by Kronecker-packed products: several candidates in the fields of one integer, exact scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.sources.shared import store

# integers below 2 ** 53 are exact in a float64, whose products the processor adds up fastest
EXACT = 53
WIDE = 8  # fields of an integer of any width, where two factors need more bits
LONG = (1 << 63) - 1


class Packing:
    """How wide a field must be, and how many of them one integer holds, for vectors of given size and length."""

    def __init__(self, peak: int, dimension: int):
        self.bias = peak
        self.width = max(1, (max(dimension, 1) * (2 * peak) ** 2).bit_length())
        self.plain = self.width <= EXACT
        self.fields = EXACT // self.width if self.plain else WIDE

    def whole(self, vectors: np.ndarray) -> np.ndarray:
        """Components as exact numbers of the kind that the products are made of."""
        if self.plain:
            return vectors.astype(np.float64)
        return np.array([int(x) for x in vectors.ravel()], object).reshape(vectors.shape)

    def packed(self, candidates: np.ndarray) -> np.ndarray:
        """One integer per component and run of ``fields`` candidates: their biased components side by side."""
        biased = self.whole(candidates) + self.bias
        short = -len(biased) % self.fields
        biased = np.concatenate([biased, np.zeros((short, biased.shape[1]), biased.dtype)]).reshape((len(biased) + short) // self.fields, self.fields, biased.shape[1])
        shifts = np.array([1 << (self.width * f) for f in range(self.fields)], object)
        shifts = shifts.astype(np.float64) if self.plain else shifts
        return (biased * shifts[None, :, None]).sum(axis=1)

    def scores(self, anchors: np.ndarray, packed: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Exact inner products of all anchors with all candidates: one multiplication per anchor component and integer."""
        a, c = self.whole(anchors), self.whole(candidates)
        products = (a + self.bias) @ packed.T
        if self.plain:
            products, a, c = products.astype(np.int64), a.astype(np.int64), c.astype(np.int64)
        mask = (1 << self.width) - 1
        split = np.stack([(products >> (self.width * f)) & mask for f in range(self.fields)], axis=2)
        split = split.reshape(len(a), -1)[:, : len(c)]
        sums = self.bias * a.sum(axis=1)[:, None] + self.bias * c.sum(axis=1)[None, :] + a.shape[1] * self.bias * self.bias
        return split - sums


def storage(peak: int) -> np.dtype:
    """The narrowest kind of number that holds whole components up to ``peak``."""
    return np.dtype(next((k for k in ("int8", "int16", "int32") if peak <= np.iinfo(k).max), "float64"))


def first_of(row: np.ndarray, score: np.ndarray, ids: np.ndarray, take: int) -> np.ndarray:
    """Indexes of the first ``take`` entries of each row: highest score first, ties by smaller id."""
    if score.dtype == object:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], -score[i], ids[i])), np.int64)
    else:
        order = np.lexsort((ids, -score, row))
    begins = np.append(True, row[order][1:] != row[order][:-1]) if len(order) else np.zeros(0, bool)
    starts = np.flatnonzero(begins)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < take]


def as_longs(numbers) -> pa.Array:
    return pa.array([min(max(int(x), -LONG), LONG) for x in numbers] if numbers.dtype == object else numbers, pa.int64())


def packed_rows(rows: DataFrame, number: str, parts: int, dimension: int, kind: np.dtype) -> DataFrame:
    """One row per part: its ids, labels and vectors as bytes, by label and id.  Rows are dealt to parts by their hash."""

    def run(table: pa.Table) -> pa.Table:
        ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
        vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(len(ids), dimension)
        order = np.lexsort((ids, labels))
        cells = [pa.array([x[order].tobytes()], pa.binary()) for x in (ids, labels, vectors.astype(kind))]
        return pa.table({number: table[number][:1], "ids": cells[0], "labels": cells[1], "vectors": cells[2]})

    dealt = rows.withColumn(number, F.pmod(F.xxhash64("row"), F.lit(parts)))
    return dealt.select(number, "id", "label", "vector").groupBy(number).applyInArrow(run, f"{number} long, ids binary, labels binary, vectors binary")


def every(number: str, parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias(number)


def opened(batch: pa.RecordBatch, r: int, prefix: str, dimension: int, kind: np.dtype):
    ids, labels, vectors = (batch.column(prefix + c)[r].as_buffer() for c in ("ids", "labels", "vectors"))
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(labels, np.int64), np.frombuffer(vectors, kind).reshape(len(ids), dimension)


def mine_negatives(
    vectors: DataFrame, anchors: Column, label: Column, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = 16384, cells: int = 1 << 21,
) -> DataFrame:
    """Per row that ``anchors`` holds for and each of its positives, the hardest negatives within a band of scores.

    Components become floor(``scale`` * x); a score is the integer inner product with the anchor.  Positives are the
    first ``positives`` other rows of the anchor's ``label``; negatives are the first ``negatives`` rows of other labels
    with ``low`` * positive score <= 100 * score <= ``high`` * positive score.  Higher scores come first, ties by id.
    Columns: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Blocks of anchors meet blocks of rows through an equality join on both numbers, twice: for positives, then for
    negatives, when the bands are known.  In a meeting, the biased components of several candidates stand in the
    fields of one integer, and one product per anchor component serves them all.  A meeting gives out its own first
    rows of each list, so every list is whole.  Blocks follow a hash of the rows: neither a hot label nor a hot vector
    fills one, and a block holds at most ``block`` rows on average and 2 ** 22 components.

    Rows without an id, label or vector, with a null or non-finite component (before or after scaling), or with
    another number of components than most take no part; zero vectors do.  Rows that repeat an id are rows of
    their own, but none is a positive or negative of an anchor with that id.  Scores beyond a long become its end.
    Further columns are not read.  Without anchors or rows there is no result.
    """
    spark = vectors.sparkSession
    scaled = F.transform(F.col(vector), lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("vector"), anchors.alias("asked"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(F.coalesce(finite, F.lit(False)))
    # beyond 2 ** 53 every double is whole
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**EXACT, F.floor(x).cast("double")).otherwise(x))
    rows = store(rows.withColumn("vector", whole).withColumn("row", F.monotonically_increasing_id()), "vectors")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    peak = F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector"))))
    facts = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked"), F.coalesce(peak, F.lit(0.0)).alias("peak"))
    facts = facts.orderBy(F.desc("n"), "d").limit(1).collect()
    if not facts or not facts[0].asked:
        return spark.createDataFrame([], result)
    dimension, peak = facts[0].d, int(facts[0].peak)
    packing, kind = Packing(peak, dimension), storage(peak)
    rows = rows.where(F.size("vector") == dimension)
    block = max(256, min(block, (1 << 22) // max(dimension, 1)))
    blocks, turns = -(-facts[0].n // block), -(-facts[0].asked // block)
    index = store(packed_rows(rows, "block", blocks, dimension, kind), "index")
    asks = store(packed_rows(rows.where("asked"), "turn", turns, dimension, kind).toDF("turn", "ask_ids", "ask_labels", "ask_vectors"), "asks")

    def meet(asks, work, columns: str) -> DataFrame:
        meetings = index.select("*", every("turn", turns)).join(asks.select("*", every("block", blocks)), ["block", "turn"])

        def run(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    ids, labels, own = opened(batch, r, "", dimension, kind)
                    asking = opened(batch, r, "ask_", dimension, kind)
                    turn = batch.column("turn")[r].as_py()
                    bands = batch.column("bands")[r].as_buffer() if "bands" in batch.schema.names and batch.column("bands")[r].is_valid else None
                    for found in work(ids, labels, own, *asking, bands):
                        made = [pa.array(np.full(len(found[0]), turn), pa.int64()), *map(as_longs, found)]
                        yield pa.RecordBatch.from_arrays(made, names=columns.replace(" long", "").split(", "))

        return meetings.mapInArrow(run, columns)

    def same_label(ids, labels, own, ask_ids, ask_labels, asking, _):
        """The first rows of each anchor's label; both sides are sorted by label."""
        for value in np.intersect1d(labels, ask_labels):
            rows_, places = (np.flatnonzero(x == value) for x in (labels, ask_labels))
            packed, few = packing.packed(own[rows_]), max(1, cells // len(rows_))
            for at in range(0, len(places), few):
                some = places[at : at + few]
                scores = packing.scores(asking[some], packed, own[rows_])
                other = ids[rows_][None, :] != ask_ids[some][:, None]
                kept = other
                if scores.dtype != object and len(rows_) > positives:
                    floor = np.partition(np.where(other, scores, np.iinfo(np.int64).min), len(rows_) - positives, axis=1)[:, len(rows_) - positives]
                    kept = other & (scores >= floor[:, None])
                x, y = np.nonzero(kept)
                best = first_of(x, scores[x, y], ids[rows_][y], positives)
                x, y = x[best], y[best]
                yield some[x], ask_ids[some][x], ids[rows_][y], scores[x, y]

    def other_labels(ids, labels, own, ask_ids, ask_labels, asking, bands):
        """Rows of other labels that are among the first within the band of one of the anchor's positives."""
        if bands is None:
            return
        bands = np.frombuffer(bands, np.int64).reshape(-1, positives)
        packed, few = packing.packed(own), max(1, cells // len(own))
        for at in range(0, len(ask_ids), few):
            some = slice(at, at + few)
            scores = packing.scores(asking[some], packed, own)
            mine = bands[some].astype(scores.dtype)
            usable = mine >= 0  # a negative score has an empty band
            widest = np.where(usable, mine, -1).max(axis=1)
            least = np.where(usable, mine, LONG // 100).min(axis=1)
            fits = (labels[None, :] != ask_labels[some][:, None]) & (100 * scores >= low * least[:, None]) & (100 * scores <= high * widest[:, None])
            x, y = np.nonzero(fits & (ids[None, :] != ask_ids[some][:, None]))
            score = scores[x, y]
            chosen = np.zeros(len(x), bool)
            for slot in range(positives):
                p = mine[x, slot]
                inside = np.flatnonzero(((p >= 0) & (100 * score >= low * p) & (100 * score <= high * p)).astype(bool))
                chosen[inside[first_of(x[inside], score[inside], ids[y[inside]], negatives)]] = True
            if chosen.any():
                yield x[chosen] + at, ids[y[chosen]], score[chosen]

    place = W.partitionBy("turn", "place")
    found = meet(asks, same_label, "turn long, place long, anchor_id long, positive_id long, positive_score long")
    ordinal = F.row_number().over(place.orderBy(F.desc("positive_score"), "positive_id"))
    known = store(found.withColumn("slot", ordinal).where(F.col("slot") <= positives), "positives")

    def band_table(table: pa.Table) -> pa.Table:
        at, slot, score = (table[c].to_numpy() for c in ("place", "slot", "positive_score"))
        out = np.full((table["places"][0].as_py(), positives), -1, np.int64)
        out[at, slot - 1] = np.maximum(score, -1)
        return pa.table({"turn": table["turn"][:1], "bands": pa.array([out.tobytes()], pa.binary())})

    sizes = asks.select("turn", (F.octet_length("ask_ids") / 8).cast("long").alias("places"))
    bands = known.join(sizes, "turn").select("turn", "place", "slot", "positive_score", "places")
    bands = store(bands.groupBy("turn").applyInArrow(band_table, "turn long, bands binary"), "bands")
    near = meet(asks.join(bands, "turn", "left"), other_labels, "turn long, place long, negative_id long, negative_score long")
    p, n = (F.col(c).cast("decimal(20,0)") for c in ("positive_score", "negative_score"))
    inside = (low * p <= 100 * n) & (100 * n <= high * p)
    ranked = known.join(store(near, "near"), ["turn", "place"]).where(inside)
    order = W.partitionBy("turn", "place", "slot").orderBy(F.desc("negative_score"), "negative_id")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
