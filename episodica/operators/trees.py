"""Tree ensembles on binned features: deep forests whose top grows from summed histograms and whose subtrees grow in tasks.

Features are cut into at most 255 bins once; training rows are then one byte a feature, packed into blocks that
every pass reads.  A node with more rows than a task should hold is split from histograms that Spark sums up.  Once
all open nodes are small enough, their rows are handed over, one group per (tree, node), and the rest of each
subtree is grown in its task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.operators.linear import as_array, matrix
from episodica.sources.shared import store

BINS = 255
# shares of a Poisson(1) draw below 1, 2, 3, ... occurrences
OCCURS = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])
# bytes of histograms that a task holds before it gives them out
HELD = 1 << 26
# training rows that a task looks at together, and rows up to which nodes of a subtree are split level by level
TOGETHER, SMALL = 1 << 16, 1 << 12
# sums of weights below this share a double with those of weighted labels
PAIR = float(1 << 26)
# tasks whose histograms may meet in one task, and the number of tasks that add them up before
MEETING, SHARDS = 512, 32
NODES = "tree int, root long, at int, feature int, cut double, low int, high int, value double, cover double"
PACKED = "tree int, feature binary, cut binary, low binary, high binary, value binary, cover binary"
KINDS = {"feature": np.int32, "cut": np.float64, "low": np.int32, "high": np.int32, "value": np.float64, "cover": np.float64}


def summary(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values with weights, at most ``points``: the last value of each stretch of equal weight stands for it.

    Ranks at the kept values are exact, so a value's rank is off by one stretch at most.  Few values stay as they are.
    """
    values, at = np.unique(values, return_inverse=True)
    weights = np.bincount(at, weights, len(values))
    if len(values) <= points:
        return values, weights
    running = np.cumsum(weights)
    stretch = np.minimum((running * points / running[-1]).astype(np.int64), points - 1)
    last = np.flatnonzero(np.append(np.diff(stretch) > 0, True))
    return values[last], np.diff(np.append(0.0, running[last]))


def bin_edges(rows: DataFrame, width: int, bins: int = BINS, points: int = 4 * BINS, shards: int = 32) -> list[np.ndarray]:
    """Rising cut points per feature, ``bins`` - 1 at most: quantiles of all rows from summaries that tasks make and merge.

    A merge reads ``points`` values from each task of its shard, then from each shard, whatever the rows are.
    """

    def scan(batches):
        held = [(np.zeros(0), np.zeros(0))] * width
        for batch in batches:
            x = matrix(batch.column(0), width)
            held = [summary(np.concatenate([v, x[:, f]]), np.concatenate([w, np.ones(len(x))]), points) for f, (v, w) in enumerate(held)]
        for f, (v, w) in enumerate(held):
            if len(v):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), f, np.int32)), pa.array(v), pa.array(w)], names=["feature", "value", "weight"])

    def merge(table: pa.Table) -> pa.Table:
        v, w = summary(table["value"].to_numpy(), table["weight"].to_numpy(), points)
        return pa.table({"feature": pa.array(np.full(len(v), table["feature"][0].as_py(), np.int32)), "value": v, "weight": w})

    def cuts(table: pa.Table) -> pa.Table:
        v, w = summary(table["value"].to_numpy(), table["weight"].to_numpy(), points)
        running = np.cumsum(w)
        at = np.searchsorted(running, np.arange(1, bins) / bins * running[-1] * (1 - 1e-12))
        return pa.table({"feature": table["feature"][:1], "cuts": pa.array([np.unique(v[at]).tolist()])})

    schema = "feature int, value double, weight double"
    found = rows.select("features").mapInArrow(scan, schema).withColumn("shard", F.pmod(F.spark_partition_id(), F.lit(shards)))
    found = found.groupBy("feature", "shard").applyInArrow(merge, schema).groupBy("feature").applyInArrow(cuts, "feature int, cuts array<double>")
    by_feature = {r.feature: np.array(r.cuts) for r in found.collect()}
    return [by_feature.get(f, np.zeros(1)) for f in range(width)]


def pack_rows(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """One row per block of training rows: their ids, labels and bins as bytes.  Stored, so ids stay as they are."""
    d = len(edges)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1), d)
                bins = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(d)], axis=1).astype(np.uint8)
                cells = [batch.column(0).to_numpy().tobytes(), batch.column(2).to_numpy().astype(np.float64).tobytes(), bins.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["ids", "labels", "bins"])

    numbered = rows.select(F.monotonically_increasing_id().alias("id"), "features", F.col("label").cast("double").alias("label"))
    return store(numbered.mapInArrow(run, "ids binary, labels binary, bins binary"), "binned-rows")


def unpacked(batch: pa.RecordBatch, width: int):
    """(ids, labels, bins) of each block of a batch."""
    for r in range(batch.num_rows):
        ids, labels, bins = (batch.column(c)[r].as_buffer() for c in ("ids", "labels", "bins"))
        labels = np.frombuffer(labels, np.float64)
        yield np.frombuffer(ids, np.int64), labels, np.frombuffer(bins, np.uint8).reshape(len(labels), width)


def spread_bits(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# occurrences by the first 16 bits of a draw; those that hold a step between two numbers are looked at again
STEPS = np.searchsorted(OCCURS, np.arange(1 << 16) / 2.0**16, "right").astype(np.float64)
STEPS[np.searchsorted(OCCURS, (np.arange(1 << 16) + 1) / 2.0**16, "right") != STEPS] = -1


def occurrences(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row stands in a tree's sample: a Poisson(1) draw that depends on row, tree and seed alone."""
    salt = np.uint64((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    draw = spread_bits(ids.view(np.uint64) ^ salt)
    out = STEPS.take((draw >> np.uint64(48)).astype(np.int64))
    again = np.flatnonzero(out < 0)
    out[again] = np.searchsorted(OCCURS, (draw[again] >> np.uint64(11)).astype(np.float64) / 2.0**53, "right")
    return out


@dataclass
class ForestSettings:
    trees: int = 200
    depth: int = 20
    leaf: int = 50
    seed: int = 42
    bootstrap: bool = True
    random_cuts: bool = False
    share: str | float = "sqrt"

    def tried(self, width: int) -> int:
        return max(1, int(width**0.5) if self.share == "sqrt" else round(width * float(self.share)))

    def chosen(self, tree: int, node: int, width: int) -> tuple[np.ndarray, np.random.Generator]:
        """The features that a node may be split on, and the numbers for its random cuts: by tree and node alone."""
        rng = np.random.default_rng((self.seed, tree, node))
        return np.sort(rng.choice(width, self.tried(width), replace=False)), rng


def mixed(words: list[np.ndarray]) -> list[np.ndarray]:
    """The four 64-bit words that numpy's SeedSequence makes of up to four 32-bit numbers, for many of them at once."""
    u, low, pool = np.uint64, np.uint64(0xFFFFFFFF), []

    def hashed(v, times, factor):
        v = v ^ u(times)
        times = times * factor & 0xFFFFFFFF
        v = v * u(times) & low
        return v ^ (v >> u(16)), times

    times = 0x43B0D7E5
    for v in words:
        v, times = hashed(v, times, 0x931E8875)
        pool.append(v)
    for source in range(4):
        for goal in range(4):
            if source != goal:
                v, times = hashed(pool[source], times, 0x931E8875)
                v = (pool[goal] * u(0xCA01F9DD) - v * u(0x4973F715)) & low
                pool[goal] = v ^ (v >> u(16))
    times, out = 0x8B51F9DD, []
    for i in range(8):
        v, times = hashed(pool[i % 4], times, 0x58F38DED)
        out.append(v)
    return [out[i] | (out[i + 1] << u(32)) for i in range(0, 8, 2)]


class Generators:
    """numpy's default generators of many nodes of a tree, a step at a time for all of them."""

    def __init__(self, seed: int, tree: int, nodes: np.ndarray):
        u, n = np.uint64, len(nodes)
        high, low, high_step, low_step = mixed([np.full(n, seed, u), np.full(n, tree, u), nodes.astype(u), np.zeros(n, u)])
        self.high_step, self.low_step = (high_step << u(1)) | (low_step >> u(63)), (low_step << u(1)) | u(1)
        self.low = self.low_step + low
        self.high = self.high_step + high + (self.low < low)
        self.half = None
        self.step()

    def step(self) -> None:
        u, low32 = np.uint64, np.uint64(0xFFFFFFFF)
        a0, a1, b0, b1 = self.low & low32, self.low >> u(32), u(0x9FCCF645), u(0x4385DF64)
        middle = a1 * b0 + (a0 * b0 >> u(32))
        high = a1 * b1 + (middle >> u(32)) + (a0 * b1 + (middle & low32) >> u(32))
        high += self.high * u(0x4385DF649FCCF645) + self.low * u(0x2360ED051FC65DA4)
        self.low = self.low * u(0x4385DF649FCCF645) + self.low_step
        self.high = high + self.high_step + (self.low < self.low_step)

    def next64(self) -> np.ndarray:
        self.step()
        v, turn = self.high ^ self.low, self.high >> np.uint64(58)
        return (v >> turn) | (v << (np.uint64(64) - turn & np.uint64(63)))

    def below(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers below ``n``, and where numpy might have drawn again."""
        if self.half is None:
            v = self.next64()
            v, self.half = v & np.uint64(0xFFFFFFFF), v >> np.uint64(32)
        else:
            v, self.half = self.half, None
        v = v * np.uint64(n)
        return (v >> np.uint64(32)).astype(np.int64), v & np.uint64(0xFFFFFFFF) < np.uint64(n)

    def unit(self) -> np.ndarray:
        return (self.next64() >> np.uint64(11)).astype(np.float64) / 2.0**53


def chosen_of_many(settings: ForestSettings, tree: int, nodes: list[int], width: int) -> tuple[np.ndarray, np.ndarray | None]:
    """What :meth:`ForestSettings.chosen` gives for many nodes: features (nodes x tried), and numbers for random cuts.

    The steps of numpy's generator are taken for all nodes together; nodes whose draws need more care ask numpy.
    """
    k = settings.tried(width)
    features, units = np.empty((len(nodes), k), np.int64), np.empty((len(nodes), k)) if settings.random_cuts else None
    alone = np.ones(len(nodes), bool)
    if len(nodes) > 8 and width <= 10_000 and 0 <= settings.seed < 1 << 32 and max(nodes) < 1 << 32:
        many = Generators(settings.seed, tree, np.array(nodes, np.uint64))
        alone[:] = False
        for i, top in enumerate(range(width - k, width)):
            drawn, again = many.below(top + 1) if top else (np.zeros(len(nodes), np.int64), False)
            features[:, i] = np.where((features[:, :i] == drawn[:, None]).any(axis=1), top, drawn)
            alone |= again
        for i in range(k - 1, 0, -1):
            alone |= many.below(i + 1)[1]
        features.sort(axis=1)
        for i in range(k if units is not None else 0):
            units[:, i] = many.unit()
    for at in np.flatnonzero(alone):
        features[at], rng = settings.chosen(tree, nodes[at], width)
        if units is not None:
            units[at] = rng.random(k)
    return features, units


def gini_split(weight: np.ndarray, hits: np.ndarray, leaf: float, units: np.ndarray | None = None):
    """Best cut of a node out of histograms (features x bins): ``(gain, feature, bin, weight left, hits left)`` or None.

    Rows with a bin up to the cut go left.  Ties go to the first feature and bin.  With ``units``, a number below 1 a
    feature, each feature has one cut, at that share of the way between its lowest and highest bin.
    """
    left, left_hits = np.cumsum(weight, axis=1)[:, :-1], np.cumsum(hits, axis=1)[:, :-1]
    total, all_hits = weight[0].sum(), hits[0].sum()
    right, right_hits = total - left, all_hits - left_hits
    allowed = (left >= leaf) & (right >= leaf)
    if units is not None:
        filled = weight > 0
        lowest, highest = filled.argmax(axis=1), filled.shape[1] - 1 - filled[:, ::-1].argmax(axis=1)
        drawn = lowest + np.floor(units * np.maximum(highest - lowest, 1)).astype(np.int64)
        only = np.zeros_like(allowed)
        only[np.arange(len(weight)), np.minimum(drawn, only.shape[1] - 1)] = True
        allowed &= only
    if not allowed.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = left_hits**2 / left + (left - left_hits) ** 2 / left + right_hits**2 / right + (right - right_hits) ** 2 / right
    gain = np.where(allowed, pure - (all_hits**2 + (total - all_hits) ** 2) / total, -np.inf)
    best = int(gain.argmax())
    if not gain.flat[best] > 1e-12 * total:
        return None
    f, b = divmod(best, gain.shape[1])
    return float(gain[f, b]), f, b, float(left[f, b]), float(left_hits[f, b])


def narrow_split(ones: np.ndarray, hits: np.ndarray, total: float, all_hits: float, leaf: float) -> np.ndarray:
    """Gain of the only cut of features with two bins, from the weight and label sums of the upper bin; -inf if refused.

    The same numbers as those of :func:`gini_split`; a drawn cut of two filled bins is the same one.
    """
    left, left_hits, right, right_hits = total - ones, all_hits - hits, ones, hits
    allowed = (left >= leaf) & (right >= leaf) & (left > 0) & (right > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = left_hits**2 / left + (left - left_hits) ** 2 / left + right_hits**2 / right + (right - right_hits) ** 2 / right
    return np.where(allowed, pure - (all_hits**2 + (total - all_hits) ** 2) / total, -np.inf)


def grow_subtree(bins: np.ndarray, labels: np.ndarray, weight: np.ndarray, settings: ForestSettings, tree: int, root: int, depth: int):
    """Nodes of a subtree as lists (feature, bin, low, high, value, cover) by place; ``root`` is the place in the whole tree.

    Weights are whole numbers, so sums are exact in any order; features with two bins need a product with the weights only.
    """
    columns = np.ascontiguousarray(bins.T)
    tops = columns.max(axis=1, initial=0)
    # whole numbers below 2^24 add up exactly in single precision
    marks = np.stack([weight, weight * labels]).astype(np.float32 if weight.sum() < 1 << 24 else np.float64)
    nodes, todo, small = [], [(np.arange(len(labels)), root, depth, -1, False)], []
    by_level = settings.leaf >= 1 and weight.sum() < PAIR and weight.min(initial=1) > 0
    while todo:
        rows, name, at_depth, parent, is_high = todo.pop()
        place, own_marks = len(nodes), marks.take(rows, axis=1)
        total, hits = (float(v) for v in own_marks.sum(axis=1))
        nodes.append([-1, 0, -1, -1, hits / total if total else 0.0, total])
        if parent >= 0:
            nodes[parent][3 if is_high else 2] = place
        if at_depth >= settings.depth or total < 2 * settings.leaf or hits <= 0 or hits >= total:
            continue
        if by_level and len(rows) <= SMALL:
            small.append((rows, name, at_depth, place))
            continue
        features, rng = settings.chosen(tree, name, len(columns))
        units = rng.random(len(features)) if settings.random_cuts else None
        own = np.stack([columns[f].take(rows) for f in features])
        found = best_cut(own, own_marks, tops[features], total, hits, settings.leaf, units)
        if found is None:
            continue
        f, cut = found
        nodes[place][:2] = [int(features[f]), cut]
        left = own[f] <= cut
        # places of children follow from the parent's, as in a heap; numbers of any size seed their draws
        todo += [(rows[~left], 2 * name + 2, at_depth + 1, place, True), (rows[left], 2 * name + 1, at_depth + 1, place, False)]
    if small:
        grow_small(bins, marks[0] + marks[1].astype(np.float64) * PAIR, tops, settings, tree, small, nodes)
    return nodes


def gini_gain(left, left_hits, total, all_hits, leaf: float) -> np.ndarray:
    """Gain of cuts with so much on the left, as :func:`gini_split` has it; -inf where a side has less than ``leaf``."""
    right, right_hits = total - left, all_hits - left_hits
    allowed = (left >= leaf) & (right >= leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = left_hits**2 / left + (left - left_hits) ** 2 / left + right_hits**2 / right + (right - right_hits) ** 2 / right
    return np.where(allowed, pure - (all_hits**2 + (total - all_hits) ** 2) / total, -np.inf)


def parted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weights and of weighted labels out of sums of pairs."""
    hits = np.floor(pairs / PAIR)
    return pairs - hits * PAIR, hits


def grow_small(bins: np.ndarray, pairs: np.ndarray, tops: np.ndarray, settings: ForestSettings, tree: int, small, nodes: list) -> None:
    """Grow below many small nodes at once, level by level; new nodes are appended and filled in as by :func:`grow_subtree`.

    ``pairs`` has weight and weighted label of each row in one number; ``small`` the open nodes (rows, name, depth, place).
    """
    flat, width = bins.ravel(), bins.shape[1]
    todo = [([rows], [name], [at_depth], [place]) for rows, name, at_depth, place in small]
    while todo:
        # nodes of one level go on together, in runs of so many rows that they stay near the processor
        runs, held = [], TOGETHER
        for open_nodes in todo:
            size = sum(map(len, open_nodes[0]))
            if held + size > TOGETHER:
                runs.append(([], [], [], []))
                held = 0
            held += size
            for mine, more in zip(runs[-1], open_nodes, strict=True):
                mine.extend(more)
        todo = []
        for parts, names, depths, places in runs:
            lengths = np.array([len(p) for p in parts])
            rows, starts, seg = np.concatenate(parts), np.cumsum(lengths) - lengths, np.repeat(np.arange(len(parts)), lengths)
            mine, base = pairs.take(rows), rows * width
            total, hits = parted(np.add.reduceat(mine, starts))
            feature, cut, gain = split_small(flat, base, mine, seg, starts, total, hits, tops, settings, *chosen_of_many(settings, tree, names, width))
            split = gain > 1e-12 * total
            low = flat.take(base + feature[seg]) <= cut[seg]
            n_low = np.add.reduceat(low.astype(np.int64), starts)
            low_pairs = np.add.reduceat(np.where(low, mine, 0.0), starts)
            sides = [(low, n_low, *parted(low_pairs))]
            sides.append((~low, lengths - n_low, total - sides[0][2], hits - sides[0][3]))
            for side, (chosen, sizes, totals, all_hits) in enumerate(sides):
                pieces = np.split(rows[chosen], np.cumsum(sizes)[:-1])
                for i in np.flatnonzero(split):
                    place, total_, hits_ = len(nodes), float(totals[i]), float(all_hits[i])
                    nodes.append([-1, 0, -1, -1, hits_ / total_, total_])
                    nodes[places[i]][2 + side] = place
                    if side == 0:
                        nodes[places[i]][:2] = [int(feature[i]), int(cut[i])]
                    if depths[i] + 1 < settings.depth and total_ >= 2 * settings.leaf and 0 < hits_ < total_:
                        todo.append(([pieces[i]], [2 * names[i] + 1 + side], [depths[i] + 1], [place]))


def split_small(flat, base, mine, seg, starts, total, hits, tops, settings: ForestSettings, features, units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, bin and gain of the best cut of each node, as :func:`best_cut` finds it; rows are in runs, one a node."""
    n, k = features.shape
    cuts, gains, wide = np.zeros((n, k), np.int64), np.empty((n, k)), tops[features] > 1
    cells, weights, found = [], [], []
    levels = int(tops[features[wide]].max(initial=0)) + 1
    for j in range(k):
        own = flat.take(base + features[seg, j])
        if units is not None:
            lowest, highest = np.minimum.reduceat(own, starts).astype(np.int64), np.maximum.reduceat(own, starts).astype(np.int64)
            cuts[:, j] = np.where(wide[:, j], lowest + np.floor(units[:, j] * np.maximum(highest - lowest, 1)).astype(np.int64), 0)
        elif wide[:, j].any():
            # features with more than two bins need a histogram
            at = np.flatnonzero(wide[:, j])
            place = np.full(n, -1)
            place[at] = len(found) + np.arange(len(at))
            found += [(i, j) for i in at]
            chosen = np.flatnonzero(place[seg] >= 0)
            cells.append(place[seg[chosen]] * levels + own[chosen])
            weights.append(mine[chosen])
        upper = np.add.reduceat(np.where(own > cuts[seg, j], mine, 0.0), starts)
        ones, one_hits = parted(upper)
        gains[:, j] = gini_gain(total - ones, hits - one_hits, total, hits, settings.leaf)
    if found:
        node, slot = (np.array(c) for c in zip(*found, strict=True))
        sums = np.bincount(np.concatenate(cells), np.concatenate(weights), len(found) * levels).reshape(len(found), levels)
        gain = gini_gain(*parted(np.cumsum(sums, axis=1)[:, :-1]), total[node, None], hits[node, None], settings.leaf)
        cuts[node, slot] = gain.argmax(axis=1)
        gains[node, slot] = gain.max(axis=1)
    best = gains.argmax(axis=1)
    here = np.arange(n)
    return features[here, best], cuts[here, best], gains[here, best]


def best_cut(own: np.ndarray, marks: np.ndarray, tops: np.ndarray, total: float, hits: float, leaf: float, units: np.ndarray | None):
    """``(feature, bin)`` of the best cut of a node's rows, as :func:`gini_split` finds it, or None.

    ``own`` has the bins (features x rows), ``marks`` weight and weighted label, ``tops`` the highest bin of each feature.
    """
    best = (1e-12 * total, 0, 0)
    narrow = np.flatnonzero(tops <= 1)
    if len(narrow):
        upper = own[narrow].astype(marks.dtype) @ marks.T
        gain = narrow_split(upper[:, 0].astype(float), upper[:, 1].astype(float), total, hits, leaf)
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (float(gain[at]), -int(narrow[at]), 0)
    wide = np.flatnonzero(tops > 1)
    if len(wide):
        levels = int(tops[wide].max()) + 1
        if total < PAIR:
            pairs = marks[0] + marks[1].astype(np.float64) * PAIR
            sums = parted(np.stack([np.bincount(own[f], pairs, levels) for f in wide]))
        else:
            sums = [np.stack([np.bincount(own[f], m, levels) for f in wide]) for m in marks]
        found = gini_split(*sums, leaf, units=None if units is None else units[wide])
        # of equal gains the first feature's wins
        if found is not None and (found[0], -int(wide[found[1]])) > best[:2]:
            best = (found[0], -int(wide[found[1]]), found[2])
    return None if best[0] <= 1e-12 * total else (-best[1], best[2])


def ways(nodes) -> set[int]:
    """The nodes and all that are above them."""
    out = set()
    for node in nodes:
        while node not in out:
            out.add(node)
            node = max(0, (node - 1) // 2)
    return out


def rows_of(columns: np.ndarray, used: np.ndarray, top: dict[int, tuple[int, int]], wanted: set[int], way: set[int]):
    """``(node, rows)`` of the wanted open nodes of a tree's top that some of the rows ``used`` fall into, in their order.

    ``top`` has (feature, bin) of split nodes by place.  Parts of the top without a wanted node are not walked.
    """
    todo = [(0, used)] if len(used) else []
    while todo:
        node, here = todo.pop()
        if node not in top:
            if node in wanted:
                yield node, here
            continue
        feature, cut = top[node]
        low = columns[feature].take(here) <= cut
        for child, rows in ((2 * node + 2, here[~low] if 2 * node + 2 in way else ()), (2 * node + 1, here[low] if 2 * node + 1 in way else ())):
            if len(rows):
                todo.append((child, rows))


def together(batches, width: int):
    """(ids, labels, bins, bins by feature) of blocks, several at a time."""
    held = []
    for batch in batches:
        for block in unpacked(batch, width):
            held.append(block)
            if sum(len(b[0]) for b in held) >= TOGETHER:
                yield joined(held)
                held = []
    if held:
        yield joined(held)


def joined(blocks):
    ids, labels, bins = (np.concatenate(parts) for parts in zip(*blocks, strict=True))
    return ids, labels, bins, np.ascontiguousarray(bins.T)


def by_node(at: np.ndarray, used: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The rows ``used``, run by run of the node that they are at, in their order."""
    if not len(used):
        return []
    used = used[np.argsort(at[used], kind="stable")]
    runs = np.split(used, np.flatnonzero(np.diff(at[used])) + 1)
    return [(int(at[run[0]]), run) for run in runs]


def wide_features(packed: DataFrame, width: int) -> list[int]:
    """Features with more than two bins in use; all others fit in a bit."""

    def run(batches):
        tops = np.zeros(width, np.int32)
        for batch in batches:
            for _, _, bins in unpacked(batch, width):
                tops = np.maximum(tops, bins.max(axis=0, initial=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(tops)], names=["feature", "top"])

    found = packed.mapInArrow(run, "feature int, top int").groupBy("feature").agg(F.max("top").alias("top")).where("top > 1")
    return sorted(r.feature for r in found.collect())


def slim(bins: np.ndarray, wide: list[int]) -> np.ndarray:
    """Rows of bins with one byte for each wide feature and one bit for each other one."""
    narrow = np.setdiff1d(np.arange(bins.shape[1]), wide)
    return np.concatenate([bins[:, wide], np.packbits(bins[:, narrow], axis=1)], axis=1)


def full(rows: np.ndarray, wide: list[int], width: int) -> np.ndarray:
    """The bins that :func:`slim` was made of."""
    narrow = np.setdiff1d(np.arange(width), wide)
    out = np.empty((len(rows), width), np.uint8)
    out[:, wide] = rows[:, : len(wide)]
    out[:, narrow] = np.unpackbits(rows[:, len(wide) :], axis=1, count=len(narrow)) if len(narrow) else 0
    return out


def merged(batches):
    """Small batches as one."""
    batches = list(batches)
    if batches:
        yield from pa.Table.from_batches(batches).combine_chunks().to_batches()


def add_sums(sums: np.ndarray, columns: np.ndarray, rows: np.ndarray, features: np.ndarray, is_wide: np.ndarray, marks: np.ndarray) -> None:
    """Add weight and weighted label of rows to a node's histograms (2 x features x bins); features with two bins need one product."""
    levels, mine = sums.shape[2], marks.take(rows, axis=1)
    narrow = np.flatnonzero(~is_wide[features])
    if len(narrow):
        # whole numbers below 2^24 add up exactly in single precision
        upper = (np.stack([columns[f].take(rows) for f in features[narrow]]).astype(np.float32) @ mine.T.astype(np.float32)).T.astype(np.float64)
        sums[:, narrow, 0] += mine.sum(axis=1)[:, None] - upper
        if levels > 1:
            sums[:, narrow, 1] += upper
    pairs = mine[0] + mine[1] * PAIR
    for at in np.flatnonzero(is_wide[features]):
        sums[:, at] += parted(np.bincount(columns[features[at]].take(rows), pairs, levels))


def split_tops(packed: DataFrame, tops, open_nodes, settings: ForestSettings, width: int, levels: int, wide: list[int] | None = None):
    """Splits of the open nodes (tree, node) from histograms over all rows: ``{(tree, node): (gain, feature, bin, ...)}``.

    Every task gives out one row a (tree, node), with its sums of weight and label per (feature tried, bin); tasks add them
    up, some of many first, and each node's histogram, of a size that follows from features and bins, is searched in a task.
    """
    by_tree: dict[int, set[int]] = {}
    for tree, node in open_nodes:
        by_tree.setdefault(tree, set()).add(node)
    shared = packed.sparkSession.sparkContext.broadcast((tops, by_tree))
    is_wide, kept = np.isin(np.arange(width), wide_features(packed, width) if wide is None else wide), "tree int, node long, shard int, slots binary, w binary, h binary"

    def given_out(held):
        for (tree, node), sums in held.items():
            yield as_sums(tree, node, 0, sums.reshape(2, -1))

    def run(batches):
        tops_, wanted = shared.value
        held, tried, way = {}, {}, {tree: ways(nodes) for tree, nodes in wanted.items()}
        for ids, labels, _, columns in together(batches, width):
            for tree, nodes in wanted.items():
                weight = occurrences(ids, tree, settings.seed) if settings.bootstrap else np.ones(len(ids))
                marks = np.stack([weight, weight * labels])
                for node, rows in rows_of(columns, np.flatnonzero(weight), tops_.get(tree, {}), nodes, way[tree]):
                    at = (tree, node)
                    if at not in tried:
                        tried[at] = settings.chosen(tree, node, width)[0]
                    if at not in held:
                        held[at] = np.zeros((2, len(tried[at]), levels))
                    add_sums(held[at], columns, rows, tried[at], is_wide, marks)
                # a task holds the sums of all its blocks, up to a bound
                if len(held) * levels * settings.tried(width) * 16 > HELD:
                    yield from merged(given_out(held))
                    held = {}
        yield from merged(given_out(held))

    def summed(table: pa.Table) -> np.ndarray:
        sums = np.zeros((2, settings.tried(width) * levels))
        for r in range(table.num_rows):
            slots, w, h = (np.frombuffer(table[c][r].as_buffer(), t) for c, t in (("slots", np.int32), ("w", np.float64), ("h", np.float64)))
            sums[:, slots] += [w, h]
        return sums

    def add_up(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([as_sums(*(table[c][0].as_py() for c in ("tree", "node", "shard")), summed(table))])

    def search(table: pa.Table) -> pa.Table:
        tree, node = (table[c][0].as_py() for c in ("tree", "node"))
        features, rng = settings.chosen(tree, node, width)
        sums = summed(table).reshape(2, len(features), levels)
        found = gini_split(*sums, settings.leaf, rng.random(len(features)) if settings.random_cuts else None)
        total, hits = float(sums[0][0].sum()), float(sums[1][0].sum())
        gain, f, cut, left, left_hits = found or (-1.0, -1, 0, 0.0, 0.0)
        values = (tree, node, int(features[f]) if found else -1, cut, total, hits, left, left_hits)
        return pa.table({n: pa.array([v], t) for n, v, t in zip(("tree", "node", "feature", "cut", "total", "hits", "left", "left_hits"), values, TYPES, strict=True)})

    sums = packed.mapInArrow(run, kept)
    if packed.rdd.getNumPartitions() > MEETING:
        sums = sums.withColumn("shard", F.pmod(F.spark_partition_id(), F.lit(SHARDS))).groupBy("tree", "node", "shard").applyInArrow(add_up, kept)
    found = sums.groupBy("tree", "node").applyInArrow(search, "tree int, node long, feature int, cut int, total double, hits double, left double, left_hits double")
    out = {(r.tree, r.node): r for r in found.collect()}
    shared.unpersist()
    return out


def as_sums(tree: int, node: int, shard: int, sums: np.ndarray) -> pa.RecordBatch:
    """The filled slots of a node's histograms as one row."""
    slots = np.flatnonzero(sums[0])
    cells = [slots.astype(np.int32), *sums[:, slots]]
    columns = [pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array([shard], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cells]]
    return pa.RecordBatch.from_arrays(columns, names=["tree", "node", "shard", "slots", "w", "h"])


TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.float64()] * 4)


def depth_of(node: int) -> int:
    return (node + 1).bit_length() - 1


class TreeEnsemble:
    """Trees as a table, one row a tree with its nodes as bytes.

    ``scale`` times the sum of leaf values plus ``start`` is the margin; a forest's is its probability already.
    """

    def __init__(self, table: DataFrame, scale: float = 1.0, start: float = 0.0, logistic: bool = False, block_bytes: int = 1 << 26):
        self.table, self.scale, self.start, self.logistic, self.block_bytes = table, scale, start, logistic, block_bytes

    def blocks(self):
        """Trees in runs whose nodes take at most ``block_bytes`` (one tree at least), one run at a time on the driver."""
        sizes = sorted((r.tree, r.size) for r in self.table.select("tree", (F.octet_length("cut") * 4).alias("size")).collect())
        runs, held = [[]], 0
        for tree, size in sizes:
            if runs[-1] and held + size > self.block_bytes:
                runs, held = [*runs, []], 0
            runs[-1].append(tree)
            held += size
        for run in runs:
            if run:
                rows = self.table.where(F.col("tree").between(run[0], run[-1])).orderBy("tree").collect()
                yield [{n: np.frombuffer(r[n], k) for n, k in KINDS.items()} for r in rows]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds the probability ``p``.  Each block of trees is broadcast on its own and adds its share to the margin."""
        spark, kept = df.sparkSession, df.columns
        out = df.withColumns({"_x": as_array(df, features), "_margin": F.lit(0.0)})
        for block in self.blocks():
            out = add_margin(out, spark.sparkContext.broadcast(block))
        margin = F.lit(self.start) + F.lit(self.scale) * F.col("_margin")
        return out.withColumn("p", 1 / (1 + F.exp(-margin)) if self.logistic else margin).select(*kept, "p")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/trees")
        facts = [(float(self.scale), float(self.start), self.logistic)]
        spark.createDataFrame(facts, "scale double, start double, logistic boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TreeEnsemble":
        return cls(spark.read.parquet(f"{path}/trees"), *spark.read.parquet(f"{path}/facts").first())


def leaf_values(x: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    """Value of the leaf that each row of ``x`` reaches; values up to a cut go to the low side."""
    at = np.zeros(len(x), np.int32)
    open_rows = np.arange(len(x) if tree["feature"][0] >= 0 else 0)
    while len(open_rows):
        node = at[open_rows]
        low = x[open_rows, tree["feature"][node]] <= tree["cut"][node]
        at[open_rows] = np.where(low, tree["low"][node], tree["high"][node])
        open_rows = open_rows[tree["feature"][at[open_rows]] >= 0]
    return tree["value"][at]


def add_margin(df: DataFrame, shared) -> DataFrame:
    """Adds the values of a block's trees.  As the sum so far goes in, Spark gives every block workers of its own."""

    @F.pandas_udf("double")
    def margins(x: pd.Series, so_far: pd.Series) -> pd.Series:
        values, total = np.stack(x.to_numpy()), so_far.to_numpy().copy()
        for tree in shared.value:
            total += leaf_values(values, tree)
        return pd.Series(total)

    return df.withColumn("_margin", margins("_x", "_margin"))


def assemble(nodes: DataFrame) -> DataFrame:
    """Node rows to one row a tree: the top's nodes first, then subtrees by the place that they continue."""

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_numpy() for c in ("root", "at", "feature", "cut", "low", "high", "value", "cover")}
        order = np.lexsort((columns["at"], columns["root"]))
        columns = {c: v[order] for c, v in columns.items()}
        root, at = columns["root"], columns["at"]
        roots, first = np.unique(root, return_index=True)
        starts = dict(zip(roots.tolist(), first.tolist(), strict=True))
        tops = {int(place): i for i, place in enumerate(at) if root[i] < 0}
        low, high = columns["low"].copy(), columns["high"].copy()
        inner = columns["feature"] >= 0
        sub = inner & (root >= 0)
        offset = first[np.searchsorted(roots, root[sub])].astype(low.dtype)
        low[sub] += offset
        high[sub] += offset
        # the top has heap places; where a child is no node of the top, a subtree starts
        for i in np.flatnonzero(inner & (root < 0)):
            low[i], high[i] = (tops.get(c, starts.get(c, -1)) for c in (2 * int(at[i]) + 1, 2 * int(at[i]) + 2))
        columns |= {"low": low, "high": high}
        cells = {n: pa.array([columns[n].astype(k).tobytes()], pa.binary()) for n, k in KINDS.items()}
        return pa.table({"tree": table["tree"][:1], **cells})

    return nodes.groupBy("tree").applyInArrow(run, PACKED)


def fit_forest(rows: DataFrame, settings: ForestSettings = ForestSettings(), per_task: int = 1 << 18, trees_at_once: int = 100) -> TreeEnsemble:
    """A random forest on ``features`` (vector or array) and ``label`` (0 or 1).

    A tree sees every row as often as a Poisson(1) draw says; a node tries the square root of the features.  Nodes with
    more than ``per_task`` weighted rows are split from summed histograms.  The rows of smaller ones are handed over, about
    ``per_task`` rows of a bit or a byte a feature a task, for ``trees_at_once`` trees in one job, so a shuffle holds at most that
    many copies of the binned rows.  A node is a leaf at full depth, if it is pure, or if no cut leaves ``leaf`` rows on
    both sides.  Draws depend on rows, trees and nodes alone, so lost tasks give the same trees again.  The driver
    holds the tops: 2 / ``per_task`` nodes a row and tree at most.

    Rows with a NULL label or features are left out; without rows the forest gives 0.
    """
    spark = rows.sparkSession
    rows = store(rows.select(as_array(rows, "features").alias("features"), "label").where("features is not null and label is not null"), "tree-rows")
    first = rows.select(F.size("features").alias("d")).first()
    if first is None:
        return TreeEnsemble(spark.createDataFrame([], PACKED))
    width = first.d
    edges = bin_edges(rows, width)
    levels = max(len(e) for e in edges) + 1
    packed, n_rows, parts = pack_rows(rows, edges), rows.count(), []
    wide = wide_features(packed, width)
    for start in range(0, settings.trees, trees_at_once):
        trees = range(start, min(settings.trees, start + trees_at_once))
        parts.append(grow_trees(packed, trees, edges, settings, levels, per_task, n_rows, wide))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    table = store(table, "forest")
    # a tree whose draws left it without rows has no nodes
    return TreeEnsemble(table, 1.0 / max(1, table.count()))


def grow_trees(packed: DataFrame, trees: range, edges, settings: ForestSettings, levels: int, per_task: int, n_rows: int, wide: list[int]) -> DataFrame:
    """Trees of one batch, a row each, stored."""
    spark, width = packed.sparkSession, len(edges)
    tops: dict[int, dict[int, tuple[int, int]]] = {t: {} for t in trees}
    leaves, sizes = [], {(t, 0): (float(n_rows), 0.5 * n_rows) for t in trees}
    handed, large = ([], list(sizes)) if n_rows > per_task else (list(sizes), [])
    while large:
        found = split_tops(packed, tops, large, settings, width, levels, wide)
        large = []
        for (tree, node), r in found.items():
            if r.feature < 0 or depth_of(node) >= settings.depth:
                leaves.append((tree, node, r.hits / r.total, r.total))
                continue
            tops[tree][node] = (r.feature, r.cut)
            for child, total, hits in ((2 * node + 1, r.left, r.left_hits), (2 * node + 2, r.total - r.left, r.hits - r.left_hits)):
                (large if total > per_task and depth_of(child) < settings.depth and 0 < hits < total else handed).append((tree, child))
    top_rows = [
        (tree, -1, node, feature, float(edges[feature][cut]), -1, -1, 0.0, 0.0) for tree, top in tops.items() for node, (feature, cut) in top.items()
    ] + [(tree, -1, node, -1, 0.0, -1, -1, value, total) for tree, node, value, total in leaves]
    by_tree: dict[int, set[int]] = {}
    for tree, node in handed:
        by_tree.setdefault(tree, set()).add(node)
    shared = spark.sparkContext.broadcast((tops, by_tree))

    def as_batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), HANDED_TYPES, strict=True)], names=HANDED)

    def hand_over(batches):
        tops_, wanted = shared.value
        way = {tree: ways(nodes) for tree, nodes in wanted.items()}
        for ids, labels, bins, columns in together(batches, width):
            rows, marks, out = slim(bins, wide), labels.astype(np.uint8), []
            for tree, nodes in wanted.items():
                weight = occurrences(ids, tree, settings.seed) if settings.bootstrap else np.ones(len(ids))
                for node, run in rows_of(columns, np.flatnonzero(weight), tops_[tree], nodes, way[tree]):
                    out.append((tree, node, int(ids[0]), marks[run].tobytes(), weight[run].astype(np.uint8).tobytes(), rows.take(run, axis=0).tobytes()))
                if sum(len(o[-1]) for o in out) > HELD:
                    yield as_batch(out)
                    out = []
            if out:
                yield as_batch(out)

    def grow(table: pa.Table) -> pa.Table:
        tree, root = (table[c][0].as_py() for c in ("tree", "root"))
        # blocks may arrive in any order
        table = table.take(pa.array(np.argsort(table["block"].to_numpy(), kind="stable")))
        labels, weight, bins = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint8) for c in ("labels", "weights", "bins"))
        bins = full(bins.reshape(len(labels), -1), wide, width)
        nodes = grow_subtree(bins, labels.astype(float), weight.astype(float), settings, tree, root, depth_of(root))
        feature, cut, low, high, value, cover = (list(c) for c in zip(*nodes, strict=True))
        cuts = [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(feature, cut, strict=True)]
        n = len(nodes)
        columns = [[tree] * n, [root] * n, list(range(n)), feature, cuts, low, high, value, cover]
        return pa.table({f: pa.array(c, t) for f, c, t in zip(NAMES, columns, NODE_TYPES, strict=True)})

    given = packed.mapInArrow(hand_over, "tree int, root long, block long, labels binary, weights binary, bins binary")
    # a subtree is a task's work, so tasks should be as many as subtrees, up to what one job can usefully schedule
    subtrees = given.repartition(min(len(handed), 10_000) or 1, "tree", "root").groupBy("tree", "root").applyInArrow(grow, NODES)
    top = spark.createDataFrame(top_rows, NODES)
    out = store(assemble(subtrees.unionByName(top)), "trees")
    shared.unpersist()
    return out


NAMES = [c.split()[0] for c in NODES.split(", ")]
HANDED = ["tree", "root", "block", "labels", "weights", "bins"]
HANDED_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
NODE_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]


class DeepForest:
    """Estimator form of :func:`fit_forest` for the registry of models."""

    def __init__(self, per_task: int = 1 << 18, **settings):
        self.settings, self.per_task = ForestSettings(**settings), per_task

    def fit(self, rows: DataFrame) -> TreeEnsemble:
        return fit_forest(rows, self.settings, self.per_task)
