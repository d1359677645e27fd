"""Leaf-wise boosting on binned features: gradient histograms summed over all rows, the best leaf split first.

A pass over the rows sums count, gradient and curvature per (node, feature, bin) for one child of every pair that may
be wanted next; its sibling is the parent less that child.  Open nodes with few enough rows are handed over instead:
their rows go to a task each, which grows the subtree best leaf first as far as the whole tree could want it.  What
reaches the driver has the size of the model: nodes, or nodes times bins.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.operators.linear import as_array
from episodica.operators.trees import PACKED, TreeEnsemble, bin_edges, by_node, pack_rows, spread_bits
from episodica.sources.shared import store

# rows of a product of bins and gradients
PRODUCT = 1 << 14


@dataclass
class BoostSettings:
    rounds: int = 300
    rate: float = 0.05
    leaves: int = 63
    leaf: int = 50
    l2: float = 0.0
    least_curvature: float = 1e-3
    patience: int | None = 10
    tolerance: float = 1e-7
    held_out: float = 0.1
    refresh: int = 8
    per_task: int = 1 << 18
    seed: int = 42


@dataclass
class Node:
    """A node of the tree that grows: its histogram (count, gradient, curvature by slot) and its best split, if any."""

    sums: np.ndarray
    gain: float = 0.0
    feature: int = -1
    cut: int = 0
    children: tuple[int, int] | None = None
    totals: np.ndarray = field(default_factory=lambda: np.zeros(3))


def newton_split(node: Node, firsts: np.ndarray, settings: BoostSettings) -> None:
    """Find the cut of largest gain G_l^2 / H_l + G_r^2 / H_r - G^2 / H; ties go to the first feature and bin."""
    sizes = np.diff(firsts)
    node.totals = node.sums[:, : sizes[0]].sum(axis=1)
    running = np.cumsum(node.sums, axis=1)
    before = np.concatenate([np.zeros((3, 1)), running], axis=1)[:, firsts[:-1]]
    left = running - np.repeat(before, sizes, axis=1)
    right = node.totals[:, None] - left
    allowed = (np.minimum(left[0], right[0]) >= settings.leaf) & (np.minimum(left[2], right[2]) >= settings.least_curvature)
    allowed[firsts[1:] - 1] = False  # the last bin of a feature leaves nothing on the right
    if not allowed.any():
        return
    with np.errstate(divide="ignore", invalid="ignore"):
        worth = left[1] ** 2 / (left[2] + settings.l2) + right[1] ** 2 / (right[2] + settings.l2)
    gain = np.where(allowed, worth - node.totals[1] ** 2 / (node.totals[2] + settings.l2), -np.inf)
    best = int(gain.argmax())
    if gain[best] > 1e-10:
        node.gain, node.feature = float(gain[best]), int(np.searchsorted(firsts, best, "right")) - 1
        node.cut = best - int(firsts[node.feature])


def best_first(nodes: list[Node], leaves: int) -> tuple[list[int], list[int]]:
    """Split nodes in best-first order as far as histograms are known, and the leaves of that tree.

    It ends when the tree is complete or the next node's children are unknown.  Ties go to the node made first.
    """
    made, order, open_nodes = 1, [], [(-nodes[0].gain, 0, 0)] if nodes[0].feature >= 0 else []
    closed = [0] if not open_nodes else []
    while open_nodes and len(order) + 1 < leaves:
        _, _, at = open_nodes[0]
        if nodes[at].children is None:
            break
        heapq.heappop(open_nodes)
        order.append(at)
        for child in nodes[at].children:
            if nodes[child].feature >= 0:
                heapq.heappush(open_nodes, (-nodes[child].gain, made, child))
            else:
                closed.append(child)
            made += 1
    return order, closed + [at for _, _, at in open_nodes]


def place_rows(bins: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    """The deepest node that each row reaches."""
    at, todo = np.zeros(len(bins), np.int32), np.arange(len(bins) if tree["feature"][0] >= 0 else 0)
    while len(todo):
        node = at[todo]
        at[todo] = np.where(bins[todo, tree["feature"][node]] <= tree["cut"][node], tree["low"][node], tree["high"][node])
        todo = todo[tree["feature"][at[todo]] >= 0]
    return at


def as_arrays(nodes: list[Node], split: set[int] | None = None) -> dict[str, np.ndarray]:
    """Nodes as arrays; those that are not split, or not in ``split``, count as leaves."""
    inner = [n.children is not None and (split is None or i in split) for i, n in enumerate(nodes)]
    return {
        "feature": np.array([n.feature if s else -1 for n, s in zip(nodes, inner, strict=True)], np.int32),
        "cut": np.array([n.cut for n in nodes], np.int32),
        "low": np.array([n.children[0] if s else -1 for n, s in zip(nodes, inner, strict=True)], np.int32),
        "high": np.array([n.children[1] if s else -1 for n, s in zip(nodes, inner, strict=True)], np.int32),
    }


def read_block(batch: pa.RecordBatch, r: int, recent, width: int, start: float, seed: int, held_out: float):
    """Labels, bins, margins and whether the row is held out, of one block."""
    labels = np.frombuffer(batch.column("labels")[r].as_buffer(), np.float64)
    bins = np.frombuffer(batch.column("bins")[r].as_buffer(), np.uint8).reshape(len(labels), width)
    margin = np.frombuffer(batch.column("margins")[r].as_buffer(), np.float64) + start
    for tree in recent:
        margin = margin + tree["value"][place_rows(bins, tree)]
    ids = np.frombuffer(batch.column("ids")[r].as_buffer(), np.uint64)
    unit = (spread_bits(ids ^ np.uint64(seed * 0x9E3779B9)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return labels, bins, margin, unit < held_out


class Rows:
    """The binned rows in the shared folder with their margins, and the trees that came after those were stored."""

    def __init__(self, packed: DataFrame, firsts: np.ndarray, start: float, settings: BoostSettings):
        self.firsts, self.settings, self.start, self.recent = firsts, settings, start, []
        zero = F.expr("repeat(x'00', cast(octet_length(labels) as int))").cast("binary")
        self.table = packed.withColumn("margins", zero)

    def reader(self):
        """:func:`read_block` for the rows as they are now; tasks get parameters only."""
        share = self.settings.held_out if self.settings.patience else 0.0
        return partial(read_block, recent=list(self.recent), width=len(self.firsts) - 1, start=self.start, seed=self.settings.seed, held_out=share)

    def sums(self, nodes: list[Node], wanted: list[int]) -> tuple[dict[int, np.ndarray], float, float]:
        """Histograms of the wanted nodes over the rows that are learned from, and mean loss and count of the others."""
        firsts, slots = self.firsts, int(self.firsts[-1])
        tree, block = as_arrays(nodes), self.reader()
        places = np.full(len(nodes), -1)
        places[wanted] = np.arange(len(wanted))

        def run(batches):
            held, total = np.zeros((len(wanted), 3, slots)), np.zeros(2)
            for batch in batches:
                for r in range(batch.num_rows):
                    labels, bins, margin, out = block(batch, r)
                    total += [np.logaddexp(0, margin[out]).sum() - (labels[out] * margin[out]).sum(), out.sum()]
                    place = places[place_rows(bins, tree)]
                    for at, rows in by_node(place, np.flatnonzero((place >= 0) & ~out)):
                        p = 1 / (1 + np.exp(-margin[rows]))
                        held[at] += histogram(bins[rows], p - labels[rows], p * (1 - p), firsts)
            held = held.transpose(1, 0, 2).reshape(3, -1)
            slot = np.flatnonzero(held[0])
            node = np.append(slot // slots, -1).astype(np.int32)
            values = [np.append(held[k][slot], total[k] if k < 2 else 0.0) for k in range(3)]
            columns = [pa.array(node), pa.array(np.append(slot % slots, -1).astype(np.int32)), *map(pa.array, values)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "slot", "n", "g", "h"])

        found = self.table.mapInArrow(run, "node int, slot int, n double, g double, h double")
        found = found.groupBy("node", "slot").agg(*[F.sum(c).alias(c) for c in "ngh"]).toPandas()
        out, loss, count = {at: np.zeros((3, slots)) for at in wanted}, 0.0, 0.0
        for node, part in found.groupby("node"):
            if node < 0:
                loss, count = float(part["n"].iloc[0]), float(part["g"].iloc[0])
            else:
                out[wanted[node]][:, part["slot"].to_numpy()] = part[["n", "g", "h"]].to_numpy().T
        return out, loss / max(count, 1.0), count

    def subtrees(self, nodes: list[Node], wanted: list[int]) -> tuple[dict[int, list[Node]], float, float]:
        """What grows below the wanted nodes, each from its own rows in one task; mean loss and count of held-out rows."""
        firsts, settings, tree, block, width = self.firsts, self.settings, as_arrays(nodes), self.reader(), len(self.firsts) - 1
        places = np.zeros(len(nodes), bool)
        places[wanted] = True

        def run(batches):
            total = np.zeros(2)
            for batch in batches:
                for r in range(batch.num_rows):
                    labels, bins, margin, out = block(batch, r)
                    total += [np.logaddexp(0, margin[out]).sum() - (labels[out] * margin[out]).sum(), out.sum()]
                    at = place_rows(bins, tree)
                    rows = np.flatnonzero(places[at] & ~out)
                    rows = rows[np.argsort(at[rows], kind="stable")]
                    name = int(np.frombuffer(batch.column("ids")[r].as_buffer(), np.int64)[0])
                    for part in np.split(rows, np.flatnonzero(np.diff(at[rows])) + 1):
                        if len(part):
                            p = 1 / (1 + np.exp(-margin[part]))
                            yield as_batch(int(at[part[0]]), name, bins[part], p - labels[part], p * (1 - p))
            yield as_batch(-1, 0, np.zeros(0, np.uint8), total[:1], total[1:])

        def grow(table: pa.Table) -> pa.Table:
            node = table["node"][0].as_py()
            # blocks may arrive in any order
            table = table.take(pa.array(np.argsort(table["block"].to_numpy(), kind="stable")))
            bins, g, h = (np.frombuffer(b"".join(table[c].to_pylist()), k) for c, k in (("bins", np.uint8), ("g", np.float64), ("h", np.float64)))
            made = [Node(np.zeros((3, 0)), totals=np.array([0.0, g.sum(), h.sum()]))] if node < 0 else grow_below(bins.reshape(-1, width), g, h, firsts, settings)
            low, high = ([n.children[k] if n.children else -1 for n in made] for k in (0, 1))
            totals = np.array([n.totals for n in made])
            columns = [[node] * len(made), range(len(made)), [n.gain for n in made], [n.feature for n in made], [n.cut for n in made], low, high, *totals.T]
            return pa.table({f.name: pa.array(list(c), f.type) for f, c in zip(GROWN, columns, strict=True)})

        found = self.table.mapInArrow(run, "node int, block long, bins binary, g binary, h binary")
        found = found.repartition(len(wanted) + 1, "node").groupBy("node").applyInArrow(grow, ", ".join(f"{f.name} {KIND[f.type]}" for f in GROWN)).toPandas()
        out, loss, count = {at: [] for at in wanted}, 0.0, 0.0
        for node, part in found.sort_values("at").groupby("node"):
            if node < 0:
                loss, count = float(part["g"].iloc[0]), float(part["h"].iloc[0])
                continue
            for r in part.itertuples():
                children = (r.low, r.high) if r.low >= 0 else None
                out[node].append(Node(np.zeros((3, 0)), r.gain, r.feature, r.cut, children, np.array([r.n, r.g, r.h])))
        return out, loss / max(count, 1.0), count

    def add(self, tree: dict[str, np.ndarray]) -> None:
        """A finished tree; the margins are written anew after ``refresh`` trees."""
        self.recent.append(tree)
        if len(self.recent) < self.settings.refresh:
            return
        block, start = self.reader(), self.start

        def run(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    margin = block(batch, r)[2] - start
                    cells = [batch.column(c)[r].as_py() for c in ("ids", "labels", "bins")]
                    yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in (*cells, margin.tobytes())], names=["ids", "labels", "bins", "margins"])

        self.table, self.recent = store(self.table.mapInArrow(run, "ids binary, labels binary, bins binary, margins binary"), "margins"), []


def as_batch(node: int, block: int, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([node], pa.int32()), pa.array([block], pa.int64()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (bins, g, h)]]
    return pa.RecordBatch.from_arrays(cells, names=["node", "block", "bins", "g", "h"])


KIND = {pa.int32(): "int", pa.float64(): "double"}
GROWN = [pa.field(n, t) for t, names in ((pa.int32(), ("node", "at")), (pa.float64(), ("gain",)), (pa.int32(), ("feature", "cut", "low", "high")), (pa.float64(), "ngh")) for n in names]


def histogram(bins: np.ndarray, g: np.ndarray, h: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Count, gradient and curvature by slot; features with two bins need one product with the three only."""
    marks, sizes = np.stack([np.ones(len(g)), g, h]), np.diff(firsts)
    out, totals = np.zeros((3, int(firsts[-1]))), marks.sum(axis=1)
    two, more = np.flatnonzero(sizes == 2), np.flatnonzero(sizes != 2)
    at = 0
    for some in np.array_split(np.arange(len(g)), len(g) // PRODUCT + 1):
        run, at = slice(at, at + len(some)), at + len(some)
        out[:, firsts[two] + 1] += np.ascontiguousarray(marks[:, run]) @ bins[run].take(two, axis=1).astype(np.float64)
    out[:, firsts[two]] = totals[:, None] - out[:, firsts[two] + 1]
    for f in more:
        begin, end = int(firsts[f]), int(firsts[f + 1])
        own = bins[:, f].astype(np.intp)
        out[:, begin:end] = [np.bincount(own, v, end - begin) for v in (None, g, h)]
    return out


def grow_below(bins: np.ndarray, g: np.ndarray, h: np.ndarray, firsts: np.ndarray, settings: BoostSettings) -> list[Node]:
    """Best leaf first below one node, from all of its rows, until it has as many leaves as a whole tree may have."""
    nodes, rows = [Node(histogram(bins, g, h, firsts))], [np.arange(len(g))]
    newton_split(nodes[0], firsts, settings)
    while True:
        order, leaves = best_first(nodes, settings.leaves)
        open_nodes = [at for at in leaves if nodes[at].feature >= 0] if len(order) + 1 < settings.leaves else []
        if not open_nodes:
            return nodes
        at = max(open_nodes, key=lambda i: (nodes[i].gain, -i))
        parent, mine = nodes[at], rows[at]
        is_low = bins[mine, parent.feature] <= parent.cut
        sides = [mine[is_low], mine[~is_low]]
        few = int(len(sides[1]) < len(sides[0]))
        smaller = histogram(bins[sides[few]], g[sides[few]], h[sides[few]], firsts)
        sums = [smaller, parent.sums - smaller] if few == 0 else [parent.sums - smaller, smaller]
        parent.children, parent.sums = (len(nodes), len(nodes) + 1), np.zeros((3, 0))
        nodes += [Node(s) for s in sums]
        rows += sides
        for child in parent.children:
            newton_split(nodes[child], firsts, settings)


def grow_tree(rows: Rows, settings: BoostSettings, n_rows: int) -> tuple[list[Node], list[int], list[int], float, float]:
    """One tree: its nodes, the split ones in order, the leaves, and the loss of the held-out rows before it.

    A pass asks for the children of all nodes that are open, at most as many as splits are left, by gain: those that
    the best-first order turns to next are among them.  Nodes of up to ``per_task`` rows get their whole subtree at once.
    """
    nodes = [Node(np.zeros((3, 0)))]
    if n_rows <= settings.per_task:
        below, loss, count = rows.subtrees(nodes, [0])
        nodes = below[0] or nodes
    else:
        first, loss, count = rows.sums(nodes, [0])
        nodes = [Node(first[0])]
        newton_split(nodes[0], rows.firsts, settings)
    while True:
        order, leaves = best_first(nodes, settings.leaves)
        unknown = sorted((at for at in leaves if nodes[at].feature >= 0 and nodes[at].children is None), key=lambda at: -nodes[at].gain)
        unknown = unknown[: settings.leaves - 1 - len(order)]
        if not unknown:
            return nodes, order, leaves, loss, count
        handed = [at for at in unknown if nodes[at].totals[0] <= settings.per_task]
        if handed:
            below, *_ = rows.subtrees(nodes, handed)
            for at, made in below.items():
                # the first of a subtree is the node itself
                offset = len(nodes) - 1
                for n in made:
                    n.children = (n.children[0] + offset, n.children[1] + offset) if n.children else None
                nodes[at].children = made[0].children
                nodes += made[1:]
        large, wanted = [at for at in unknown if at not in set(handed)], []
        for at in large:
            parent = nodes[at]
            begin = rows.firsts[parent.feature]
            low_count = parent.sums[0, begin : begin + parent.cut + 1].sum()
            low, high = len(nodes), len(nodes) + 1
            parent.children = (low, high)
            nodes += [Node(np.zeros((3, 0))), Node(np.zeros((3, 0)))]
            wanted.append(low if 2 * low_count <= parent.totals[0] else high)
        found = rows.sums(nodes, wanted)[0] if wanted else {}
        for at, smaller in zip(large, wanted, strict=True):
            low, high = nodes[at].children
            other = high if smaller == low else low
            nodes[smaller].sums = found[smaller]
            nodes[other].sums = nodes[at].sums - found[smaller]
            for child in (low, high):
                newton_split(nodes[child], rows.firsts, settings)


def fit_boosting(rows: DataFrame, settings: BoostSettings = BoostSettings()) -> TreeEnsemble:
    """Boosted trees for log loss on ``features`` (vector or array) and ``label`` (0 or 1).

    Each round grows one tree, best leaf first, to ``leaves`` leaves of ``leaf`` rows or more, by Newton gain over up to 255
    bins a feature; leaves are worth -``rate`` G / H.  A share ``held_out`` of the rows, chosen by a hash, decides when to
    stop: after ``patience`` rounds without a lower loss (None: never), and the trees up to the best round stay.

    Rows with a NULL label or features are left out; without rows, or with one class, there are no trees and the
    score is the share of positives (0 without rows).
    """
    spark = rows.sparkSession
    rows = store(rows.select(as_array(rows, "features").alias("features"), "label").where("features is not null and label is not null"), "tree-rows")
    n, positive, width = rows.agg(F.count(F.lit(1)), F.sum("label"), F.max(F.size("features"))).first()
    none = spark.createDataFrame([], PACKED)
    if not n or positive in (0, n):
        return TreeEnsemble(none, 1.0, 0.0 if not n else float(positive / n))
    edges = bin_edges(rows, width)
    firsts = np.append(0, np.cumsum([len(e) + 1 for e in edges]))
    start = float(np.log(positive / (n - positive)))
    held, trees, losses = Rows(pack_rows(rows, edges), firsts, start, settings), [], []
    for _ in range(settings.rounds):
        nodes, order, leaves, loss, count = grow_tree(held, settings, n)
        if settings.patience and count:
            losses.append(loss)
            best = int(np.argmin(np.array(losses) - settings.tolerance * np.arange(len(losses), 0, -1)))
            if len(losses) - 1 - best >= settings.patience:
                trees = trees[:best]
                break
        if not order:
            break
        tree = as_arrays(nodes, set(order))
        value = np.zeros(len(nodes))
        for at in leaves:
            value[at] = -settings.rate * nodes[at].totals[1] / (nodes[at].totals[2] + settings.l2)
        tree |= {"value": value, "cover": np.array([n_.totals[0] for n_ in nodes])}
        held.add(tree)
        trees.append(tree)
    table = [(t, *cells) for t, cells in enumerate(map(lambda tree: packed_tree(tree, edges), trees))]
    return TreeEnsemble(store(spark.createDataFrame(table, PACKED), "boosted"), 1.0, start, True)


def packed_tree(tree: dict[str, np.ndarray], edges: list[np.ndarray]) -> tuple[bytes, ...]:
    """The reachable nodes of a tree as the bytes of a :class:`TreeEnsemble`'s row; cuts become feature values."""
    reached, todo = [], [0]
    while todo:
        at = todo.pop()
        reached.append(at)
        if tree["feature"][at] >= 0:
            todo += [int(tree["high"][at]), int(tree["low"][at])]
    new = np.full(len(tree["feature"]) + 1, -1, np.int32)
    new[reached] = np.arange(len(reached))
    feature = tree["feature"][reached]
    cut = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(feature, tree["cut"][reached], strict=True)], np.float64)
    low, high = new[tree["low"][reached]], new[tree["high"][reached]]
    return tuple(x.tobytes() for x in (feature, cut, low, high, tree["value"][reached], tree["cover"][reached].astype(np.float64)))


class LeafwiseBoosting:
    """Estimator form of :func:`fit_boosting` for the registry of models."""

    def __init__(self, **settings):
        self.settings = BoostSettings(**settings)

    def fit(self, rows: DataFrame) -> TreeEnsemble:
        return fit_boosting(rows, self.settings)
