"""A fitted scorer as one expression: no joins, no ML stages, no Python, so it runs alike in batch, stream and SQL views.

Everything a row needs besides its own columns stands in literal arrays: level tables sorted by level, the points of a
calibration curve, the nodes of all trees.  They are found by binary search or by walking from node to node.  The
arrays are sent with the plan, so their size is checked: a scorer with more entries keeps its joins.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.operators.decide import Calibrator
from episodica.operators.encode import RARE, FittedEncoder, filled_text
from episodica.operators.isotonic import IsotonicCurve, line
from episodica.operators.linear import LinearModel
from episodica.operators.score import Scorer, decisions, in_range, to_feature_types
from episodica.operators.trees import KINDS, TreeEnsemble
from episodica.roles import FeatureSpec

# entries that the literal arrays of one expression may hold together
MOST = 1 << 20


class TooLarge(ValueError):
    """The scorer has more levels, points or nodes than may stand in an expression."""


class Budget:
    """Counts the entries of literal arrays; they are read only if they still fit."""

    def __init__(self, most: int):
        self.left = most

    def take(self, n: int, what: str) -> None:
        if n > self.left:
            raise TooLarge(f"{what}: {n} entries, {self.left} left")
        self.left -= n

    def rows(self, df: DataFrame, what: str) -> list:
        found = df.limit(self.left + 1).collect()
        self.take(len(found), what)
        return found


def literal(values, kind: str) -> Column:
    """An array literal.  As text it is one node of the plan, which the optimizer folds into the array."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def steps(n: int) -> Column:
    """Falling powers of two whose sum is n at least."""
    return F.array(*[F.lit(1 << k) for k in range(max(1, n.bit_length()) - 1, -1, -1)])


def count_up_to(xs: Column, n: int, x: Column) -> Column:
    """How many of the ``n`` rising entries of ``xs`` are at most ``x``, in log2(n) steps; NULL counts as below all."""
    return F.aggregate(
        steps(n), F.lit(0), lambda at, step: F.when((at + step <= n) & F.coalesce(F.get(xs, at + step - 1) <= x, F.lit(False)), at + step).otherwise(at)
    )


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def look_up(table: dict[str, float], x: Column, default: float) -> Column:
    """The number that belongs to a text, or the default."""
    if not table:
        return F.lit(default)
    # UTF-8 bytes order like code points
    names = sorted(table)
    keys, values = literal(names, "string"), literal([table[n] for n in names], "double")
    return bind(count_up_to(keys, len(names), x) - 1, lambda at: F.when(F.get(keys, at) == x, F.get(values, at)).otherwise(F.lit(default)))


def encoded(encoder: FittedEncoder, budget: Budget) -> tuple[dict[str, Column], list[Column]]:
    """The slots of the encoder's vector, in order: the same numbers as its joins and stages give.

    First come the columns that several slots use: the place of a row's level among the one-hot levels.
    """
    spec, places, slots = encoder.spec, {}, []
    for c in spec.numeric:
        median, mean, std = encoder.numeric[c]
        slots.append((F.coalesce(F.col(c).cast("double"), F.lit(median)) - mean) / std)
    for c in spec.binary:
        slots.append(F.coalesce(F.col(c).cast("int"), F.lit(encoder.modes.get(c, 0))).cast("double"))
    for c in spec.cat_low:
        kept = encoder.kept_levels(c)
        place = {level: float(i) for i, level in enumerate(kept) if level != RARE}
        if RARE in kept:
            rare = encoder.rare.where(F.col("feature") == c).select("level")
            place |= {r.level: float(len(kept) - 1) for r in budget.rows(rare, f"rare levels of {c}")}
            # a level that is called like the shared slot falls into it
            place.setdefault(RARE, float(len(kept) - 1))
        budget.take(len(kept), f"levels of {c}")
        places[f"_at__{c}"] = look_up(place, filled_text(c), -1.0)
        slots += [(F.col(f"_at__{c}") == float(i)).cast("double") for i in range(len(kept))]
    for c in spec.cat_high:
        means = budget.rows(encoder.table.where(F.col("feature") == c).select("level", "encoded"), f"levels of {c}")
        slots.append(look_up({r.level: r.encoded for r in means}, filled_text(c), encoder.default[c]))
    return places, slots


def tree_margin(model: TreeEnsemble, x: Column, budget: Budget) -> Column:
    """Sum of the leaves that ``x`` reaches.  All trees stand in one set of node arrays; a walk ends in a leaf, which points to itself."""
    nodes = {n: [] for n in KINDS}
    roots, deepest = [], 0
    count = model.table.agg(F.sum(F.octet_length("cut"))).first()[0] or 0
    budget.take(count // KINDS["cut"]().itemsize, "tree nodes")
    for r in sorted(model.table.collect(), key=lambda r: r.tree):
        tree = {n: np.frombuffer(r[n], k) for n, k in KINDS.items()}
        start, inner = len(nodes["cut"]), tree["feature"] >= 0
        own = np.arange(len(inner))
        roots.append(start)
        deepest = max(deepest, depth(tree))
        nodes["feature"] += np.where(inner, tree["feature"], 0).tolist()
        nodes["cut"] += tree["cut"].tolist()
        nodes["low"] += (np.where(inner, tree["low"], own) + start).tolist()
        nodes["high"] += (np.where(inner, tree["high"], own) + start).tolist()
        nodes["value"] += tree["value"].tolist()
    if not roots:
        return F.lit(0.0)
    feature, low, high = (literal(nodes[n], "int") for n in ("feature", "low", "high"))
    cut, value = literal(nodes["cut"], "double"), literal(nodes["value"], "double")

    def leaf(root: Column) -> Column:
        if not deepest:
            return root
        down = F.sequence(F.lit(1), F.lit(deepest))
        return F.aggregate(down, root, lambda at, _: F.when(F.get(x, F.get(feature, at)) <= F.get(cut, at), F.get(low, at)).otherwise(F.get(high, at)))

    return F.aggregate(literal(roots, "int"), F.lit(0.0), lambda total, root: total + F.get(value, leaf(root)))


def depth(tree: dict[str, np.ndarray]) -> int:
    """Steps from the root to the furthest leaf."""
    level, at = 0, np.zeros(1, np.int64)
    while True:
        at = at[tree["feature"][at] >= 0]
        if not len(at):
            return level
        at, level = np.concatenate([tree["low"][at], tree["high"][at]]), level + 1


def probability(model, x: Column, budget: Budget) -> Column:
    """A classifier's probability on the array ``x``."""
    if isinstance(model, LinearModel):
        budget.take(len(model.coefficients), "coefficients")
        return S.sigmoid(model.margin(x))
    if isinstance(model, TreeEnsemble):
        margin = F.lit(model.start) + F.lit(model.scale) * tree_margin(model, x, budget)
        return 1 / (1 + F.exp(-margin)) if model.logistic else margin
    raise TypeError(f"{type(model).__name__} has no expression")


def curve(model: IsotonicCurve, p: Column, budget: Budget) -> Column:
    """Straight lines between the curve's points, the end values beyond them; a curve without points gives NULL."""
    points = sorted((r.x, r.value) for r in budget.rows(model.points, "curve points"))
    if not points:
        return F.lit(None).cast("double")
    xs, ys = (literal([q[i] for q in points], "double") for i in (0, 1))
    # a place before the first point is no place: get() with -1 is NULL
    value = bind(count_up_to(xs, len(points), p), lambda at: line(p, F.get(xs, at - 1), F.get(ys, at - 1), F.get(xs, at), F.get(ys, at)))
    return F.when(p.isNotNull(), value)


def calibrated(calibrator: Calibrator, p: Column, budget: Budget) -> Column:
    if calibrator.method == "uncalibrated":
        return p
    if calibrator.method == "isotonic":
        return curve(calibrator.model, p, budget)
    return S.sigmoid(p * float(calibrator.model.coefficients[0]) + float(calibrator.model.intercept))


@dataclass
class CompiledScorer:
    """Encoder, model and calibrator as expressions.

    ``places`` and ``slots`` encode a row of features into the array ``_x``; ``raw`` is the probability on it, ``final`` the
    calibrated one on ``_p``.  Rows, not tables, go in: it is stateless and shuffles nothing, so a hot level, a NULL or
    an unseen level costs what any other row costs, and an empty table gives no rows.
    """

    spec: FeatureSpec
    places: dict[str, Column]
    slots: list[Column]
    raw: Column
    final: Column
    threshold: float
    ranges: dict

    def checked(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """As :meth:`Scorer.checked`: rows that may be scored, and those outside the ranges."""
        return in_range(df, {c: bounds for c, bounds in self.ranges.items() if c in df.columns})

    def probabilities(self, df: DataFrame) -> DataFrame:
        """``df`` with the calibrated probability ``p``; its feature columns must be there."""
        typed = to_feature_types(df, self.spec)
        kept = [c for c in df.columns if c not in ("_x", "_p", "p", *self.places)]
        vectors = typed.withColumns(self.places).withColumn("_x", F.array(*self.slots)).withColumn("_p", self.raw)
        return vectors.withColumn("p", self.final).select(*kept, "p")

    def score(self, df: DataFrame) -> DataFrame:
        """``(key, p, threshold, decision, risk_band)`` of the rows that pass :meth:`checked`."""
        return decisions(self.probabilities(self.checked(df)[0]).select(self.spec.key, "p"), self.threshold)


def compile_scorer(scorer: Scorer, most: int = MOST) -> CompiledScorer:
    """The scorer as expressions, or :class:`TooLarge` if its levels, curve points and nodes are more than ``most``.

    Linear models and tree ensembles can be compiled.  Tables are read one by one, each only as far as the bound, so
    the driver never holds more than ``most`` entries.
    """
    budget, trained = Budget(most), scorer.trained
    places, slots = encoded(trained.encoder, budget)
    raw = probability(trained.model.classifier, F.col("_x"), budget)
    return CompiledScorer(trained.encoder.spec, places, slots, raw, calibrated(scorer.calibrator, F.col("_p"), budget), scorer.threshold, scorer.ranges)
