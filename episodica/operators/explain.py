"""Attributions: exact for linear models, path-dependent Shapley values for tree models, local surrogates.

Row-wise Python runs only inside Arrow batches that Spark partitions (``mapInArrow``) or on small
fixed-size groups (``applyInPandas``); everything that summarises attributions is plain DataFrame work.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions import scalars as S
from episodica.functions.ordered import exact_quantiles, global_cumsum, null_safe_join, shuffle_rank
from episodica.operators.encode import filled_text
from episodica.operators.linear import as_array, matrix
from episodica.operators.trees import KINDS, TreeEnsemble
from episodica.sources.shared import shared_path, store


def vector_mean(df: DataFrame, features: str = "features") -> list[float]:
    return [float(v) for v in df.select(Summarizer.mean(F.col(features))).first()[0]]


def linear_attributions(df: DataFrame, model, names, background: list[float], key: str, features: str = "features"):
    """``(key, feature, value, phi)`` with phi = coefficient * (x - background mean), and the base margin."""
    weights = [float(c) for c in model.coefficients]
    base = float(model.intercept) + sum(w * m for w, m in zip(weights, background))
    params = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(w).alias("w"), F.lit(m).alias("m")) for n, w, m in zip(names, weights, background)])
    cells = F.transform(
        F.arrays_zip(vector_to_array(features).alias("x"), params.alias("p")),
        lambda c: F.struct(c["p"]["feature"].alias("feature"), c["x"].alias("value"), (c["p"]["w"] * (c["x"] - c["p"]["m"])).alias("phi")),
    )
    return df.select(key, F.inline(cells)), base


def tree_nodes(model) -> tuple[dict[int, pd.DataFrame], dict[int, float], bool]:
    """Node tables and weights of a saved tree ensemble: ``(nodes by tree, weight by tree, is_classification)``.

    The model is written to the shared folder and read back as tables; a model is parameters, not data.
    """
    spark = SparkSession.active()
    path = shared_path(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()
    meta = spark.read.parquet(f"{path}/treesMetadata")
    weights = {r[0]: float(r[2]) for r in meta.collect()}
    votes = type(model).__name__.startswith("RandomForestClassification")
    return {t: g.sort_values("id").reset_index(drop=True) for t, g in rows.groupby("treeID")}, weights, votes


def ensemble_nodes(model: TreeEnsemble) -> dict[int, pd.DataFrame]:
    """The node tables of our own ensembles, with the names of a saved ML ensemble."""
    out = {}
    for r in model.table.collect():
        t = {n: np.frombuffer(r[n], k) for n, k in KINDS.items()}
        splits = [{"featureIndex": int(f), "leftCategoriesOrThreshold": [float(c)]} for f, c in zip(t["feature"], t["cut"], strict=True)]
        out[r.tree] = pd.DataFrame({"id": np.arange(len(t["cut"])), "leftChild": t["low"], "rightChild": t["high"], "split": splits, "prediction": t["value"], "rawCount": t["cover"]})
    return out


def leaf_paths(nodes: pd.DataFrame, weight: float, votes: bool) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Every leaf as ``(value, conditions)``; a condition is (feature, low, high, share of the cover).

    The value lies in (low, high] of the feature.  Conditions on the same feature are merged, so the
    features of a path are distinct.
    """
    by_id = {int(r.id): r for r in nodes.itertuples()}
    out, todo = [], [(0, {})]
    while todo:
        at, path = todo.pop()
        node = by_id[at]
        if node.leftChild < 0:
            stats = np.asarray(node.impurityStats, dtype=float) if votes else None
            value = stats[1] / stats.sum() if votes else float(node.prediction)
            out.append((weight * value, [(f, *c) for f, c in path.items()]))
            continue
        split = node.split
        f, cut = int(split["featureIndex"]), float(split["leftCategoriesOrThreshold"][0])
        for child, low, high in ((int(node.leftChild), -math.inf, cut), (int(node.rightChild), cut, math.inf)):
            share = by_id[child].rawCount / node.rawCount
            lo, hi, sh = path.get(f, (-math.inf, math.inf, 1.0))
            todo.append((child, {**path, f: (max(lo, low), min(hi, high), sh * share)}))
    return out


def condition_values(inside: np.ndarray, value: float, conditions) -> np.ndarray:
    """Shapley value of each condition (columns) of a leaf, for rows that say which conditions are met."""
    d = len(conditions)
    cover = np.array([c[3] for c in conditions])
    order = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
    out = np.empty(inside.shape)
    for i in range(d):
        poly = np.zeros((len(inside), d))
        poly[:, 0] = 1.0
        size = 1
        for j in range(d):
            if j == i:
                continue
            shifted = poly[:, :size] * inside[:, [j]]
            poly[:, :size] *= cover[j]
            poly[:, 1 : size + 1] += shifted
            size += 1
        out[:, i] = value * (inside[:, i] - cover[i]) * (poly @ np.array(order))
    return out


def leaf_shapley(x: np.ndarray, value: float, conditions, phi: np.ndarray) -> float:
    """Add one leaf's Shapley values to ``phi`` (rows x features); returns the leaf's share of the base value.

    With a subset S of the path's features known, the leaf is worth value * prod(inside_f, f in S) *
    prod(cover_f, f not in S).  The average over all orders follows from the coefficients of
    prod(cover_j + inside_j * t) over the other features, weighted by k! (d-1-k)! / d!.
    """
    d = len(conditions)
    base = value * float(np.prod([c[3] for c in conditions])) if d else value
    if d == 0:
        return base
    met = [(x[:, f] > lo) & (x[:, f] <= hi) for f, lo, hi, _ in conditions]
    if 1 << d <= len(x):
        # rows differ only in which conditions they meet, so each way to meet them is worked out once
        way = np.zeros(len(x), np.int32)
        for i, m in enumerate(met):
            way += m.astype(np.int32) << i
        parts = condition_values(((np.arange(1 << d)[:, None] >> np.arange(d)) & 1).astype(float), value, conditions)
        for i, (f, *_rest) in enumerate(conditions):
            phi[:, f] += np.ascontiguousarray(parts[:, i]).take(way)
    else:
        parts = condition_values(np.stack(met, axis=1).astype(float), value, conditions)
        for i, (f, *_rest) in enumerate(conditions):
            phi[:, f] += parts[:, i]
    return base


def tree_attributions(df: DataFrame, model, names, key: str, features: str = "features"):
    """``(key, feature, value, phi)`` for a boosted or bagged tree classifier, and the base value.

    Boosted trees are explained on the log-odds, forests on the probability of the positive class.  The
    paths are broadcast once; rows stream through in Arrow batches.
    """
    spark, start = df.sparkSession, 0.0
    if isinstance(model, TreeEnsemble):
        start = model.start
        leaves = [leaf for table in ensemble_nodes(model).values() for leaf in leaf_paths(table, model.scale, False)]
    else:
        nodes, weights, votes = tree_nodes(model)
        scale = (lambda w: w / sum(weights.values())) if votes else (lambda w: 2.0 * w)
        leaves = [leaf for t, table in nodes.items() for leaf in leaf_paths(table, scale(weights[t]), votes)]
    base = start + float(sum(v * float(np.prod([c[3] for c in conds])) if conds else v for v, conds in leaves))
    shared = spark.sparkContext.broadcast((leaves, len(names)))

    def explain(batches):
        paths, width = shared.value
        for batch in batches:
            # column by column, as the leaves use them
            x = np.asfortranarray(matrix(batch.column(1), width))
            phi = np.zeros(x.shape, order="F")
            for value, conditions in paths:
                leaf_shapley(x, value, conditions, phi)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            lists = [pa.ListArray.from_arrays(ends, pa.array(cells.ravel())) for cells in (x, phi)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=[key, "_x", "_phi"])

    key_type = df.schema[key].dataType.simpleString()
    arrays = df.select(key, as_array(df, features).alias("_x")).mapInArrow(explain, f"{key} {key_type}, _x array<double>, _phi array<double>")
    # one row a feature is Spark's work: a row leaves Python as two arrays
    labels = F.array(*[F.lit(n) for n in names])
    return arrays.select(key, F.inline(F.arrays_zip(labels.alias("feature"), F.col("_x").alias("value"), F.col("_phi").alias("phi")))), base


def importance(phi: DataFrame) -> DataFrame:
    """Mean absolute and mean signed attribution per feature, ranked."""
    means = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"), F.avg("phi").alias("mean_signed"))
    return means.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("mean_abs"), "feature")))


def top_contributions(phi: DataFrame, key: str, n: int = 8) -> DataFrame:
    """The ``n`` largest attributions by size of each row; a row has one attribution per feature."""
    order = W.partitionBy(key).orderBy(F.desc(F.abs("phi")), "feature")
    return phi.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def implied_probability(phi: DataFrame, base: float, key: str) -> DataFrame:
    """Probability that the attributions of each row add up to."""
    return phi.groupBy(key).agg(F.sum("phi").alias("_s")).select(key, S.sigmoid(F.col("_s") + base).alias("p"))


def dependence_trend(phi: DataFrame, features=None, n_edges: int = 21, min_rows: int = 20) -> DataFrame:
    """Mean attribution per quantile bin of the feature value: ``(feature, low, high, mid, mean_phi, n)``.

    Bins are closed on both sides, so a value on an inner edge counts in both neighbours.  The rows are
    reduced to one per (feature, value) first, and each value picks its (at most two) bins from the
    short list of edges.
    """
    rows = phi if features is None else phi.where(F.col("feature").isin(list(features)))
    cells = rows.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("phi").alias("s"))
    probs = {f"e{i}": i / (n_edges - 1) for i in range(n_edges)}
    edges = exact_quantiles(cells, "value", probs, ["feature"], weight="n")
    edges = edges.select("feature", F.array_distinct(F.array(*[F.round(F.col(e), 12) for e in probs])).alias("_e"))
    v = F.round(F.col("value"), 12)
    pairs = F.filter(
        F.transform(F.sequence(F.lit(1), F.size("_e") - 1), lambda i: F.struct(F.get("_e", i - 1).alias("low"), F.get("_e", i).alias("high"))),
        lambda b: (v >= b["low"]) & (v <= b["high"]),
    )
    binned = null_safe_join(cells, edges.where(F.size("_e") > 1), ["feature"]).select("feature", "n", "s", F.inline(pairs))
    means = binned.groupBy("feature", "low", "high").agg((F.sum("s") / F.sum("n")).alias("mean_phi"), F.sum("n").alias("n"))
    return means.where(F.col("n") >= min_rows).withColumn("mid", (F.col("low") + F.col("high")) / 2)


def trend_and_caps(phi: DataFrame, caps=(0.05, 0.95), more_than: int = 10, least_span: float = 1e-6) -> DataFrame:
    """Value caps and dependence trend: ``(feature, low, high, bin_low, bin_high, mid, mean_phi, n)``, one row a bin.

    A feature's values are clipped to ``low`` and ``high``; if the quantiles are equal, ``high`` is ``least_span`` above ``low``.
    Features with at most ``more_than`` distinct values have no trend: one row without a bin.
    """
    found = exact_quantiles(phi, "value", {"low": caps[0], "high": caps[1]}, ["feature"])
    found = found.withColumn("high", F.when(F.col("high") <= F.col("low"), F.col("low") + least_span).otherwise(F.col("high")))
    many = phi.select("feature", "value").distinct().groupBy("feature").agg(F.count("value").alias("_v")).where(F.col("_v") > more_than)
    trend = dependence_trend(phi).withColumnsRenamed({"low": "bin_low", "high": "bin_high"}).join(many, "feature", "left_semi")
    return found.join(trend.select("feature", "bin_low", "bin_high", "mid", "mean_phi", "n"), "feature", "left")


def extreme_rows(df: DataFrame, score: str, key: str, n: int = 3) -> DataFrame:
    """The ``n`` highest and ``n`` lowest scored rows with ``risk_bucket`` and ``rank`` from 0."""
    high = df.orderBy(F.desc(score), key).limit(n).withColumn("risk_bucket", F.lit("high"))
    low = df.orderBy(F.asc(score), key).limit(n).withColumn("risk_bucket", F.lit("low"))
    order = W.partitionBy("risk_bucket").orderBy(F.when(F.col("risk_bucket") == "high", -F.col(score)).otherwise(F.col(score)), key)
    return high.unionByName(low).withColumn("rank", F.row_number().over(order) - 1)


def nth_extremes(df: DataFrame, score: str, key: str, n: int = 10) -> DataFrame:
    """The row with the n-th lowest and the row with the n-th highest score."""
    return extreme_rows(df, score, key, n).where(F.col("rank") == n - 1)


def label_encoding(df: DataFrame, columns, missing: str = "__missing__", seed: int = 42) -> DataFrame:
    """``(feature, level, code)``: codes 0.. per column, NULL as its own level.

    The order of the codes carries no meaning; it is the seeded md5 order, so that a column with very
    many levels is numbered in parallel.
    """
    cells = [F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias("level")) for c in columns]
    levels = store(df.select(F.inline(F.array(*cells))).distinct(), "levels")
    ranked = shuffle_rank(levels, "level", seed, ["feature"])
    return ranked.select("feature", "level", (F.col("shuffle_rank") - 1).alias("code"))


SHARE_CELLS = 1024


def _background(df: DataFrame, spec):
    """Quartiles of the numbers, and a table of the levels of the rest with the stretch of [0, 1) each one fills.

    ``levels`` has ``(f, cell, low, high, v)``: a level stands in every one of the 1,024 cells that its stretch
    touches, so that a drawn number finds its level by an equality join on the cell.
    """
    numbers = [*spec.numeric]
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("double").alias("v")) for c in numbers])))
    quartiles = {
        r.f: [r.a, r.b, r.c, r.lo, r.hi]
        for r in exact_quantiles(stacked, "v", {"a": 0.25, "b": 0.5, "c": 0.75, "lo": 0.0, "hi": 1.0}, ["f"]).collect()
    }
    texts = [*spec.binary, *spec.cat_low, *spec.cat_high]
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("f"), filled_text(c).alias("v")) for c in texts])))
    counts = store(cells.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")), "levels")
    # the order of the levels carries no meaning: the shuffled rank cuts them into ranges that are summed apart
    ranked = shuffle_rank(counts, "v", 42, ["f"]).drop("group_size")
    summed = null_safe_join(global_cumsum(ranked, "shuffle_rank", ["n"], ["f"]), counts.groupBy("f").agg(F.sum("n").alias("_all")), ["f"])
    low, high = (F.col("cum_n") - F.col("n")) / F.col("_all"), F.col("cum_n") / F.col("_all")
    touched = F.sequence(F.floor(low * SHARE_CELLS).cast("int"), F.least(F.floor(high * SHARE_CELLS), F.lit(SHARE_CELLS - 1)).cast("int"))
    levels = summed.select("f", F.explode(touched).alias("cell"), low.alias("low"), high.alias("high"), "v")
    return quartiles, store(levels, "level-shares")


def local_surrogate(
    df: DataFrame, trained, n_each: int = 3, n_samples: int = 1500, n_features: int = 10, seed: int = 42, background: DataFrame | None = None,
) -> DataFrame:
    """Local linear explanation of the most extreme scored rows: ``(risk_bucket, rank, score, feature, weight)``.

    Each chosen row is copied ``n_samples`` times; copies redraw each feature from all rows of the background
    (a quartile of a number, a level of a text by its share) by seeded hashing.  The copies are scored as one Spark job,
    and a kernel-weighted ridge regression on "same bin as the original" is solved per chosen row.
    """
    spec = trained.encoder.spec
    numbers, texts = list(spec.numeric), [*spec.binary, *spec.cat_low, *spec.cat_high]
    names = [*numbers, *texts]
    quartiles, levels = _background(background if background is not None else df, spec)
    scored = trained.transform(df).select(*dict.fromkeys([spec.key, *names]), "p")
    chosen = extreme_rows(scored, "p", spec.key, n_each).withColumnRenamed("p", "score")
    copies = store(chosen.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1)))), "copies")

    def unit(name: str, salt: str) -> Column:
        draw = F.xxhash64(F.lit(f"{name}|{salt}|{seed}"), F.col("risk_bucket"), F.col("rank"), F.col("_i"))
        return F.pmod(draw, F.lit(2**31 - 1)) / float(2**31 - 1)

    fields = {f.name: f.dataType for f in df.schema.fields}
    types = {c: fields[c] for c in names}
    keep = F.col("_i") == 0  # the first copy is the row itself
    drawn = {}
    for c in numbers:
        a, b, d, lo, hi = quartiles.get(c, [0.0, 0.0, 0.0, 0.0, 0.0])
        bounds = [lo, a, b, d, hi]
        x = F.col(c).cast("double")
        own = (x > a).cast("int") + (x > b).cast("int") + (x > d).cast("int")
        pick = F.floor(unit(c, "bin") * 4).cast("int")
        low = F.get(F.array(*[F.lit(float(v)) for v in bounds]), pick)
        high = F.get(F.array(*[F.lit(float(v)) for v in bounds]), pick + 1)
        value = low + unit(c, "at") * (high - low)
        if types[c].typeName() in ("integer", "long", "short", "byte"):
            value = F.round(value)
        new = F.when(keep, x).otherwise(value)
        fresh = (new > a).cast("int") + (new > b).cast("int") + (new > d).cast("int")
        drawn[c] = (new.cast(types[c]), F.coalesce((fresh == own).cast("double"), F.lit(1.0)))
    ids = ("risk_bucket", "rank", "_i")
    draws = copies.select(*ids, F.inline(F.array(*[F.struct(F.lit(c).alias("f"), unit(c, "level").alias("u")) for c in texts])))
    draws = draws.withColumn("cell", F.least(F.floor(F.col("u") * SHARE_CELLS), F.lit(SHARE_CELLS - 1)).cast("int"))
    hit = (F.col("u") >= F.col("low")) & ((F.col("u") < F.col("high")) | ((F.col("u") == 1) & (F.col("high") >= 1)))
    drawn_levels = draws.join(levels, ["f", "cell"]).where(hit).groupBy(*ids).agg(F.map_from_entries(F.collect_list(F.struct("f", "v"))).alias("_levels"))
    copies = copies.join(drawn_levels, list(ids))
    for c in texts:
        text = F.try_element_at("_levels", F.lit(c))
        new = F.when(keep, filled_text(c)).otherwise(text)
        drawn[c] = (new.try_cast(types[c]), (new == filled_text(c)).cast("double"))
    id_type = fields[spec.key]
    sampled = copies.select(
        F.concat_ws("|", "risk_bucket", "rank", "_i").alias(spec.key) if id_type.typeName() == "string"
        else F.pmod(F.xxhash64("risk_bucket", "rank", "_i"), F.lit(2**31 - 1)).cast(id_type).alias(spec.key),
        "risk_bucket", "rank", "score", "_i",
        *[v.alias(c) for c, (v, _) in drawn.items()],
        F.array(*[z for _, z in drawn.values()]).alias("_z"),
    )
    predicted = trained.transform(sampled).select("risk_bucket", "rank", "score", "_i", "_z", "p")
    width = 0.75 * math.sqrt(len(names))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_i")
        z, y = np.stack(group["_z"].to_numpy()), group["p"].to_numpy()
        weight = np.sqrt(np.exp(-((1 - z) ** 2).sum(axis=1) / width**2))
        mean_z, mean_y = np.average(z, axis=0, weights=weight), np.average(y, weights=weight)
        zc, yc = (z - mean_z) * np.sqrt(weight)[:, None], (y - mean_y) * np.sqrt(weight)
        top = np.argsort(-np.abs(_ridge(zc, yc)), kind="stable")[:n_features]
        final = _ridge(zc[:, top], yc)
        return pd.DataFrame(
            {
                "risk_bucket": group["risk_bucket"].iloc[0], "rank": int(group["rank"].iloc[0]), "score": float(group["score"].iloc[0]),
                "feature": [names[i] for i in top], "weight": final,
            }
        )

    # the groups have a fixed size: n_samples rows for each of the 2 * n_each chosen rows
    return predicted.groupBy("risk_bucket", "rank").applyInPandas(
        solve, "risk_bucket string, rank int, score double, feature string, weight double"
    )


def _ridge(x: np.ndarray, y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    return np.linalg.solve(x.T @ x + alpha * np.eye(x.shape[1]), x.T @ y)
