"""Feature encoding fitted on training rows only.

Numbers: median impute and population-standardise.  Flags: most frequent value.  Low-cardinality text:
one-hot with a shared column for rare levels.  High-cardinality text: smoothed target mean, cross-fitted
on the training rows.  All statistics are aggregates; the level tables of the target encoder stay
distributed and meet the rows through a join that spreads frequent levels.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions.joins import key_counts, salted_join
from episodica.functions.ordered import exact_quantiles, null_safe_join, shuffle_hash
from episodica.roles import FeatureSpec, require_columns
from episodica.sources.shared import store

# Fill text, rarity limit of one-hot levels, folds of the target encoder.
MISSING = "UNKNOWN"
MIN_FREQUENCY = 20
TARGET_FOLDS = 5
RARE = "__infrequent__"


def _long(df: DataFrame, columns, value, *keep) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("feature"), value(c).alias("level")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


def filled_text(column: str) -> Column:
    """Categorical value as text; numbers are cast, NULL becomes the fill text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def numeric_stats(train: DataFrame, columns) -> DataFrame:
    """``(feature, median, mean, std)``: exact median, then mean and population deviation after imputing.

    Works on (feature, value) counts, so imputing only shifts the weight of the median value.
    """
    long = _long(train, columns, lambda c: F.col(c).cast("double"))
    counts = store(long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n")), "numeric-counts")
    medians = exact_quantiles(counts, "level", {"median": 0.5}, ["feature"], weight="n")
    filled = null_safe_join(counts, medians, ["feature"], "left").withColumn("x", F.coalesce("level", "median", F.lit(0.0)))
    n, x = F.col("n"), F.col("x")
    means = filled.groupBy("feature").agg(F.first("median", True).alias("median"), (F.sum(n * x) / F.sum(n)).alias("mean"))
    centred = null_safe_join(filled.select("feature", "n", "x"), means, ["feature"])
    spread = F.sqrt(F.sum(n * (x - F.col("mean")) * (x - F.col("mean"))) / F.sum(n))
    stats = centred.groupBy("feature", "median", "mean").agg(spread.alias("std"))
    return stats.withColumn("std", F.when(F.col("std") > 0, F.col("std")).otherwise(1.0))


def flag_modes(train: DataFrame, columns) -> DataFrame:
    """``(feature, mode)``: most frequent value of each flag; the smaller one wins a tie."""
    long = _long(train, columns, lambda c: F.col(c).cast("int")).where(F.col("level").isNotNull())
    counts = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(F.max_by("level", F.struct(F.col("n"), -F.col("level"))).alias("mode"))


def level_counts(train: DataFrame, columns, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """``(feature, level, n, rare)`` of the filled text values."""
    counts = _long(train, columns, filled_text).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rare", F.col("n") < min_frequency)


def target_fold(key: str, k: int = TARGET_FOLDS, seed=42) -> Column:
    """Fold 0..k-1 of a row, from the md5 of its key."""
    return F.pmod(F.conv(F.substring(shuffle_hash(key, seed), 1, 8), 16, 10).cast("bigint"), F.lit(k)).cast("int")


def _smoothed(n: Column, s: Column, total_n: Column, total_s: Column) -> Column:
    """Empirical-Bayes mean of a level: shrunk to the overall mean by the ratio of the variances."""
    overall = F.try_divide(total_s, total_n)
    mean = F.try_divide(s, n)
    prior = overall * (1 - overall)
    weight = F.try_divide(n * prior, n * prior + mean * (1 - mean))
    return F.when((n > 0) & (prior > 0), weight * mean + (1 - weight) * overall).otherwise(overall)


def target_table(train: DataFrame, columns, label: str) -> DataFrame:
    """``(feature, level, n, encoded, overall)`` fitted on all training rows."""
    sums = _long(train, columns, filled_text, F.col(label).alias("_y")).groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").cast("double").alias("_s")
    )
    totals = sums.groupBy("feature").agg(F.sum("n").alias("_tn"), F.sum("_s").alias("_ts"))
    joined = null_safe_join(sums, totals, ["feature"])
    encoded = _smoothed(F.col("n").cast("double"), F.col("_s"), F.col("_tn").cast("double"), F.col("_ts"))
    return joined.select("feature", "level", "n", encoded.alias("encoded"), (F.col("_ts") / F.col("_tn")).alias("overall"))


def cross_target_table(train: DataFrame, columns, label: str, fold: str) -> DataFrame:
    """``(feature, level, fold, encoded)``: what rows of a fold get from the rows of the other folds."""
    long = _long(train, columns, filled_text, F.col(label).alias("_y"), F.col(fold).alias("fold"))
    cells = long.groupBy("feature", "level", "fold").agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").cast("double").alias("_s"))
    by_level = cells.groupBy("feature", "level").agg(F.sum("_n").alias("_ln"), F.sum("_s").alias("_ls"))
    by_fold = cells.groupBy("feature", "fold").agg(F.sum("_n").alias("_fn"), F.sum("_s").alias("_fs"))
    totals = cells.groupBy("feature").agg(F.sum("_n").alias("_tn"), F.sum("_s").alias("_ts"))
    joined = null_safe_join(null_safe_join(null_safe_join(cells, by_level, ["feature", "level"]), by_fold, ["feature", "fold"]), totals, ["feature"])
    n, s = (F.col("_ln") - F.col("_n")).cast("double"), F.col("_ls") - F.col("_s")
    encoded = _smoothed(n, s, (F.col("_tn") - F.col("_fn")).cast("double"), F.col("_ts") - F.col("_fs"))
    return joined.select("feature", "level", "fold", encoded.alias("encoded"))


def ordered_target(train: DataFrame, columns, label: str, key: str, weight: float = 1.0, seed=42) -> DataFrame:
    """``(key, feature, level, n_before, encoded)``: the smoothed label mean of a level over the rows before each row.

    Rows stand in seeded md5 order of the unique ``key``, the same for all columns.  A row's own label never enters its
    code, nor do those behind it: (sum before + ``weight`` * overall mean) / (rows before + ``weight``).  Sums run inside
    cells of a hash prefix, which are equally full; cells start from the sums of the earlier ones, so a level with most
    of the rows is spread over all cells.  NULL is a level like others; rows with a NULL label get a code and add nothing.
    """
    cells_wanted = 16 * int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prefix = max(1, math.ceil(math.log2(cells_wanted) / 4))
    hashed = shuffle_hash(key, seed)
    keep = [F.col(key), F.col(label).cast("double").alias("_y"), hashed.alias("_hash"), F.substring(hashed, 1, prefix).alias("_cell")]
    long = _long(train, columns, filled_text, *keep)
    cell = ["feature", "level", "_cell"]
    counted, summed = F.count("_y"), F.coalesce(F.sum("_y"), F.lit(0.0))
    sums = store(long.groupBy(*cell).agg(counted.alias("_n"), summed.alias("_s")), "level-cells")
    earlier = W.partitionBy("feature", "level").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*cell, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_n", "_s")])
    inside = W.partitionBy(*cell).orderBy("_hash", key).rowsBetween(W.unboundedPreceding, -1)
    n = F.col("_n_before") + F.count("_y").over(inside)
    total = F.col("_s_before") + F.coalesce(F.sum("_y").over(inside), F.lit(0.0))
    overall = train.select(F.coalesce(F.avg(F.col(label).cast("double")), F.lit(0.0))).scalar()
    placed = long.join(offsets, cell).select(key, "feature", "level", n.alias("n_before"), total.alias("_total"))
    return placed.select(key, "feature", "level", "n_before", ((F.col("_total") + weight * overall) / (F.col("n_before") + weight)).alias("encoded"))


def level_target(train: DataFrame, columns, label: str, weight: float = 1.0) -> DataFrame:
    """``(feature, level, n, encoded)`` for rows that the codes were not made on: the same mean over all rows of a level."""
    long = _long(train, columns, filled_text, F.col(label).cast("double").alias("_y"))
    overall = train.select(F.coalesce(F.avg(F.col(label).cast("double")), F.lit(0.0))).scalar()
    sums = long.groupBy("feature", "level").agg(F.count("_y").alias("n"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("_s"))
    return sums.select("feature", "level", "n", ((F.col("_s") + weight * overall) / (F.col("n") + weight)).alias("encoded"))


def apply_target(df: DataFrame, table: DataFrame, columns, default: dict[str, float], key: str, fold: str | None = None) -> DataFrame:
    """Add ``cat_high__<column>``; levels that the table does not hold get the default."""
    out = df
    for c in columns:
        side = table.where(F.col("feature") == c).select(
            F.col("level").alias("_level"), *([F.col("fold").alias("_fold")] if fold else []), F.col("encoded").alias("_enc")
        )
        keys = ["_level", *(["_fold"] if fold else [])]
        facts = out.withColumn("_level", filled_text(c))
        if fold:
            facts = facts.withColumn("_fold", F.col(fold))
        counted = df.select(key, filled_text(c).alias("_level"), *([F.col(fold).alias("_fold")] if fold else []))
        joined = salted_join(facts, side, keys, "left", key, key_counts(counted, keys))
        out = joined.withColumn(f"cat_high__{c}", F.coalesce("_enc", F.lit(default[c]))).drop("_enc", *keys)
    return out


class FittedEncoder:
    """The statistics of one training set, and the columns and ML stages that follow from them."""

    def __init__(self, spec: FeatureSpec, numeric: dict, modes: dict, levels: dict, rare: DataFrame | None, default: dict, table: DataFrame, train_table):
        self.spec, self.numeric, self.modes, self.levels, self.rare = spec, numeric, modes, levels, rare
        self.default, self.table, self.train_table = default, table, train_table

    def _numbers_and_flags(self, df: DataFrame) -> DataFrame:
        columns = {}
        for c in self.spec.numeric:
            median, mean, std = self.numeric[c]
            columns[f"num__{c}"] = (F.coalesce(F.col(c).cast("double"), F.lit(median)) - mean) / std
        for c in self.spec.binary:
            columns[f"bin__{c}"] = F.coalesce(F.col(c).cast("int"), F.lit(self.modes.get(c, 0))).cast("double")
        for c in self.spec.cat_low:
            columns[f"cat_low__{c}"] = filled_text(c)
        out = df.withColumns(columns)
        # rare levels may be many: they stay a table
        for c in self.spec.cat_low:
            if RARE in self.levels[c]:
                name = f"cat_low__{c}"
                rare = self.rare.where(F.col("feature") == c).select(F.col("level").alias(name), F.lit(True).alias("_rare"))
                out = out.join(rare, name, "left").withColumn(name, F.when(F.col("_rare"), RARE).otherwise(F.col(name))).drop("_rare")
        return out

    def prepare(self, df: DataFrame) -> DataFrame:
        """Encoded columns for rows the encoder was not fitted on."""
        require_columns(df, self.spec.features())
        return apply_target(self._numbers_and_flags(df), self.table, self.spec.cat_high, self.default, self.spec.key)

    def prepare_train(self, df: DataFrame) -> DataFrame:
        """Encoded columns for the training rows: target means come from the other folds."""
        require_columns(df, self.spec.features())
        folded = self._numbers_and_flags(df).withColumn("_tfold", target_fold(self.spec.key))
        return apply_target(folded, self.train_table, self.spec.cat_high, self.default, self.spec.key, "_tfold").drop("_tfold")

    def kept_levels(self, c: str) -> list[str]:
        """One-hot levels by name, the shared one of the rare levels last."""
        return self.levels[c]

    def stages(self, spark) -> list:
        """ML stages from the prepared columns to the vector ``features``.  Unseen levels become all zeros."""
        low = list(self.spec.cat_low)
        stages, inputs = [], []
        if low:
            for c in low:
                stages.append(
                    StringIndexerModel.from_labels(self.kept_levels(c), inputCol=f"cat_low__{c}", outputCol=f"_ix__{c}", handleInvalid="keep")
                )
            stages.append(OneHotEncoder(inputCols=[f"_ix__{c}" for c in low], outputCols=[f"_oh__{c}" for c in low], dropLast=True))
            inputs = [f"_oh__{c}" for c in low]
        numbers = [*[f"num__{c}" for c in self.spec.numeric], *[f"bin__{c}" for c in self.spec.binary]]
        high = [f"cat_high__{c}" for c in self.spec.cat_high]
        stages.append(VectorAssembler(inputCols=[*numbers, *inputs, *high], outputCol="features"))
        return stages

    def feature_names(self) -> list[str]:
        """Names of the vector's slots, in order."""
        return [
            *[f"num__{c}" for c in self.spec.numeric],
            *[f"bin__{c}" for c in self.spec.binary],
            *[f"cat_low__{c}_{level}" for c in self.spec.cat_low for level in self.kept_levels(c)],
            *[f"cat_high__{c}" for c in self.spec.cat_high],
        ]

    def save(self, spark, path: str) -> None:
        """Parquet tables: parameters (one row per feature and kept level), target means and rare levels."""
        rows = [("numeric", c, None, *map(float, v)) for c, v in self.numeric.items()]
        rows += [("mode", c, None, float(v), None, None) for c, v in self.modes.items()]
        rows += [("level", c, level, None, None, None) for c, kept in self.levels.items() for level in kept]
        rows += [("default", c, None, float(v), None, None) for c, v in self.default.items()]
        schema = "kind string, feature string, level string, a double, b double, c double"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/parameters")
        self.table.write.mode("overwrite").parquet(f"{path}/target_means")
        if self.rare is not None:
            self.rare.write.mode("overwrite").parquet(f"{path}/rare_levels")

    @classmethod
    def load(cls, spark, path: str, spec: FeatureSpec = FeatureSpec()) -> "FittedEncoder":
        numeric, modes, levels, default = {}, {}, {c: [] for c in spec.cat_low}, {}
        for r in spark.read.parquet(f"{path}/parameters").collect():
            if r.kind == "numeric":
                numeric[r.feature] = (r.a, r.b, r.c)
            elif r.kind == "mode":
                modes[r.feature] = int(r.a)
            elif r.kind == "level":
                levels[r.feature].append(r.level)
            else:
                default[r.feature] = r.a
        levels = {c: [*sorted(x for x in kept if x != RARE), *([RARE] if RARE in kept else [])] for c, kept in levels.items()}
        rare = spark.read.parquet(f"{path}/rare_levels") if spec.cat_low else None
        return cls(spec, numeric, modes, levels, rare, default, spark.read.parquet(f"{path}/target_means"), None)


def fit_encoder(train: DataFrame, spec: FeatureSpec = FeatureSpec(), min_frequency: int = MIN_FREQUENCY) -> FittedEncoder:
    """Fit all statistics.  Only parameters reach the driver: moments, modes and the names of kept one-hot levels."""
    numeric = {r.feature: (r.median or 0.0, r.mean, r.std) for r in numeric_stats(train, spec.numeric).collect()} if spec.numeric else {}
    modes = {r.feature: r.mode for r in flag_modes(train, spec.binary).collect()} if spec.binary else {}
    levels: dict[str, list[str]] = {c: [] for c in spec.cat_low}
    rare = None
    if spec.cat_low:
        table = store(level_counts(train, spec.cat_low, min_frequency), "levels")
        rare = table.where("rare").select("feature", "level")
        # a kept level is a slot of the vector, so the model bounds their number
        for r in table.where("not rare").select("feature", "level").orderBy("feature", "level").collect():
            levels[r.feature].append(r.level)
        for r in rare.select("feature").distinct().collect():
            levels[r.feature].append(RARE)
    mean = train.agg(F.avg(spec.label)).first()[0] or 0.0
    default = {c: float(mean) for c in spec.cat_high}
    full, crossed = None, None
    if spec.cat_high:
        folded = train.withColumn("_tfold", target_fold(spec.key))
        full = store(target_table(train, spec.cat_high, spec.label), "target-means")
        crossed = store(cross_target_table(folded, spec.cat_high, spec.label, "_tfold"), "target-means-crossed")
    return FittedEncoder(spec, numeric, modes, levels, rare, default, full, crossed)
