"""Entity-level splits, folds, samples and their integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.operators import splits as X
from episodica.plans import claims as P
from episodica.plans import views as V
from episodica.plans.catalog.registry import query, rnd
from episodica.sources import files
from episodica.sources.shared import shared_path

RANKED = f"{V.LAB}, {V.ranked_sql('lab', 'id')}"


def split_rows(spark, sf):
    return X.assign_splits(V.features(spark, sf))


@query("a7_split_filter", f"WITH {V.SPLIT} SELECT claim_id, beneficiary_id, split, y FROM feats WHERE split = 'val'")
def split_filter(spark, sf):
    """Features written by split, then one split read back: only its folder is listed."""
    path = shared_path(spark, "features")
    files.write_table(P.build_features(V.cohort(spark, sf)), path, ["split"])
    return files.read_split(spark, path, "val").select("claim_id", "beneficiary_id", "split", "y")


@query("a8_key_table", f"WITH {V.SPLIT} SELECT claim_id, beneficiary_id, split FROM feats")
def key_table(spark, sf):
    path = shared_path(spark, "split-keys")
    files.write_key_table(split_rows(spark, sf), path)
    return spark.read.parquet(path)


@query("a11_keyed_scores", f"WITH {V.SCORES} SELECT claim, y::BIGINT AS y, model, {rnd('p', 'p')} FROM scores")
def keyed_scores(spark, sf):
    path = shared_path(spark, "scores")
    files.write_scores(V.scores(spark, sf), path, "claim")
    return spark.read.parquet(path)


@query("a14_audit_rows", f"WITH {V.AUD} SELECT claim_id, sex, race, age_bin, y, {rnd('p', 'p')}, yhat::BIGINT AS yhat FROM aud")
def audit_rows(spark, sf):
    path = shared_path(spark, "audit-rows")
    files.write_audit_rows(V.audit_rows(spark, sf), path)
    return spark.read.parquet(path)


@query("c4_split_join", f"WITH {V.SPLIT} SELECT claim_id, split FROM feats")
def split_join(spark, sf):
    return split_rows(spark, sf).select("claim_id", "split")


@query(
    "c5_keep_entities",
    f"WITH {RANKED} SELECT claim, id, y::BIGINT AS y FROM lab WHERE id IN (SELECT entity FROM ranked WHERE r <= 100)",
)
def keep_entities(spark, sf):
    """All rows of the first 100 entities of each stratum (semi-join)."""
    rows = V.labelled(spark, sf)
    chosen = X.ranked_entities(rows, "id", "y", at_most=F.lit(100))
    return X.keep_entities(rows, chosen, "id", "claim").select("claim", "id", "y")


@query(
    "d2_split_summary",
    f"WITH {V.SPLIT} SELECT split, count(DISTINCT beneficiary_id) AS n_beneficiaries, count(*) AS n_encounters, {rnd('avg(y)', 'positive_rate')} FROM feats GROUP BY split",
)
def split_summary(spark, sf):
    return X.split_summary(split_rows(spark, sf))


_PROFILE = "prof AS (SELECT sum(n_rows)::BIGINT AS n_rows, count(*) AS n_entities, avg(n_rows) AS rpe, avg(ever_pos) AS share FROM strata)"


@query(
    "d19_entity_profile",
    f"WITH {RANKED}, {_PROFILE} SELECT n_rows, n_entities, {rnd('rpe', 'rows_per_entity')}, {rnd('share', 'positive_share')} FROM prof",
)
def entity_profile(spark, sf):
    return X.entity_profile(V.labelled(spark, sf), "id")


@query("e9_seeded_rank", f"WITH {RANKED} SELECT entity AS id, ever_pos::BIGINT AS ever_pos, n_rows, r AS shuffle_rank, sz AS group_size FROM ranked")
def seeded_rank(spark, sf):
    return X.ranked_entities(V.labelled(spark, sf), "id", "y")


@query(
    "g2_union_of_entities",
    f"WITH {RANKED} SELECT entity AS id FROM ranked WHERE (ever_pos = 1 AND r <= 50) OR (ever_pos = 0 AND r <= 80)",
)
def union_of_entities(spark, sf):
    """Chosen positive and never-positive entities under one another."""
    strata = X.ranked_entities(V.labelled(spark, sf), "id", "y", at_most=F.when(F.col("ever_pos") == 1, 50).otherwise(80))
    return strata.where("ever_pos = 1").select("id").union(strata.where("ever_pos = 0").select("id"))


@query("g3_leakage", f"WITH {V.SPLIT} SELECT beneficiary_id, count(DISTINCT split) AS n_parts FROM feats GROUP BY beneficiary_id HAVING count(DISTINCT split) > 1")
def leakage(spark, sf):
    """Entities in more than one split: none."""
    return X.leaking_entities(split_rows(spark, sf), "beneficiary_id")


@query("h1_splits", f"WITH {V.SPLIT} SELECT entity AS beneficiary_id, split FROM splits")
def splits(spark, sf):
    return X.split_of_entities(V.cohort(spark, sf), "beneficiary_id", "y")


@query(
    "h2_halves",
    f"WITH {RANKED} SELECT l.claim, CASE WHEN r.r <= r.sz // 2 THEN 'calib' ELSE 'test' END AS half FROM lab l JOIN ranked r ON r.entity = l.id",
)
def halves(spark, sf):
    return X.assign_halves(V.labelled(spark, sf), "id", "claim").select("claim", "half")


@query(
    "h3_sample_to_rows",
    f"""WITH {RANKED}, {_PROFILE}, q AS (SELECT floor(5000 / rpe) AS ne, round_even(floor(5000 / rpe) * share, 0) AS np FROM prof)
 SELECT claim, id, y::BIGINT AS y FROM lab WHERE id IN (SELECT entity FROM ranked, q WHERE r <= CASE WHEN ever_pos = 1 THEN np ELSE ne - np END)""",
)
def sample_to_rows(spark, sf):
    return X.sample_to_rows(V.labelled(spark, sf), 5000, "id", "claim").select("claim", "id", "y")


@query(
    "h4_sample_entities",
    f"""WITH {RANKED}, {_PROFILE}, q AS (SELECT greatest(1, round_even(200 * share, 0)) AS np FROM prof)
 SELECT claim, id, y::BIGINT AS y FROM lab WHERE id IN (SELECT entity FROM ranked, q WHERE r <= CASE WHEN ever_pos = 1 THEN np ELSE greatest(1, 200 - np) END)""",
)
def sample_entities(spark, sf):
    return X.sample_entities(V.labelled(spark, sf), 200, "id", "claim").select("claim", "id", "y")


@query(
    "h5_sample_fraction",
    f"""WITH {RANKED}, {_PROFILE} SELECT claim, id, y::BIGINT AS y FROM lab WHERE id IN (
  SELECT entity FROM ranked, prof WHERE r <= floor(sz * least(0.999::DOUBLE, 3000::DOUBLE / n_rows_total) + 0.5))""".replace("n_rows_total", "prof.n_rows"),
)
def sample_fraction(spark, sf):
    return X.sample_fraction(V.labelled(spark, sf), 3000, "id", "claim").select("claim", "id", "y")


@query("h6_sample_rows", f"WITH {V.ENC} SELECT claim, id FROM enc ORDER BY md5(CAST(claim AS VARCHAR) || '|42'), claim LIMIT 2000")
def sample_rows(spark, sf):
    return X.sample_rows(V.encounters(spark, sf).select("claim", "id"), 2000, "claim")


@query("h7_folds", f"WITH {RANKED} SELECT l.claim, (r.r - 1) % 3 AS fold FROM lab l JOIN ranked r ON r.entity = l.id")
def folds(spark, sf):
    return X.assign_folds(V.labelled(spark, sf), "id", "claim").select("claim", "fold")
