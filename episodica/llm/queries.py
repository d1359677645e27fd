"""The operators with production parameters over the whole given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import divergence, mixture
from episodica.llm.arrow import pick
from episodica.llm.decontaminate import find_contamination
from episodica.llm.hard_negatives import mine_negatives
from episodica.llm.language import identify_language
from episodica.llm.lm import score_texts
from episodica.llm.near_duplicates import find_near_duplicates
from episodica.llm.neighbours import nearest
from episodica.llm.pii import find_personal_data
from episodica.llm.quality import score_quality
from episodica.llm.secrets import scan_secrets
from episodica.llm.simhash import find_simhash_groups
from episodica.llm.substrings import remove_repeated_strings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secret_scan(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    return pick(found, ["doc_id"], "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans")


@query
def op2_mixture(spark, sf_dir):
    return mixture.mix_sources(table(spark, sf_dir, "documents"))


ORACLE["op2_mixture"] = mixture.ORACLE


@query
def op3_near_duplicates(spark, sf_dir):
    return find_near_duplicates(table(spark, sf_dir, "documents"))


_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op3_near_duplicates"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT l.b, r.c FROM reach r JOIN both_ways l ON l.a = r.doc_id),
least_id AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least_id USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query
def op4_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_quality(spark, sf_dir):
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return pick(scored, ["doc_id"], "held_out", "score", "predicted")


@query
def op6_decontamination(spark, sf_dir):
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return pick(found, ["doc_id"], "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op6_decontamination"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, least(i + 12, len(w))) AS win FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win FROM d, lengths, unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM m), unnest(range(i, i + n)) t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit, CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items,
  sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op7_repeated_strings(spark, sf_dir):
    kept = remove_repeated_strings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op8_personal_data(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents"), ["doc_id"])
    return pick(found, ["doc_id"], "n_email", "n_ip", "n_card", "n_phone", "n_term", "base_sha256", "spans")


@query
def op9_language(spark, sf_dir):
    named = identify_language(table(spark, sf_dir, "documents"), ["doc_id"])
    return pick(named, ["doc_id"], "held_out", "lang_pred", "score", "rejected")


@query
def op10_lm_score(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"))


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


ORACLE["op11_source_divergence"] = divergence.ORACLE


@query
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE["op12_hard_negatives"] = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_sum([a.v[i] * r.v[i] FOR i IN range(1, len(r.v) + 1)]) AS BIGINT) AS score
  FROM r a JOIN r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) <= 10
"""


@query
def op13_simhash_groups(spark, sf_dir):
    return find_simhash_groups(table(spark, sf_dir, "documents"))
