"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names: no crash, and the stated results."""

import brute
from pyspark.sql import functions as F

from episodica.llm.decontaminate import find_contamination
from episodica.llm.language import identify_language
from episodica.llm.lm import score_texts
from episodica.llm.mixture import mix_sources
from episodica.llm import near_duplicates
from episodica.llm.near_duplicates import find_near_duplicates
from episodica.llm.pii import find_personal_data
from episodica.llm.quality import score_quality
from episodica.llm.secrets import scan_secrets
from episodica.llm.substrings import remove_repeated_strings

LABELS = "doc_id long, quality int"


def keyed(rows):
    return sorted(rows, key=str)


def test_secrets(hard, nothing):
    got = scan_secrets(hard, hard.columns).collect()
    assert len(got) == hard.count() and all(([r.n_assign, r.n_access, r.n_hex], r.base_sha256) == brute.secrets(r.doc.text) for r in got)
    assert scan_secrets(nothing, nothing.columns).count() == 0


def test_mixture(hard, nothing):
    got = mix_sources(hard).collect()
    assert len(got) == hard.count()
    want = keyed((r.doc_id, len(brute.words(r.text))) for r in hard.collect())
    assert keyed((r.doc_id, r["size"]) for r in got) == want
    targets = {r.source: (r.source_size, r.target) for r in got}
    assert set(targets) == {None, "", "a", "b", "c"} and targets[None] == (0, 0.0)
    assert all(t <= 2 * s for s, t in targets.values()) and abs(sum(t for _, t in targets.values()) - 1.5 * sum(s for s, _ in targets.values())) < 1e-6
    assert mix_sources(nothing).count() == 0 and {r.taken for r in mix_sources(hard.where("doc_id in (1, 2, 3)")).collect()} == {0}


def test_near_duplicates(hard, nothing):
    got = find_near_duplicates(hard).collect()
    assert len(got) == hard.count()
    for r in got:
        assert r.component_id == r.doc_id and r.kept
    assert {r.doc_id: r.n_shingles for r in got if r.doc_id} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 10, 10: 1}
    assert find_near_duplicates(nothing).count() == 0 and find_near_duplicates(hard.where("doc_id < 4")).count() == 3


def test_null_ids_in_a_group(spark):
    text = " ".join(f"w{k}" for k in range(50))
    got = find_near_duplicates(spark.createDataFrame([(None, text), (7, text + " more"), (3, "more " + text)], "doc_id long, text string")).collect()
    assert keyed((r.doc_id, r.component_id, r.kept) for r in got) == keyed([(None, 3, False), (7, 3, False), (3, 3, True)])


def test_many_rows_under_one_id(spark, monkeypatch):
    """Rows without an id, and rows of one id, meet the nodes of their own text: no product of rows and nodes."""
    texts = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(400)]
    rows = [(i, t + end) for t in texts for i in (None, 5) for end in ("", " more")]
    taken = []
    whole = near_duplicates.annotate

    def counted(df, *rest):
        if "members binary" in rest[2]:
            taken.append(df.count())
        return whole(df, *rest)

    monkeypatch.setattr(near_duplicates, "annotate", counted)
    got = find_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 1600 and {r.component_id for r in got} == {5} and sum(r.kept for r in got) == 800
    assert taken == [800]


def test_quality(spark, hard, nothing):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in score_quality(hard, none, hard.columns).collect()} == {0.5}
    labels = spark.createDataFrame([(k, k % 2) for k in range(11)] + [(None, 1), (3, 0), (5, None), (4, 5)], LABELS)
    got = score_quality(hard, labels, hard.columns).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    empty = {r.score for r in got if not r.doc.text}
    assert len(empty) == 1
    assert score_quality(nothing, labels, ["doc_id"]).count() == 0


def test_contamination(spark, hard, nothing):
    items = [("a", None), ("b", ""), ("c", "one TWO"), (None, "word word"), ("c", "a text without an id a b c d e f g h"), ("d", "a text without an id a b c d e f g h")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id string, text string, doc string")
    got = find_contamination(hard, benchmark, hard.columns).collect()
    for r in got:
        assert tuple(r)[1:6] == brute.contamination({0: r.doc.text}, items)[0]
    clean = find_contamination(hard, benchmark.where("false"), ["doc_id"]).collect()
    assert not any(r.contaminated or r.n_hit for r in clean) and find_contamination(nothing, benchmark, ["doc_id"]).count() == 0


def test_repeated_strings(hard, nothing):
    got = remove_repeated_strings(hard).collect()
    want = brute.repeated_strings(dict(enumerate(r.text for r in hard.collect())))
    assert keyed((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == keyed(want.values())
    assert remove_repeated_strings(nothing).count() == 0 and remove_repeated_strings(hard.where("doc_id < 4")).count() == 3


def test_personal_data(hard, nothing):
    got = find_personal_data(hard, hard.columns).collect()
    assert len(got) == hard.count()
    assert all(([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute.personal(r.doc.text) for r in got)
    assert find_personal_data(nothing, nothing.columns).count() == 0


def test_language(hard, nothing):
    got = identify_language(hard, hard.columns).collect()
    assert len(got) == hard.count()
    assert {r.doc.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 4, 10} and all(r.rejected for r in got if r.lang_pred == "und")
    assert {r.lang_pred for r in identify_language(hard.withColumn("lang", F.lit(None).cast("string")), ["doc_id"]).collect()} == {"und"}
    assert identify_language(nothing, nothing.columns).count() == 0


def test_lm_scores(hard, nothing):
    rows = hard.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in score_texts(rows).collect()}
    for i, (n, known, total, base) in brute.token_scores({r.doc_id: r.text for r in rows.collect()}).items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and abs(r.base_score - base) < 1e-6 * abs(base) + 1e-9
    assert score_texts(nothing).count() == 0 and score_texts(hard).count() == hard.count()
