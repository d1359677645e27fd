"""Texts with very many matches, strings that compression alone judges, and more labels than dictionaries of full size."""

import random
import string
import time

from pyspark.sql import functions as F

from episodica.llm import pii, secrets
from episodica.llm.dictionaries import sample_dictionaries


def test_matches_are_located_in_runs(spark):
    """100,000 matches in one text beside none and 256 of them."""
    texts = [",".join(["12"] * n) + "é" for n in (100_000, 0, 1, 256, 257)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(2)
    begun = time.time()
    spans = df.select("k", pii.located(F.coalesce("text", F.lit("")), "[0-9]+", 2).alias("s"))
    got = {r.k: r for r in spans.select("k", F.size("s").alias("n"), F.get("s", F.size("s") - 1).alias("last")).collect()}
    assert time.time() - begun < 60
    for k, n in enumerate((100_000, 0, 1, 256, 257, 0, 0)):
        assert got[k].n == n
        if n:
            assert (got[k].last.start, got[k].last.kind, got[k].last.stop, got[k].last.value) == (3 * n - 3, 2, 3 * n - 1, "12")
    every = spans.where("k = 4").first().s
    assert [(s.start, s.stop) for s in every] == [(3 * i, 3 * i + 2) for i in range(257)]


def test_strings_without_digits_and_sensitive_words_in_a_row():
    def strings(text):
        return [text[s:e] for s, e, _ in secrets.sensitive_strings(text, secrets.base_spans(text))[0]]

    assert strings("bearer qZTxPQvLJmKHwRitBanYkc") == ["qZTxPQvLJmKHwRitBanYkc"]
    assert strings("private authorization: qZ7xP0vL2mK9wR4tB8nY3c") == ["qZ7xP0vL2mK9wR4tB8nY3c"]
    assert strings("access considerations and key CONSIDERATIONS") == []
    assert strings("session authorization-bearer wQ8eRt5yUi2oPa") == ["wQ8eRt5yUi2oPa"]


def test_many_candidates_and_spans_in_one_text():
    rng = random.Random(4)
    value = lambda: "".join(rng.choices(string.ascii_letters + string.digits, k=20)) + "7"
    text = " ".join(f"password={value()} bearer {value()}" for _ in range(20_000)) + " " + "key=" * 50_000
    begun = time.time()
    base = secrets.base_spans(text)
    found, _ = secrets.sensitive_strings(text, base)
    assert len(base) >= 20_000 and len(found) >= 19_000 and time.time() - begun < 30


def test_every_label_is_learned(spark):
    rows = [(k, f"l{k % 700:03d}", f"w{k % 700} " * 300) for k in range(2100)]
    df = spark.createDataFrame(rows, "k int, label string, text string")
    made = sample_dictionaries(df, F.col("k"), F.col("text"), F.col("label"), total=1 << 20)
    assert len(made) == 700 and all(f"w{int(name[1:])} ".encode() in content and len(content) <= 1 << 11 for name, content in made.items())
