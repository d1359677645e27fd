"""Balanced folds and ordered target statistics against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from episodica.operators import encode as E
from episodica.operators import splits as P


def entity_rows(seed, hot=False):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 1, 1, 2, 3, 5, 8, 40]) for _ in range(400)]
    if hot:
        sizes.append(sum(sizes) // 2)  # a third of all rows
    rows = [(f"e{i}", int(rng.random() < (0.3 if i % 7 else 0.9))) for i, n in enumerate(sizes) for _ in range(n)]
    return [(e, k, y) for k, (e, y) in enumerate(rows)]


@pytest.mark.parametrize("hot", [False, True])
def test_folds_have_even_rows_and_positives(spark, hot):
    rows = entity_rows(5, hot)
    got = P.assign_balanced_folds(spark.createDataFrame(rows, "e string, k long, y int"), "e", "k", k=3).collect()
    assert len(got) == len(rows) and {r.fold for r in got} == {0, 1, 2}
    assert all(len(s) == 1 for s in _folds_of(got).values())
    n, positives = Counter(r.fold for r in got), Counter(r.fold for r in got if r.y)
    # rows and positives weigh the same in all, and entities differ most in size, so each is close, not exact
    assert max(n.values()) - min(n.values()) <= 0.06 * len(rows) and max(positives.values()) - min(positives.values()) <= 0.06 * sum(positives.values())
    if hot:
        alone = next(r.fold for r in got if r.e == "e400")
        assert n[alone] <= 0.38 * len(rows)


def _folds_of(rows):
    out = defaultdict(set)
    for r in rows:
        out[r.e].add(r.fold)
    return out


def one_by_one(profiles, k):
    rows, positives = (sum(p[i] * p[2] for p in profiles) for i in (0, 1))
    weigh = {p: p[0] * max(positives, 1) + p[1] * rows for p in profiles}
    loads, out = [0] * k, []
    for p in sorted(profiles, key=lambda q: (-weigh[q], q)):
        given = [0] * k
        for _ in range(p[2]):
            f = min(range(k), key=lambda f: (loads[f], f))
            loads[f] += weigh[p]
            given[f] += 1
        out.append((p[0], p[1], [sum(given[: f + 1]) for f in range(k)]))
    return out


def test_profiles_are_dealt_as_one_by_one():
    rng = random.Random(1)
    for k in (2, 3, 5):
        for _ in range(40):
            profiles = list({(rng.randrange(1, 30), rng.randrange(0, 4)): 0 for _ in range(rng.randrange(1, 12))})
            profiles = [(n, min(p, n), rng.randrange(1, 60)) for n, p in profiles]
            profiles = [(n, p, m) for (n, p), m in {(n, p): m for n, p, m in profiles}.items()]
            assert P.deal_profiles(profiles, k) == one_by_one(profiles, k)
    assert P.deal_profiles([], 3) == [] and P.deal_profiles([(4, 0, 10**15 + 1)], 3)[0][2][-1] == 10**15 + 1


def test_counts_keep_six_bits(spark):
    from pyspark.sql import functions as F

    got = {r.n: r.c for r in spark.createDataFrame([(n,) for n in (0, 1, 63, 64, 65, 1000, 10**12 + 1)], "n long").select("n", P.coarse(F.col("n")).alias("c")).collect()}
    assert all(got[n] == (n >> max(n.bit_length() - 6, 0)) << max(n.bit_length() - 6, 0) for n in got)


def test_folds_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 0), ("a", 3, None), ("b", 4, 1)], "e string, k long, y int")
    got = P.assign_balanced_folds(df, "e", "k", k=2).collect()
    assert len(got) == 4 and None not in {r.fold for r in got} and len({r.fold for r in got if r.e is None}) == 1
    assert P.assign_balanced_folds(df.where("false"), "e", "k").count() == 0


def ordered(rows, weight):
    """(key, level, y) to {key: (rows before, code)}."""
    known = [y for _, _, y in rows if y is not None]
    overall = sum(known) / len(known) if known else 0.0
    n, s, out = Counter(), Counter(), {}
    for k, level, y in sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|42".encode()).hexdigest()):
        level = "UNKNOWN" if level is None else level
        out[k] = (n[level], (s[level] + weight * overall) / (n[level] + weight))
        if y is not None:
            n[level] += 1
            s[level] += y
    return out


def test_codes_come_from_the_rows_before(spark):
    rng = random.Random(2)
    rows = [(k, None if k % 11 == 0 else "hot" if k % 3 else f"c{rng.randrange(30)}", None if k % 50 == 7 else rng.randrange(2)) for k in range(900)]
    df = spark.createDataFrame(rows, "k long, code string, y int").repartition(6)
    for weight in (1.0, 10.0):
        got = {r.k: (r.n_before, r.encoded) for r in E.ordered_target(df, ["code"], "y", "k", weight).collect()}
        want = ordered(rows, weight)
        assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in got)
    table = {r.level: (r.n, r.encoded) for r in E.level_target(df, ["code"], "y").collect()}
    mine = [y for _, c, y in rows if c == "hot" and y is not None]
    overall = sum(y for *_, y in rows if y is not None) / sum(y is not None for *_, y in rows)
    assert table["hot"] == (len(mine), pytest.approx((sum(mine) + overall) / (len(mine) + 1)))
    # a row's own label does not enter its code
    flipped = spark.createDataFrame([(k, c, 1 - y if k == 100 else y) for k, c, y in rows], "k long, code string, y int")
    assert {r.n_before for r in E.ordered_target(flipped, ["code"], "y", "k").where("k = 100").collect()} == {got[100][0]}
    assert E.ordered_target(df.where("false"), ["code"], "y", "k").count() == 0
