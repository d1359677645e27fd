import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from episodica.operators import cohort as C
from episodica.roles import EpisodeRoles

ROLES = EpisodeRoles("id", "claim", "a", "d")
DAY0 = dt.date(2000, 1, 1)


def episodes(spark, rows):
    data = [(i, c, DAY0 + dt.timedelta(a), DAY0 + dt.timedelta(d)) for i, c, a, d in rows]
    return spark.createDataFrame(data, "id int, claim int, a date, d date")


def brute(rows):
    """Order, gaps and counts by plain loops."""
    out = {}
    for entity in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == entity], key=lambda r: (r[2], r[3], r[1]))
        for j, (_, c, a, d) in enumerate(mine):
            nxt = mine[j + 1][2] if j + 1 < len(mine) else None
            prev = mine[j - 1][3] if j else None
            prior = sum(1 for r in mine if a - 180 < r[2] <= a) - 1
            y = int(nxt is not None and 0 < nxt - d <= 30)
            out[c] = (nxt, prev, prior, y)
    return out


def compute(spark, rows):
    got = C.with_return_label(C.with_sequence(episodes(spark, rows), ROLES), ROLES).collect()
    off = lambda x: None if x is None else (x - DAY0).days
    return {r.claim: (off(r.next_start), off(r.prev_end), r.prior_count, r.y) for r in got}


def test_look_back_edges_and_twins(spark):
    rows = [(1, 1, 0, 2), (1, 2, 179, 180), (1, 3, 180, 181), (2, 4, 5, 6), (2, 5, 5, 6), (2, 6, 5, 9)]
    assert compute(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_sequence_against_loops_with_a_hot_entity(spark, seed):
    rng = random.Random(seed)
    rows = []
    for claim in range(600):
        entity = 0 if rng.random() < 0.4 else rng.randrange(1, 60)
        a = rng.randrange(0, 400)
        rows.append((entity, claim, a, a + rng.randrange(0, 12)))
    assert compute(spark, rows) == brute(rows)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_rows_of_small_entities_are_not_joined_back(spark):
    rows = [(c % 60, c, c * 7 % 400, c * 7 % 400 + c % 12) for c in range(600)]
    assert compute(spark, rows) == brute(rows)
    assert "Join" not in final_plan(C.with_sequence(episodes(spark, rows), ROLES))
    assert "Join" in final_plan(C.with_sequence(episodes(spark, [(0, c, a, d) for _, c, a, d in rows]), ROLES))


def test_both_paths_agree_on_odd_rows(spark):
    """NULL entities, keys and dates, repeated keys and stays."""
    rng = random.Random(3)
    maybe = lambda x: None if rng.random() < 0.1 else x
    day = lambda n: DAY0 + dt.timedelta(n)
    rows = [(maybe(rng.randrange(8)), maybe(rng.randrange(200)), maybe(day(a)), maybe(day(a + rng.randrange(3)))) for a in rng.choices(range(60), k=400)]
    df = spark.createDataFrame(rows, "id int, claim int, a date, d date")
    few, many = (sorted(map(str, f(df, ROLES, 20).collect())) for f in (C.sequence_of_few, C.sequence_of_hot))
    assert few == many and len(few) == 400
    assert sorted(map(str, C.with_sequence(df, ROLES, 20).collect())) == many


def attach(facts, snaps):
    return C.attach_snapshot(facts, snaps, ["id"], "year", "syear", ["birth", "attr"], "birth", "claim")


def test_snapshot_keys(spark):
    """NULL keys meet nothing, snapshots without a year don't count, a repeated year is an error."""
    facts = spark.createDataFrame([(None, 1, 2000), (7, 2, 2000)], "id int, claim int, year int")
    schema = "id int, syear int, birth string, attr string"
    got = attach(facts, spark.createDataFrame([(None, 2000, "b", "x"), (7, None, "c", "y"), (7, 1999, "d", "z")], schema)).collect()
    assert {r.claim: (r.birth, r.attr) for r in got} == {1: (None, None), 2: ("d", "z")}
    with pytest.raises(ValueError, match="more than one snapshot"):
        attach(facts, spark.createDataFrame([(7, 2000, "b", "x"), (7, 2000, "c", "y")], schema))


def test_one_day_of_one_entity_with_a_third_of_all_rows(spark):
    rows = [(0, c, 10, 12) for c in range(500)] + [(c % 40, c, c % 300, c % 300 + 3) for c in range(500, 1500)]
    assert compute(spark, rows) == brute(rows)


def test_snapshot_fallback(spark):
    facts = spark.createDataFrame([(1, 10, 2000), (2, 11, 2000), (3, 12, 2003), (4, 13, 2000)], "id int, claim int, year int")
    snaps = spark.createDataFrame(
        [(1, 2000, "b0", "x"), (1, 2001, "b1", "y"), (2, 2000, None, "p"), (2, 2002, "b2", "q"), (3, 2000, "b3", "r")],
        "id int, syear int, birth string, attr string",
    )
    got = C.attach_snapshot(facts, snaps, ["id"], "year", "syear", ["birth", "attr"], "birth", "claim")
    assert {r.claim: (r.birth, r.attr) for r in got.collect()} == {10: ("b0", "x"), 11: ("b2", "q"), 12: ("b3", "r"), 13: (None, None)}
    assert C.duplicate_snapshots(snaps, ["id", "syear"]).count() == 0


def test_snapshots_are_not_broadcast(spark):
    """Spark takes packed years for small; they grow with the entities and must not pass through the driver."""
    facts = spark.range(2000).selectExpr("id % 50 as id", "id as claim", "cast(2000 + id % 3 as int) as year")
    snaps = spark.range(150).selectExpr("id % 50 as id", "cast(2000 + id div 50 as int) as syear", "if(id % 7 = 0, null, string(id)) as birth", "string(id) as attr")
    got = attach(facts, snaps)
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    born = {(i % 50, 2000 + i // 50): (str(i) if i % 7 else None, str(i)) for i in range(150)}
    for r in got.collect():
        own = born[r.id, r.year]
        assert (r.birth, r.attr) == (own if own[0] else born[r.id, 2002])


def test_snapshots_are_packed_behind_the_shuffle(spark):
    """Packed before it, they are sorted and spilled by the few tasks that read them."""
    facts = spark.range(2000).selectExpr("id % 50 as id", "id as claim", "cast(2000 + id % 3 as int) as year")
    snaps = spark.range(150).selectExpr("id % 50 as id", "cast(2000 + id div 50 as int) as syear", "string(id) as birth", "string(id) as attr")
    plan = attach(facts, snaps)._jdf.queryExecution().executedPlan().toString().split("\n")
    steps = [line.lstrip(" :+-").split("(")[0].split(" ")[0] for line in plan]
    assert ("ObjectHashAggregate", "ObjectHashAggregate") in list(zip(steps, steps[1:]))


def test_year_join_is_not_broadcast(spark):
    from episodica.plans.catalog import QUERIES

    got = QUERIES["c2_year_join"](spark, "/root/testdata/sf0.001")
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_exclusions_are_three_valued(spark):
    day = lambda n: DAY0 + dt.timedelta(n)
    rows = [
        (1, day(0), day(3), day(1), 3, 70, 0),
        (2, day(0), day(3), day(20), 3, 70, 0),
        (3, day(0), day(3), day(20), 3, 70, 1),
        (4, day(190), day(195), None, 5, 70, 0),
        (5, day(0), day(3), None, 400, 17, 0),
        (6, day(0), day(3), None, 3, None, 0),
        (7, day(200), day(3), None, 3, 70, 0),
    ]
    df = spark.createDataFrame(rows, "k int, admit_date date, discharge_date date, death_date date, los_days int, age_at_admit int, y int")
    flagged = C.exclusion_flags(df)
    assert sorted(r.k for r in C.keep_included(flagged).collect()) == [3, 7]
    counts = {r.reason: r.n for r in C.attrition(flagged).collect()}
    assert counts == {"total": 7, "dropped": 5, "died_during": 1, "censored_death": 1, "censored_window": 1, "long_los": 1, "too_young": 1}
