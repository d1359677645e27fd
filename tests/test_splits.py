import random

import pytest

from episodica.operators import splits as X


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    data, claim = [], 0
    for entity in range(800):
        for _ in range(400 if entity == 0 else rng.randrange(1, 5)):
            claim += 1
            data.append((f"e{entity}", f"c{claim}", int(rng.random() < 0.06)))
    return spark.createDataFrame(data, "beneficiary_id string, claim_id string, y int").cache()


def share(df):
    return df.selectExpr("avg(y)").first()[0]


def test_splits_keep_entities_together(rows):
    done = X.assign_splits(rows).cache()
    assert done.count() == rows.count() and done.where("split is null").count() == 0
    assert X.leaking_entities(done, "beneficiary_id").count() == 0
    entities = {r.split: r.n_beneficiaries for r in X.split_summary(done).collect()}
    assert sum(entities.values()) == 800
    assert abs(entities["test"] - 120) <= 1 and abs(entities["val"] - 120) <= 1
    # ever-positive entities are spread evenly
    strata = X.split_of_entities(rows, "beneficiary_id", "y").join(X.entity_strata(rows, "beneficiary_id", "y"), "beneficiary_id")
    rates = {r[0]: r[1] for r in strata.groupBy("split").avg("ever_pos").collect()}
    assert max(rates.values()) - min(rates.values()) < 0.02
    assert sorted(map(str, X.assign_splits(rows).collect())) == sorted(map(str, done.collect()))


def test_split_arguments(rows):
    for bad in ({"test_size": 0.0}, {"test_size": 1.0}, {"val_size": 0.9}):
        with pytest.raises(ValueError):
            X.assign_splits(rows, **bad)


def test_halves_are_disjoint_and_exhaustive(rows):
    done = X.assign_halves(rows, "beneficiary_id", "claim_id")
    assert X.partition_check(done).first().asDict() == {"n_rows": rows.count(), "n_unassigned": 0}
    assert X.leaking_entities(done, "beneficiary_id", "half").count() == 0


def test_folds(rows):
    done = X.assign_folds(rows, "beneficiary_id", "claim_id", k=3)
    assert X.leaking_entities(done, "beneficiary_id", "fold").count() == 0
    sizes = [r[1] for r in done.selectExpr("fold", "beneficiary_id").distinct().groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2


@pytest.mark.parametrize("sample", ["rows", "entities", "fraction"])
def test_samples_keep_whole_entities(rows, sample):
    small = rows.where("beneficiary_id <> 'e0'")
    run = {"rows": X.sample_to_rows, "entities": X.sample_entities, "fraction": X.sample_fraction}[sample]
    got = run(small, 300, "beneficiary_id", "claim_id").cache()
    assert X.broken_entities(small, got, "beneficiary_id").count() == 0
    if sample == "entities":
        assert got.select("beneficiary_id").distinct().count() == 300
    else:
        assert 230 <= got.count() <= 370
    assert run(small, 10**6, "beneficiary_id", "claim_id").count() == small.count()


def test_row_sample_and_hold_out(rows):
    assert X.sample_rows(rows, 100, "claim_id").count() == 100
    assert X.sample_rows(rows, 10**6, "claim_id").count() == rows.count()
    held = X.hold_out(rows, "claim_id", 0.1, at_least=64).groupBy("is_validation").count().collect()
    assert {r.is_validation: r["count"] for r in held}[True] == int(rows.count() * 0.1)
