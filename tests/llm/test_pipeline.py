"""The stages one by one against plain versions, and the whole run."""

import brute
import duckdb

import corpus_pipeline
from episodica.llm import mixture, stages
from episodica.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.store(stage(spark, docs, SF), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "mixture":
            assert docs.columns == columns
        texts = {i: r.text for i, r in before.items()}
        if name == "language":
            assert len(after) >= 0.97 * len(before)
        if name == "near_duplicates":
            assert set(after) == {i for i, (_, group) in brute.near_duplicates(texts).items() if group == i}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(after) == {i for i, r in brute.contamination(texts, items).items() if not r[4]}
        if name == "secrets":
            assert set(after) == set(before)
            assert all(brute.secrets(r.text)[0] == [0, 0, 0] and r.n_chars == len(r.text) for r in after.values())
            same = [i for i, t in texts.items() if brute.secrets(t)[0] == [0, 0, 0]]
            assert all(after[i].text == texts[i] for i in same)
        if name == "mixture":
            con = duckdb.connect()
            con.register("documents", spark.createDataFrame(list(before.values()), documents.schema).toPandas())
            want = con.execute(mixture.ORACLE).fetchdf()
            assert sorted(map(tuple, docs.select("doc_id", "size", "taken").collect())) == sorted(want[["doc_id", "size", "taken"]].itertuples(index=False, name=None))


def test_hard_rows(spark, hard, nothing):
    for frame in (hard, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF).columns == frame.columns
    kept = stages.secrets(spark, hard, SF).collect()
    text = next(r.text for r in kept if r.doc_id == 9)
    assert text.startswith("[assign] and token: 'abc'") and len(kept) == hard.count()
    assert stages.near_duplicates(spark, hard, SF).count() == hard.count()


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "taken"} <= set(got.columns) and got.count() > 100


def test_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in ORACLE.items():
        want, got = con.execute(sql).fetchdf(), QUERIES[name](spark, SF).toPandas()
        assert sorted(got.columns) == sorted(want.columns)
        order = sorted(got.columns)
        a, b = (f[order].sort_values(order).reset_index(drop=True) for f in (got, want))
        assert a.equals(b.astype(a.dtypes.to_dict()))
