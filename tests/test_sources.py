
import pytest
from pyspark.sql import functions as F

from episodica.operators import cohort as C
from episodica.operators import reports as Q
from episodica.plans import claims as P
from episodica.sources import files
from episodica.sources.shared import shared_path, store


def write_csv(path, header, rows):
    path.write_text("\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n")


@pytest.fixture()
def folder(tmp_path):
    header = [*P.CLAIM_COLUMNS, "UNUSED"]

    def claim(person, number, start, end, dx):
        values = dict.fromkeys(header, "")
        values.update(DESYNPUF_ID=person, CLM_ID=number, CLM_FROM_DT=start, CLM_THRU_DT=end, ADMTNG_ICD9_DGNS_CD=dx, CLM_DRG_CD="001", ICD9_DGNS_CD_1=dx)
        return [values[c] for c in header]

    write_csv(tmp_path / "DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.csv", header,
              [claim("A", "1", "20080105", "20080109", "4280"), claim("A", "2", "20080120", "20080125", "V450"), claim("B", "3", "", "20080125", "E812")])
    write_csv(tmp_path / "DE1_0_2008_to_2010_Inpatient_Claims_Sample_2.csv", header, [claim("C", "4", "20090301", "20090302", "0389"), claim("D", "5", "20100601", "20100602", "780")])
    columns = [*P.SNAPSHOT_COLUMNS]
    person = lambda i, birth, flag="1": [i, birth, "", "1", "2", "26", *[flag] * 11]
    write_csv(tmp_path / "DE1_0_2008_Beneficiary_Summary_File_Sample_1.csv", columns, [person("A", "19300101")])
    write_csv(tmp_path / "DE1_0_2009_Beneficiary_Summary_File_Sample_2.csv", columns, [person("C", "19400101", "2")])
    write_csv(tmp_path / "DE1_0_2010_Beneficiary_Summary_File_Sample_2.csv", columns, [person("C", "19400101"), person("D", "19500101")])
    return tmp_path


def test_raw_files_to_cohort(spark, folder):
    claims, snapshots = files.read_claims(spark, str(folder)), files.read_snapshots(spark, str(folder))
    assert {t for _, t in claims.drop("sample").dtypes} == {"string"} and {r.sample for r in claims.collect()} == {1, 2}
    assert {(r.DESYNPUF_ID, r.year, r.sample) for r in snapshots.collect()} == {("A", 2008, 1), ("C", 2009, 2), ("C", 2010, 2), ("D", 2010, 2)}
    cohort = P.build_cohort(claims, snapshots)
    assert cohort.columns == list(P.COHORT_COLUMNS) and len(P.COHORT_COLUMNS) == 31
    got = {r.claim_id: r for r in cohort.collect()}
    assert set(got) == {"1", "2", "4"}  # 3 has no start, 5 ends too close to the last observed start
    assert (got["1"].y, got["2"].y, got["2"].days_since_last_discharge, got["2"].prior_6mo_inpatient_count) == (1, 0, 11, 1)
    assert (got["1"].admit_dx_chapter, got["1"].age_bin, got["1"].sex, got["1"].race, got["1"].chronic_chf, got["4"].chronic_chf) == ("Circulatory", "75-84", "Male", "Black", True, False)
    summary = C.cohort_summary(cohort, F.lit(4)).first()
    assert (summary.n_encounters, summary.n_beneficiaries, summary.positive_count, summary.n_dropped_total) == (3, 2, 1, 1)


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_claims(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.read_split(spark, str(tmp_path / "nothing"), "train")


def test_manifest(spark, folder):
    numbers = lambda *x: sorted(r["sample"] for r in files.sample_numbers(spark, *x).collect())
    assert numbers(1, 3) == [1, 2, 3] and numbers(7) == [7]
    wanted = files.expected_files(spark, [1, 2])
    assert wanted.count() == 9  # one of the ten is known to be broken
    names = {r.n for r in wanted.select(files.canonical_csv_name("file_name").alias("n")).collect()}
    assert "DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.csv" in names and "DE1_0_2009_Beneficiary_Summary_File_Sample_2.csv" in names
    missing = {(r["sample"], r.kind) for r in files.missing_files(spark, [1, 2], str(folder)).collect()}
    assert missing == {(1, "beneficiary_2009"), (1, "outpatient"), (2, "beneficiary_2008"), (2, "outpatient")}


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("c1", "b1", "train", 0.25, 1), ("c2", "b2", "val", 0.5, 0)], "claim_id string, beneficiary_id string, split string, p double, y int")
    files.write_table(df, str(tmp_path / "t"), ["split"])
    assert [r.claim_id for r in files.read_split(spark, str(tmp_path / "t"), "val").collect()] == ["c2"]
    plan = files.read_split(spark, str(tmp_path / "t"), "val")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    files.write_key_table(df, str(tmp_path / "k"))
    assert spark.read.parquet(str(tmp_path / "k")).columns == ["claim_id", "beneficiary_id", "split"]
    files.write_report_csv(df, str(tmp_path / "c"))
    files.write_summary_json(df, str(tmp_path / "j"))
    want = sorted(map(str, df.collect()))
    assert sorted(map(str, files.read_report_csv(spark, str(tmp_path / "c"), df.schema).collect())) == want
    assert sorted(map(str, files.read_summary_json(spark, str(tmp_path / "j"), df.schema).collect())) == want
    curve = spark.createDataFrame([("m", 0, 0.0, 1.0)], "model string, idx int, fpr double, tpr double")
    files.write_curves({"roc": curve, "again": curve}, str(tmp_path / "curves"))
    assert {r.curve for r in spark.read.parquet(str(tmp_path / "curves")).collect()} == {"roc", "again"}


def test_shared_folder(spark):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert store(spark.range(5), "five").count() == 5


def test_reports(spark):
    a = spark.createDataFrame([("x", 0.2)], "model string, pr_auc double")
    b = spark.createDataFrame([("y", 0.3, 1.5)], "model string, pr_auc double, fit_seconds double")
    both = Q.combine_boards({"base": a, "missing": None, "tuned": b})
    assert {(r.board, r.model, r.fit_seconds) for r in both.collect()} == {("base", "x", None), ("tuned", "y", 1.5)}
    assert Q.report_view(b, ["model", "fit_seconds"]).columns == ["Model", "Fit (s)"]
    assert Q.against_previous_best(b, a).first().delta == pytest.approx(0.1)
