"""The whole pipeline on small extracts in the raw schemas."""

import dataclasses
import datetime as dt
import json
import random
import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskmart import jobs
from riskmart.plans.training import TrainingOptions
from riskmart.schemas import RAW_ATTRIBUTE_COLUMNS, RAW_CLICKSTREAM_COLUMNS, RAW_FINANCIAL_COLUMNS
from riskmart.sources import readers, writers

CUSTOMERS = 60
MONTHS = [dt.date(2023 + m // 12, m % 12 + 1, 1) for m in range(18)]
OPTIONS = TrainingOptions(
    train_end="2023-06-01",
    test_end="2023-09-01",
    forest_trees=3,
    forest_depth=3,
    search_draws=1,
    search_folds=2,
    search_parallelism=1,
    search_ranges={"maxIter": [2], "maxDepth": [2]},
)


def add_months(day, n):
    m = day.month - 1 + n
    return dt.date(day.year + m // 12, m % 12 + 1, 1)


def write_csv(path, header, rows):
    import csv

    with open(path, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(7)
    risk = {c: rng.random() for c in range(CUSTOMERS)}
    loans, clicks, attributes, financials = [], [], [], []
    for month in MONTHS:
        for c in range(CUSTOMERS):
            bad = risk[c] + rng.random() * 0.3 > 0.75
            clicks.append([int(100 * risk[c]) + rng.randint(0, 9) + i for i in range(20)] + [f"C{c}", month])
            if add_months(month, 6) in MONTHS:
                overdue = 250 if bad else 0
                loan = f"L{c}_{month}"
                for step in (5, 6):
                    loans.append(
                        [loan, f"C{c}", month, 10, step, 1000, 100, 100, overdue, 500, add_months(month, step)]
                    )
    for c in range(CUSTOMERS):
        day = dt.date(2022, 12, 15)
        attributes.append([f"C{c}", f"Name, {c}", f"{20 + c}_", "000-00-0000", "Lawyer", day])
        financials.append(
            [f"C{c}", f"{20000 + 1000 * c}.5_", "2500.0", "3", "4", "12", "2_", "Auto Loan, and Payday Loan",
             "5", "3", "_", "4.0", "Good", "900.1", "30.2", "12 Years and 3 Months", "NM", "40.5",
             "__10000__", "!@9#%8", "310.4", day]
        )
    loan_header = [
        "loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt",
        "due_amt", "paid_amt", "overdue_amt", "balance", "snapshot_date",
    ]
    return jobs.RawPaths(
        write_csv(folder / "loans.csv", loan_header, loans),
        write_csv(folder / "clicks.csv", RAW_CLICKSTREAM_COLUMNS, clicks),
        write_csv(folder / "attributes.csv", RAW_ATTRIBUTE_COLUMNS, attributes),
        write_csv(folder / "financials.csv", RAW_FINANCIAL_COLUMNS, financials),
    )


@pytest.fixture(scope="module")
def mart(spark, raw, tmp_path_factory):
    mart = jobs.Mart(str(tmp_path_factory.mktemp("mart")))
    reason = jobs.run(spark, raw, mart, "v1", at=F.lit("2024-07-01"), options=OPTIONS)
    assert reason == "no_champion"
    return mart


def table(spark, mart, name):
    return spark.read.parquet(mart.path(name))


def test_datamart(spark, mart):
    labels = table(spark, mart, "label_store")
    assert labels.count() == CUSTOMERS * 12
    assert {r[0] for r in labels.select("label").distinct().collect()} == {0, 1}
    store = table(spark, mart, "feature_store")
    assert store.count() == CUSTOMERS * len(MONTHS)
    row = store.where("Customer_ID = 'C3' and snapshot_date = '2023-05-01'").first()
    assert (row["Age"], row["Occupation"], row["Num_of_Loan"], row["num_loan_types"]) == (23, 7, 2, 2)
    assert row["credit_history_months"] == 147
    assert row["Changed_Credit_Limit"] is None and row["Payment_Behaviour"] is None
    assert "Name" not in store.columns and "SSN" not in table(spark, mart, "silver_attributes").columns


def test_first_model_is_promoted(spark, mart):
    assert jobs.version_of(spark, mart, "champion") == "v1"
    assert jobs.version_of(spark, mart, "challenger") is None
    comparison = jobs.of_version(spark, mart, "model_comparison", "v1")
    assert comparison.count() == 9
    assert comparison.where("is_champion").select("model").distinct().count() == 1
    best = comparison.where("is_champion and split = 'oot'").first()
    assert best["auc"] > 0.7 and best["train_date"] is not None
    assert jobs.of_version(spark, mart, "train_scores", "v1").first()["percentiles"] is not None
    metadata = jobs.of_version(spark, mart, "model_metadata", "v1").first()
    parameters = json.loads(metadata["parameters"])
    assert set(parameters["boosted_trees"]) == {"maxIter", "maxDepth"} and parameters["options"]["search_draws"] == 1
    assert metadata["calibration"] == "sigmoid" and metadata["calibration_rows"] > 0
    assert metadata["scored_through"] is None and metadata["excluded_features"] == []


def test_predictions(spark, mart):
    predictions = table(spark, mart, "predictions")
    assert predictions.count() == CUSTOMERS * len(MONTHS)
    low, high = predictions.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low <= high <= 1
    assert predictions.agg(F.min("snapshot_date")).first()[0] == dt.date(2023, 7, 1)


def test_monitoring(spark, mart):
    rows = table(spark, mart, "monitoring").orderBy("snapshot_date").collect()
    assert rows[0]["psi_score"] is None and rows[0]["psi_flag"] == "unknown"
    assert rows[1]["psi_score"] is not None
    assert rows[0]["auc"] > 0.7
    assert rows[0]["psi_vs_training"] is not None
    assert any(c.startswith("csi_") for c in rows[0].asDict())


def snapshot(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_alert_document_is_nested(spark, mart):
    document = spark.read.json(mart.path("latest_alert"))
    if document.count():
        assert document.schema["alerts"].dataType.elementType.names == ["feature", "flag", "type", "value"]
        assert "timestamp" in document.columns


def test_gate_sees_absent_months(spark, mart):
    report = table(spark, mart, "quality_report")
    months = {r[0] for r in report.select("snapshot_date").distinct().collect()}
    assert months == set(MONTHS)
    empty = {r["snapshot_date"] for r in report.where("check = 'empty_label_partition'").collect()}
    assert empty == set(MONTHS[5:6])  # loans of five months on book only


def test_rerun_changes_nothing(spark, raw, mart):
    names = ("label_store", "feature_store", "alerts", "registry", "predictions", "monitoring", "silver_financials")
    before = {n: snapshot(table(spark, mart, n)) for n in names}
    jobs.build_datamart(spark, raw, mart)
    assert jobs.score(spark, mart) == []
    jobs.monitor(spark, mart, F.lit("2024-08-01"))
    assert before == {n: snapshot(table(spark, mart, n)) for n in before}


def test_months_one_by_one_equal_all_at_once(spark, raw, mart, tmp_path):
    other = jobs.Mart(str(tmp_path / "stepwise"))
    for months in (MONTHS[:7], MONTHS[7:8], MONTHS[8:]):
        jobs.build_datamart(spark, raw, other, months)
    for name in ("silver_loans", "label_store", "feature_store"):
        assert snapshot(table(spark, other, name)) == snapshot(table(spark, mart, name)), name


def test_months_without_output_are_not_tried_again(spark, raw, mart):
    assert set(MONTHS[5:6]) <= jobs.finished_months(spark, mart, "label_store")
    assert MONTHS[5] not in readers.month_partitions(spark, mart.path("label_store"))
    log = spark.read.parquet(mart.path("finished")).count()
    jobs.build_datamart(spark, raw, mart)
    assert spark.read.parquet(mart.path("finished")).count() == log


def test_only_the_due_partitions_are_read(spark, mart, monkeypatch):
    plans = []
    monkeypatch.setattr(writers, "write_months", lambda df, path: plans.append(df._jdf.queryExecution().toString()))
    monkeypatch.setattr(jobs, "mark_finished", lambda *a: None)
    jobs.build_months(spark, mart, "silver_loans", "bronze_loans", jobs.datamart.silver_loans, [MONTHS[8]], True)
    jobs.score(spark, mart, [add_months(MONTHS[2], 6)], rebuild=True)
    monkeypatch.setattr(readers, "month_partitions", lambda s, p: [MONTHS[8]])
    jobs.measure(spark, mart, rebuild=True)
    assert len(plans) == 4
    for plan, month in zip(plans, (MONTHS[8], MONTHS[2], MONTHS[8], MONTHS[8])):
        filters = re.findall(r"PartitionFilters: \[[^\]]*\]", plan)
        assert filters and all(f"= {month}" in f or f"IN ({month})" in f for f in filters), filters


def test_new_records_of_a_history_are_added(spark, raw, mart, tmp_path):
    lines = Path(raw.attributes).read_text().splitlines()
    longer = tmp_path / "attributes.csv"
    longer.write_text("\n".join([*lines, 'C3,"Name, 3",44_,000-00-0000,Doctor,2024-06-15']) + "\n")
    other = jobs.Mart(str(tmp_path / "history"))
    jobs.build_datamart(spark, raw, other, MONTHS[:2])
    before = table(spark, other, "silver_attributes").count()
    jobs.build_datamart(spark, dataclasses.replace(raw, attributes=str(longer)), other, MONTHS[:3])
    after = table(spark, other, "silver_attributes")
    assert after.count() == before + 1
    assert after.where("snapshot_date = '2024-06-15'").first()["Age"] == 44


def test_shadow_period_month_by_month(spark, mart, tmp_path):
    """A challenger is scored on new months only, and needs two new labelled cohorts to be promoted."""
    other = jobs.Mart(str(tmp_path / "shadow"))
    copy_tables(spark, mart, other)
    scored = MONTHS[6:10]
    jobs.score(spark, other, scored)
    jobs.monitor(spark, other, F.lit("2023-11-01"))
    old = snapshot(table(spark, other, "predictions"))
    jobs.train(spark, other, "v2", F.lit("2023-11-01"), OPTIONS)
    assert jobs.version_of(spark, other, "challenger") == "v2"
    assert jobs.decide_retrain(spark, other).first()["reason"] == "challenger_in_shadow"
    assert jobs.of_version(spark, other, "model_metadata", "v2").first()["scored_through"] == MONTHS[9]

    jobs.monitor(spark, other, F.lit("2023-11-02"))
    assert jobs.version_of(spark, other, "challenger") == "v2"
    win_always(other, spark)
    for n, month in enumerate(MONTHS[10:12]):
        assert jobs.score(spark, other, MONTHS[: 11 + n]) == [month]
        new = table(spark, other, "predictions")
        assert snapshot(new.where(F.col("snapshot_date") <= MONTHS[9])) == old
        assert new.where(F.col("snapshot_date") == month).where("challenger_score is null").count() == 0
        jobs.monitor(spark, other, F.lit(f"2023-12-0{n + 1}"))
        assert n or jobs.version_of(spark, other, "champion") == "v1"
        # What the measured months say is made a win of the challenger's, and monitoring goes on from there.
        win_always(other, spark)
        jobs.monitor(spark, other, F.lit(f"2023-12-1{n + 1}"))
        assert jobs.version_of(spark, other, "champion") == ("v1" if n == 0 else "v2")
    assert table(spark, other, "promotion_log").first()["cohorts"] == MONTHS[10:12]


def copy_tables(spark, mart, other):
    for name in ("feature_store", "label_store", "registry", "finished", "feature_baseline", "train_scores", "model_comparison", "model_metadata", "training_splits"):
        rows = spark.read.parquet(mart.path(name))
        if name == "finished":
            rows = rows.where("table in ('label_store', 'feature_store')")
        keys = [c for c in ("snapshot_date", "version_key") if c in rows.columns and name != "finished"]
        rows.write.partitionBy(*keys).parquet(other.path(name)) if keys else rows.write.parquet(other.path(name))
    shutil.copytree(mart.model("v1"), other.model("v1"))


def win_always(mart, spark):
    """Stored metrics in which the challenger wins every month, those before its time too."""
    rows = spark.read.schema(jobs.PERFORMANCE_SCHEMA).parquet(mart.path("cohort_performance"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    writers.write_months(rows.withColumns({"auc": F.lit(0.6), "challenger_auc": F.lit(0.9)}), mart.path("cohort_performance"))


def test_measuring_month_by_month_equals_all_at_once(spark, mart, tmp_path):
    other = jobs.Mart(str(tmp_path / "measured"))
    copy_tables(spark, mart, other)
    for months in (MONTHS[6:8], MONTHS[8:9], None):
        jobs.score(spark, other, months)
        jobs.monitor(spark, other, F.lit("2024-07-01"))
    for name in ("predictions", "monitoring", "score_profile", "cohort_performance", "csi"):
        assert snapshot(rounded(table(spark, other, name))) == snapshot(rounded(table(spark, mart, name))), name


def rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes])


def test_training_a_version_again_replaces_it(spark, mart, tmp_path):
    other = jobs.Mart(str(tmp_path / "again"))
    copy_tables(spark, mart, other)
    jobs.train(spark, other, "v1", F.lit("2024-09-01"), OPTIONS)
    for name, rows in (("model_comparison", 9), ("model_metadata", 1), ("train_scores", 1), ("training_splits", 3)):
        assert jobs.of_version(spark, other, name, "v1").count() == rows
    assert jobs.of_version(spark, other, "model_metadata", "v1").first()["train_date"].month == 9
    jobs.promote(spark, other, F.lit("2024-09-01").cast("timestamp"), "test")  # at the time of registration
    roles = {r["model_version"]: r["role"] for r in jobs.governance.current_roles(jobs.registry(spark, other)).collect()}
    assert roles == {"v1": "champion"}


def test_month_files_are_landed(spark, mart, tmp_path):
    other = jobs.Mart(str(tmp_path / "landed"))
    for month in MONTHS[:2]:
        spark.createDataFrame([("a", 1)], "k string, x int").write.parquet(f"{tmp_path}/in/clicks_{month:%Y_%m_%d}.parquet")
    jobs.land_month_files(spark, other, "bronze_clickstream", f"{tmp_path}/in", "clicks_")
    assert readers.month_partitions(spark, other.path("bronze_clickstream")) == MONTHS[:2]


def test_a_raw_file_is_parsed_once(spark, mart, tmp_path):
    """New files only are read; late rows rewrite their month, and what was built from it is due again."""
    other = jobs.Mart(str(tmp_path / "files"))
    folder = tmp_path / "extracts"
    folder.mkdir()
    header, read = ["k", "snapshot_date"], []

    def parse(paths):
        read.append(sorted(Path(p).name for p in paths))
        return jobs.typed_month(jobs.filelog.with_source(readers.read_text_csv(spark, paths, jobs.text_schema(header))))

    def land(**more):
        return jobs.land_months(spark, other, "bronze_clickstream", str(folder / "*.csv"), parse, **more)

    def rows():
        found = table(spark, other, "bronze_clickstream").select("k", F.col("snapshot_date").cast("string")).collect()
        return sorted(map(tuple, found))

    write_csv(folder / "a.csv", header, [["1", "2023-01-01"], ["2", "2023-02-01"]])
    assert land() == MONTHS[:2] and land() == []
    january = jobs.month_states(spark, other, "bronze_clickstream")[MONTHS[0]]
    write_csv(folder / "b.csv", header, [["3", "2023-02-01"], ["4", "2023-03-01"], ["5", ""]])
    assert land() == MONTHS[1:3]
    assert rows() == [("1", "2023-01-01"), ("2", "2023-02-01"), ("3", "2023-02-01"), ("4", "2023-03-01")]
    write_csv(folder / "a.csv", header, [["1", "2023-01-01"], ["22", "2023-02-01"], ["23", "2023-02-01"]])
    assert land() == MONTHS[:2]
    assert read == [["a.csv"], ["b.csv"], ["a.csv"]]
    assert [r[0] for r in rows()] == ["1", "22", "23", "3", "4"]
    # The month whose rows are the same is no reason to build anything again.
    sources = jobs.current(spark, other, "bronze_clickstream")
    assert sources[MONTHS[0]] == january[0]
    assert jobs.stale_months(spark, other, "silver_clickstream", MONTHS[:3], sources) == MONTHS[:3]
    jobs.mark_finished(spark, other, "silver_clickstream", MONTHS[:3], {**sources, MONTHS[1]: "old"})
    assert jobs.stale_months(spark, other, "silver_clickstream", MONTHS[:3], sources) == [MONTHS[1]]
    with pytest.raises(FileNotFoundError):
        jobs.fresh_files(spark, other, "bronze_loans", str(tmp_path / "nowhere*.csv"), False)


def test_late_rows_reach_the_stores(spark, raw, tmp_path):
    lines = Path(raw.clickstream).read_text().splitlines()
    first, second = tmp_path / "clicks", jobs.Mart(str(tmp_path / "late"))
    first.mkdir()
    (first / "1.csv").write_text("\n".join([x for x in lines if f"C0,{MONTHS[0]}" not in x and str(MONTHS[2]) not in x]) + "\n")
    paths = dataclasses.replace(raw, clickstream=str(first))
    jobs.build_datamart(spark, paths, second, MONTHS[:3])
    assert table(spark, second, "feature_store").count() == 2 * CUSTOMERS - 1
    log = spark.read.parquet(second.path("finished")).where("table = 'feature_store'")
    assert log.count() == 2
    (first / "2.csv").write_text("\n".join([lines[0], *[x for x in lines if f"C0,{MONTHS[0]}" in x or str(MONTHS[2]) in x]]) + "\n")
    jobs.build_datamart(spark, paths, second, MONTHS[:3])
    assert table(spark, second, "feature_store").count() == 3 * CUSTOMERS
    built = spark.read.parquet(second.path("finished")).where("table = 'feature_store'").groupBy("snapshot_date").count()
    assert {r[0]: r[1] for r in built.collect()} == {MONTHS[0]: 2, MONTHS[1]: 1, MONTHS[2]: 1}


def test_gate_profiles_a_month_once(spark, mart, tmp_path, monkeypatch):
    other = jobs.Mart(str(tmp_path / "gate"))
    copy_tables(spark, mart, other)
    table(spark, mart, "silver_clickstream").write.partitionBy("snapshot_date").parquet(other.path("silver_clickstream"))
    stores = [table(spark, other, t) for t in ("feature_store", "label_store")]
    dates = spark.createDataFrame([(m,) for m in MONTHS], "snapshot_date date")
    direct = jobs.quality.quality_report(*stores, dates)
    profiled = []
    plan = jobs.quality.feature_findings
    monkeypatch.setattr(jobs.quality, "feature_findings", lambda rows, dates: profiled.append(dates.count()) or plan(rows, dates))
    whole = snapshot(jobs.check_quality(spark, other))
    assert set(snapshot(direct)) <= set(whole) and len(whole) == direct.count() + 1
    assert snapshot(jobs.check_quality(spark, other)) == whole and profiled == [len(MONTHS)]
    # A month written anew is profiled anew, and only that one is read.
    month = stores[0].where(F.col("snapshot_date") == MONTHS[4])
    writers.write_months(spark.createDataFrame(month.limit(7).collect(), month.schema), other.path("feature_store"))
    jobs.mark_finished(spark, other, "feature_store", [MONTHS[4]])
    report = jobs.check_quality(spark, other)
    assert profiled == [len(MONTHS), 1]
    few = report.where("check = 'row_count' and severity = 'warn'").collect()
    assert [(r["snapshot_date"], r["value"]) for r in few] == [(MONTHS[4], 7.0)]


def test_rescored_months_are_measured_again(spark, mart, tmp_path):
    other = jobs.Mart(str(tmp_path / "rescored"))
    copy_tables(spark, mart, other)
    jobs.score(spark, other, MONTHS[6:8])
    jobs.measure(spark, other)
    before = {r["snapshot_date"]: r["mean_score"] for r in table(spark, other, "score_profile").collect()}
    rows = table(spark, other, "predictions").where(F.col("snapshot_date") == MONTHS[7]).withColumn("score", F.lit(0.25))
    writers.write_months(spark.createDataFrame(rows.collect(), rows.schema), other.path("predictions"))
    jobs.mark_finished(spark, other, "predictions", [MONTHS[7]])
    jobs.measure(spark, other)
    after = {r["snapshot_date"]: r["mean_score"] for r in table(spark, other, "score_profile").collect()}
    assert after == {MONTHS[6]: before[MONTHS[6]], MONTHS[7]: 0.25}
    performance = {r["snapshot_date"]: r["auc"] for r in table(spark, other, "cohort_performance").collect()}
    assert performance[MONTHS[7]] == 0.5


def test_latest_month(spark, mart, tmp_path):
    last = readers.latest_month(spark, mart.path("feature_store"))
    assert {r[0] for r in last.select("snapshot_date").distinct().collect()} == {MONTHS[-1]}
    assert last.count() == CUSTOMERS and readers.latest_month(spark, str(tmp_path / "none")) is None


def test_values_with_line_breaks(spark, tmp_path):
    path = write_csv(tmp_path / "x.csv", ["a", "b"], [["one\ntwo", "3"], ["four", "5"]])
    schema = jobs.text_schema(["a", "b"])
    rows = readers.read_text_csv(spark, path, schema, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("one\ntwo", "3"), ("four", "5")]
