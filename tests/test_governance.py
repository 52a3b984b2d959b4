"""Decision rules, registry and alerts on hand-made monitoring rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskmart.plans import governance, monitoring

SCHEMA = "snapshot_date date, psi_score double, auc double, challenger_auc double"


def table(spark, rows):
    return spark.createDataFrame([(dt.date(2023, m, 1), *values) for m, *values in rows], SCHEMA)


@pytest.mark.parametrize(
    ("rows", "promote"),
    [
        ([(1, 0.0, 0.6, 0.7), (2, 0.0, 0.6, 0.7)], True),
        ([(1, 0.0, 0.6, 0.7), (2, 0.0, 0.7, 0.6)], False),
        ([(1, 0.0, 0.6, 0.7), (2, 0.0, 0.6, 0.6)], False),
        ([(1, 0.0, 0.6, 0.7)], False),
        ([(1, 0.0, 0.7, 0.6), (2, 0.0, 0.6, 0.7), (3, 0.0, 0.6, 0.7), (4, 0.0, 0.9, None)], True),
        ([], False),
    ],
)
def test_promotion(spark, rows, promote):
    row = governance.promotion_decision(table(spark, rows)).first()
    assert row["promote"] is promote
    if promote:
        assert row["cohorts"] == sorted(row["cohorts"]) and len(row["champion_auc_months"]) == 2


@pytest.mark.parametrize(
    ("rows", "champion", "challenger", "baseline", "reason"),
    [
        ([(1, 0.9, 0.1, None)], False, False, None, "no_champion"),
        ([(1, 0.9, 0.1, None)], True, True, 0.9, "challenger_in_shadow"),
        ([], True, False, 0.9, "no_monitoring"),
        ([(1, 0.9, 0.6, None), (2, 0.2, 0.6, None), (3, 0.2, 0.6, None), (4, 0.2, None, None)], True, False, 0.6, "stable"),
        ([(1, 0.2, 0.6, None), (2, 0.4, 0.6, None), (3, 0.4, 0.6, None), (4, None, None, None)], True, False, 0.6, "psi_breach"),
        ([(1, 0.0, 0.9, None), (2, 0.0, 0.6, None), (3, 0.0, None, None)], True, False, 0.66, "auc_decay"),
        ([(1, 0.0, 0.1, None)], True, False, 0.0, "stable"),
        ([(1, None, None, None)], True, False, 0.7, "stable"),
    ],
)
def test_retrain(spark, rows, champion, challenger, baseline, reason):
    row = governance.retrain_decision(
        table(spark, rows), F.lit(champion), F.lit(challenger), F.lit(baseline).cast("double")
    ).first()
    assert row["reason"] == reason
    trains = reason in ("no_champion", "psi_breach", "auc_decay")
    assert row["decision"] == (governance.TRAIN if trains else governance.SKIP)


def test_model_choice_counts_zero_as_missing(spark):
    rows = [("a", "oot", 0.0), ("a", "test", 0.6), ("b", "oot", 0.55), ("b", "test", 0.9), ("c", "test", None)]
    metrics = spark.createDataFrame(rows, "model string, split string, auc double")
    chosen = governance.select_model(metrics, ["a", "b", "c"])
    assert {r["model"] for r in chosen.where("is_champion").collect()} == {"a"}
    tied = spark.createDataFrame([("b", "oot", 0.6), ("a", "oot", 0.6)], "model string, split string, auc double")
    assert {r["model"] for r in governance.select_model(tied, ["b", "a"]).where("is_champion").collect()} == {"b"}


def test_registry_roles(spark):
    at = lambda d: F.lit(f"2024-01-0{d}").cast("timestamp")
    log = spark.createDataFrame([], "model_version string, role string, valid_from timestamp, reason string")
    assert governance.promotion(log, at(1)).count() == 0
    log = log.unionByName(governance.registration(log, "v1", at(1)))
    log = log.unionByName(governance.promotion(log, at(1), "bootstrap"))
    log = log.unionByName(governance.registration(log, "v2", at(2)))
    log = log.unionByName(governance.registration(log, "v3", at(3)))
    roles = {r["model_version"]: r["role"] for r in governance.current_roles(log).collect()}
    assert roles == {"v1": "champion", "v2": "archived", "v3": "challenger"}
    log = log.unionByName(governance.promotion(log, at(4)))
    roles = {r["model_version"]: r["role"] for r in governance.current_roles(log).collect()}
    assert roles == {"v1": "archived", "v2": "archived", "v3": "champion"}


def test_alerts_are_strictly_above_the_threshold(spark):
    rows = table(spark, [(1, 0.25, None, None), (2, 0.26, None, None), (3, None, None, None)])
    csi = spark.createDataFrame(
        [(dt.date(2023, 1, 1), "Age", 0.25), (dt.date(2023, 2, 1), "Age", 0.251)], "snapshot_date date, feature string, csi double"
    )
    alerts = monitoring.breach_alerts(rows, csi)
    assert {(r["snapshot_date"].month, r["type"]) for r in alerts.collect()} == {(2, "PSI_BREACH"), (2, "CSI_BREACH")}
    line = alerts.where("type = 'PSI_BREACH'").first()["line"]
    assert line == "2023-02-01 | PSI_BREACH | value=0.2600 | flag=retrain | feature=score"
    latest = monitoring.latest_alert(alerts).first()
    assert latest["n_alerts"] == 2 and "Age" in [a["feature"] for a in latest["alerts"]]


def test_drifted_features(spark):
    csi = spark.createDataFrame([("a", 0.1), ("a", 0.3), ("b", 0.25), ("c", None)], "feature string, csi double")
    assert [r["feature"] for r in governance.drifted_features(csi).collect()] == ["a"]
