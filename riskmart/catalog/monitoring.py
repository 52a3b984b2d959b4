"""Monitoring table, alerts and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.catalog.base import CTE, observed_labels, predictions, query, sql_with
from riskmart.catalog.metrics import ITEM_FEATURES, MONTH, metrics_sql
from riskmart.catalog.stability import CSI, SCORE_PSI, csi, flag_sql
from riskmart.operators.stability import unit_edges
from riskmart.plans import monitoring

CTE["challenger_joined"] = metrics_sql("scored_labels", "snapshot_date", "challenger_score", 10, True)
CTE["cohort_stats"] = """SELECT snapshot_date, count(*) AS n_predictions, avg(score) AS mean_score,
  stddev_pop(score) AS std_score FROM predictions GROUP BY snapshot_date"""
CTE["mon"] = f"""SELECT s.snapshot_date, s.n_predictions, s.mean_score, s.std_score, p.psi AS psi_score,
  {flag_sql("p.psi")} AS psi_flag, m.auc, m.gini, m.ks, m.default_rate,
  CASE WHEN m.auc IS NOT NULL AND c.n_scored >= 10 THEN c.auc END AS challenger_auc,
  coalesce(c.n_scored >= 10 AND c.auc > m.auc, false) AS challenger_wins
  FROM cohort_stats s JOIN score_psi_rolling p ON p.snapshot_date = s.snapshot_date
  LEFT JOIN joined_metrics m ON m.snapshot_date = s.snapshot_date
  LEFT JOIN challenger_joined c ON c.snapshot_date = s.snapshot_date"""
MON = [
    "predictions",
    *SCORE_PSI,
    "observed_labels",
    "label_weights",
    "scored_labels",
    "joined_metrics",
    "challenger_joined",
    "cohort_stats",
    "mon",
]
DOUBLES = ["mean_score", "std_score", "psi_score", "auc", "gini", "ks", "default_rate", "challenger_auc"]


def base_table(spark, folder):
    return monitoring.monitoring_table(predictions(spark, folder), observed_labels(spark, folder)).drop(
        "psi_vs_training"
    )


def six(df, columns):
    return df.withColumns({c: F.round(c, 6) for c in columns if c in df.columns})


def six_sql(columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


CTE["csi_columns"] = "SELECT snapshot_date, " + ", ".join(
    f"max(CASE WHEN feature = '{f}' THEN csi END) AS csi_{f}" for f in ITEM_FEATURES
) + " FROM csi GROUP BY snapshot_date"


@query(
    "monitoring_table",
    sql_with(
        [*MON, *CSI, "csi_columns"],
        f"""SELECT mon.snapshot_date, n_predictions, psi_flag, challenger_wins, {six_sql(DOUBLES)},
        {", ".join(f"csi_{f}" for f in ITEM_FEATURES)}
        FROM mon LEFT JOIN csi_columns ON mon.snapshot_date = csi_columns.snapshot_date""",
    ),
)
def monitoring_table(spark, folder):
    table = monitoring.monitoring_table(
        predictions(spark, folder), observed_labels(spark, folder), None, csi(spark, folder), ITEM_FEATURES
    ).drop("psi_vs_training")
    return six(table, DOUBLES).orderBy(MONTH)


@query(
    "challenger_comparison",
    sql_with(
        MON,
        f"""SELECT snapshot_date, {six_sql(["auc", "challenger_auc"])}, challenger_wins FROM mon
        WHERE auc IS NOT NULL""",
    ),
)
def challenger_comparison(spark, folder):
    return six(monitoring.challenger_report(base_table(spark, folder)), DOUBLES)


CTE["psi_alerts"] = """SELECT snapshot_date, 'PSI_BREACH' AS type, 'score' AS feature, round(psi_score, 6) AS value,
  'retrain' AS flag FROM mon WHERE psi_score > 0.25"""
CTE["csi_alerts"] = """SELECT snapshot_date, 'CSI_BREACH' AS type, feature, round(csi, 6) AS value, 'retrain' AS flag
  FROM csi WHERE csi > 0.25"""
CTE["alerts"] = """SELECT *, concat_ws(' | ', strftime(snapshot_date, '%Y-%m-%d'), type,
  concat('value=', printf('%.4f', value)), concat('flag=', flag), concat('feature=', feature)) AS line
  FROM (SELECT * FROM psi_alerts UNION ALL SELECT * FROM csi_alerts)"""
ALERTS = [*MON, *CSI, "psi_alerts", "csi_alerts", "alerts"]


def alerts(spark, folder):
    return monitoring.breach_alerts(base_table(spark, folder), csi(spark, folder))


query("breach_alerts", sql_with(ALERTS, "SELECT * FROM alerts"))(alerts)


@query(
    "latest_alert",
    sql_with(
        ALERTS,
        """SELECT snapshot_date, count(*) AS n_alerts, string_agg(concat(type, ':', feature), ',' ORDER BY type, feature)
        AS alerts FROM alerts WHERE snapshot_date = (SELECT max(snapshot_date) FROM alerts) GROUP BY snapshot_date""",
    ),
)
def latest_alert(spark, folder):
    latest = monitoring.latest_alert(alerts(spark, folder))
    names = F.transform("alerts", lambda a: F.concat(a["type"], F.lit(":"), a["feature"]))
    return latest.select(MONTH, "n_alerts", F.array_join(names, ",").alias("alerts"))


@query(
    "performance_report",
    sql_with(
        MON,
        f"""SELECT snapshot_date, {six_sql(["auc", "gini", "ks"])}, auc < 0.6 AS auc_below_floor,
        gini < 0.2 AS gini_below_floor, ks < 0.1 AS ks_below_floor FROM mon WHERE auc IS NOT NULL""",
    ),
)
def performance_report(spark, folder):
    return six(monitoring.performance_report(base_table(spark, folder)), ["auc", "gini", "ks"])


@query(
    "report_bands",
    sql_with(
        [*MON, *CSI],
        """SELECT snapshot_date, feature, round(value, 6) AS value, CASE WHEN value < 0.10 THEN 'green'
        WHEN value < 0.25 THEN 'orange' ELSE 'red' END AS band FROM (
        SELECT snapshot_date, 'score' AS feature, coalesce(psi_score, 0) AS value FROM mon
        UNION ALL SELECT snapshot_date, feature, csi FROM csi)""",
    ),
)
def report_bands(spark, folder):
    return six(monitoring.stability_report(base_table(spark, folder), csi(spark, folder)), ["value"])


def _twenty(score: str) -> str:
    edges = unit_edges(20)
    whens = " ".join(f"WHEN {score} >= {edges[i]:.17e} THEN {i}" for i in range(19, 0, -1))
    return f"CASE {whens} ELSE 0 END"


@query(
    "score_histogram",
    sql_with(
        ["predictions"],
        """SELECT m.snapshot_date, CAST(g.bin AS INT) AS bin, round(g.bin / 20, 6) AS low,
        round((g.bin + 1) / 20, 6) AS high, coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / (m.total * 0.05), 6) AS density
        FROM recent m CROSS JOIN (SELECT unnest(range(20)) AS bin) g
        LEFT JOIN counted c ON c.snapshot_date = m.snapshot_date AND c.bin = g.bin""",
        inside="SELECT snapshot_date, score FROM predictions WHERE score BETWEEN 0 AND 1",
        recent="""SELECT snapshot_date, count(*) AS total FROM inside WHERE snapshot_date IN (
          SELECT DISTINCT snapshot_date FROM predictions ORDER BY 1 DESC LIMIT 12) GROUP BY ALL""",
        counted=f"SELECT snapshot_date, {_twenty('score')} AS bin, count(*) AS n FROM inside GROUP BY ALL",
    ),
)
def score_histogram(spark, folder):
    return six(monitoring.score_histogram(predictions(spark, folder)), ["low", "high", "density"])


DRIFT = ["default_rate", "mean_rate", "monitor_band", "investigate_band"]


@query(
    "label_drift_bands",
    sql_with(
        MON,
        f"""SELECT snapshot_date, {six_sql(DRIFT)} FROM (SELECT snapshot_date, default_rate,
        avg(default_rate) OVER () AS mean_rate, avg(default_rate) OVER () * 1.2 AS monitor_band,
        avg(default_rate) OVER () * 1.4 AS investigate_band FROM mon WHERE default_rate IS NOT NULL)""",
    ),
)
def label_drift_bands(spark, folder):
    return six(monitoring.label_drift_report(base_table(spark, folder)), DRIFT)
