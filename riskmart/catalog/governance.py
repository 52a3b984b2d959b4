"""Decision and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.catalog.base import CTE, predictions, query, sql_with, table
from riskmart.catalog.metrics import metrics_sql
from riskmart.catalog.monitoring import MON, base_table
from riskmart.catalog.stability import CSI, csi
from riskmart.operators.ranking import ranking_metrics
from riskmart.plans import governance, training_data

TRAIN_END = "1998-01-01"
TEST_END = "2000-01-01"
MODELS = ["discount", "tax", "price"]

CTE["candidates"] = f"""SELECT model, split, score, label FROM (SELECT unnest([
    {{'model': 'discount', 'score': score}}, {{'model': 'tax', 'score': challenger_score}},
    {{'model': 'price', 'score': price_score}}], recursive := true), label,
  CASE WHEN snapshot_date <= DATE '{TRAIN_END}' THEN 'train' WHEN snapshot_date <= DATE '{TEST_END}' THEN 'test'
    ELSE 'oot' END AS split FROM predictions)"""
CTE["candidate_metrics"] = metrics_sql("candidates", "model, split", "score", 5, False)


def candidate_metrics(spark, folder):
    scores = {"discount": "score", "tax": "challenger_score", "price": "price_score"}
    entries = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(s).alias("score")) for m, s in scores.items()]
    )
    split = training_data.split_name(F.col("snapshot_date"), TRAIN_END, TEST_END)
    rows = predictions(spark, folder).select("label", split.alias("split"), F.explode(entries).alias("_e"))
    return ranking_metrics(rows.select("label", "split", "_e.*"), ["model", "split"], min_rows=5)


@query(
    "model_selection",
    sql_with(
        ["predictions", "candidates", "candidate_metrics"],
        """SELECT m.model, split, round(auc, 6) AS auc, round(gini, 6) AS gini, round(ks, 6) AS ks,
        m.model = (SELECT model FROM best ORDER BY s DESC, list_position(['discount', 'tax', 'price'], model) LIMIT 1)
        AS is_champion FROM candidate_metrics m""",
        best="""SELECT model, coalesce(nullif(max(CASE WHEN split = 'oot' THEN auc END), 0),
          nullif(max(CASE WHEN split = 'test' THEN auc END), 0), 0) AS s FROM candidate_metrics GROUP BY model""",
    ),
)
def model_selection(spark, folder):
    chosen = governance.select_model(candidate_metrics(spark, folder), MODELS)
    return chosen.select(
        "model", "split", *[F.round(c, 6).alias(c) for c in ("auc", "gini", "ks")], "is_champion"
    )


@query(
    "promotion_decision",
    sql_with(
        MON,
        """SELECT count(*) = 2 AND bool_and(challenger_auc > auc) AS promote, CAST(count(*) AS INT) AS n_compared,
        string_agg(strftime(snapshot_date, '%Y-%m-%d'), ', ' ORDER BY snapshot_date) AS cohorts,
        round(sum(auc), 6) AS champion_auc, round(sum(challenger_auc), 6) AS challenger_auc FROM (
        SELECT * FROM mon WHERE auc IS NOT NULL AND challenger_auc IS NOT NULL ORDER BY snapshot_date DESC LIMIT 2)""",
    ),
)
def promotion_decision(spark, folder):
    decision = governance.promotion_decision(base_table(spark, folder))

    def total(column):
        return F.round(F.aggregate(column, F.lit(0.0), lambda a, x: a + x), 6)

    return decision.select(
        "promote",
        "n_compared",
        F.array_join(F.transform("cohorts", lambda d: F.date_format(d, "yyyy-MM-dd")), ", ").alias("cohorts"),
        total("champion_auc_months").alias("champion_auc"),
        total("challenger_auc_months").alias("challenger_auc"),
    )


@query(
    "retrain_decision",
    sql_with(
        MON,
        """SELECT CASE WHEN psi > 0.25 OR 0.6 - auc > 0.05 THEN 'train_challenger' ELSE 'skip_training' END AS decision,
        CASE WHEN psi > 0.25 THEN 'psi_breach' WHEN 0.6 - auc > 0.05 THEN 'auc_decay' ELSE 'stable' END AS reason,
        n_months, round(psi, 6) AS recent_psi, round(auc, 6) AS last_auc, CAST(0.6 AS DOUBLE) AS baseline_auc FROM (
        SELECT (SELECT count(*) FROM mon) AS n_months,
        (SELECT avg(psi_score) FROM (SELECT psi_score FROM mon WHERE psi_score IS NOT NULL
          ORDER BY snapshot_date DESC LIMIT 3)) AS psi,
        (SELECT auc FROM mon WHERE auc IS NOT NULL ORDER BY snapshot_date DESC LIMIT 1) AS auc)""",
    ),
)
def retrain_decision(spark, folder):
    decision = governance.retrain_decision(
        base_table(spark, folder), F.lit(True), F.lit(False), F.lit(0.6)
    )
    return decision.withColumns({c: F.round(c, 6) for c in ("recent_psi", "last_auc")})


@query(
    "drifted_features",
    sql_with(
        CSI,
        "SELECT feature, max(csi) AS max_csi FROM csi GROUP BY feature HAVING max(csi) > 0.02",
    ),
)
def drifted_features(spark, folder):
    return governance.drifted_features(csi(spark, folder), threshold=0.02)


CTE["registry"] = """SELECT CAST(o_custkey AS STRING) AS model_version,
  CASE o_orderstatus WHEN 'O' THEN 'challenger' WHEN 'P' THEN 'champion' ELSE 'archived' END AS role,
  CAST(o_orderdate AS DATE) AS valid_from, o_orderpriority AS reason, o_orderkey AS entry FROM orders"""


def registry(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS model_version",
        "CASE o_orderstatus WHEN 'O' THEN 'challenger' WHEN 'P' THEN 'champion' ELSE 'archived' END AS role",
        "CAST(o_orderdate AS DATE) AS valid_from",
        "o_orderpriority AS reason",
        "o_orderkey AS entry",
    )


@query(
    "registry_current_roles",
    sql_with(
        ["registry"],
        """SELECT model_version, role, valid_from, reason FROM registry QUALIFY
        row_number() OVER (PARTITION BY model_version ORDER BY valid_from DESC, entry DESC) = 1""",
    ),
)
def registry_current_roles(spark, folder):
    return governance.current_roles(registry(spark, folder), order=["valid_from", "entry"])


@query(
    "registry_promotion",
    sql_with(
        ["registry"],
        """SELECT model_version, CASE role WHEN 'challenger' THEN 'champion' ELSE 'archived' END AS role,
        DATE '2002-01-01' AS valid_from, 'won_consecutive_months' AS reason FROM (SELECT * FROM registry QUALIFY
        row_number() OVER (PARTITION BY model_version ORDER BY valid_from DESC, role DESC, reason DESC) = 1)
        WHERE role IN ('challenger', 'champion')""",
    ),
)
def registry_promotion(spark, folder):
    return governance.promotion(registry(spark, folder), F.lit("2002-01-01").cast("date"))
