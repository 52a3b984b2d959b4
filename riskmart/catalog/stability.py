"""PSI and CSI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.catalog.base import CTE, predictions, query, sql_with
from riskmart.catalog.metrics import (
    ITEM_FEATURES,
    MONTH,
    item_features,
    training_items,
)
from riskmart.functions.bands import stability_flag
from riskmart.operators.quantiles import PERCENTILES_1_99, exact_percentiles, long_features
from riskmart.operators.stability import decile_edges, quantile_psi, score_profile, unit_edges
from riskmart.plans import monitoring


def bin_case(score: str, n_bins: int) -> str:
    edges = unit_edges(n_bins)
    whens = " ".join(f"WHEN {score} >= {edges[i]:.17e} THEN {i}" for i in range(n_bins - 1, 0, -1))
    return f"CASE WHEN {score} IS NULL THEN NULL {whens} ELSE 0 END"


TERM = "(greatest({a}, 1e-6) - greatest({e}, 1e-6)) * ln(greatest({a}, 1e-6) / greatest({e}, 1e-6))"


def psi_views(prefix: str, source: str, score: str) -> dict[str, str]:
    """Views that end in ``<prefix>_rolling``: PSI against the three cohorts before."""
    return {
        f"{prefix}_months": f"""SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS idx
          FROM (SELECT DISTINCT snapshot_date FROM {source})""",
        f"{prefix}_counts": f"""SELECT snapshot_date, {bin_case(score, 10)} AS bin, count(*) AS n
          FROM {source} WHERE {score} IS NOT NULL GROUP BY ALL""",
        f"{prefix}_grid": f"""SELECT m.snapshot_date, m.idx, g.bin, coalesce(c.n, 0) AS n
          FROM {prefix}_months m CROSS JOIN (SELECT unnest(range(10)) AS bin) g
          LEFT JOIN {prefix}_counts c ON c.snapshot_date = m.snapshot_date AND c.bin = g.bin""",
        f"{prefix}_prior": f"""SELECT *, coalesce(sum(n) OVER (PARTITION BY bin ORDER BY idx
          ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS e FROM {prefix}_grid""",
        f"{prefix}_shares": f"""SELECT *, n / greatest(sum(n) OVER (PARTITION BY snapshot_date), 1) AS share,
          e / greatest(sum(e) OVER (PARTITION BY snapshot_date), 1) AS e_share,
          sum(e) OVER (PARTITION BY snapshot_date) AS e_total FROM {prefix}_prior""",
        f"{prefix}_rolling": f"""SELECT snapshot_date, CASE WHEN max(e_total) > 0 THEN
          sum({TERM.format(a="share", e="e_share")}) END AS psi FROM {prefix}_shares GROUP BY snapshot_date""",
    }


CTE |= psi_views("score_psi", "predictions", "score")
CTE |= psi_views("price_psi", "predictions", "price_score")
SCORE_PSI = [f"score_psi_{s}" for s in ("months", "counts", "grid", "prior", "shares", "rolling")]
PRICE_PSI = [f"price_psi_{s}" for s in ("months", "counts", "grid", "prior", "shares", "rolling")]


def flag_sql(value: str) -> str:
    return f"""CASE WHEN {value} IS NULL THEN 'unknown' WHEN {value} < 0.10 THEN 'stable'
      WHEN {value} < 0.25 THEN 'drift' ELSE 'retrain' END"""


@query(
    "psi_rolling",
    sql_with(
        ["predictions", *SCORE_PSI],
        f"SELECT snapshot_date, round(psi, 6) AS psi_score, {flag_sql('psi')} AS psi_flag FROM score_psi_rolling",
    ),
)
def psi_rolling(spark, folder):
    stability = monitoring.score_stability(score_profile(predictions(spark, folder)))
    return stability.select(MONTH, F.round("psi_score", 6).alias("psi_score"), "psi_flag")


@query(
    "psi_rolling_continuous_score",
    sql_with(["predictions", *PRICE_PSI], "SELECT snapshot_date, round(psi, 6) AS psi_score FROM price_psi_rolling"),
)
def psi_rolling_continuous_score(spark, folder):
    profile = score_profile(predictions(spark, folder), score="price_score")
    return monitoring.score_stability(profile).select(MONTH, F.round("psi_score", 6).alias("psi_score"))


TRAIN_SCORES_END = "1998-01-01"
PERCENTILE_LIST = "[" + ", ".join(f"{p:.17e}" for p in PERCENTILES_1_99) + "]"
CTE["reference_sample"] = f"""SELECT unnest(quantile_cont(price_score, {PERCENTILE_LIST})) AS s FROM predictions
  WHERE snapshot_date <= DATE '{TRAIN_SCORES_END}'"""
CTE["reference_shares"] = f"""SELECT g.bin, coalesce(r.n, 0) / 99 AS e_share FROM (SELECT unnest(range(10)) AS bin) g
  LEFT JOIN (SELECT {bin_case("s", 10)} AS bin, count(*) AS n FROM reference_sample GROUP BY ALL) r ON r.bin = g.bin"""


def training_score_sample(spark, folder):
    """The 99 stored percentiles of the training scores, taken as a sample."""
    training = predictions(spark, folder).where(F.col(MONTH) <= F.lit(TRAIN_SCORES_END).cast("date"))
    percentiles = exact_percentiles(training, [], "price_score", PERCENTILES_1_99)
    return percentiles.select(F.explode("percentiles").alias("score"))


@query(
    "psi_vs_training",
    sql_with(
        ["predictions", *PRICE_PSI[:5], "reference_sample", "reference_shares"],
        f"""SELECT snapshot_date, round(psi, 6) AS psi_vs_training, {flag_sql("psi")} AS flag FROM (
        SELECT snapshot_date, sum({TERM.format(a="s.share", e="r.e_share")}) AS psi
        FROM price_psi_shares s JOIN reference_shares r ON r.bin = s.bin GROUP BY snapshot_date)""",
    ),
)
def psi_vs_training(spark, folder):
    profile = score_profile(predictions(spark, folder), score="price_score")
    stability = monitoring.score_stability(profile, training_score_sample(spark, folder))
    return stability.select(
        MONTH,
        F.round("psi_vs_training", 6).alias("psi_vs_training"),
        stability_flag(F.col("psi_vs_training")).alias("flag"),
    )


def bins_sql(edges: str, value: str) -> str:
    return f"""CASE WHEN {value} < {edges}[1] OR {value} > {edges}[len({edges})] THEN NULL
      WHEN {value} = {edges}[len({edges})] THEN len({edges}) - 1
      ELSE len(list_filter({edges}, lambda x: x <= {value})) END"""


DECILE_LITERALS = "[0e0, 1e-1, 2e-1, 3e-1, 4e-1, 5e-1, 6e-1, 7e-1, 8e-1, 9e-1, 1e0]"
CTE["edges"] = f"""SELECT feature, list_sort(list_distinct(quantile_cont(value, {DECILE_LITERALS}))) AS edges
  FROM training_long GROUP BY feature"""
CTE["placed"] = f"""SELECT snapshot_date, feature, {bins_sql("edges", "value")} AS bin
  FROM items_long JOIN edges USING (feature)"""
CTE["csi_counts"] = "SELECT snapshot_date, feature, bin, count(*) AS n FROM placed GROUP BY ALL"
CTE["csi_grid"] = """SELECT t.snapshot_date, t.feature, t.total, t.n_bins, g.bin, coalesce(c.n, 0) AS n FROM (
    SELECT p.snapshot_date, p.feature, sum(p.n) AS total, any_value(len(e.edges)) - 1 AS n_bins
    FROM csi_counts p JOIN edges e ON e.feature = p.feature GROUP BY ALL) t
  CROSS JOIN (SELECT unnest(range(1, 11)) AS bin) g
  LEFT JOIN csi_counts c ON c.snapshot_date = t.snapshot_date AND c.feature = t.feature AND c.bin = g.bin
  WHERE g.bin <= t.n_bins"""
CTE["csi"] = f"""SELECT snapshot_date, feature, CASE WHEN any_value(n_bins) < 2 THEN 0.0
  ELSE round(sum({TERM.format(a="n / greatest(total, 1)", e="1.0 / n_bins")}), 6) END AS csi
  FROM csi_grid GROUP BY ALL"""
CSI = ["item_features", "training_items", "training_long", "items_long", "edges", "placed", "csi_counts", "csi_grid", "csi"]


def csi(spark, folder):
    edges = decile_edges(long_features(training_items(spark, folder), ITEM_FEATURES))
    return monitoring.csi_table(item_features(spark, folder), edges, ITEM_FEATURES)


query("csi_by_feature", sql_with(CSI, "SELECT snapshot_date, feature, csi FROM csi"))(csi)


@query(
    "feature_psi_quantile",
    sql_with(
        [*CSI[:6]],
        f"""SELECT feature, round(sum({TERM.format(a="a_share", e="e_share")}), 6) AS psi FROM (
        SELECT g.feature, g.bin, coalesce(a.n, 0) / (SELECT count(*) FROM items_long i WHERE i.feature = g.feature)
          AS a_share, coalesce(e.n, 0) / (SELECT count(*) FROM training_long i WHERE i.feature = g.feature) AS e_share
        FROM (SELECT feature, unnest(range(1, len(edges))) AS bin FROM edges) g
        LEFT JOIN (SELECT feature, bin, count(*) AS n FROM placed GROUP BY ALL) a
          ON a.feature = g.feature AND a.bin = g.bin
        LEFT JOIN (SELECT feature, {bins_sql("edges", "value")} AS bin, count(*) AS n
          FROM training_long JOIN edges USING (feature) GROUP BY ALL) e ON e.feature = g.feature AND e.bin = g.bin
        ) GROUP BY feature""",
    ),
)
def feature_psi_quantile(spark, folder):
    baseline = long_features(training_items(spark, folder), ITEM_FEATURES)
    current = long_features(item_features(spark, folder), ITEM_FEATURES)
    return quantile_psi(baseline, current).withColumn("psi", F.round("psi", 6))
