"""Monitoring table, breach alerts and report tables, all cohorts in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions.bands import RETRAIN_FROM, alert_line, stability_colour, stability_flag
from riskmart.operators.quantiles import long_features
from riskmart.operators.ranking import join_predictions, ranking_metrics
from riskmart.operators.recent import present
from riskmart.operators.stability import (
    bin_counts,
    bin_index,
    bin_names,
    covariate_shift,
    previous_bins,
    psi,
    sample_bins,
    score_profile,
    unit_edges,
)
from riskmart.schemas import CUSTOMER, MONTH

# Floors shown in the performance report.
AUC_FLOOR = 0.60
GINI_FLOOR = 0.20
KS_FLOOR = 0.10
# Fixed value: rows with a challenger score needed for a comparison.
MIN_COMPARED = 10


def by_model(scored: DataFrame) -> DataFrame:
    """Two rows per scored row: one with the champion's score, one with the challenger's."""
    models = F.array(
        F.struct(F.lit("champion").alias("model"), F.col("score").cast("double").alias("score")),
        F.struct(F.lit("challenger").alias("model"), F.col("challenger_score").cast("double").alias("score")),
    )
    return scored.select(MONTH, "n_pos", "n_neg", F.explode(models).alias("_m")).select(
        MONTH, "n_pos", "n_neg", "_m.model", "_m.score"
    )


def cohort_performance(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Champion AUC, Gini, KS and default rate per month, and the challenger's AUC beside it.

    Both models are ranked in the same pass.
    """
    if "challenger_score" not in predictions.columns:
        predictions = predictions.withColumn("challenger_score", F.lit(None).cast("double"))
    joined = join_predictions(predictions, labels, [CUSTOMER, MONTH], ["score", "challenger_score"])
    metrics = ranking_metrics(
        by_model(joined), [MONTH, "model"], positives=F.col("n_pos"), negatives=F.col("n_neg")
    )

    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(column)))

    wide = metrics.groupBy(MONTH).agg(
        *[of("champion", c).alias(c) for c in ("auc", "gini", "ks", "default_rate")],
        F.max(F.when((F.col("model") == "challenger") & (F.col("n_scored") >= MIN_COMPARED), F.col("auc"))).alias(
            "_challenger_auc"
        ),
    )
    return wide.select(
        MONTH,
        "auc",
        "gini",
        "ks",
        "default_rate",
        F.when(F.col("auc").isNotNull(), F.col("_challenger_auc")).alias("challenger_auc"),
    )


def score_stability(
    profile: DataFrame, training_scores: DataFrame | None = None, training_score: str = "score"
) -> DataFrame:
    """Rolling PSI, its flag and the PSI against a reference sample of training scores."""
    reference = (
        sample_bins(training_scores, training_score).scalar()
        if training_scores is not None
        else F.lit(None).cast("array<bigint>")
    )
    return (
        profile.withColumns({"_previous": previous_bins(), "_reference": reference})
        .select(
            MONTH,
            "n_predictions",
            "mean_score",
            "std_score",
            psi(F.col("_previous"), F.col("bins")).alias("psi_score"),
            psi(F.col("_reference"), F.col("bins")).alias("psi_vs_training"),
        )
        .withColumn("psi_flag", stability_flag(F.col("psi_score")))
    )


def csi_table(feature_store: DataFrame, edges: DataFrame, features: Sequence[str]) -> DataFrame:
    """``snapshot_date, feature, csi`` for those tracked features the store has."""
    tracked = [c for c in features if c in feature_store.columns]
    return covariate_shift(long_features(feature_store, tracked, [MONTH]), edges)


def csi_wide(csi: DataFrame, features: Sequence[str]) -> DataFrame:
    """One ``csi_<feature>`` column per feature."""
    return csi.groupBy(MONTH).agg(
        *[F.max(F.when(F.col("feature") == f, F.col("csi"))).alias(f"csi_{f}") for f in features]
    )


def monitoring_table(
    predictions: DataFrame,
    labels: DataFrame,
    training_scores: DataFrame | None = None,
    csi: DataFrame | None = None,
    csi_features: Sequence[str] = (),
) -> DataFrame:
    """One row per scored month: stability, performance, challenger comparison and CSI."""
    return assemble(
        score_profile(predictions), cohort_performance(predictions, labels), training_scores, csi, csi_features
    )


def assemble(
    profile: DataFrame,
    performance: DataFrame,
    training_scores: DataFrame | None = None,
    csi: DataFrame | None = None,
    csi_features: Sequence[str] = (),
) -> DataFrame:
    """The monitoring table from what is stored of each month: bin counts, metrics and CSI."""
    stability = score_stability(profile, training_scores)
    table = stability.join(performance, MONTH, "left").withColumn(
        "challenger_wins", challenger_wins(F.col("auc"), F.col("challenger_auc"))
    )
    if csi is not None and csi_features:
        table = table.join(csi_wide(csi, csi_features), MONTH, "left")
    return table


def in_shadow(monitoring: DataFrame, versions: DataFrame, challenger: str, after: Column) -> DataFrame:
    """The monitoring table with the challenger's AUC only where it says something of this challenger.

    ``versions`` has the ``challenger_model_version`` that scored each month; only later months
    than ``after``, the last one scored before the challenger was registered, count.
    """
    own = (F.col("challenger_model_version") == challenger) & (after.isNull() | (F.col(MONTH) > after))
    return monitoring.join(versions.select(MONTH, "challenger_model_version"), MONTH, "left").withColumn(
        "challenger_auc", F.when(own, F.col("challenger_auc"))
    )


def challenger_wins(champion_auc: Column, challenger_auc: Column) -> Column:
    """Strictly better; false when either is unknown."""
    return F.coalesce(challenger_auc > champion_auc, F.lit(False))


def breach_alerts(
    monitoring: DataFrame, csi: DataFrame | None = None, threshold: float = RETRAIN_FROM
) -> DataFrame:
    """Alerts for values strictly above the threshold, with their log line."""

    def alert(kind: str, feature: Column, value: Column) -> list[Column]:
        return [
            F.col(MONTH),
            F.lit(kind).alias("type"),
            feature.alias("feature"),
            F.round(value, 6).alias("value"),
            F.lit("retrain").alias("flag"),
        ]

    alerts = monitoring.where(present(F.col("psi_score")) & (F.col("psi_score") > threshold)).select(
        *alert("PSI_BREACH", F.lit("score"), F.col("psi_score"))
    )
    if csi is not None:
        alerts = alerts.unionByName(
            csi.where(F.col("csi") > threshold).select(
                *alert("CSI_BREACH", F.col("feature"), F.col("csi"))
            )
        )
    return alerts.withColumn(
        "line",
        alert_line(F.col(MONTH), F.col("type"), F.col("value"), F.col("flag"), F.col("feature")),
    )


def latest_alert(alerts: DataFrame) -> DataFrame:
    """The last month that raised alerts: when, how many, and all of them as nested rows."""
    last = alerts.agg(F.max(MONTH)).scalar()
    entries = F.sort_array(F.collect_list(F.struct("type", "feature", "value", "flag")))
    when = [F.max("raised_at").alias("timestamp")] if "raised_at" in alerts.columns else []
    return (
        alerts.where(F.col(MONTH) == last)
        .groupBy(MONTH)
        .agg(*when, F.count(F.lit(1)).alias("n_alerts"), entries.alias("alerts"))
    )


# --- report tables --------------------------------------------------------------------


def performance_report(monitoring: DataFrame) -> DataFrame:
    """AUC, Gini and KS of labelled cohorts against their floors."""
    return monitoring.where(present(F.col("auc"))).select(
        MONTH,
        "auc",
        "gini",
        "ks",
        (F.col("auc") < AUC_FLOOR).alias("auc_below_floor"),
        (F.col("gini") < GINI_FLOOR).alias("gini_below_floor"),
        (F.col("ks") < KS_FLOOR).alias("ks_below_floor"),
    )


def stability_report(monitoring: DataFrame, csi: DataFrame | None = None) -> DataFrame:
    """Colour band of the score PSI and of each CSI per month, unknown shown as 0."""
    rows = monitoring.select(MONTH, F.lit("score").alias("feature"), F.col("psi_score").alias("value"))
    if csi is not None:
        rows = rows.unionByName(csi.select(MONTH, "feature", F.col("csi").alias("value")))
    return rows.select(
        MONTH,
        "feature",
        F.coalesce("value", F.lit(0.0)).alias("value"),
        stability_colour(F.col("value")).alias("band"),
    )


def recent_cohorts(per_month: DataFrame, n: int, order: str = MONTH) -> DataFrame:
    """The last ``n`` rows of a one-row-per-month table."""
    newest = Window.orderBy(F.desc(order))
    return per_month.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).drop("_rn")


def score_histogram(predictions: DataFrame, n_bins: int = 20, cohorts: int = 12) -> DataFrame:
    """Score density per cohort, last ``cohorts`` cohorts; scores outside [0, 1] are left out."""
    binned = predictions.select(MONTH, bin_index(F.col("score"), n_bins, clip=False).alias("_bin"))
    counted = binned.groupBy(MONTH).agg(*bin_counts("_bin", n_bins))
    recent = recent_cohorts(counted, cohorts)
    edges = unit_edges(n_bins)
    bins = F.array(
        *[
            F.struct(
                F.lit(i).alias("bin"),
                F.lit(edges[i]).alias("low"),
                F.lit(edges[i + 1]).alias("high"),
                F.col(name).alias("n"),
            )
            for i, name in enumerate(bin_names(n_bins))
        ]
    )
    total = sum(F.col(name) for name in bin_names(n_bins))
    return (
        recent.withColumn("_total", total)
        .where(F.col("_total") > 0)
        .select(MONTH, "_total", F.explode(bins).alias("_b"))
        .select(
            MONTH,
            "_b.bin",
            "_b.low",
            "_b.high",
            "_b.n",
            (F.col("_b.n") / (F.col("_total") * F.lit(1.0 / n_bins))).alias("density"),
        )
    )


def label_drift_report(monitoring: DataFrame) -> DataFrame:
    """Default rate per cohort with the mean of all cohorts and its +20% and +40% bands."""
    labelled = monitoring.where(present(F.col("default_rate"))).select(MONTH, "default_rate")
    mean = F.avg("default_rate").over(Window.partitionBy())
    return labelled.withColumn("mean_rate", mean).select(
        MONTH,
        "default_rate",
        "mean_rate",
        (F.col("mean_rate") * 1.20).alias("monitor_band"),
        (F.col("mean_rate") * 1.40).alias("investigate_band"),
    )


def challenger_report(monitoring: DataFrame) -> DataFrame:
    """Champion and challenger AUC of labelled cohorts, months won marked."""
    return monitoring.where(present(F.col("auc"))).select(
        MONTH, "auc", "challenger_auc", "challenger_wins"
    )
