"""Model selection, promotion and retrain decisions, and the model registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.bands import RETRAIN_FROM
from riskmart.operators.recent import last_value, latest_entries, mean_of_last, present
from riskmart.schemas import MONTH

WINS_REQUIRED = 2
RECENT_MONTHS = 3
AUC_DROP = 0.05

TRAIN = "train_challenger"
SKIP = "skip_training"


def known(value: Column) -> Column:
    """An AUC, with 0 counted as missing."""
    return F.nullif(value, F.lit(0.0))


def selection_scores(metrics: DataFrame) -> DataFrame:
    """``model, selection_auc``: out-of-time AUC, else test AUC, else 0."""

    def of(split: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col("auc")))

    return metrics.groupBy("model").agg(
        F.coalesce(known(of("oot")), known(of("test")), F.lit(0.0)).alias("selection_auc")
    )


def select_model(metrics: DataFrame, model_order: Sequence[str]) -> DataFrame:
    """Model comparison with ``is_champion`` on the best model; the first listed wins ties."""
    position = F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model"))
    scores = selection_scores(metrics)
    best = scores.agg(F.max_by("model", F.struct("selection_auc", -position))).scalar()
    return metrics.withColumn("is_champion", F.col("model") == best)


def drifted_features(csi: DataFrame, threshold: float = RETRAIN_FROM) -> DataFrame:
    """Features whose highest CSI of all months is above the threshold."""
    return csi.groupBy("feature").agg(F.max("csi").alias("max_csi")).where(F.col("max_csi") > threshold)


def promotion_decision(monitoring: DataFrame, wins_required: int = WINS_REQUIRED) -> DataFrame:
    """One row: does the challenger win the last compared months, and the log of those months."""
    compared = present(F.col("auc")) & present(F.col("challenger_auc"))
    entry = F.struct(F.col(MONTH), F.col("auc"), F.col("challenger_auc"))
    recent = monitoring.agg(latest_entries(entry, compared, wins_required).alias("_newest"))
    ordered = F.sort_array("_newest")
    wins = F.forall("_newest", lambda e: e["challenger_auc"] > e["auc"])
    return recent.select(
        ((F.size("_newest") == wins_required) & wins).alias("promote"),
        F.size("_newest").alias("n_compared"),
        F.transform(ordered, lambda e: e["challenger_auc"]).alias("challenger_auc_months"),
        F.transform(ordered, lambda e: e["auc"]).alias("champion_auc_months"),
        F.transform(ordered, lambda e: e[MONTH]).alias("cohorts"),
    )


def retrain_decision(
    monitoring: DataFrame, has_champion: Column, has_challenger: Column, baseline_auc: Column
) -> DataFrame:
    """One row with the decision, its reason and the numbers behind it.

    ``baseline_auc`` is the champion's AUC at training time; null or 0 means unknown.
    """
    facts = monitoring.agg(
        F.count(F.lit(1)).alias("n_months"),
        mean_of_last(F.col("psi_score"), F.col(MONTH), RECENT_MONTHS).alias("recent_psi"),
        last_value(F.col("auc"), F.col(MONTH), present(F.col("auc"))).alias("last_auc"),
    ).withColumns(
        {
            "_champion": has_champion,
            "_challenger": has_challenger,
            "baseline_auc": known(baseline_auc),
        }
    )
    drop = F.col("baseline_auc") - F.col("last_auc")
    reason = (
        F.when(~F.col("_champion"), "no_champion")
        .when(F.col("_challenger"), "challenger_in_shadow")
        .when(F.col("n_months") == 0, "no_monitoring")
        .when(F.col("recent_psi") > RETRAIN_FROM, "psi_breach")
        .when(drop > AUC_DROP, "auc_decay")
        .otherwise("stable")
    )
    decided = facts.withColumn("reason", reason)
    trains = F.col("reason").isin("no_champion", "psi_breach", "auc_decay")
    return decided.select(
        F.when(trains, TRAIN).otherwise(SKIP).alias("decision"),
        "reason",
        "n_months",
        "recent_psi",
        "last_auc",
        "baseline_auc",
    )


# --- registry: an append-only log of (model_version, role, valid_from, reason) ---------


def current_roles(log: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Latest role of each model version: by ``sequence`` where the log has it, so times may tie."""
    if order is None:
        order = ["sequence"] if "sequence" in log.columns else ["valid_from"]
    if "valid_from" not in order:
        order = [*order, "valid_from"]
    latest = F.max(F.struct(*order, "role", "reason")).alias("_last")
    return log.groupBy("model_version").agg(latest).select(
        "model_version", "_last.role", "_last.valid_from", "_last.reason"
    )


def version_in_role(log: DataFrame, role: str) -> DataFrame:
    """``model_version`` now in a role, none or one row."""
    order = "sequence" if "sequence" in log.columns else "valid_from"
    latest = F.max(F.struct(order, "role")).alias("_last")
    holders = log.groupBy("model_version").agg(latest).where(F.col("_last.role") == role)
    return holders.agg(F.max_by("model_version", f"_last.{order}").alias("model_version")).where(
        F.col("model_version").isNotNull()
    )


def in_sequence(changes: DataFrame, log: DataFrame, first: str) -> DataFrame:
    """Number new log rows after those of ``log``; rows of the role ``first`` come before the others."""
    if "sequence" not in log.columns:
        return changes
    last = F.coalesce(log.agg(F.max("sequence")).scalar(), F.lit(0))
    return changes.withColumn("sequence", last + F.when(F.col("role") == first, 1).otherwise(2))


def registration(
    log: DataFrame, model_version: str, at: Column, reason: str = "trained"
) -> DataFrame:
    """Rows to append when a challenger is trained; without a champion it is promoted at once.

    A challenger already in shadow is replaced.
    """
    spark = log.sparkSession
    challenger = spark.range(1).select(
        F.lit(model_version).alias("model_version"),
        F.lit("challenger").alias("role"),
        at.alias("valid_from"),
        F.lit(reason).alias("reason"),
    )
    replaced = version_in_role(log, "challenger").select(
        "model_version",
        F.lit("archived").alias("role"),
        at.alias("valid_from"),
        F.lit("replaced").alias("reason"),
    )
    rows = challenger.unionByName(replaced.where(F.col("model_version") != model_version))
    return in_sequence(rows, log, "archived")


def promotion(log: DataFrame, at: Column, reason: str = "won_consecutive_months") -> DataFrame:
    """Rows to append on promotion: challenger to champion, old champion to archive.

    Without a challenger there is nothing to append.
    """
    roles = current_roles(log).where(F.col("role").isin("challenger", "champion"))
    has_challenger = roles.agg(F.max(F.col("role") == "challenger")).scalar()
    rows = roles.where(has_challenger).select(
        "model_version",
        F.when(F.col("role") == "challenger", "champion").otherwise("archived").alias("role"),
        at.alias("valid_from"),
        F.lit(reason).alias("reason"),
    )
    return in_sequence(rows, log, "archived")
