"""AUC, Gini and KS per group, exact with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.operators.running import running_sums


def count_by_score(
    scored: DataFrame, by: Sequence[str], score: str, positives: Column, negatives: Column
) -> DataFrame:
    """One row per (by, score): ``n_pos`` and ``n_neg``, and ``u_pos`` and ``u_neg`` where there is no score."""
    usable = scored
    for name in by:
        usable = usable.where(F.col(name).isNotNull())
    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    counts = usable.groupBy(*by, value.alias("_score")).agg(
        F.sum(positives.cast("bigint")).alias("pos"), F.sum(negatives.cast("bigint")).alias("neg")
    )
    ranked = F.col("_score").isNotNull()
    zero = F.lit(0).cast("bigint")
    return counts.select(
        *by,
        "_score",
        *[F.when(ranked, F.col(c)).otherwise(zero).alias(f"n_{c}") for c in ("pos", "neg")],
        *[F.when(ranked, zero).otherwise(F.col(c)).alias(f"u_{c}") for c in ("pos", "neg")],
    )


def ranking_metrics(
    scored: DataFrame,
    by: Sequence[str],
    score: str = "score",
    label: str = "label",
    positives: Column | None = None,
    negatives: Column | None = None,
    min_rows: int = 10,
) -> DataFrame:
    """``n_scored, default_rate, auc, gini, ks`` per group.

    ``positives`` and ``negatives`` replace the 0/1 ``label`` when a row stands for several
    labelled rows. The default rate and the guards are taken over all labelled rows, those
    without a score too: with fewer than ``min_rows`` all metrics are null, with one class only
    the default rate is given. AUC, Gini and KS rank the rows that have a score.
    """
    pos = positives if positives is not None else F.when(F.col(label) == 1, 1).otherwise(0)
    neg = negatives if negatives is not None else F.when(F.col(label) == 0, 1).otherwise(0)
    counts = count_by_score(scored, by, score, pos, neg)
    ranked = running_sums(counts, by, "_score", ["n_pos", "n_neg"])

    share_pos = F.try_divide(
        (F.col("below_n_pos") + F.col("n_pos")).cast("double"), F.col("total_n_pos").cast("double")
    )
    share_neg = F.try_divide(
        (F.col("below_n_neg") + F.col("n_neg")).cast("double"), F.col("total_n_neg").cast("double")
    )
    pairs_won = F.col("n_pos").cast("double") * (
        F.col("below_n_neg").cast("double") + F.lit(0.5) * F.col("n_neg").cast("double")
    )
    summary = ranked.groupBy(*by).agg(
        F.sum("n_pos").alias("_pos"),
        F.sum("n_neg").alias("_neg"),
        (F.sum("n_pos") + F.sum("u_pos")).alias("_all_pos"),
        (F.sum("n_neg") + F.sum("u_neg")).alias("_all_neg"),
        F.sum(pairs_won).alias("_won"),
        F.max(F.abs(share_pos - share_neg)).alias("_ks"),
    )
    n = F.col("_all_pos") + F.col("_all_neg")
    enough = n >= min_rows
    rankable = enough & (F.col("_all_pos") > 0) & (F.col("_all_neg") > 0)
    auc = F.try_divide(F.col("_won"), F.col("_pos").cast("double") * F.col("_neg").cast("double"))
    return summary.select(
        *by,
        (F.col("_pos") + F.col("_neg")).alias("n_scored"),
        F.when(enough, F.try_divide(F.col("_all_pos").cast("double"), n.cast("double"))).alias("default_rate"),
        F.when(rankable, auc).alias("auc"),
        F.when(rankable, F.lit(2.0) * auc - F.lit(1.0)).alias("gini"),
        F.when(rankable, F.col("_ks")).alias("ks"),
    )


def join_predictions(
    predictions: DataFrame,
    labels: DataFrame,
    keys: Sequence[str],
    scores: Sequence[str] = ("score",),
    label: str = "label",
) -> DataFrame:
    """Inner join of predictions to labels with weights instead of repeated rows.

    Duplicates on either side multiply in a row join. Here the labels are combined per key
    and label value first: each prediction comes out once per label value and stands for
    ``n_pos`` + ``n_neg`` joined rows. A key is then only hot on the left. Both inputs of the
    join are plain shuffles (the labels are grouped by one column more than the keys), which
    is what lets adaptive execution split a hot key.
    """
    counts = labels.groupBy(*keys, F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    joined = predictions.select(*keys, *scores).join(counts, list(keys))
    return joined.select(
        *keys,
        *scores,
        F.when(F.col("_label") == 1, F.col("_n")).otherwise(0).alias("n_pos"),
        F.when(F.col("_label") == 0, F.col("_n")).otherwise(0).alias("n_neg"),
    )
