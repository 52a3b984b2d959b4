"""Queries on ranking metrics, percentiles and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.catalog.base import CTE, observed_labels, predictions, query, sql_with, table
from riskmart.operators.quantiles import DECILES, exact_medians, exact_percentiles, long_features
from riskmart.operators.ranking import join_predictions, ranking_metrics
from riskmart.operators.stability import score_profile
from riskmart.plans import preprocessing, training_data

MONTH = "snapshot_date"


def metrics_sql(source: str, by: str, score: str, min_rows: int, weighted: bool) -> str:
    """Default rate and guards over all labelled rows of a group, ranks over those with a score."""
    pos = "n_pos" if weighted else "CASE WHEN label = 1 THEN 1 ELSE 0 END"
    neg = "n_neg" if weighted else "CASE WHEN label = 0 THEN 1 ELSE 0 END"
    known = " AND ".join(f"{c.strip()} IS NOT NULL" for c in by.split(","))
    return f"""WITH labelled AS (
      SELECT {by}, {score} AS s, CAST({pos} AS DOUBLE) AS pos, CAST({neg} AS DOUBLE) AS neg
      FROM {source} WHERE {known}
    ), whole AS (
      SELECT {by}, sum(pos) AS all_pos, sum(neg) AS all_neg,
        coalesce(sum(pos) FILTER (s IS NOT NULL), 0) AS p, coalesce(sum(neg) FILTER (s IS NOT NULL), 0) AS n
      FROM labelled GROUP BY {by}
    ), steps AS (
      SELECT {by}, s, sum(pos) AS pos, sum(neg) AS neg FROM labelled WHERE s IS NOT NULL GROUP BY {by}, s
    ), sums AS (
      SELECT *, sum(pos) OVER (PARTITION BY {by} ORDER BY s) AS cp, sum(neg) OVER (PARTITION BY {by} ORDER BY s) AS cn
      FROM steps
    ), ranked AS (
      SELECT {by}, sum(pos * (cn - 0.5 * neg)) AS won, max(abs(cp / nullif(p, 0) - cn / nullif(n, 0))) AS ks
      FROM sums JOIN whole USING ({by}) GROUP BY {by}
    ), guarded AS (
      SELECT *, all_pos + all_neg >= {min_rows} AS enough, all_pos > 0 AND all_neg > 0 AS both_classes
      FROM whole LEFT JOIN ranked USING ({by})
    )
    SELECT {by}, CAST(p + n AS BIGINT) AS n_scored,
      CASE WHEN enough THEN all_pos / (all_pos + all_neg) END AS default_rate,
      CASE WHEN enough AND both_classes THEN won / nullif(p * n, 0) END AS auc,
      CASE WHEN enough AND both_classes THEN 2 * won / nullif(p * n, 0) - 1 END AS gini,
      CASE WHEN enough AND both_classes THEN ks END AS ks
    FROM guarded"""


ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in ("default_rate", "auc", "gini", "ks"))


def rounded(metrics, *by):
    return metrics.select(
        *by, "n_scored", *[F.round(c, 6).alias(c) for c in ("default_rate", "auc", "gini", "ks")]
    )


CTE["champion_metrics"] = metrics_sql("predictions", "snapshot_date", "score", 10, False)
CTE["price_metrics"] = metrics_sql("predictions", "snapshot_date", "price_score", 10, False)
CTE["label_weights"] = """SELECT Customer_ID, snapshot_date, count(*) FILTER (label = 1) AS n_pos,
  count(*) FILTER (label = 0) AS n_neg FROM observed_labels GROUP BY ALL"""
CTE["scored_labels"] = """SELECT p.snapshot_date, p.score, p.challenger_score, l.n_pos, l.n_neg FROM predictions p
  JOIN label_weights l ON l.Customer_ID = p.Customer_ID AND l.snapshot_date = p.snapshot_date"""
CTE["joined_metrics"] = metrics_sql("scored_labels", "snapshot_date", "score", 10, True)


@query(
    "cohort_auc_gini_ks",
    sql_with(["predictions", "champion_metrics"], f"SELECT snapshot_date, n_scored, {ROUNDED} FROM champion_metrics"),
)
def cohort_auc_gini_ks(spark, folder):
    return rounded(ranking_metrics(predictions(spark, folder), [MONTH]), MONTH)


@query(
    "cohort_auc_continuous_score",
    sql_with(["predictions", "price_metrics"], f"SELECT snapshot_date, n_scored, {ROUNDED} FROM price_metrics"),
)
def cohort_auc_continuous_score(spark, folder):
    return rounded(ranking_metrics(predictions(spark, folder), [MONTH], score="price_score"), MONTH)


@query(
    "joined_auc_gini_ks",
    sql_with(
        ["predictions", "observed_labels", "label_weights", "scored_labels", "joined_metrics"],
        f"SELECT snapshot_date, n_scored, {ROUNDED} FROM joined_metrics",
    ),
)
def joined_auc_gini_ks(spark, folder):
    joined = join_predictions(
        predictions(spark, folder), observed_labels(spark, folder), ["Customer_ID", MONTH]
    )
    metrics = ranking_metrics(joined, [MONTH], positives=F.col("n_pos"), negatives=F.col("n_neg"))
    return rounded(metrics, MONTH)


@query(
    "scored_documents_by_language",
    f"""WITH scored AS (SELECT lang, n_chars / 20000.0 AS score, quality AS label
      FROM documents JOIN labels ON documents.doc_id = labels.doc_id),
    m AS ({metrics_sql("scored", "lang", "score", 10, False)})
    SELECT lang, n_scored, {ROUNDED} FROM m""",
)
def scored_documents_by_language(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    scored = documents.join(table(spark, folder, "labels"), "doc_id").select(
        "lang", (F.col("n_chars") / F.lit(20000.0)).alias("score"), F.col("quality").alias("label")
    )
    return rounded(ranking_metrics(scored, ["lang"]), "lang")


@query(
    "score_stats_by_cohort",
    sql_with(
        ["predictions"],
        """SELECT snapshot_date, count(*) AS n_predictions, count(score) AS n_scores,
        round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score
        FROM predictions GROUP BY snapshot_date""",
    ),
)
def score_stats_by_cohort(spark, folder):
    profile = score_profile(predictions(spark, folder))
    return profile.select(
        MONTH,
        "n_predictions",
        "n_scores",
        F.round("mean_score", 6).alias("mean_score"),
        F.round("std_score", 6).alias("std_score"),
    )


TRAIN_MONTHS = "1998-01-01"
ITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def item_features(spark, folder):
    from riskmart.functions.loans import month_start

    return table(spark, folder, "lineitem").select(
        month_start(F.col("l_shipdate")).alias(MONTH), *ITEM_FEATURES
    )


def training_items(spark, folder):
    return item_features(spark, folder).where(F.col(MONTH) <= F.lit(TRAIN_MONTHS).cast("date"))


CTE["item_features"] = """SELECT make_date(CAST(year(l_shipdate) AS INT), CAST(month(l_shipdate) AS INT), 1)
  AS snapshot_date, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"""
CTE["training_items"] = f"SELECT * FROM item_features WHERE snapshot_date <= DATE '{TRAIN_MONTHS}'"
CTE["training_long"] = "UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM training_items) ON COLUMNS(*) INTO NAME feature VALUE value"
CTE["items_long"] = """UNPIVOT item_features ON l_quantity, l_extendedprice, l_discount, l_tax
  INTO NAME feature VALUE value"""
DECILE_LIST = "[" + ", ".join(str(p) for p in DECILES) + "]"


@query(
    "feature_baseline_stats",
    sql_with(
        ["item_features", "training_items", "training_long"],
        f"""SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std,
        CAST(generate_subscripts(q, 1) * 10 - 10 AS INT) AS percentile, round(unnest(q), 6) AS value FROM (
        SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, quantile_cont(value, {DECILE_LIST}) AS q
        FROM training_long GROUP BY feature)""",
    ),
)
def feature_baseline_stats(spark, folder):
    baseline = training_data.feature_baseline(training_items(spark, folder), ITEM_FEATURES)
    return baseline.select(
        "feature",
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
        F.posexplode("percentiles").alias("position", "value"),
    ).select(
        "feature", "mean", "std", (F.col("position") * 10).alias("percentile"), F.round("value", 6).alias("value")
    )


@query(
    "score_percentiles",
    sql_with(
        ["predictions"],
        """SELECT round(mean, 6) AS mean, round(std, 6) AS std, CAST(generate_subscripts(q, 1) AS INT) AS percentile,
        round(unnest(q), 6) AS value FROM (SELECT avg(price_score) AS mean, stddev_pop(price_score) AS std,
        quantile_cont(price_score, list_transform(range(1, 100), lambda i: i / 100)) AS q FROM predictions)""",
    ),
)
def score_percentiles(spark, folder):
    scores = predictions(spark, folder)
    distribution = training_data.score_distribution(scores, "price_score")
    return distribution.select(
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
        F.posexplode("percentiles").alias("position", "value"),
    ).select("mean", "std", (F.col("position") + 1).alias("percentile"), F.round("value", 6).alias("value"))


@query(
    "monthly_price_deciles",
    sql_with(
        ["item_features"],
        f"""SELECT snapshot_date, CAST(generate_subscripts(q, 1) * 10 - 10 AS INT) AS percentile,
        round(unnest(q), 6) AS value FROM (SELECT snapshot_date, quantile_cont(l_extendedprice, {DECILE_LIST}) AS q
        FROM item_features GROUP BY snapshot_date)""",
    ),
)
def monthly_price_deciles(spark, folder):
    deciles = exact_percentiles(item_features(spark, folder), [MONTH], "l_extendedprice", DECILES)
    return deciles.select(MONTH, F.posexplode("percentiles").alias("position", "value")).select(
        MONTH, (F.col("position") * 10).alias("percentile"), F.round("value", 6).alias("value")
    )


@query(
    "column_medians",
    sql_with(
        ["item_features", "training_items", "training_long"],
        "SELECT feature, round(median(value), 6) AS median FROM training_long GROUP BY feature",
    ),
)
def column_medians(spark, folder):
    values = long_features(training_items(spark, folder), ITEM_FEATURES)
    return exact_medians(values, ["feature"], "value").withColumn("median", F.round("median", 6))


SPARSE = {
    "quantity": "CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity END",
    "price": "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END",
    "tax": "CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END",
}
CTE["sparse"] = "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{e} AS {c}" for c, e in SPARSE.items()) + " FROM lineitem"
CTE["filled"] = "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"coalesce({c}, median({c}) OVER ()) AS {c}" for c in SPARSE
) + " FROM sparse"


@query(
    "impute_and_scale",
    sql_with(
        ["sparse", "filled"],
        "SELECT l_orderkey, l_linenumber, "
        + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in SPARSE)
        + " FROM filled",
    ),
)
def impute_and_scale(spark, folder):
    sparse = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", *[f"{e} AS {c}" for c, e in SPARSE.items()]
    )
    fitted = preprocessing.fit(sparse, list(SPARSE))
    scaled = fitted.scale(fitted.impute(sparse))
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in SPARSE])
