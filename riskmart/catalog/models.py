"""Training, calibration and scoring queries, checked by what must hold of any right fit.

A fit itself cannot be stated in SQL. Each query therefore returns counts that SQL takes from the
same tables, and properties computed from the models' output: scores are probabilities, the planted
signal is found, optima are optima, calibration keeps means.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskmart.catalog.base import query, table
from riskmart.functions.loans import month_start
from riskmart.plans import training
from riskmart.plans.training import TrainingOptions
from riskmart.sources.scratch import keep

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
TRAIN_END, TEST_END = "1998-01-01", "2000-01-01"
# The whole configuration, fitted on all rows.
OPTIONS = TrainingOptions(train_end=TRAIN_END, test_end=TEST_END, search_parallelism=8)
# For queries that fit tree ensembles on a bounded number of rows.
BOUNDED = replace(OPTIONS, fit_rows=5_000)
AUC_FLOOR = 0.6

_LABEL_SQL = """CAST(l_extendedprice / 105000.0 * 0.6 + l_discount * 4
  > ((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 1000) / 1000.0 AS INT)"""
_MONTH_SQL = "make_date(CAST(year(l_shipdate) AS INT), CAST(month(l_shipdate) AS INT), 1)"
_SPLITS_SQL = f"""splits AS (
  SELECT split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos FROM (
    SELECT {_LABEL_SQL} AS label, CASE WHEN {_MONTH_SQL} <= DATE '{TRAIN_END}' THEN 'train'
      WHEN {_MONTH_SQL} <= DATE '{TEST_END}' THEN 'test' ELSE 'oot' END AS split FROM lineitem)
  GROUP BY split)"""


def by_split_sql(*true: str) -> str:
    facts = "".join(f", true AS {name}" for name in true)
    return f"WITH {_SPLITS_SQL} SELECT split, n_rows, n_pos, n_rows AS n_scored{facts} FROM splits"


def dataset(spark, folder):
    """Line items with a label that depends on price and discount, with noise from the keys."""
    items = table(spark, folder, "lineitem")
    price = F.col("l_extendedprice") / F.lit(105000.0)
    mixed = F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_linenumber") * 31
    noise = F.pmod(mixed, F.lit(1000)) / F.lit(1000.0)
    return items.select(
        F.col("l_orderkey").cast("string").alias("Customer_ID"),
        month_start(F.col("l_shipdate")).alias("feature_snapshot_date"),
        *FEATURES,
        (price * 0.6 + F.col("l_discount") * 4 > noise).cast("int").alias("label"),
    )


def prepared(spark, folder, options=BOUNDED):
    """Assembled rows of all splits, the training weight, and the rows to fit ensembles on."""
    imputed, fitted, rows, (n_neg, n_pos), _ = training.prepare(
        dataset(spark, folder), FEATURES, options, "feature_snapshot_date"
    )
    frame = training.assembler(fitted.features).transform(
        fitted.scale(imputed).withColumns(
            {
                "balanced_weight": training.class_weight(n_neg, n_pos) * F.col("weight"),
                "ratio_weight": training.boosted_weight(n_neg, n_pos) * F.col("weight"),
            }
        )
    )
    frame = frame.select(training.ROW, "label", "weight", "split", "balanced_weight", "ratio_weight", "features")
    frame = keep(frame, "prepared")
    train = training.fitted_on(frame.where("split = 'train'"), rows["train"], options)
    return frame, float(n_neg + n_pos), keep(train, "fitted_on")


def facts_by_split(name, model, frame, **more):
    """Counts per split, whether all scores are probabilities and whether the signal is found."""
    scored = training.with_probability(model, frame, "score").select(
        "label", "weight", "split", F.lit(name).alias("model"), "score"
    )
    # Counts and metrics read the scores several times.
    scored = keep(scored, "scored")
    counts = scored.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.sum("label").cast("bigint").alias("n_pos"),
        F.min(F.col("score").between(0, 1)).alias("in_unit"),
    )
    metrics = training.evaluate(scored).select("split", "n_scored", (F.col("auc") > AUC_FLOOR).alias("finds_signal"))
    return counts.join(metrics, "split").withColumns({k: F.lit(v) for k, v in more.items()})


def logistic_gradient(model, train, penalty):
    """The largest part of the gradient of the penalised mean loss at the fitted coefficients."""
    residual = F.col("balanced_weight") * (training.positive_probability() - F.col("label"))
    x = vector_to_array("features")
    scored = model.transform(train)
    sums = scored.agg(
        F.sum("balanced_weight"), F.sum(residual), *[F.sum(residual * x[i]) for i in range(len(FEATURES))]
    ).first()
    parts = [sums[1] / sums[0]]
    parts += [s / sums[0] + penalty * float(b) for s, b in zip(sums[2:], model.coefficients)]
    return max(abs(p) for p in parts)


@query("train_logistic", by_split_sql("in_unit", "finds_signal", "at_optimum"))
def train_logistic(spark, folder):
    frame, n, _ = prepared(spark, folder)
    train = frame.where("split = 'train'")
    model = training.logistic_regression(n).fit(train)
    gradient = logistic_gradient(model, train, 1.0 / n)
    return facts_by_split("logistic_regression", model, frame, at_optimum=gradient < 1e-4)


@query("train_forest", by_split_sql("in_unit", "finds_signal", "whole_forest"))
def train_forest(spark, folder):
    frame, _, train = prepared(spark, folder, OPTIONS)
    model = training.random_forest(OPTIONS).fit(train)
    whole = len(model.trees) == 200 and max(t.depth for t in model.trees) == 8
    return facts_by_split("random_forest", model, frame, whole_forest=whole)


@query("train_boosted_trees", by_split_sql("in_unit", "finds_signal", "all_steps"))
def train_boosted_trees(spark, folder):
    frame, _, train = prepared(spark, folder, OPTIONS)
    model = training.boosted_trees(OPTIONS.seed, maxIter=100, maxDepth=3, stepSize=0.1).fit(train)
    return facts_by_split("boosted_trees", model, frame, all_steps=model.getNumTrees == 100)


@query(
    "search_hyperparameters",
    f"""WITH {_SPLITS_SQL} SELECT n_rows AS n_train, CAST(10 AS BIGINT) AS n_draws, CAST(10 AS BIGINT) AS n_different,
    true AS in_ranges, true AS finds_signal, true AS best_is_best, true AS within_bound FROM splits WHERE split = 'train'""",
)
def search_hyperparameters(spark, folder):
    """All draws over all folds and ranges."""
    frame, n, train = prepared(spark, folder)
    rows = train.select(training.ROW, "label", "weight", "split", "ratio_weight", "features")
    best, results = training.search_boosted_trees(rows, BOUNDED)
    drawn = [{k: v for k, v in r.items() if k != "mean_auc"} for r in results]
    top = max(r["mean_auc"] for r in results)
    facts = (
        frame.where("split = 'train'").count(),
        len(drawn),
        len({str(sorted(d.items())) for d in drawn}),
        all(v in training.BOOSTED_TREE_RANGES[k] for d in drawn for k, v in d.items())
        and all(set(d) == set(training.BOOSTED_TREE_RANGES) for d in drawn),
        all(AUC_FLOOR < r["mean_auc"] <= 1 for r in results),
        next(r["mean_auc"] for r, d in zip(results, drawn) if d == best) == top,
        rows.count() == min(BOUNDED.fit_rows, frame.where("split = 'train'").count()),
    )
    schema = "n_train long, n_draws long, n_different long, in_ranges boolean, finds_signal boolean, best_is_best boolean"
    return spark.createDataFrame([facts], f"{schema}, within_bound boolean")


@query(
    "calibrate_scores",
    f"""WITH {_SPLITS_SQL} SELECT split, n_rows, n_pos, true AS in_unit, true AS rising, true AS isotonic_keeps_mean,
    true AS sigmoid_at_optimum FROM splits""",
)
def calibrate_scores(spark, folder):
    """Both methods fitted on the test split and applied to all rows.

    An isotonic fit keeps the label mean of the rows it is fitted on; the sigmoid's two score
    equations against its smoothed targets are zero there.
    """
    frame, n, _ = prepared(spark, folder)
    model = training.logistic_regression(n).fit(frame.where("split = 'train'"))
    raw = keep(model.transform(frame).select("label", "weight", "split", training.margin().alias("raw")), "raw")
    test = raw.where("split = 'test'")
    both = training.fit_sigmoid(test).apply(raw, "raw", "sigmoid")
    both = keep(training.fit_isotonic(test).apply(both, "raw", "isotonic"), "calibrated")
    sums = both.where("split = 'test'").agg(F.count("*").alias("n"), F.sum("label").alias("p"), F.avg("isotonic").alias("mean")).first()
    high, low = (sums["p"] + 1.0) / (sums["p"] + 2.0), 1.0 / (sums["n"] - sums["p"] + 2.0)
    residual = F.col("sigmoid") - F.when(F.col("label") == 1, high).otherwise(low)
    first, second = both.where("split = 'test'").agg(F.avg(residual), F.avg(residual * F.col("raw"))).first()
    correlation = both.agg(F.corr("raw", "sigmoid").alias("a"), F.corr("raw", "isotonic").alias("b")).first()
    ok = F.col("sigmoid").between(0, 1) & F.col("isotonic").between(0, 1)
    facts = {
        "rising": correlation["a"] > 0 and correlation["b"] > 0,
        "isotonic_keeps_mean": math.isclose(sums["mean"], sums["p"] / sums["n"], abs_tol=1e-6),
        "sigmoid_at_optimum": max(abs(first), abs(second)) < 1e-4,
    }
    counts = both.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.sum("label").cast("bigint").alias("n_pos"), F.min(ok).alias("in_unit")
    )
    return counts.withColumns({k: F.lit(v) for k, v in facts.items()})


@query(
    "train_challenger",
    f"""WITH {_SPLITS_SQL}, models AS (SELECT unnest(['logistic_regression', 'random_forest', 'boosted_trees']) AS model)
    SELECT model, split, n_rows AS n_scored, true AS finds_signal, true AS consistent, true AS one_champion,
    true AS all_parameters, 'challenger_v1' AS model_version FROM splits CROSS JOIN models""",
)
def train_challenger(spark, folder):
    """A whole training run: three candidates, search, choice and calibration."""
    result = training.train_challenger(dataset(spark, folder), FEATURES, "challenger_v1", OPTIONS)
    champions = result.comparison.where("is_champion").select("model").distinct().count()
    return result.comparison.select(
        "model",
        "split",
        "n_scored",
        (F.col("auc") > AUC_FLOOR).alias("finds_signal"),
        (F.abs(2 * F.col("auc") - 1 - F.col("gini")) < 1e-9).alias("consistent"),
        F.lit(champions == 1).alias("one_champion"),
        F.lit(set(result.parameters) == set(training.BOOSTED_TREE_RANGES)).alias("all_parameters"),
        "model_version",
    )


@query(
    "shadow_scoring",
    f"""SELECT {_MONTH_SQL} AS snapshot_date, count(*) AS n_rows, count(*) AS n_scored, count(*) AS n_challenger,
    true AS in_unit, true AS at_threshold, 'champion_v1' AS model_version, 'challenger_v1' AS challenger_model_version
    FROM lineitem GROUP BY ALL""",
)
def shadow_scoring(spark, folder):
    """A linear champion and a forest challenger score every row."""
    data = dataset(spark, folder)
    imputed, fitted, rows, (n_neg, n_pos), _ = training.prepare(data, FEATURES, OPTIONS, "feature_snapshot_date")
    weight = training.class_weight(n_neg, n_pos) * F.col("weight")
    ready = fitted.scale(imputed).withColumn("balanced_weight", weight)
    train = keep(training.fitted_on(ready.where("split = 'train'"), rows["train"], OPTIONS), "fitted_on")
    dealt = train.unionByName(ready.where("split = 'test'"))
    champion = training.fit_bundle(
        ready, fitted, "logistic_regression", "champion_v1", training.logistic_regression(n_neg + n_pos)
    )
    challenger = training.fit_bundle(
        dealt, fitted, "random_forest", "challenger_v1", training.random_forest(OPTIONS)
    )
    rows = data.withColumnRenamed("feature_snapshot_date", "snapshot_date")
    scored = training.score_month_rows(rows, champion, challenger)
    in_unit = F.col("score").between(0, 1) & F.col("challenger_score").between(0, 1)
    at_threshold = (F.col("predicted_label") == (F.col("score") >= 0.5).cast("int")) & (
        F.col("challenger_predicted_label") == (F.col("challenger_score") >= 0.5).cast("int")
    )
    return scored.groupBy("snapshot_date").agg(
        F.count("*").alias("n_rows"),
        F.count("score").alias("n_scored"),
        F.count("challenger_score").alias("n_challenger"),
        F.min(in_unit).alias("in_unit"),
        F.min(at_threshold).alias("at_threshold"),
        F.max("model_version").alias("model_version"),
        F.max("challenger_model_version").alias("challenger_model_version"),
    )


@query(
    "feature_importance",
    f"""WITH {_SPLITS_SQL} SELECT n_rows AS n_train, CAST(5 AS BIGINT) AS n_features, true AS sums_to_one, true AS in_order,
    true AS signal_first FROM splits WHERE split = 'train'""",
)
def feature_importance(spark, folder):
    """A feature the label depends on comes first."""
    frame, _, train = prepared(spark, folder)
    model = training.boosted_trees(OPTIONS.seed, maxIter=100, maxDepth=3, stepSize=0.1).fit(train)
    listed = training.importance_table(spark, FEATURES, model).withColumn("place", F.monotonically_increasing_id())
    entries = F.sort_array(F.collect_list(F.struct("place", "feature", "importance")))
    n_train = frame.where("split = 'train'").count()
    facts = listed.agg(entries.alias("e"), F.sum("importance").alias("total"))
    falling = F.forall(F.sequence(F.lit(1), F.size("e") - 1), lambda i: F.col("e")[i - 1]["importance"] >= F.col("e")[i]["importance"])
    return facts.select(
        F.lit(n_train).cast("bigint").alias("n_train"),
        F.size("e").cast("bigint").alias("n_features"),
        (F.abs(F.col("total") - 1) < 1e-9).alias("sums_to_one"),
        falling.alias("in_order"),
        F.col("e")[0]["feature"].isin("l_discount", "l_extendedprice").alias("signal_first"),
    )
