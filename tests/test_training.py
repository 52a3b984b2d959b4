"""Preprocessing, calibration and the training fallbacks."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.operators.isotonic import pool, pooled_blocks
from riskmart.plans import preprocessing, training, training_data


def test_preprocessing_equals_numpy(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, float(rng.randint(0, 20))]), float("nan") if i % 7 == 0 else i * 1.0, 5.0, None) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    fitted = preprocessing.fit(df, ["a", "b", "c", "d"])
    assert fitted.features == ["a", "b", "c"]
    a = np.array([r[0] for r in rows if r[0] is not None])
    filled = np.array([np.median(a) if r[0] is None else r[0] for r in rows])
    assert fitted.medians[0] == np.median(a)
    assert fitted.means[0] == pytest.approx(filled.mean())
    assert fitted.deviations[0] == pytest.approx(filled.std())
    scaled = fitted.scale(fitted.impute(df))
    assert scaled.agg(F.max(F.abs("c"))).first()[0] == 0.0


def brute_platt(raw, y):
    """Newton steps on the smoothed log loss."""
    pos, neg = sum(y), len(y) - sum(y)
    target = np.where(np.array(y) == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([raw, np.ones(len(raw))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (target - p))
    return w


def test_sigmoid_equals_newton(spark):
    rng = random.Random(2)
    raw = [round(rng.gauss(0, 1), 2) for _ in range(150)]
    y = [int(rng.random() < 1 / (1 + math.exp(-2 * r))) for r in raw]
    df = spark.createDataFrame([(r, l, 1) for r, l in zip(raw, y)], "raw double, label int, weight long")
    fitted = training.fit_sigmoid(df)
    slope, intercept = brute_platt(np.array(raw), y)
    assert fitted.slope == pytest.approx(slope, rel=1e-3)
    assert fitted.intercept == pytest.approx(intercept, abs=1e-3)


def test_isotonic_is_monotone_and_keeps_the_mean(spark):
    rng = random.Random(3)
    rows = [(r := rng.random(), int(rng.random() < r), 1) for _ in range(400)]
    df = spark.createDataFrame(rows, "raw double, label int, weight long")
    out = training.fit_isotonic(df).apply(df, "raw", "p").orderBy("raw").collect()
    values = [r["p"] for r in out]
    assert all(a <= b + 1e-12 for a, b in zip(values, values[1:]))
    assert np.mean(values) == pytest.approx(np.mean([r["label"] for r in out]), abs=1e-9)


def test_pooling_batch_by_batch_gives_the_same_blocks():
    rows = [(float(i), float((i * 7) % 11 > 5), 1.0 + i % 3) for i in range(200)]
    blocks = []
    for start in range(0, 200, 13):
        pool(iter(rows[start : start + 13]), blocks)
    assert blocks == pool(rows) and len(blocks) < 20


def test_pooling_in_ranges_changes_no_fit(spark):
    from pyspark.ml.regression import IsotonicRegression

    rng = random.Random(4)
    rows = [(rng.random(), float(rng.random() < 0.3 + 0.4 * (i % 7 == 0)), float(rng.randint(1, 4))) for i in range(800)]
    rows += [(2 + i / 10, float(i % 2), 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "raw double, target double, w double").repartition(5)
    blocks = pooled_blocks(df, "raw", "target", "w")
    assert blocks.count() < 200
    fits = [
        IsotonicRegression(featuresCol="raw", labelCol="target", weightCol="w").fit(x).transform(df).orderBy("raw").collect()
        for x in (df, blocks)
    ]
    for a, b in zip(*fits, strict=True):
        assert a["prediction"] == pytest.approx(b["prediction"], abs=1e-9)


def test_calibration_method_is_an_option(spark):
    rows = [(i / 100, i % 3 == 0, 1) for i in range(100)]
    df = spark.createDataFrame([(r, int(y), w) for r, y, w in rows], "raw double, label int, weight long")
    options = training.TrainingOptions(isotonic_above=50)
    assert training.fit_calibrator(df, 100, options).method == "isotonic"
    assert training.fit_calibrator(df, 50, options).method == "sigmoid"
    assert training.fit_calibrator(df, 100, training.TrainingOptions(calibration="sigmoid", isotonic_above=50)).method == "sigmoid"


def test_absent_split_has_rows_without_metrics(spark):
    metrics = spark.createDataFrame(
        [(m, "train", 9, 0.7, 0.4, 0.3) for m in training.MODEL_ORDER], "model string, split string, n_scored long, auc double, gini double, ks double"
    )
    rows = training.with_all_splits(metrics).collect()
    assert len(rows) == 9 and sum(r["auc"] is None for r in rows) == 6


def test_fit_rows_bound_only_the_fit(spark):
    """Assembled rows, most of them equal: exactly the wanted number, both classes in proportion."""
    rows = [(dt.date(2023, 1, 1), int(i % 10 == 0), float(i % 3)) for i in range(6_000)]
    df = spark.createDataFrame(rows, "feature_snapshot_date date, label int, x double")
    options = training.TrainingOptions(fit_rows=1000)
    imputed, fitted, counts, _, _ = training.prepare(df, ["x"], options, "feature_snapshot_date")
    ready = training.assembler(["x"]).transform(fitted.scale(imputed)).where("split = 'train'").drop("x")
    chosen = training.fitted_on(ready, counts["train"], options)
    assert {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()} == {0: 900, 1: 100}
    assert chosen.select(training.ROW).distinct().count() == 1000
    again = training.fitted_on(ready.repartition(7), counts["train"], options)
    assert chosen.select(training.ROW).exceptAll(again.select(training.ROW)).isEmpty()
    assert training.fitted_on(ready, 900, options).count() == 6_000


def test_folds_are_even_for_equal_rows(spark):
    seen = {}

    class Stop(Exception):
        pass

    def fit(self, frame):
        seen["sizes"] = sorted(r["count"] for r in frame.groupBy("fold").count().collect())
        raise Stop

    from unittest.mock import patch

    from pyspark.ml.tuning import CrossValidator

    frame = spark.range(3_000).select(F.col("id").alias(training.ROW), F.lit(1).alias("label"), F.lit(1).alias("weight"))
    with patch.object(CrossValidator, "fit", fit), pytest.raises(Stop):
        training.search_boosted_trees(frame, training.TrainingOptions())
    assert len(seen["sizes"]) == 3 and seen["sizes"][0] > 900


def test_bottom_k_is_exact_and_unbiased(spark):
    from riskmart.operators.sampling import bottom_k, proportional, random_place

    df = spark.range(20_000).select("id", (F.col("id") % 4).cast("int").alias("g"), F.lit("x").alias("extra"))
    sizes = {0: 700, 1: 1, 2: 10_000}
    rows = bottom_k(df, "g", "id", sizes, 3)
    assert rows.columns == df.columns
    got = {}
    for r in rows.collect():
        got.setdefault(r["g"], set()).add(r["id"])
    assert {g: len(v) for g, v in got.items()} == {0: 700, 1: 1, 2: 5_000}
    order = [r["id"] for r in df.where("g = 0").orderBy(random_place("id", 3)).select("id").collect()]
    assert got[0] == set(order[:700])
    assert bottom_k(df.limit(0), "g", "id", sizes).count() == 0
    assert proportional({0: 996, 1: 3, 2: 1}, 10) == {0: 8, 1: 1, 2: 1}
    assert proportional({0: 5, 1: 5}, 10) == {0: 5, 1: 5} and sum(proportional({0: 7, 1: 6, 2: 5}, 11).values()) == 11


def test_split_names(spark):
    days = ["2023-12-01", "2024-01-01", "2024-03-01", "2024-04-01"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    assert [r[0] for r in df.select(training_data.split_name(F.col("d"))).collect()] == ["train", "test", "test", "oot"]


def test_split_fallbacks(spark):
    df = spark.createDataFrame([("train", 1)] * 12 + [("test", 2)] * 3 + [("oot", 3)] * 4, "split string, x int")
    used = training.splits_in_use(df, {"train": 12, "test": 3, "oot": 4})
    assert {(r["split"], r["x"]): r["count"] for r in used.groupBy("split", "x").count().collect()} == {
        ("train", 1): 12, ("test", 1): 12,
    }


def test_too_few_training_rows(spark):
    rows = [(dt.date(2023, 1, 1), i % 2, float(i)) for i in range(49)]
    df = spark.createDataFrame(rows, "feature_snapshot_date date, label int, x double")
    assert training.train_challenger(df, ["x"], "v") is None


def test_duplicate_labels_become_weights(spark):
    day = dt.date(2023, 7, 1)
    features = spark.createDataFrame([("a", dt.date(2023, 1, 1)), ("b", dt.date(2023, 1, 1))], "Customer_ID string, snapshot_date date")
    labels = spark.createDataFrame([("a", day, 1), ("a", day, 1), ("a", day, 0), ("c", day, 1)], "Customer_ID string, snapshot_date date, label int")
    dataset = training_data.labelled_dataset(features, labels)
    assert {(r["Customer_ID"], r["label"], r["weight"]) for r in dataset.collect()} == {("a", 1, 2), ("a", 0, 1)}
    assert training_data.expand_weights(dataset).count() == features.join(labels, "Customer_ID").count()


def test_drawn_parameters_are_repeatable():
    first = training.draw_parameters(training.BOOSTED_TREE_RANGES, 10, 42)
    assert first == training.draw_parameters(training.BOOSTED_TREE_RANGES, 10, 42)
    assert len({tuple(p.items()) for p in first}) == 10


def forest_rows(spark, n=400):
    rng = random.Random(5)
    rows = [(i, *(x := [rng.gauss(0, 1), float(rng.randint(0, 9)), rng.random()]), int(x[0] + x[2] > rng.random()), 1) for i in range(n)]
    df = spark.createDataFrame(rows, f"{training.ROW} long, a double, b double, c double, label int, weight long")
    return training.assembler(["a", "b", "c"]).transform(df).withColumns({w: F.lit(1.0) for w in ("balanced_weight", "ratio_weight")})


def test_forest_walk_equals_the_transform(spark):
    """Bit for bit, also below a pipeline and on values beyond all thresholds; and no row walks through Spark's trees."""
    from pyspark.ml import PipelineModel

    df = forest_rows(spark)
    model = training.random_forest(training.TrainingOptions(forest_trees=21, forest_depth=6)).fit(df)
    odd = spark.createDataFrame([(v, -v, v) for v in (float("inf"), float("nan"), 1e300, 0.0)], "a double, b double, c double")
    for frame in (df, training.assembler(["a", "b", "c"]).setHandleInvalid("keep").transform(odd)):
        both = training.with_probability(model, model.transform(frame), "walked")
        rows = both.select("walked", training.positive_probability().alias("p")).collect()
        assert [r["walked"] for r in rows] == [r["p"] for r in rows] and rows
    piped = training.with_probability(PipelineModel(stages=[training.assembler(["a", "b", "c"]), model]), df.drop("features"), "p")
    assert "rawPrediction" not in piped.columns and piped.where("p between 0 and 1").count() == 400


def test_search_fits_every_draw_once_per_fold(spark):
    """The metrics of Spark's cross validation, without the fit of the best draw on all rows."""
    from unittest.mock import patch

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.tuning import CrossValidator

    ranges = {"maxIter": [2, 3], "maxDepth": [2], "stepSize": [0.1, 0.5]}
    options = training.TrainingOptions(search_draws=3, search_folds=2, search_ranges=ranges)
    df = forest_rows(spark, 200)
    fits, fit = [], GBTClassifier._fit
    with patch.object(GBTClassifier, "_fit", lambda self, frame: fits.append(1) or fit(self, frame)):
        best, results = training.search_boosted_trees(df, options)
    assert len(fits) == 6
    with patch.object(training, "PooledSearch", CrossValidator):
        assert (best, results) == training.search_boosted_trees(df, options)


@pytest.fixture(scope="module")
def line_items(spark, tmp_path_factory):
    """6,500 training, 700 test and 800 later rows of the table the model queries read."""
    folder = tmp_path_factory.mktemp("items")
    day = F.when(F.col("id") < 6_500, "1996-05-03").when(F.col("id") < 7_200, "1999-05-03").otherwise("2001-05-03")
    spark.range(8_000).select(
        F.col("id").alias("l_orderkey"),
        (F.col("id") * 31 % 977).alias("l_partkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"),
        (F.col("id") % 50).cast("double").alias("l_quantity"),
        (F.col("id") * 7919 % 105_000).cast("double").alias("l_extendedprice"),
        (F.col("id") % 11 / 100).alias("l_discount"),
        (F.col("id") % 9 / 100).alias("l_tax"),
        day.cast("date").alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "name, fits",
    [
        ("train_challenger", ["search", "RandomForestClassifier", "GBTClassifier"]),
        ("shadow_scoring", ["RandomForestClassifier"]),
        ("train_forest", ["RandomForestClassifier"]),
        ("train_boosted_trees", ["GBTClassifier"]),
    ],
)
def test_ensembles_are_fitted_on_all_training_rows(spark, line_items, name, fits):
    from unittest.mock import patch

    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier

    from riskmart.catalog import QUERIES

    seen = {}

    class Stop(Exception):
        pass

    def search(frame, options):
        seen["search"] = frame.select(training.ROW).distinct().count()
        return {}, []

    def fit(self, frame):
        seen[type(self).__name__] = frame.count()
        if type(self).__name__ == fits[-1]:
            raise Stop

    with (
        patch.object(training, "search_boosted_trees", search),
        patch.object(RandomForestClassifier, "_fit", fit),
        patch.object(GBTClassifier, "_fit", fit),
        pytest.raises(Stop),
    ):
        QUERIES[name](spark, line_items)
    assert seen == dict.fromkeys(fits, 6_500)
