"""Operators against brute force on small data, and properties that must always hold."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.operators.asof import asof_latest
from riskmart.operators.profile import duplicate_rate
from riskmart.operators.quantiles import exact_percentiles, long_features, moments
from riskmart.operators.ranking import join_predictions, ranking_metrics
from riskmart.operators.running import range_of, running_sums, splitters, with_range
from riskmart.operators.stability import (
    bin_index,
    covariate_shift,
    decile_edges,
    previous_bins,
    psi,
    quantile_psi,
    sample_bins,
    score_profile,
)

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def brute_metrics(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    auc = won / (len(pos) * len(neg))
    ks = max(
        abs(sum(p <= t for p in pos) / len(pos) - sum(n <= t for n in neg) / len(neg)) for t, _ in rows
    )
    return auc, ks


@SLOW
@given(
    st.lists(
        st.tuples(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5000001, 1.0, -3.0, 1e6]), st.integers(0, 1)),
        min_size=12,
        max_size=40,
    ).filter(lambda rows: len({y for _, y in rows}) == 2)
)
def test_auc_and_ks_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(1, s, y) for s, y in rows], "cohort int, score double, label int")
    out = ranking_metrics(df, ["cohort"]).first()
    auc, ks = brute_metrics(rows)
    assert out["auc"] == pytest.approx(auc, abs=1e-12)
    assert out["gini"] == pytest.approx(2 * auc - 1, abs=1e-12)
    assert out["ks"] == pytest.approx(ks, abs=1e-12)


def test_metric_guards(spark):
    rows = [(1, 0.5, i % 2) for i in range(9)] + [(2, 0.5, 1) for _ in range(12)] + [(3, 0.5, i % 2) for i in range(10)]
    out = {r["c"]: r for r in ranking_metrics(
        spark.createDataFrame(rows, "c int, score double, label int"), ["c"]).collect()}
    assert out[1]["auc"] is None and out[1]["default_rate"] is None
    assert out[2]["auc"] is None and out[2]["default_rate"] == 1.0
    assert (out[3]["auc"], out[3]["gini"], out[3]["ks"]) == (0.5, 0.0, 0.0)


def test_guards_count_rows_without_a_score(spark):
    scores = [0.1, 0.4, 0.6, 0.9, None, None, float("nan"), None, None, None]
    rows = [(1, s, y) for s, y in zip(scores, [0, 1, 0, 1, 1, 1, 1, 0, 1, 1], strict=True)]
    rows += [(2, s, y) for s, y in zip(scores, [1, 1, 1, 1, 0, 0, 0, 0, 0, 0], strict=True)]
    frame = spark.createDataFrame(rows, "c int, score double, label int")
    out = {r["c"]: r for r in ranking_metrics(frame, ["c"]).collect()}
    assert (out[1]["n_scored"], out[1]["default_rate"], out[1]["auc"], out[1]["ks"]) == (4, 0.7, 0.75, 0.5)
    assert (out[2]["n_scored"], out[2]["default_rate"], out[2]["auc"]) == (4, 0.4, None)


def test_joined_metrics_equal_a_row_join(spark):
    rng = random.Random(3)
    predictions = spark.createDataFrame(
        [(rng.choice("abc"), 1, rng.randint(0, 5) / 5) for _ in range(60)], "k string, m int, score double"
    )
    labels = spark.createDataFrame(
        [(rng.choice("abcd"), 1, rng.randint(0, 1)) for _ in range(30)], "k string, m int, label int"
    )
    weighted = ranking_metrics(
        join_predictions(predictions, labels, ["k", "m"]), ["m"],
        positives=F.col("n_pos"), negatives=F.col("n_neg"),
    ).first()
    plain = ranking_metrics(predictions.join(labels, ["k", "m"]), ["m"]).first()
    assert weighted["n_scored"] == plain["n_scored"]
    assert weighted["auc"] == pytest.approx(plain["auc"])
    assert weighted["ks"] == pytest.approx(plain["ks"])


def test_ranges_are_monotone(spark):
    values = sorted([float("-inf"), float("inf"), 1e308, 3e-7, 3.0000001e-7, 0.0, -0.0, 1e-12, 0.1, 0.1000001, 3.0, 5e7, 1e300, -1e-9, -2.5, -1e9] + [i / 7 for i in range(99)])
    df = spark.createDataFrame([(v,) for v in values], "x double")
    cuts = [-2.5, 0.0, 0.1, 0.1, 3.0, 5e7, 1e300]
    ranges = [r[0] for r in df.select(range_of(F.col("x"), F.array(*map(F.lit, cuts)), 8)).collect()]
    assert ranges == [sum(c <= v for c in cuts) for v in values]
    assert spark.range(1).select(range_of(F.lit(None).cast("double"), F.array(F.lit(1.0)), 2)).first()[0] == 0


def test_ranges_of_rows_are_compiled(spark):
    """The range of a row is that of ``range_of``, without a function interpreted for every value."""
    df = spark.createDataFrame([(v,) for v in [*map(float, range(40)), float("inf"), -1.0, 0.5]], "v double")
    located = with_range(df, [], "v", 6)
    assert "lambdafunction" not in located._jdf.queryExecution().optimizedPlan().toString()
    cuts = splitters(df, [], "v", 6).first()["_splitters"]
    assert all(r["_bucket"] == sum(c <= r["v"] for c in cuts) for r in located.collect())
    assert located.schema["_bucket"].dataType.typeName() == "long" and not located.schema["_bucket"].nullable


def test_running_sums_with_coarse_buckets(spark):
    values = [0.001 * i for i in range(50)] + [float(i) for i in range(1, 40)]
    df = spark.createDataFrame([("g", v, i % 3) for i, v in enumerate(sorted(set(values)))], "g string, v double, n long")
    for ranges, few in ((1, True), (7, False), (4096, True)):
        out = running_sums(df, ["g"], "v", ["n"], ranges, few).orderBy("v").collect()
        total = 0
        for r in out:
            assert r["below_n"] == total
            total += r["n"]
        assert {r["total_n"] for r in out} == {total}


def test_narrow_values_spread_over_ranges(spark):
    """1e5 scores within 1e-6 of each other and a few far away: no range holds many of them."""
    df = spark.range(100_000).select((F.lit(0.5) + F.col("id") * 1e-11).alias("v"), F.lit(1).alias("n"))
    df = df.union(spark.createDataFrame([(-1e9, 1), (0.0, 1), (1e-300, 1), (1e9, 1)], "v double, n int"))
    for ranges in (256, 1024):
        sizes = [r["count"] for r in with_range(df, [], "v", ranges).groupBy("_bucket").count().collect()]
        assert len(sizes) > 0.9 * ranges and max(sizes) < 3 * 100_000 / ranges
    got = exact_percentiles(df, [], "v", [0.25, 0.5, 1.0]).first()["percentiles"]
    values = np.sort(np.concatenate([0.5 + np.arange(100_000) * 1e-11, [-1e9, 0.0, 1e-300, 1e9]]))
    assert got == pytest.approx(list(np.percentile(values, [25, 50, 100])), rel=1e-15)
    last = running_sums(df.groupBy("v").agg(F.sum("n").alias("n")), [], "v", ["n"]).orderBy(F.desc("v")).first()
    assert (last["below_n"], last["total_n"]) == (100_003, 100_004)


def test_percentiles_of_many_groups_without_broadcast(spark):
    df = spark.range(6_000).select((F.col("id") % 2_000).alias("g"), (F.col("id") * 7 % 1_001).cast("double").alias("v"))
    plan = exact_percentiles(df, ["g"], "v", [0.5], 16, few_groups=False)
    assert "hint" not in plan._jdf.queryExecution().logical().toString().lower()
    rows = {r["g"]: r["percentiles"][0] for r in plan.collect()}
    assert len(rows) == 2_000
    for g in (0, 7, 1_999):
        assert rows[g] == np.median([i * 7 % 1_001 for i in range(g, 6_000, 2_000)])


@SLOW
@given(st.lists(st.floats(-1e6, 1e6, width=32), min_size=1, max_size=60), st.sampled_from([1, 16, 4096]))
def test_percentiles_equal_linear_interpolation(spark, values, resolution):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = exact_percentiles(df, [], "v", probabilities, resolution).first()["percentiles"]
    want = np.percentile(np.array(values, dtype=float), [100 * p for p in probabilities])
    assert got == pytest.approx(list(want), rel=1e-9, abs=1e-9)


def test_weighted_percentiles_and_moments(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 1), ("a", 9.0, 2), ("b", 2.0, 4)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    expanded = {"a": [1.0] * 3 + [5.0] + [9.0] * 2, "b": [2.0] * 4}
    for r in exact_percentiles(df, ["g"], "v", [0.1, 0.5, 0.9], weight="w").collect():
        assert r["percentiles"] == pytest.approx(list(np.percentile(expanded[r["g"]], [10, 50, 90])))
    for r in moments(df, ["g"], "v", "w").collect():
        assert r["mean"] == pytest.approx(np.mean(expanded[r["g"]]))
        assert math.sqrt(r["squares"] / r["n"]) == pytest.approx(np.std(expanded[r["g"]]))


def brute_psi(expected, actual):
    def shares(v):
        return np.clip(np.histogram(np.clip(v, 0, 1), bins=np.linspace(0, 1, 11))[0] / max(len(v), 1), 1e-6, None)

    e, a = shares(expected), shares(actual)
    return float(np.sum((a - e) * np.log(a / e)))


def test_rolling_psi_equals_pooled_scores(spark):
    rng = random.Random(11)
    months = [dt.date(2023, m, 1) for m in range(1, 8)]
    scores = {m: [rng.choice([0.3, 0.6, 0.7, 1.0, 1.2, -0.1, rng.random()]) for _ in range(40)] for m in months}
    df = spark.createDataFrame([(m, s) for m in months for s in scores[m]], "snapshot_date date, score double")
    profile = score_profile(df).withColumn("prev", previous_bins())
    out = profile.select("snapshot_date", psi(F.col("prev"), F.col("bins")).alias("p")).orderBy("snapshot_date").collect()
    assert out[0]["p"] is None
    for i in range(1, len(months)):
        pooled = [s for m in months[max(0, i - 3) : i] for s in scores[m]]
        assert out[i]["p"] == pytest.approx(brute_psi(pooled, scores[months[i]]), rel=1e-9)


def test_bins_follow_the_float_edges(spark):
    df = spark.createDataFrame([(0.3,), (0.1,), (1.0,), (0.0,), (float("nan"),), (None,), (1.5,)], "s double")
    clipped = [r[0] for r in df.select(bin_index(F.col("s"), 10)).collect()]
    assert clipped == [2, 1, 9, 0, None, None, 9]
    assert [r[0] for r in df.select(bin_index(F.col("s"), 10, clip=False)).collect()][-1] is None


def test_psi_of_equal_shares_is_zero(spark):
    df = spark.createDataFrame([(i / 10 + 0.05,) for i in range(10)], "score double")
    bins = sample_bins(df, "score")
    assert bins.select(psi(F.col("bins"), F.col("bins"))).first()[0] == 0.0


def brute_csi(current, edges):
    edges = np.unique(edges)
    if len(edges) < 3:
        return 0.0
    e = np.full(len(edges) - 1, 1 / (len(edges) - 1))
    a = np.clip(np.histogram(current, bins=edges)[0] / max(len(current), 1), 1e-6, None)
    return round(float(np.sum((a - e) * np.log(a / e))), 6)


def test_csi_and_quantile_psi_equal_numpy(spark):
    rng = random.Random(5)
    columns = {
        "smooth": ([rng.gauss(0, 1) for _ in range(200)], [rng.gauss(0.4, 1.3) for _ in range(90)]),
        "ties": ([float(rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(200)], [float(rng.randint(-1, 4)) for _ in range(90)]),
        "constant": ([1.0] * 200, [1.0] * 90),
    }
    base = spark.createDataFrame(list(zip(*[b for b, _ in columns.values()])), ", ".join(f"{c} double" for c in columns))
    now = spark.createDataFrame(list(zip(*[a for _, a in columns.values()])), ", ".join(f"{c} double" for c in columns))
    now = now.withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    values = long_features(base, list(columns))
    current = long_features(now, list(columns), ["snapshot_date"])
    csi = {r["feature"]: r["csi"] for r in covariate_shift(current, decile_edges(values)).collect()}
    qpsi = {r["feature"]: r["psi"] for r in quantile_psi(values, current).collect()}
    for name, (before, after) in columns.items():
        edges = np.percentile(before, range(0, 101, 10))
        assert csi[name] == pytest.approx(brute_csi(after, edges), abs=1e-6)
        unique = np.unique(edges)
        if len(unique) < 3:
            assert qpsi[name] == 0.0
            continue
        e = np.clip(np.histogram(before, bins=unique)[0] / len(before), 1e-6, None)
        a = np.clip(np.histogram(after, bins=unique)[0] / len(after), 1e-6, None)
        assert qpsi[name] == pytest.approx(float(np.sum((a - e) * np.log(a / e))), rel=1e-9)


def brute_asof(visits, records):
    out = []
    for key, day in visits:
        known = [(d, t, v) for k, d, t, v in records if k == key and d is not None and d <= day]
        out.append((key, day, max(known)[2] if known else None))
    return sorted(out, key=str)


@SLOW
@given(st.integers(0, 10**6), st.booleans())
def test_asof_equals_brute_force(spark, seed, monthly):
    rng = random.Random(seed)
    day = lambda first: dt.date(2023, rng.randint(1, 6), 1 if first else rng.randint(1, 28))
    keys = ["hot"] * 5 + ["a", "b", "c"]
    visits = [(rng.choice(keys), day(monthly)) for _ in range(30)]
    records = [(rng.choice(keys), day(False), i, rng.choice([None, i * 10])) for i in range(40)]
    v = spark.createDataFrame(visits, "Customer_ID string, snapshot_date date")
    r = spark.createDataFrame(records, "Customer_ID string, snapshot_date date, rec int, value int")
    got = asof_latest(v, {"r": r}, tiebreak=["rec"], monthly=monthly).collect()
    assert sorted([tuple(x) for x in got], key=str) == brute_asof(visits, records)


def test_asof_takes_whole_records_and_keeps_visits(spark):
    d = dt.date
    visits = spark.createDataFrame(
        [("a", d(2023, 1, 1)), ("a", d(2023, 2, 1)), ("a", d(2023, 3, 1)), (None, d(2023, 3, 1)), ("z", d(2023, 3, 1))],
        "Customer_ID string, snapshot_date date",
    )
    one = spark.createDataFrame(
        [("a", d(2023, 1, 10), 1, 5), ("a", d(2023, 2, 10), 2, None), ("a", None, 9, 9)],
        "Customer_ID string, snapshot_date date, x int, y int",
    )
    two = spark.createDataFrame([("a", d(2023, 3, 1), "p")], "Customer_ID string, snapshot_date date, name string")
    rows = asof_latest(visits, {"one": one, "two": two}).collect()
    got = {(r["Customer_ID"], r["snapshot_date"].month): (r["x"], r["y"], r["name"]) for r in rows}
    assert got == {
        ("a", 1): (None, None, None), ("a", 2): (1, 5, None), ("a", 3): (2, None, "p"),
        (None, 3): (None, None, None), ("z", 3): (None, None, None),
    }


@pytest.mark.parametrize("n", [1, 2, 3, 400])
def test_asof_finds_each_of_many_dates(spark, n):
    first = dt.date(2020, 1, 2)
    records = [("k", first + dt.timedelta(2 * i), i) for i in range(n)]
    visits = [("k", first + dt.timedelta(i - 1)) for i in range(2 * n + 3)] + [("k", None), (None, first)]
    v = spark.createDataFrame(visits, "Customer_ID string, snapshot_date date")
    r = spark.createDataFrame(records, "Customer_ID string, snapshot_date date, value int")
    got = asof_latest(v, {"r": r, "s": r.withColumnRenamed("value", "other").where("other % 2 = 0")}, monthly=False).collect()
    assert {(x["snapshot_date"], x["value"], x["other"]) for x in got if x["Customer_ID"] and x["snapshot_date"]} == {
        (d, *(max((i for _, f, i in records if f <= d and i % m == 0), default=None) for m in (1, 2))) for _, d in visits[:-2]
    }
    assert [x["value"] for x in got if not (x["Customer_ID"] and x["snapshot_date"])] == [None, None]


def test_duplicate_rate_counts_null_as_a_key(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",)], "k string")
    assert duplicate_rate(df, ["k"]).first()["duplicate_rate"] == 0.25
