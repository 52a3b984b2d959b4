"""Carried histories, switched tables and the order of promotion and its log."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskmart import jobs
from riskmart.operators.asof import asof_latest
from riskmart.sources import history, readers, writers

MONTHS = [dt.date(2023, m, 1) for m in range(1, 9)]
RECORD = "Customer_ID string, snapshot_date date, amount int, note string"
VISIT = "Customer_ID string, clicks int, snapshot_date date"


def snapshot(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def some_records(rng, n, first, last):
    days = (last - first).days
    rows = [(f"C{rng.randrange(25)}", first + dt.timedelta(rng.randrange(days)), rng.randrange(50), rng.choice(["x", "y", None])) for _ in range(n)]
    hot = [("C0", first + dt.timedelta(rng.randrange(days)), rng.randrange(50), None) for _ in range(n // 2)]
    return rows + hot + [(None, first, 1, "n"), ("C1", None, 2, "n"), rows[0]]


@pytest.fixture
def mart(spark, tmp_path):
    mart = jobs.Mart(str(tmp_path / "mart"))
    visits = [(f"C{c}", c, m) for m in MONTHS for c in range(30)] + [(None, 1, MONTHS[2])]
    writers.write_months(spark.createDataFrame(visits, VISIT), mart.path("silver_clickstream"))
    jobs.mark_finished(spark, mart, "silver_clickstream", MONTHS)
    return mart


def whole(spark, mart, months):
    visits = readers.in_months(spark.read.parquet(mart.path("silver_clickstream")), months)
    records = spark.read.parquet(mart.path("silver_extra")).drop(history.LANDED, history.USABLE)
    return snapshot(asof_latest(visits, {"extra": records}))


def store(spark, mart, months):
    return snapshot(readers.in_months(spark.read.parquet(mart.path("feature_store")), months))


def test_carried_records_give_the_same_features(spark, mart):
    """Month by month, with late records between, equals the whole history."""
    rng = random.Random(3)
    silver = mart.path("silver_extra")
    history.land(spark.createDataFrame(some_records(rng, 60, dt.date(2022, 11, 5), dt.date(2023, 7, 20)), RECORD), silver)
    for n, months in enumerate((MONTHS[:2], MONTHS[2:3], MONTHS[3:4], MONTHS[4:7])):
        assert jobs.build_features(spark, mart, ["extra"], months) == months
        assert store(spark, mart, months) == whole(spark, mart, months)
        late = some_records(rng, 5, dt.date(2022, 11, 5), dt.date(2023, 1 + n, 20))
        history.land(spark.createDataFrame(late, RECORD), silver)
    assert jobs.build_features(spark, mart, ["extra"], MONTHS[:7]) == []
    # A month built before: the whole history is read again, and what is carried stays.
    part = history.History(spark, silver, mart.path("latest_extra"), lambda rows: rows)
    assert part.through() == (MONTHS[6], 4)
    assert jobs.build_features(spark, mart, ["extra"], MONTHS[1:2], rebuild=True) == MONTHS[1:2]
    assert store(spark, mart, MONTHS[1:2]) == whole(spark, mart, MONTHS[1:2])
    assert part.through() == (MONTHS[6], 4) and not part.carry(MONTHS[3])
    # The last month again, after a landing it did not know.
    assert jobs.build_features(spark, mart, ["extra"], MONTHS[6:7], rebuild=True) == MONTHS[6:7]
    assert store(spark, mart, MONTHS[6:7]) == whole(spark, mart, MONTHS[6:7])
    assert part.through() == (MONTHS[6], 5)
    carried = spark.read.parquet(mart.path("latest_extra"))
    assert carried.count() == carried.select("Customer_ID").distinct().count() <= 25


def test_one_month_reads_what_is_carried_and_new_records(spark, mart):
    rng = random.Random(4)
    silver = mart.path("silver_extra")
    history.land(spark.createDataFrame(some_records(rng, 80, dt.date(2022, 6, 5), dt.date(2023, 4, 20)), RECORD), silver)
    jobs.build_features(spark, mart, ["extra"], MONTHS[:3])
    history.land(spark.createDataFrame([("C2", dt.date(2022, 7, 9), 1, "late")], RECORD), silver)
    part = history.History(spark, silver, mart.path("latest_extra"), lambda rows: rows)
    files = part.records(MONTHS[3:4]).inputFiles()
    plan = part.records(MONTHS[3:4])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "landed" in plan and files
    read = {f for r in part.records(MONTHS[3:4]).select(F.input_file_name()).distinct().collect() for f in r}
    old = [f for f in read if "/landed=1/" in f and not f.rpartition("usable_from=")[2].startswith(str(MONTHS[3]))]
    assert not old and any("/latest_extra/" in f for f in read) and any("/landed=2/" in f for f in read)


def test_replaced_landings_outdate_what_is_carried(spark, mart):
    silver = mart.path("silver_extra")
    first = [("C1", dt.date(2022, 12, 9), 1, "a"), ("C2", dt.date(2022, 12, 9), 2, "a")]
    history.land(spark.createDataFrame(first, RECORD), silver)
    jobs.build_features(spark, mart, ["extra"], MONTHS[:1])
    history.land(spark.createDataFrame(first[1:], RECORD), silver, whole=True)
    assert history.landings(spark, silver) == [2]
    part = history.History(spark, silver, mart.path("latest_extra"), lambda rows: rows)
    assert part.through() is None
    jobs.build_features(spark, mart, ["extra"], MONTHS[1:2])
    assert store(spark, mart, MONTHS[1:2]) == whole(spark, mart, MONTHS[1:2])
    assert part.through() == (MONTHS[1], 2)


def test_history_without_records(spark, mart):
    history.land(spark.createDataFrame([(None, None, 1, "a")], RECORD), mart.path("silver_extra"))
    assert jobs.build_features(spark, mart, ["extra"], MONTHS[:2]) == MONTHS[:2]
    assert jobs.build_features(spark, mart, ["extra"], MONTHS[2:3]) == MONTHS[2:3]
    assert spark.read.parquet(mart.path("feature_store")).where("amount is not null").count() == 0


def rows_of(spark, path):
    return [r[0] for r in readers.read_table(spark, path).orderBy("id").collect()]


def test_a_lost_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "static")
    writers.write_static(spark.range(3), path)
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.write_static(broken, path)
    assert rows_of(spark, path) == [0, 1, 2]
    writers.write_static(spark.range(2), path)
    assert rows_of(spark, path) == [0, 1] and not (tmp_path / "_new_static").exists()


def test_a_switch_half_done_is_finished(spark, tmp_path):
    path = str(tmp_path / "static")
    spark.range(3).write.parquet(str(tmp_path / "_old_static"))
    spark.range(5).write.parquet(str(tmp_path / "_new_static"))
    assert rows_of(spark, path) == [0, 1, 2, 3, 4]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["static"]
    # Lost after both renames: only the old table is left to remove.
    spark.range(1).write.parquet(str(tmp_path / "_old_static"))
    assert rows_of(spark, path) == [0, 1, 2, 3, 4]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["static"]
