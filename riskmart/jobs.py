"""The monthly pipeline as jobs over all months that are due.

A month is built, scored and measured once. Jobs work on what is missing, read only the
partitions of those months, and can be run again. A raw file is parsed once. A finished month is built
or measured again only when what it was built from has changed, and scored again only on an
explicit ``rebuild``.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.asof import asof_latest
from riskmart.operators.stability import score_profile
from riskmart.plans import datamart, governance, monitoring, quality, training, training_data
from riskmart.schemas import (
    CUSTOMER,
    MOB,
    MONTH,
    RAW_ATTRIBUTE_COLUMNS,
    RAW_CLICKSTREAM_COLUMNS,
    RAW_FINANCIAL_COLUMNS,
    loan_schema,
    text_schema,
)
from riskmart.session import tune
from riskmart.sources import filelog, history, readers, writers
from riskmart.sources.scratch import keep, temporary

REGISTRY_SCHEMA = "model_version string, role string, valid_from timestamp, reason string, sequence bigint"
COMPARISON_SCHEMA = (
    "model string, split string, n_scored bigint, auc double, gini double, ks double, "
    "is_champion boolean, train_date timestamp, model_version string"
)
METADATA_SCHEMA = (
    "model string, parameters string, excluded_features array<string>, features array<string>, "
    "calibration string, calibration_rows bigint, train_end date, test_end date, train_date timestamp, "
    "scored_through date, model_version string"
)
MONITORING_SCHEMA = f"{MONTH} date, psi_score double, auc double, challenger_auc double"
CSI_SCHEMA = f"feature string, csi double, model_version string, {MONTH} date"
PROFILE_SCHEMA = (
    "n_predictions bigint, n_scores bigint, mean_score double, std_score double, bins array<bigint>, "
    f"model_version string, challenger_model_version string, {MONTH} date"
)
PERFORMANCE_SCHEMA = f"auc double, gini double, ks double, default_rate double, challenger_auc double, {MONTH} date"
FINISHED_SCHEMA = f"table string, {MONTH} date, fingerprint string, built_from string, finished_at timestamp"
FINDINGS_SCHEMA = f"check string, column_name string, value double, severity string, {MONTH} date"
# Tables whose months others are built from.
FINGERPRINTED = {
    "bronze_loans",
    "bronze_clickstream",
    "silver_loans",
    "silver_clickstream",
    "label_store",
    "feature_store",
    "predictions",
}
PREDICTION_SCHEMA = (
    f"{CUSTOMER} string, score double, predicted_label int, model_version string, "
    "challenger_score double, challenger_predicted_label int, challenger_model_version string, "
    f"{MONTH} date"
)


@dataclass(frozen=True)
class RawPaths:
    """CSV extracts: files, folders or globs; ``multiline`` if values may hold line breaks (such a
    file is read by one task). ``clickstream_months`` names (folder, prefix) of clickstream Parquet files
    that carry their month in the name; they are landed beside the extract, or without one (None)."""

    loans: str
    clickstream: str | None
    attributes: str
    financials: str
    multiline: bool = False
    clickstream_months: tuple[str, str] | None = None


@dataclass(frozen=True)
class Mart:
    """Where the tables of one datamart live."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def model(self, version: str) -> str:
        return self.path(f"models/{version}")


Months = Sequence[dt.date] | None


def typed_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.col(MONTH).try_cast("date"))


def shifted(month: dt.date, months: int) -> dt.date:
    """The same day some months on; days that a month lacks become its last, as in ``add_months``."""
    place = month.year * 12 + month.month - 1 + months
    for day in range(month.day, month.day - 4, -1):
        try:
            return dt.date(place // 12, place % 12 + 1, day)
        except ValueError:
            continue
    raise ValueError(month)


def fingerprints(rows: DataFrame) -> dict[dt.date, str]:
    """For each month the number of its rows and the sum of their hashes, whatever their order."""
    hashed = F.xxhash64(*sorted(c for c in rows.columns if c != MONTH)).cast("decimal(20,0)")
    states = rows.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("sum"))
    return {r[MONTH]: f"{r['n']}:{r['sum']}" for r in states.collect()}


def finished_log(spark: SparkSession, mart: Mart) -> DataFrame:
    path = mart.path("finished")
    if not readers.path_exists(spark, path):
        return spark.createDataFrame([], FINISHED_SCHEMA)
    return spark.read.schema(FINISHED_SCHEMA).parquet(path)  # logs of earlier versions lack columns


def month_states(spark: SparkSession, mart: Mart, table: str) -> dict[dt.date, tuple[str | None, str | None]]:
    """For each finished month of a table its fingerprint and that of what it was built from."""
    latest = F.max(F.struct("finished_at", "fingerprint", "built_from")).alias("s")
    rows = finished_log(spark, mart).where(F.col("table") == table).groupBy(MONTH).agg(latest)
    return {r[MONTH]: (r["s"]["fingerprint"], r["s"]["built_from"]) for r in rows.collect()}


def finished_months(spark: SparkSession, mart: Mart, table: str) -> set[dt.date]:
    """Months of a table that are done, also those that gave no row."""
    return set(month_states(spark, mart, table))


def current(spark: SparkSession, mart: Mart, *tables: str) -> dict[dt.date, str]:
    """The fingerprints of the months of ``tables`` as they are now, joined; months unknown to any have none."""
    states = [month_states(spark, mart, t) for t in tables]
    months = set.intersection(*map(set, states))
    joined = {m: [s[m][0] for s in states] for m in months}
    return {m: "|".join(parts) for m, parts in joined.items() if all(parts)}


def stale_months(
    spark: SparkSession, mart: Mart, table: str, months: Sequence[dt.date], sources: dict[dt.date, str], rebuild: bool = False
) -> list[dt.date]:
    """Those of ``months`` that ``table`` has not been built for, or whose source has changed since."""
    done = month_states(spark, mart, table)
    return sorted(
        m for m in months if rebuild or m not in done or (m in sources and done[m][1] != sources[m])
    )


def mark_finished(
    spark: SparkSession,
    mart: Mart,
    table: str,
    months: Sequence[dt.date],
    sources: dict[dt.date, str] | None = None,
) -> None:
    """Log months as built from ``sources``; with the fingerprint of what was written, if others are built from it."""
    if not months:
        return
    states = {}
    fingerprinted = table in FINGERPRINTED
    if fingerprinted and readers.month_partitions(spark, mart.path(table)):
        states = fingerprints(readers.in_months(spark.read.parquet(mart.path(table)), months))
    now = dt.datetime.now()
    rows = [(table, m, states.get(m, "0:0") if fingerprinted else None, (sources or {}).get(m), now) for m in months]
    writers.append_rows(spark.createDataFrame(rows, FINISHED_SCHEMA).coalesce(1), mart.path("finished"))


def fresh_files(spark: SparkSession, mart: Mart, table: str, pattern: str, rebuild: bool) -> list[filelog.RawFile]:
    files = filelog.listed(spark, pattern)
    if not files:
        raise FileNotFoundError(pattern)
    return files if rebuild else filelog.changed(spark, mart.path("landed_files"), table, files)


def land_months(
    spark: SparkSession,
    mart: Mart,
    table: str,
    pattern: str,
    parse: Callable[[list[str]], DataFrame],
    months: Months = None,
    rebuild: bool = False,
) -> list[dt.date]:
    """Parse raw files that are new or have changed, and write the months they hold. Returns these.

    Late rows of a landed month arrive in a new file or a longer one: the month is written again with the
    rows other files gave it, and what is built from it is due again. A changed file replaces its own
    rows in the months it holds. A file is parsed once, so all its months are landed; ``months`` limits a ``rebuild``.
    """
    files = fresh_files(spark, mart, table, pattern, rebuild)
    if not files:
        return []
    with temporary():
        rows = parse([f.path for f in files]).where(F.col(MONTH).isNotNull())
        if rebuild and months is not None:
            rows = readers.in_months(rows, sorted(months))
        rows = keep(rows, f"raw_{table}")
        touched = sorted(r[0] for r in rows.select(MONTH).distinct().collect())
        before = sorted(set(touched) & set(readers.month_partitions(spark, mart.path(table))))
        if before:
            landed = readers.in_months(spark.read.parquet(mart.path(table)), before)
            if filelog.SOURCE in landed.columns:
                others = landed.join(rows.select(filelog.SOURCE).distinct(), filelog.SOURCE, "left_anti")
                rows = rows.unionByName(others, allowMissingColumns=True)
        writers.write_months(rows, mart.path(table))
        mark_finished(spark, mart, table, touched)
        if months is None or not rebuild:
            filelog.record(spark, mart.path("landed_files"), table, files)
    return touched


def land_month_files(spark: SparkSession, mart: Mart, table: str, folder: str, prefix: str, months: Months = None) -> list[dt.date]:
    """Land Parquet files that carry their month in the name (``<prefix>YYYY_MM_DD.parquet``)."""

    def parse(paths: list[str]) -> DataFrame:
        rows = filelog.with_source(readers.read_month_files(spark, folder, prefix, paths))
        return rows if months is None else readers.in_months(rows, sorted(months))

    return land_months(spark, mart, table, f"{folder.rstrip('/')}/{prefix}*.parquet", parse)


def due_months(
    spark: SparkSession, mart: Mart, table: str, source: str, months: Months, rebuild: bool
) -> tuple[list[dt.date], dict[dt.date, str]]:
    """Months of ``source`` that ``table`` has not been built from as they are now, and how they all are."""
    have = set(readers.month_partitions(spark, mart.path(source)))
    sources = current(spark, mart, source)
    return stale_months(spark, mart, table, have if months is None else have & set(months), sources, rebuild), sources


def build_months(
    spark: SparkSession,
    mart: Mart,
    table: str,
    source: str,
    plan: Callable[[DataFrame], DataFrame],
    months: Months,
    rebuild: bool,
) -> None:
    """Apply ``plan`` to the partitions of ``source`` that ``table`` has not been built from as they are now."""
    todo, sources = due_months(spark, mart, table, source, months, rebuild)
    if not todo:
        return
    rows = readers.in_months(spark.read.parquet(mart.path(source)), todo)
    writers.write_months(plan(rows), mart.path(table))
    mark_finished(spark, mart, table, todo, sources)


def build_features(
    spark: SparkSession, mart: Mart, names: Sequence[str], months: Months = None, rebuild: bool = False
) -> list[dt.date]:
    """Build the feature store's due months from visits and the histories ``names``. Returns these months.

    Of a history the latest records carried from the last month built are read, and those that they lack;
    the whole history only for months before that one. What is carried is then moved on.
    """
    todo, sources = due_months(spark, mart, "feature_store", "silver_clickstream", months, rebuild)
    if not todo:
        return []
    visits = readers.in_months(spark.read.parquet(mart.path("silver_clickstream")), todo)
    parts = [history.History(spark, mart.path(f"silver_{n}"), mart.path(f"latest_{n}"), datamart.encoded_history) for n in names]
    records = {n: p.records(todo) for n, p in zip(names, parts)}
    writers.write_months(asof_latest(visits, records) if records else visits, mart.path("feature_store"))
    mark_finished(spark, mart, "feature_store", todo, sources)
    for part in parts:
        part.carry(max(todo))
    return todo


def land_history(
    spark: SparkSession,
    mart: Mart,
    name: str,
    pattern: str,
    parse: Callable[[list[str]], DataFrame],
    clean: Callable[[DataFrame], DataFrame],
    rebuild: bool,
) -> None:
    """Parse raw files that are new or have changed, land their dated records that are new, and clean only those."""
    bronze, silver = mart.path(f"bronze_{name}"), mart.path(f"silver_{name}")
    whole = rebuild or not history.landings(spark, silver)
    files = fresh_files(spark, mart, f"bronze_{name}", pattern, whole)
    if whole:
        writers.write_static(parse([f.path for f in files]), bronze)
        history.land(clean(spark.read.parquet(bronze)), silver, whole=True)
    elif files:
        readers.settle(spark, bronze)
        known = spark.read.parquet(bronze).select(F.col(CUSTOMER).alias("c"), F.col(MONTH).alias("m"))
        same = F.col(CUSTOMER).eqNullSafe(F.col("c")) & F.col(MONTH).eqNullSafe(F.col("m"))
        with temporary():
            new = keep(parse([f.path for f in files]).join(known, same, "left_anti"), f"new_{name}")
            if not new.isEmpty():
                history.land(clean(new), silver)
                writers.append_rows(new, bronze)
    if files:
        filelog.record(spark, mart.path("landed_files"), f"bronze_{name}", files)


def build_datamart(
    spark: SparkSession, raw: RawPaths, mart: Mart, months: Months = None, rebuild: bool = False
) -> None:
    """Raw extracts to label store and feature store; months already built are skipped."""
    tune(spark)

    def text(schema: T.StructType) -> Callable[[list[str]], DataFrame]:
        return lambda paths: filelog.with_source(readers.read_text_csv(spark, paths, schema, raw.multiline))

    def extract(columns: list[str]) -> Callable[[list[str]], DataFrame]:
        return lambda paths: datamart.normalise_text(text(text_schema(columns))(paths))

    def build(table: str, source: str, plan: Callable[[DataFrame], DataFrame]) -> None:
        build_months(spark, mart, table, source, plan, months, rebuild)

    def loans(paths: list[str]) -> DataFrame:
        return typed_month(text(loan_schema())(paths))

    land_months(spark, mart, "bronze_loans", raw.loans, loans, months, rebuild)
    build("silver_loans", "bronze_loans", datamart.silver_loans)
    build("label_store", "silver_loans", datamart.label_store)

    def clicks(paths: list[str]) -> DataFrame:
        return typed_month(extract(RAW_CLICKSTREAM_COLUMNS)(paths))

    if raw.clickstream is not None:
        land_months(spark, mart, "bronze_clickstream", raw.clickstream, clicks, months, rebuild)
    if raw.clickstream_months is not None:
        land_month_files(spark, mart, "bronze_clickstream", *raw.clickstream_months)
    build("silver_clickstream", "bronze_clickstream", datamart.silver_clickstream)

    land_history(
        spark, mart, "attributes", raw.attributes, extract(RAW_ATTRIBUTE_COLUMNS), datamart.silver_attributes, rebuild
    )
    land_history(
        spark, mart, "financials", raw.financials, extract(RAW_FINANCIAL_COLUMNS), datamart.silver_financials, rebuild
    )
    build_features(spark, mart, ("attributes", "financials"), months, rebuild)


def profile_months(
    spark: SparkSession, mart: Mart, table: str, source: str, plan: Callable[[DataFrame, DataFrame], DataFrame], months: Sequence[dt.date]
) -> None:
    """Store the findings of those months of ``source`` that have none yet or have changed since."""
    have = set(months) & set(readers.month_partitions(spark, mart.path(source)))
    sources = current(spark, mart, source)
    todo = stale_months(spark, mart, table, have, sources)
    if todo:
        rows = readers.in_months(spark.read.parquet(mart.path(source)), todo)
        dates = spark.createDataFrame([(m,) for m in todo], f"{MONTH} date")
        writers.write_months(plan(rows, dates), mart.path(table))
        mark_finished(spark, mart, table, todo, sources)


def check_quality(spark: SparkSession, mart: Mart, months: Months = None) -> DataFrame:
    """Write the quality report and stop on critical findings.

    By default of all months that have clickstream or labels: a month without features is
    reported, and so is one that was built but holds no row. A month is profiled once, when it is new or
    has changed; its findings are kept, and the gate reads these few rows.
    """
    clicks = readers.month_partitions(spark, mart.path("silver_clickstream"))
    built = {t: finished_months(spark, mart, t) for t in ("feature_store", "label_store")}
    if months is None:
        months = sorted({*clicks, *built["label_store"]})
    have = {t: set(readers.month_partitions(spark, mart.path(t))) for t in built}
    profile_months(spark, mart, "feature_findings", "feature_store", quality.feature_findings, months)
    profile_months(spark, mart, "label_findings", "label_store", lambda rows, _: quality.label_findings(rows), months)

    def dates(wanted: set[dt.date]) -> DataFrame:
        return spark.createDataFrame([(m,) for m in sorted(wanted)], f"{MONTH} date")

    stored = [readers.read_table(spark, mart.path(t), FINDINGS_SCHEMA) for t in ("feature_findings", "label_findings")]
    parts = [readers.in_months(t, [m for m in months if m in have[s]]) for t, s in zip(stored, built)]
    parts.append(quality.absent_features(dates(set(months) - have["feature_store"])))
    for table, check in (("feature_store", "empty_partition"), ("label_store", "empty_label_partition")):
        parts.append(quality.empty_partitions(dates(built[table] & set(months)), dates(have[table]), check))
    writers.write_months(reduce(DataFrame.unionByName, parts), mart.path("quality_report"))
    report = readers.in_months(spark.read.parquet(mart.path("quality_report")), months)
    quality.require_passed(report)
    return report


def registry(spark: SparkSession, mart: Mart) -> DataFrame:
    return readers.read_table(spark, mart.path("registry"), REGISTRY_SCHEMA)


def version_of(spark: SparkSession, mart: Mart, role: str) -> str | None:
    """Model version now in a role."""
    row = governance.version_in_role(registry(spark, mart), role).first()
    return row["model_version"] if row else None


def of_version(spark: SparkSession, mart: Mart, table: str, version: str | None, schema: str | None = None) -> DataFrame:
    """Rows of one model version; only its partition is read."""
    rows = readers.read_table(spark, mart.path(table), schema)
    if writers.VERSION_KEY in rows.columns:
        return rows.where(F.col(writers.VERSION_KEY) == f"version {version}").drop(writers.VERSION_KEY)
    return rows.where(F.col("model_version") == F.lit(version))


def decide_retrain(spark: SparkSession, mart: Mart) -> DataFrame:
    """One row: train a challenger or not, and why."""
    champion = version_of(spark, mart, "champion")
    challenger = version_of(spark, mart, "challenger")
    chosen = of_version(spark, mart, "model_comparison", champion, COMPARISON_SCHEMA).where("is_champion")
    baseline = governance.selection_scores(chosen).agg(F.max("selection_auc")).scalar()
    table = readers.read_table(spark, mart.path("monitoring"), MONITORING_SCHEMA)
    return governance.retrain_decision(
        table, F.lit(champion is not None), F.lit(challenger is not None), baseline
    )


def drifted_features(spark: SparkSession, mart: Mart) -> list[str]:
    """Names of the features to leave out of training; at most one row per feature."""
    csi = of_version(spark, mart, "csi", version_of(spark, mart, "champion"), CSI_SCHEMA)
    return sorted(r["feature"] for r in governance.drifted_features(csi).select("feature").collect())


def train(
    spark: SparkSession,
    mart: Mart,
    version: str,
    at: Column | None = None,
    options: training.TrainingOptions = training.TrainingOptions(),
) -> training.TrainingResult | None:
    """Train a challenger and register it; the first model becomes champion at once.

    Training a version again replaces its model and all tables that describe it.
    """
    at = F.current_timestamp() if at is None else at.cast("timestamp")
    store = datamart.with_engineered(spark.read.parquet(mart.path("feature_store")))
    dataset = training_data.labelled_dataset(store, spark.read.parquet(mart.path("label_store")))
    excluded = drifted_features(spark, mart)
    with temporary():
        features = training_data.available_features(dataset.columns, excluded)
        result = training.train_challenger(dataset, features, version, options)
        if result is None:
            return None
        result.model.save(spark, mart.model(version))
        scored = readers.month_partitions(spark, mart.path("predictions"))
        metadata = spark.createDataFrame(
            [
                (
                    result.model.name,
                    json.dumps({"boosted_trees": result.parameters, "options": asdict(options)}),
                    excluded,
                    list(result.model.preprocessing.features),
                    result.model.calibrator.method,
                    result.calibration_rows,
                    dt.date.fromisoformat(options.train_end),
                    dt.date.fromisoformat(options.test_end),
                    None,
                    max(scored, default=None),
                    version,
                )
            ],
            METADATA_SCHEMA,
        ).withColumn("train_date", at)
        for name, table in (
            ("model_metadata", metadata),
            ("model_comparison", result.comparison.withColumn("train_date", at)),
            ("feature_importance", result.importances),
            ("feature_baseline", result.baseline),
            ("train_scores", result.train_scores),
            ("training_splits", result.splits),
        ):
            writers.write_version(table, mart.path(name), version)

    log = registry(spark, mart)
    bootstrap = governance.version_in_role(log, "champion").isEmpty()
    writers.append_rows(governance.registration(log, version, at), mart.path("registry"))
    if bootstrap:
        promote(spark, mart, at, "bootstrap")
    return result


def promote(spark: SparkSession, mart: Mart, at: Column, reason: str) -> None:
    """Move the challenger to champion and archive the old champion."""
    changes = governance.promotion(registry(spark, mart), at, reason)
    writers.append_rows(changes, mart.path("registry"))


def score(spark: SparkSession, mart: Mart, months: Months = None, rebuild: bool = False) -> list[dt.date]:
    """Predict the scoring months that are due, by the champion and a challenger in shadow.

    A scoring month is due when its features exist and it has no predictions; others are only
    written again on ``rebuild``. Returns the months written.
    """
    champion = version_of(spark, mart, "champion")
    if champion is None:
        return []
    challenger = version_of(spark, mart, "challenger")
    possible = {shifted(m, MOB) for m in readers.month_partitions(spark, mart.path("feature_store"))}
    wanted = possible if months is None else possible & set(months)
    done = set() if rebuild else set(readers.month_partitions(spark, mart.path("predictions")))
    todo = sorted(wanted - done)
    if not todo:
        return []
    # The months are filtered before the shift, so only their feature partitions are read.
    sources = [m for m in readers.month_partitions(spark, mart.path("feature_store")) if shifted(m, MOB) in todo]
    store = readers.in_months(spark.read.parquet(mart.path("feature_store")), sources)
    predictions = training.score_month_rows(
        datamart.with_engineered(training_data.scoring_features(store)),
        training.load_scoring_model(spark, mart.model(champion)),
        training.load_scoring_model(spark, mart.model(challenger)) if challenger else None,
    )
    writers.write_months(predictions, mart.path("predictions"))
    mark_finished(spark, mart, "predictions", todo)
    return todo


def measure(spark: SparkSession, mart: Mart, rebuild: bool = False) -> None:
    """Store what monitoring needs of each new month: bin counts, ranking metrics and CSI.

    A month's predictions, labels and features are read once, and again when they have changed.
    CSI belongs to the champion whose training bins it uses; a new champion gets its own.
    """
    champion = version_of(spark, mart, "champion")
    scored = readers.month_partitions(spark, mart.path("predictions"))

    sources = current(spark, mart, "predictions")
    todo = stale_months(spark, mart, "score_profile", scored, sources, rebuild)
    if todo:
        rows = readers.in_months(spark.read.parquet(mart.path("predictions")), todo)
        versions = rows.groupBy(MONTH).agg(
            F.max("model_version").alias("model_version"),
            F.max("challenger_model_version").alias("challenger_model_version"),
        )
        writers.write_months(score_profile(rows).join(versions, MONTH), mart.path("score_profile"))
        mark_finished(spark, mart, "score_profile", todo, sources)

    labelled = set(readers.month_partitions(spark, mart.path("label_store")))
    sources = current(spark, mart, "predictions", "label_store")
    todo = stale_months(spark, mart, "cohort_performance", labelled.intersection(scored), sources, rebuild)
    if todo:
        rows = readers.in_months(spark.read.parquet(mart.path("predictions")), todo)
        labels = readers.in_months(spark.read.parquet(mart.path("label_store")), todo)
        writers.write_months(monitoring.cohort_performance(rows, labels), mart.path("cohort_performance"))
        mark_finished(spark, mart, "cohort_performance", todo, sources)

    store_months = set(readers.month_partitions(spark, mart.path("feature_store")))
    sources = current(spark, mart, "feature_store")
    todo = stale_months(spark, mart, f"csi of {champion}", store_months.intersection(scored), sources, rebuild)
    if todo:
        store = readers.in_months(spark.read.parquet(mart.path("feature_store")), todo)
        baseline = of_version(spark, mart, "feature_baseline", champion)
        edges = baseline.select("feature", F.col("percentiles").alias("edges"))
        tracked = tracked_features(spark, mart, champion, store.columns)
        if tracked:
            writers.write_version_months(monitoring.csi_table(store, edges, tracked), mart.path("csi"), champion)
        mark_finished(spark, mart, f"csi of {champion}", todo, sources)


def tracked_features(spark: SparkSession, mart: Mart, champion: str, columns: Sequence[str]) -> list[str]:
    """Baseline features of the champion that the feature store has; at most one row per feature."""
    baseline = of_version(spark, mart, "feature_baseline", champion)
    return [r["feature"] for r in baseline.select("feature").orderBy("feature").collect() if r["feature"] in columns]


def monitor(spark: SparkSession, mart: Mart, at: Column | None = None, rebuild: bool = False) -> None:
    """Monitoring table, CSI, alerts, and promotion when the challenger has won.

    New months are measured once; the table is then put together from one small row per month.
    """
    at = F.current_timestamp() if at is None else at.cast("timestamp")
    champion = version_of(spark, mart, "champion")
    if champion is None or not readers.path_exists(spark, mart.path("predictions")):
        return
    measure(spark, mart, rebuild)

    train_scores = of_version(spark, mart, "train_scores", champion)
    sample = train_scores.select(F.explode("percentiles").alias("score"))
    tracked = tracked_features(spark, mart, champion, spark.read.parquet(mart.path("feature_store")).columns)
    csi = of_version(spark, mart, "csi", champion, CSI_SCHEMA).select(MONTH, "feature", "csi") if tracked else None
    profile = readers.read_table(spark, mart.path("score_profile"), PROFILE_SCHEMA)
    performance = readers.read_table(spark, mart.path("cohort_performance"), PERFORMANCE_SCHEMA)
    table = monitoring.assemble(profile, performance, sample, csi, tracked)
    writers.write_static(table, mart.path("monitoring"))
    table = spark.read.parquet(mart.path("monitoring"))

    alerts = monitoring.breach_alerts(table, csi).withColumn("raised_at", at)
    writers.append_new(alerts, mart.path("alerts"), [MONTH, "type", "feature"])
    raised = spark.read.parquet(mart.path("alerts"))
    writers.write_json_document(monitoring.latest_alert(raised), mart.path("latest_alert"))

    challenger = version_of(spark, mart, "challenger")
    if challenger is None:
        return
    metadata = of_version(spark, mart, "model_metadata", challenger, METADATA_SCHEMA)
    after = metadata.agg(F.max("scored_through")).scalar()
    decision = governance.promotion_decision(monitoring.in_shadow(table, profile, challenger, after))
    if decision.first()["promote"]:
        log = keep(decision.withColumn("promoted_at", at), "promotion")
        # The log first: a run lost in between finds the challenger still winning and adds no second row.
        writers.append_new(log, mart.path("promotion_log"), ["cohorts"])
        promote(spark, mart, at, "won_consecutive_months")


def run(
    spark: SparkSession,
    raw: RawPaths,
    mart: Mart,
    version: str,
    months: Months = None,
    at: Column | None = None,
    options: training.TrainingOptions = training.TrainingOptions(),
    rebuild: bool = False,
) -> str:
    """Build, check, train when needed, score and monitor what is due. Returns the retrain reason."""
    build_datamart(spark, raw, mart, months, rebuild)
    check_quality(spark, mart, months)
    decision = decide_retrain(spark, mart).first()
    if decision["decision"] == governance.TRAIN:
        train(spark, mart, version, at, options)
    score(spark, mart, months, rebuild)
    monitor(spark, mart, at, rebuild)
    return decision["reason"]
