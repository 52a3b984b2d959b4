"""Quality gate: a report row per finding, for all months at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.operators.profile import (
    NULL_WARN,
    any_negative_sql,
    duplicate_rate,
    first_of_key,
    missing_columns,
    null_rate_sql,
)
from riskmart.schemas import CUSTOMER, MONTH, REQUIRED_FEATURE_COLUMNS

MIN_ROWS = 10
DUPLICATE_WARN = 0.05
MAX_DEFAULT_RATE = 0.80


class QualityGateError(ValueError):
    """A critical finding stops the run."""


def finding(check: str, column: str | None, value: str) -> str:
    """SQL of one finding of a month; a null value means it does not apply."""
    name = f"'{column}'" if column else "CAST(NULL AS STRING)"
    return f"named_struct('check', '{check}', 'column_name', {name}, 'value', CAST({value} AS DOUBLE))"


def severity(check: Column, value: Column) -> Column:
    """critical / warn / ok of a finding."""
    critical = (check == "required_column") | (check == "empty_partition")
    warn = (
        ((check == "feature_partition") & (value == 0))
        | ((check == "row_count") & (value < MIN_ROWS))
        | ((check == "null_rate") & (value > NULL_WARN))
        | ((check == "duplicate_key") & (value > DUPLICATE_WARN))
        | ((check == "null_key") & (value > 0))
        | ((check == "negative_values") & (value > 0))
        | ((check == "default_rate") & ((value == 0) | (value > MAX_DEFAULT_RATE)))
        | (check == "empty_label_partition")
    )
    return F.when(critical, "critical").when(warn, "warn").otherwise("ok")


def unfold(per_month: DataFrame, findings: Sequence[str]) -> DataFrame:
    """One row per finding and month with its severity; those that do not apply are dropped."""
    listed = F.expr(f"explode(array({', '.join(findings)}))")
    rows = per_month.select(MONTH, listed.alias("_f")).select(MONTH, "_f.*")
    return rows.where(F.col("value").isNotNull()).withColumn(
        "severity", severity(F.col("check"), F.col("value"))
    )


def feature_findings(
    features: DataFrame,
    months: DataFrame,
    required: Sequence[str] = REQUIRED_FEATURE_COLUMNS,
    one_pass: bool = False,
) -> DataFrame:
    """Row count, required columns, null rates, duplicate and null keys, negative clickstream.

    Stored features are best read twice, the second time their keys alone. ``one_pass`` suits features that
    are still to be computed and whose rows then lie by customer: they are computed once.
    """
    columns = [c for c in features.columns if c != MONTH]
    channels = [c for c in columns if c.startswith("fe_")]
    by_key = CUSTOMER in columns
    rows, copies = features, []
    if by_key and one_pass:
        rows = features.withColumn("_first", first_of_key([CUSTOMER, MONTH]))
        further = F.count_if(~F.col("_first")).cast("double")
        copies = [F.try_divide(further, F.count(F.lit(1)).cast("double")).alias("duplicate_rate")]
    profile = rows.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("_rows"),
        *copies,
        *[F.expr(null_rate_sql(features, c)).alias(f"null_{c}") for c in columns],
        *[F.expr(any_negative_sql(c)).alias(f"negative_{c}") for c in channels],
    )
    findings = [
        finding("feature_partition", None, "coalesce(_rows, 0)"),
        finding("row_count", None, "_rows"),
        *[
            finding("required_column", c, "CASE WHEN _rows IS NOT NULL THEN 0 END")
            for c in missing_columns(features, required)
        ],
        *[finding("null_rate", c, f"`null_{c}`") for c in columns],
        *[finding("negative_values", c, f"CAST(`negative_{c}` AS INT)") for c in channels],
    ]
    if by_key:
        if not one_pass:
            profile = profile.join(duplicate_rate(features, [CUSTOMER], [MONTH]), MONTH, "left")
        findings.append(finding("duplicate_key", CUSTOMER, "duplicate_rate"))
        findings.append(finding("null_key", CUSTOMER, f"`null_{CUSTOMER}`"))
    return unfold(months.select(MONTH).distinct().join(profile, MONTH, "left"), findings)


def label_findings(labels: DataFrame) -> DataFrame:
    """Default rate sanity of the months that have labels."""
    rates = labels.groupBy(MONTH).agg(F.avg("label").alias("_rate"))
    return unfold(rates, [finding("default_rate", "label", "_rate")])


def quality_report(
    features: DataFrame,
    labels: DataFrame,
    months: DataFrame,
    required: Sequence[str] = REQUIRED_FEATURE_COLUMNS,
    one_pass: bool = False,
) -> DataFrame:
    """All findings of the wanted ``months``: snapshot_date, check, column_name, value, severity.

    A month without features only gets a warning; a built partition that lacks required
    columns is critical. ``one_pass`` is that of ``feature_findings``.
    """
    wanted = months.select(MONTH).distinct()
    in_scope = labels.join(wanted, MONTH, "left_semi")
    return feature_findings(features, wanted, required, one_pass).unionByName(label_findings(in_scope))


def absent_features(months: DataFrame) -> DataFrame:
    """The warning for months that have no features."""
    return unfold(months, [finding("feature_partition", None, "0")])


def empty_partitions(built: DataFrame, table: DataFrame, check: str = "empty_partition") -> DataFrame:
    """Months that were written but hold no row: critical for features, a warning for
    labels (``check="empty_label_partition"``)."""
    empty = built.select(MONTH).distinct().join(table.select(MONTH).distinct(), MONTH, "left_anti")
    return unfold(empty, [finding(check, None, "0")])


def require_passed(report: DataFrame) -> None:
    """Raise when the report has critical rows; only their number and a few names are fetched."""
    critical = report.where(F.col("severity") == "critical")
    summary = critical.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(MONTH, "check", "column_name")).alias("first"),
    ).first()
    if summary["n"]:
        first = summary["first"]
        where = f"{first['check']} {first['column_name'] or ''}".strip()
        raise QualityGateError(
            f"{summary['n']} critical finding(s), first: {where} in {first[MONTH]}"
        )
