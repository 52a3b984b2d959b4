"""Drift bands, flags and text of alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRIFT_FROM = 0.10
RETRAIN_FROM = 0.25


def stability_flag(value: Column) -> Column:
    """unknown / stable / drift / retrain by PSI value."""
    return (
        F.when(value.isNull() | F.isnan(value), F.lit("unknown"))
        .when(value < DRIFT_FROM, F.lit("stable"))
        .when(value < RETRAIN_FROM, F.lit("drift"))
        .otherwise(F.lit("retrain"))
    )


def stability_colour(value: Column) -> Column:
    """green / orange / red by PSI or CSI value, null shown as 0."""
    shown = F.coalesce(value, F.lit(0.0))
    return (
        F.when(shown < DRIFT_FROM, F.lit("green"))
        .when(shown < RETRAIN_FROM, F.lit("orange"))
        .otherwise(F.lit("red"))
    )


def alert_line(snapshot: Column, kind: Column, value: Column, flag: Column, feature: Column) -> Column:
    """One log line of an alert."""
    return F.concat_ws(
        " | ",
        F.date_format(snapshot, "yyyy-MM-dd"),
        kind,
        F.concat(F.lit("value="), F.format_string("%.4f", value)),
        F.concat(F.lit("flag="), flag),
        F.concat(F.lit("feature="), feature),
    )
