"""Month-on-book, missed installments, days past due and the default label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(column: Column) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(column.cast("date"), "month")


def installments_missed(overdue: Column, due: Column) -> Column:
    """Missed installments, counting a started one as missed; 0 when nothing is due."""
    missed = F.when(due == 0, F.lit(0.0)).otherwise(
        F.try_divide(overdue.cast("double"), due.cast("double"))
    )
    return F.coalesce(F.ceil(missed).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Date of the first missed installment, null when none was missed."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days since the first missed installment; 0 when nothing is overdue."""
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def default_label(dpd: Column, threshold: int) -> Column:
    """1 at or beyond ``threshold`` days past due, else 0 (also for null)."""
    return F.when(dpd >= threshold, F.lit(1)).otherwise(F.lit(0))


def label_definition(dpd: int, mob: int) -> str:
    """Name of the label definition, such as ``30dpd_6mob``."""
    return f"{dpd}dpd_{mob}mob"
