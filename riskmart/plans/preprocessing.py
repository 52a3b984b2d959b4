"""Median imputation and scaling fitted on the training rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators.quantiles import exact_medians, long_features, moments


@dataclass(frozen=True)
class Preprocessing:
    """Per-feature medians, means and population deviations."""

    features: list[str]
    medians: list[float]
    means: list[float]
    deviations: list[float]

    def impute(self, df: DataFrame) -> DataFrame:
        """Replace missing feature values by the training median."""
        missing = F.lit(None).cast("double")
        return df.withColumns(
            {
                name: F.coalesce(F.nanvl(F.col(name).cast("double"), missing), F.lit(median))
                for name, median in zip(self.features, self.medians)
            }
        )

    def scale(self, df: DataFrame) -> DataFrame:
        """Centre and scale imputed features; a constant feature is only centred."""
        return df.withColumns(
            {
                name: (F.col(name) - F.lit(mean)) / F.lit(deviation or 1.0)
                for name, mean, deviation in zip(self.features, self.means, self.deviations)
            }
        )


def fit(train: DataFrame, features: Sequence[str], weight: str | None = None) -> Preprocessing:
    """Fit on the training rows; features without any value are left out.

    Only the parameters, a few numbers per feature, come to the driver.
    """
    keep = [weight] if weight else []
    medians = {
        row["feature"]: row["median"]
        for row in exact_medians(
            long_features(train, features, keep), ["feature"], "value", weight
        ).collect()
    }
    kept = [name for name in features if name in medians]
    filled = [medians[name] for name in kept]
    imputed = Preprocessing(kept, filled, [], []).impute(train)
    spread = {
        row["feature"]: row
        for row in moments(long_features(imputed, kept, keep), ["feature"], "value", weight).collect()
    }
    return Preprocessing(
        kept,
        filled,
        [spread[name]["mean"] for name in kept],
        [math.sqrt(max(spread[name]["squares"], 0.0) / spread[name]["n"]) for name in kept],
    )
