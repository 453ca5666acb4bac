"""Domain vocabulary, lookup weights and per-reading features."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event vocabulary, weights and thresholds of the curated tables.
RISK_TYPES = ("FOG", "SNOW", "THUNDERSTORM")
RISK_SEVERITIES = ("Moderate", "Heavy")
WINTER_TYPES = ("SNOW", "ICE", "COLD")
STORM_TYPES = ("STORM",)
SEVERITY_WEIGHTS = {"Light": 1, "Moderate": 2, "Heavy": 3}
OTHER_SEVERITY_WEIGHT = 1
WINTER_TYPE_WEIGHTS = {"SNOW": 3, "ICE": 2, "COLD": 1}
OTHER_TYPE_WEIGHT = 0
FREEZE_PATTERN = ("RAIN", "COLD", "SNOW")
FREEZE_LABEL = "RAIN→FREEZE→SNOW"
HEAT_STRESS_TEMP_C = 30.0
HEAT_STRESS_HUMIDITY = 60.0


def type_in(column: str, types: Iterable[str]) -> Column:
    """``IN`` list over event types.

    The cleaned table stores types in upper case, so the list is folded instead
    of the column: the bare column keeps the predicate usable for the scan.
    """
    return F.col(column).isin([t.strip().upper() for t in types])


def severity_in(column: str, severities: Iterable[str]) -> Column:
    """``IN`` list over severities, which the cleaned table stores as ``Xxxx``."""
    return F.col(column).isin([s.strip().capitalize() for s in severities])


def lookup(column: str, weights: Mapping[str, int], default: int) -> Column:
    """Weight of a category as a ``CASE`` chain; the default if there are no weights."""
    expr = F
    for key, weight in weights.items():
        expr = expr.when(F.col(column) == key, weight)
    return expr.otherwise(default) if weights else F.lit(default)


def severity_weight(column: str, weights: Mapping[str, int] = SEVERITY_WEIGHTS) -> Column:
    folded = {key.strip().capitalize(): weight for key, weight in weights.items()}
    return lookup(column, folded, OTHER_SEVERITY_WEIGHT)


def winter_type_weight(column: str, weights: Mapping[str, int] = WINTER_TYPE_WEIGHTS) -> Column:
    folded = {key.strip().upper(): weight for key, weight in weights.items()}
    return lookup(column, folded, OTHER_TYPE_WEIGHT)


def require_vocabulary(events: DataFrame, most: int = 50) -> None:
    """Raise if there are more than ``most`` event types: pairing types multiplies rows."""
    found = events.select("type").distinct().limit(most + 1).count()
    if found > most:
        raise ValueError(f"more than {most} event types")


def pair_label(a: Column, b: Column) -> Column:
    """Order-free label of a pair of types, ``FOG+RAIN`` for either order."""
    return F.concat_ws("+", F.least(a, b), F.greatest(a, b))


def rainy_flag() -> Column:
    return F.when(F.col("precip_in") > 0.0, 1.0).otherwise(0.0)


def heat_stress() -> Column:
    return (F.col("temp_c") >= HEAT_STRESS_TEMP_C) & (F.col("humidity") >= HEAT_STRESS_HUMIDITY)


def daytime_flag() -> Column:
    return F.when(F.col("is_day") == 1, 1.0).otherwise(0.0)


def dewpoint_spread() -> Column:
    return F.col("temp_c") - F.col("dewpoint_c")


def gust_factor() -> Column:
    """Gust over mean wind; 1 when there is no wind or no wind reading."""
    return F.when(F.col("wind_kph") > 0, F.col("gust_kph") / F.col("wind_kph")).otherwise(1.0)
