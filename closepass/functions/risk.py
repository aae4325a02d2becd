"""Risk scores and categories."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from closepass.functions.numeric import _col, dround


@dataclass(frozen=True)
class RiskWeights:
    """Score terms: size ``30 - h``, nearness ``0.1 - dist`` and bounded speed."""

    size: float
    nearness: float
    speed: float
    top_speed: float


# Weights of the score, the first version of it, and its bounds.
STANDARD = RiskWeights(size=1.33, nearness=400.0, speed=0.33, top_speed=60.0)
FIRST_VERSION = RiskWeights(size=2.0, nearness=500.0, speed=2.0, top_speed=50.0)
FAINTEST_H = 30.0
NEAR_LIMIT_AU = 0.1
SCORE_CAP = 100.0

# Thresholds and labels, first match wins.
RISK_LEVELS = ((18.0, 0.05, "VERY_HIGH"), (20.0, 0.1, "HIGH"), (25.0, 0.2, "MEDIUM"))
RISK_REST = "LOW"
COARSE_RISK_LEVELS = ((18.0, 0.05, "HIGH_RISK"), (22.0, 0.1, "MEDIUM_RISK"))
COARSE_RISK_REST = "LOW_RISK"
SIZE_CLASSES = (
    (18.0, "Very Large (>1km)"),
    (22.0, "Large (140m-1km)"),
    (25.0, "Medium (30-140m)"),
)
SIZE_REST = "Small (<30m)"
SPEED_CLASSES = (
    (10.0, "Slow (<10 km/s)"),
    (20.0, "Moderate (10-20 km/s)"),
    (30.0, "Fast (20-30 km/s)"),
)
SPEED_REST = "Very Fast (>30 km/s)"


def raw_risk_score(
    h: Column | str = "h",
    dist: Column | str = "dist",
    v_rel: Column | str = "v_rel",
    weights: RiskWeights = STANDARD,
) -> Column:
    """Unrounded, uncapped score.  ``greatest``/``least`` skip NULLs, so filter NULLs first."""
    size = F.greatest(F.lit(0.0), F.lit(FAINTEST_H) - _col(h))
    nearness = F.greatest(F.lit(0.0), F.lit(NEAR_LIMIT_AU) - _col(dist))
    speed = F.least(_col(v_rel), F.lit(weights.top_speed))
    return (
        size * F.lit(weights.size)
        + nearness * F.lit(weights.nearness)
        + speed * F.lit(weights.speed)
    )


def risk_score(
    h: Column | str = "h",
    dist: Column | str = "dist",
    v_rel: Column | str = "v_rel",
    weights: RiskWeights = STANDARD,
) -> Column:
    """Score to two digits, not capped."""
    return dround(raw_risk_score(h, dist, v_rel, weights), 2)


def capped_risk_score(
    h: Column | str = "h",
    dist: Column | str = "dist",
    v_rel: Column | str = "v_rel",
    weights: RiskWeights = STANDARD,
    digits: int | None = 2,
) -> Column:
    """Score of at most 100; 0.0 when any input is NULL or NaN."""
    inputs = [_col(c) for c in (h, dist, v_rel)]
    missing = F.lit(False)
    for c in inputs:
        missing = missing | c.isNull() | F.isnan(c)
    capped = F.least(raw_risk_score(*inputs, weights), F.lit(SCORE_CAP))
    return F.when(missing, F.lit(0.0)).otherwise(
        capped if digits is None else dround(capped, digits)
    )


def level_by_size_and_distance(
    levels: Sequence[tuple[float, float, str]],
    rest: str,
    h: Column | str = "h",
    dist: Column | str = "dist",
) -> Column:
    """Label of the first level with ``h`` and ``dist`` below its bounds."""
    label = None
    for h_bound, dist_bound, name in levels:
        inside = (_col(h) < F.lit(h_bound)) & (_col(dist) < F.lit(dist_bound))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(rest)


def risk_category(h: Column | str = "h", dist: Column | str = "dist") -> Column:
    """VERY_HIGH, HIGH, MEDIUM or LOW."""
    return level_by_size_and_distance(RISK_LEVELS, RISK_REST, h, dist)


def coarse_risk_category(h: Column | str = "h", dist: Column | str = "dist") -> Column:
    """HIGH_RISK, MEDIUM_RISK or LOW_RISK."""
    return level_by_size_and_distance(COARSE_RISK_LEVELS, COARSE_RISK_REST, h, dist)


def bucketize(c: Column | str, bounds: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first upper bound the value lies below, else ``rest``."""
    label = None
    for upper, name in bounds:
        below = _col(c) < F.lit(upper)
        label = F.when(below, name) if label is None else label.when(below, name)
    return label.otherwise(rest)


def size_category(h: Column | str = "h") -> Column:
    return bucketize(h, SIZE_CLASSES, SIZE_REST)


def speed_category(v_rel: Column | str = "v_rel") -> Column:
    return bucketize(v_rel, SPEED_CLASSES, SPEED_REST)


def temporal_segment(
    year: Column | str = "approach_year", last_past: int = 2025, first_future: int = 2026
) -> Column:
    """``historical`` up to one year, ``future`` from another; NULL for neither."""
    return F.when(_col(year) <= last_past, "historical").when(
        _col(year) >= first_future, "future"
    )


def register_sql_functions(spark: SparkSession, name: str = "approach_risk") -> str:
    """Create a temporary SQL function for the capped score.

    Catalyst inlines the body, so it costs what the column expression costs and
    starts no Python worker.
    """
    w = STANDARD
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(h DOUBLE, d DOUBLE, v DOUBLE)
        RETURNS DOUBLE
        RETURN CASE
            WHEN h IS NULL OR d IS NULL OR v IS NULL
                 OR isnan(h) OR isnan(d) OR isnan(v) THEN 0D
            ELSE round(least(greatest(0D, {FAINTEST_H}D - h) * {w.size}D
                             + greatest(0D, {NEAR_LIMIT_AU}D - d) * {w.nearness}D
                             + least(v, {w.top_speed}D) * {w.speed}D, {SCORE_CAP}D)
                       * 100D, 0) / 100D
        END
        """
    )
    return name
