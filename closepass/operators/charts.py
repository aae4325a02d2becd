"""Datasets behind charts: histograms, cumulative frames, the risk dashboard."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closepass.functions.numeric import clip
from closepass.functions.risk import RISK_LEVELS, RISK_REST, temporal_segment
from closepass.operators.ranking import best_per_object

RISK_LABELS = (*[name for _, _, name in RISK_LEVELS], RISK_REST)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram ``(bin, low, high, count)`` with empty bins.

    A column of one value gets bins over half a unit on both sides of it.  NaN and
    infinite values have no bin: they raise.
    """
    rows = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("__x"))
    limits = (
        rows.agg(F.min("__x").alias("a"), F.max("__x").alias("b"))
        .select(
            F.struct(
                F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
                F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
            ).alias("s")
        )
        .scalar()
    )
    low, high = limits["lo"], limits["hi"]
    position = F.when(
        F.abs("__x") < float("inf"), F.floor((F.col("__x") - low) / (high - low) * float(bins))
    ).otherwise(F.raise_error(F.lit(f"Value without a bin in {column}")).cast("bigint"))
    counts = (
        rows.select(F.least(position, F.lit(bins - 1)).cast("bigint").alias("__bin"))
        .groupBy("__bin")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    width = (high - low) / float(bins)
    return (
        every.join(F.broadcast(counts), F.col("bin") == F.col("__bin"), "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("low"),
            (low + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("__n", F.lit(0)).alias("count"),
        )
        .filter(low.isNotNull())
    )


def rounded_histogram(df: DataFrame, column: str, at_most: int) -> DataFrame:
    """Histogram ``(bin, low, high, count)`` of at most ``at_most`` bins of a round width, empty ones included.

    The width is 1, 2 or 5 times a power of ten, the least that needs no more bins, and edges are
    multiples of it.  A bin holds its lower edge.  NaN and infinite values have no bin: they raise.  Values on both
    sides of zero need two bins, so ``at_most`` must be 2 or more.
    """
    if at_most < 2:
        raise ValueError("at_most must be 2 or more")
    rows = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("__x"))
    # Division by a whole power of ten is exact where multiplication by 0.1 is not.
    number = "floor(CASE WHEN {k} < 0 THEN {x} * pow(10D, -{k}) / {m} ELSE {x} / ({m} * pow(10D, {k})) END)"
    edge = "CASE WHEN {k} < 0 THEN {i} * {m} / pow(10D, -{k}) ELSE {i} * {m} * pow(10D, {k}) END"
    k, m = "w.k", "w.m"
    first, last = (number.format(k=k, m=m, x=x) for x in ("a", "b"))
    widths = (
        "flatten(transform(sequence(k0 - 1, k0 + 2), k ->"
        " array(named_struct('k', k, 'm', 1D), named_struct('k', k, 'm', 2D), named_struct('k', k, 'm', 5D))))"
    )
    grid = (
        rows.agg(F.min("__x").alias("a"), F.max("__x").alias("b"))
        .select("*", F.expr(f"CAST(CASE WHEN b > a AND b - a < double('Infinity') THEN floor(log10((b - a) / {at_most}D)) ELSE 0 END AS int) AS k0"))
        .select("*", F.expr(f"get(filter({widths}, w -> {last} - {first} < {at_most}), 0) AS w"))
        .select(F.expr(f"named_struct('k', w.k, 'm', w.m, 'first', {first}, 'last', {last}) AS g"))
        .scalar()
    )
    own = number.format(k="__g.k", m="__g.m", x="__x")
    counts = (
        rows.withColumn("__g", grid)
        .select(
            F.when(F.abs("__x") < float("inf"), F.expr(own))
            .otherwise(F.raise_error(F.lit(f"Value without a bin in {column}")).cast("bigint"))
            .alias("__bin")
        )
        .groupBy("__bin")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    every = df.sparkSession.range(1).select(grid.alias("__g")).filter("__g.first IS NOT NULL")
    every = every.select("__g", F.explode(F.expr("sequence(__g.first, __g.last)")).alias("__i"))
    low, high = (edge.format(k="__g.k", m="__g.m", i=i) for i in ("__i", "(__i + 1)"))
    return every.join(F.broadcast(counts), F.col("__i") == F.col("__bin"), "left").select(
        (F.col("__i") - F.col("__g.first")).alias("bin"),
        F.expr(low).alias("low"),
        F.expr(high).alias("high"),
        F.coalesce("__n", F.lit(0)).alias("count"),
    )


def cumulative_frames(df: DataFrame) -> DataFrame:
    """Rows up to and including each year, per risk category.

    The frames of an animation repeat earlier rows; the running count gives their
    sizes from one pass, :func:`frame` gives the rows of one.
    """
    per_year = (
        df.filter(F.col("year").isNotNull())
        .groupBy("year")
        .agg(
            *[
                F.count(F.when(F.col("risk_category") == label, F.lit(1))).alias(label)
                for label in RISK_LABELS
            ]
        )
    )
    w = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    running = per_year.select(
        "year", *[F.sum(label).over(w).alias(label) for label in RISK_LABELS]
    )
    cells = []
    for label in RISK_LABELS:
        cells += [F.lit(label), F.col(label)]
    return running.select(
        "year", F.stack(F.lit(len(RISK_LABELS)), *cells).alias("risk_category", "running_count")
    )


def frame(df: DataFrame, year: int) -> DataFrame:
    """Rows of the animation frame of one year."""
    return df.filter(F.col("year") <= year)


def marker_size_by_score(score: Column | str = "risk_score", high: float = 20.0) -> Column:
    return clip((F.col(score) if isinstance(score, str) else score) / 5.0, 5.0, high)


def marker_size_by_magnitude(h: Column | str = "h") -> Column:
    return clip(30.0 - (F.col(h) if isinstance(h, str) else h), 5.0, 25.0)


def risk_dashboard(
    df: DataFrame, last_past: int = 2025, first_future: int = 2026
) -> DataFrame:
    """Best row per object with year, segment and marker sizes."""
    best = best_per_object(df, ordered=False)
    return (
        best.withColumn("approach_year", F.year("approach_date").cast("bigint"))
        .withColumn("segment", temporal_segment("approach_year", last_past, first_future))
        .withColumn("score_marker", marker_size_by_score())
        .withColumn("size_marker", marker_size_by_magnitude())
    )
