"""Filtered, projected and ordered row reports (top-k lists, windows of the source)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closepass.functions.numeric import dround, hash_key
from closepass.functions.risk import (
    FIRST_VERSION,
    coarse_risk_category,
    raw_risk_score,
    register_sql_functions,
    risk_category,
    risk_score,
)
from closepass.operators.selection import first_rows
from closepass.schema import present

#: Columns that tell one approach from another.
IDENTITY = ("des", "orbit_id", "cd", "dist", "v_rel")


def top_rows(
    df: DataFrame,
    outputs: dict[str, Column],
    order: Sequence[Column],
    limit: int | None,
    ties: Sequence[str],
) -> DataFrame:
    """Order, limit, then project.

    ``ties`` are the source columns of the outputs: they make the result the same
    for any partitioning, and no column is read just to do so.  Spark plans the
    limit as a per-task top-k and computes the outputs for the kept rows only;
    ``limit=None`` gives a range-partitioned sort.
    """
    sort = [*order, *[F.col(c).asc_nulls_last() for c in present(df, *ties)]]
    rows = df.orderBy(*sort)
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(*[c.alias(n) for n, c in outputs.items()])


#: Source columns behind the outputs of most lists.
TIES = ("des", "h", "dist", "v_rel")
DATED_TIES = (*TIES, "cd")


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def desc(c: Column) -> Column:
    return c.desc_nulls_last()


def named(df: DataFrame, *names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in present(df, *names)}


def not_null(*names: str) -> Column:
    condition = F.col(names[0]).isNotNull()
    for n in names[1:]:
        condition = condition & F.col(n).isNotNull()
    return condition


def source_window(
    df: DataFrame,
    first_day: str,
    last_day: str,
    max_dist: float,
    limit: int,
    seed: int = 42,
    identity: Sequence[str] = IDENTITY,
) -> DataFrame:
    """Earliest ``limit`` approaches of a date range within a distance, by date.

    The limit may be hundreds of thousands, too many for a per-task top-k, so the
    cut-off date is found by counting.  A hash order decides between rows of the
    cut-off date.
    """
    rows = df.filter(
        F.col("cd").between(
            F.lit(first_day).cast("timestamp_ntz"), F.lit(last_day).cast("timestamp_ntz")
        )
        & (F.col("dist") <= max_dist)
    )
    keyed = rows.withColumn("__h", hash_key(rows, present(rows, *identity), seed))
    chosen = first_rows(
        keyed,
        levels=[F.to_date("cd"), F.struct("cd", F.substring("__h", 1, 3))],
        order=[F.col("__h"), *[F.col(c).asc_nulls_last() for c in rows.columns]],
        quota=limit,
    )
    return chosen.drop("__h").orderBy("cd")


def full_source_window(df: DataFrame, limit: int = 200_000) -> DataFrame:
    """The complete pull: 1900 to 2100 within 0.5 AU."""
    return source_window(df, "1900-01-01", "2100-12-31", 0.5, limit)


def limited_source_window(df: DataFrame, limit: int = 50_000) -> DataFrame:
    """The small pull: 1900 to 2030 within 0.2 AU."""
    return source_window(df, "1900-01-01", "2030-12-31", 0.2, limit)


def dangerous_objects(df: DataFrame, limit: int | None = 10) -> DataFrame:
    rows = df.filter((F.col("h") < 18) & (F.col("dist") < 0.05))
    outputs = named(rows, "des", "fullname", "h", "dist", "v_rel")
    return top_rows(rows, outputs, [asc("dist")], limit, TIES)


def recent_close_approaches(
    df: DataFrame, since: str = "2020-01-01", max_dist: float = 0.01, limit: int | None = 15
) -> DataFrame:
    rows = df.filter(
        (F.col("cd") >= F.lit(since).cast("timestamp_ntz")) & (F.col("dist") < max_dist)
    )
    outputs = {
        **named(rows, "des", "fullname"),
        "approach_date": F.col("cd"),
        "distance_au": dround("dist", 6),
        "velocity_kms": dround("v_rel", 2),
        "magnitude": F.col("h"),
    }
    return top_rows(rows, outputs, [asc("dist")], limit, DATED_TIES)


def large_and_near(df: DataFrame, limit: int | None = 25) -> DataFrame:
    """Complete rows with ``h < 22`` and ``dist < 0.1``, nearest first."""
    rows = df.filter(
        not_null("h", "dist", "v_rel") & (F.col("h") < 22) & (F.col("dist") < 0.1)
    )
    outputs = named(rows, "des", "fullname", "h", "dist", "v_rel")
    return top_rows(rows, outputs, [asc("dist")], limit, TIES)


def nearest_with_category(df: DataFrame, limit: int | None = 50) -> DataFrame:
    """Nearest rows with the three-way category."""
    rows = df.filter(not_null("h", "dist"))
    outputs = {
        **named(rows, "des", "fullname", "h", "dist", "v_rel"),
        "risk_category": coarse_risk_category(),
    }
    return top_rows(rows, outputs, [asc("dist")], limit, TIES)


def risk_ranking(df: DataFrame, limit: int = 100) -> DataFrame:
    """Nearest rows with the three-way category and their position.

    The position is numbered after the limit, over ``limit`` rows.
    """
    nearest = nearest_with_category(df, limit)
    if "fullname" in nearest.columns:
        nearest = nearest.drop("fullname")
    order = ["dist", *[c for c in nearest.columns if c != "dist"]]
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return nearest.withColumn("risk_rank", F.row_number().over(w).cast("bigint"))


def presentation_top(df: DataFrame, limit: int = 10) -> DataFrame:
    """Display columns, ordered by size and nearness."""
    rows = df.filter(not_null("h", "dist"))
    outputs = {"Object": F.col("des")}
    if "fullname" in rows.columns:
        outputs["Name"] = F.col("fullname")
    outputs |= {
        "Distance (AU)": dround("dist", 6),
        "Size (H mag)": dround("h", 1),
        "Velocity (km/s)": dround("v_rel", 1),
    }
    weight = (F.lit(30.0) - F.col("h")) + (F.lit(0.1) - F.col("dist")) * F.lit(100.0)
    return top_rows(rows, outputs, [desc(weight)], limit, TIES)


def _scored(df: DataFrame, with_date: bool = True) -> dict[str, Column]:
    outputs = {
        **named(df, "des", "fullname", "h"),
        "distance_au": dround("dist", 6),
        "velocity_kms": dround("v_rel", 2),
    }
    if with_date:
        outputs["approach_date"] = F.col("cd")
    return outputs | {"risk_score": risk_score(), "risk_category": risk_category()}


def risky_objects(df: DataFrame, limit: int | None = 20) -> DataFrame:
    """Approaches of the highest score."""
    rows = df.filter(not_null("h", "dist", "v_rel"))
    return top_rows(rows, _scored(rows), [desc(risk_score())], limit, DATED_TIES)


def risk_overview(df: DataFrame, limit: int | None = 100) -> DataFrame:
    """As :func:`risky_objects`, without the date and not one row per object."""
    rows = df.filter(not_null("h", "dist", "v_rel"))
    return top_rows(rows, _scored(rows, with_date=False), [desc(risk_score())], limit, TIES)


def top_risks_first_version(df: DataFrame, limit: int | None = 20) -> DataFrame:
    """Top list under the first weights, score neither rounded nor capped."""
    rows = df.filter(not_null("h", "dist", "v_rel"))
    score = raw_risk_score(weights=FIRST_VERSION)
    outputs = {**named(rows, "des", "fullname", "h", "dist", "v_rel"), "risk_score": score}
    return top_rows(rows, outputs, [desc(score)], limit, TIES)


def top_by_sql_function(df: DataFrame, limit: int | None = 5) -> DataFrame:
    """Top list through the registered SQL function."""
    name = register_sql_functions(df.sparkSession)
    scored = df.withColumn("risk", F.expr(f"{name}(h, dist, v_rel)"))
    outputs = named(scored, "des", "fullname", "risk")
    return top_rows(scored, outputs, [desc(F.col("risk"))], limit, ("des",))


def top_by_size_and_distance(df: DataFrame, limit: int | None = 20) -> DataFrame:
    """Brightest rows, nearest first among equals, with category."""
    rows = df.filter(not_null("h", "dist"))
    outputs = {
        **named(rows, "des", "fullname", "h"),
        "distance_au": dround("dist", 6),
        "velocity_kms": dround("v_rel", 2),
        "approach_date": F.col("cd"),
        "risk_category": risk_category(),
    }
    return top_rows(rows, outputs, [asc("h"), asc("dist")], limit, DATED_TIES)


def nearest(df: DataFrame, limit: int = 10) -> DataFrame:
    return top_rows(
        df.filter(not_null("dist")),
        named(df, "des", "fullname", "cd", "dist", "h"),
        [asc("dist")],
        limit,
        ("des", "cd", "h"),
    )


def timeline_slice(
    df: DataFrame, first_year: int = 1900, last_year: int = 1967, limit: int | None = 500
) -> DataFrame:
    """Scored rows of some years, by year and falling score."""
    rows = df.filter(
        F.col("approach_year").between(first_year, last_year) & not_null("h", "dist", "v_rel")
    )
    return top_rows(
        rows, discovery_columns(), [asc("approach_year"), desc(risk_score())], limit, TIES
    )


def discovery_columns() -> dict[str, Column]:
    return {
        "object_name": F.col("des"),
        "year": F.col("approach_year"),
        "distance_au": dround("dist", 6),
        "magnitude": F.col("h"),
        "velocity_kms": dround("v_rel", 2),
        "risk_score": risk_score(),
        "risk_category": risk_category(),
    }


def limited_scan(df: DataFrame, limit: int = 1000, order: Sequence[str] = ()) -> DataFrame:
    """Row count, year range and nearest distance of ``limit`` rows: the first of an order, or any."""
    rows = df.select("approach_year", "dist", *[c for c in order if c not in ("approach_year", "dist")])
    if order:
        rows = rows.orderBy(*[asc(c) for c in order])
    return rows.limit(limit).agg(
        F.count(F.lit(1)).alias("records"),
        F.min("approach_year").alias("first_year"),
        F.max("approach_year").alias("last_year"),
        F.min("dist").alias("closest"),
    )


def record_holders(df: DataFrame) -> DataFrame:
    """Rows at the smallest distance, the highest speed and the smallest h; ties kept.

    One scan finds the three extrema, a second one the rows.  The last record type
    reports ``h`` in the velocity column, as the source of the report does.
    """
    extreme = (
        df.agg(
            F.struct(
                F.min("dist").alias("dist"), F.max("v_rel").alias("v_rel"), F.min("h").alias("h")
            ).alias("x")
        )
        .select("x")
        .scalar()
    )
    closest = F.col("dist") == extreme["dist"]
    fastest = F.col("v_rel") == extreme["v_rel"]
    largest = F.col("h") == extreme["h"]
    held = F.array_compact(
        F.array(
            F.when(closest, "Closest Approach"),
            F.when(fastest, "Fastest Object"),
            F.when(largest, "Largest Object"),
        )
    )
    rows = df.filter(closest | fastest | largest).withColumn("record_type", F.explode(held))
    is_closest = F.col("record_type") == "Closest Approach"
    is_largest = F.col("record_type") == "Largest Object"
    outputs = {
        "record_type": F.col("record_type"),
        **named(rows, "des", "fullname"),
        "distance_au": F.when(is_closest, dround("dist", 8)).otherwise(dround("dist", 6)),
        "date": F.col("cd"),
        "velocity_kms": F.when(is_largest, F.col("h")).otherwise(dround("v_rel", 2)),
    }
    return rows.select(*[c.alias(n) for n, c in outputs.items()])
