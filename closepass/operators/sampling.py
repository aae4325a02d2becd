"""Reproducible samples of exact size.

All samples take the first rows of a random order made from the rows' values, that of a digest
(``hash_key``).  They are the same rows for any partitioning, executor loss included.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closepass.functions.numeric import hash_key, mix_key
from closepass.operators.reports import IDENTITY, not_null
from closepass.operators.selection import first_rows
from closepass.schema import present

SEED = 42
#: Hex digits of the digest that name the counting cell of a whole table or of a few strata: 65,536 cells.
CELL_DIGITS = 4
#: The same where every year has its own cells: 4,096.
YEAR_CELL_DIGITS = 3


def _by_hash(
    df: DataFrame,
    quota: int | Callable[[Column], Column],
    seed: int,
    identity: Sequence[str],
    groups: Sequence[str] = (),
    few_groups: bool = False,
    digits: int = CELL_DIGITS,
) -> DataFrame:
    names = present(df, *identity) or df.columns
    keyed = df.withColumn("__h", hash_key(df, names, seed))
    ties = [F.col(c).asc_nulls_last() for c in df.columns]
    return first_rows(
        keyed,
        levels=[F.substring("__h", 1, digits)],
        order=[F.col("__h"), *ties],
        quota=quota,
        groups=groups,
        few_groups=few_groups,
    ).drop("__h")


def sample_random(
    df: DataFrame, size: int, seed: int = SEED, identity: Sequence[str] = IDENTITY
) -> DataFrame:
    """``size`` rows, or all rows of a smaller table."""
    return _by_hash(df, size, seed, identity)


def sample_stratified(
    df: DataFrame,
    size: int,
    column: str = "risk_category",
    strata: int = 4,
    seed: int = SEED,
    identity: Sequence[str] = IDENTITY,
    few_groups: bool = False,
) -> DataFrame:
    """Up to ``size // strata`` rows of every stratum; temporal if the column is absent.

    A table of at most ``size`` rows is returned whole.  ``few_groups`` is
    True for a column that takes few values by construction, as a risk category does.
    """
    if column not in df.columns:
        return sample_temporal(df, size, seed, identity)
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def quota(group_total: Column) -> Column:
        return F.when(total <= size, group_total).otherwise(F.lit(size // strata))

    return _by_hash(df, quota, seed, identity, [column], few_groups)


def sample_temporal(
    df: DataFrame, size: int, seed: int = SEED, identity: Sequence[str] = IDENTITY
) -> DataFrame:
    """Equal share of every year; random if there is no date.

    A missing date counts as one more year in the division, but its rows are not
    drawn.  A table of at most ``size`` rows is returned whole.
    """
    if "cd" not in df.columns:
        return sample_random(df, size, seed, identity)
    year = F.year("cd")
    facts = (
        df.agg(
            F.struct(
                F.count(F.lit(1)).alias("rows"),
                (
                    F.count_distinct(year)
                    + F.max(F.when(year.isNull(), F.lit(1)).otherwise(F.lit(0)))
                ).alias("years"),
            ).alias("s")
        )
        .select("s")
        .scalar()
    )
    fits = facts["rows"] <= size

    def quota(group_total: Column) -> Column:
        share = F.floor(F.lit(size) / facts["years"])
        return (
            F.when(fits, group_total)
            .when(F.col("__year").isNull(), F.lit(0))
            .otherwise(share)
        )

    return _by_hash(
        df.withColumn("__year", year), quota, seed, identity, ["__year"], few_groups=True, digits=YEAR_CELL_DIGITS
    ).drop("__year")


def sample(
    df: DataFrame, size: int = 100_000, strategy: str = "stratified", seed: int = SEED
) -> DataFrame:
    """Sample by strategy name: ``random``, ``stratified`` or ``temporal``."""
    strategies = {
        "random": sample_random,
        "stratified": sample_stratified,
        "temporal": sample_temporal,
    }
    if strategy not in strategies:
        raise ValueError(f"Unknown sampling strategy: {strategy}")
    return strategies[strategy](df, size, seed=seed)


def scatter_sample(
    df: DataFrame,
    limit: int = 1000,
    seed: int | None = None,
    identity: Sequence[str] = IDENTITY,
) -> DataFrame:
    """``h, dist, v_rel`` of complete rows for a scatter plot.

    Without a seed any rows are taken, which reads only as much as needed; with one
    the rows are the first of the hash order over the whole table.
    """
    rows = df.filter(not_null("h", "dist", "v_rel"))
    if seed is None:
        return rows.select("h", "dist", "v_rel").limit(limit)
    key = mix_key(rows, present(rows, *identity), seed)
    return (
        rows.select("h", "dist", "v_rel", key.alias("__key"))
        .orderBy("__key", "dist", "v_rel", "h")
        .limit(limit)
        .select("h", "dist", "v_rel")
    )
