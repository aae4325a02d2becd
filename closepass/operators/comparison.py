"""Whether two tables hold the same rows, whatever their order, files or format."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _canonical(df: DataFrame) -> list[Column]:
    """The columns with one form of each value: NaN is NaN, -0.0 is 0.0."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            zero = F.lit(0.0).cast(kind)
            c = F.when(F.isnan(c), F.lit(float("nan")).cast(kind)).when(c == zero, zero).otherwise(c)
        out.append(c.alias(name))
    return out


def digest(df: DataFrame) -> DataFrame:
    """One row ``(n, first, second)`` that is the same for any order of the rows of ``df``.

    Two 64-bit hashes of each row, the second over salted columns in reverse order, are added up in wide decimals, so repeated rows count each time.  A
    row's NULLs enter as a pattern of their own, as a hash skips them.
    """
    values = df.select(*_canonical(df))
    columns = [F.col(f"`{c}`") for c in values.columns]
    nulls = F.concat_ws("", *[c.isNull().cast("int").cast("string") for c in columns])
    first = F.xxhash64(nulls, *columns)
    second = F.xxhash64(F.lit("second"), *reversed(columns), nulls)
    wide = "decimal(38,0)"
    return values.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(first.cast(wide)), F.lit(0).cast(wide)).alias("first"),
        F.coalesce(F.sum(second.cast(wide)), F.lit(0).cast(wide)).alias("second"),
    )


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of the same columns hold the same rows equally often; columns may stand in another order.

    One scan of each table and two rows for the driver.  NULL equals NULL, NaN equals NaN, -0.0 equals 0.0.  ValueError for
    other columns or types.
    """
    if sorted(a.dtypes) != sorted(b.dtypes):
        raise ValueError(f"Different columns: {sorted(a.dtypes)} and {sorted(b.dtypes)}")
    digests = digest(a).unionByName(digest(b.select(*[f"`{c}`" for c in a.columns])))
    return digests.distinct().count() == 1


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one table holds more often than the other, with ``in_a`` and ``in_b``, how often each does.

    Rows are counted before the shuffle, so a row that makes up a third of a table is one entry of each task.
    """
    names = [f"`{c}`" for c in a.columns]
    sides = [
        t.select(*names).select(*_canonical(t.select(*names))).withColumns({"__a": F.lit(k), "__b": F.lit(1 - k)})
        for t, k in ((a, 1), (b, 0))
    ]
    counts = sides[0].unionByName(sides[1]).groupBy(*names)
    counts = counts.agg(F.sum("__a").alias("in_a"), F.sum("__b").alias("in_b"))
    return counts.filter("in_a <> in_b")
