"""Exact order statistics and first-n selection without a global sort.

``limit`` with a large n, ``median`` and a global ``row_number`` all end in one
task that holds n rows or every distinct value.  The functions here find the
cut-off by counting instead: rows are counted per coarse cell (a bounded number
of cells, combined map-side), the cell that holds the wanted rank is picked, and
only that cell is looked at more closely.  The answer is exact whatever the
distribution, and a heavily repeated value costs one counter.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Inner join on null-safe equal keys, keeping the left key columns.

    ``small`` marks a right side of bounded or counted size; any other size is left
    to the optimizer.
    """
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    if small:
        renamed = F.broadcast(renamed)
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, condition, "inner").drop(*[f"__r_{k}" for k in keys])


def _rows_before(groups: Sequence[str], order: str | Column, n: str = "__n") -> Column:
    """Rows counted in the earlier cells of the same group."""
    w = Window.partitionBy(*groups).orderBy(order)
    earlier = F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(earlier, F.lit(0)).cast("bigint")


def _key(columns: Sequence[str]) -> str:
    """One comparable value of some columns."""
    return columns[0] if len(columns) == 1 else f"struct({', '.join(columns)})"


def first_rows(
    df: DataFrame,
    levels: Sequence[Column],
    order: Sequence[Column],
    quota: int | Callable[[Column], Column],
    groups: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """The first ``quota`` rows (of every group) in the order of levels, then ``order``.

    ``levels`` are non-null keys, coarse to fine, that are a prefix of the wanted
    order; each must take a bounded number of values inside one value of the level
    before it.  ``quota`` is a row count or a function of the group's row count.
    ``order`` breaks the ties inside the last level; rows equal in all of it are
    exchangeable only if it covers every column that differs, so pass all of them.
    ``few_groups`` says that the groups are few by construction, so one cut-off per
    group may be broadcast; otherwise the join is left to the optimizer.

    One pruned scan counts each level.  Then rows before the cut-off cell pass from the scan to the
    result as they are; only the rows of the cut-off cell itself are shuffled and ordered, in a branch of
    their own.  Copies of one row are counted, not sorted, so a large group of copies is one entry.
    """
    groups = list(groups)
    small = few_groups or not groups
    columns = df.columns
    path = [f"__c{i}" for i in range(len(levels))]
    keyed = df.withColumns(dict(zip(path, levels)))
    cut: DataFrame | None = None

    def with_cut(rows: DataFrame) -> DataFrame:
        if groups:
            return _match(rows, cut, groups, small)
        return rows.withColumn("__cut", cut.select("__cut").scalar())

    for i, cell in enumerate(path):
        rows = keyed.select(*groups, *path[: i + 1])
        coarse = _key(path[:i])
        if i == 0:
            counts = rows.groupBy(*groups, cell).agg(F.count(F.lit(1)).alias("__n"))
            total = F.sum("__n").over(Window.partitionBy(*groups))
            wanted = (quota(total) if callable(quota) else F.lit(quota)).cast("bigint")
            before_cell = ""
        else:
            inside = with_cut(rows).filter(f"{coarse} = __cut.at")
            counts = inside.groupBy(*groups, *path[: i + 1], "__cut.need").agg(
                F.count(F.lit(1)).alias("__n")
            )
            wanted = F.col("need")
            before_cell = f"'coarse', {coarse}, "
        found = (
            f"max_by(named_struct({before_cell}'last', {cell},"
            f" 'at', {_key(path[: i + 1])},"
            f" 'need', least(__wanted - __before, __n)), {cell})"
        )
        cut = (
            counts.select(
                "*", wanted.alias("__wanted"), _rows_before(groups, cell).alias("__before")
            )
            .filter("__before < __wanted")
            .groupBy(*groups)
            .agg(F.expr(found).alias("__cut"))
        )

    # The coarse levels decide for most rows, so a costly last level is seldom computed.
    last = path[-1]
    if len(path) == 1:
        inside = "true"
        upto = f"{last} < __cut.last"
    else:
        inside = f"{coarse} = __cut.coarse"
        upto = f"{coarse} <= __cut.coarse AND ({coarse} < __cut.coarse OR {last} < __cut.last)"
    below = with_cut(keyed).filter(upto).select(*columns)
    at_cut = with_cut(keyed).filter(f"{inside} AND {last} = __cut.last").select(*columns, F.col("__cut.need").alias("__need"))
    copies = at_cut.groupBy(*columns, "__need").agg(F.count(F.lit(1)).alias("__n"))
    in_cell = Window.partitionBy(*groups).orderBy(*order)
    before = F.sum("__n").over(in_cell.rowsBetween(Window.unboundedPreceding, -1))
    taken = copies.select("*", F.coalesce(before, F.lit(0)).alias("__before")).select(
        *columns, F.expr("least(__n, __need - __before)").alias("__take")
    )
    return below.unionByName(_repeat(taken.filter("__take > 0"), "__take").select(*columns))


def _repeat(df: DataFrame, times: str, chunk: int = 10_000) -> DataFrame:
    """Every row as often as ``times`` says, in two steps so no array grows large."""
    blocks = F.expr(f"explode(sequence(0L, CAST(({times} - 1) DIV {chunk} AS bigint)))")
    copies = F.expr(f"explode(sequence(1L, least({chunk}L, {times} - __block * {chunk})))")
    return df.select("*", blocks.alias("__block")).select("*", copies.alias("__copy"))


#: Cell number that never decreases with the value, for any double: 4096 cells per
#: power of two on each side of zero, under 18 million in all, a few ten thousand for
#: values within a few orders of magnitude.  Infinity (with NaN, which sorts after it) and
#: minus Infinity have an end cell each.
END_CELL = 9_000_000
LOG_CELL = f"""CAST(CASE
    WHEN {{v}} = 0D THEN 0
    WHEN {{v}} >= double('Infinity') THEN {END_CELL}
    WHEN {{v}} = double('-Infinity') THEN -{END_CELL}
    WHEN {{v}} > 0D THEN floor(log2({{v}}) * 4096D) + 4505600
    ELSE -(floor(log2(-{{v}}) * 4096D) + 4505600) END AS bigint)"""

#: Division of such a cell into 65,536 equal widths, in the order of the values.
LINEAR_CELL = f"""CAST(CASE WHEN abs({{c}}) = {END_CELL} THEN 0 ELSE sign({{c}}) * greatest(0, least(65535, floor(try_divide(
    abs({{v}}) - pow(2D, (abs({{c}}) - 4505600) / 4096D),
    pow(2D, (abs({{c}}) - 4505600) / 4096D) * (pow(2D, 1D / 4096D) - 1D) / 65536D)))) END AS bigint)"""


def ordered_positions(df: DataFrame, value: str, ties: Sequence[Column], name: str) -> DataFrame:
    """Every row with its position (from 1) in the order of a double, then ``ties``, as column ``name``.

    A global ``row_number`` sorts all rows in one task; here only the counts per cell meet.
    """
    placed = df.withColumn("__c", F.expr(LOG_CELL.format(v=value)))
    counts = placed.groupBy("__c").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__c", _rows_before([], "__c").alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__c").orderBy(value, *ties))
    position = (F.col("__before") + inside).cast("bigint").alias(name)
    return _match(placed, before, ["__c"], False).select(*df.columns, position)


#: Figures that cells keep and that merge into those of a group, by compensated sums of squares.
CELL_FIGURES = {
    "n": "count(1)",
    "sum": "sum(__v)",
    "squares": "var_pop(__v) * count(1)",
    "min": "min(__v)",
    "max": "max(__v)",
}


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    few_groups: bool = False,
    summary: bool = False,
    conditions: Sequence[str] = (),
) -> DataFrame:
    """Exact interpolated quantiles per group: ``groups..., n, quantiles array<double>``.

    Built-in ``median`` and ``percentile`` keep a map of all distinct values in one
    task.  Here three pruned scans count rows per logarithmic cell, then per linear
    cell inside the cells that hold a wanted rank, then per value.  The last step
    sees at most 2^25 distinct doubles and normally a handful.

    ``summary`` adds a struct column ``summary``: rows, mean, std (of the sample), min, max of all values that are not
    NULL, NaN included, and ``counts``, the rows that meet each of ``conditions`` (SQL over ``__v``, the value).  The first
    scan keeps these figures for each logarithmic cell and they are merged over the cells, so they cost no scan of
    their own.  A group that has only NaN then has a row too, with NULL quantiles.

    ``few_groups`` says that the groups are few by construction, so their cut-offs may
    be broadcast; otherwise the join is left to the optimizer.
    """
    groups = list(groups)
    small = few_groups or not groups
    path = ["__c1", "__c2", "__v"]
    rows = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("__v"))
    if not summary:
        rows = rows.filter(~F.isnan("__v"))
    c1 = LOG_CELL.format(v="__v")
    if summary:  # NaN has a cell of its own, which no rank is looked for in
        c1 = f"CASE WHEN isnan(__v) THEN {END_CELL + 1} ELSE {c1} END"
    rows = rows.select("*", F.expr(c1).alias("__c1")).select(
        "*", F.expr(LINEAR_CELL.format(v="__v", c="__c1")).alias("__c2")
    )
    carried = ["__total", "__ranks", *(["__summary"] if summary else [])]
    # The two neighbouring ranks of every interpolated quantile.
    positions = [f"{float(p)}D * (__total - 1)" for p in probabilities]
    ranks = ", ".join(
        f"named_struct('i', {i}, 'side', {side}, 'rank', CAST({side_of}({position}) AS bigint))"
        for i, position in enumerate(positions)
        for side, side_of in ((0, "floor"), (1, "ceil"))
    )
    found: DataFrame | None = None
    for i, cell in enumerate(path):
        keys = [*groups, *path[:i]]
        if found is None:
            figures = dict(CELL_FIGURES) if summary else {"n": "count(1)"}
            for k, condition in enumerate(conditions if summary else ()):
                figures[f"if{k}"] = f"count_if({condition})"
            counts = rows.groupBy(*keys, cell).agg(
                *[F.expr(e).alias("__n" if name == "n" else f"__{name}") for name, e in figures.items()]
            )
            over = Window.partitionBy(*groups)
            if summary:
                counts = _merged(counts, over, len(conditions)).withColumn(
                    "__ranked", F.expr(f"CASE WHEN __c1 > {END_CELL} THEN 0L ELSE __n END")
                )
            total = F.sum("__ranked" if summary else "__n").over(over)
            counts = counts.select("*", total.alias("__total")).select(
                "*", F.expr(f"array({ranks})").alias("__ranks")
            )
        else:
            inside = _match(rows, found, keys, small or not groups)
            counts = inside.groupBy(*keys, cell, *carried).agg(F.count(F.lit(1)).alias("__n"))
        moved = F.expr(
            "transform(filter(__ranks, r -> r.rank >= __before AND r.rank < __before + __n),"
            " r -> named_struct('i', r.i, 'side', r.side, 'rank', r.rank - __before))"
        )
        if summary:
            moved = F.when(F.col("__total") > 0, moved).otherwise(F.expr("filter(__ranks, r -> false)"))
        found = (
            counts.select("*", _rows_before(keys, cell).alias("__before"))
            .select(*keys, cell, *[moved.alias(c) if c == "__ranks" else F.col(c) for c in carried])
            .filter("size(__ranks) > 0 OR __total = 0" if summary else "size(__ranks) > 0")
        )

    def neighbour(i: int, side: int) -> str:
        return f"max(CASE WHEN r.i = {i} AND r.side = {side} THEN __v END)"

    results = []
    for i, p in enumerate(probabilities):
        position = f"{float(p)}D * (max(__total) - 1)"
        low, high = neighbour(i, 0), neighbour(i, 1)
        between = f"{low} + ({high} - {low}) * ({position} - floor({position}))"
        results.append(f"CASE WHEN {low} = {high} THEN {low} ELSE {between} END")
    more = [F.max("__summary").alias("summary")] if summary else []
    return (
        found.select(*groups, "__v", *[c for c in carried if c != "__ranks"], F.explode_outer("__ranks").alias("r"))
        .groupBy(*groups)
        .agg(
            F.max("__total").alias("n"),
            F.expr(f"array({', '.join(results)})").alias("quantiles"),
            *more,
        )
    )


def _merged(cells: DataFrame, over: Window, conditions: int) -> DataFrame:
    """``cells`` with the figures of the whole group, merged from those of its cells, as a struct."""
    whole = cells.select(
        "*", F.sum("__n").over(over).alias("__rows"), F.sum("__sum").over(over).alias("__all")
    ).select("*", (F.col("__all") / F.col("__rows")).alias("__mean"))
    # the squares inside a cell, and those of its mean about the mean of all
    squares = F.expr("__squares + __n * pow(__sum / __n - __mean, 2)")
    whole = whole.select("*", F.sum(squares).over(over).alias("__spread"))
    figures = F.struct(
        F.col("__rows").alias("rows"),
        F.col("__mean").alias("mean"),
        F.expr("CASE WHEN __rows > 1 THEN sqrt(__spread / (__rows - 1)) END").alias("std"),
        F.min("__min").over(over).alias("min"),
        F.max("__max").over(over).alias("max"),
        F.array(*[F.sum(f"__if{k}").over(over) for k in range(conditions)]).cast("array<bigint>").alias("counts"),
    )
    kept = [c for c in cells.columns if c not in ("__sum", "__squares", "__min", "__max", *(f"__if{k}" for k in range(conditions)))]
    return whole.select(*kept, figures.alias("__summary"))
