"""Compare a Spark result with the same SQL in DuckDB."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return None if v is None else str(v)


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((x is None, x or "") for x in r))


def differences(spark_df, con, sql: str) -> str | None:
    """None when names, row count and values agree, else what does not."""
    names = spark_df.columns
    mine = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    their_names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(their_names):
        return f"columns {sorted(names)} != {sorted(their_names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    a, b = _sorted(mine, names), _sorted(theirs, their_names)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
