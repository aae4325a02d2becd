"""SQL for the registered queries, written for an engine with other arithmetic habits.

Each text stands alone and is run on the same Parquet tables.
"""

_APPROACHES = """
approaches AS (
  SELECT CAST(l_partkey AS VARCHAR) AS des, p_name AS fullname,
         CAST(l_suppkey AS VARCHAR) AS orbit_id, l_shipdate AS cd,
         datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + 2440587.5::DOUBLE AS jd,
         l_extendedprice / 210000::DOUBLE AS dist,
         l_extendedprice / 210000::DOUBLE * (1::DOUBLE - l_tax) AS dist_min,
         l_extendedprice / 210000::DOUBLE * (1::DOUBLE + l_tax) AS dist_max,
         l_quantity * 1.3::DOUBLE AS v_rel,
         l_quantity * 1.3::DOUBLE * (1::DOUBLE - l_discount) AS v_inf,
         CASE WHEN l_suppkey % 50 = 0 THEN NULL
              ELSE 14::DOUBLE + (l_partkey % 160) / 10::DOUBLE END AS h,
         CASE WHEN l_linenumber = 7 THEN NULL
              ELSE concat(l_returnflag, l_linestatus) END AS t_sigma_f,
         CAST(year(l_shipdate) AS BIGINT) AS approach_year
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

_COLUMNS = (
    "des, orbit_id, cd, jd, dist, dist_min, dist_max, v_rel, v_inf, h, t_sigma_f, approach_year"
)

_RAW_SCORE = (
    "(greatest(0::DOUBLE, 30::DOUBLE - h) * 1.33::DOUBLE"
    " + greatest(0::DOUBLE, 0.1::DOUBLE - dist) * 400::DOUBLE"
    " + least(v_rel, 60::DOUBLE) * 0.33::DOUBLE)"
)
_SCORE = f"round({_RAW_SCORE}, 2)"
_CAPPED = (
    "CASE WHEN h IS NULL OR dist IS NULL OR v_rel IS NULL THEN 0::DOUBLE"
    f" ELSE round(least({_RAW_SCORE}, 100::DOUBLE), 2) END"
)
_CATEGORY = (
    "CASE WHEN h < 18 AND dist < 0.05::DOUBLE THEN 'VERY_HIGH'"
    " WHEN h < 20 AND dist < 0.1::DOUBLE THEN 'HIGH'"
    " WHEN h < 25 AND dist < 0.2::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END"
)
_COARSE = (
    "CASE WHEN h < 18 AND dist < 0.05::DOUBLE THEN 'HIGH_RISK'"
    " WHEN h < 22 AND dist < 0.1::DOUBLE THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END"
)
_SIZE = (
    "CASE WHEN h < 18 THEN 'Very Large (>1km)' WHEN h < 22 THEN 'Large (140m-1km)'"
    " WHEN h < 25 THEN 'Medium (30-140m)' ELSE 'Small (<30m)' END"
)
_SPEED = (
    "CASE WHEN v_rel < 10 THEN 'Slow (<10 km/s)' WHEN v_rel < 20 THEN 'Moderate (10-20 km/s)'"
    " WHEN v_rel < 30 THEN 'Fast (20-30 km/s)' ELSE 'Very Fast (>30 km/s)' END"
)
_COMPLETE = "h IS NOT NULL AND dist IS NOT NULL AND v_rel IS NOT NULL"
_HASH = (
    "md5(concat_ws('|', des, orbit_id, CAST(CAST(cd AS TIMESTAMP) AS VARCHAR),"
    " coalesce(CAST(dist AS VARCHAR), ''), coalesce(CAST(v_rel AS VARCHAR), ''), '42'))"
)
# The first 46 bits of the digest.
_MIX = f"(CAST('0x' || substr({_HASH}, 1, 12) AS BIGINT) >> 2)"
_CELL = f"({_MIX} >> 30)"
_SEGMENT = (
    "CASE WHEN approach_year <= 1998 THEN 'historical'"
    " WHEN approach_year >= 1999 THEN 'future' END"
)
_NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"

_BEST = f"""
best AS (
  SELECT des, fullname, h, round(dist, 6) AS distance_au, round(v_rel, 2) AS velocity_kms,
         cd AS approach_date, {_SCORE} AS risk_score, {_CATEGORY} AS risk_category,
         row_number() OVER (PARTITION BY des ORDER BY {_RAW_SCORE} DESC, h, dist, v_rel, cd) AS rn
  FROM approaches WHERE {_COMPLETE}
),
risk_rows AS (
  SELECT des, fullname, h, distance_au, velocity_kms, approach_date, risk_score, risk_category,
         CAST(year(approach_date) AS BIGINT) AS approach_year,
         CASE WHEN year(approach_date) <= 1998 THEN 'historical'
              WHEN year(approach_date) >= 1999 THEN 'future' END AS segment,
         greatest(5::DOUBLE, least(20::DOUBLE, risk_score / 5::DOUBLE)) AS score_marker,
         greatest(5::DOUBLE, least(25::DOUBLE, 30::DOUBLE - h)) AS size_marker
  FROM best WHERE rn = 1
)"""


def _q(body: str, *more: str) -> str:
    return "WITH " + ",".join([_APPROACHES, *more]) + "\n" + body


def _top(select: str, where: str, order: str, limit: int, ties: str) -> str:
    return _q(f"SELECT {select} FROM approaches WHERE {where} ORDER BY {order}, {ties} LIMIT {limit}")


def _yearly(name: str, metrics: str, where: str = "approach_year IS NOT NULL", tail: str = "") -> str:
    return _q(
        f"SELECT approach_year AS {name}, {metrics} FROM approaches"
        f" WHERE {where} GROUP BY approach_year {tail}"
    )


def _sizes(metrics: str) -> str:
    return _q(
        f"SELECT {_SIZE} AS size_category, {metrics} FROM approaches"
        " WHERE h IS NOT NULL GROUP BY 1"
    )


def _histogram(source: str, column: str, bins: int, *more: str) -> str:
    return _q(
        f"""
SELECT b.bin, lo + b.bin * ((hi - lo) / {bins}::DOUBLE) AS low,
       lo + (b.bin + 1) * ((hi - lo) / {bins}::DOUBLE) AS high,
       count(v.bin) AS count
FROM (SELECT range AS bin FROM range({bins})) b CROSS JOIN limits
LEFT JOIN (SELECT least(CAST(floor((x - lo) / (hi - lo) * {bins}::DOUBLE) AS BIGINT), {bins - 1}) AS bin
           FROM (SELECT {column} AS x FROM {source} WHERE {column} IS NOT NULL), limits) v
  ON v.bin = b.bin
GROUP BY b.bin, lo, hi""",
        *more,
        f"limits AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})",
    )


def _rounded_histogram(column: str, at_most: int) -> str:
    number = "floor(CASE WHEN k < 0 THEN {x} * pow(10::DOUBLE, -k) / m ELSE {x} / (m * pow(10::DOUBLE, k)) END)"
    edge = "CASE WHEN k < 0 THEN {i} * m / pow(10::DOUBLE, -k) ELSE {i} * m * pow(10::DOUBLE, k) END"
    a, b, own = (number.format(x=x) for x in ("lo", "hi", "x"))
    return _q(
        f"""
SELECT i - a AS bin, {edge.format(i="i")} AS low, {edge.format(i="(i + 1)")} AS high, count(x) AS count
FROM (SELECT *, unnest(range(a, b + 1)) AS i FROM grid) g
LEFT JOIN (SELECT x, CAST({own} AS BIGINT) AS own FROM (SELECT {column} AS x FROM approaches WHERE {column} IS NOT NULL), grid) v
  ON v.own = g.i
GROUP BY i, a, k, m""",
        f"limits AS (SELECT min({column}) AS lo, max({column}) AS hi FROM approaches)",
        f"""grid AS (SELECT k, m, CAST({a} AS BIGINT) AS a, CAST({b} AS BIGINT) AS b
  FROM limits, (SELECT unnest(range(-12, 12)) AS k) ks, (VALUES (1::DOUBLE), (2::DOUBLE), (5::DOUBLE)) ms(m)
  WHERE {b} - {a} < {at_most} ORDER BY k, m LIMIT 1)""",
    )


_SCORED = (
    "des, fullname, h, round(dist, 6) AS distance_au, round(v_rel, 2) AS velocity_kms,"
    f" cd AS approach_date, {_SCORE} AS risk_score, {_CATEGORY} AS risk_category"
)
_DISCOVERY = (
    "des AS object_name, approach_year AS year, round(dist, 6) AS distance_au, h AS magnitude,"
    f" round(v_rel, 2) AS velocity_kms, {_SCORE} AS risk_score, {_CATEGORY} AS risk_category"
)


def _source_window(last_day: str, max_dist: float, limit: int) -> str:
    ties = ", ".join(_COLUMNS.split(", "))
    return _q(
        f"SELECT {_COLUMNS} FROM approaches WHERE cd BETWEEN TIMESTAMP '1900-01-01' AND"
        f" TIMESTAMP '{last_day}' AND dist <= {max_dist}::DOUBLE"
        f" ORDER BY cd, {_HASH}, {ties} LIMIT {limit}"
    )


def _per_stratum(source: str, stratum: str, size: int, quota: str, columns: str) -> str:
    """Rows per stratum up to a quota; a table of at most ``size`` rows whole."""
    ties = ", ".join(f"{c} NULLS LAST" for c in _COLUMNS.split(", "))
    return _q(
        f"""
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY {_CELL}, {_HASH}, {ties}) AS rn,
         count(*) OVER () AS n
  FROM ({source})) WHERE n <= {size} OR rn <= {quota}"""
    )


_RAW_ROWS = """
WITH raw AS (
  SELECT concat('  ', CAST(l_partkey AS VARCHAR), ' ') AS des, CAST(l_suppkey AS VARCHAR) AS orbit_id,
         CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN 'bad'
              ELSE strftime(l_shipdate, '%Y-%b-%d %H:%M') END AS cd,
         CASE WHEN l_suppkey % 37 = 0 THEN '-0.001' WHEN l_suppkey % 41 = 0 THEN 'invalid'
              ELSE CAST(l_extendedprice / 210000::DOUBLE AS VARCHAR) END AS dist,
         CAST(l_quantity * 1.3::DOUBLE AS VARCHAR) AS v_rel,
         CASE WHEN l_suppkey % 50 = 0 THEN 'nan' WHEN l_suppkey % 47 = 0 THEN ''
              ELSE CAST(14::DOUBLE + (l_partkey % 160) / 10::DOUBLE AS VARCHAR) END AS h,
         CASE WHEN l_linenumber = 7 THEN 'None'
              ELSE concat(l_returnflag, l_linestatus) END AS t_sigma_f
  FROM lineitem)"""


def _number(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), {_NUMBER}) AND isfinite(TRY_CAST(trim({c}) AS DOUBLE)) THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def _text(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ('nan', 'None', '') THEN trim({c}) END"


_VERSION = "CASE WHEN approach_year <= 1997 THEN 1 WHEN approach_year = 1998 THEN 2 ELSE 3 END"
_LIST_TIES = "des, h, dist, v_rel"

ORACLE: dict[str, str] = {
    "footer_summary": """
SELECT count(*) AS n, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey,
  min(l_partkey) AS min_l_partkey, max(l_partkey) AS max_l_partkey FROM lineitem""",
    "payload_rows": """
SELECT CAST(l_partkey AS VARCHAR) AS des, CAST(l_suppkey AS VARCHAR) AS orbit_id, strftime(l_shipdate, '%Y-%m-%d') AS cd,
  '] "' || l_returnflag || '",[' || l_linestatus AS t_sigma_f,
  CASE WHEN l_suppkey % 50 <> 0 THEN CAST(l_partkey % 160 AS VARCHAR) END AS h, CAST(NULL AS VARCHAR) AS fullname,
  l_orderkey AS "order", CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
    CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_shipdate, l_returnflag, l_linestatus) - 1 AS INTEGER) AS "row"
FROM lineitem""",
    "json_records": _q("SELECT des, CAST(NULL AS VARCHAR) AS fullname, cd, dist, h, approach_year FROM approaches"),
    "as_of_times": _q(
        """
SELECT o_orderkey, o_orderdate AS time, version, coalesce(total, 0) AS records
FROM orders ASOF LEFT JOIN history ON o_orderdate >= committed_at""",
        "loads AS (SELECT *, CASE WHEN approach_year <= 1997 THEN 1 WHEN approach_year = 1998 THEN 2 ELSE 3 END AS version FROM approaches)",
        """history AS (SELECT version, max(cd) AS committed_at, CAST(sum(count(*)) OVER (ORDER BY version) AS BIGINT) AS total
  FROM loads GROUP BY version)""",
    ),
    "row_differences": _q(
        """
SELECT h, t_sigma_f, CAST(count(*) FILTER (approach_year = 1996) AS BIGINT) AS in_a,
  CAST(count(*) FILTER (approach_year = 1997) AS BIGINT) AS in_b
FROM approaches WHERE approach_year IN (1996, 1997) GROUP BY h, t_sigma_f HAVING in_a <> in_b"""
    ),
    "objects_by_sketch": _q(
        """
SELECT y AS first_year, CAST(2000 AS BIGINT) AS last_year, count(DISTINCT des) AS objects, true AS within_bound
FROM approaches JOIN (SELECT DISTINCT approach_year AS y FROM approaches WHERE approach_year < 2001) ON approach_year BETWEEN y AND 2000
GROUP BY y"""
    ),
    "window_full": _source_window("2100-12-31", 0.5, 200_000),
    "window_limited": _source_window("2030-12-31", 0.2, 10_000),
    "partition_scan": _q(
        "SELECT approach_year, count(*) AS records FROM approaches"
        " WHERE approach_year BETWEEN 1996 AND 1998 GROUP BY 1"
    ),
    "version_counts": _q(
        "SELECT version, records, sum(records) OVER (ORDER BY version)::BIGINT AS total FROM ("
        f"SELECT {_VERSION} AS version, count(*) AS records FROM approaches GROUP BY 1)"
    ),
    "as_of_version": _q(
        "SELECT approach_year, count(*) AS records, count(h) AS with_h, min(dist) AS closest FROM approaches"
        f" WHERE {_VERSION} <= 2 GROUP BY 1"
    ),
    "limited_scan": _q(
        "SELECT count(*) AS records, min(approach_year) AS first_year, max(approach_year) AS last_year,"
        " min(dist) AS closest FROM (SELECT * FROM approaches ORDER BY cd NULLS LAST, des NULLS LAST,"
        " dist NULLS LAST LIMIT 1000)"
    ),
    "table_stats": _q(
        "SELECT count(*) AS row_count, min(cd) AS min_date, max(cd) AS max_date FROM approaches"
    ),
    "clean": f"""{_RAW_ROWS},
typed AS (
  SELECT {_text('des')} AS des, orbit_id, TRY_STRPTIME(cd, '%Y-%b-%d %H:%M') AS cd,
         {_number('dist')} AS dist, {_number('v_rel')} AS v_rel, {_number('h')} AS h,
         {_text('t_sigma_f')} AS t_sigma_f
  FROM raw)
SELECT DISTINCT *, CAST(year(cd) AS BIGINT) AS approach_year FROM typed WHERE dist > 0""",
    "dedupe_key": _q(
        f"""SELECT {_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY des, cd ORDER BY orbit_id, jd, dist, dist_min, dist_max,
      v_rel, v_inf, h NULLS LAST, t_sigma_f NULLS LAST, approach_year) AS rn FROM approaches)
WHERE rn = 1"""
    ),
    "cd_string": _q(
        "SELECT strftime(cd, '%Y-%m-%d %H:%M:%S') AS cd, count(*) AS records"
        " FROM approaches GROUP BY 1"
    ),
    "null_profile": _q(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,"
            f" round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 2) AS null_pct FROM approaches"
            for c in _COLUMNS.split(", ")
        )
    ),
    "dangerous_objects": _top(
        "des, fullname, h, dist, v_rel", "h < 18 AND dist < 0.05::DOUBLE", "dist", 10, _LIST_TIES
    ),
    "recent_close": _top(
        "des, fullname, cd AS approach_date, round(dist, 6) AS distance_au,"
        " round(v_rel, 2) AS velocity_kms, h AS magnitude",
        "cd >= TIMESTAMP '1999-01-01' AND dist < 0.01::DOUBLE",
        "dist",
        15,
        "des, h, dist, v_rel, cd",
    ),
    "complex_filter": _top(
        "des, fullname, h, dist, v_rel",
        f"{_COMPLETE} AND h < 22 AND dist < 0.1::DOUBLE",
        "dist",
        25,
        _LIST_TIES,
    ),
    "complex_filtering": _top(
        f"des, fullname, h, dist, v_rel, {_COARSE} AS risk_category",
        "h IS NOT NULL AND dist IS NOT NULL",
        "dist",
        50,
        _LIST_TIES,
    ),
    "presentation_top": _top(
        'des AS "Object", fullname AS "Name", round(dist, 6) AS "Distance (AU)",'
        ' round(h, 1) AS "Size (H mag)", round(v_rel, 1) AS "Velocity (km/s)"',
        "h IS NOT NULL AND dist IS NOT NULL",
        "(30::DOUBLE - h) + (0.1::DOUBLE - dist) * 100::DOUBLE DESC",
        10,
        _LIST_TIES,
    ),
    "risky_objects": _top(_SCORED, _COMPLETE, "risk_score DESC", 20, _LIST_TIES + ", cd"),
    "risk_top100": _top(
        _SCORED.replace(" cd AS approach_date,", ""), _COMPLETE, "risk_score DESC", 100, _LIST_TIES
    ),
    "top_risks_v0": _top(
        "des, fullname, h, dist, v_rel, (greatest(0::DOUBLE, 30::DOUBLE - h) * 2::DOUBLE"
        " + greatest(0::DOUBLE, 0.1::DOUBLE - dist) * 500::DOUBLE"
        " + least(v_rel, 50::DOUBLE) * 2::DOUBLE) AS risk_score",
        _COMPLETE,
        "risk_score DESC",
        20,
        _LIST_TIES,
    ),
    "top_size_proximity": _top(
        _SCORED.replace(f" {_SCORE} AS risk_score,", ""),
        "h IS NOT NULL AND dist IS NOT NULL",
        "h, dist",
        20,
        _LIST_TIES + ", cd",
    ),
    "nearest10": _top(
        "des, fullname, cd, dist, h", "dist IS NOT NULL", "dist", 10, "des, cd, h NULLS LAST"
    ),
    "top5_udf": _top(f"des, fullname, {_CAPPED} AS risk", "TRUE", "risk DESC", 5, "des"),
    "timeline_slice": _top(
        _DISCOVERY,
        f"approach_year BETWEEN 1996 AND 1999 AND {_COMPLETE}",
        "year, risk_score DESC",
        500,
        _LIST_TIES,
    ),
    "record_holders": _q(
        """
SELECT 'Closest Approach' AS record_type, des, fullname, round(dist, 8) AS distance_au, cd AS date,
       round(v_rel, 2) AS velocity_kms
FROM approaches WHERE dist = (SELECT min(dist) FROM approaches)
UNION ALL
SELECT 'Fastest Object', des, fullname, round(dist, 6), cd, round(v_rel, 2)
FROM approaches WHERE v_rel = (SELECT max(v_rel) FROM approaches)
UNION ALL
SELECT 'Largest Object', des, fullname, round(dist, 6), cd, h
FROM approaches WHERE h = (SELECT min(h) FROM approaches)"""
    ),
    "scatter_sample": _q(
        f"SELECT h, dist, v_rel FROM approaches WHERE {_COMPLETE}"
        f" ORDER BY {_MIX}, dist, v_rel, h LIMIT 1000"
    ),
    "risk_score": _q(
        f"SELECT {_CATEGORY} AS risk_category, {_SCORE} AS risk_score, count(*) AS count"
        " FROM approaches WHERE h IS NOT NULL GROUP BY 1, 2"
    ),
    "risk_score_capped": _q(
        f"SELECT {_CATEGORY} AS risk_category, {_CAPPED} AS risk_score, count(*) AS count"
        " FROM approaches GROUP BY 1, 2"
    ),
    "risk_category": _q(
        f"SELECT {_CATEGORY} AS risk_category, count(*) AS count FROM approaches"
        " WHERE h IS NOT NULL AND dist IS NOT NULL GROUP BY 1"
    ),
    "temporal_segment": _q(
        f"SELECT {_SEGMENT} AS segment, count(*) AS count FROM approaches GROUP BY 1"
    ),
    "clip": _q(
        f"""SELECT greatest(5::DOUBLE, least(20::DOUBLE, {_SCORE} / 5::DOUBLE)) AS score_marker,
  greatest(5::DOUBLE, least(25::DOUBLE, 30::DOUBLE - h)) AS size_marker,
  greatest(5::DOUBLE, least(30::DOUBLE, {_SCORE} / 5::DOUBLE)) AS wide_marker, count(*) AS count
FROM approaches WHERE h IS NOT NULL GROUP BY 1, 2, 3"""
    ),
    "simple_count": _q("SELECT count(*) AS total_approaches FROM approaches"),
    "filtered_count": _q("SELECT count(*) AS total_approaches FROM approaches WHERE h < 20"),
    "aggregation": _yearly(
        "approach_year",
        "count(*) AS count, round(avg(dist), 6) AS avg_dist",
        tail="ORDER BY 1 DESC LIMIT 10",
    ),
    "yearly_discoveries": _yearly(
        "year",
        "count(*) AS approaches, round(avg(dist), 6) AS avg_distance_au,"
        " round(min(dist), 6) AS closest_approach_au, count(DISTINCT des) AS unique_objects",
        tail="ORDER BY 1 DESC LIMIT 20",
    ),
    "yearly_all": _yearly(
        "year",
        "count(*) AS total_approaches, count(DISTINCT des) AS unique_objects,"
        " round(avg(dist), 6) AS avg_distance, round(min(dist), 6) AS closest_approach",
    ),
    "yearly_by_date": _q(
        "SELECT CAST(year(CAST(cd AS DATE)) AS BIGINT) AS year, count(*) AS total_approaches,"
        " count(DISTINCT des) AS unique_objects, round(avg(dist), 6) AS avg_distance,"
        " round(min(dist), 6) AS closest_approach FROM approaches WHERE cd IS NOT NULL GROUP BY 1"
    ),
    "yearly_trends": _yearly(
        "year",
        "count(*) AS total_approaches, count(DISTINCT des) AS unique_objects,"
        " round(avg(dist), 6) AS avg_distance_au, round(min(dist), 6) AS closest_approach_au,"
        " round(max(dist), 6) AS farthest_approach_au, round(avg(v_rel), 2) AS avg_velocity_kms,"
        " round(avg(h), 2) AS avg_magnitude, count(CASE WHEN h < 22 THEN 1 END) AS large_objects,"
        " count(CASE WHEN dist < 0.05::DOUBLE THEN 1 END) AS close_approaches",
        where="approach_year BETWEEN 1900 AND 2030",
        tail="ORDER BY 1 DESC LIMIT 25",
    ),
    "years_range": _yearly(
        "approach_year",
        "count(*) AS approaches, round(avg(dist), 6) AS avg_distance,"
        " round(min(dist), 6) AS closest_approach",
        where="approach_year BETWEEN 1996 AND 1998",
    ),
    "trend_stats": _q(
        "SELECT round(avg(total) FILTER (p <= 3), 2) AS avg_approaches_recent,"
        " (SELECT y FROM years ORDER BY total DESC, y DESC LIMIT 1) AS peak_year FROM years",
        """
years AS (SELECT approach_year AS y, count(*) AS total,
            row_number() OVER (ORDER BY approach_year DESC) AS p
          FROM approaches WHERE approach_year BETWEEN 1900 AND 2030
          GROUP BY 1 ORDER BY 1 DESC LIMIT 25)""",
    ),
    "monthly_distribution": _q(
        "SELECT CAST(extract(month FROM CAST(cd AS DATE)) AS BIGINT) AS month,"
        " count(*) AS approach_count, round(avg(dist), 6) AS avg_distance,"
        " count(CASE WHEN dist < 0.05::DOUBLE THEN 1 END) AS close_approaches"
        " FROM approaches WHERE cd IS NOT NULL GROUP BY 1"
    ),
    "partition_counts": _q(
        "SELECT approach_year, count(*) AS records FROM approaches GROUP BY 1"
    ),
    "velocity_analysis": _q(
        f"SELECT {_SPEED} AS velocity_category, count(*) AS object_count,"
        " round(min(v_rel), 2) AS min_velocity, round(max(v_rel), 2) AS max_velocity,"
        " round(avg(v_rel), 2) AS avg_velocity, round(avg(dist), 6) AS avg_distance_au,"
        " round(avg(h), 2) AS avg_magnitude,"
        " count(CASE WHEN dist < 0.05::DOUBLE THEN 1 END) AS close_approaches"
        " FROM approaches WHERE v_rel IS NOT NULL AND v_rel > 0 GROUP BY 1"
    ),
    "size_distribution": _sizes(
        "count(*) AS object_count, round(min(dist), 6) AS closest_ever_au,"
        " round(avg(dist), 6) AS avg_distance_au, round(avg(v_rel), 2) AS avg_velocity_kms,"
        " round(min(h), 2) AS brightest_magnitude, round(max(h), 2) AS dimmest_magnitude,"
        " count(CASE WHEN dist < 0.05::DOUBLE THEN 1 END) AS close_approaches"
    ),
    "size_distribution_basic": _sizes(
        "count(*) AS count, round(min(dist), 6) AS closest_ever_au,"
        " round(avg(v_rel), 2) AS avg_velocity_kms"
    ),
    "size_distribution_nb": _sizes(
        "count(*) AS count, round(min(dist), 6) AS closest_approach_au,"
        " round(avg(v_rel), 2) AS avg_velocity_kms, round(min(h), 2) AS brightest,"
        " round(max(h), 2) AS dimmest"
    ),
    "size_share": _q(
        f"""SELECT size_category, object_count,
  round(100.0::DOUBLE * object_count / (SELECT count(h) FROM approaches), 1) AS percentage
FROM (SELECT {_SIZE} AS size_category, count(*) AS object_count FROM approaches
      WHERE h IS NOT NULL GROUP BY 1)"""
    ),
    "distance_statistics": _q(
        "SELECT count(*) AS total_approaches, round(min(dist), 8) AS closest_ever,"
        " round(max(dist), 6) AS farthest, round(avg(dist), 6) AS mean_distance,"
        " round(median(dist), 6) AS median_distance, round(stddev(dist), 6) AS std_distance,"
        " count(CASE WHEN dist < 0.01::DOUBLE THEN 1 END) AS very_close_approaches,"
        " count(CASE WHEN dist < 0.05::DOUBLE THEN 1 END) AS close_approaches,"
        " count(CASE WHEN dist < 0.1::DOUBLE THEN 1 END) AS notable_approaches"
        " FROM approaches WHERE dist IS NOT NULL"
    ),
    "distance_statistics_nb": _q(
        "SELECT count(*) AS total_approaches, round(min(dist), 8) AS closest_approach_au,"
        " round(max(dist), 6) AS farthest_approach_au, round(avg(dist), 6) AS mean_distance_au,"
        " round(median(dist), 6) AS median_distance_au,"
        " count(CASE WHEN dist < 0.01::DOUBLE THEN 1 END) AS very_close_approaches,"
        " count(CASE WHEN dist < 0.05::DOUBLE THEN 1 END) AS close_approaches,"
        " count(CASE WHEN dist < 0.1::DOUBLE THEN 1 END) AS notable_approaches"
        " FROM approaches WHERE dist IS NOT NULL"
    ),
    "dataset_overview": _q(
        "SELECT count(*) AS total_records, count(DISTINCT des) AS unique_objects,"
        " min(approach_year) AS earliest_year, max(approach_year) AS latest_year,"
        " count(h) AS records_with_magnitude, count(dist) AS records_with_distance FROM approaches"
    ),
    "data_quality": _q(
        "SELECT count(*) AS total_records, count(des) AS valid_designations,"
        " count(h) AS valid_magnitudes, count(dist) AS valid_distances,"
        " count(v_rel) AS valid_velocities, count(cd) AS valid_dates,"
        " min(approach_year) AS earliest_year, max(approach_year) AS latest_year FROM approaches"
    ),
    "completeness": _q(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS total_count, count({v}) AS non_null_count,"
            f" round(100.0::DOUBLE * count({v}) / count(*), 2) AS completeness_pct FROM approaches"
            for c, v in (("des", "nullif(des, '')"), ("h", "h"), ("dist", "dist"), ("v_rel", "v_rel"))
        )
    ),
    "summary_metrics": _q(
        """
SELECT 'Total NEO Approaches' AS metric, CAST(count(*) AS VARCHAR) AS value FROM approaches
UNION ALL SELECT 'Unique Objects', CAST(count(DISTINCT des) AS VARCHAR) FROM approaches
UNION ALL SELECT 'Closest Approach (AU)', printf('%.8f', round(min(dist), 8)) FROM approaches
UNION ALL SELECT 'Largest Object (H mag)', printf('%.2f', round(min(h), 2)) FROM approaches
UNION ALL SELECT 'Fastest Object (km/s)', printf('%.2f', round(max(v_rel), 2)) FROM approaches
UNION ALL SELECT 'Very Close Approaches (<0.01 AU)', CAST(count(*) AS VARCHAR)
  FROM approaches WHERE dist < 0.01::DOUBLE"""
    ),
    "key_findings": _q(
        f"""
SELECT 'risky_objects' AS finding,
       (SELECT count(*) FROM (SELECT 1 FROM approaches WHERE {_COMPLETE} LIMIT 20))::DOUBLE AS value
UNION ALL SELECT 'highest_risk_score', max({_SCORE}) FROM approaches WHERE {_COMPLETE}
UNION ALL SELECT 'latest_year', max(approach_year)::DOUBLE FROM approaches
  WHERE approach_year BETWEEN 1900 AND 2030
UNION ALL SELECT 'latest_year_approaches', count(*)::DOUBLE FROM approaches
  WHERE approach_year = (SELECT max(approach_year) FROM approaches WHERE approach_year <= 2030)
UNION ALL SELECT 'sized_objects', count(h)::DOUBLE FROM approaches
UNION ALL SELECT 'size_categories', count(DISTINCT {_SIZE})::DOUBLE FROM approaches WHERE h IS NOT NULL
UNION ALL SELECT 'closest_approach', round(min(dist), 8) FROM approaches"""
    ),
    "complex_join": _q(
        "SELECT a.des, count(a.des) AS approaches, min(a.dist) AS closest"
        " FROM approaches a JOIN approaches b ON a.des = b.des WHERE a.h IS NOT NULL"
        " GROUP BY a.des HAVING count(a.des) > 1"
    ),
    "risk_counts": _q(
        "SELECT risk_category, count(*) AS count FROM risk_rows GROUP BY 1", _BEST
    ),
    "risk_trend": _q(
        """
SELECT segment, approach_year, round(avg(risk_score), 4) AS avg_risk FROM risk_rows r
WHERE segment IN (SELECT segment FROM risk_rows GROUP BY 1
                  HAVING count(*) > 5 AND count(DISTINCT approach_year) > 1)
GROUP BY 1, 2""",
        _BEST,
    ),
    "segment_comparison": _q(
        """
SELECT round(avg(risk_score) FILTER (segment = 'historical'), 4) AS historical_avg_risk,
       round(avg(risk_score) FILTER (segment = 'future'), 4) AS future_avg_risk,
       count(*) FILTER (segment = 'historical' AND risk_score > 50) AS historical_high_risk,
       count(*) FILTER (segment = 'future' AND risk_score > 50) AS future_high_risk,
       CASE WHEN avg(risk_score) FILTER (segment = 'future')
                 > avg(risk_score) FILTER (segment = 'historical')
            THEN 'Increasing' ELSE 'Decreasing' END AS risk_trend
FROM risk_rows""",
        _BEST,
    ),
    "pivot_mean": _q(
        "SELECT risk_category, "
        + ", ".join(
            f'round(avg(dist) FILTER (approach_year = {y}), 6) AS "{y}"' for y in range(1995, 2002)
        )
        + ', round(avg(dist) FILTER (approach_year IS NULL OR approach_year NOT BETWEEN 1995 AND 2001), 6) AS "other"'
        + f" FROM (SELECT *, {_CATEGORY} AS risk_category FROM approaches"
        " WHERE h IS NOT NULL AND dist IS NOT NULL) GROUP BY 1"
    ),
    "group_speedup": """
WITH means AS (SELECT event_type, avg(value) AS m FROM events GROUP BY 1)
SELECT event_type, round(m, 6) AS mean_value, row_number() OVER (ORDER BY m, event_type) AS rank,
       round((SELECT m FROM means WHERE event_type = 'click') / m, 4) AS speedup,
       round((SELECT max(m) / min(m) FROM means), 4) AS slowest_over_fastest
FROM means""",
    "measure_stats": """
SELECT event_type, round(avg(value), 6) AS mean, round(median(value), 6) AS median,
       min(value) AS min, max(value) AS max, round(coalesce(stddev_samp(value), 0), 6) AS std,
       count(value) AS n
FROM events WHERE value IS NOT NULL GROUP BY 1""",
    "analytical_window": _top(
        "des, h, dist, v_rel, row_number() OVER (ORDER BY dist, des, h, v_rel) AS distance_rank,"
        " percent_rank() OVER (ORDER BY h DESC) AS size_percentile",
        "h IS NOT NULL AND dist IS NOT NULL",
        "dist",
        25,
        _LIST_TIES,
    ),
    "risk_rank": _top(
        f"des, h, dist, v_rel, {_COARSE} AS risk_category,"
        " row_number() OVER (ORDER BY dist, des, h, v_rel) AS risk_rank",
        "h IS NOT NULL AND dist IS NOT NULL",
        "dist",
        100,
        _LIST_TIES,
    ),
    "risk_best_per_object": _q(
        "SELECT des, fullname, h, distance_au, velocity_kms, approach_date, risk_score,"
        " risk_category FROM best WHERE rn = 1",
        _BEST,
    ),
    "section_top": _q(
        """SELECT * FROM (
  SELECT segment, row_number() OVER (PARTITION BY segment ORDER BY risk_score DESC, des,
      distance_au, approach_year) AS position, des, risk_score, risk_category
  FROM risk_rows WHERE segment IS NOT NULL) WHERE position <= 8""",
        _BEST,
    ),
    "discovery_sample": _q(
        f"""SELECT * EXCLUDE (rn) FROM (
  SELECT {_DISCOVERY},
      row_number() OVER (PARTITION BY approach_year ORDER BY {_MIX}, des, h, dist, v_rel) AS rn
  FROM approaches WHERE approach_year BETWEEN 1900 AND 2100 AND {_COMPLETE}) WHERE rn <= 50"""
    ),
    "sample_random": _q(
        f"SELECT {_COLUMNS} FROM approaches ORDER BY {_CELL}, {_HASH},"
        f" {', '.join(c + ' NULLS LAST' for c in _COLUMNS.split(', '))} LIMIT 5000"
    ),
    "sample_stratified": _per_stratum(
        f"SELECT *, {_CATEGORY} AS risk_category FROM approaches"
        " WHERE h IS NOT NULL AND dist IS NOT NULL",
        "risk_category",
        8000,
        "2000",
        f"{_COLUMNS}, risk_category",
    ),
    "sample_temporal": _per_stratum(
        "SELECT * FROM approaches",
        "year(cd)",
        7000,
        "7000 // (SELECT count(DISTINCT year(cd)) FROM approaches)",
        _COLUMNS,
    ),
    "cumulative_frames": _q(
        f"""
SELECT y.year, c.risk_category, count(a.c) AS running_count
FROM (SELECT DISTINCT approach_year AS year FROM approaches WHERE h IS NOT NULL) y
CROSS JOIN (VALUES ('VERY_HIGH'), ('HIGH'), ('MEDIUM'), ('LOW')) c(risk_category)
LEFT JOIN (SELECT approach_year, {_CATEGORY} AS c FROM approaches
           WHERE h IS NOT NULL AND dist IS NOT NULL) a
  ON a.c = c.risk_category AND a.approach_year <= y.year
GROUP BY 1, 2"""
    ),
    "histogram_dist": _histogram("approaches", "dist", 50),
    "histogram_h": _histogram("approaches", "h", 50),
    "histogram_dist_round": _rounded_histogram("dist", 15),
    "histogram_h_round": _rounded_histogram("h", 20),
    "histogram_risk": _histogram("risk_rows", "risk_score", 20, _BEST),
    "box_summary": _q(
        "SELECT risk_category, round(min(dist), 6) AS min,"
        " round(quantile_cont(dist, 0.25), 6) AS q1, round(quantile_cont(dist, 0.5), 6) AS median,"
        " round(quantile_cont(dist, 0.75), 6) AS q3, round(max(dist), 6) AS max, count(*) AS n"
        f" FROM (SELECT dist, {_CATEGORY} AS risk_category FROM approaches"
        " WHERE h IS NOT NULL AND dist IS NOT NULL) GROUP BY 1"
    ),
    "risk_dashboard": _q("SELECT * FROM risk_rows", _BEST),
}
