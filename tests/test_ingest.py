"""Payload parsing, cleaning, file formats."""

import datetime
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closepass.operators import aggregates as agg
from closepass.operators import cleaning
from closepass.operators.ranking import distance_rank_with_size_percentile
from closepass.operators.reports import nearest_with_category
from closepass.schema import APPROACHES
from closepass.sinks import files as sinks
from closepass.sources import files as sources
from closepass.sources.payload import parse_payload

FIELDS = "des orbit_id jd cd dist dist_min dist_max v_rel v_inf t_sigma_f h fullname".split()
#: A leap day, a year's last minute, and a number with an exponent.
ROWS = [
    ["A-1", "7", "2460369.5", "2024-Feb-29 00:00", "1.25", "1.2", "1.3", "8.0", "7.5", "< 00:01", "21.0", "A One"],
    ["B 2", "8", "2459945.49", "2022-Dec-31 23:59", "2.5e-3", "2e-3", "3e-3", "22.75", "22.5", "3_02:10", "27.25", "(B Two)"],
    ["C3", "9", "2451545.0", "2000-Jan-01 12:00", "0.5", "0.25", "0.75", "3.125", "3", "00:07", "18", "C Three"],
]


def write_payload(path, fields=FIELDS, data=ROWS):
    document = {"signature": {"version": "1.0"}, "count": len(data), "fields": fields, "data": data}
    path.write_text(json.dumps(document, indent=1))


@pytest.fixture
def raw(spark, tmp_path):
    write_payload(tmp_path / "a.json")
    return parse_payload(spark, str(tmp_path / "a.json"))


def test_payload_rows(raw):
    rows = raw.orderBy("_row").collect()
    assert [[r[f] for f in FIELDS] for r in rows] == ROWS
    assert [r["_row"] for r in rows] == [0, 1, 2]


def test_payload_column_order_and_absent_columns(spark, tmp_path):
    write_payload(tmp_path / "a.json", ["cd", "des"], [["2024-Apr-13 12:00", "x"]])
    write_payload(tmp_path / "b.json", ["des", "h"], [["y", "1"], ["z", None]])
    rows = parse_payload(spark, str(tmp_path)).collect()
    got = sorted((r["des"], r["cd"], r["h"], r["dist"]) for r in rows)
    assert got == [("x", "2024-Apr-13 12:00", None, None), ("y", None, "1", None), ("z", None, None, None)]


def test_bad_payloads(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"invalid": "response"}')
    with pytest.raises(ValueError, match="Invalid API response format"):
        parse_payload(spark, str(tmp_path / "bad.json"))
    with pytest.raises(Exception, match="Invalid API response format"):
        parse_payload(spark, str(tmp_path / "bad.json"), strict=False).collect()
    write_payload(tmp_path / "empty.json", data=[])
    with pytest.raises(ValueError, match="API returned empty dataset"):
        parse_payload(spark, str(tmp_path / "empty.json"))


def test_clean_types_and_values(raw):
    clean = cleaning.clean(raw.drop("_file", "_row"), strict=True)
    types = dict(clean.dtypes)
    assert all(types[c] == "double" for c in "jd dist dist_min dist_max v_rel v_inf h".split())
    assert types["cd"] == "timestamp_ntz" and types["approach_year"] == "bigint"
    row = clean.filter("des = 'B 2'").first()
    assert row["cd"] == datetime.datetime(2022, 12, 31, 23, 59)
    assert (row["approach_year"], row["dist"], row["h"]) == (2022, 0.0025, 27.25)


def test_clean_bad_values(spark):
    columns = "des string, cd string, dist string, h string, v_rel string, t_sigma_f string, orbit_id string"
    rows = [
        (" a ", "2024-Apr-13 12:00", " 0.1 ", "", "invalid", "None", "nan"),
        (" a ", "2024-Apr-13 12:00", " 0.1 ", "", "invalid", "None", "nan"),
        ("nan", "2024-apr-03 1:5", "1e-3", "nan", "1d", "", "x"),
        ("b", "13/04/2024", ".5", "inf", "1.5f", " s ", " y "),
        ("c", None, "-0.001", "1", "1", "s", "y"),
        ("d", None, "0", "1", "1", "s", "y"),
        ("e", None, "oops", "1", "1", "s", "y"),
        ("f", None, None, "1", "1", "s", "y"),
    ]
    got = cleaning.clean(spark.createDataFrame(rows, columns)).orderBy("dist").collect()
    assert [tuple(r)[:7] for r in got] == [
        (None, datetime.datetime(2024, 4, 3, 1, 5), 0.001, None, None, None, "x"),
        ("a", datetime.datetime(2024, 4, 13, 12), 0.1, None, None, None, "nan"),
        ("b", None, 0.5, None, None, "s", " y "),
    ]
    assert [r["approach_year"] for r in got] == [2024, 2024, None]


def test_clean_empty(spark):
    empty = spark.createDataFrame([], "des string, dist string")
    with pytest.raises(ValueError, match="Cannot clean empty DataFrame"):
        cleaning.clean(empty, strict=True)
    assert cleaning.clean(empty).count() == 0
    with pytest.raises(ValueError, match="All data was filtered out"):
        cleaning.clean(spark.createDataFrame([("a", "-1")], "des string, dist string"), strict=True)


def test_clean_strips_column_names(spark):
    df = spark.createDataFrame([("a", "1")], ["des ", " dist"])
    assert cleaning.clean(df).columns == ["des", "dist", "approach_year"]


def test_key_dedupe_keeps_first_in_source_order(spark, tmp_path):
    write_payload(tmp_path / "a.json", ["des", "cd", "h"], [["x", "t", "1"], ["x", "t", "2"], ["y", "t", "3"]])
    write_payload(tmp_path / "b.json", ["des", "cd", "h"], [["x", "t", "4"], ["y", "u", "5"]])
    rows = parse_payload(spark, str(tmp_path))
    kept = cleaning.dedupe_by_key(rows, order=["_file", "_row"])
    assert sorted(r["h"] for r in kept.collect()) == ["1", "3", "5"]


@pytest.fixture(scope="module")
def table(spark, small):
    missing = [f for f in APPROACHES if f.name not in small.columns]
    return small.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]
    ).select(*APPROACHES.fieldNames())


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_round_trip(spark, table, tmp_path, fmt):
    path = sinks.save(table, fmt, str(tmp_path / f"t.{fmt}"))
    back = sources.load_table(spark, path)
    assert back.schema == APPROACHES
    assert sorted(back.collect()) == sorted(table.collect())
    assert spark.table("approaches").count() == 5


def test_json_array_form(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '[{"des": "a", "dist": 0.5, "cd": "2024-01-01T00:00:00.000"}, {"des": "b", "h": 3.0}]'
    )
    rows = sources.load_table(spark, str(tmp_path / "a.json"), multi_line=True).orderBy("des").collect()
    assert (rows[0]["dist"], rows[0]["cd"], rows[1]["h"]) == (0.5, datetime.datetime(2024, 1, 1), 3.0)


def test_csv_designations_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("dist,des,extra\n0.5,00433,x\n")
    row = sources.load_table(spark, str(tmp_path / "a.csv")).first()
    assert (row["des"], row["dist"], row["h"]) == ("00433", 0.5, None)


def test_save_and_load_errors(spark, table, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format: xlsx"):
        sinks.save(table, "xlsx", str(tmp_path / "t.xlsx"))
    with pytest.raises(ValueError, match="Cannot save empty DataFrame"):
        sinks.save(table.limit(0), "csv", str(tmp_path / "t.csv"))
    with pytest.raises(FileNotFoundError):
        sources.load_table(spark, str(tmp_path / "none.csv"))
    (tmp_path / "t.txt").write_text("x")
    with pytest.raises(ValueError, match="Unsupported file format: .txt"):
        sources.load_table(spark, str(tmp_path / "t.txt"))


def test_replace_table(spark, table, tmp_path):
    path = sinks.save(table, "parquet", str(tmp_path / "t.parquet"))
    for _ in range(2):
        assert sources.replace_table(spark, path, "replaced").count() == 5


def test_latest_file(spark, tmp_path):
    now = time.time()
    for name, age in (("a_3.csv", 30), ("a_1.csv", 0), ("b.txt", -60)):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (now - age, now - age))
    assert sources.latest_file(spark, str(tmp_path), "a_*").endswith("a_1.csv")
    assert sources.latest_file(spark, str(tmp_path), "a_*", by="name").endswith("a_3.csv")
    with pytest.raises(FileNotFoundError):
        sources.latest_file(spark, str(tmp_path), "c_*")


BENCHMARK = {
    "simple_count": agg.simple_count,
    "filtered_count": agg.filtered_count,
    "aggregation": agg.yearly_counts,
    "complex_filtering": nearest_with_category,
    "analytical_window": distance_rank_with_size_percentile,
}


def test_formats_agree_and_footprint(spark, approaches, tmp_path):
    df = approaches.select(*APPROACHES.fieldNames())
    paths = sinks.save_all(df, str(tmp_path / "t"))
    paths["by_year"] = sinks.save_by_year(df, str(tmp_path / "by_year"))
    tables = {f: sources.load_table(spark, paths[f], view=None) for f in ("csv", "parquet", "json")}
    tables["by_year"] = sources.read_parquet(spark, paths["by_year"])
    for query in BENCHMARK.values():
        expected = [tuple(r) for r in query(df).collect()]
        for table in tables.values():
            assert [tuple(r) for r in query(table).collect()] == expected

    sizes = {r["format"]: r for r in sinks.storage_footprint(spark, paths).collect()}
    on_disk = sum(
        os.path.getsize(os.path.join(d, f))
        for d, _, names in os.walk(paths["csv"])
        for f in names
        if not f.startswith((".", "_"))
    )
    assert sizes["csv"]["size_bytes"] == on_disk
    assert sizes["csv"]["compression_ratio"] == 1.0
    assert sizes["parquet"]["compression_ratio"] > 1.5
    assert sizes["by_year"]["partitions"] == 7
    assert sinks.best_format(sinks.storage_footprint(spark, paths)).first()["format"] in (
        "parquet",
        "by_year",
    )


def test_unknown_types_do_not_leak(table):
    assert isinstance(table.schema["cd"].dataType, T.TimestampNTZType)
