"""One large JSON array against Spark's reader of whole documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from closepass.schema import RAW_COLUMNS
from closepass.sources import arrays
from closepass.sources.arrays import parse_large_payload, read_json_array
from closepass.sources.files import read_json
from closepass.sources.payload import parse_payload

#: Texts that cut records, look like members, or hold escaped quotes.
ODD = ["plain", "a ] b", '],["x","y"', 'say "]" and \\', '"data":[[', '{"fields":["des"]', "},{", "", "é 中 ]]]", "line\nbreak ]", None]


@pytest.fixture(scope="module")
def small_splits(spark):
    """Files are cut into blocks of a few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "700")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def rows_of(n, odd_share):
    rng = random.Random(n)
    return [[rng.choice(ODD) if rng.random() < odd_share else f"{k}.{c}" for c in range(len(RAW_COLUMNS))] for k in range(n)]


def same_rows(got, want):
    key = lambda r: (r["_file"], r["_row"])
    plain = lambda rows: [tuple(r[c] for c in RAW_COLUMNS) for r in sorted(rows, key=key)]
    assert plain(got.collect()) == plain(want.collect())


@pytest.mark.parametrize("odd_share,indent,data_first", [(0.0, None, False), (0.02, 1, True), (0.02, None, True), (0.6, 1, False), (0.6, None, True)])
def test_payloads(spark, small_splits, tmp_path, odd_share, indent, data_first):
    for k, n in enumerate((1, 40, 300)):
        fields = {"fields": [*RAW_COLUMNS[3:], "more", *RAW_COLUMNS[:2]]}
        data = {"data": rows_of(n, odd_share)}
        document = {"signature": {"version": '1 "]" '}, "count": str(n), **(data if data_first else fields), **(fields if data_first else data)}
        (tmp_path / f"{k}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=bool(k % 2)))
    got = parse_payload(spark, str(tmp_path), split=True)
    assert arrays._pieces(spark, str(tmp_path), "]").rdd.getNumPartitions() > 20
    same_rows(got, parse_payload(spark, str(tmp_path)))


@pytest.mark.parametrize("odd_share", [0.0, 0.3])
def test_arrays_of_objects(spark, small_splits, tmp_path, odd_share):
    rng = random.Random(5)
    rows = [
        {"des": rng.choice(ODD) if rng.random() < odd_share else str(k), "dist": k / 7, "h": None, "approach_year": k, "cd": "2001-02-03T04:05:06"}
        for k in range(400)
    ]
    for k, indent in enumerate((None, 2)):
        (tmp_path / f"{k}.json").write_text(json.dumps(rows[k * 100 :], indent=indent))
    got, want = read_json(spark, str(tmp_path), split=True), read_json(spark, str(tmp_path), multi_line=True)
    assert got.schema == want.schema and arrays._pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() > 20
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 700


def test_text_without_brackets_in_strings_is_not_shuffled(spark, small_splits, tmp_path):
    document = {"fields": list(RAW_COLUMNS), "data": rows_of(200, 0.0)}
    (tmp_path / "p.json").write_text(json.dumps(document))
    got = parse_large_payload(spark, str(tmp_path)).select("des")
    assert got.count() == 200
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text


def test_bad_documents(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"message": "no [data] here"}')
    with pytest.raises(ValueError, match="Invalid API response format"):
        parse_large_payload(spark, str(tmp_path / "bad.json"))
    (tmp_path / "none.json").write_text('{"fields": ["des"], "data": []}')
    with pytest.raises(ValueError, match="API returned empty dataset"):
        parse_large_payload(spark, str(tmp_path / "none.json"))
    assert parse_large_payload(spark, str(tmp_path / "none.json"), strict=False).count() == 0
    (tmp_path / "empty.json").write_text("[]")
    assert read_json_array(spark, str(tmp_path / "empty.json")).select(F.count("*")).first()[0] == 0
