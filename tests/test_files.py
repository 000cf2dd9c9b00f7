"""Delimited files with quoted line breaks, read by byte ranges."""

import csv
import random

import pytest
from pyspark.sql import types as T

from homematch.sources import files, stores

COLUMNS = ["id", "a b", "c"]


@pytest.fixture
def small_splits(spark):
    """Byte ranges of 2,000 bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def random_rows(count, seed):
    draw = random.Random(seed)
    parts = ["a", "b", '"', "\n", ",", "\r\n", " ", "x" * 30]
    rows = [(str(i), "".join(draw.choice(parts) for _ in range(draw.randint(1, 30))), f"z{i}") for i in range(count)]
    rows[count // 2] = ("long", "line\n" * 1500, "over several ranges")
    return rows


def write(path, rows, end="\n", header=True):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, quoting=csv.QUOTE_ALL, lineterminator=end)
        if header:
            writer.writerow(COLUMNS)
        writer.writerows(rows)


def test_line_breaks_across_borders(small_splits, tmp_path):
    rows = random_rows(160, 1)
    for name, end in (("a", "\n"), ("b", "\r\n")):
        write(tmp_path / f"{name}.csv", rows, end)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
    found = files.read_csv(small_splits, str(tmp_path), schema, with_order=True)
    assert files.byte_ranges(files.text_lines(small_splits, str(tmp_path))).count() > 8
    assert [tuple(r)[:3] for r in found.orderBy("_order").collect()] == rows * 2


def test_no_header_blank_lines_and_an_open_quote(small_splits, tmp_path):
    (tmp_path / "x.csv").write_text('1,"a ""b""",c\n\n2,x,y\n3,"never closed\n4,5,6\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
    records = files.csv_records(small_splits, str(tmp_path / "x.csv"))
    rows = files._parsed(records, schema, False, True).orderBy("_order").collect()
    assert [tuple(r)[:3] for r in rows[:2]] == [("1", 'a "b"', "c"), ("2", "x", "y")] and len(rows) == 3 and rows[2]["id"] == "3"


def test_types_are_inferred(small_splits, tmp_path):
    (tmp_path / "x.csv").write_text("n,big,x,day,at,yes,t\n1,9999999999,1.5,2023-01-02,2023-01-02 10:00:00,true,a\n,5,2,,,False,1\n")
    found = files.read_csv(small_splits, str(tmp_path / "x.csv"))
    assert found.dtypes == [("n", "int"), ("big", "bigint"), ("x", "double"), ("day", "date"), ("at", "timestamp"), ("yes", "boolean"), ("t", "string")]
    assert found.count() == 2
    (tmp_path / "empty.csv").write_text("a,b\n")
    assert files.read_csv(small_splits, str(tmp_path / "empty.csv")).columns == ["a", "b"]


def test_loads_do_not_depend_on_splits(spark, small_splits, tmp_path):
    """Later rows win, rows without a readable id are kept apart, whatever the splits are."""
    draw = random.Random(4)
    rows = [(draw.choice(["", "x", str(draw.randint(1, 40))]), f"v{i}\n{i}", str(i)) for i in range(300)]
    write(tmp_path / "1.csv", rows[:150])
    write(tmp_path / "2.csv", rows[150:])
    expected = {int(key): value for key, value, _ in rows if key.isdigit()}
    results = []
    for size in ("500", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        raw = files.read_csv_with_nulls(spark, [str(tmp_path / "2.csv"), str(tmp_path / "1.csv")], ["id", "v", "n"], with_order=True)
        typed = stores.geocoded_rows(raw, {"id": "bigint", "n": "bigint"})
        target = spark.createDataFrame([(1, "old", 0), (99, "kept", 0)], "id bigint, v string, n bigint")
        stored = stores.upsert(target, stores.valid_rows(typed), "id", files.ORDER)
        reasons = {r.reason: r.n for r in stores.quarantined_rows(typed).groupBy("reason").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
        results.append(({r.id: r.v for r in stored.collect()}, reasons))
    assert results[0] == results[1] == ({**expected, 99: "kept"}, {
        "error: missing id": sum(r[0] == "" for r in rows), "error: unreadable id": sum(r[0] == "x" for r in rows)})
