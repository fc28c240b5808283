"""CSV tables taken in by one pass: types, records that do not fit, and what is read."""

from __future__ import annotations

import dataclasses
import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadwarden.config import LoadConfig
from loadwarden.intake import OTHER_FIELDS, WRONG_TYPE, TooManyRejected, column_type, take_in_csv
from loadwarden.plans import load_pipeline, published_rows, rejected_records
from loadwarden.sinks import overwrite_csv
from loadwarden.sources import Source, read_csv

LOAD_TS = "2024-01-01 06:00:00"
SF = "/root/testdata/sf0.001"
BAD = 'id,name,v\n1,"a, b",1.5\nx,b,2\n3,c\n4,d,5,6\n5,"e",zz\n,f,\n'


def taken(spark, tmp_path, text, schema=None, **options):
    (tmp_path / "s.csv").write_text(text, encoding="utf-8")
    return take_in_csv(spark, str(tmp_path / "s.csv"), str(tmp_path / "in"), schema, **options)


@pytest.mark.parametrize("name", ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "benchmark"])
def test_types_and_rows_are_those_of_inference(spark, tmp_path, name):
    table = spark.read.parquet(f"{SF}/{name}.parquet")
    overwrite_csv(table, str(tmp_path / "t"), multiLine=True)
    inferred = read_csv(spark, str(tmp_path / "t"), multiLine=True)
    intake = take_in_csv(spark, str(tmp_path / "t"), str(tmp_path / "in"), multiLine=True)
    assert intake.rows.dtypes == inferred.dtypes
    assert inferred.exceptAll(intake.rows).isEmpty() and intake.rows.exceptAll(inferred).isEmpty()
    assert (intake.num_rows, intake.num_rejected) == (table.count(), 0)


def test_types_of_odd_values_are_those_of_inference(spark, tmp_path):
    text = (
        "i,l,d,x,day,ts,b,m,e,w,z,s,mix,day1\n"
        '1,5000000000,12345678901234567890,1.5,2024-01-02,2024-01-02 03:04:05,true,2024-01-01,,+5,007,1d,1,2024-1-2\n'
        '-2,3,4,2,2024-01-03,2024-01-02T03:04:05Z,FALSE,2024-01-01 01:00:00,"",6,1e5,2,true,2024-01-03\n'
        "3,,,NaN,,,,,,,Inf,3,,\n"
    )
    intake = taken(spark, tmp_path, text)
    assert intake.rows.dtypes == read_csv(spark, str(tmp_path / "s.csv")).dtypes
    first, second, third = intake.rows.orderBy("x").collect()
    assert (first.d, first.day, first.w, first.e) == (Decimal("12345678901234567890"), dt.date(2024, 1, 2), 5, None)
    assert (second.b, second.e, second.mix) == (False, "", "true")
    assert third.z == float("inf")


def test_the_source_is_read_once(spark, tmp_path):
    spark.range(0, 400_000, 1, 4).selectExpr("id", "id * 0.5 as half", "'some text' as t").write.csv(
        str(tmp_path / "t"), header=True
    )
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.csv"))

    def read(action) -> int:
        statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
        before = sum(s.getBytesRead() for s in statistics())
        action()
        return sum(s.getBytesRead() for s in statistics()) - before

    twice = read(lambda: read_csv(spark, str(tmp_path / "t")).write.parquet(str(tmp_path / "p")))
    once = read(lambda: take_in_csv(spark, str(tmp_path / "t"), str(tmp_path / "in")))
    assert twice >= 2 * size
    assert size <= once < 1.3 * size


@given(st.lists(st.sampled_from([1, 2, 4, 8, 16, 32, 64, 128]), max_size=6), st.randoms())
@settings(max_examples=200, deadline=None)
def test_findings_can_be_merged_in_any_order(kinds, rng):
    def merged(values):
        found = 0
        for value in values:
            found |= value
        return column_type(found)

    shuffled = kinds + kinds
    rng.shuffle(shuffled)
    assert merged(shuffled) == merged(kinds)


def test_types_hold_each_other():
    assert [column_type(k) for k in (0, 1, 2, 3, 9, 16, 32, 48, 64, 65, 128, 17)] == [
        "string", "int", "bigint", "bigint", "double", "date", "timestamp", "timestamp", "boolean", "string", "string", "string",
    ]
    assert [column_type(4, n) for n in (19, 25, 38, 39)] == ["decimal(20,0)", "decimal(25,0)", "decimal(38,0)", "double"]


def test_records_that_do_not_fit_are_set_aside(spark, tmp_path):
    intake = taken(spark, tmp_path, BAD, "id int, name string, v double")
    assert sorted(tuple(r) for r in intake.rows.na.fill(-1).collect()) == [(-1, "f", -1.0), (1, "a, b", 1.5)]
    rejected = {r.text: r.reason for r in intake.rejected.collect()}
    assert rejected == {
        "x,b,2": f"{WRONG_TYPE}id",
        "3,c": OTHER_FIELDS,
        "4,d,5,6": OTHER_FIELDS,
        '5,"e",zz': f"{WRONG_TYPE}v",
    }
    assert all(r.file.endswith("s.csv") for r in intake.rejected.collect())
    assert (intake.num_rows, intake.num_rejected) == (2, 4)


def test_without_types_only_the_number_of_fields_counts(spark, tmp_path):
    intake = taken(spark, tmp_path, BAD)
    assert intake.rows.dtypes == [("id", "string"), ("name", "string"), ("v", "string")]
    assert (intake.num_rows, intake.num_rejected) == (4, 2)
    assert {r.reason for r in intake.rejected.collect()} == {OTHER_FIELDS}


def test_rejected_values_do_not_count_for_types(spark, tmp_path):
    assert taken(spark, tmp_path, "a,b\n1,2\nx\n3,4\n").rows.dtypes == [("a", "int"), ("b", "int")]


def test_a_limit_of_rejected_records(spark, tmp_path):
    schema = "id int, name string, v double"
    assert taken(spark, tmp_path, BAD, schema, most_rejected=4).num_rejected == 4
    with pytest.raises(TooManyRejected, match="4 records"):
        taken(spark, tmp_path, BAD, schema, most_rejected=3)
    assert spark.read.parquet(str(tmp_path / "in")).where("kind = 'rejected'").count() == 4


def test_another_header_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        taken(spark, tmp_path, "name,id\na,1\n", "id int, name string")


def test_a_header_alone_and_columns_with_names_used_inside(spark, tmp_path):
    empty = taken(spark, tmp_path, "a,b\n")
    assert (empty.rows.dtypes, empty.num_rows, empty.num_rejected) == ([("a", "string"), ("b", "string")], 0, 0)
    assert empty.rows.collect() == [] and empty.rejected.collect() == []
    names = "kind,text,file,reason,record,_corrupt,a.b,kinds0"
    intake = taken(spark, tmp_path, f"{names}\n1,2,3,4,5,6,7,8\n1,2\n")
    assert intake.rows.columns == names.split(",")
    assert tuple(intake.rows.first()) == (1, 2, 3, 4, 5, 6, 7, 8)
    assert intake.rejected.count() == 1


def test_line_breaks_in_rejected_records(spark, tmp_path):
    intake = taken(spark, tmp_path, 'id,t\n1,"a\nb"\nx,"c\nd"\n', "id int, t string", multiLine=True)
    assert [tuple(r) for r in intake.rows.collect()] == [(1, "a\nb")]
    assert [r.reason for r in intake.rejected.collect()] == [f"{WRONG_TYPE}id"]


def test_a_load_sets_records_aside_and_keeps_them(spark, tmp_path, request):
    (tmp_path / "left.csv").write_text("id,name\n" + "".join(f"{i},n{i}\n" for i in range(50)) + "x,bad\ny,worse\n")
    (tmp_path / "right.csv").write_text("id,v\n" + "".join(f"{i},{i}\n" for i in range(40)) + "1\n")
    config = LoadConfig(
        left=Source(str(tmp_path / "left.csv"), schema="id bigint, name string", most_rejected=2, rename={"name": "called"}),
        right=Source(str(tmp_path / "right.csv"), most_rejected=1),
        join_on=["id"],
        database="db_intake",
        table="t",
        target_path=str(tmp_path / "out" / "t"),
        results_path=str(tmp_path / "monitoring"),
        ledger_path=str(tmp_path / "monitoring" / "ledger"),
        key_columns=["id"],
        expected_columns=[("id", "bigint")],
        keep_loads=2,
    )
    table = load_pipeline(spark, config, LOAD_TS)
    assert table.columns[:3] == ["id", "called", "v"] and table.count() == 40
    found = sorted((r.side, r.text, r.reason) for r in rejected_records(spark, config).collect())
    assert found == [
        ("left", "x,bad", f"{WRONG_TYPE}id"),
        ("left", "y,worse", f"{WRONG_TYPE}id"),
        ("right", "1", OTHER_FIELDS),
    ]
    intakes = tmp_path / "out" / "t-loads" / "intake"
    assert not list(intakes.glob("*/*/kind=rows")) and len(list(intakes.glob("*/*/kind=rejected"))) == 2
    strict = dataclasses.replace(config, left=dataclasses.replace(config.left, most_rejected=1))
    with pytest.raises(TooManyRejected):
        load_pipeline(spark, strict, LOAD_TS)
    assert published_rows(spark, config) == 40 and table.count() == 40
    (tmp_path / "left.csv").write_text("id,name\n1,a\n")
    load_pipeline(spark, config, LOAD_TS)
    assert [r.side for r in rejected_records(spark, config).collect()] == ["right"]


def test_only_csv_sources_set_records_aside():
    with pytest.raises(ValueError, match="CSV"):
        Source("p", "parquet", most_rejected=1)
