from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, ParseException

from loadwarden.plans import run_sql_script, script_statements, show_results


@pytest.mark.parametrize(
    ("script", "statements"),
    [
        ("", []),
        (" ;; \n; ", []),
        ("select 1", ["select 1"]),
        ("select 1;select 2;", ["select 1", "select 2"]),
        ("select 'a;b'; select 2", ["select 'a;b'", "select 2"]),
        ("select 'it''s; ok'; x", ["select 'it''s; ok'", "x"]),
        (r"select 'a\';b'; x", [r"select 'a\';b'", "x"]),
        (r"select r'a\'; x", [r"select r'a\'", "x"]),
        ('select "a;b"; x', ['select "a;b"', "x"]),
        ("select `a;b`; x", ["select `a;b`", "x"]),
        ("-- it's; a comment\nselect 1; -- tail;", ["select 1"]),
        ("select 1 /* a; 'b */ + 2; /* only */", ["select 1   + 2"]),
        ("select /* a; /* b; */ c; */ 1; x", ["select   1", "x"]),
        ("select /*+ broadcast(t) */ 1; x", ["select /*+ broadcast(t) */ 1", "x"]),
        ("select '--no; comment', 1 - -1", ["select '--no; comment', 1 - -1"]),
        ("select 6 / 2 * 3; x", ["select 6 / 2 * 3", "x"]),
    ],
)
def test_split(script, statements):
    assert script_statements(script) == statements


def test_unclosed_comment_is_an_error():
    with pytest.raises(ValueError, match="not closed"):
        script_statements("select 1 /* never; ends")


def test_placeholders():
    script = "select * from ${db_name}.${table_name}; -- ${unknown} in a comment"
    assert script_statements(script, {"db_name": "d", "table_name": "t"}) == ["select * from d.t"]


def test_unknown_placeholder_is_an_error():
    with pytest.raises(ValueError, match="other"):
        script_statements("select ${other}", {"db_name": "d"})


@pytest.mark.parametrize("value", ["a; drop table t", "it's", 'a"b', "a`b", "a\\b"])
def test_value_cannot_leave_its_place(value):
    with pytest.raises(ValueError, match="db_name"):
        script_statements("select '${db_name}'", {"db_name": value})


words = st.text(st.sampled_from("ab ;-/*'\"`\n"), max_size=8)


@given(st.lists(words, min_size=1, max_size=4))
def test_quoted_texts_are_never_split(texts):
    statements = ["select '" + text.replace("'", "''") + "'" for text in texts]
    assert script_statements(";\n".join(statements)) == statements


# The first three commands are those that existing DDL scripts have.
def test_run(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("good",), ("good",), (None,)], "side string").write.parquet(path)
    script = """
        CREATE DATABASE IF NOT EXISTS ${db_name};
        CREATE TABLE IF NOT EXISTS ${db_name}.${table_name}
        USING parquet OPTIONS (path '${parquet_path}');
        REFRESH TABLE ${db_name}.${table_name};
        SELECT coalesce(side, 'none') AS s, max(length(side)) AS n FROM ${db_name}.${table_name} GROUP BY 1;
        SELECT count(1) n, ';' s FROM IDENTIFIER(:t) WHERE side = :value
    """
    results = run_sql_script(
        spark,
        script,
        {"db_name": "script_db", "table_name": "t", "parquet_path": path},
        {"t": "script_db.t", "value": "good"},
    )
    assert len(results) == 5
    assert rows(results[3]) == [("good", 4), ("none", None)]
    assert rows(results[4]) == [(2, ";")]


def test_errors_reach_the_caller_and_end_the_script(spark):
    with pytest.raises(AnalysisException):
        run_sql_script(
            spark,
            "select * from no_such_table; create or replace temporary view late as select 1",
        )
    assert not spark.catalog.tableExists("late")
    with pytest.raises(ParseException):
        run_sql_script(spark, "selec 1")


def test_show(spark, capsys):
    results = run_sql_script(spark, "select 'y' as a; select id as b from range(60)")
    show_results(results)
    printed = capsys.readouterr().out
    assert "|y|" in printed and printed.count("|") == 4 + 2 + 120
    show_results(results, 50)
    assert "only showing top 50 rows" in capsys.readouterr().out
