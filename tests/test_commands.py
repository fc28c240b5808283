from __future__ import annotations

import json

import pytest

from loadwarden.__main__ import main


@pytest.fixture
def config_file(tmp_path):
    (tmp_path / "people.csv").write_text("id,name\n1,Ash\n2,Birch\n")
    (tmp_path / "stats.csv").write_text("Name,v\nAsh,1\nAsh,2\nBirch,3\n")
    (tmp_path / "queries.sql").write_text("SELECT count(1) AS n FROM ${db_name}.${table_name};")
    columns = {"name": "string", "id": "int", "v": "int", "batch_id": "string"}
    columns["load_date"] = "string"
    settings = {
        "code_path": str(tmp_path),
        "input_path": str(tmp_path),
        "output_path": str(tmp_path / "out"),
        "source_file1": "people.csv",
        "source_file2": "stats.csv",
        "join_on": ["name"],
        "right_rename": {"Name": "name"},
        "database": {
            "db_name": "db_commands",
            "table_name": "people",
            "analytics_script": "queries.sql",
        },
        "monitoring_path": str(tmp_path / "monitoring"),
        "load_status_table": "load_status",
        "primary_key_columns": ["id", "name"],
        "threshold_percentage": 10,
        "columns": [{"name": name, "type": type} for name, type in columns.items()],
    }
    file = tmp_path / "config.json"
    file.write_text(json.dumps(settings))
    return str(file)


def test_jobs_in_order(spark, config_file, capsys):
    def run(job, *options):
        code = main([job, "--config", config_file, *options])
        return code, capsys.readouterr().out

    day = ("--run-date", "2024-01-01")
    assert run("load")[0] == 0
    assert "|3  |" in run("analytics")[1]
    assert "id data_type" in run("unit-test", *day)[1]
    code, printed = run("quality", "--previous-rows", "3", *day)
    assert code == 0 and "Total of 1 duplicate primary key values found" in printed
    code, printed = run("monitor", *day)
    assert code == 0 and "Please check Data Quality log" in printed
    assert run("monitor", "--fail-on-alert", *day)[0] == 2
    assert run("monitor", "--fail-on-alert", "--run-date", "2024-01-02")[0] == 2


def test_daily(spark, config_file, capsys):
    assert main(["daily", "--config", config_file, "--fail-on-alert"]) == 2
    assert "test_primary_key" in capsys.readouterr().out


def test_job_errors_are_not_swallowed(spark, config_file, tmp_path):
    (tmp_path / "stats.csv").write_text("Label,v\nAsh,1\n")
    with pytest.raises(ValueError, match="Name"):
        main(["load", "--config", config_file])
