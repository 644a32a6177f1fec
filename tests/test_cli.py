from datetime import date, datetime

import pytest

from farebox.__main__ import main
from support import month_file


def test_command_line(spark, folder, capsys):
    raw = f"{folder}/raw"
    month_file(raw, date(2024, 1, 1), rows=6)
    month_file(raw, date(2024, 3, 1), rows=8, variant="B")
    month_file(raw, date(2024, 4, 1), drop=["tip_amount"])
    base = [
        "--table", f"{folder}/table", "--ledger", f"{folder}/ledger",
        "--summary", f"{folder}/summary", "--raw", raw,
    ]

    def run(*args):
        assert main([*base, *args]) == 0
        return capsys.readouterr().out

    run("create")
    assert "6 rows in" in run("load", "--year", "2024", "--months", "1")
    out = run("backfill", "--from", "2024-01", "--to", "2024-04")
    assert "2024-02  no file, skipped" in out and "2024-04  skipped" in out and "lacks tip_amount" in out
    assert "14 rows in" in out
    assert "passed: 8 rows" in run("quality", "2024-03")
    assert "8 rows in" in run("scheduled", "--run-date", "2024-06-01")
    assert "all passed" in run("health")
    out = run("sql", "SELECT month, trip_count FROM v_monthly_trend")
    assert "2024-03-01 00:00:00|8" in out
    assert "|success|" in run("sql", "SELECT DISTINCT status FROM pipeline_runs")
    month_file(raw, date(2024, 5, 1), rows=3)
    run("watch", "--checkpoint", f"{folder}/checkpoint")
    assert "|17|" in run("sql", "SELECT count(*) AS trips FROM clean_taxi_trips")
    with pytest.raises(ValueError, match="2024-02 has no rows"):
        run("quality", "2024-02")


def test_all_rows_are_printed(spark, folder, capsys):
    base = ["--table", f"{folder}/table", "--ledger", f"{folder}/ledger"]
    assert main([*base, "create"]) == 0
    capsys.readouterr()
    assert main([*base, "sql", "SELECT id FROM range(2500)"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 2501
    assert main([*base, "sql", "SELECT id FROM range(2500)", "--limit", "3"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 4
    assert main([*base, "sql", "SELECT id FROM range(2500)", "--out", f"{folder}/rows"]) == 0
    assert spark.read.parquet(f"{folder}/rows").count() == 2500
    assert main([*base, "health"]) == 1


def test_usage_errors(folder, capsys):
    base = ["--table", f"{folder}/table", "--ledger", f"{folder}/ledger"]
    for command in (["load", "--year", "2024", "--months", "1"], ["load", "--months", "1"], ["backfill"]):
        with pytest.raises(SystemExit):
            main([*base, *command])
    assert "needs --raw" in capsys.readouterr().err


def test_rejected_trips_deletes_and_exports(spark, folder, capsys):
    raw = f"{folder}/raw"
    month_file(raw, date(2024, 1, 1), rows=6, strays=[datetime(2023, 5, 5)])
    month_file(raw, date(2024, 2, 1), rows=4, fare=2000.0)
    base = [
        "--table", f"{folder}/table", "--ledger", f"{folder}/ledger", "--quarantine", f"{folder}/rejected", "--raw", raw]

    def run(*args):
        assert main([*base, *args]) == 0
        return capsys.readouterr().out

    run("create")
    out = run("backfill", "--from", "2024-01", "--to", "2024-02", "--layout", "clustered")
    assert "2024-01  6 rows of 7, 1 rejected" in out and "2024-02  0 rows of 4, 4 rejected" in out
    out = run("rejected").splitlines()
    assert out[1:] == ["|2024-01-01|128|foreign_month|1|", "|2024-02-01|4|bad_fare_high|4|"]
    assert "6 rows in 1 files" in run("export", f"{folder}/csv")
    assert "0 rows in 0 files" in run("export", f"{folder}/csv", "--from", "2024-02")
    assert "2024-01  deleted" in run("delete", "--from", "2024-01", "--to", "2024-02")
    assert "|deleted|6|" in run("sql", "SELECT status, rows_loaded FROM pipeline_runs WHERE status = 'deleted'")
    with pytest.raises(SystemExit):
        main([*base[:4], "rejected"])
