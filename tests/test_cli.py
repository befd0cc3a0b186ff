"""The command-line runner lists, runs with parameters and explains."""

from tillroll.__main__ import main

from .conftest import SF_SMALL


def test_list(capsys):
    assert main(["--list"]) == 0
    out = capsys.readouterr().out
    assert "best_sellers" in out and "k=20" in out


def test_run_with_params_and_explain(spark, capsys):
    assert main(["best_sellers", "--sf-dir", SF_SMALL, "--param", "k=3", "--rows", "5"]) == 0
    out = capsys.readouterr().out
    assert out.count("\n|") >= 4          # header + 3 rows
    assert main(["purchase_history", "--sf-dir", SF_SMALL, "--param", "customer_id=1",
                 "--param", "days=3650", "--explain"]) == 0
    assert "PushedFilters" in capsys.readouterr().out


def test_unknown_query():
    assert main(["no_such_query"]) == 2
