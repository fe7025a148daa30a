from tempest.__main__ import main

from .conftest import SF_SMALL


def test_cli_lists_and_runs_a_query(spark, tmp_path, capsys):
    assert main(["--list"]) == 0
    assert "tumble_count_avg" in capsys.readouterr().out.split()
    out = str(tmp_path / "o")
    assert main(["tumble_count_avg", SF_SMALL, out, "--format", "parquet"]) == 0
    assert spark.read.parquet(out).count() == 397
