"""The statistics report refuses more scripts than it has columns for."""

from argparse import Namespace

import pytest

from colloquia import cli


def test_stats_refuses_too_many_scripts(spark, tmp_path, monkeypatch):
    counts = spark.range(1001).selectExpr("'v0' as version", "concat('s', id) as script", "'1' as category", "1L as n")
    monkeypatch.setattr(cli, "version_rows", lambda spark, directory: counts)
    monkeypatch.setattr(cli.q, "version_counts", lambda rows, column: counts)
    monkeypatch.setattr(cli.sinks, "write_report_csv", lambda *args, **kwargs: pytest.fail("a report without all scripts"))
    with pytest.raises(ValueError, match="1000 scripts"):
        cli.stats(spark, Namespace(input_dir="", output=str(tmp_path), output_csv=str(tmp_path / "s.csv")))
