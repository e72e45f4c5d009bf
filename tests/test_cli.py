import pytest

import tripflow.__main__ as cli
from tripflow.fixtures import as_records, load_feed
from tripflow.plans.warehouse import Warehouse
from tripflow.streaming.lake import Lake


@pytest.fixture
def here(spark, monkeypatch):
    """Commands run in the test session."""
    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)


def test_stream_then_promote(spark, here, tmp_path, capsys):
    as_records(load_feed(spark, "/root/testdata/sf0.001")).write.parquet(str(tmp_path / "records"))
    lake = str(tmp_path / "lake")
    cli.main(["stream", "--records", str(tmp_path / "records"), "--lake", lake, "--checkpoint", str(tmp_path / "cp"), "--drain"])
    day = Lake(lake).read_clean(spark).first().ingestion_date.isoformat()
    target = ["--warehouse", str(tmp_path / "tables"), "--database", "cli_promote", "--buckets", "2"]
    cli.main(["promote", "--lake", lake, "--date", day, *target])
    out = capsys.readouterr().out
    assert "'attempted': 839, 'inserted': 833, 'quarantined': 0" in out and "'fct_trips': 167" in out
    # Names come from the validated path, so case is folded.
    assert {r[1] for r in spark.table("cli_promote.dim_payment_method").collect()} == {"cash", "card", "ecocash"}
    cli.main(["promote", "--lake", lake, "--date", "1999-01-01", *target])
    assert "'attempted': 0, 'inserted': 0" in capsys.readouterr().out


def test_arguments_are_required():
    for command in (["stream"], ["batch"], ["promote"], []):
        with pytest.raises(SystemExit):
            cli.main(command)


def test_single_steps(spark, here, tmp_path, capsys):
    target = ["--warehouse", str(tmp_path / "tables"), "--database", "cli_steps", "--buckets", "2"]
    records, lake = str(tmp_path / "records"), str(tmp_path / "lake")
    as_records(load_feed(spark, "/root/testdata/sf0.001")).write.parquet(records)
    cli.main(["stream", "--records", records, "--lake", lake, "--checkpoint", str(tmp_path / "cp"), "--drain"])
    cli.main(["promote", "--lake", lake, "--date", "1999-01-01", *target])
    cli.main(["load", "--table", "dim_driver", *target])
    cli.main(["load", "--table", "fct_trips", "--since", "2000-01-01T00:00:00", *target])
    cli.main(["fill", "--table", "fct_trips", *target])
    cli.main(["clean", "--older-than-hours", "0", *target])
    out = capsys.readouterr().out
    assert "{'dim_driver': 0}" in out and "{'fct_trips': 0}" in out and "{'removed': 0}" in out
    with Warehouse(spark, "cli_steps", str(tmp_path / "tables")).writing("dim_driver"):
        cli.main(["unlock", "--table", "dim_driver", *target])
        cli.main(["load", "--table", "dim_driver", *target])
