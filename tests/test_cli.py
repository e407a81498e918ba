"""The command line over a small registry."""

import json

from rollcall import __main__ as cli
from rollcall.operators import registry


def test_commands(spark, tmp_path, capsys):
    rows = [
        {"meeting_key": "a", "viebit_filename": "f1", "event_date": "2025-05-01", "event_time": "10:00 AM", "body_name": "Parks", "process_attempts": 0},
        {"meeting_key": "b", "viebit_filename": "f2", "event_date": "2025-05-02", "event_time": None, "body_name": "Land Use", "process_attempts": 5},
        {"meeting_key": "c", "viebit_filename": None, "event_date": "2025-05-03", "event_time": None, "body_name": "X", "process_attempts": 0},
        {"meeting_key": "d", "viebit_filename": "f4", "event_date": "2025-01-03", "event_time": None, "body_name": "X", "process_attempts": 0},
    ]
    spark.createDataFrame(rows, "meeting_key string, viebit_filename string, event_date string, event_time string, body_name string, process_attempts long").write.parquet(f"{tmp_path}/reg")
    cli.main(["pending-matrix", "--registry", f"{tmp_path}/reg"])
    assert json.loads(capsys.readouterr().out) == [{"meeting_key": "a"}]
    (tmp_path / "res").mkdir()
    (tmp_path / "res" / "1.json").write_text(json.dumps({"status": "complete", "row": {"meeting_key": "a", "fetch_status": "fetched", "process_attempts": 1, "cost_usd": 0.24}}))
    cli.main(["merge-results", "--registry", f"{tmp_path}/reg", "--results", f"{tmp_path}/res", "--out", f"{tmp_path}/new"])
    new = {r.meeting_key: r for r in spark.read.parquet(f"{tmp_path}/new").collect()}
    assert new["a"].fetch_status == "fetched" and new["a"].process_attempts == 1 and new["a"].cost_usd == 0.24 and new["b"].fetch_status == "pending"
    cli.main(["reset-meeting", "--registry", f"{tmp_path}/new", "--key", "a", "--out", f"{tmp_path}/reset"])
    assert registry.one(spark.read.parquet(f"{tmp_path}/reset"), "meeting_key", "a").first().fetch_status == "pending"
    for command in ("status", "ci-health", "publishable"):
        cli.main([command, "--registry", f"{tmp_path}/new"])
    cli.main(["verify-run-results", "--registry", f"{tmp_path}/reg", "--results", f"{tmp_path}/res"])
    assert "missing" in capsys.readouterr().out
