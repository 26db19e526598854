"""The command line over a small CSV feed."""

from __future__ import annotations

import tempfile
from pathlib import Path

from batchwarden.__main__ import main


def _feed(bad: bool) -> str:
    path = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")) / "feed.csv"
    lines = ["Manufacturer,Odometer,Price,Model,Year,Title_Status,VIN,Posting_Date"]
    for i in range(240):
        price = -1 if bad and i < 100 else 5000 + i
        lines.append(f"ford,{1000 + i},{price},focus,2015,clean,V{i},2024-01-{1 + i // 120 * 7:02d}")
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_validate_and_load(spark, capsys):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    assert main(["validate", _feed(False)]) == 0
    printed = capsys.readouterr().out
    assert printed.count("[PASS ]") == 8
    assert main(["load", _feed(False), "--out", out]) == 0
    assert main(["load", _feed(True), "--out", out]) == 1
    assert main(["validate", _feed(True)]) == 1


def test_run_backfill(spark, capsys):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    assert main(["run", _feed(False), "--out", out, "--backfill", "--no-train"]) == 0
    assert "2024-W02" in capsys.readouterr().out
    assert main(["run", _feed(True), "--out", out, "--backfill", "--no-train"]) == 1
    lenient = ["--max-error-fraction", "0.9", "--reference-date", "2024-01-10"]
    assert main(["run", _feed(True), "--out", out, "--backfill", "--no-train", *lenient]) == 0
