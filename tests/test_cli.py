"""The daily jobs through the command line, chained in one session."""

import json
import uuid

from conftest import SF0001
from pairscope.plans import cli
from pairscope.session import scratch_path
from pairscope.sources.partitioned import create_database


def test_daily_jobs_end_to_end(spark, capsys):
    db = f"cli_{uuid.uuid4().hex[:8]}"
    create_database(spark, db, scratch_path(spark, db))
    src = ["--events-dir", SF0001]
    cli.main(["features", *src, "--run-date", "20240128", "--run-date-to", "20240130",
              "--out-table", f"{db}.features"])
    counts = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [c["dt"] for c in counts] == ["20240129", "20240128", "20240127"]

    out = scratch_path(spark, "extract")
    cli.main(["extract", "--features-table", f"{db}.features", "--dt", "20240129", "--out", out])
    assert json.loads(capsys.readouterr().out)["rows"] == counts[0]["count"]

    training = scratch_path(spark, "training")
    cli.main(["training-set", *src, "--label-date", "20240103", "--label-date-to", "20240130",
              "--out", training])
    model_path = scratch_path(spark, "model")
    cli.main(["train", "--training", training, "--model", model_path, "--n-sample", "5",
              "--test-size", "0.5", "--iterations", "3", "--holdout-rows", "50"])
    assert "confusion_matrix" in capsys.readouterr().out

    cli.main(["score", "--features-table", f"{db}.features", "--result-table", f"{db}.scores",
              "--dt", "20240129", "--model", model_path])
    scored = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert scored == [{"dt": "20240129", "count": counts[0]["count"]}]
