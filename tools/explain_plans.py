"""Write ``explain("formatted")`` of the main queries to docs/plans/.

The plans of tables that a query stores on the way come first.
Two variants per query: as planned on the test data (small sides broadcast)
and with broadcasts disabled, which is how the plan looks when every side is
large (a big cluster).  Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pairscope.operators import features, labels  # noqa: E402
from pairscope.plans import registry  # noqa: E402
from pairscope.session import get_session, stored  # noqa: E402

QUERIES = ["serving_features", "training_set", "pre_order_searches", "balanced_sample",
           "holdout_complement", "classification_report", "history_route_flag"]
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def planned(build) -> str:
    """The plans of the tables that ``build`` stores, and of its result."""
    parts: list[str] = []

    def recording(df, name="frame"):
        parts.append(f"==== stored: {name} ====\n{explain(df)}")
        return stored(df, name)

    features.stored = labels.stored = recording
    try:
        df = build()
    finally:
        features.stored = labels.stored = stored
    return "\n".join([*parts, f"==== result ====\n{explain(df)}" if parts else explain(df)])


def main(sf_dir: str) -> None:
    spark = get_session("local[8]", 8, extra={"spark.ui.enabled": "false",
                                              "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for variant, conf in (("test-data", {}), ("no-broadcast", NO_BROADCAST)):
        old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in QUERIES:
            text = planned(lambda: registry.QUERIES[name](spark, sf_dir))
            with open(os.path.join(out_dir, f"{name}.{variant}.txt"), "w") as f:
                f.write(text)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
