"""Bench: headline survey jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line. The headline metric is the wall time of the full
published feature table (all metrics x race groups x states/metros/nation x
two-week intervals, with 80 replicate SEs), computed from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from repweave.session import get_spark  # noqa: E402
from repweave.plans import queries as Q  # noqa: E402

HEADLINE = ["feature_table", "us_total", "svy_mean", "normalise_food2b",
            "enrich_weights", "recode_mental_health"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark()
    timings, rows = {}, {}
    for name in HEADLINE:
        t = time.time()
        df = Q.SPARK[name](spark, sf_dir)
        rows[name] = len(df.collect())
        timings[name] = round(time.time() - t, 3)
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "feature_table_seconds", "value": timings["feature_table"],
                      "unit": "sec", "queries": timings, "rows": rows,
                      "cpus": int(os.environ.get("BENCH_CPUS", "8")),
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
