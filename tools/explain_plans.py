"""Write the final (post-AQE) physical plan of selected query keys to PLANS.md.

Usage: python tools/explain_plans.py [sf] [key ...]
Each key's own plan is executed first, so adaptive re-planning is reflected; long expression lines are trimmed to keep the file readable.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumage.plans.registry import QUERIES  # noqa: E402
from plumage.session import local_session  # noqa: E402

DEFAULT_KEYS = ["filter_label_train", "hex_to_int", "csv_scan_dropmalformed", "describe_profile",
                "stage_counts", "term_frequency", "idf", "tfidf", "hashing_tf", "standard_scale",
                "feature_pipeline", "train_evaluate", "eval_metrics"]
WIDTH = 160


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.1"
    keys = sys.argv[2:] or DEFAULT_KEYS
    spark = local_session(8, 16, app="plumage-plans")
    out = [f"# Physical plans (sf{sf}, local[8], AQE final plans)\n",
           "Generated by `python tools/explain_plans.py`. Lines are trimmed to "
           f"{WIDTH} characters.\n"]
    for k in keys:
        df = QUERIES[k](spark, f"/root/testdata/sf{sf}")
        df._jdf.queryExecution().toRdd().count()  # runs the plan that is printed
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln if len(ln) <= WIDTH else ln[:WIDTH] + " ..." for ln in plan.splitlines()]
        out += [f"\n## `{k}`\n", "```", *lines, "```"]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
