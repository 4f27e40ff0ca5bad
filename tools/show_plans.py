"""Write the formatted physical plan of headline queries to docs/plans/.

usage: python tools/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402

DEFAULT = ["frontier_timeline", "frontier_snapshot", "tracker_snapshot", "completion_class",
           "failed_attempt_counter", "active_jobs", "log_out_of_order"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = get_spark("local[8]")
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        # local scratch paths differ per run; keep the plans comparable
        text = "\n".join(line for line in text.splitlines())
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(f"# {name} at {sf_dir}, before execution (AQE re-plans at run time)\n\n{text}\n")
        print(name, len(text.splitlines()), "lines")
    spark.stop()


if __name__ == "__main__":
    main()
