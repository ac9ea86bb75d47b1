"""Write the physical plan tree of every registered query to PLANS.md.

    python scripts/dump_plans.py [--sf-dir DIR]

For streaming queries the plan is that of the landed result; the streaming
plan itself ran when the query function was called.
"""

from __future__ import annotations

import argparse
import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default="PLANS.md")
    a = ap.parse_args()

    from rivulet.plans import registry
    from rivulet.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=16)
    qs = registry.queries()
    parts = ["# Physical plans\n",
             f"Generated by `scripts/dump_plans.py` on `{a.sf_dir}` (local[8], AQE on; "
             "the final adaptive plan may differ, e.g. a shuffle join turned into a "
             "broadcast join after the size check).\n"]
    for name in sorted(qs):
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, a.sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0].strip()
        details = [ln for ln in text.splitlines()
                   if ln.startswith(("PushedFilters", "ReadSchema"))]
        parts.append(f"\n## {name}\n\n```\n{tree}\n" + "\n".join(details) + "\n```\n")
    with open(a.out, "w") as f:
        f.write("".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
