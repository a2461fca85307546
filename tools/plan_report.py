"""Write PLANS.md: the physical plan of every registered engine query
(the training-data queries run in several steps and have no single plan).

Usage: python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.queries import QUERIES  # noqa: E402
from tidewater.session import build_session  # noqa: E402


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session(master="local[8]", shuffle_partitions=16)
    parts = [f"# Physical plans\n\nGenerated by `tools/plan_report.py` on `{base}` "
             "(local[8], 16 shuffle partitions, AQE on; the final AQE plan may coalesce "
             "partitions or switch join strategies at run time).\n"]
    for name, q in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q(spark, base).explain("simple")
        lines = [ln[:220] for ln in buf.getvalue().splitlines() if ln.strip()]
        parts.append(f"## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    spark.stop()
    with open(out, "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main()
