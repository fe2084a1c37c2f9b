"""Run the whole study on the test tables and write every report table.

Usage: python scripts/run_study.py SF_DIR OUTPUT_FOLDER
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.plans import queries as Q  # noqa: E402
from panelkit.plans.study import Protocol, run_study  # noqa: E402
from panelkit.session import local_session  # noqa: E402


def main() -> None:
    if len(sys.argv) < 3:
        sys.exit("usage: run_study.py SF_DIR OUTPUT_FOLDER (a folder that all executors share)")
    sf_dir, out = sys.argv[1:3]
    spark = local_session(app="panelkit-study")
    t0 = time.time()
    written = run_study(Q.raw_store(spark, sf_dir), out,
                        Protocol(train=Q.years(last=1999), validate=Q.years(2000, 2000), develop=Q.years(last=2000), test=Q.years(2001, 2001)))
    print(f"{len(written)} tables in {time.time() - t0:.1f}s under {out}")
    spark.stop()


if __name__ == "__main__":
    main()
