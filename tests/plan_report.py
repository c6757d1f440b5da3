"""Print ``explain("formatted")`` for registered queries (not a test).

Usage:  python tests/plan_report.py [sf_dir] [query ...]
Shows the scans' ReadSchema / PushedFilters, the exchanges and the
whole-stage-codegen spans of each plan.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tabprep.session import local_session  # noqa: E402

DEFAULT = ["split_stratified", "preprocess_full", "oversample_random", "classification_report",
           "synth_independent", "synth_quality"]


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or DEFAULT
    spark = local_session(8)
    q = E.queries()
    for name in names:
        print("=" * 30, name, "=" * 30)
        q[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
