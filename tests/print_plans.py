"""Write the physical plan trees of the headline queries (explain "formatted",
tree part only) as markdown. Usage: python tests/print_plans.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = (
    "fact_transactions",
    "gold_charge_by_provider_dept",
    "gold_patient_history",
    "gold_provider_performance",
    "gold_department_performance",
    "gold_financial_metrics",
)


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n(1)")[0].strip()


def main(argv):
    from tallyward.plans.queries import all_queries
    from tallyward.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    qs = all_queries()
    print(f"# Physical plans ({os.path.basename(sf_dir)}, before adaptive re-planning)\n")
    for name in NAMES:
        print(f"## {name}\n\n```\n{tree(qs[name](spark, sf_dir))}\n```\n")


if __name__ == "__main__":
    main(sys.argv)
