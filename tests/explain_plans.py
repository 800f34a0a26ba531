"""Print the formatted physical plan of registered queries.

    python tests/explain_plans.py /root/testdata/sf0.1 first_contact_master access_shares
    python tests/explain_plans.py /root/testdata/sf0.1 --final build_master   # AQE plan after running

With ``--final`` the query is run first and the adaptive plan as executed
(broadcast conversions, skew splits, coalesced reads) is printed.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    from __spark_entry__ import queries
    from fieldbook.session import get_session

    args = argv[1:]
    final = "--final" in args
    args = [a for a in args if a != "--final"]
    sf_dir, names = args[0], args[1:] or ["first_contact_master"]
    spark = get_session("local[8]", 8)
    qs = queries()
    for name in names:
        df = qs[name](spark, sf_dir)
        print(f"===== {name}")
        if final:
            df.collect()
            print(df._jdf.queryExecution().executedPlan().toString())
        else:
            df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
