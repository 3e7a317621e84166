"""Compare every registered query with its oracle SQL (default sf0.01).

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from dayflow.plans.all import ORACLE, QUERIES  # noqa: E402
from compare import compare  # noqa: E402
from dayflow.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")] or list(QUERIES)
    spark = local_session(8)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = QUERIES[n](spark, sf_dir)
            if n in ORACLE:
                ok, msg = compare(df, ORACLE[n], sf_dir)
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
