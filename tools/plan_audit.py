"""Summarise the executed physical plan of every query: shuffles, joins,
windows, Python operators.  usage: python tools/plan_audit.py [sf_dir] [name ...]"""

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from dayflow.plans.all import QUERIES  # noqa: E402
from dayflow.session import local_session  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in argv if not a.startswith("/")] or list(QUERIES)
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        p = df._jdf.queryExecution().executedPlan().toString()
        ex = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|RoundRobin\w*|rangepartitioning\([^)]*\))", p)
        ex = [re.sub(r"#\d+L?", "", e) for e in ex]
        joins = re.findall(r"(\w+Join) ", p)
        wins = len(re.findall(r"Window \[", p))
        py = re.findall(r"(FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython|MapInPandas)", p)
        scans = len(re.findall(r"FileScan|Scan ExistingRDD|Scan csv", p))
        print(f"{n:26s} shuffles={len(ex):2d} joins={joins} windows={wins} python={py} scans={scans}")
        print("    " + "; ".join(ex))


if __name__ == "__main__":
    main(sys.argv[1:])
