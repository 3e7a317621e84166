"""Render PLANS.md from `python tools/plan_audit.py > audit.txt`.

usage: python tools/plans_md.py audit.txt > PLANS.md
"""

import re
import sys

NOTES = {
    "segment_counts": "join first (orders cross the network once; AQE splits a hot "
                      "customer), then partial counts per day before the small day shuffle",
    "segment_ratio": "as segment_counts",
    "fillna_measures": "spine generated after the user shuffle (dense_panel); SinglePartition "
                       "= final step of the day-range scalar subquery",
    "forward_fill": "the same user shuffle feeds the panel aggregate and the window",
    "exog_join_ffill": "orders joined to customers once, (nation, day) sums partial before "
                       "their shuffle; lineitem scanned once for both series, broadcast (one "
                       "row per day); the window reuses the (nation) partitioning",
    "lag_features": "14 lags x 2 measures: one Window, one sort, no join",
    "lag_self_join": "cross-check of lag_features: one pass emits base + shifted copies, "
                     "one group-by (no joins); the other exchange builds its input panel; "
                     "the literal 14-join chain is method='join'",
    "avg_balance_by_city": "orders of the day counted per customer before the join; range "
                           "partitioning is the presentation sort",
    "sql_avg_balance_by_city": "SQL text, same plan shape as avg_balance_by_city",
    "user_month_flow": "orders summed per user before the customer join",
    "topk_per_group": "partial WindowGroupLimit before the city shuffle",
    "sql_topk_per_group": "SQL text; parameters pushed to the scan; partial WindowGroupLimit",
    "score": "fit as a window aggregate over the series partition: no join back",
    "rollout_ar": "fit, last day and last value in one aggregate; rollout is one SQL "
                  "expression",
    "point_overwrite": "panel materialised once, reused by history, horizon and rollout",
    "rollout_var": "SQL higher-order rollout over a materialised panel: no Python",
    "ols_multi": "written feature arrays, one scan for the statistics of all targets and both "
                 "configurations, one more a configuration for its certificate",
    "ols_wide": "26 targets fitted from one scan of the written feature arrays",
    "split_time": "reads the materialised (nation, day) table",
}


def main(path):
    lines = open(path).read().splitlines()
    out = ["# Physical plans", "",
           "Executed plans of every registered query at sf0.1 with automatic broadcast",
           "disabled (`spark.sql.autoBroadcastJoinThreshold=-1`, adaptive too), so that",
           "joins plan as they would on tables too large to broadcast. Only explicit",
           "broadcasts of bounded frames (one row per day) remain. Produced by",
           "`python tools/plan_audit.py`. `shuffles` counts Exchange operators in the",
           "final adaptive plan. A materialised input (`session.materialize`) shows as",
           "a single Parquet scan, and the work that built it ran before the query.",
           "",
           "| query | scans | shuffles | joins | windows | python | exchanges | notes |",
           "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    pat = re.compile(r"(\S+)\s+shuffles=\s*(\d+) joins=(\[.*?\]) windows=(\d+) "
                     r"python=(\[.*?\]) scans=(\d+)")
    for i, line in enumerate(lines):
        m = pat.match(line)
        if not m:
            continue
        name, sh, joins, win, py, scans = m.groups()
        ex = lines[i + 1].strip() if i + 1 < len(lines) else ""
        ex = re.sub(r", \d+\)", ")", ex) or "-"
        j = eval(joins)
        jt = ", ".join(sorted({f"{x} x{j.count(x)}" if j.count(x) > 1 else x
                               for x in j})) or "-"
        out.append(f"| `{name}` | {scans} | {sh} | {jt} | {win} | {'yes' if eval(py) else '-'} | "
                   f"{ex} | {NOTES.get(name, '')} |")
    out += ["", "Notes that apply throughout:", "",
            "- `SinglePartition` exchanges only feed the final step of a keyless",
            "  aggregate: the day-range scalar subquery or a global count. Each map task",
            "  sends one partial row.",
            "- Every hash aggregate runs partial-then-final, so a key holding a third of",
            "  the rows leaves each map task as one row.",
            "- Windows partition by series keys. Their inputs have at most one row per",
            "  (series, day), so a window partition is bounded by the number of days.",
            ""]
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1])
