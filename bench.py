"""Benchmark: run every registered query over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect to the
driver).  Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _event_metrics(event_dir: str) -> dict:
    """Per job group (= query): shuffle bytes written and input bytes read,
    summed over its tasks, from the Spark event log."""
    stage_group, shuffle, read = {}, defaultdict(int), defaultdict(int)
    for path in glob.glob(os.path.join(event_dir, "*")):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if group:
                        shuffle[group] += (m.get("Shuffle Write Metrics") or {}).get(
                            "Shuffle Bytes Written", 0)
                        read[group] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
    return {g: {"shuffle_mb": round(shuffle[g] / 2**20, 3), "input_mb": round(read[g] / 2**20, 3)}
            for g in set(shuffle) | set(read)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if not a.startswith("-")]

    from dayflow.plans.all import QUERIES
    from dayflow.plans import model_queries
    from dayflow.operators import model
    from dayflow.session import local_session

    event_dir = tempfile.mkdtemp(prefix="dayflow-bench-events-")
    eventlog = os.environ.get("BENCH_EVENTLOG", "1") != "0"
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
             "spark.eventLog.compress": "false",
             "spark.eventLog.rolling.enabled": "false"} if eventlog else {}
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app_name="dayflow-bench",
                          extra=extra)
    names = only or list(QUERIES)

    # warm-up (JIT, file listing cache): not counted
    QUERIES["daily_flow"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)

    # model fitting throughput, comparable to the reference's per-model save gaps
    spark.sparkContext.setJobGroup("model_fits", "model_fits")
    fit = {}
    # slim: 4 ridge models of 61 features; wide: 26 unpenalised models of 371 features
    for cfg, spec, keys, frame in (
            ("slim", model_queries.SPEC, model_queries.KEYS, model_queries.model_panel),
            ("wide", model_queries.WIDE_SPEC, [], model_queries.wide_panel)):
        data = model_queries.assembled_features(spark, sf_dir, frame(spark, sf_dir), spec, keys)
        train = data.filter("split = 'train'")
        t0 = time.perf_counter()
        model.fit_targets(train, spec, model_queries.CONFIGS[cfg], parallelism=8)
        fit[cfg] = round((time.perf_counter() - t0) / len(spec.targets), 3)

    spark.stop()
    try:
        data_moved = _event_metrics(event_dir)
    except Exception as e:  # the timings stand without the event-log summary
        print(f"# event log not summarised: {e}", file=sys.stderr)
        data_moved = {}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "model_fit_sec_per_target": fit,
        # wide 371 features median 63.0 s per model, slim 61 features ~21 s
        "reference_model_sec_per_target": {"wide": 63.0, "slim": 21.0},
        "n_features": {"slim": len(model_queries.SPEC.feature_names()),
                       "wide": len(model_queries.WIDE_SPEC.feature_names())},
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": int(cpus),
        "data_moved": {n: data_moved.get(n, {}) for n in names},
        "n_queries": len(names),
    }))


if __name__ == "__main__":
    main()
