import datetime as dt

import pytest

from dayflow.operators import model
from dayflow.plans import jobs

D = dt.date


def test_forecast_job_fills_lag_cells(spark, tmp_path):
    rows = []
    for k in (1, 2):
        for i in range(50):
            d = D(2014, 7, 1) + dt.timedelta(days=i)
            rows.append((k, d, 100.0 + 2 * i * k + (i % 7), 40.0 + i + (i % 3)))
    p = spark.createDataFrame(rows, "k int, d date, p double, r double")
    spec = model.FeatureSpec(targets=("p", "r"), lag_measures=("p", "r"), lags=(1, 2, 7))
    models, metrics = jobs.train_job(p, ["k"], "d", spec, model.SLIM_PARAMS,
                                     str(tmp_path / "m"), split_k=5)
    assert {r["target"] for r in metrics.collect()} == {"p", "r"}
    fc, matrix = jobs.forecast_job(p, ["k"], "d", spec, str(tmp_path / "m"), 10)
    f = {(r["k"], r["d"]): r for r in fc.collect()}
    obs = {(r["k"], r["d"]): r for r in p.collect()}
    m = {(r["k"], r["d"]): r for r in matrix.collect()}
    last = D(2014, 7, 1) + dt.timedelta(days=49)
    for k in (1, 2):
        for h in range(1, 11):
            d = last + dt.timedelta(days=h)
            row = m[(k, d)]
            assert row["p"] == pytest.approx(f[(k, d)]["p"])
            for lag in (1, 2, 7):
                src = d - dt.timedelta(days=lag)
                want = f[(k, src)]["p"] if src > last else obs[(k, src)]["p"]
                assert row[f"p_{lag}"] == pytest.approx(want)
    sub = jobs.submission(fc, ["k"], "d", {"purchase": "p"}).collect()
    assert len(sub) == 20 and sub[0]["d"].isdigit()


def test_submission_floor(spark):
    fc = spark.createDataFrame([(1, D(2014, 9, 1), -5.7, 3.9)], "k int, d date, p double, r double")
    r = jobs.submission(fc, ["k"], "d", {"purchase": "p", "redeem": "r"}).first()
    assert (r["d"], r["purchase"], r["redeem"]) == ("20140901", -5, 3)
    r = jobs.submission(fc, ["k"], "d", {"purchase": "p"}, floor=0).first()
    assert r["purchase"] == 0


def test_single_global_series_end_to_end(spark, tmp_path):
    """keys=[]: the reference's one global daily series, through every step."""
    import datetime as _dt
    from pyspark.sql import functions as F
    from dayflow.functions.calendar import HOLIDAYS_2013_2014
    from dayflow.operators import flows, panel

    facts = []
    for i in range(120):
        d = _dt.date(2014, 3, 1) + _dt.timedelta(days=i)
        if i % 9 == 4:
            continue                                    # a few days without rows
        facts += [(u, d, 100 + (i * u) % 37, 50 + (i + u) % 11) for u in (1, 2, 3)]
    bal = spark.createDataFrame(facts, "user_id int, report_date date, p int, r int")
    daily = flows.daily_totals(bal, "report_date", {"p": "p", "r": "r"})
    rates = spark.createDataFrame(
        [(_dt.date(2014, 3, 1) + _dt.timedelta(days=i), 3.0 + i / 100) for i in range(120)
         if (_dt.date(2014, 3, 1) + _dt.timedelta(days=i)).isoweekday() <= 5],
        "report_date date, rate double")
    dense = panel.dense_panel(daily, [], "report_date", panel.day_range(daily, "report_date"),
                              {"p": 0, "r": 0})
    dense = panel.forward_fill(panel.join_daily_series(dense, [rates], "report_date"), [],
                               "report_date", ["rate"])
    assert dense.count() == 120 and dense.filter(F.col("rate").isNull()).count() <= 2
    spec = model.FeatureSpec(targets=("p", "r", "rate"), lag_measures=("p", "r", "rate"),
                             holidays=HOLIDAYS_2013_2014)
    models, metrics = jobs.train_job(dense, [], "report_date", spec, model.SLIM_PARAMS,
                                     str(tmp_path / "g"))
    assert metrics.count() == 3
    fc, filled = jobs.forecast_job(dense, [], "report_date", spec, str(tmp_path / "g"), 30)
    rows = fc.orderBy("report_date").collect()
    assert len(rows) == 30 and rows[0]["report_date"] == _dt.date(2014, 6, 29)
    assert all(r["p"] is not None for r in rows)
    assert filled.count() == 150
    sub = jobs.submission(fc, [], "report_date", {"purchase": "p", "redeem": "r"}).collect()
    assert sub[0]["report_date"].startswith("2014") and len(sub) == 30


def test_submission_date_window(spark):
    rows = [(1, D(2014, 8, 31) + dt.timedelta(days=i), float(i), 1.0) for i in range(5)]
    fc = spark.createDataFrame(rows, "k int, d date, p double, r double")
    out = jobs.submission(fc, ["k"], "d", {"purchase": "p"}, first=D(2014, 9, 1),
                          last=D(2014, 9, 3)).collect()
    assert sorted(r["d"] for r in out) == ["20140901", "20140902", "20140903"]


def test_forecasts_of_ragged_series_are_kept(spark, tmp_path):
    rows = []
    for k, n in ((1, 60), (2, 50)):
        rows += [(k, D(2014, 6, 1) + dt.timedelta(days=i), 100.0 + 3 * i + i % 5, 9.0 + i % 4)
                 for i in range(n)]
    p = spark.createDataFrame(rows, "k int, d date, p double, r double")
    spec = model.FeatureSpec(targets=("p", "r"), lag_measures=("p", "r"), lags=(1, 2), calendar=())
    jobs.train_job(p, ["k"], "d", spec, model.SLIM_PARAMS, str(tmp_path / "m"))
    fc, matrix = jobs.forecast_job(p, ["k"], "d", spec, str(tmp_path / "m"), 5)
    assert fc.count() == 10
    m = {(r["k"], r["d"]): r["p"] for r in matrix.collect()}
    f = {(r["k"], r["d"]): r["p"] for r in fc.collect()}
    assert len(m) == 120 and all(m[key] == v and v is not None for key, v in f.items())
    assert min(d for k, d in f if k == 2) == D(2014, 7, 21)


def test_training_window_and_split_choice(spark, tmp_path):
    rows = [(1, D(2014, 1, 1) + dt.timedelta(days=i), float(i % 9 + i)) for i in range(80)]
    p = spark.createDataFrame(rows, "k int, d date, p double")
    spec = model.FeatureSpec(targets=("p",), lag_measures=("p",), lags=(1, 14), calendar=())
    _, metrics = jobs.train_job(p, ["k"], "d", spec, model.SLIM_PARAMS, str(tmp_path / "w"),
                                split=lambda df: model.split_time(df, "d", 7),
                                first=D(2014, 1, 15), last=D(2014, 2, 28))
    assert metrics.first()["n"] == 7


def test_raw_tables_to_submission(spark, tmp_path):
    """The FIXTURES tables as CSV: panel job, training window, forecast, submission."""
    import csv
    from pyspark.sql import functions as F
    from dayflow.functions.calendar import (
        HOLIDAYS_2013_2014, WEEKEND_REFERENCE, WORKDAY_OVERRIDES_2014,
    )
    from dayflow.functions.clean import parse_amount, parse_yyyymmdd
    from dayflow.sources.files import read_csv, string_schema, write_csv
    measures = ["total_purchase_amt", "total_redeem_amt", "category1"]
    days = [D(2014, 3, 1) + dt.timedelta(days=i) for i in range(150)]

    def save(name, head, rows):
        with open(tmp_path / name, "w", newline="") as f:
            csv.writer(f).writerows([head, *rows])
        return read_csv(spark, str(tmp_path / name), string_schema(head))

    balance = save("balance.csv", ["user_id", "report_date", "tBalance", *measures],
                   [(u, f"{d:%Y%m%d}", 5, 100 + i * u % 37, 50 + (i + u) % 11, "" if i % 3 else 4)
                    for i, d in enumerate(days) for u in (1, 2, 3)])
    profile = save("profile.csv", ["user_id", "sex", "city"], [(1, 1, 9), (2, 0, 9)])
    rates = save("rates.csv", ["mfd_date", "Interest_O_N"],
                 [(f"{d:%Y%m%d}", 2 + i / 1000) for i, d in enumerate(days) if d.isoweekday() < 6])
    facts = balance.select("user_id", parse_yyyymmdd("report_date").alias("report_date"),
                           *[parse_amount(m).alias(m) for m in measures])
    people = profile.select("user_id", parse_amount("sex", to="int", default=None).alias("sex"))
    series = rates.select(parse_yyyymmdd("mfd_date").alias("report_date"),
                          F.col("Interest_O_N").cast("double").alias("rate"))
    day = jobs.panel_job(facts, people, "user_id", "report_date", measures, "sex",
                         {"male": 1, "female": 0, "unknown": 2}, [series], ("male", "female"))
    assert day.count() == 150
    r = day.filter("report_date = '2014-03-02'").first()
    assert (r.male, r.female, r.unknown, r.segment_ratio) == (1, 1, 1, 1.0)
    assert int(r.total_purchase_amt) == sum(100 + u % 37 for u in (1, 2, 3))
    longer = jobs.panel_job(facts, people, "user_id", "report_date", measures, "sex", {"male": 1},
                            [series], last=D(2014, 8, 10))
    tail = longer.filter("report_date > '2014-07-28'").collect()
    assert len(tail) == 13 and all(x.rate is not None and x.male is None for x in tail)
    targets = ("total_purchase_amt", "total_redeem_amt", "rate")
    spec = model.FeatureSpec(targets=targets, lag_measures=targets, holidays=HOLIDAYS_2013_2014,
                             weekend_days=WEEKEND_REFERENCE,
                             workday_overrides=WORKDAY_OVERRIDES_2014,
                             trend="trend_unix_timestamp")
    jobs.train_job(day, [], "report_date", spec, model.SLIM_PARAMS, str(tmp_path / "models"),
                   first=D(2014, 3, 16), last=D(2014, 7, 28))
    fc, filled = jobs.forecast_job(day, [], "report_date", spec, str(tmp_path / "models"), 30)
    sub = jobs.submission(fc, [], "report_date", {"purchase": "total_purchase_amt",
                                                  "redeem": "total_redeem_amt"})
    out = write_csv(sub, str(tmp_path / "submission"), header=False, single_file=True)
    back = read_csv(spark, out, "report_date string, purchase bigint, redeem bigint", header=False)
    assert back.count() == 30 and back.agg(F.min("report_date")).first()[0] == "20140729"
    assert filled.count() == 180 and back.filter("purchase is null").count() == 0


@pytest.mark.parametrize("keys", [["k"], []])
def test_changed_matrix_and_submission_fail_their_certificates(spark, tmp_path, keys):
    from pyspark.sql import functions as F
    from dayflow.operators import certificates

    rows = [(k, D(2014, 7, 1) + dt.timedelta(days=i), 100.0 + 2 * i * (k + 1) + (i % 7), 40.0 + i % 3)
            for k in (range(2) if keys else [0]) for i in range(40)
            if (k, i) != (0, 20)]                       # a gap: later rows have null cells
    p = spark.createDataFrame(rows, "k int, d date, p double, r double").select(*keys, "d", "p", "r")
    spec = model.FeatureSpec(targets=("p", "r"), lag_measures=("p", "r"), lags=(1, 2, 7),
                             calendar=())
    jobs.train_job(p, keys, "d", spec, model.SLIM_PARAMS, str(tmp_path / "m"))
    fc, matrix = jobs.forecast_job(p, keys, "d", spec, str(tmp_path / "m"), 5)
    n = 2 if keys else 1
    first = fc.groupBy(*keys).agg(F.min("d").alias("first"))

    def lags(m, **kw):
        out = certificates.certify_lags(m, keys, "d", spec.targets, spec.lags, **kw).collect()
        return {r.target: (r.n_cells, r.n_cells_hold) for r in out}

    whole = n * 5 * 3
    assert lags(matrix, first=first) == {"p": (whole, whole), "r": (whole, whole)}
    every = (len(rows) + n * 5) * 3
    assert lags(matrix) == {"p": (every, every), "r": (every, every)}
    day = D(2014, 8, 11)                                 # second day of the horizon
    at = (F.col("d") == F.lit(day)) & (F.col("k") == 0 if keys else F.lit(True))
    off = matrix.withColumn("p_2", F.when(at, F.col("p_2") + 1).otherwise(F.col("p_2")))
    assert lags(off, first=first) == {"p": (whole, whole - 1), "r": (whole, whole)}
    none = matrix.withColumn("r_7", F.when(at, F.lit(None)).otherwise(F.col("r_7")))
    assert lags(none, first=first) == {"p": (whole, whole), "r": (whole, whole - 1)}
    # a changed cell is missed by the lag cells of one and two days later that read it
    moved = matrix.withColumn("p", F.when(at, F.col("p") + 1).otherwise(F.col("p")))
    assert lags(moved, first=first)["p"] == (whole, whole - 2)
    assert lags(matrix.limit(0), first=first) == {}

    columns = {"purchase": "p", "redeem": "r"}
    sub = jobs.submission(fc, keys, "d", columns)

    def sent(s):
        out = certificates.certify_submission(s, fc, keys, "d", columns).collect()
        return {r.target: (r.n_submitted, r.n_submitted_hold) for r in out}

    m = n * 5
    assert sent(sub) == {"p": (m, m), "r": (m, m)}
    here = (F.col("d") == "20140811") & (F.col("k") == 0 if keys else F.lit(True))
    assert sent(sub.withColumn("redeem", F.when(here, F.col("redeem") + 1).otherwise(
        F.col("redeem")))) == {"p": (m, m), "r": (m, m - 1)}
    assert sent(sub.filter(~here)) == {"p": (m - 1, m - 1), "r": (m - 1, m - 1)}
    assert sent(sub.unionByName(sub.filter(here))) == {"p": (m + 1, m), "r": (m + 1, m)}
    assert sent(sub.withColumn("d", F.when(here, "20150101").otherwise(F.col("d")))) == {
        "p": (m, m - 1), "r": (m, m - 1)}
