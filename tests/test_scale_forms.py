"""Mergeable, committed, monthly, counted, bucketed and incremental forms."""

import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from dayflow.operators import bitmaps, incremental
from dayflow.operators.flows import active_days
from dayflow.operators.lags import lag_features
from dayflow.plans import scale_queries as q
from dayflow.sources import committed, counted, models, monthly
from dayflow.sources.counted import Field

from conftest import SF001

D = dt.date


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- bitmaps ---------------------------------------------------------------------
def test_masks_and_bitmaps_merge_without_the_first_month(spark, tmp_path):
    rows = [(u, D(2024, m, d)) for u in (1, 2, 40_000, None) for m in (1, 2) for d in (1, 31, 31, 15)
            if (m, d) != (2, 31) and (u, m) != (2, 2)] + [(7, None)]
    facts = spark.createDataFrame(rows, "u long, d date")
    jan, feb = (facts.filter(F.month("d") == m) for m in (1, 2))
    for n, f in (("jan", jan), ("feb", feb)):
        bitmaps.day_masks(f, "u", "d").write.parquet(f"{tmp_path}/masks/{n}")
        bitmaps.entity_bitmaps(f, "u").write.parquet(f"{tmp_path}/users/{n}")
    masks = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/masks")
    want = facts.groupBy("u").agg(F.countDistinct("d").alias("active_days")).filter("active_days > 0")
    assert _rows(bitmaps.distinct_days(masks, "u")) == _rows(want)
    assert _rows(bitmaps.distinct_days(masks, "u", 3)) == _rows(active_days(
        facts.filter("d is not null"), "u", "d", 3))
    users = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/users")
    assert bitmaps.distinct_entities(users).first()[0] == 3
    # a batch given twice changes nothing
    assert _rows(bitmaps.distinct_days(masks.union(masks), "u")) == _rows(want)
    assert bitmaps.distinct_days(bitmaps.day_masks(facts.limit(0), "u", "d"), "u").count() == 0
    assert bitmaps.distinct_entities(users.limit(0)).first()[0] == 0
    # nothing but the stored state is read, and masks are partially aggregated
    assert "bit_or" in _plan(masks.groupBy("u").agg(F.bit_or("mask")))


# --- committed output -------------------------------------------------------------
def test_a_writer_ended_midway_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    one, two = spark.range(5), spark.range(7)
    with pytest.raises(FileNotFoundError):
        committed.read_committed(spark, root)
    m = committed.commit(one, root, spec="a")
    assert (m["rows"], m["number"]) == (5, 1) and m["schema"] == one.schema.json()
    with pytest.raises(FileExistsError):
        committed.commit(two, root)

    def fail(_):
        raise RuntimeError("lost")
    broken = two.rdd.map(fail).toDF("id long")
    with pytest.raises(Exception, match="lost"):
        committed.commit(broken, root, mode="overwrite")
    two.write.parquet(committed.new_version(root))          # written, never published
    with open(f"{root}/_manifests/0000000002.json", "w") as fh:     # cut off midway
        fh.write('{"path": "x", "rows')
    assert committed.read_committed(spark, root, spec="a").count() == 5
    assert committed.commit(two, root, mode="overwrite")["number"] == 3
    assert committed.read_committed(spark, root).count() == 7
    assert committed.read_committed(spark, root, number=1).count() == 5
    with pytest.raises(ValueError, match="specification"):
        committed.read_committed(spark, root, spec="a")
    assert len(committed.vacuum(spark, root)) >= 2
    assert committed.read_committed(spark, root).count() == 7
    part = next(f for f in os.listdir(committed.manifest(spark, root)["path"])
                if f.startswith("part"))
    os.remove(os.path.join(committed.manifest(spark, root)["path"], part))
    with pytest.raises(OSError, match="missing"):
        committed.read_committed(spark, root)


def test_csv_and_partitions_are_committed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2), (2, "b", 3)], "x int, s string, p int")
    root = str(tmp_path / "c")
    committed.commit(df, root, fmt="csv", options={"header": "true"})
    assert _rows(committed.read_committed(spark, root)) == _rows(df)
    committed.commit(df, root, mode="overwrite", partition_by=["p"])
    assert _rows(committed.read_committed(spark, root)) == _rows(df)


def test_a_half_written_model_set_does_not_load(spark, tmp_path):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import LinearRegression, LinearRegressionModel
    df = spark.createDataFrame([(Vectors.dense([float(i), i % 3.0]), 2.0 * i + 1, -1.0 * i)
                                for i in range(12)], ["features", "p", "r"])
    fits = {t: LinearRegression(labelCol=t).fit(df) for t in ("p", "r")}
    root = str(tmp_path / "m")
    half = committed.new_version(root)
    fits["p"].write().save(models.model_path(half, "p"))
    with pytest.raises(FileNotFoundError, match="published"):
        models.load_models(root, ["p"])
    models.save_models(fits, root, terms=["a", "b"])
    assert isinstance(models.load_models(root, ["p", "r"])["r"], LinearRegressionModel)
    got = {(r.target, r.term): r.value for r in models.load_coefficients(spark, root).collect()}
    assert got[("p", "a")] == fits["p"].coefficients[0] and len(got) == 6
    with pytest.raises(FileExistsError):
        models.save_models(fits, root, overwrite=False)
    fits["p"].write().save(models.model_path(committed.new_version(root), "p"))
    assert set(models.load_models(root, ["p", "r"])) == {"p", "r"}


# --- partial rewrite ----------------------------------------------------------------
def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f), "rb").read()
            for d, _, names in os.walk(path) for f in names if f.startswith("part")}


def test_a_forecast_rewrites_at_most_three_months(spark, tmp_path):
    path = str(tmp_path / "matrix")
    days = [D(2014, 1, 1) + dt.timedelta(days=i) for i in range(300)]
    monthly.write_monthly(spark.createDataFrame(
        [(k, d, float(k)) for k in (1, 2) for d in days], "k int, d date, v double"), path, "d")
    before = _files(path)
    ahead = [D(2014, 8, 31) + dt.timedelta(days=i) for i in range(30)] + [D(2015, 1, 1)]
    new = spark.createDataFrame([(k, d, -1.0) for k in (1, 2) for d in ahead],
                                "k int, d date, v double")
    assert monthly.upsert_monthly(spark, path, new, ["k", "d"], ["v"], "d") == [201408, 201409, 201501]
    after = _files(path)
    changed = {n.split("/")[0] for n in before if after.get(n) != before[n]}
    assert changed == {"month=201408", "month=201409"}
    assert {n.split("/")[0] for n in after if n not in before} == changed | {"month=201501"}
    got = {(r.k, r.d): r.v for r in monthly.read_monthly(spark, path).collect()}
    want = {(k, d): -1.0 if d in ahead else float(k) for k in (1, 2) for d in {*days, *ahead}}
    assert got == want
    with pytest.raises(Exception, match="more than one row"):
        monthly.upsert_monthly(spark, path, new.union(new), ["k", "d"], ["v"], "d")
    assert monthly.upsert_monthly(spark, path, new.limit(0), ["k", "d"], ["v"], "d") == []
    assert "PartitionFilters: [isnotnull(month" in _plan(monthly.read_monthly(spark, path, [201408]))


# --- counted scan --------------------------------------------------------------------
def test_bad_rows_are_counted_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as fh:
        fh.write("id,amt,name\n1,5,a\n2,x,b\n3,,c\n4\n5,6,d,e\n99999999999999999999,7,\n")
    fields = {"id": Field("bigint", r"^\d+$", 0), "amt": Field("int", r"^\d+$", -1), "name": Field()}
    rows, seen = counted.read_csv_counted(spark, path, fields)
    assert _plan(rows).count("FileScan") == 1
    assert _rows(rows) == [(0, 7, None), (1, 5, "a"), (2, -1, "b"), (3, -1, "c")]
    assert [tuple(r) for r in counted.counts_frame(spark, seen, fields).collect()] == [
        ("id", 6, 3, 1, 2), ("amt", 6, 2, 2, 2), ("name", 6, 3, 1, 2)]
    kept, _ = counted.read_csv_counted(spark, path, fields, keep_rejected=True)
    assert sorted(r[counted.CORRUPT] for r in kept.collect() if r[counted.CORRUPT]) == \
        ["4", "5,6,d,e"]


# --- bucketed tables -----------------------------------------------------------------
def test_bucketed_flow_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = q.bucketed_flow(*q.bucketed_inputs(spark, SF001))
        plan = _plan(out)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        from dayflow.plans.all import QUERIES
        plain = QUERIES["user_month_flow"](spark, SF001)
        assert "Exchange" in _plan(plain) and _rows(out) == _rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- incremental days ----------------------------------------------------------------
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_adding_days_equals_a_full_rebuild(spark, tmp_path, keys):
    first = D(2014, 1, 1)
    facts = [(k, first + dt.timedelta(days=i), decimal.Decimal(i + k), i % 5)
             for k in (1, 2) for i in range(100) for _ in range(2) if i % 13]
    df = spark.createDataFrame(facts, "k int, d date, v decimal(18,2), part int")
    late = (F.col("d") >= D(2014, 4, 5)) | ((F.col("d") == D(2014, 3, 30)) & (F.col("part") > 1))
    totals, lags = str(tmp_path / "totals"), str(tmp_path / "lags")

    def add(batch):
        days = incremental.add_facts(spark, totals, batch, "d", {"v": "v"}, keys)
        return days, incremental.refresh_lags(spark, totals, lags, "d", ["v"], days, keys, (1, 14))
    add(df.filter(~late))
    old = _files(totals) | _files(lags)
    days, months = add(df.filter(late))
    assert min(days) >= D(2014, 3, 30) and months == [201403, 201404]
    new = _files(totals) | _files(lags)
    kept = {n.split("/")[0] for n in old if new.get(n) == old[n]}
    assert {"month=201401", "month=201402"} <= kept
    want = df.groupBy(*keys, "d").agg(F.sum("v").cast("decimal(38,2)").alias("v"))
    assert _rows(spark.read.parquet(totals).drop("month").select(*want.columns)) == _rows(want)
    made = lag_features(want, keys, "d", ["v"], (1, 14))
    assert _rows(spark.read.parquet(lags).select(*made.columns)) == _rows(made)
    assert add(df.limit(0)) == ([], [])


def test_only_touched_months_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(D(2014, m, 1), 1.0) for m in range(1, 13)], "d date, v double")
    monthly.write_monthly(df, path, "d")
    got = monthly.read_monthly(spark, path, [201403, 201404])
    assert "PartitionFilters: [month" in _plan(got) and "month=2014" not in _plan(got)
    assert {r.f.split("/month=")[1][:6] for r in got.select(F.input_file_name().alias("f")).collect()
            } == {"201403", "201404"}
