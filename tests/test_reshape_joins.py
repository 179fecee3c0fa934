import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from paneljet.operators import agg, joins, reshape, windows
from paneljet.operators.util import ValidationError
from paneljet.sources import io
from conftest import rows


def d(y, m, day=1):
    return dt.date(y, m, day)


def test_melt_keeps_nulls_and_stack_drop(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "id int, a double, b double")
    assert reshape.melt(df, ["id"], ["a", "b"]).count() == 2
    assert reshape.melt(df, ["id"], ["a", "b"], drop_null=True).count() == 1
    st = reshape.stack_levels(df, ["id"], {"a": ("x", "u1"), "b": ("x", "u2")}, drop_null=True)
    assert rows(st, "level0", "level1", "value") == [("x", "u1", 1.0)]


def test_pivots_create_absent_columns(spark):
    df = spark.createDataFrame([("k", "A", 1), ("k", "B", 2), ("k", "B", 3)], "k string, c string, v int")
    p1 = reshape.pivot_first(df.where(F.col("v") < 3), ["k"], "c", "v", ["A", "B", "Z"])
    assert p1.columns == ["k", "A", "B", "Z"] and tuple(p1.first()) == ("k", 1, 2, None)
    p2 = reshape.pivot_sum(df, ["k"], "c", "v", ["A", "B", "Z"], prefix="s_")
    assert tuple(p2.first()) == ("k", 1, 5, 0)
    p3 = reshape.pivot_sum(df, ["k"], "c", None, ["B"])
    assert tuple(p3.first()) == ("k", 2)


def test_densify_and_split(spark):
    df = spark.createDataFrame([("a", d(2020, 1), 5), ("a", d(2020, 3), 1), ("b", d(2020, 2), 2)],
                               "k string, m date, v int")
    cal = reshape.period_table(spark, "2020-01-01", "2020-03-01")
    out = reshape.densify(df.withColumnRenamed("m", "period"), ["k"], "period", cal, ["v"])
    assert len(out.collect()) == 6 and sum(r["v"] for r in out.collect()) == 8
    lab = spark.createDataFrame([("status_2019-01",), ("nActive_x_y",)], "s string")
    a, b = reshape.split_label("s")
    assert [tuple(r) for r in lab.select(a, b).collect()] == [("status", "2019-01"), ("nActive", "x_y")]


def test_read_wide2_two_header_rows(spark):
    path = os.path.join(tempfile.mkdtemp(), "wide.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(",light,,heavy,\n")
        fh.write(",台北市,central,台北市,central\n")
        fh.write("2018-01-01,1,2,3,\n")
        fh.write("2018-02-01,4,5,6,7\n")
    long = io.read_wide2(spark, path, ("category", "unit"))
    got = rows(long, "date", "category", "unit", "value")
    assert ("2018-01-01", "heavy", "central", None) in got            # NULL value kept
    assert ("2018-02-01", "light", "central", 5.0) in got             # blank top cell filled
    assert len(got) == 8
    assert io.read_wide2(spark, path, ("category", "unit"), drop_null=True).count() == 7


def test_read_panel_required_and_types(spark):
    path = os.path.join(tempfile.mkdtemp(), "p.csv")
    with open(path, "w") as fh:
        fh.write("county,n\nA,3\nB,x\n")
    df = io.read_panel(spark, path, {"county": "string", "n": "bigint"})
    assert rows(df) == [("A", 3), ("B", None)]
    with pytest.raises(ValidationError, match="missing required columns"):
        io.read_panel(spark, path, {"county": "string", "nope": "int"})


def test_write_roundtrip_and_pending(spark):
    out = os.path.join(tempfile.mkdtemp(), "part")
    df = spark.createDataFrame([("A", d(2020, 1), 1.0), ("A", d(2020, 2), 2.0)], "city string, month date, v double")
    io.write_partitioned(df, out, ["city", "month"])
    done = io.done_keys(spark, out, ["city", "month"])
    grid = spark.createDataFrame([("A", d(2020, m)) for m in (1, 2, 3, 12)], "city string, month date")
    assert set(rows(io.pending_keys(grid, done, ["city", "month"]))) == {("A", d(2020, 3)), ("A", d(2020, 12))}
    assert rows(io.pending_keys(grid, done, ["city", "month"], months_of_year=[12])) == [("A", d(2020, 12))]
    p = os.path.join(tempfile.mkdtemp(), "panel")
    io.write_panel(df, p, ["city", "month"])
    assert rows(spark.read.parquet(p)) == rows(df)


def test_validated_joins(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    right = spark.createDataFrame([(1, 10), (1, 11)], "k int, b int")
    with pytest.raises(ValidationError, match="duplicate keys"):
        joins.left_join(left, right, ["k"], validate="m:1")
    with pytest.raises(ValidationError, match="unmatched"):
        joins.left_join(left, right.limit(1), ["k"], require_match="b")
    nullkey = spark.createDataFrame([(None, "n")], "k int, a string")
    assert joins.left_join(nullkey, spark.createDataFrame([(None, 1)], "k int, b int"), ["k"]).first()["b"] is None


def test_outer_join_prefer(spark):
    a = spark.createDataFrame([("d1", "old", 3)], "k string, name string, n int")
    b = spark.createDataFrame([("d1", "new"), ("d2", "only")], "k string, name string")
    out = joins.outer_join(a, b, ["k"], prefer="right", fill_zero=["n"])
    assert rows(out, "k", "name", "n") == [("d1", "new", 3), ("d2", "only", 0)]


def test_calendar_lag_by_date(spark):
    df = spark.createDataFrame([("a", d(2019, 1), 1), ("a", d(2019, 3), 3), ("a", d(2020, 2), 9),
                                ("a", d(2020, 3), 4), ("b", d(2020, 2, 29), 7), ("b", d(2021, 2, 28), 8)],
                               "k string, m date, v int")
    out = {(r["k"], r["m"]): r["lag1y_v"] for r in joins.calendar_lag(df, ["k"], "m", ["v"]).collect()}
    assert out[("a", d(2020, 2))] is None          # a row lag would give 3
    assert out[("a", d(2020, 3))] == 3
    assert out[("b", d(2021, 2, 28))] == 7         # 29 Feb + 1 year = 28 Feb


def test_active_count_intervals(spark):
    rows_in = [("A", "s1", dt.datetime(2018, 1, 1), dt.datetime(2018, 3, 1), 0),   # opens/closes on the 1st
               ("A", "s2", dt.datetime(2018, 1, 15), None, 0),                      # never closes
               ("A", "s3", dt.datetime(2018, 5, 1), dt.datetime(2018, 2, 1), 0),    # closes before it opens
               ("A", "s4", dt.datetime(2018, 2, 1), dt.datetime(2018, 2, 2), 1),    # active: close ignored
               ("A", "s5", None, None, 1)]                                          # no open date
    df = spark.createDataFrame(rows_in, "g string, id string, o timestamp, c timestamp, status int")
    cal = reshape.period_table(spark, "2018-01-01", "2018-06-01", name="month")
    out = {r["month"]: r["n_open"] for r in
           joins.active_count(df, "o", "c", ["g"], cal, status_col="status").collect()}
    assert out == {d(2018, 1): 1, d(2018, 2): 3, d(2018, 3): 3, d(2018, 4): 2, d(2018, 5): 2, d(2018, 6): 2}


def brute_ratio(data, keys):
    """The reference O(n^2) prefix loop."""
    dates = sorted({r[1] for r in data})
    out = {}
    for x in range(1, len(dates) + 1):
        levels = set(dates[:x])
        for k in keys:
            sub = [r for r in data if r[0] == k and r[1] in levels]
            if not sub:
                out[(k, x)] = None
                continue
            den = sum(r[3] for r in sub)
            out[(k, x)] = None if den == 0 else sum(r[2] for r in sub) / den
    return out


def test_expanding_ratio_equals_prefix_loop(spark):
    import random

    rnd = random.Random(3)
    data = []
    for k in "abcd":
        for m in rnd.sample(range(1, 13), 7):
            tot = rnd.randint(0, 5)
            data.append((k, d(2021, m), rnd.randint(0, tot), tot))
    df = spark.createDataFrame(data, "k string, m date, num long, den long")
    r = windows.expanding_ratio(df, ["k"], "m", "num", "den", digits=4)
    base = spark.createDataFrame([(k, 100) for k in "abcde"], "k string, baseline long")
    sc = windows.scale_baseline(r, base, ["k"], "ratio", "baseline")
    got = {(x["k"], x["pos"]): (x["ratio"], x["stock"]) for x in sc.collect()}
    want = brute_ratio(data, "abcde")
    for key, v in want.items():
        g_ratio, g_stock = got[key]
        if v is None:
            assert g_ratio is None
        else:
            assert g_ratio == pytest.approx(round(v, 4), abs=1e-12)
            assert g_stock == round(g_ratio * 100)


def test_best_row_and_dedup(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5.0, 2), ("k", 5.0, 3), ("z", None, 4)],
                               "k string, v double, r int")
    assert rows(windows.best_value_row(df, ["k"], "v", ["r"]), "k", "r") == [("k", 2), ("z", 4)]
    assert rows(windows.first_wins_dedup(df, ["k"], ["r"]), "k", "r") == [("k", 1), ("z", 4)]
    assert rows(windows.last_per_group(df, ["k"], ["r"]), "k", "r") == [("k", 3), ("z", 4)]


def test_ffill_bfill_running(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 7)],
                               "k string, t int, v int")
    f = windows.ffill(df, ["k"], ["t"], "v", "f")
    b = windows.bfill(f, ["k"], ["t"], "v", "b")
    r = windows.running_sum(b, ["k"], ["t"], "v", "c")
    assert rows(r, "t", "f", "b", "c") == [(1, None, 5, None), (2, 5, 5, 5), (3, 5, 7, 5), (4, 7, 7, 12)]


def test_priority_lookup_and_alias(spark):
    s1 = spark.createDataFrame([("n1", 1, None), ("n2", 2, 2.0)], "name string, id int, x double")
    s2 = spark.createDataFrame([("n1", 9, 1.0), ("n1", 8, 1.5), ("n2", 7, 3.0)], "nm string, id int, x double")
    best = joins.priority_lookup([(s1, {"name": "name", "id": "id", "x": "x"}),
                                  (s2, {"nm": "name", "id": "id", "x": "x"})], "name", ["x"], ["id"])
    assert rows(best, "name", "id", "source_rank") == [("n1", 8, 2), ("n2", 2, 1)]
    al = spark.createDataFrame([("N-one", "n1")], "alias string, name string")
    exp = joins.alias_expand(best.select("name", "id"), al, "name")
    assert rows(exp) == [("N-one", 8), ("n1", 8), ("n2", 2)]


def test_aggregates(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 2, 1.0), ("B", 3, None), ("B", 3, None)],
                               "c string, id int, v double")
    prof = agg.missing_profile(df, ["c"], "id", "v")
    tot = agg.with_total_row(prof, "c", ["number_station", "n_missing"],
                             ("percent_missing", "n_missing", "number_station"), order=["B", "A"])
    got = {r["c"]: (r["number_station"], r["n_missing"], r["percent_missing"], r["row_order"]) for r in tot.collect()}
    assert got == {"A": (2, 1, 50.0, 2), "B": (1, 2, 200.0, 1), "Total": (3, 3, 100.0, 3)}
    assert rows(agg.group_sum(df, ["c"], ["v"]), "c", "v") == [("A", 1.0), ("B", None)]
    assert rows(agg.group_sum(df, ["c"], ["v"], empty="zero"), "c", "v") == [("A", 1.0), ("B", 0.0)]
    with pytest.raises(ValidationError):
        agg.assert_unique(df, ["c"])


def test_describe_stata_quartiles(spark):
    df = spark.createDataFrame([(float(i),) for i in (4, 1, 3, 2)] + [(None,)], "x double").repartition(3)
    r = agg.describe(df, ["x"]).first()
    assert (r["count"], r["p25"], r["p50"], r["p75"], r["min"], r["max"]) == (4, 1.5, 2.5, 3.5, 1.0, 4.0)
    df5 = spark.createDataFrame([(float(i),) for i in range(1, 6)], "x double")
    r5 = agg.describe(df5, ["x"]).first()
    assert (r5["p25"], r5["p50"], r5["p75"]) == (2.0, 3.0, 4.0)


def test_category_split_central_missing_month(spark):
    long = spark.createDataFrame([
        (d(2020, 1), "light", "臺北市", 5.0), (d(2020, 1), "light", "IDB", 1.0),
        (d(2020, 1), "light", "EPA", None), (d(2020, 2), "light", "臺北市", None),
        (d(2020, 2), "heavy", "臺北市", 3.0)], "date date, category string, unit string, value double")
    out = agg.category_split_totals(long, "date", "category", "unit", "value", ["IDB", "EPA"],
                                    ["light", "heavy"], "sub", unit_out="county")
    got = {r["date"]: r for r in out.collect()}
    jan, feb = got[d(2020, 1)], got[d(2020, 2)]
    assert jan["sub_light_local"] == 5.0 and jan["sub_light_total"] == 6.0   # EPA NULL skipped
    assert jan["sub_heavy_local"] is None and jan["sub_heavy_total"] == 0.0
    assert feb["sub_light_local"] is None and feb["sub_light_total"] == 0.0  # no central rows
    assert feb["sub_heavy_total"] == 3.0


def test_null_keys_form_no_group(spark):
    df = spark.createDataFrame([("A", 1.0), (None, 2.0), ("A", None)], "k string, v double")
    assert rows(agg.group_sum(df, ["k"], ["v"]), "k", "v") == [("A", 1.0)]
    assert len(agg.group_sum(df, ["k"], ["v"], drop_null_keys=False).collect()) == 2
    assert rows(agg.count_by(df, ["k"]), "k", "n") == [("A", 2)]


def test_io_parquet_csv_and_first_run(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([("A", 1, "x"), ("B", 2, "y")], "county string, n int, extra string")
    pq = os.path.join(base, "p.parquet")
    df.write.parquet(pq)
    got = io.read_panel(spark, pq, {"county": "string", "n": "bigint", "absent": "double"}, fmt="parquet",
                        required=["county", "n"])
    assert got.columns == ["county", "n", "absent"] and rows(got, "county", "n") == [("A", 1), ("B", 2)]
    out = os.path.join(base, "panel_csv")
    io.write_panel(df, out, ["county"], fmt="csv")
    back = spark.read.option("header", True).csv(out)
    assert sorted(r["county"] for r in back.collect()) == ["A", "B"]
    assert io.done_keys(spark, os.path.join(base, "nothing_yet"), ["county"]) is None
    grid = spark.createDataFrame([("A", d(2020, 1)), ("A", d(2020, 1))], "city string, month date")
    assert rows(io.pending_keys(grid, None, ["city", "month"])) == [("A", d(2020, 1))]


def test_read_wide2_keeps_or_refuses_every_row(spark):
    path = os.path.join(tempfile.mkdtemp(), "wide.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(",light,\n,A,B\n2018-01-01,\"1,234\",2\n,3,4\n")
    with pytest.raises(Exception, match="blank date"):
        io.read_wide2(spark, path).collect()
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(",light,\n,A,B\n2018-01-01,\"1,234\",2\n")
    assert rows(io.read_wide2(spark, path), "level1", "value") == [("A", None), ("B", 2.0)]


def test_category_split_refuses_unknown_and_duplicate(spark):
    def split(data):
        long = spark.createDataFrame(data, "date date, category string, unit string, value double")
        return agg.category_split_totals(long, "date", "category", "unit", "value", ["IDB"], ["light"], "sub")
    with pytest.raises(Exception, match="unknown category"):
        split([(d(2020, 1), "light", "A", 5.0), (d(2020, 1), "other", "A", 5.0)]).collect()
    with pytest.raises(Exception, match="duplicate local key"):
        split([(d(2020, 1), "light", "A", 5.0), (d(2020, 1), "light", "A", 6.0)]).collect()


def test_calendar_lag_leap_day_and_uniqueness(spark):
    import datetime

    days = [datetime.date(2020, 2, 28), datetime.date(2020, 2, 29), datetime.date(2021, 2, 28)]
    df = spark.createDataFrame([("A", x, float(i)) for i, x in enumerate(days)], "k string, m date, v double")
    out = {r.m: r.lag1y_v for r in joins.calendar_lag(df, ["k"], "m", ["v"]).collect()}
    assert out == {days[0]: None, days[1]: None, days[2]: 1.0}      # the 29th is the later one
    with pytest.raises(Exception, match="repeat"):
        joins.calendar_lag(df.union(df), ["k"], "m", ["v"]).collect()


def test_done_keys_text_and_errors(spark):
    out = os.path.join(tempfile.mkdtemp(), "part")
    df = spark.createDataFrame([("063", 1.0)], "city string, v double")
    io.write_partitioned(df, out, ["city"])
    assert rows(io.done_keys(spark, out, ["city"])) == [("063",)]
    assert io.pending_keys(df, io.done_keys(spark, out, ["city"]), ["city"]).count() == 0
    with open(os.path.join(out, "city=063", "broken.parquet"), "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):
        io.done_keys(spark, out, ["city"]).collect()


def test_expanding_ratio_has_rows_before_a_key_starts(spark):
    df = spark.createDataFrame([("a", 1, 1, 2), ("a", 3, 1, 2), ("b", 3, 0, 0), ("b", 5, 3, 4), ("c", 5, 1, 1)],
                               "k string, m int, num long, den long")
    got = rows(windows.expanding_ratio(df, ["k"], "m", "num", "den"), "k", "m", "pos", "ratio")
    assert got == sorted([("a", 1, 1, 0.5), ("a", 3, 2, 0.5), ("a", 5, 3, 0.5), ("b", 1, 1, None), ("b", 3, 2, None),
                          ("b", 5, 3, 0.75), ("c", 1, 1, None), ("c", 3, 2, None), ("c", 5, 3, 1.0)], key=repr)


def test_more_periods_than_a_calendar_equal_the_small_path(spark, monkeypatch):
    """J4, R5, W5, W6 give the same rows when the periods are too many to broadcast."""
    from pyspark.sql import functions as F

    from paneljet.operators import joins, reshape, util

    df = spark.range(300).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 101).alias("m"),
                                 (F.col("id") % 3).alias("num"), (F.col("id") % 5).alias("den"))
    base = spark.createDataFrame([(i, 10 * i) for i in range(9)], "k long, baseline long")

    def results():
        ratio = windows.expanding_ratio(df, ["k"], "m", "num", "den")
        return [rows(x) for x in (
            joins.grid(base.select("k"), df.select("m").distinct()), windows.positions(df, "m"), ratio,
            windows.scale_baseline(ratio, base, ["k"], "ratio", "baseline"),
            reshape.densify(df.groupBy("k", "m").agg(F.sum("num").alias("num")), ["k"], "m",
                            df.select("m").distinct(), ["num"]))]
    small = results()
    monkeypatch.setattr(util, "MAX_CALENDAR_ROWS", 20)
    assert results() == small


def test_a_million_periods(spark):
    from pyspark.sql import functions as F

    df = spark.range(1_000_000).select((F.col("id") * 60).alias("t"), (F.col("id") % 2).alias("num"), F.lit(1).alias("den"),
                                       F.lit("k").alias("k"))
    out = windows.expanding_ratio(df, ["k"], "t", "num", "den", digits=2)
    row = out.agg(F.count("ratio").alias("n"), F.max("pos").alias("top"), F.max_by("ratio", "pos").alias("last")).first()
    assert (row.n, row.top, row["last"]) == (1_000_000, 1_000_000, 0.5)


def test_commit_table_resumes(spark, tmp_path):
    """An empty key is finished, changed input is pending again, and what a crash between data
    and commit leaves behind is neither read nor taken for finished."""
    from pyspark.sql import functions as F

    from paneljet.sources import io

    path, log = str(tmp_path / "out"), str(tmp_path / "log")
    by = ["city", "month"]

    def inputs(values):
        return spark.createDataFrame([("A", 1, v) for v in values] + [("B", 1, 7)], "city string, month int, v long")

    def pending(df):
        keys = spark.createDataFrame([("A", 1), ("B", 1), ("C", 1)], "city string, month int")
        grid = keys.join(io.input_fingerprints(df, by), by, "left")
        return io.uncommitted_keys(grid, io.committed_keys(spark, log, by), by)

    def compute(df, todo):
        return df.join(todo.select(*by), by, "left_semi").groupBy(*by).agg(F.sum("v").alias("total"))

    schema = compute(inputs([1]), pending(inputs([1]))).schema
    read = lambda: rows(io.read_committed(spark, path, log, by, schema), *by, "total")
    assert read() == []
    df = inputs([1, 2])
    todo = pending(df)
    assert rows(todo, *by) == [("A", 1), ("B", 1), ("C", 1)]
    # a crash after the data, before the commit
    compute(df, todo).withColumn("batch", F.lit("dead")).write.mode("append").partitionBy(*by, "batch").parquet(path)
    assert read() == [] and pending(df).count() == 3
    io.write_committed(compute(df, todo), todo, path, log, by)
    assert read() == [("A", 1, 3), ("B", 1, 7)]
    assert pending(df).count() == 0                        # C is finished though it has no row
    assert pending(df.repartition(7)).count() == 0         # whatever the order of the rows
    df = inputs([1, 2, 9])
    todo = pending(df)
    assert rows(todo, *by) == [("A", 1)]
    io.write_committed(compute(df, todo), todo, path, log, by)
    assert read() == [("A", 1, 12), ("B", 1, 7)]
    df = inputs([])
    todo = pending(df)                                     # A has lost its input: empty from now on
    io.write_committed(compute(df, todo), todo, path, log, by)
    assert read() == [("B", 1, 7)] and pending(df).count() == 0


def test_quartiles_are_exact_whatever_the_distribution(spark):
    import math

    import numpy as np

    from paneljet.operators import agg

    rng = np.random.default_rng(2)
    n = 40_000
    cols = {"heavy": rng.lognormal(0, 4, n), "ties": rng.integers(0, 3, n).astype(float), "one": np.full(n, 7.0),
            "normal": rng.normal(1e9, 1e-3, n), "few": np.where(np.arange(n) < 6, rng.normal(size=n), np.nan)}
    data = [tuple(None if k == "few" and math.isnan(v) else float(v) for k, v in zip(cols, r)) for r in zip(*cols.values())]
    df = spark.createDataFrame(data, ", ".join(f"{k} double" for k in cols) + "")
    got = {r.variable: r for r in agg.describe(df, list(cols)).collect()}
    for k, v in cols.items():
        x = np.sort(v[~np.isnan(v)])
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            r = len(x) * p
            want = (x[int(r) - 1] + x[int(r)]) / 2 if r == int(r) else x[math.ceil(r) - 1]
            assert got[k][name] == want, (k, name)
        assert got[k]["count"] == len(x)


def test_write_wide2_reads_back(spark):
    from paneljet.plans.io_queries import write_wide2

    wide = spark.createDataFrame([("2020-01", 1, None, 3), ("2020-02", None, 5, 6)],
                                 "month string, a int, b int, c int")
    path = os.path.join(tempfile.mkdtemp(), "wide")
    write_wide2(wide, path, "month", {"a": ("X", "p"), "b": ("X", "q"), "c": ("Y", "p")})
    long = io.read_wide2(spark, path, ("top", "sub"), index="month")
    assert sorted(rows(long, "month", "top", "sub", "value"), key=str) == sorted([
        ("2020-01", "X", "p", 1.0), ("2020-01", "X", "q", None), ("2020-01", "Y", "p", 3.0),
        ("2020-02", "X", "p", None), ("2020-02", "X", "q", 5.0), ("2020-02", "Y", "p", 6.0)], key=str)
