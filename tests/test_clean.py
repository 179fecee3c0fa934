import datetime as dt

import pytest
from pyspark.sql import functions as F

from paneljet.functions import clean
from conftest import rows


def test_parse_date_modes(spark):
    df = spark.createDataFrame([(1, "2019-01-05"), (2, "05/02/2019"), (3, "junk"), (4, None)],
                               "k int, s string")
    fmts = ["yyyy-MM-dd", "dd/MM/yyyy"]
    assert rows(clean.parse_date(df, "s", fmts, "null", out="d"), "k", "d") == [
        (1, dt.date(2019, 1, 5)), (2, dt.date(2019, 2, 5)), (3, None), (4, None)]
    assert [r[0] for r in rows(clean.parse_date(df, "s", fmts, "drop", out="d"), "k")] == [1, 2]
    with pytest.raises(Exception, match="unparseable date"):
        clean.parse_date(df, "s", fmts, "fail", out="d").collect()
    ok = df.where(F.col("k") != 3)
    assert clean.parse_date(ok, "s", fmts, "fail", out="d").count() == 3


def test_roc_date(spark):
    df = spark.createDataFrame([("1070101",), ("990315",), ("1071301",), ("abc",), (None,)], "s string")
    out = [r[0] for r in df.select(clean.roc_date("s")).collect()]
    assert out == [dt.date(2018, 1, 1), dt.date(2010, 3, 15), None, None, None]


def test_title_month_text_parses(spark):
    df = spark.createDataFrame([("01JAN2019",)], "s string")
    v = df.select(clean.parse_date_col(clean.normalize_text("s", case="title"), ["ddMMMyyyy"])).first()[0]
    assert v == dt.date(2019, 1, 1)


def test_normalize_and_map(spark):
    df = spark.createDataFrame([(" 台北巿 ",), ("x",), (None,)], "s string")
    norm = clean.normalize_text("s", [("台", "臺"), ("巿", "市")])
    assert [r[0] for r in df.select(norm).collect()] == ["臺北市", "x", None]
    keep = clean.map_values(norm, {"臺北市": "Taipei"})
    null = clean.map_values(norm, {"臺北市": "Taipei"}, default="null")
    assert [tuple(r) for r in df.select(keep, null).collect()] == [
        ("Taipei", "Taipei"), ("x", None), (None, None)]


def test_to_number(spark):
    df = spark.createDataFrame([("1,234",), (" 5 ",), ("abc",), ("NaN",)], "s string")
    assert [r[0] for r in df.select(clean.to_number("s")).collect()] == [None, 5.0, None, None]


def test_drop_missing_report(spark):
    df = spark.createDataFrame([(1, 1, 1), (None, None, 1), (1, None, None), (1, 1, None)],
                               "a int, b int, c int")
    kept, report = clean.drop_missing(df, ["a", "b", "c"])
    assert kept.count() == 1
    assert rows(report, "step", "col", "n_dropped") == [(1, "a", 1), (2, "b", 1), (3, "c", 1)]


def test_log_kinds_keep_null(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (0.0,), (3.0,)], "x double")
    out = df.select(*[clean.log_col("x", k).alias(k) for k in
                      ("log1p_nonneg", "log1p_clip0", "log_clip1", "log1p")]).collect()
    assert tuple(out[0]) == (None, None, None, None)            # NULL in -> NULL out
    assert out[1]["log1p_nonneg"] is None and out[1]["log1p_clip0"] == 0.0
    assert out[1]["log_clip1"] == 0.0 and out[1]["log1p"] is None
    assert out[3]["log_clip1"] == pytest.approx(1.0986122886681098)


def test_interactions_null_chain(spark):
    df = spark.createDataFrame([(10.0, 2.0, None), (10.0, 2.0, 3.0)], "b double, l1 double, l2 double")
    out = clean.interactions(df, "b", {"one": ["l1"], "two": ["l1", "l2"]}).collect()
    assert out[0]["iv_two"] is None and out[0]["iv_one"] is not None
    assert out[1]["iv_two"] == pytest.approx(2.302585092994046 * 1.791759469228055)


def test_safe_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (1.0, 4.0)], "n double, d double")
    assert [r[0] for r in df.select(clean.safe_ratio("n", "d")).collect()] == [None, None, 0.25]
    assert [r[0] for r in df.select(clean.safe_ratio("n", "d", zero="zero")).collect()] == [0.0, 0.0, 0.25]
    r = spark.createDataFrame([(0.00015,), (2.5,), (3.5,), (0.125,)], "x double")
    got = r.select(clean.round_half_even("x", 4).alias("a"), clean.round_half_even("x", 0).alias("b"),
                   clean.round_half_even("x", 2).alias("c")).collect()
    assert got[0]["a"] == 0.0001          # numpy-style, not 0.0002
    assert (got[1]["b"], got[2]["b"]) == (2.0, 4.0)
    assert got[3]["c"] == 0.12


def test_encode_ids_with_hot_values_and_nulls(spark):
    rows = [("hot", i) for i in range(300)] + [(None, i) for i in range(50)] + [(f"v{i % 90:02d}", i) for i in range(200)]
    rows += [("hot", 1)] * 40
    df = spark.createDataFrame(rows, "v string, n int")
    order = {v: k + 1 for k, v in enumerate(sorted({v for v, _ in rows if v is not None}))}
    want = sorted((str(v), n, order.get(v) or 0) for v, n in rows)
    for share in (0.0, 0.1, 1.0):                    # all hot, one hot, none hot
        got = clean.encode_ids(df.repartition(3), "v", "id", hot_share=share)
        assert got.columns == ["v", "n", "id"]
        assert sorted((str(r.v), r.n, r.id or 0) for r in got.collect()) == want


def test_encode_ids_dense(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "a", None, "b"]], "v string")
    out = clean.encode_ids(df.repartition(3), "v", "id")
    assert sorted(set(rows(out, "v", "id")), key=repr) == sorted(
        {("a", 1), ("b", 2), ("c", 3), (None, None)}, key=repr)


def test_extract_and_keys(spark):
    df = spark.createDataFrame([("https://m.x/?ll=25.03,121.56&z=1", "a/vmid/ABC123/map"),
                                ("nothing", None)], "u string, p string")
    lat, lon = clean.extract_ll("u")
    out = df.select(lat, lon, clean.extract_path_id("p"),
                    clean.composite_key(["u", "p"], "|")).collect()
    assert tuple(out[0])[:3] == (25.03, 121.56, "ABC123")
    assert tuple(out[1]) == (None, None, None, None)


def test_keep_columns_report(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out, rep = clean.keep_columns(df, ["c", "z", "a"])
    assert out.columns == ["c", "a"] and rep["missing"] == ["z"] and rep["dropped"] == ["b"]
    assert clean.drop_if_exists(out, ["a", "q"]).columns == ["c"]


def test_recode_join(spark):
    df = spark.createDataFrame([("統一超商",), ("other",), (None,)], "parent string")
    lk = spark.createDataFrame([("統一超商", "7-11")], "from string, to string")
    assert [r[0] for r in clean.recode_join(df, "parent", lk).orderBy("parent").collect()] == [None, "7-11", "other"]
    got = {r[0] for r in clean.recode_join(df, "parent", lk, default="null").collect()}
    assert got == {None, "7-11"}
