"""W3 against a brute-force version of the reference algorithm (grid, ffill, bfill)."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from paneljet.operators import lifecycle
from conftest import rows


def brute(events, entities, start_prefix="remove", end_prefix="activate"):
    """The reference algorithm on pandas, month grain."""
    ev = pd.DataFrame(events, columns=["id", "event", "seq", "ts"]).dropna(subset=["ts"])
    ev["month"] = pd.to_datetime(ev["ts"]).dt.to_period("M")
    ev = ev.sort_values(["id", "ts", "seq"], kind="stable")
    fl = ev.groupby(["id", "month"]).agg(first=("event", "first"), last=("event", "last")).reset_index()
    fl["s0"] = fl["first"].str.startswith(start_prefix).astype(int)
    fl["s1"] = fl["last"].str.startswith(end_prefix).astype(int)
    months = pd.period_range(ev["month"].min(), ev["month"].max(), freq="M")
    out = {}
    for eid, cur in entities:
        sub = fl[fl["id"] == eid].set_index("month")
        end_ff, start_bf = None, None
        vals = []
        for m in months:
            if m in sub.index:
                end_ff = sub.loc[m, "s1"]
            vals.append(end_ff)
        start_list = [None] * len(months)
        for i in range(len(months) - 1, -1, -1):
            m = months[i]
            if m in sub.index:
                start_bf = sub.loc[m, "s0"]
            start_list[i] = start_bf
        for i, m in enumerate(months):
            v = vals[i] if vals[i] is not None else start_list[i]
            if v is None:
                v = cur
            out[(eid, m.to_timestamp().date())] = int(v)
    return out


def ts(y, m, d, h=0):
    return dt.datetime(y, m, d, h)


FIXTURE = [
    # no events, current on / off
    # 3: only activate
    (3, "activate_time1", 0, ts(2019, 3, 10)),
    # 4: only remove -> active before, inactive after
    (4, "remove_time1", 4, ts(2019, 4, 2)),
    # 5: activate, remove, activate in different months
    (5, "activate_time1", 0, ts(2019, 1, 5)), (5, "remove_time1", 4, ts(2019, 3, 5)),
    (5, "activate_time2", 1, ts(2019, 5, 5)),
    # 6: two events in a month (remove then activate)
    (6, "remove_time1", 4, ts(2019, 2, 1)), (6, "activate_time2", 1, ts(2019, 2, 20)),
    # 7: two at one timestamp: melt order (activate before remove) breaks the tie
    (7, "activate_time1", 0, ts(2019, 4, 1)), (7, "remove_time1", 4, ts(2019, 4, 1)),
    # 8: events in the first and the last month of the span
    (8, "activate_time1", 0, ts(2019, 1, 1)), (8, "remove_time1", 4, ts(2019, 6, 30)),
    # 9: NULL timestamps only (no event)
    (9, "activate_time1", 0, None),
]
ENTITIES = [(1, 1), (2, 0), (3, 0), (4, 0), (5, 0), (6, 1), (7, 0), (8, 0), (9, 1)]


def test_entity_status_matches_reference(spark):
    ev = spark.createDataFrame(FIXTURE, "id long, event string, seq int, ts timestamp")
    ent = spark.createDataFrame(ENTITIES, "id long, cur int")
    out = lifecycle.entity_status(ev, ent, current="cur", grain="month")
    got = {(r["id"], r["period"]): r["status"] for r in out.collect()}
    want = brute(FIXTURE, ENTITIES)
    assert got == want
    # status in {0,1}, no gaps: 9 entities x 6 months
    assert len(got) == 9 * 6 and set(got.values()) <= {0, 1}


def test_entity_status_random(spark):
    rnd = random.Random(7)
    events = []
    for eid in range(40):
        for _ in range(rnd.randint(0, 6)):
            kind = rnd.choice(["activate_time1", "remove_time1"])
            events.append((eid, kind, 0 if kind.startswith("a") else 4,
                           ts(2020, rnd.randint(1, 12), rnd.randint(1, 28), rnd.randint(0, 2))))
    ents = [(eid, rnd.randint(0, 1)) for eid in range(45)]
    ev = spark.createDataFrame(events, "id long, event string, seq int, ts timestamp").repartition(5)
    ent = spark.createDataFrame(ents, "id long, cur int")
    out = lifecycle.entity_status(ev, ent, current="cur")
    got = {(r["id"], r["period"]): r["status"] for r in out.collect()}
    assert got == brute(events, ents)


def test_melt_events_and_first_last(spark):
    wide = spark.createDataFrame([(1, ts(2019, 1, 1), None, ts(2019, 1, 1))],
                                 "id long, activate_time1 timestamp, activate_time2 timestamp, remove_time1 timestamp")
    long = lifecycle.melt_events(wide, "id", ["activate_time1", "activate_time2"], ["remove_time1"])
    assert long.count() == 3
    fl = lifecycle.first_last_event(long.where(F.col("ts").isNotNull()), ["id"], "event", "ts", "seq")
    assert rows(fl, "first", "last") == [("activate_time1", "remove_time1")]


def test_status_from_wide_and_region_panel(spark):
    acts = [f"activate_time{i}" for i in range(1, 5)]
    rems = ["remove_time1", "remove_time2"]
    schema = ("id long, " + ", ".join(f"{c} timestamp" for c in acts + rems)
              + ", current_status string, nBatteries double, district string, county string")
    none4 = [None] * 4
    wide = spark.createDataFrame([
        (1, ts(2019, 1, 5), None, None, None, ts(2019, 3, 2), None, "on", 4.0, "d1", "c1"),
        (2, *none4, None, None, "on", None, "d1", "c1"),                 # no events, active now
        (3, *none4, ts(2019, 2, 1), None, "off", 2.0, "d2", "c1"),      # only a removal
    ], schema)
    st = lifecycle.status_from_wide(wide, "id", acts, rems, "current_status", "on")
    got = {(r["id"], r["period"].month): r["status"] for r in st.collect()}
    assert got == {(1, 1): 1, (1, 2): 1, (1, 3): 0, (2, 1): 1, (2, 2): 1, (2, 3): 1,
                   (3, 1): 1, (3, 2): 0, (3, 3): 0}
    regions = spark.createDataFrame([("c1", "d1"), ("c1", "d2"), ("c2", "d3")],
                                    "county string, district string")
    panel = lifecycle.region_panel(st, wide.select("id", "county", "district", "nBatteries"),
                                   regions, "id", ["county", "district"], "district",
                                   value="nBatteries")
    got = {(r["district"], r["period"].month): (r["n_active"], r["value_active"], r["active_with_value"])
           for r in panel.collect()}
    assert got[("d1", 1)] == (2, 4, 1) and got[("d1", 3)] == (1, 0, 0)
    assert got[("d2", 1)] == (1, 2, 1) and got[("d2", 2)] == (0, 0, 0)
    assert got[("d3", 2)] == (0, 0, 0) and len(got) == 9             # full district x month panel


def test_packed_order_key_equals_struct_key(spark):
    rnd = random.Random(21)
    events = []
    for eid in range(30):
        for _ in range(rnd.randint(1, 8)):
            seq = rnd.randint(0, 5)
            events.append((eid, "activate_time1" if seq < 4 else "remove_time1", seq,
                           ts(2021, rnd.randint(1, 4), rnd.choice([1, 15]))))       # many exact ties
    ev = spark.createDataFrame(events, "id long, event string, seq int, ts timestamp_ntz")
    a = lifecycle.entity_status(ev, grain="month")
    b = lifecycle.entity_status(ev, grain="month", seq_bits=3)
    assert rows(a) == rows(b)
    buf = __import__("io").StringIO()
    with __import__("contextlib").redirect_stdout(buf):
        b.explain("formatted")
    assert "HashAggregate" in buf.getvalue() and "SortAggregate" not in buf.getvalue()


def test_decimal_packed_key_orders_like_struct(spark):
    from paneljet.operators.lifecycle import _order_key

    rows_in = [(1, dt.datetime(2021, 3, 14, 2, 30, 0, 5), -5), (1, dt.datetime(2021, 3, 14, 2, 30, 0, 5), 7),
               (1, dt.datetime(2021, 3, 14, 3, 10), 0), (1, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), 2 ** 62),
               (1, dt.datetime(2021, 3, 14, 2, 30, 0, 4), 2 ** 62)]
    df = spark.createDataFrame(rows_in, "id long, ts timestamp_ntz, seq long")
    got = [(r["ts"], r["seq"]) for r in df.withColumn("k", _order_key(df, "ts", "seq", None)).orderBy("k").collect()]
    assert got == sorted((t, q) for _, t, q in rows_in)
