"""Hot keys: one key holding a third of all rows must give the same answers."""

from pyspark.sql import functions as F

from paneljet.operators import lifecycle, windows
from test_lifecycle import brute

SF = "/root/testdata/sf0.001"


def test_entity_status_with_a_hot_entity(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = (ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
           .where(F.col("event_type").isin("signup", "error"))
           .select(F.col("user_id").alias("id"),
                   F.when(F.col("event_type") == "signup", "activate").otherwise("remove").alias("event"),
                   F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"))
           .repartition(6))
    rows = [(r["id"], r["event"], r["seq"], r["ts"]) for r in hot.collect()]
    assert sum(1 for r in rows if r[0] == 0) > len(rows) / 4
    out = lifecycle.entity_status(hot, grain="month")
    got = {(r["id"], r["period"]): r["status"] for r in out.collect()}
    ents = sorted({r[0] for r in rows})
    assert got == brute(rows, [(e, 0) for e in ents])


def test_best_row_with_a_hot_key(spark):
    n = 3000
    data = [(0 if i % 3 == 0 else i % 50, float((i * 7919) % 1000), i) for i in range(n)]
    df = spark.createDataFrame(data, "k int, v double, id int").repartition(8)
    got = {r["k"]: (r["v"], r["id"]) for r in windows.best_value_row(df, ["k"], "v", ["id"]).collect()}
    want = {}
    for k, v, i in data:
        if k not in want or (v, -i) > (want[k][0], -want[k][1]):
            want[k] = (v, i)
    assert got == want
