import contextlib
import io

from paneljet.operators.util import broadcast_calendar, cut_lineage_counted


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_calendar_is_broadcast_within_its_bound_only(spark):
    import pytest

    from paneljet.operators.util import ValidationError

    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "m")
    assert "BroadcastNestedLoopJoin" in _plan(big.crossJoin(broadcast_calendar(small, 10)))
    with pytest.raises(ValidationError):
        broadcast_calendar(small, 9)


def test_counted_checkpoint(spark):
    df, n = cut_lineage_counted(spark.range(100).where("id % 3 = 0"))
    assert n == 34 and df.count() == 34
    assert "Scan ExistingRDD" in _plan(df) or "LogicalRDD" in _plan(df) or "ExistingRDD" in _plan(df)


def test_partitioned_checkpoint_is_not_shuffled_again(spark):
    from pyspark.sql import functions as F

    from paneljet.operators.util import cut_lineage_partitioned

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = cut_lineage_partitioned(spark.range(100).withColumn("v", F.col("id") * 2), 8, "id")
        other = spark.range(50).groupBy((F.col("id") % 9).alias("id")).agg(F.count("id").alias("n"))
        joined = kept.join(other, "id")
        assert joined.count() == 9
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
        plan = _plan(joined).split("Initial Plan")[-1]
        assert plan.count("Exchange hashpartitioning") == 1      # the other side's aggregate only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
