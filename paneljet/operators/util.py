"""Small shared helpers: bounded broadcasts, validation actions, lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MAX_CALENDAR_ROWS = 100_000


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder named by ``spark.checkpoint.dir``.

    Survives executor loss (unlike a local checkpoint) and truncates the plan of
    iterative jobs.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def cut_lineage_partitioned(df: DataFrame, parts: int, *cols: str) -> DataFrame:
    """``cut_lineage`` of ``df`` hash-partitioned on ``cols``, in a way that later plans know it.

    Joins and aggregates on ``cols`` with ``parts`` shuffle partitions then leave these rows
    where they are. An adaptive plan does not tell its partitioning to the checkpoint, so this
    one plan is made without adaptive execution.
    """
    spark = df.sparkSession
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return cut_lineage(df.repartition(parts, *cols))
    finally:
        spark.conf.set(key, before)


def cut_lineage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` that also returns the row count, observed while the checkpoint is
    written (no second job)."""
    import uuid

    from pyspark.sql import Observation

    obs = Observation(f"rows_{uuid.uuid4().hex}")
    out = cut_lineage(df.observe(obs, F.count(F.lit(1)).alias("n")), eager=True)
    return out, int(obs.get["n"])


def broadcast_calendar(df: DataFrame, max_rows: int = MAX_CALENDAR_ROWS) -> DataFrame:
    """A calendar (one row per period), materialised and counted in one job, then broadcast.

    A frame with more than ``max_rows`` rows is no calendar and is refused, never broadcast.
    """
    out, n = cut_lineage_counted(df)
    if n > max_rows:
        raise ValidationError(f"{n} periods: over the bound of {max_rows} for a calendar")
    return F.broadcast(out)


def every_period(ids: DataFrame, periods: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Every row of ``ids`` with every row of ``periods``, whatever their number.

    Up to ``max_rows`` (default MAX_CALENDAR_ROWS) periods are a calendar and broadcast. More of them are dealt
    over slices, as the ids are, each side copied into the other's slices: an equi-join on
    the pair of slices, spread over tasks, that no task holds a side of.
    """
    max_rows = MAX_CALENDAR_ROWS if max_rows is None else max_rows
    cal, n = cut_lineage_counted(periods)
    if n <= max_rows:
        return ids.crossJoin(F.broadcast(cal))
    few = -(-n // max(1, min(max_rows, 10_000)))
    many = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = lambda df, m: F.pmod(F.xxhash64(*df.columns), F.lit(m)).cast("int")
    copies = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = ids.withColumn("_deal_i", deal(ids, many)).withColumn("_deal_p", copies(few))
    right = cal.withColumn("_deal_p", deal(cal, few)).withColumn("_deal_i", copies(many))
    return left.join(right, ["_deal_i", "_deal_p"]).select(*ids.columns, *periods.columns)


class ValidationError(ValueError):
    """Raised by the opt-in validation actions."""
