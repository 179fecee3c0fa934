"""Status of entities over time from activation/removal events.

Definition (followed from the reference code, not its prose):

* per entity and period that has events, ``first``/``last`` are the labels with the least
  and greatest ``(ts, seq)``;
* ``start = 1`` when ``first`` is a removal (the entity must have been active before it),
  ``end = 1`` when ``last`` is an activation;
* on the grid of all entities x all periods between the first and the last event period
  (both included) ``status = coalesce(ffill(end), bfill(start), current)``.

Plan. Instead of materialising the grid and then filling it with two windows, the status is
constant between two consecutive event periods of an entity, so each event period row emits
its own run of periods with ``explode(sequence(...))``:

    event log -(one pass: hash aggregate on (entity, period), packed order key)->
              per-period start/end flags (+ optional extra aggregates), materialised
    -(shuffle on entity, window over <= #periods rows)-> run start/end
    -> explode runs (the expanded grid is never shuffled)
    entities without events -> anti join -> explode the whole span with the current status

Per-entity work is bounded by the number of periods, not by the number of events, so an
entity with a third of all events costs one partial aggregate per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import add_periods, period_start, period_step
from .util import cut_lineage


def melt_events(df: DataFrame, entity: str, activate_cols: Sequence[str],
                remove_cols: Sequence[str], ts_out: str = "ts", label_out: str = "event",
                seq_out: str = "seq") -> DataFrame:
    """R1 for lifecycle tables: wide ``activate_time1..n`` / ``remove_time1..m`` columns to
    long ``(entity, event, seq, ts)``; ``seq`` is the melt position (activations first), the
    tie-break for events at the same timestamp. Rows with a NULL time are kept (they carry
    no event but keep the entity)."""
    cols = list(activate_cols) + list(remove_cols)
    structs = [F.struct(F.lit(c).alias(label_out), F.lit(i).alias(seq_out),
                        F.col(c).cast("timestamp").alias(ts_out))
               for i, c in enumerate(cols)]
    return (df.select(entity, F.explode(F.array(*structs)).alias("_e"))
            .select(entity, f"_e.{label_out}", f"_e.{seq_out}", f"_e.{ts_out}"))


def first_last_event(events: DataFrame, keys: Sequence[str], label: str, ts: str,
                     seq: str | None = None) -> DataFrame:
    """First and last label per key group, ordered by ``(ts, seq)``.

    ``min_by``/``max_by`` are partial aggregates, so hot keys are combined map-side.
    """
    order = F.struct(F.col(ts), F.col(seq)) if seq else F.col(ts)
    return events.groupBy(*keys).agg(F.min_by(label, order).alias("first"),
                                     F.max_by(label, order).alias("last"))


def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch, monotonic in the column's own order.

    TIMESTAMP values are instants (``unix_micros``). TIMESTAMP_NTZ values are wall-clock
    times: they are converted from their date and time fields, never through a session time
    zone (a cast would make times inside a daylight-saving gap overtake later ones).
    """
    t = df.schema[ts].dataType.typeName()
    c = F.col(ts)
    if t == "timestamp_ntz":
        return (F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
                + F.hour(c).cast("long") * F.lit(3_600_000_000)
                + F.minute(c).cast("long") * F.lit(60_000_000)
                + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))
    if t == "date":
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    return F.unix_micros(c.cast("timestamp"))


_SEQ_SHIFT = 2 ** 63          # moves any LONG into [0, 2**64) < 10**20
_DEC = "decimal(38,0)"


def _order_key(df: DataFrame, ts: str, seq: str | None, seq_bits: int | None) -> Column:
    """A single primitive key ordered like (ts, seq), so the first/last aggregate is a hash
    aggregate: a LONG when ``seq`` fits in ``seq_bits``, else a DECIMAL(38,0)
    ``micros * 10**20 + (seq + 2**63)`` for any integral ``seq``; a struct otherwise."""
    if seq is None:
        return F.col(ts)
    if seq_bits:
        return F.shiftleft(_micros(df, ts), seq_bits) + F.col(seq).cast("long")
    if df.schema[seq].dataType.typeName() in ("byte", "short", "integer", "long"):
        shifted = F.col(seq).cast(_DEC) + F.expr(f"CAST('{_SEQ_SHIFT}' AS {_DEC})")
        scale = F.expr(f"CAST('{10 ** 20}' AS {_DEC})")
        return (_micros(df, ts).cast(_DEC) * scale + shifted).cast(_DEC)
    return F.struct(F.col(ts), F.col(seq))


def _is_prefixed(c: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def event_periods(events: DataFrame, *, entity: str = "id", label: str = "event",
                  ts: str = "ts", seq: str | None = "seq", grain: str = "month",
                  activate: Sequence[str] = ("activate",), remove: Sequence[str] = ("remove",),
                  period: str = "period", seq_bits: int | None = None,
                  keep_non_events: bool = True, extra: dict[str, Column] | None = None) -> DataFrame:
    """A7 as W3 needs it, in one pass over the event log: per (entity, period) the start flag
    (first event is a removal), the end flag (last event is an activation) and whether the
    period has an event at all, plus optional ``extra`` aggregates over the same rows (e.g.
    per-period counts of other event types).

    Only the two flags are needed from the first/last event, so they are computed per event
    and the aggregate carries integers; the order key (ts, seq) is packed into one primitive
    (``_order_key``), so it is a hash aggregate. Non-events get a NULL key, which
    ``min_by``/``max_by`` skip. With ``keep_non_events`` every row keeps its (entity, period),
    so entities without any event still appear. The result (no larger than the output grid)
    is materialised with a reliable checkpoint.
    """
    is_rem = _is_prefixed(F.col(label), remove)
    is_act = _is_prefixed(F.col(label), activate)
    ev = events.withColumns({"_rem": is_rem.cast("int"), "_act": is_act.cast("int"),
                             "_is_ev": (is_rem | is_act) & F.col(ts).isNotNull()})
    key = F.when(F.col("_is_ev"), _order_key(events, ts, seq, seq_bits))
    if not keep_non_events:
        ev = ev.where(F.col("_is_ev"))
    ev = ev.withColumn(period, period_start(ts, grain))
    aggs = [F.min_by("_rem", key).alias("_start"), F.max_by("_act", key).alias("_end"),
            F.max("_is_ev").alias("_has_ev")]
    aggs += [c.alias(name) for name, c in (extra or {}).items()]
    return cut_lineage(ev.groupBy(entity, period).agg(*aggs))


def status_from_periods(agg: DataFrame, entities: DataFrame | None = None, *, entity: str = "id",
                        grain: str = "month", current: str | Column | None = None,
                        period: str = "period", status: str = "status") -> DataFrame:
    """W3 from ``event_periods``: ``status = coalesce(ffill(end), bfill(start), current)`` on
    the grid of all entities x all periods between the first and the last event period."""
    fl = agg.where(F.col("_has_ev")).select(entity, period, "_start", "_end")

    # The span of the grid: one row, so a broadcast of it is bounded by construction.
    span = F.broadcast(fl.agg(F.min(period).alias("_lo"), F.max(period).alias("_hi")))

    w = Window.partitionBy(entity).orderBy(period)
    runs = (fl.withColumn("_next", F.lead(period).over(w))
              .withColumn("_first_row", F.row_number().over(w) == 1)
              .crossJoin(span))
    step = period_step(grain)
    run_end = F.coalesce(add_periods(F.col("_next"), -1, grain), F.col("_hi"))
    own_run = F.struct(F.col(period).alias("a"), run_end.alias("b"), F.col("_end").alias("s"))
    lead_in = F.struct(F.col("_lo").alias("a"), add_periods(F.col(period), -1, grain).alias("b"),
                       F.col("_start").alias("s"))
    segs = F.when(F.col("_first_row") & (F.col(period) > F.col("_lo")),
                  F.array(lead_in, own_run)).otherwise(F.array(own_run))
    with_events = (runs.select(entity, F.explode(segs).alias("_seg"))
                   .select(entity, F.explode(F.sequence("_seg.a", "_seg.b", step)).alias(period),
                           F.col("_seg.s").cast("int").alias(status)))

    if entities is None:
        ent = agg.select(entity).distinct().withColumn("_cur", F.lit(0))
    else:
        cur = F.lit(0) if current is None else (
            F.col(current) if isinstance(current, str) else current)
        ent = entities.select(entity, F.coalesce(cur.cast("int"), F.lit(0)).alias("_cur"))
    quiet = (ent.join(fl.select(entity).distinct(), entity, "left_anti")
             .crossJoin(span)
             .select(entity, F.explode(F.sequence("_lo", "_hi", step)).alias(period),
                     F.col("_cur").alias(status)))
    return with_events.unionByName(quiet)


def entity_status(events: DataFrame, entities: DataFrame | None = None, *, entity: str = "id",
                  label: str = "event", ts: str = "ts", seq: str | None = "seq",
                  grain: str = "month", activate: Sequence[str] = ("activate",),
                  remove: Sequence[str] = ("remove",), current: str | Column | None = None,
                  period: str = "period", status: str = "status",
                  seq_bits: int | None = None) -> DataFrame:
    """W3 (flagship): ``(entity, period, status)`` for every entity and every period.

    ``events``: long events ``(entity, label, ts[, seq])``; rows with NULL ``ts``, and rows
    whose label is neither an activation nor a removal, are not events (they may be passed
    so that one pass over an event log gives both the events and the entity set).
    ``entities``: the entity table (one row per entity) carrying ``current``; when omitted
    the entities are the distinct ids of ``events``. ``current``: column (0/1 or boolean)
    used for entities with no event at all; default 0. ``seq_bits`` says
    ``seq < 2**seq_bits`` (e.g. the melt position of a wide table) and allows a LONG order
    key instead of a DECIMAL one.
    """
    agg = event_periods(events, entity=entity, label=label, ts=ts, seq=seq, grain=grain,
                        activate=activate, remove=remove, period=period, seq_bits=seq_bits,
                        keep_non_events=entities is None)
    return status_from_periods(agg, entities, entity=entity, grain=grain, current=current,
                               period=period, status=status)


def active_per_period(status_df: DataFrame, by: Sequence[str] = (), period: str = "period",
                      status: str = "status") -> DataFrame:
    """Count of active entities (and of all entities) per period and optional keys."""
    return status_df.groupBy(period, *by).agg(
        F.sum(status).cast("long").alias("n_active"),
        F.count(F.lit(1)).alias("n_entities"))


def status_from_wide(df: DataFrame, entity: str, activate_cols: Sequence[str],
                     remove_cols: Sequence[str], current_col: str | None = None,
                     active_value=None, grain: str = "month", period: str = "period",
                     status: str = "status") -> DataFrame:
    """C1 on the wide lifecycle layout: one row per entity with ``activate_time1..n`` and
    ``remove_time1..m`` columns and a current-status column (``active_value`` marks active).

    The melt order gives the tie-break (activations before removals), labels are the column
    names, so a column counts as activation/removal by the list it is passed in.
    """
    ev = melt_events(df, entity, activate_cols, remove_cols)
    cur = None
    if current_col is not None:
        cur = (F.col(current_col) == F.lit(active_value)).cast("int")
    ent = df.select(entity, *([current_col] if current_col else []))
    n_cols = len(activate_cols) + len(remove_cols)
    return entity_status(ev, ent, entity=entity, label="event", ts="ts", seq="seq", grain=grain,
                         activate=tuple(activate_cols), remove=tuple(remove_cols), current=cur,
                         period=period, status=status, seq_bits=max(1, (n_cols - 1).bit_length()))


def region_panel(status_df: DataFrame, attrs: DataFrame, regions: DataFrame, entity: str,
                 region_keys: Sequence[str], join_key: str, period: str = "period",
                 status: str = "status", value: str | None = None,
                 grain: str = "month") -> DataFrame:
    """Per region x period the number of active entities, the active total of ``value``
    (e.g. batteries; all-missing counts as 0) and the active entities with a value, over
    the full region list x all periods (gaps 0; regions outside the list kept, names taken
    from the list where both exist).

    ``attrs`` carries ``entity``, the region keys and ``value``; ``regions`` is the region
    list (e.g. all districts) keyed by ``join_key``.
    """
    from ..functions.clean import indicator_product
    from .joins import grid, outer_join
    from .reshape import densify, periods_of

    st = status_df.join(attrs, entity)
    cols = {"n_active": F.col(status)}
    if value is not None:
        cols["value_active"] = indicator_product(status, value)
        cols["active_with_value"] = indicator_product(status, F.col(value).isNotNull().cast("int"))
    st = st.withColumns(cols).dropna(subset=list(region_keys))   # no NULL-region group
    measures = list(cols)
    agg = st.groupBy(*region_keys, period).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in measures])
    cal = periods_of(st, period, grain, period)
    dense = densify(agg, list(region_keys), period, cal, measures, 0)
    full = grid(regions.select(*region_keys), cal)
    out = outer_join(dense, full, [join_key, period], prefer="right", fill_zero=measures)
    return out.select(*region_keys, period, *[F.col(m).cast("long").alias(m) for m in measures])

