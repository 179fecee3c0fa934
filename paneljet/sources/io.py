"""Sources and sinks S1-S7.

Readers return typed DataFrames; writers range-partition on the output keys so that a hot
key is spread over several files instead of one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.util import ValidationError


def read_panel(spark: SparkSession, path: str, schema: T.StructType | Mapping[str, str],
               fmt: str = "csv", required: Sequence[str] | None = None) -> DataFrame:
    """Read a header CSV (or Parquet) and cast to ``schema``.

    Text that does not fit the declared type becomes NULL (``try_cast``). A required column
    missing from the file fails with its name before any data is read.
    """
    fields = (schema.fields if isinstance(schema, T.StructType)
              else [T.StructField(k, T._parse_datatype_string(v)) for k, v in schema.items()])
    if fmt == "csv":
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    need = list(required) if required is not None else [f.name for f in fields]
    missing = [c for c in need if c not in raw.columns]
    if missing:
        raise ValidationError(f"{path}: missing required columns {missing}")
    cols = []
    for f in fields:
        if f.name in raw.columns:
            c = F.col(f"`{f.name}`")
            if fmt == "csv":
                c = F.trim(c).try_cast(f.dataType)
            else:
                c = c.cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def _first_two_lines(raw: DataFrame, path: str) -> list:
    lines = raw.limit(2).collect()
    if len(lines) < 2:
        raise ValidationError(f"{path}: expected two header rows")
    return lines


def wide2_header(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The two header rows of a two-level CSV as (level0, level1) per data column.

    Blank top cells take the last non-blank label to their left. Only the first two lines
    of the file are read (the header, not the data).
    """
    return _labels(_first_two_lines(spark.read.option("header", False).csv(path), path))


def _labels(lines: list) -> list[tuple[str, str]]:
    top, sub = list(lines[0])[1:], list(lines[1])[1:]
    out, last = [], None
    for a, b in zip(top, sub):
        if a is not None and str(a).strip() != "":
            last = str(a).strip()
        out.append((last, None if b is None else str(b).strip()))
    return out


def read_wide2(spark: SparkSession, path: str, level_names: Sequence[str] = ("level0", "level1"),
               index: str = "date", drop_null: bool = False, value_type: str = "double") -> DataFrame:
    """CSV with two header rows and an index first column to long
    ``(index, level0, level1, value)``.

    The header (two rows) is read once on the driver; the data rows are unpivoted in place
    with one ``explode`` over literal labels, no join. A data row with a blank index is an
    error, never dropped (several files must share one header); text that is not a plain
    number, thousands separators included, is NULL.
    """
    raw = spark.read.option("header", False).csv(path)
    cols = raw.columns
    idx = cols[0]
    head = _first_two_lines(raw, path)
    header = _labels(head)
    is_head = F.lit(False)
    for row in head:
        same = F.lit(True)
        for c, v in zip(cols, row):
            same = same & F.col(c).eqNullSafe(F.lit(v).cast("string"))
        is_head = is_head | same
    blank = F.coalesce(F.trim(F.col(idx)) == "", F.lit(True))
    data = raw.where(~is_head).withColumn(idx, F.when(blank, F.raise_error(
        F.lit(f"{path}: a data row has a blank {index}"))).otherwise(F.col(idx)))
    structs = [F.struct(F.lit(l0).alias(level_names[0]), F.lit(l1).alias(level_names[1]),
                        F.trim(F.col(c)).try_cast(value_type).alias("value"))
               for c, (l0, l1) in zip(cols[1:], header)]
    out = (data.select(F.trim(F.col(idx)).alias(index), F.explode(F.array(*structs)).alias("_s"))
           .select(index, f"_s.{level_names[0]}", f"_s.{level_names[1]}", "_s.value"))
    return out.where(F.col("value").isNotNull()) if drop_null else out


def write_panel(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """One panel sorted by ``keys``: range partitions, each sorted, written in order."""
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode(mode).format(fmt).option("header", True).save(path))


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet",
                      sort_keys: Sequence[str] = ()) -> None:
    """One output slice per value of ``by`` (e.g. city x month); only the slices present
    in ``df`` are replaced (dynamic partition overwrite), so reruns of pending keys are safe.

    Range partitioning on (by, sort keys) lets a large slice span several tasks/files.
    """
    (df.repartitionByRange(*by, *sort_keys).sortWithinPartitions(*by, *sort_keys)
     .write.mode("overwrite").format(fmt).option("header", True)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(path))


def done_keys(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet"
              ) -> DataFrame | None:
    """Partition values already written under ``path``, as text (``None`` when the path does
    not exist yet). Any other read error is raised: it must not look like "nothing written"."""
    schema = ", ".join(f"`{k}` string" for k in keys)     # no type inference: '063' stays '063'
    try:
        return spark.read.format(fmt).schema(schema).load(path).select(*keys).distinct()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def pending_keys(grid: DataFrame, done: DataFrame | None, keys: Sequence[str],
                 months_of_year: Sequence[int] | None = None, month_col: str = "month") -> DataFrame:
    """Combinations of ``grid`` whose output does not exist yet, optionally only some
    months of the year (e.g. December snapshots)."""
    g = grid
    if months_of_year:
        g = g.where(F.month(month_col).isin(list(months_of_year)))
    if done is None:
        return g.select(*keys).distinct()
    kinds = dict(g.dtypes)
    typed = done.select(*[F.col(k).cast(kinds[k]).alias(k) for k in keys])
    return g.select(*keys).distinct().join(typed, list(keys), "left_anti")


def input_fingerprints(df: DataFrame, keys: Sequence[str], out: str = "fingerprint") -> DataFrame:
    """``(keys, fingerprint)`` of the input rows of every key: their number and the sum of their
    hashes, whatever their order (one partial aggregate)."""
    h = F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))
    return df.groupBy(*keys).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), h.cast("string")).alias(out))


def _parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or ``None`` when there is none yet; other errors are raised."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def committed_keys(spark: SparkSession, commits: str, keys: Sequence[str]) -> DataFrame | None:
    """The last commit ``(keys, fingerprint, batch)`` of every finished key, or ``None`` when
    nothing was committed yet."""
    log = _parquet(spark, commits)
    if log is None:
        return None
    last = F.max_by(F.struct("fingerprint", "batch"), F.struct("committed_at", "batch"))
    return log.groupBy(*keys).agg(last.alias("_c")).select(*keys, "_c.fingerprint", "_c.batch")


def uncommitted_keys(grid: DataFrame, done: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The keys of ``grid`` (``keys`` and ``fingerprint``, NULL for a key without input) that were
    never committed or whose input has changed since. A key committed as empty is finished."""
    wanted = grid.select(*keys, "fingerprint").distinct()
    if done is None:
        return wanted
    return wanted.join(done, [wanted[c].eqNullSafe(done[c]) for c in (*keys, "fingerprint")], "left_anti")


def write_committed(df: DataFrame, pending: DataFrame, path: str, commits: str, by: Sequence[str],
                    sort_keys: Sequence[str] = ()) -> None:
    """S5 + S6: write the rows of the ``pending`` keys (``by`` and ``fingerprint``), then commit every
    one of them, also those without a row.

    Each call writes a batch of its own beside earlier ones and names it in the commit, which
    follows the data: what a crash in between leaves behind is never read, and its keys are
    still pending. A key whose rows have gone is empty in its new batch.
    """
    batch = uuid.uuid4().hex
    rows = df.withColumn("batch", F.lit(batch))
    (rows.repartitionByRange(*by, *sort_keys).sortWithinPartitions(*by, *sort_keys)
     .write.mode("append").partitionBy(*by, "batch").parquet(path))
    (pending.select(*by, "fingerprint").distinct()
     .select("*", F.lit(batch).alias("batch"), F.current_timestamp().alias("committed_at"))
     .write.mode("append").parquet(commits))


def read_committed(spark: SparkSession, path: str, commits: str, by: Sequence[str], schema: T.StructType
                   ) -> DataFrame:
    """The rows of ``schema`` that belong to the last commit of their key."""
    done = committed_keys(spark, commits, by)
    rows = _parquet(spark, path, T.StructType([*schema.fields, T.StructField("batch", T.StringType())]))
    if done is None or rows is None:
        return spark.createDataFrame([], schema)
    last = [rows[c].eqNullSafe(done[c]) for c in (*by, "batch")]
    return rows.join(done, last, "left_semi").select(*schema.names)


def build_base_layers(roads: Sequence[DataFrame], towns: Sequence[DataFrame],
                      class_col: str = "ROADCLASS1", drop_classes: Sequence[str] = ("HW",)) -> tuple[DataFrame, DataFrame]:
    """Union per-city roads and towns; drop highway classes; one boundary set per city.

    Rows with no road class are kept (a NULL class is not a highway). A town may have several
    rows, one per ring of its boundary; only rows equal in every column are united.
    """
    r = roads[0]
    for x in roads[1:]:
        r = r.unionByName(x, allowMissingColumns=True)
    t = towns[0]
    for x in towns[1:]:
        t = t.unionByName(x, allowMissingColumns=True)
    r = r.where(F.col(class_col).isNull() | ~F.col(class_col).isin(list(drop_classes)))
    return r, t.distinct()
