"""Incremental maintenance of date-partitioned tables.

Two refresh styles exist and differ on purpose:

* ``replace_window`` deletes every row with ``key >= from_date`` and
  inserts the new rows: a day in the window that has no new rows is gone
  afterwards.
* ``overwrite_partitions`` replaces only the partitions present in the new
  rows: a day with no new rows keeps its old rows.

Each has a logical form (a DataFrame expression of the table after the
refresh, lazily planned) and an on-disk form (``commit_window`` /
``commit_partitions``) that writes Parquet with dynamic partition
overwrite, so only the touched partitions are rewritten, and the job can be
rerun after a failure with the same result.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasty.functions.dates import as_date, date_in_name, days_back

#: The folder that holds the rows without a key; a fixed value of the format.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

LATE_MODES = ("reject", "drop", "widen")


def reject_late(new: DataFrame, key: str, from_date) -> DataFrame:
    """Fail the job, inside the task that meets it, on a row whose ``key``
    is before ``from_date``. Lazy: costs nothing until the rows are
    computed."""
    frm = as_date(from_date)
    bad = F.raise_error(F.concat(F.lit(f"row with {key} before the refresh window: "), F.col(key).cast("string")))
    return new.withColumn(key, F.when(F.col(key) < frm, bad.cast(new.schema[key].dataType)).otherwise(F.col(key)))


def window_start(new: DataFrame, key: str, from_date, late: str = "reject") -> Column:
    """First key the refresh replaces: ``from_date``, or, when late rows
    widen the window, the oldest key among the new rows if that is older.
    The minimum is a scalar subquery that Spark evaluates once, before the
    main job, so a partition filter on it still prunes."""
    frm = as_date(from_date)
    if late != "widen":
        return frm
    return F.least(frm, new.agg(F.min(key)).scalar())


def replace_window(target: DataFrame, new: DataFrame, key: str, from_date, late: str = "reject") -> DataFrame:
    """``DELETE FROM target WHERE key >= from; INSERT new``.

    ``late`` says what to do with new rows whose key is before ``from_date``
    (events that arrive in a later file than their date):

    * ``reject``: the job fails naming the key;
    * ``drop``: such rows are left out;
    * ``widen``: the window starts at the oldest new key instead, so those
      days are replaced as a whole. The caller must then pass every row of
      the widened window in ``new`` (``refresh_fact`` does).
    """
    if late not in LATE_MODES:
        raise ValueError(f"late must be one of {LATE_MODES}, got {late!r}")
    start = window_start(new, key, from_date, late)
    if late == "reject":
        new = reject_late(new, key, start)
    elif late == "drop":
        new = new.where((F.col(key) >= start) | F.col(key).isNull())
    # Rows without a key are in no window: the old ones stay, new ones come.
    kept = target.where((F.col(key) < start) | F.col(key).isNull())
    return kept.unionByName(new.select(*target.columns))


def overwrite_partitions(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Partitions of ``target`` whose key appears in ``new`` are replaced by
    the new rows; every other partition is kept as it is.

    The set of keys in ``new`` (one per partition it touches, e.g. the days
    of a window) is computed once as a scalar subquery and applied to
    ``target`` as a filter. On a table partitioned by ``key`` it becomes a
    partition filter, so replaced partitions are not even read, and the
    target is never shuffled or joined."""
    touched = new.agg(F.collect_set(key)).scalar()
    kept = target.where(~F.array_contains(touched, F.col(key)) | F.col(key).isNull())
    return kept.unionByName(new.select(*target.columns))


def lookback(df: DataFrame, key: str, as_of, lookback_days: int) -> DataFrame:
    """Rows of the moving window ``key >= as_of - lookback_days``."""
    return df.where(F.col(key) >= days_back(as_of, lookback_days))


def retain(df: DataFrame, key: str | Column, as_of, days: int = 7, fmt: str = "yyyyMMdd") -> DataFrame:
    """Retention: drop rows whose dated key is strictly older than
    ``as_of - days``; rows whose key holds no valid date are kept."""
    k = F.col(key) if isinstance(key, str) else key
    d = F.to_date(F.try_to_timestamp(k.cast("string"), F.lit(fmt)))
    return df.where(d.isNull() | (d >= days_back(as_of, days)))


def retain_by_name(df: DataFrame, name: str | Column, as_of, days: int = 7) -> DataFrame:
    """Retention of named items (files, tables): drop those whose name holds
    a ``_YYYYMMDD`` date strictly older than ``as_of - days``; keep undated
    ones."""
    d = date_in_name(name)
    return df.where(d.isNull() | (d >= days_back(as_of, days)))


# --- on disk ---------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _partition_dirs(spark: SparkSession, path: str, key: str) -> dict[str, object]:
    """``{value: folder}`` of the ``key=...`` partition folders of a table;
    values are unescaped (Spark escapes special characters in folder names)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    out = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{key}="):
            out[unquote(name.split("=", 1)[1])] = st.getPath()
    return out


def partition_values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the ``key=...`` partition folders of a table (a listing of
    folder names, not a data scan)."""
    return sorted(_partition_dirs(spark, path, key))


def drop_partitions(spark: SparkSession, path: str, key: str, values) -> int:
    """Delete the partition folders of the given values."""
    fs, _ = _fs(spark, path)
    dirs = _partition_dirs(spark, path, key)
    n = 0
    for v in values:
        if v in dirs and fs.delete(dirs[v], True):
            n += 1
    return n


def expire_partitions(spark: SparkSession, path: str, key: str, as_of, days: int = 7,
                      fmt: str = "%Y%m%d") -> list[str]:
    """Retention on disk: drop the partitions whose dated key is strictly
    older than ``as_of - days`` (partitions with no valid date are kept).
    Works on the folder listing; no data is read. Returns the dropped
    values."""
    day = as_of.date() if isinstance(as_of, _dt.datetime) else as_of
    day = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
    cutoff = day - _dt.timedelta(days=days)
    old = []
    for v in partition_values(spark, path, key):
        for f in (fmt, "%Y-%m-%d"):
            try:
                d = _dt.datetime.strptime(v, f).date()
            except ValueError:
                continue
            if d < cutoff:
                old.append(v)
            break
    drop_partitions(spark, path, key, old)
    return old


def drop_table(spark: SparkSession, path: str) -> bool:
    """Remove a table folder this job created as an intermediate (a listing
    and a delete on the file system; no data read)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def swap_table(spark: SparkSession, new_path: str, path: str) -> None:
    """Put the table at ``new_path`` in the place of the one at ``path``, by
    two renames: readers see the old table or the new one, never a mix. What
    a failure between the two leaves is mended by ``restore_table``."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old")
    if fs.exists(old):
        fs.delete(old, True)
    if fs.exists(p) and not fs.rename(p, old):
        raise RuntimeError(f"cannot move {path}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(new_path), p):
        raise RuntimeError(f"cannot move {new_path}")
    fs.delete(old, True)


def restore_table(spark: SparkSession, path: str) -> bool:
    """Take back the old table if a swap ended between its two renames."""
    fs, p = _fs(spark, path)
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old")
    return bool(not fs.exists(p) and fs.exists(old) and fs.rename(old, p))


def _contract_path(path: str) -> str:
    return f"{path.rstrip('/')}__schema"


def init_table(spark: SparkSession, path: str, schema, keys: str | list[str]) -> None:
    """An empty table, whatever was there, and its contract: the declared
    columns and partition keys, kept beside it as JSON."""
    keys = [keys] if isinstance(keys, str) else keys
    commit_full(spark.createDataFrame([], schema), path, keys)
    lines = [(schema.json(),), (",".join(keys),)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(_contract_path(path))


def contract(spark: SparkSession, path: str):
    """``(schema, keys)`` that ``init_table`` declared, or None."""
    fs, p = _fs(spark, _contract_path(path))
    if not fs.exists(p):
        return None
    lines = [r["value"] for r in spark.read.text(_contract_path(path)).collect()]
    schema = next(v for v in lines if v.startswith("{"))
    return T.StructType.fromJson(json.loads(schema)), next(v for v in lines if not v.startswith("{")).split(",")


def require_contract(df: DataFrame, path: str, keys: str | list[str]) -> None:
    """Fails a job that would write other columns, types or partition keys
    than the table was declared with. A table without a contract takes all."""
    declared = contract(df.sparkSession, path)
    if declared is None:
        return
    keys = [keys] if isinstance(keys, str) else keys
    want = {f.name: f.dataType.simpleString() for f in declared[0].fields}
    have = dict(df.dtypes)
    wrong = [f"{c} is {have.get(c, 'absent')}, declared {want.get(c, 'absent')}" for c in dict.fromkeys([*want, *have]) if want.get(c) != have.get(c)]
    if declared[1] != list(keys):
        wrong.append(f"partitioned by {', '.join(keys)}, declared {', '.join(declared[1])}")
    if wrong:
        raise ValueError(f"{path} was declared otherwise: {'; '.join(wrong)}")


def read_declared(spark: SparkSession, path: str) -> DataFrame:
    """A table made by ``init_table``, with its declared columns and types,
    also while it is empty."""
    declared = contract(spark, path)
    if declared is None:
        raise ValueError(f"{path} was not declared: run its init step first")
    return spark.read.schema(declared[0]).parquet(path).select(*declared[0].fieldNames())


def commit_partitions(new: DataFrame, path: str, key: str, fmt: str = "parquet") -> None:
    """Write ``new`` replacing only the partitions it holds (insert
    overwrite). Reading and rewriting the same table in one job is safe in
    this mode: untouched partitions are never deleted."""
    (
        new.hint("rebalance", F.col(key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .format(fmt)
        .save(path)
    )


def _observed(df: DataFrame, value: Column, write) -> list:
    """Run ``write(df)`` and return the distinct ``value`` of its rows,
    observed while they go by (a set per task, merged on the driver: one value
    a partition written)."""
    seen = Observation(f"written_{uuid.uuid4().hex}")
    write(df.observe(seen, F.collect_set(value).alias("values")))
    try:
        return seen.get["values"]
    except Exception:
        # A frame that is empty by its plan is not run, so nothing is observed.
        if df.isEmpty():
            return []
        raise


def write_observed(df: DataFrame, key: str, write) -> set[str]:
    """Run ``write(df)`` and return the ``key`` values written, as text, null
    left out."""
    return set(_observed(df, F.col(key).cast("string"), write))


def commit_window(new: DataFrame, path: str, key: str, from_date, fmt: str = "parquet", also=()) -> list[str]:
    """Make the table at ``path`` hold ``new`` for every ``key >= from_date``
    and for the keys of ``also``: the partitions in ``new`` are overwritten,
    then window partitions that received no rows are removed. Returns the
    removed values.

    A rerun after a failure at any point gives the same final state. The
    partition values written are observed during the write itself (a set
    per task, merged on the driver: one value per partition written), so the
    new rows are computed once."""
    spark = new.sparkSession
    require_contract(new, path, key)
    written = write_observed(new, key, lambda df: commit_partitions(df, path, key, fmt))
    frm, more = _as_iso(from_date), {_as_iso(d) for d in also}
    stale = [v for v in partition_values(spark, path, key) if v != NULL_PARTITION and (v >= frm or v in more) and v not in written]
    drop_partitions(spark, path, key, stale)
    return stale


def commit_keys(new: DataFrame, path: str, key: str, keys, fmt: str = "parquet") -> list[str]:
    """Make the table at ``path`` hold ``new`` for the given ``keys`` (None:
    rows without one): what is in ``new`` is overwritten, the keys that got no
    rows are removed, other partitions stay. Returns the keys removed."""

    def write(rows: DataFrame) -> None:
        commit_partitions(rows, path, key, fmt)

    text = F.coalesce(F.col(key).cast("string"), F.lit(NULL_PARTITION))
    written = set(_observed(new, text, write))
    named = {NULL_PARTITION if k is None else _as_iso(k) for k in keys}
    stale = sorted((named - written) & set(partition_values(new.sparkSession, path, key)))
    drop_partitions(new.sparkSession, path, key, stale)
    return stale


def pieces(spark: SparkSession, path: str, keys: list[str]) -> dict[tuple[str, ...], object]:
    """``{values: folder}`` of a table partitioned by several keys (one
    listing, no data read). A table that has partitions of the first key
    without the others was written in another layout: an error."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    jvm = spark.sparkContext._jvm
    out = {}
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, "/".join(f"{k}=*" for k in keys))) or []:
        parts = st.getPath().toString().rsplit("/", len(keys))[1:]
        out[tuple(unquote(v.split("=", 1)[1]) for v in parts)] = st.getPath()
    if not out and _partition_dirs(spark, path, keys[0]):
        raise ValueError(f"{path} is not partitioned by {', '.join(keys)}: rebuild it with a full load")
    return out


def commit_pieces(new: DataFrame, path: str, keys: list[str], stale, fmt: str = "parquet") -> tuple[set, set]:
    """Make the pieces (combinations of ``keys``) that are in ``new`` hold it,
    then remove the other pieces for which ``stale(values, written)`` holds.
    Returns the values written and removed, as text.

    Pieces are overwritten one by one (dynamic partition overwrite) and
    removed last, so a rerun after a failure at any point gives the same final
    state. What was written is observed while the rows go by: one value a
    piece."""
    spark = new.sparkSession
    require_contract(new, path, keys)
    text = [F.coalesce(F.col(k).cast("string"), F.lit(NULL_PARTITION)) for k in keys]

    def write(rows: DataFrame) -> None:
        rows = rows.hint("rebalance", *[F.col(k) for k in keys])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).format(fmt).save(path)

    written = {tuple(v) for v in _observed(new, F.array(*text), write)}
    fs, _ = _fs(spark, path)
    dropped = {v: folder for v, folder in pieces(spark, path, keys).items() if v not in written and stale(v, written)}
    for folder in dropped.values():
        fs.delete(folder, True)
    return written, set(dropped)


def commit_full(new: DataFrame, path: str, key: str | list[str], fmt: str = "parquet") -> None:
    """Full refresh: the table is rebuilt from ``new`` alone (static
    overwrite), partitioned by one key or several. ``new`` must not read
    ``path`` itself."""
    keys = [key] if isinstance(key, str) else key
    rows = new.hint("rebalance", *[F.col(k) for k in keys])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).format(fmt).save(path)


def _as_iso(d) -> str:
    if isinstance(d, _dt.datetime):
        d = d.date()
    return d.isoformat() if isinstance(d, _dt.date) else str(d)
