"""Raw tables named after their files, kept in a catalog table.

Each landing file ``{name}.{ext}`` of a day becomes the table
``{name}_{yyyyMMdd}``. The catalog says which file a table came from, where it
is and whether it is still kept; the loader and the retention by name update
it together with the tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasty.functions.dates import date_in_name
from roasty.functions.strings import safe_name
from roasty.operators.incremental import commit_keys, drop_table, retain_by_name
from roasty.sources.files import file_table
from roasty.sources.landing import path_exists, read_landing

#: ``state`` is ``kept`` or ``expired``.
CATALOG = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("ymd", T.StringType()),
    ]
)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], CATALOG)


def named_files(files: DataFrame) -> DataFrame:
    """``name, source, ymd`` of the files of a ``file_table``: the name without
    its extension, other characters than letters, digits and ``_`` replaced,
    and the day."""
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    return files.select(F.concat_ws("_", safe_name(stem), "ymd").alias("name"), F.col("path").alias("source"), "ymd")


def load_by_file_name(spark: SparkSession, root: str, ymd: str, tables_root: str, catalog_path: str,
                      schemas: dict[str, T.StructType] | None = None) -> dict[str, str]:
    """Load every file of a landing day into the table named after it, and
    enter it in the catalog. Two files whose names give one table fail the
    load before anything is written. ``schemas`` declares columns by the name
    without its day. Loading the day again replaces its tables and entries;
    tables of files that have gone stay until they expire. Returns
    ``{table: path}``."""
    found = named_files(file_table(spark, f"{root.rstrip('/')}/{ymd}"))
    twice = found.groupBy("name").agg(F.sort_array(F.collect_list("source")).alias("s")).where("size(s) > 1").orderBy("name").first()
    if twice:
        raise ValueError(f"several files would load into the table {twice['name']}: {', '.join(twice['s'])}")
    loaded: dict[str, str] = {}
    files = found.orderBy("name").collect()  # the files of one day
    for r in files:
        schema = (schemas or {}).get(r["name"].rpartition("_")[0])
        path = f"{tables_root.rstrip('/')}/{r['name']}"
        read_landing(spark, r["source"], schema=schema, infer=schema is None).write.mode("overwrite").parquet(path)
        loaded[r["name"]] = path
    entries = found.select(
        "name", date_in_name("name").alias("day"), "source", F.concat(F.lit(tables_root.rstrip("/") + "/"), "name").alias("path"),
        F.lit("kept").alias("state"), "ymd",
    )
    old = read_catalog(spark, catalog_path).where(F.col("ymd") == ymd).join(found.select("name"), "name", "left_anti").select(*CATALOG.fieldNames())
    # The day's entries are read before their partition is replaced.
    rows = spark.createDataFrame(entries.unionByName(old).collect(), CATALOG)
    commit_keys(rows, catalog_path, "ymd", [ymd])
    return loaded


def expire_by_name(spark: SparkSession, catalog_path: str, as_of, days: int = 7) -> list[str]:
    """Retention by name: tables whose name holds a date older than ``as_of -
    days`` are removed and marked as expired; undated ones stay. The entries
    are marked last, so a failed run is done again. Returns the names."""
    now = read_catalog(spark, catalog_path).where("state = 'kept'")
    old = now.join(retain_by_name(now, "name", as_of, days).select("name"), "name", "left_anti").select(*CATALOG.fieldNames())
    gone = old.collect()  # the tables of the days that expire with this run
    for r in gone:
        drop_table(spark, r["path"])
    if gone:
        changed = sorted({r["ymd"] for r in gone})
        names = {r["name"] for r in gone}
        rows = read_catalog(spark, catalog_path).where(F.col("ymd").isin(changed)).collect()
        marked = [{**r.asDict(), "state": "expired" if r["name"] in names else r["state"]} for r in rows]
        commit_keys(spark.createDataFrame([tuple(m[f] for f in CATALOG.fieldNames()) for m in marked], CATALOG), catalog_path, "ymd", changed)
    return sorted(r["name"] for r in gone)


def read_named(spark: SparkSession, catalog_path: str, name: str, from_day: _dt.date | None = None) -> DataFrame:
    """The kept tables ``{name}_*`` of days ``>= from_day`` as one (a table
    family with a suffix filter)."""
    rows = read_catalog(spark, catalog_path).where((F.col("state") == "kept") & F.col("name").rlike(rf"^{name}_\d{{8}}$"))
    if from_day is not None:
        rows = rows.where(F.col("day") >= F.lit(from_day))
    paths = sorted(r["path"] for r in rows.select("path").collect())
    if not paths:
        raise ValueError(f"no table {name}_* is kept")
    return spark.read.option("mergeSchema", "true").parquet(*paths)
