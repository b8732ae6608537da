"""The files under a folder as a table, and a manifest of those loaded.

The table comes from a listing: Spark lists many folders in parallel tasks and
opens no file. A loader keeps the listing of the days it has loaded; holding
the next one against it tells which days have new, replaced or missing files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasty.functions.dates import timestamp_millis
from roasty.sources.landing import DAY_IN_PATH, infer_format, load_raw, path_exists, read_landing

FILE_TABLE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("ymd", T.StringType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("modified_ms", T.LongType()),
        T.StructField("modified", T.TimestampNTZType()),
    ]
)
MANIFEST = T.StructType([f for f in FILE_TABLE.fields if f.name in ("path", "n_bytes", "modified_ms")])


def file_table(spark: SparkSession, paths: str | Iterable[str], name_glob: str | None = None) -> DataFrame:
    """``path, name, ymd, n_bytes, modified_ms, modified`` (UTC) of every file
    under the given folders or of the given files; names that start with
    ``_`` or ``.`` are no data and left out. ``ymd`` is the day folder, '' if
    there is none. Folders that do not exist hold no files."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    there = [p for p in wanted if path_exists(spark, p)] if len(wanted) == 1 else wanted
    if not there:
        return spark.createDataFrame([], FILE_TABLE)
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    millis = F.unix_millis("modificationTime")
    # The column of contents is not selected, so nothing is read.
    return r.load(there).select(
        "path",
        F.regexp_extract("path", r"([^/]*)$", 1).alias("name"),
        F.regexp_extract("path", DAY_IN_PATH, 1).alias("ymd"),
        F.col("length").alias("n_bytes"),
        millis.alias("modified_ms"),
        timestamp_millis(millis).alias("modified"),
    )


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """The files that were loaded, as they were then; empty before the first load."""
    full = T.StructType([*MANIFEST.fields, T.StructField("ymd", T.StringType())])
    if not path_exists(spark, manifest_path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(manifest_path)


def file_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """``ymd, path, change``: files that are ``new``, ``replaced`` (another
    size or modification time under the same path) or ``gone``."""
    old = before.select(F.col("path").alias("_path"), F.col("ymd").alias("_ymd"), F.col("n_bytes").alias("_bytes"), F.col("modified_ms").alias("_ms"))
    met = now.join(old, F.col("path") == F.col("_path"), "full")
    change = (
        F.when(F.col("_path").isNull(), "new")
        .when(F.col("path").isNull(), "gone")
        .when((F.col("n_bytes") != F.col("_bytes")) | (F.col("modified_ms") != F.col("_ms")), "replaced")
    )
    return met.select(F.coalesce("ymd", "_ymd").alias("ymd"), F.coalesce("path", "_path").alias("path"), change.alias("change")).where("change IS NOT NULL")


def load_days(spark: SparkSession, listing: DataFrame, days: list[str], file_glob: str, schema: T.StructType, raw_path: str,
              manifest_path: str | None = None, fmt: str | None = None) -> None:
    """Load whole landing days from the files of ``listing`` (a ``file_table``
    taken before): days without files are emptied. Their manifest is written
    last, so a load that fails is done again, and a file that changes while it
    is read differs from the manifest next time."""
    here = listing.where(F.col("ymd").isin(days))
    # Folders, one or a few a day.
    folders = sorted(r[0] for r in here.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).distinct().collect())
    df = read_landing(spark, [f"{d}/{file_glob}" for d in folders], fmt=fmt or infer_format(file_glob), schema=schema)
    load_raw(df, raw_path, days)
    if manifest_path:
        load_raw(here.select(*MANIFEST.fieldNames(), "ymd"), manifest_path, days)


def sync_landing(spark: SparkSession, root: str, file_glob: str, schema: T.StructType, raw_path: str, manifest_path: str,
                 fmt: str | None = None) -> list[str]:
    """Bring a raw table in line with its landing folder: the days that have
    new, replaced or missing files are loaded again, whole; a day whose files
    have all gone is emptied. Returns these days. Nothing is read of others."""
    now = file_table(spark, root, file_glob).where("ymd <> ''")
    changed = file_changes(now, read_manifest(spark, manifest_path))
    days = sorted(r["ymd"] for r in changed.select("ymd").distinct().collect())
    if days:
        load_days(spark, now, days, file_glob, schema, raw_path, manifest_path, fmt)
    return days
