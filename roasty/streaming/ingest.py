"""Incremental ingest of landing files with Structured Streaming.

The file source remembers which files it has read (in the checkpoint), so
each run with ``availableNow`` loads exactly the files that landed since the
last run, then stops. A micro-batch only tells which landing days have new
files; each of those days is loaded whole from its folder, like a batch load
(dynamic overwrite of its ``ymd`` partition). A day whose files arrive over
several runs so gives the complete day, and a replayed batch writes the same
partitions again.

A file that is replaced under its old name, or removed, is not new to the file
source. With a manifest of the loaded files, ``ingest_available`` finds the days
of such files by a listing, and loads them again.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roasty.sources.files import file_table, load_days, sync_landing
from roasty.sources.landing import CSV_OPTIONS, DAY_IN_PATH, JSON_OPTIONS, infer_format

#: Files of a micro-batch: bounds its days and its tasks.
MAX_FILES = 1000


def landing_stream(spark: SparkSession, root: str, file_glob: str, schema: T.StructType,
                   fmt: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over ``{root}/*/{file_glob}`` with ``ymd`` and
    the day folder of each row."""
    fmt = fmt or infer_format(file_glob)
    r = spark.readStream.schema(schema)
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS)
    elif fmt == "json":
        r = r.options(**JSON_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.format(fmt).load(f"{root.rstrip('/')}/*/{file_glob}")
    path = F.col("_metadata.file_path")
    return (
        df.withColumn("ymd", F.regexp_extract(path, DAY_IN_PATH, 1))
        .withColumn("_day_dir", F.regexp_extract(path, r"^(.*)/[^/]*$", 1))
    )


def file_stream(spark: SparkSession, root: str, file_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame with a row per new landing file of
    ``{root}/*/{file_glob}``: its ``ymd`` and day folder. No file is opened."""
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    path = F.col("_metadata.file_path")
    return r.load(f"{root.rstrip('/')}/*/{file_glob}").select(
        F.regexp_extract(path, DAY_IN_PATH, 1).alias("ymd"), F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("_day_dir")
    )


def reload_days(schema: T.StructType, file_glob: str, raw_path: str, fmt: str | None = None, manifest: str | None = None):
    """``foreachBatch`` function: write every day the batch touched, whole,
    from its landing folder, and note its files in the manifest. The driver
    gets one value per day of a batch, and a batch holds
    ``max_files_per_trigger`` files at most."""

    def run(batch: DataFrame, _batch_id: int) -> None:
        # Folders come URI-encoded; readers take them decoded.
        folders = [(unquote(r["_day_dir"]), r["ymd"]) for r in batch.select("_day_dir", "ymd").distinct().collect()]
        if folders:
            listing = file_table(batch.sparkSession, [f for f, _ in folders], file_glob.rpartition("/")[2])
            load_days(batch.sparkSession, listing, sorted({d for _, d in folders}), file_glob, schema, raw_path, manifest, fmt)

    return run


def ingest_available(spark: SparkSession, root: str, file_glob: str, schema: T.StructType,
                     raw_path: str, checkpoint: str, fmt: str | None = None,
                     max_files_per_trigger: int | None = MAX_FILES, manifest: str | None = None) -> StreamingQuery:
    """Load every landing file not loaded yet into the raw table, then stop
    (``trigger(availableNow=True)``, in batches of ``max_files_per_trigger``
    files). With ``manifest``, the path of the table of loaded files, days
    whose files were replaced or removed since are loaded again, too. Returns
    the finished query."""
    stream = file_stream(spark, root, file_glob, max_files_per_trigger)
    q = (
        stream.writeStream.foreachBatch(reload_days(schema, file_glob, raw_path, fmt, manifest))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if manifest:
        sync_landing(spark, root, file_glob, schema, raw_path, manifest, fmt)
    return q


def start_ingest(spark: SparkSession, root: str, file_glob: str, schema: T.StructType,
                 raw_path: str, checkpoint: str, every: str = "1 hour", fmt: str | None = None,
                 max_files_per_trigger: int | None = MAX_FILES, manifest: str | None = None) -> StreamingQuery:
    """The scheduled form: a running query that loads new landing files every
    ``every`` (the hourly ingest), noting them in ``manifest`` if given; call
    ``sync_landing`` beside it for replaced and removed ones. Stop it with
    ``query.stop()``."""
    stream = file_stream(spark, root, file_glob, max_files_per_trigger)
    return (
        stream.writeStream.foreachBatch(reload_days(schema, file_glob, raw_path, fmt, manifest))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )
