"""Landing files -> raw tables.

Landing layout: ``{root}/{yyyyMMdd}/{file}.{ext}``, one file per feed and
day. The day is taken from the folder name (``_metadata.file_path``), so a
glob over all days reads every day in one scan. Raw tables are Parquet
partitioned by ``ymd``: later reads by day prune partitions.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasty.operators.incremental import drop_partitions, write_observed

# File extensions the loader accepts and the reader of each.
EXTENSION_FORMATS = {
    "json": "json",
    "ndjson": "json",
    "csv": "csv",
    "parquet": "parquet",
    "avro": "avro",
    "orc": "orc",
}

# CSV as the feeds write it: one header row, '"' quotes, a quote inside a
# field doubled (JSON text in event_value), UTF-8. A malformed row fails the
# load rather than turning into NULLs.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "FAILFAST",
    # Every file's header is held against the columns read: a file of one load
    # whose columns are in another order than the first one's fails the load.
    "enforceSchema": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}
JSON_OPTIONS = {"mode": "FAILFAST", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}

DAY_IN_PATH = r"/(?:ymd=)?(\d{8})/"


def infer_format(path: str) -> str:
    """Reader for a file name or glob, from its extension."""
    name = path.rstrip("/").rpartition("/")[2]
    ext = name.rpartition(".")[2].lower()
    fmt = EXTENSION_FORMATS.get(ext) if "." in name else None
    if fmt is None:
        raise ValueError(f"no reader for {path}: its extension is none of {', '.join(sorted(EXTENSION_FORMATS))}")
    return fmt


def table_name_of(file_name: str) -> str:
    """Table name from a file name without its extension: letters, digits and
    ``_`` of ASCII stay, any other character becomes ``_``."""
    name = file_name.rstrip("/").rpartition("/")[2]
    stem = name.rpartition(".")[0] or name
    return "".join(c if c == "_" or (c.isascii() and c.isalnum()) else "_" for c in stem)


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None, infer: bool):
    r = spark.read
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS)
        if infer and schema is None:
            r = r.option("inferSchema", "true")
    elif fmt == "json":
        r = r.options(**JSON_OPTIONS)
    if schema is not None and fmt in ("csv", "json"):
        r = r.schema(schema)
    return r.format(fmt)


def _in_file_order(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The declared columns in the order of the CSV header at ``path``;
    columns the schema does not declare are read as text, to be dropped."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    if not set(header) & set(declared):
        if not header:
            return schema
        raise ValueError(f"the header of {path} has none of the declared columns: {', '.join(header)}")
    return T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a path or glob match anything (a listing, no data read)?"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def read_landing(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    schema: T.StructType | None = None,
    infer: bool = False,
    with_day: bool = True,
) -> DataFrame:
    """Read landing files (a path, a glob or a list) with one reader.

    ``schema`` declares the columns (the default for the feeds); ``infer``
    asks CSV to infer types instead. Columns are found by name in every
    format, CSV headers included, and put in the declared order; a declared
    column that the files lack becomes a typed NULL. Files of several formats
    are read by the reader of each. ``ymd`` is the ``yyyyMMdd`` folder of each
    file. No file matching -> an empty frame with the declared schema.
    """
    paths = [path] if isinstance(path, str) else list(path)
    by_format: dict[str, list[str]] = {}
    for p in paths:
        by_format.setdefault(fmt or infer_format(p), []).append(p)
    if unknown := set(by_format) - set(EXTENSION_FORMATS.values()):
        raise ValueError(f"no reader of the format {', '.join(sorted(unknown))}")
    found = {f: [p for p in some if path_exists(spark, p)] for f, some in by_format.items()}
    parts = [_read_one_format(spark, some, f, schema, infer, with_day) for f, some in found.items() if some]
    if not parts:
        if schema is None:
            raise ValueError(f"no file at {path} and no schema to build an empty frame")
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("ymd", F.lit(None).cast("string")) if with_day else empty
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=schema is None), parts)


def _read_one_format(spark: SparkSession, paths: list[str], fmt: str, schema: T.StructType | None, infer: bool,
                     with_day: bool) -> DataFrame:
    try:
        read_as = _in_file_order(spark, paths[0], schema) if schema is not None and fmt == "csv" else schema
        df = _reader(spark, fmt, read_as, infer).load(paths)
    except AnalysisException as e:
        if fmt == "avro" and "avro" in str(e).lower():
            raise RuntimeError(
                "The Avro data source is not on the classpath; start Spark with the spark-avro package"
            ) from e
        raise
    if with_day:
        df = df.withColumn("ymd", F.regexp_extract(F.col("_metadata.file_path"), DAY_IN_PATH, 1))
    if schema is not None:
        have = set(df.columns)
        columns = [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ]
        df = df.select(*columns, *(["ymd"] if with_day else []))
    return df


def day_paths(root: str, days: Iterable[str], file_glob: str) -> list[str]:
    """Globs of one file pattern in each day folder."""
    return [f"{root.rstrip('/')}/{d}/{file_glob}" for d in days]


def read_feed(
    spark: SparkSession,
    root: str,
    file_glob: str,
    schema: T.StructType,
    days: Iterable[str] | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """A feed's landing files: the given days, or every day (``*``)."""
    paths = day_paths(root, days, file_glob) if days is not None else [f"{root.rstrip('/')}/*/{file_glob}"]
    return read_landing(spark, paths, fmt=fmt or infer_format(file_glob), schema=schema)


def write_landing(df: DataFrame, root: str) -> None:
    """Write feed rows as landing CSV, one folder per day
    (``{root}/ymd={day}/part-*.csv``), quoted as the feeds quote."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("mode", "timestampNTZFormat", "enforceSchema")}
    (
        df.hint("rebalance", F.col("ymd"))
        .write.mode("overwrite")
        .options(**opts)
        # The writer trims spaces by default; a blank value must stay blank.
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .partitionBy("ymd")
        .csv(root)
    )


def load_raw(df: DataFrame, raw_path: str, days: Iterable[str] | None = None) -> None:
    """Replace the raw table's day partitions (truncate and load per day): a
    rerun of the same days gives the same table. ``days`` names the days that
    were delivered: one of them without rows ends up empty. Each day is
    written by few tasks, a huge one by as many as it needs."""

    def write(rows: DataFrame) -> None:
        (
            rows.hint("rebalance", F.col("ymd"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ymd")
            .parquet(raw_path)
        )

    written = write_observed(df, "ymd", write)
    if days is not None:
        drop_partitions(df.sparkSession, raw_path, "ymd", sorted(set(days) - written))


def read_raw(spark: SparkSession, raw_path: str, schema: T.StructType, from_ymd: str | None = None) -> DataFrame:
    """A raw table (or its days ``>= from_ymd``, pruned by partition); an
    empty frame with the declared schema when the table does not exist."""
    full = T.StructType(list(schema.fields) + [T.StructField("ymd", T.StringType())])
    if not path_exists(spark, raw_path):
        return spark.createDataFrame([], full)
    # The declared schema also types the ``ymd`` partition as a string (no
    # inference of partition types, no footer reads to infer the schema).
    df = spark.read.schema(full).parquet(raw_path)
    if from_ymd is not None:
        df = df.where(F.col("ymd") >= F.lit(from_ymd))
    return df


def register_external(spark: SparkSession, name: str, path: str, fmt: str | None = None,
                      schema: T.StructType | None = None) -> DataFrame:
    """An external (no-copy) table: a temp view over the landing files,
    replaced if it exists."""
    df = read_landing(spark, path, fmt=fmt, schema=schema)
    df.createOrReplaceTempView(name)
    return df


def list_day(spark: SparkSession, root: str, ymd: str) -> list[str]:
    """Files under one day prefix ``{root}/{ymd}`` (a listing, no data)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{ymd}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(
        st.getPath().toString()
        for st in fs.listStatus(p)
        if st.isFile() and not st.getPath().getName().startswith(("_", "."))
    )


def load_day_by_file(
    spark: SparkSession,
    root: str,
    ymd: str,
    raw_root: str,
    schemas: dict[str, T.StructType] | None = None,
    infer: bool = True,
) -> dict[str, str]:
    """Load the files of one landing day into the raw tables named after each
    file (``table_name_of``), replacing that table's day partition.

    The reader comes from each file's extension (an unknown extension fails
    the load, naming it); the schema is the declared one of the table when
    ``schemas`` has it, else inferred. Files of one feed that differ in their
    extension are one load; two feeds whose names give one table fail the
    load. An empty day loads nothing. Returns ``{table: raw path}``."""
    files = list_day(spark, root, ymd)
    feeds: dict[str, set[str]] = {}
    tables: dict[str, list[str]] = {}
    for f in files:
        infer_format(f)  # fail before anything is written
        name = f.rpartition("/")[2]
        feeds.setdefault(table_name_of(f), set()).add(name.rpartition(".")[0] or name)
        tables.setdefault(table_name_of(f), []).append(f)
    for table, names in feeds.items():
        if len(names) > 1:
            raise ValueError(f"several feeds would load into the table {table}: {', '.join(sorted(names))}")
    loaded = {}
    for table, some in tables.items():
        schema = (schemas or {}).get(table)
        df = read_landing(spark, some, schema=schema, infer=infer and schema is None)
        path = f"{raw_root.rstrip('/')}/{table}"
        load_raw(df, path, [ymd])
        loaded[table] = path
    return loaded
