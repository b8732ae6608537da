"""Landing files whose columns differ: read by shape and widened.

A load may hold files with their columns in another order, with a column more
or less, or with a column of another type. Files are grouped by the columns
they have, each group is read by name with its own types, and the groups are
united in the narrowest types that hold all their values.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasty.sources.files import file_table
from roasty.sources.landing import CSV_OPTIONS, DAY_IN_PATH, infer_format

#: Whole numbers and decimals from narrow to wide, and times.
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
TIMES = ("date", "timestamp_ntz", "timestamp")


def wider(a: str, b: str) -> str:
    """The narrowest type that holds the values of both: along the numbers
    and along the times, text for all else. A column of nulls fits any type; a
    long with a float, and a decimal with a float, need a double."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    for chain in (NUMBERS, TIMES):
        if a in chain and b in chain:
            top = chain[max(chain.index(a), chain.index(b))]
            return "double" if top == "float" and {a, b} & {"int", "bigint"} else top
    if a.startswith("decimal") or b.startswith("decimal"):
        one, two = sorted((a, b), key=lambda t: t.startswith("decimal"))
        if one in ("float", "double"):
            return "double"
        sizes = [_decimal(t) for t in (one, two)]
        if None not in sizes:
            scale = max(s for _, s in sizes)
            whole = max(p - s for p, s in sizes)
            return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "double"
    return "string"


def _decimal(t: str) -> tuple[int, int] | None:
    if t.startswith("decimal"):
        p, s = t[8:-1].split(",")
        return int(p), int(s)
    return {"tinyint": (3, 0), "smallint": (5, 0), "int": (10, 0), "bigint": (19, 0)}.get(t)


def csv_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, header``: the first line of each CSV file, read in tasks. A
    file's lines pass one by one; each task keeps the first of each file."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("n", F.monotonically_increasing_id())
    return first.groupBy("path").agg(F.min_by("value", "n").alias("header"))


def _groups(spark: SparkSession, fmt: str, paths: list[str]) -> list[tuple[str, list[str]]]:
    """Files by shape. For CSV the header is the shape; the others carry types
    of their own: a file's schema, from its footer or its records."""
    if fmt == "csv":
        shapes = csv_headers(spark, paths).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
        return [(r["header"], sorted(r["paths"])) for r in shapes]
    by: dict[str, list[str]] = {}
    for p in paths:
        by.setdefault(spark.read.format(fmt).load(p).schema.json(), []).append(p)
    return sorted(by.items())


def read_shapes(spark: SparkSession, paths: str | Iterable[str], declared: T.StructType | None = None) -> DataFrame:
    """The rows of all files under ``paths`` with ``ymd``, whatever the order,
    number and types of each file's columns.

    With ``declared`` the result has these columns and types: text is parsed
    (a value that does not parse fails the job), files without a column give
    nulls. Without, CSV types are inferred shape by shape, and the result has
    every column of any file in the narrowest common type."""
    files = [r["path"] for r in file_table(spark, paths).select("path").collect()]  # a load: the files of some days
    by_format: dict[str, list[str]] = {}
    for f in sorted(files):
        by_format.setdefault(infer_format(f), []).append(f)
    frames = []
    for fmt, some in by_format.items():
        for _, same in _groups(spark, fmt, some):
            r = spark.read.format(fmt)
            if fmt == "csv":
                r = r.options(**CSV_OPTIONS).option("inferSchema", str(declared is None).lower())
            df = r.load(same)
            frames.append(df.withColumn("ymd", F.regexp_extract(F.col("_metadata.file_path"), DAY_IN_PATH, 1)))
    if not frames:
        if declared is None:
            raise ValueError(f"no file under {paths} and no declared columns")
        return spark.createDataFrame([], declared).withColumn("ymd", F.lit(None).cast("string"))
    types: dict[str, str] = {f.name: f.dataType.simpleString() for f in declared.fields} if declared else {}
    if declared is None:
        for df in frames:
            for c, t in df.dtypes:
                types[c] = wider(types.get(c, "void"), t)
    types["ymd"] = "string"

    def fitted(df: DataFrame) -> DataFrame:
        have = dict(df.dtypes)
        return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()])

    return reduce(DataFrame.unionByName, [fitted(df) for df in frames])
