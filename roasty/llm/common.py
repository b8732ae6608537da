"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roasty.operators.incremental import drop_table
from roasty.session import scratch_path

#: White space that separates words of the rules and join operators.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared scratch space and read
    back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    for noted in _NOTED:
        noted.append(path)
    return out


#: Lists that take down the folders being written, see ``working_tables``.
_NOTED: list[list[str]] = []


def discard(*tables: DataFrame) -> None:
    """Removes the folders of ``stored`` tables that nothing reads any more:
    all that was made of them has been written."""
    for t in tables:
        drop_table(t.sparkSession, t._stored_at)


@contextlib.contextmanager
def working_tables(spark: SparkSession, docs: DataFrame, noted: list[str]) -> Iterator[None]:
    """Notes the folders that ``stored`` writes in this block in ``noted``,
    after removing those noted before that ``docs`` does not read. For steps
    in a row of which each one's result is written before the next begins."""
    bare = lambda path: path.split(":", 1)[-1].replace("///", "/")
    read = [bare(f) for f in docs.inputFiles()]
    for path in list(noted):
        if not any(f.startswith(bare(path)) for f in read):
            drop_table(spark, path)
            noted.remove(path)
    _NOTED.append(noted)
    try:
        yield
    finally:
        _NOTED.remove(noted)


#: What operators keep in a worker process between tasks, and how to drop it.
_KEPT: dict[str, Callable[[], None]] = {}


def claim(owner: str, drop: Callable[[], None] | None = None) -> None:
    """Called where a task of ``owner`` starts: worker processes go from one
    operator's tasks to another's, so what the others keep is dropped. With
    ``drop``, what the owner keeps can be dropped by them in turn."""
    for other in [k for k in _KEPT if k != owner]:
        _KEPT.pop(other)()
    if drop:
        _KEPT[owner] = drop


def text_key(text: Column) -> Column:
    """Tells rows with one id apart by their text; null and '' agree."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def words(text: Column, separators: str) -> Column:
    """The non-empty parts of ``text`` between runs of the character class
    ``separators``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{separators}]+"), "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the
    body uses it (the optimizer may otherwise copy the expression into every
    use, and into lambdas)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` as one struct column ``row`` beside the ``keys``, so that no
    name of a table can meet a name that an operator uses."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in keys.items()])


def unpacked(rows: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns that ``packed`` took in."""
    return rows.select(*[replaced.get(c, F.col("row")[c]).alias(c) for c in columns])
