"""Merkle manifest of a table: a digest tree per language over its rows, a
root over the languages, and each row's proof.

Rows of a language ascend by id; their place in that order is their rank. A
node is labelled with the interval of ranks that it covers, so that ancestors
are the nodes whose intervals contain a row's rank, and the siblings on its
path are what remains of a parent's interval without the node's own.

The tree is built upwards, one grouping a level. Paths are handed down: each
level meets its parents by the bucket of ranks that a parent covers and by
containment. A node's path belongs to all rows below it, so no level is
larger than its own nodes; rows are shuffled twice as digests, never as texts.
Groups hold FAN nodes at most, whatever a language's share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import ascii_lower, stored

FAN = 8

#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:string,right:string>>"


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 over the fields: ``-`` for null, else byte count, ``:``, value."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


def leaves(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``g`` (the language), ``id``, ``leaf`` and ``now``: the digest of the
    row as recorded and as it is found. Here every row whose id's CRC-32 is a
    multiple of three is found with A-Z of its text in lower case."""
    names = {"doc_id": id_col, "text": text_col, "lang": lang_col}
    values = [F.col(f"`{names.get(f, f)}`") for f in FIELDS]
    tampered = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 0
    found = [ascii_lower(v) if f == "text" else v for f, v in zip(FIELDS, values, strict=True)]
    leaf = leaf_hash(values)
    return docs.select(
        F.col(f"`{lang_col}`").cast("string").alias("g"), F.col(f"`{id_col}`").alias("id"), leaf.alias("leaf"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_hash(found)).alias("changed"),
    ).withColumn("now", F.coalesce("changed", "leaf")).drop("changed")


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``lo``, the rank within ``g`` by ``order`` (nulls first).

    Rows are sorted over range partitions; a row's number within its partition
    is known there, and the rows before it come from a small table of counts
    (one row per group and partition), so a group may span any number of
    partitions."""
    keys = [F.col("g").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = stored(sorted_.withColumn("at", F.monotonically_increasing_id()), f"merkle-{name}")
    runs = numbered.groupBy("g", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.expr("coalesce(sum(n) OVER (PARTITION BY g ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    total = F.expr("sum(n) OVER (PARTITION BY g)")
    offsets = stored(
        runs.select(F.col("g").alias("_g"), F.col("part").alias("_part"), (before - F.col("first")).alias("_shift"), total.alias("size")),
        f"merkle-{name}-runs",
    )
    same = F.col("g").eqNullSafe(F.col("_g")) & (F.shiftright("at", 33) == F.col("_part"))
    return numbered.join(offsets, same).select(*rows.columns, (F.col("at") + F.col("_shift")).alias("lo"), "size")


def _parents(nodes: DataFrame, span: int, below: list[str]) -> DataFrame:
    """The level above: ``g, lo, hi, digest, size`` and ``kids``, the FAN
    nodes or fewer that a node covers, by rank. ``span`` is the number of
    ranks that a full parent covers."""
    kid = F.struct("lo", "hi", "digest", *below)
    grouped = nodes.groupBy("g", F.expr(f"lo div {span}").alias("bucket")).agg(
        F.sort_array(F.collect_list(kid)).alias("kids"), F.max("size").alias("size")
    )
    return grouped.select(
        "g", F.expr("kids[0].lo").alias("lo"), F.expr("kids[size(kids) - 1].hi").alias("hi"),
        _hash(F.col("kids.digest")).alias("digest"), "size", "kids",
    )


def _handed_down(parents: DataFrame, paths: DataFrame, span: int, below: list[str], above: list[str]) -> DataFrame:
    """``g, lo, hi, digest, path``, and ``below`` of the kids of ``parents``
    and ``above`` of the ``paths``. A path goes upwards, one step a level: the
    siblings left and right of the node, their digests joined."""
    p = paths.select(F.col("g").alias("_g"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", *above)
    inside = (F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi"))
    bucket = F.expr(f"lo div {span}") == F.expr(f"_lo div {span}")
    met = parents.select("g", "lo", "hi", "kids").join(p, F.col("g").eqNullSafe(F.col("_g")) & bucket & inside)
    each = met.select("g", "path", "kids", *above, F.explode("kids").alias("kid"))

    # What the parent's interval holds beside the node's own.
    def beside(keep) -> Column:
        return F.array_join(F.transform(F.filter("kids", keep), lambda x: x["digest"]), "")

    step = F.struct(
        beside(lambda x: x["hi"] < F.col("kid.lo")).alias("left"), beside(lambda x: x["lo"] > F.col("kid.hi")).alias("right")
    )
    path = F.concat(F.array(step), F.col("path")).alias("path")
    return each.select("g", "kid.lo", "kid.hi", "kid.digest", path, *[f"kid.{c}" for c in below], *above)


class Forest:
    """A tree per group over ranked leaves ``g, lo, digest, size``, which may
    carry more columns, ``below``."""

    def __init__(self, nodes: DataFrame, below: list[str], name: str):
        self.below, self.name = below, name
        self.leaves = nodes.withColumn("hi", F.col("lo"))
        # The deepest tree's height: one number for the driver.
        most = nodes.agg(F.max("size").alias("n")).collect()[0]["n"] or 0
        height, reach = 0, 1
        while reach < most:
            height, reach = height + 1, reach * FAN
        self.levels: list[DataFrame] = []
        level, carried = self.leaves, below
        for i in range(height):
            # A tree ends with the level that has one node.
            open_ = level.filter(F.col("size") > FAN**i)
            level = stored(_parents(open_, FAN ** (i + 1), carried), f"merkle-{name}-level{i + 1}")
            self.levels.append(level)
            carried = []

    def _tops(self, level: DataFrame) -> DataFrame:
        return level.filter("lo = 0 AND hi = size - 1")

    def roots(self) -> DataFrame:
        """``g, digest`` of each tree's root; a lone leaf is one."""
        out = self._tops(self.leaves).select("g", "digest")
        for level in self.levels:
            out = out.unionByName(self._tops(level).select("g", "digest"))
        return out

    def paths(self, tops: DataFrame, above: list[str]) -> DataFrame:
        """``g, lo, hi, digest, path, *below, *above`` of every leaf. ``tops``
        has ``g, path, *above`` of each tree's root: the steps above it, and
        what else all its leaves get."""
        t = tops.select(F.col("g").alias("_t"), "path", *above)

        def begun(level: DataFrame, extra: list[str]) -> DataFrame:
            own = self._tops(level).select("g", "lo", "hi", "digest", *extra)
            return own.join(t, F.col("g").eqNullSafe(F.col("_t"))).select("g", "lo", "hi", "digest", "path", *extra, *above)

        known = None
        for i in range(len(self.levels) - 1, -1, -1):
            roots = begun(self.levels[i], [])
            known = roots if known is None else known.unionByName(roots)
            known = _handed_down(self.levels[i], known, FAN ** (i + 1), [] if i else self.below, above)
            if i:
                known = stored(known, f"merkle-{self.name}-paths{i}")
        lone = begun(self.leaves, self.below)
        return lone if known is None else known.unionByName(lone)


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings give."""
    return F.aggregate(path, digest, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]).cast("binary"), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row ``id_col, leaf, subroot, root, proof`` (per level upwards the
    siblings ``left`` and ``right`` of the row's node), ``proof_sha256,
    folded_root, verified``.

    Null fields and languages are values of their own; null ids come first in
    their language. Rows with one id are ordered by their digests, equal rows
    in any order, which changes nothing. A null id is never tampered with. An
    empty table gives an empty result; other columns are ignored."""
    rows = leaves(docs, id_col, text_col, lang_col).withColumnRenamed("leaf", "digest")
    trees = Forest(stored(ranked(rows, ["id", "digest"], "rows"), "merkle-ranked"), ["id", "now"], "rows")
    # The languages' roots are the leaves of one more tree.
    alone = F.lit(None).cast("string").alias("g")
    roots = stored(trees.roots().select(alone, F.col("g").alias("lang"), "digest"), "merkle-subroots")
    over = Forest(stored(ranked(roots, ["lang"], "subroots"), "merkle-ranked"), ["lang"], "subroots")
    top = over.roots().select(alone, F.array().cast(STEPS).alias("path"), F.col("digest").alias("root"))
    tops = over.paths(top, ["root"]).select(F.col("lang").alias("g"), "path", F.col("digest").alias("subroot"), "root")
    found = trees.paths(stored(tops, "merkle-tops"), ["subroot", "root"])
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = found.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", F.col("path").alias("proof"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded(F.col("now"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
