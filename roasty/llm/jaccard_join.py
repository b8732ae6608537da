"""Near-duplicate documents by an n-gram Jaccard join.

A document's set holds the hashes of its word shingles. Documents with equal
sets form a class and are one node from then on. Shingles are counted over the
whole corpus and ordered rarest first; two sets that are similar enough share
one among the first few of each (prefix filter), have similar sizes (length
filter), leave enough shingles after the shared one (positional filter) and
spread alike over the parts of the hash space (suffix filter). What is left is
verified on the whole sets, once per pair.

Links are needed between components alone, so pairs are not all made: first
each class is verified against the centre that it shares most lists with, then
against the other centres that are not in its component yet, then every pair
of a list that is still in two components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import SPACE_CLASS, claim, discard, packed, stored, text_key, unpacked
from roasty.llm.components import components
from roasty.llm.shingling import digest, mixed, pack, pack_sorted, shingle_set, unpack, unpack_sorted

SHINGLE = 5
PERCENT = 80

#: Shingles travel as so many bits of their hash to be counted and listed. Two
#: that agree in them share a list: more candidates, the same links.
KEY_BITS = 40
KEY_BYTES = KEY_BITS // 8
#: A shingle of more documents than this is frequent. Its exact count goes to
#: every task; of more than MOST_FREQUENT such shingles those with the highest
#: counts do (12 bytes each), which raises the bound.
RARE = 32
MOST_FREQUENT = 1 << 21
#: Entries that a task holds before it deals them out by ranges of keys.
HELD = 800_000
#: Parts of the hash space that the suffix filter compares, 64 a word.
PARTS = 512
#: Classes whose names (24 bytes each) are sent to every task, so that only
#: their texts are shuffled. Beyond that, all texts are.
FEW_CLASSES = 1 << 20

NONE = np.zeros(0, np.uint64)


def probe_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def _range_bits(docs: DataFrame) -> int:
    """Ranges of keys so many that a range's share of all shingles is far
    below a task's input, at any size."""
    return max(6, (8 * docs.rdd.getNumPartitions() - 1).bit_length())


def _dealt(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The runs of ascending keys that fall in each range."""
    of = keys >> np.uint64(KEY_BITS - bits)
    starts = np.flatnonzero(np.diff(of, prepend=np.uint64(1 << 63)))
    for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
        yield int(of[a]), slice(a, b)


def frequent(own: DataFrame, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the frequent shingles, ascending, and the number of documents
    that have each, over all documents (copies within a task count once).

    A task counts its own shingles first, so one that a third of all documents
    share is one entry a task."""
    bits = _range_bits(own)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard")
        held, n, seen = [], 0, set()

        def deal() -> pa.RecordBatch:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            rows = [(r, pack_sorted(keys[s], KEY_BYTES), pack(times[s], 4)) for r, s in _dealt(keys, bits)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["r", "k", "c"])

        for b in batches:
            for text in b.column(2).cast(pa.binary()):
                h = shingle_set(text.as_py() or b"", size)
                if len(h) and (d := digest(h)) not in seen:
                    seen.add(d)
                    held.append(h >> np.uint64(64 - KEY_BITS))
                    n += len(h)
                    if n >= HELD:
                        yield deal()
                        n = 0
        if held:
            yield deal()

    def total(pieces: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(x, KEY_BYTES) for x in pieces["k"].to_pylist()])
        times = np.concatenate([unpack(x, 4) for x in pieces["c"].to_pylist()]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.diff(keys, prepend=keys[0] + np.uint64(1)))
        sums = np.add.reduceat(times, first)
        often = sums > RARE
        return pa.table({"k": keys[first][often].astype(np.int64), "n": sums[often]})

    dealt = own.select("_id", "_key", "_text").mapInArrow(count, "r int, k binary, c binary")
    found = stored(dealt.groupBy("r").applyInArrow(total, "k long, n long"), "jaccard-frequent")
    # By powers of the count, under a hundred rows: what bound keeps few enough?
    step = F.floor(F.log2(F.col("n")) * 4).cast("int")
    left, least = MOST_FREQUENT, 0
    for r in found.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("s")).collect():
        left -= r["n"]
        if left < 0:
            least = r["s"] + 1
            break
    rows = found.filter(step >= least).toArrow()
    discard(found)
    keys, times = rows["k"].to_numpy().astype(np.uint64), rows["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], times[order]


def prefixes(own: DataFrame, often: tuple[np.ndarray, np.ndarray], size: int = SHINGLE) -> DataFrame:
    """Two kinds of rows. Per document (``r`` null) ``_id, _key, n, a, b,
    parts``: the size and the digest of its set, and for each part of the hash
    space whether it has an odd number of shingles there. Per task and range of keys ``r, k, e, p, m``: the
    prefix entries of its distinct sets, packed (key, node, place, set size);
    those of frequent shingles have ``r`` -1.

    A set's order is rare shingles by hash, then frequent ones by count."""
    bits = _range_bits(own)
    spread = own.sparkSession.sparkContext.broadcast(often)
    fields = [("_id", pa.int64()), ("_key", pa.int64()), ("n", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("parts", pa.list_(pa.int64())),
              ("r", pa.int32()), ("k", pa.binary()), ("e", pa.binary()), ("p", pa.binary()), ("m", pa.binary())]
    schema = pa.schema(fields)

    def batch(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard")
        keys, times = spread.value
        held: dict[bool, list] = {False: [], True: []}
        held_n, seen = 0, set()

        def deal() -> pa.RecordBatch:
            rows = []
            for hot, some in held.items():
                if not some:
                    continue
                k, e, p, m = (np.concatenate([x[i] for x in some]) for i in range(4))
                order = np.argsort(k, kind="stable")
                k, e, p, m = k[order], e[order], p[order], m[order]
                some.clear()
                for r, s in [(-1, slice(None))] if hot else _dealt(k, bits):
                    rows.append((r, pack_sorted(k[s], KEY_BYTES), pack(e[s], 8), pack(p[s], 4), pack(m[s], 4)))
            return batch(**{c: [x[i] for x in rows] for i, c in enumerate("rkepm")})

        for b in batches:
            sizes, das, dbs, parts = [], [], [], []
            for text in b.column(2).cast(pa.binary()):
                h = shingle_set(text.as_py() or b"", size)
                sizes.append(len(h))
                da, db = digest(h) if len(h) else (0, 0)
                das.append(da)
                dbs.append(db)
                odd = np.bincount((h & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS) & 1
                parts.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                if not len(h) or (da, db) in seen:
                    continue
                seen.add((da, db))
                k, take = h >> np.uint64(64 - KEY_BITS), probe_length(len(h))
                at = np.searchsorted(keys, k) if len(keys) else np.zeros(len(k), np.int64)
                hot = np.zeros(len(k), bool)
                inside = at < len(keys)
                hot[inside] = keys[at[inside]] == k[inside]
                rare = k[~hot][:take]
                more = np.flatnonzero(hot)
                more = k[more[np.argsort(times[at[more]], kind="stable")][: take - len(rare)]]
                for is_hot, some, start in ((False, rare, 0), (True, more, len(rare))):
                    if len(some):
                        count = len(some)
                        held[is_hot].append((some, np.full(count, da).view(np.uint64), np.arange(start, start + count).astype(np.uint64), np.full(count, len(h), np.uint64)))
                held_n += take
                if held_n >= HELD:
                    yield deal()
                    held_n = 0
            yield batch(_id=b.column(0), _key=b.column(1), n=sizes, a=das, b=dbs, parts=parts)
        if held_n:
            yield deal()

    kinds = "_id long, _key long, n int, a long, b long, parts array<long>, r int, k binary, e binary, p binary, m binary"
    return own.select("_id", "_key", "_text").mapInArrow(run, kinds)


def _unpacked(pieces: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """``key, node, place, size`` of packed entries."""

    def all_of(name, read, *more):
        return np.concatenate([NONE, *[read(x, *more) for x in pieces[name].to_pylist()]])

    return all_of("k", unpack_sorted, KEY_BYTES), all_of("e", unpack, 8), all_of("p", unpack, 4), all_of("m", unpack, 4)


LIST = "g long, cid long, n int, pos int, c_cid long, c_n int, c_pos int"


def lists(entries: DataFrame) -> DataFrame:
    """``g, cid, n, pos, c_cid, c_n, c_pos``: the classes that share a prefix
    shingle with another one, each with the centre of its list: the class in
    whose order the shingle comes first, which has the fewest rarer ones, so
    that of copies with changes it is the one with the fewest changes.

    Rare shingles are met range by range, packed; no list of theirs is longer
    than the bound of rarity. Those of frequent shingles are pre-aggregated to
    their centre and joined back, a join whose hot partitions Spark splits."""

    def listed(pieces: pa.Table) -> pa.Table:
        k, e, p, m = _unpacked(pieces)
        order = np.lexsort((mixed(e), p, k))  # the list's centre comes first
        k, e, p, m = k[order], e[order], p[order], m[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (e[1:] != e[:-1])  # one class from several tasks
        k, e, p, m = k[new], e[new], p[new], m[new]
        head = np.flatnonzero(np.diff(k, prepend=k[0] + np.uint64(1)))
        length = np.diff([*head, len(k)])
        shared = np.repeat(length > 1, length)
        centre = np.repeat(head, length)[shared]
        some = {"g": k[shared], "cid": e[shared], "n": m[shared], "pos": p[shared], "c_cid": e[centre], "c_n": m[centre], "c_pos": p[centre]}
        wide = {c: v.astype(np.uint64).view(np.int64) for c, v in some.items()}
        return pa.table({c: v if c in ("g", "cid", "c_cid") else v.astype(np.int32) for c, v in wide.items()})

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k, e, p, m = (x.view(np.int64) for x in _unpacked(b))
            yield pa.RecordBatch.from_pydict({"g": k, "cid": e, "n": m.astype(np.int32), "pos": p.astype(np.int32), "ord": mixed(e.view(np.uint64)).view(np.int64)})

    packed_ = entries.select("r", "k", "e", "p", "m")
    light = packed_.filter("r >= 0").groupBy("r").applyInArrow(listed, LIST)
    hot = packed_.filter("r < 0").mapInArrow(opened, "g long, cid long, n int, pos int, ord long")
    hot = hot.dropDuplicates(["g", "cid"])
    me = F.struct("pos", "ord", "cid", "n")
    centres = hot.groupBy("g").agg(F.min(me).alias("c"), F.max(me).alias("z")).filter("c.cid != z.cid").select(F.col("g").alias("_g"), "c")
    hot = hot.join(centres, F.col("g") == F.col("_g")).select(
        "g", "cid", "n", "pos", F.col("c.cid").alias("c_cid"), F.col("c.n").alias("c_n"), F.col("c.pos").alias("c_pos")
    )
    return light.unionByName(hot)


def _enough(n: str, m: str) -> Column:
    """The overlap that two sets of these sizes need."""
    return F.ceil((F.col(n) + F.col(m)) * PERCENT / (100 + PERCENT) - 1e-9)


def _may_link(n: str, pos: str, m: str, at: str) -> Column:
    """Length and positional filters, for any shared shingle."""
    length = F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT
    rest = F.least(F.col(n) - F.col(pos), F.col(m) - F.col(at))
    return length & (F.least(pos, at) + rest >= _enough(n, m))


def _alike(n: str, parts: str, m: str, others: str) -> Column:
    """The suffix filter: a part of the hash space where one set has an odd
    number of shingles and the other an even one holds a shingle that only one
    of them has, and similar sets have few of those."""
    odd = F.aggregate(F.zip_with(parts, others, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, d: s + d)
    return F.col(n) + F.col(m) - odd >= 2 * _enough(n, m)


def _suffix_filter(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose sets spread alike over the hash space."""
    side = nodes.select("cid", "n", "parts")
    x = side.select(F.col("cid").alias("_a"), F.col("n").alias("_na"), F.col("parts").alias("_pa"))
    y = side.select(F.col("cid").alias("_b"), F.col("n").alias("_nb"), F.col("parts").alias("_pb"))
    met = pairs.join(x, F.col("a") == F.col("_a")).join(y, F.col("b") == F.col("_b"))
    return met.filter(_alike("_na", "_pa", "_nb", "_pb")).select(*pairs.columns)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, as edges."""
    x = sets.select(F.col("cid").alias("_a"), F.col("sh").alias("_sa"))
    y = sets.select(F.col("cid").alias("_b"), F.col("sh").alias("_sb"))
    joined = pairs.join(x, F.col("a") == F.col("_a")).join(y, F.col("b") == F.col("_b"))
    both = joined.select(
        "a", "b", F.size(F.array_intersect("_sa", "_sb")).alias("o"), (F.size("_sa") + F.size("_sb")).alias("s")
    )
    return both.filter(F.col("o") * 100 >= (F.col("s") - F.col("o")) * PERCENT).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _whole_sets(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cid, sh`` of the classes in ``pairs``, from one document each.

    Only these classes' texts are hashed again. Of rows that repeat id and
    text one is taken; that step groups by the join's key, so texts are
    shuffled once, and only those that are needed if the classes are few."""
    need = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    who = nodes.select("cid", "id", "tk").join(need, F.col("cid") == F.col("c"))
    # Null ids get a key of their own, so that the join is on plain columns.
    number = lambda c: F.coalesce(c, F.lit(0))
    hashed = lambda c, k: F.xxhash64(c.isNull(), k)
    need = who = stored(who.select("cid", number(F.col("id")).alias("w1"), hashed(F.col("id"), F.col("tk")).alias("w2")), "jaccard-need")
    doc = F.col(id_col).cast("long")
    text = docs.select(
        number(doc).alias("t1"), hashed(doc, text_key(F.col(text_col))).alias("t2"), F.col(text_col).alias("text")
    )
    if who.count() <= FEW_CLASSES:
        who = F.broadcast(who)
    met = text.join(who, (F.col("t1") == F.col("w1")) & (F.col("t2") == F.col("w2")))
    one = met.groupBy("t1", "t2", "cid").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py() or b"", SHINGLE).view(np.int64) for t in b.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["cid", "sh"])

    out = stored(one.select("cid", "text").mapInArrow(run, "cid long, sh array<long>"), "jaccard-sets")
    discard(need)
    return out


def _labelled(rows: DataFrame, label: DataFrame, cid: str, name: str) -> DataFrame:
    """``rows`` with the component of ``cid`` as ``name``."""
    of = label.select(F.col("u").alias("_u"), F.col("v").alias("_v"))
    return rows.join(of, F.col(cid) == F.col("_u"), "left").withColumn(name, F.coalesce("_v", cid)).drop("_u", "_v")


def links(met: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Edges (u, v) between classes that connect all that are similar, given
    the lists."""
    stars = (
        met.filter(F.col("cid") != F.col("c_cid"))
        .filter(_may_link("n", "pos", "c_n", "c_pos"))
        .groupBy(F.col("cid").alias("a"), F.col("c_cid").alias("b"))
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    stars = stored(_suffix_filter(stars, nodes), "jaccard-stars")
    best = stars.groupBy("a").agg(F.max(F.struct("shared", "b"))["b"].alias("b"))
    sets = _whole_sets(stars, nodes, docs, id_col, text_col)
    edges = stored(_verified(best, sets), "jaccard-edges")
    label = components(edges, "jaccard-labels")

    # The other centres, where they would join two components.
    open_ = _labelled(_labelled(stars.join(best, ["a", "b"], "left_anti"), label, "a", "_la"), label, "b", "_lb")
    edges = edges.unionByName(stored(_verified(open_.filter("_la != _lb").select("a", "b"), sets), "jaccard-edges"))
    discard(sets, label)
    label = components(edges, "jaccard-labels")

    # Every pair of a list that is still in two components; of a list of two
    # the pair has been tried. Of a linked pair, the smaller set shares a
    # shingle of its first few.
    here = _labelled(met.select("g", "cid", "n", "pos"), label, "cid", "comp")
    mixed_ = here.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("k"))
    mixed_ = mixed_.filter("lo != hi AND k > 2").select(F.col("g").alias("_g"))
    here = here.join(mixed_, F.col("g") == F.col("_g"), "left_semi")
    side = nodes.select(F.col("cid").alias("_c"), "parts")
    here = stored(here.join(side, F.col("cid") == F.col("_c")).drop("_c"), "jaccard-open")
    x = here.select("g", *[F.col(c).alias(f"x_{c}") for c in ("cid", "n", "pos", "comp", "parts")])
    y = here.select(F.col("g").alias("h"), *[F.col(c).alias(f"y_{c}") for c in ("cid", "n", "pos", "comp", "parts")])
    smaller = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_cid") < F.col("y_cid")))
    index = F.col("x_n") - F.ceil(F.col("x_n") * (2 * PERCENT) / (100 + PERCENT) - 1e-9) + 1
    rest = (
        x.join(y, (F.col("g") == F.col("h")) & (F.col("x_comp") != F.col("y_comp")) & smaller
               & (F.col("x_pos") < index) & _may_link("x_n", "x_pos", "y_n", "y_pos") & _alike("x_n", "x_parts", "y_n", "y_parts"))
        .select(F.col("x_cid").alias("a"), F.col("y_cid").alias("b"))
        .distinct()
    )
    done = stars.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    rest = rest.join(done, (F.least("a", "b") == F.col("lo")) & (F.greatest("a", "b") == F.col("hi")), "left_anti")
    rest = stored(rest, "jaccard-rest")
    discard(here, stars, label)
    if not rest.isEmpty():
        sets = _whole_sets(rest, nodes, docs, id_col, text_col)
        edges = edges.unionByName(stored(_verified(rest, sets), "jaccard-edges"))
        discard(sets)
    discard(rest)
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col, n_shingles, component_id``, and
    ``text_key`` and ``node``, a hash of the text and the component's own
    number (two components can have one smallest id if texts share ids).

    ``component_id`` is the smallest id among the documents reachable by links
    (a null id is passed over while there is another). Null and empty texts
    and texts without words have an empty set and are their own component.
    Repeated rows, and different texts with one id, are linked like any other
    documents. An empty table gives an empty result; other columns are
    ignored; texts of any length are read whole."""
    own = docs.select(F.col(id_col).cast("long").alias("_id"), text_key(F.col(text_col)).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    made = stored(prefixes(own, frequent(own)), "jaccard-prefixes")
    rows = stored(made.filter("r IS NULL").select("_id", "_key", F.col("n").cast("long").alias("n_shingles"), "n", "a", "b", "parts"), "jaccard-rows")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_key").alias("tk")))
    classes = rows.filter("n > 0").groupBy("a", "b").agg(first.alias("doc"), F.first("n").alias("n"), F.first("parts").alias("parts"))
    nodes = stored(classes.select(F.col("a").alias("cid"), F.col("b").alias("db"), "doc.id", "doc.tk", "n", "parts"), "jaccard-classes")
    met = stored(lists(made.filter("r IS NOT NULL")), "jaccard-lists")
    discard(made)
    label = components(links(met, nodes, docs, id_col, text_col), "jaccard-labels")
    discard(met)
    named = _labelled(nodes.select("cid", "db", "id"), label, "cid", "comp")
    least = named.groupBy("comp").agg(F.min("id").alias("component_id")).withColumnRenamed("comp", "_comp")
    of_class = named.join(least, F.col("comp") == F.col("_comp")).select("cid", "db", "comp", "component_id")
    found = rows.join(of_class, (F.col("a") == F.col("cid")) & (F.col("b") == F.col("db")), "left")
    return found.select(
        F.col("_id").alias(id_col), "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
        F.col("_key").alias("text_key"), F.col("comp").alias("node"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the row with its smallest id, and of
    rows that share that id the one with the smallest text hash; all its
    columns. Documents without words stay."""
    judged = near_duplicates(docs, id_col, text_col)
    chosen = stored(
        judged.filter("n_shingles > 0")
        .groupBy(F.col(id_col), "text_key", "node")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy("node")
        .agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_key", "_rows")).alias("best"))
        .select(F.col("best.id").alias("_best"), F.col("best.text_key").alias("_best_key"), F.col("best._rows").alias("_rows")),
        "jaccard-chosen",
    )
    bare = ~F.coalesce(F.col(text_col), F.lit("")).rlike(f"[^{SPACE_CLASS}]")
    rows = packed(docs, id=F.col(id_col).cast("long"), key=text_key(F.col(text_col)), bare=bare)
    same = F.col("id").eqNullSafe(F.col("_best")) & (F.col("key") == F.col("_best_key"))
    kept = rows.join(chosen, same, "left").filter((F.col("_rows") == 1) | F.col("bare"))
    # Rows that repeat id and text: few tables have any, and then not many.
    again = stored(chosen.filter("_rows > 1"), "jaccard-repeated")
    one = rows.join(again, same).dropDuplicates(["_best", "_best_key"])
    return unpacked(kept.select("row").unionByName(one.select("row")), docs.columns)
