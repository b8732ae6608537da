"""Exact substring deduplication by a distributed, hash-compared suffix sort.

Every byte covered by a string of some length (``LENGTH`` bytes) that also starts elsewhere
goes. Of each such string one anchor is chosen by its content alone: the
leftmost of its runs of a third of that length with the smallest hash. Equal strings have
equal anchors at equal offsets, so only stretches around anchors whose run
occurs twice have to meet. Stretches that are equal as a whole are counted by
digest. The others that share an anchor are compared as suffixes: mergesorts
to the right and to the left of the anchor, comparing by prefix polynomial
hashes and binary search for the common extension, each found extension
verified on the bytes. From the sorted orders follow the offsets at which a
stretch's strings occur in another one, without going through pairs.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import claim, discard, packed, stored, text_key, unpacked

LENGTH = 400
#: Bytes of a text that are looked at together; stretches may end there.
BLOCK = 1 << 20
#: Stretches of one anchor that are sorted in one task (12 MB of bytes);
#: beyond it they are dealt out and meet again by digest.
GROUP = 20_000
#: Bytes of stretches a sorting task takes, about.
BUCKET_BYTES = 16 << 20
#: Documents that are cut together.
CUT_ROWS = 1000

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 .. n - 1, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        one = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            up = np.concatenate([one, np.multiply.accumulate(np.full(size - 1, BASE, np.uint64))])
            down = np.concatenate([one, np.multiply.accumulate(np.full(size - 1, BASE_INVERSE, np.uint64))])
        _POWERS[:] = [up, down]
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hashes(data: bytes) -> np.ndarray:
    """Polynomial hash of each prefix, modulo 2 ** 64."""
    s = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    out = np.zeros(len(s) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(s * _powers(max(1, len(s)))[0][: len(s)], out=out[1:])
    return out


def anchors(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, bytes, int, int, int]]:
    """``run hash, digest of the stretch, anchor, first, last``: strings of
    ``length`` bytes that start at first .. last have this anchor; the stretch is
    all their bytes."""
    gram = length * 8 // 25
    width = length - gram + 1
    for block in range(0, max(0, len(data) - length + 1), BLOCK):
        part = data[block : block + BLOCK + length - 1]
        n = len(part) - gram + 1
        p = prefix_hashes(part)
        with np.errstate(over="ignore"):
            h = (p[gram:] - p[:-gram]) * _powers(len(part))[1][:n]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        # Smallest hash and then leftmost, of each run of ``width`` starts.
        key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        low, span = key, 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[: n - width + 1], low[width - span : width - span + n - width + 1])
        at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(at)) + 1
        firsts = np.concatenate([[0], cuts]).tolist()
        lasts = np.concatenate([cuts - 1, [len(at) - 1]]).tolist()
        for first, last in zip(firsts, lasts, strict=True):
            a = int(at[first])
            digest = xxhash.xxh3_128_digest(part[first : last + length], seed=a - first)
            yield int(h[a]) - (1 << 63), digest, block + a, block + first, block + last


class Stretches:
    """Stretches of one anchor, compared by hashes of their prefixes."""

    def __init__(self, data: list[bytes], anchor: list[int], length: int = LENGTH):
        self.data, self.anchor, self.length = data, anchor, length
        self.prefix = [memoryview(prefix_hashes(d)) for d in data]
        self.power = _powers(max(map(len, data), default=0) + 1)[0].tolist()

    def _same(self, i: int, a: int, j: int, b: int, n: int) -> bool:
        p, q = self.prefix[i], self.prefix[j]
        x, y = (p[a + n] - p[a]) & MASK, (q[b + n] - q[b]) & MASK
        return x * self.power[b - a] & MASK == y if b >= a else y * self.power[a - b] & MASK == x

    def right(self, i: int, j: int) -> int:
        """Common bytes of two stretches from the anchor on."""
        a, b = self.anchor[i], self.anchor[j]
        low, high = 0, min(len(self.data[i]) - a, len(self.data[j]) - b)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self._same(i, a, j, b, mid) else (low, mid - 1)
        if self.data[i][a : a + low] != self.data[j][b : b + low]:  # equal hashes of different bytes
            x, y = self.data[i][a:], self.data[j][b:]
            low = next(k for k in range(low) if x[k] != y[k])
        return low

    def left(self, i: int, j: int) -> int:
        """Common bytes of two stretches that end just before the anchor."""
        a, b = self.anchor[i], self.anchor[j]
        low, high = 0, min(a, b)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self._same(i, a - mid, j, b - mid, mid) else (low, mid - 1)
        if self.data[i][a - low : a] != self.data[j][b - low : b]:
            x, y = self.data[i][:a][::-1], self.data[j][:b][::-1]
            low = next(k for k in range(low) if x[k] != y[k])
        return low

    def by_right(self, i: int, j: int) -> int:
        n = self.right(i, j)
        a, b = self.data[i], self.data[j]
        x, y = self.anchor[i] + n, self.anchor[j] + n
        return (a[x] if x < len(a) else -1) - (b[y] if y < len(b) else -1)

    def by_left(self, i: int, j: int) -> int:
        n = self.left(i, j)
        x, y = self.anchor[i] - n - 1, self.anchor[j] - n - 1
        return (self.data[i][x] if x >= 0 else -1) - (self.data[j][y] if y >= 0 else -1)

    def offsets(self) -> list[list[tuple[int, int]]]:
        """Per stretch the intervals of offsets before the anchor at which its
        string of ``length`` bytes occurs in another stretch too.

        A string that starts ``l`` bytes before the anchor is shared by two
        stretches if their left extension is at least ``l`` and their right one
        at least ``length - l``. Neighbours in right order are joined from the
        longest extension down; a joined run is kept in left order, where the
        longest left extension is that of a neighbour."""
        n = len(self.data)
        out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        if n < 2:
            return out
        order = sorted(range(n), key=cmp_to_key(self.by_right))
        place = [0] * n
        for r, i in enumerate(sorted(range(n), key=cmp_to_key(self.by_left))):
            place[i] = r
        at = {r: i for i, r in enumerate(place)}
        common = [self.right(order[k], order[k + 1]) for k in range(n - 1)]
        run_of = list(range(n))
        runs = [[place[i]] for i in range(n)]

        def note(i: int, j: int, reach: int) -> None:
            left = self.left(i, j)
            if left >= self.length - reach:
                out[i].append((self.length - reach, left))
                out[j].append((self.length - reach, left))

        def top(r: int) -> int:
            while run_of[r] != r:
                run_of[r] = run_of[run_of[r]]
                r = run_of[r]
            return r

        for k in sorted(range(n - 1), key=lambda k: -common[k]):
            x, y = top(order[k]), top(order[k + 1])
            if len(runs[x]) < len(runs[y]):
                x, y = y, x
            big = runs[x]
            for r in runs[y]:
                pos = bisect_left(big, r)
                if pos < len(big):
                    note(at[r], at[big[pos]], common[k])
                if pos:
                    note(at[r], at[big[pos - 1]], common[k])
                big.insert(pos, r)
            runs[y] = []
            run_of[y] = x
        return out


MARK = "id long, key long, first int, last int"
_MARK = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def _find_anchors(docs: DataFrame, length: int) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("run", pa.int64()), ("da", pa.int64()), ("db", pa.int64()),
                        ("anchor", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("suffix")
        for b in batches:
            rows: list[tuple] = []
            for doc, key, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if text and len(text) * 4 >= length:
                    found = anchors(text.encode("utf-8", "surrogatepass"), length)
                    rows += [(doc, key, run, *struct.unpack("<qq", d), a, f, z) for run, d, a, f, z in found]
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select("id", "key", "text").mapInArrow(
        find, "id long, key long, run long, da long, db long, anchor int, first int, last int"
    )


def _cut_stretches(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``run, part, id, key, anchor, first, last, bytes`` of the ``wanted``
    stretches; a document's are gathered first, then met by its text once."""
    per_doc = wanted.groupBy("id", "key").agg(F.collect_list(F.struct("run", "part", "anchor", "first", "last")).alias("stretches"))
    per_doc = per_doc.withColumnsRenamed({"id": "_id", "key": "_key"})
    # Rows that repeat id and text hold the same bytes; each gives them, and
    # one copy goes on.
    met = docs.join(per_doc, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select("id", "key", "text", "stretches")
    schema = pa.schema([("run", pa.int64()), ("part", pa.int32()), ("id", pa.int64()), ("key", pa.int64()), ("anchor", pa.int32()),
                        ("first", pa.int32()), ("last", pa.int32()), ("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, key, text, stretches in zip(*[c.to_pylist() for c in b.columns], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                rows = [{**s, "id": doc, "key": key, "bytes": raw[s["first"] : s["last"] + length]} for s in stretches]
                yield pa.RecordBatch.from_pylist(rows, schema)

    out = met.mapInArrow(cut, "run long, part int, id long, key long, anchor int, first int, last int, bytes binary")
    return out


def _sort_group(rows: list[dict], length: int) -> Iterator[tuple]:
    """Marks of one anchor's stretches: the starts of shared strings."""
    distinct = {(r["id"], r["key"], r["first"]): r for r in rows}
    rows = list(distinct.values())
    s = Stretches([r["bytes"] for r in rows], [r["anchor"] - r["first"] for r in rows], length)
    for r, intervals in zip(rows, s.offsets(), strict=True):
        for low, high in intervals:
            first, last = max(r["first"], r["anchor"] - high), min(r["last"], r["anchor"] - low)
            if first <= last:
                yield r["id"], r["key"], first, last


def _sort_stretches(stretches: DataFrame, length: int) -> DataFrame:
    """Marks found by sorting; groups of a run and part are taken one by one
    as they come, sorted by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[list[dict]]:
            now, held = None, []
            for b in batches:
                for r in b.to_pylist():
                    if (r["run"], r["part"]) != now:
                        if len(held) > 1:
                            yield held
                        now, held = (r["run"], r["part"]), []
                    held.append(r)
            if len(held) > 1:
                yield held

        found: list[tuple] = []
        for g in groups():
            found += _sort_group(g, length)
            if len(found) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _MARK, strict=True)], schema=_MARK)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _MARK, strict=True)], schema=_MARK)

    return stretches.mapInArrow(run, MARK)


def _across_parts(stretches: DataFrame, length: int) -> DataFrame:
    """Marks of the strings that the parts of one huge group share: by digest
    of each string, counted map-side first."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("da", pa.int64()), ("db", pa.int64()), *_MARK])
        for b in batches:
            for r in b.to_pylist():
                rows = []
                for start in range(r["first"], r["last"] + 1):
                    at = start - r["first"]
                    da, db = struct.unpack("<qq", xxhash.xxh3_128_digest(r["bytes"][at : at + length]))
                    rows.append((da, db, r["id"], r["key"], start, start))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    strings = stretches.mapInArrow(each, "da long, db long, " + MARK).distinct()
    often = strings.groupBy("da", "db").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("da").alias("_da"), F.col("db").alias("_db"))
    return strings.join(often, (F.col("da") == F.col("_da")) & (F.col("db") == F.col("_db"))).select("id", "key", "first", "last")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))


def marks(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """``id, key, first, last``: starts of the strings of ``length`` bytes
    that occur twice."""
    found = _find_anchors(keyed, length)
    # Runs that occur once are most of all; two digests per run tell whether
    # all its stretches are equal.
    runs = found.groupBy("run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("da", "db")).alias("lo"), F.max(F.struct("da", "db")).alias("hi")
    ).filter("n > 1").select(F.col("run").alias("_run"), (F.col("lo") != F.col("hi")).alias("mixed"))
    # Written first: the join below is then one of two plain tables, whose
    # hot runs Spark can split over tasks.
    runs = stored(runs, "suffix-runs")
    twice = stored(found.join(runs, F.col("run") == F.col("_run")).drop("_run"), "suffix-anchors")
    whole = twice.filter("NOT mixed").select("id", "key", "first", "last")
    mixed = twice.filter("mixed")
    by = ["run", "da", "db"]
    kinds = stored(
        mixed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "anchor", "first", "last")).alias("s")),
        "suffix-kinds",
    )
    often = kinds.filter("n > 1").select(*[F.col(c).alias(f"_{c}") for c in by])
    equal = mixed.join(often, (F.col("run") == F.col("_run")) & (F.col("da") == F.col("_da")) & (F.col("db") == F.col("_db")))
    equal = equal.select("id", "key", "first", "last")

    # One stretch of each kind meets the others of its run.
    large = stored(
        kinds.groupBy(F.col("run").alias("_run")).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > GROUP), "suffix-large"
    )
    dealt = kinds.join(large, F.col("run") == F.col("_run"), "left").select(
        "run", F.when(F.col("k").isNotNull(), F.pmod("da", F.ceil(F.col("k") / GROUP)) + 1).otherwise(0).cast("int").alias("part"), "s.*"
    )
    totals = kinds.agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    buckets = max(1, -(-totals * 2 * length // BUCKET_BYTES))
    cut = _cut_stretches(keyed, dealt, length)
    small = cut.repartition(buckets, "run", "part").sortWithinPartitions("run", "part")
    out = whole.unionByName(equal).unionByName(_sort_stretches(small, length))
    # Only groups beyond GROUP were dealt out.
    if not large.isEmpty():
        out = out.unionByName(_across_parts(_cut_stretches(keyed, dealt.filter("part > 0"), length), length))
    out = stored(out.distinct(), "suffix-marks")
    discard(runs, twice, kinds, large)
    return out


def _cut_out(raw: bytes, starts: list[tuple[int, int]], length: int = LENGTH, least_words: int = 0) -> tuple[list[bytes], int, int]:
    """What is left of ``raw`` without the runs that the strings cover, and
    how many bytes and runs went. Runs of fewer words stay."""
    runs: list[list[int]] = []
    for first, last in sorted(starts):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + length)
        else:
            runs.append([first, last + length])
    runs = [r for r in runs if len(raw[r[0] : r[1]].split()) >= least_words]
    bounds = [0, *[x for r in runs for x in r], len(raw)]
    kept = [raw[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)]
    return kept, sum(b - a for a, b in runs), len(runs)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``id_col, n_bytes, n_removed, n_spans,
    kept_sha256`` of its text as UTF-8 and, if asked for, ``kept``, the bytes
    that are left, ``kept_text``, these as text, in which a character that
    loses some of its bytes goes whole, and ``text_key``.

    Null text is empty; texts under ``length`` bytes lose nothing. Matches stay
    within a document. Strings are judged on the input: all copies go, the
    first one too. Repeated rows are copies of each other; null ids are ids;
    other columns are ignored; an empty table gives an empty result."""
    keyed = _keyed(docs, id_col, text_col)
    starts = (
        marks(keyed, length).groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("starts"))
        .withColumnsRenamed({"id": "_id", "key": "_key"})
    )
    met = keyed.join(starts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left").select("id", "key", "text", "starts")
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.binary()), ("kept_text", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(k, CUT_ROWS) for b in batches for k in range(0, b.num_rows, CUT_ROWS)):
            rows = []
            for doc, key, text, found in zip(*[c.to_pylist() for c in b.columns], strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                parts, removed, spans = _cut_out(raw, [(s["first"], s["last"]) for s in found or ()], length)
                left = b"".join(parts)
                texts = (left, "".join(p.decode("utf-8", "ignore") for p in parts)) if with_text else (None, None)
                rows.append((doc, key, len(raw), removed, spans, hashlib.sha256(left).hexdigest(), *texts))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    out = met.mapInArrow(cut, "id long, key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string")
    named = out.withColumnRenamed("id", id_col).withColumnRenamed("key", "text_key")
    return named if with_text else named.drop("kept", "kept_text", "text_key")


def remove_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
                      length: int = LENGTH, least_words: int = 0) -> DataFrame:
    """``docs`` with the runs covered by repeated strings of ``length`` bytes
    cut out of ``text_col``, if they have ``least_words`` words (parts of words
    at their ends count): a character that loses some of its bytes goes whole. ``length_col`` gets the new
    number of characters of the texts that changed. Documents of which nothing
    is left go; those that came empty stay, as do all other columns."""
    keyed = _keyed(docs, id_col, text_col)
    starts = (
        marks(keyed, length).groupBy("id", "key").agg(F.collect_list(F.struct("first", "last")).alias("_starts"))
        .withColumnsRenamed({"id": "_id", "key": "_key"})
    )
    rows = packed(docs, id=F.col(id_col).cast("long"), key=text_key(F.col(text_col)), text=F.col(text_col))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    met = rows.join(starts, same, "left").select("row", "text", "_starts")
    row_type = met.schema["row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, keep = [], []
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if found:
                    raw = text.encode("utf-8", "surrogatepass")
                    left = _cut_out(raw, [(s["first"], s["last"]) for s in found], length, least_words)[0]
                    text = "".join(p.decode("utf-8", "ignore") for p in left)
                texts.append(text)
                keep.append(bool(text) or not found)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(keep, pa.bool_())], ["row", "_cut", "_keep"])

    out = met.mapInArrow(cut, f"row {row_type}, _cut string, _keep boolean").filter("_keep")
    new = {text_col: F.col("_cut")}
    if length_col:
        changed = ~F.col("_cut").eqNullSafe(F.col("row")[text_col])
        number = F.char_length("_cut").cast(docs.schema[length_col].dataType)
        new[length_col] = F.when(changed, number).otherwise(F.col("row")[length_col])
    return unpacked(out, docs.columns, **new)
