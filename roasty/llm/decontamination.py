"""Benchmark decontamination: training documents that hold benchmark text.

Benchmark items are cut into windows of ``size`` words; the windows, and the
half as long runs in them, form hash tables that every task holds. Documents
are scanned once: of a document's runs, those at every ``size // 2 + 1``-th
start are looked up; the windows around a known run are looked up in turn, and
a hit is verified word by word. Each window holds one of those starts, so no
window is missed. Windows too many for a task are met by shuffle instead: what
moves is then a run's hash, a document's known runs and a window's words,
never a document a run. Items join the windows that were hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import ascii_lower, packed, stored, text_key, unpacked, words

#: Everything but digits, letters and what lies beyond ASCII separates words.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: The same before capitals are lowered.
RAW_SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"

#: Windows of a benchmark that are broadcast, and the bytes they may have as
#: rows; a larger benchmark is joined by shuffle. Their runs are a hash each.
BROADCAST_WINDOWS = 200_000
BROADCAST_BYTES = 64 << 20


def normal_words(text: Column) -> Column:
    return words(ascii_lower(text), SEPARATORS)


def _sampled(w: Column, gram: int, stride: int) -> Column:
    """Hash of the run of ``gram`` words at each ``stride``-th start."""
    return F.when(
        F.size(w) >= gram,
        F.transform(
            F.sequence(F.lit(1), F.size(w) - (gram - 1), F.lit(stride)), lambda i: F.xxhash64(F.slice(w, i, gram))
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per distinct window: ``gram_hash, gram, gram_len, items``."""
    w = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        normal_words(F.col(text_col)).alias("w"),
    ).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(size))
    grams = w.select(
        "item",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice(F.col("w"), i, length))
        ).alias("gram"),
    )
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("gram").alias("gram_hash"), "gram", F.size("gram").alias("gram_len"), "items"
    )


def _measured(grams: DataFrame) -> tuple[DataFrame, DataFrame, list[int], bool]:
    """The windows, ``gram, items`` of them, their lengths, and whether the
    windows are broadcast; each of the two tables is, as far as its bytes
    allow. Windows that are not are written, since several joins read them."""
    # Rows of arrays: eight bytes and the word, rounded up to eight, a word.
    room = lambda c: F.aggregate(c, F.lit(64).cast("long"), lambda n, w: n + 16 + F.octet_length(w))
    # At most ``size`` rows, whatever the benchmark holds.
    lengths = grams.groupBy("gram_len").agg(
        F.count(F.lit(1)).alias("n"), F.sum(room("gram")).alias("words"), F.sum(room("items")).alias("items")
    ).collect()
    total = {c: sum(r[c] for r in lengths) for c in ("n", "words", "items")}
    broadcast = total["n"] <= BROADCAST_WINDOWS and total["words"] <= BROADCAST_BYTES
    grams = grams if broadcast else stored(grams, "benchmark-windows")
    items = grams.select(F.col("gram").alias("_gram"), "items")
    if broadcast and total["words"] + total["items"] <= BROADCAST_BYTES:
        items = F.broadcast(items)
    return grams.drop("items"), items, sorted(r["gram_len"] for r in lengths), broadcast


def _starts(k: Column, words_: Column, stride: int, n: int) -> Column:
    """Starts of the windows that hold the sampled run ``k``."""
    first = F.greatest(k * stride - (stride - 1), F.lit(0))
    last = F.least(k * stride, words_ - n)
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _hits(docs: DataFrame, grams: DataFrame, lengths: list[int], broadcast: bool, text_col: str) -> DataFrame:
    """Verified hits: ``_id, _key, start`` (from 0), ``gram_len, gram``."""
    found = None
    base = docs.select("_id", "_key", normal_words(F.col(text_col)).alias("w"))
    for n in lengths:
        # A window of n words holds exactly one run of ``gram`` words that
        # starts at a multiple of ``stride``: only those runs are hashed, and
        # the windows around a known run are looked up.
        gram = (n + 1) // 2
        stride = n - gram + 1
        side = grams.filter(F.col("gram_len") == n)
        runs = side.select(
            F.explode(
                F.transform(F.sequence(F.lit(1), F.lit(stride)), lambda i: F.xxhash64(F.slice(F.col("gram"), i, gram)))
            ).alias("run")
        ).distinct()
        sampled = F.posexplode(_sampled(F.col("w"), gram, stride)).alias("k", "h")
        if broadcast:
            side, runs = F.broadcast(side), F.broadcast(runs)
            scan = base.select("_id", "_key", "w", sampled)
            candidates = scan.join(runs, F.col("h") == F.col("run"), "left_semi").select(
                "_id", "_key", "w", F.explode(_starts(F.col("k"), F.size("w"), stride, n)).alias("start")
            )
            # Verified by membership, not equality: an equality would become a
            # second join key, built for each window and not for the hits alone.
            window = F.slice(F.col("w"), F.col("start") + 1, n)
            same = F.array_contains(F.array("gram"), window)
            hit = candidates.join(side, (F.xxhash64(window) == F.col("gram_hash")) & same)
        else:
            known = (
                base.select("_id", "_key", sampled).join(runs, F.col("h") == F.col("run"), "left_semi")
                .groupBy(F.col("_id").alias("_kid"), F.col("_key").alias("_kkey")).agg(F.collect_set("k").alias("ks"))
            )
            # The text is met once a document, however many runs are known.
            met = docs.join(
                known, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_key") == F.col("_kkey"))
            ).select("_id", "_key", "ks", normal_words(F.col(text_col)).alias("w"))
            starts = F.flatten(F.transform("ks", lambda k: _starts(k, F.size("w"), stride, n)))
            windows = F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(F.col("w"), s + 1, n).alias("words")))
            candidates = met.select("_id", "_key", F.explode(windows).alias("at")).select(
                "_id", "_key", F.col("at.start").alias("start"), F.col("at.words").alias("words")
            )
            hit = candidates.join(side, (F.xxhash64("words") == F.col("gram_hash")) & (F.col("words") == F.col("gram")))
        hit = hit.select("_id", "_key", "start", "gram_len", "gram")
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        found = docs.select(
            "_id", "_key", F.lit(0).alias("start"), F.lit(0).alias("gram_len"), F.array().cast("array<string>").alias("gram")
        ).filter(F.lit(False))
    return found


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted (start, length) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["gram_len"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["gram_len"] - F.greatest(acc["end"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def score(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document: ``id_col, n_words, n_hit, n_items, items_sha256,
    contaminated, spans``.

    ``spans`` are the sorted (start, gram_len) word windows that were hit.
    Null text has no words; an empty benchmark hits nothing; a null item id
    counts as the id ''. Rows that repeat id and text are each returned, with
    the same result; a null document id is an id. Other columns are ignored,
    whatever their names. A document longer than any buffer is still one row:
    its hits are kept per document, at most one for each of its words."""
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    keyed = own.withColumn("_key", text_key(F.col("_text")))
    grams, items, lengths, broadcast = _measured(benchmark_windows(benchmark, size, item_id_col, item_text_col))
    # A window joins its items once a document, however often it was hit.
    hits = (
        _hits(keyed, grams, lengths, broadcast, "_text")
        .groupBy("_id", "_key", "gram")
        .agg(F.collect_set(F.struct("start", "gram_len")).alias("at"))
        .join(items, F.col("gram") == F.col("_gram"))
        .groupBy("_id", "_key")
        .agg(
            F.array_sort(F.flatten(F.collect_list("at"))).alias("spans"),
            F.collect_set("items").alias("items"),
        )
        .select(
            F.col("_id").alias("_hid"),
            F.col("_key").alias("_hkey"),
            "spans",
            F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        )
    )
    base = keyed.select("_id", "_key", F.size(words(F.col("_text"), RAW_SEPARATORS)).cast("long").alias("n_words"))
    joined = base.join(hits, F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_key") == F.col("_hkey")), "left")
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long"))
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return joined.select(
        F.col("_id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce(F.col("spans"), F.array().cast("array<struct<start:int,gram_len:int>>")).alias("spans"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, mode: str = "documents", size: int = 10, text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", id_col: str | None = "doc_id",
) -> DataFrame:
    """``docs`` without its contaminated documents (``mode='documents'``), or
    with the hit words and the separators after them cut out
    (``mode='spans'``). Columns and other rows stay as they are. What was hit
    is told by ``id_col``, if the table has it, and a hash of the text."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode {mode!r}: 'documents' or 'spans'")
    grams, _, lengths, broadcast = _measured(benchmark_windows(benchmark, size, item_id_col, item_text_col))
    own = F.col(id_col).cast("string") if id_col in docs.columns else F.lit(None).cast("string")
    rows = packed(docs, id=own, key=text_key(F.col(text_col)), text=F.col(text_col))
    keyed = rows.select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("text").alias("_text"))
    found = (
        _hits(keyed, grams, lengths, broadcast, "_text")
        .groupBy(F.col("_id").alias("hit_id"), F.col("_key").alias("hit_key"))
        .agg(F.array_sort(F.collect_set(F.struct("start", "gram_len"))).alias("spans"))
    )
    # Written: few rows, and Spark can see that when it picks the join.
    found = stored(found, "decontamination-hits")
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key"))
    if mode == "documents":
        return unpacked(rows.join(found, same, "left_anti"), docs.columns)
    # Text before the first word, then each word with what follows it.
    parts = F.regexp_extract_all("text", F.lit(f"[^{RAW_SEPARATORS}]+[{RAW_SEPARATORS}]*"), F.lit(0))
    head = F.regexp_extract("text", f"^[{RAW_SEPARATORS}]*", 0)
    kept = F.filter(
        parts, lambda _, i: ~F.exists(F.col("spans"), lambda s: (s["start"] <= i) & (i < s["start"] + s["gram_len"]))
    )
    cut = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(head, F.array_join(kept, "")))
    return unpacked(rows.join(found, same, "left"), docs.columns, **{text_col: cut})
