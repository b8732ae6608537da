"""Quality rules whose limits come from the data.

Each document gets a few counts. Their ratios are gathered, per language and
source, in a quantile sketch: counts of documents by bucket, with buckets
whose width is at most 1/16 of their value. Sketches merge by adding counts,
exactly and in any order, so a group's sketch is built map-side first, a
language's is the sum of its sources' and the corpus' the sum of all. A
document is rejected if it fails the base rules, or if a ratio lies beyond
the fence of its group: the upper quartile plus ``FENCE`` times the spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import SPACE_CLASS, bind, packed, stored, text_key, unpacked, words

#: Base rules.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8

#: Spreads above the upper quartile (below the lower one) that are allowed.
FENCE = 3

#: A group with fewer documents than this takes its language's limits, a
#: language with fewer the corpus'.
MIN_GROUP = 200

#: Ratio -> least spread, in the ratio's units: a group whose documents all
#: agree still leaves room for an unusual but clean one.
RATIOS = {
    "symbols_pm": 60,  # symbols per 1000 characters of words
    "dup_lines_pm": 100,  # repeated lines per 1000 lines
    "repeats_pm": 60,  # words in repeated windows per 1000 words
    "word_len_pc": 150,  # characters per 100 words
}
LOW_FENCE = ("word_len_pc",)


def _repeated_words(w: Column) -> Column:
    """Words covered by 8-word windows found twice or more.

    Windows are compared by a 64-bit hash within one document. Only a document
    with two equal windows pays for the sort that finds which ones."""
    def hashes(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(v) - WINDOW)
        return F.when(
            F.size(v) > WINDOW,
            F.transform(starts, lambda i: F.xxhash64(*[F.get(v, i + k) for k in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        ranked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

        def starts(r: Column) -> Column:
            last = F.size(r) - 1
            twin = F.filter(
                r,
                lambda x, i: ((i > 0) & (F.get(r, i - 1)["h"] == x["h"]))
                | ((i < last) & (F.get(r, i + 1)["h"] == x["h"])),
            )
            return F.array_sort(F.transform(twin, lambda x: x["at"]))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            bind(ranked, starts),
            zero,
            lambda acc, s: F.struct(
                (s + WINDOW).alias("end"), (acc["n"] + s + WINDOW - F.greatest(acc["end"], s)).alias("n")
            ),
            lambda acc: acc["n"],
        )

    each = bind(F.transform(w, lambda x: F.xxhash64(x)), hashes)
    return bind(
        each,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)),
    )


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of each whole text instead of the text: the
    structs ``of_words (n_words, word_chars, n_repeat_words)`` and ``of_lines
    (n_lines, n_dup_lines)`` and ``n_symbols``. Null and empty texts count 0
    throughout. Write the result before taking the structs apart: a
    projection on top would evaluate a struct once for each of its fields."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    return docs.select(
        *[F.col(c) for c in docs.columns if c != text_col],
        bind(
            words(F.col(text_col), SPACE_CLASS),
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_words"),
                F.char_length(F.array_join(x, "")).cast("long").alias("word_chars"),
                _repeated_words(x).alias("n_repeat_words"),
            ),
        ).alias("of_words"),
        bind(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("of_lines"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)


def _per(top: str, bottom: str, unit: int) -> Column:
    """Whole units of ``top`` per ``bottom``; 0 where there is nothing."""
    return F.when(F.col(bottom) > 0, F.floor(F.col(top) * unit / F.col(bottom))).otherwise(F.lit(0)).cast("long")


def ratios(measured: DataFrame) -> DataFrame:
    return measured.withColumns(
        {
            "symbols_pm": _per("n_symbols", "word_chars", 1000),
            "dup_lines_pm": _per("n_dup_lines", "n_lines", 1000),
            "repeats_pm": _per("n_repeat_words", "n_words", 1000),
            "word_len_pc": _per("word_chars", "n_words", 100),
        }
    )


def bucket(value: Column) -> Column:
    """The lower end of the value's bucket: values below 32 have their own,
    larger ones keep their five leading binary digits."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    step = F.pow(F.lit(2), shift).cast("long")
    return value - value % step


def sketch(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Mergeable sketches: ``*groups, ratio, at, n`` (documents by bucket)."""
    each = F.array(*[F.struct(F.lit(r).alias("ratio"), bucket(F.col(r)).alias("at")) for r in RATIOS])
    return (
        measured.select(*groups, F.explode(each).alias("b"))
        .groupBy(*groups, F.col("b.ratio").alias("ratio"), F.col("b.at").alias("at"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """The sketches summed to coarser ``groups``."""
    return sketches.groupBy(*groups, "ratio", "at").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """``*groups, ratio, docs, q25, q75`` of each sketch: the bucket in which
    the ranked documents reach a quarter and three quarters. A group has as
    many rows as buckets, some hundreds whatever its documents."""
    cells = F.array_sort(F.collect_list(F.struct("at", "n")))
    got = sketches.groupBy(*groups, "ratio").agg(F.sum("n").alias("docs"), cells.alias("cells"))

    def reach(quarter: int) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
        return F.aggregate(
            F.col("cells"),
            zero,
            lambda acc, c: F.struct(
                (acc["seen"] + c["n"]).alias("seen"),
                F.when(acc["at"].isNull() & ((acc["seen"] + c["n"]) * 4 >= F.col("docs") * quarter), c["at"])
                .otherwise(acc["at"])
                .alias("at"),
            ),
            lambda acc: acc["at"],
        )

    return got.select(*groups, "ratio", "docs", reach(1).alias("q25"), reach(3).alias("q75"))


def limits(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang_col, source_col`` with a low and a high limit for each ratio.

    Only documents that pass the base rules are in the sketches. Null
    languages and sources are groups of their own."""
    groups = [lang_col, source_col]
    fine = sketch(measured.filter(~base_failed()), groups)
    spread = F.create_map(*[F.lit(x) for kv in RATIOS.items() for x in kv])[F.col("ratio")]

    def fences(sketches: DataFrame, by: list[str], name: str) -> DataFrame:
        q = quantiles(sketches, by)
        s = F.greatest(F.col("q75") - F.col("q25"), spread) * FENCE
        return q.select(
            *[F.col(c).alias(f"{name}_{c}") for c in by],
            F.col("ratio").alias(f"{name}_ratio"),
            F.col("docs").alias(f"{name}_docs"),
            (F.col("q25") - s).alias(f"{name}_low"),
            (F.col("q75") + s).alias(f"{name}_high"),
        )

    own = fences(fine, groups, "g")
    lang = fences(merge(fine, [lang_col]), [lang_col], "l")
    every = fences(merge(fine, []), [], "a")
    both = own.join(
        lang, F.col(f"g_{lang_col}").eqNullSafe(F.col(f"l_{lang_col}")) & (F.col("g_ratio") == F.col("l_ratio"))
    ).join(every, F.col("g_ratio") == F.col("a_ratio"))

    def pick(side: str) -> Column:
        return (
            F.when(F.col("g_docs") >= MIN_GROUP, F.col(f"g_{side}"))
            .when(F.col("l_docs") >= MIN_GROUP, F.col(f"l_{side}"))
            .otherwise(F.col(f"a_{side}"))
        )

    chosen = both.select(
        F.col(f"g_{lang_col}").alias("lim_lang"), F.col(f"g_{source_col}").alias("lim_source"),
        F.col("g_ratio").alias("ratio"), pick("low").alias("low"), pick("high").alias("high"),
    )
    return chosen.groupBy("lim_lang", "lim_source").agg(
        *[F.max(F.when(F.col("ratio") == r, F.col("high"))).alias(f"{r}_high") for r in RATIOS],
        *[F.max(F.when(F.col("ratio") == r, F.col("low"))).alias(f"{r}_low") for r in LOW_FENCE],
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: ``id_col, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept``, the four ratios and
    ``text_key``, a hash of the text.

    Null text counts as no words and fails; null language or source is a
    group like any other; repeated rows are judged, and counted in the
    sketches, one by one; an empty table gives an empty result. Other columns
    are ignored. Texts are read once: their counts are written to the shared
    scratch folder, and sketches and limits work on those."""
    own = docs.select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"),
        text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("_text"),
    )
    counted = stored(measure(own, "_text"), "quality")
    measured = ratios(counted.select("*", "of_words.*", "of_lines.*").drop("of_words", "of_lines"))
    lim = limits(measured, "_lang", "_source")
    # The sketches have a few hundred rows per group, the limits one: written,
    # so that the join below knows their size and picks its way by it.
    lim = stored(lim, "quality-limits")
    with_limits = measured.join(
        lim, F.col("_lang").eqNullSafe(F.col("lim_lang")) & F.col("_source").eqNullSafe(F.col("lim_source")), "left"
    )
    beyond = [F.col(r) > F.col(f"{r}_high") for r in RATIOS] + [F.col(r) < F.col(f"{r}_low") for r in LOW_FENCE]
    outlier = F.coalesce(reduce(lambda a, b: a | b, beyond), F.lit(False))
    return with_limits.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~outlier).alias("kept"), *RATIOS, "text_key",
    )


def keep(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    bad = judge(docs, **columns).filter(~F.col("kept")).select(F.col(id_col).alias("_bad"), F.col("text_key").alias("_bad_key"))
    rows = packed(docs, id=F.col(id_col), key=text_key(F.col(text_col)))
    return unpacked(rows.join(bad, F.col("id").eqNullSafe(F.col("_bad")) & (F.col("key") == F.col("_bad_key")), "left_anti"), docs.columns)
