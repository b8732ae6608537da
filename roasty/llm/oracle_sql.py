"""DuckDB SQL for the rows of the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item, w[i : i + least(len(w), 10) - 1] AS gram
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT len(gram) AS n FROM g),
p AS (SELECT r, n, i, w[i : i + n - 1] AS gram
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)),
h AS (SELECT r, i, n, item FROM p JOIN g USING (gram)),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM h) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""

# Limits as in quality.py: window 8, 20 words, 30 %, fence 3, groups of 200.
OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT r, i, array_to_string(w[i : i + 7], ' ') AS gram
          FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM grams) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM d LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbols_pm,
             CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines_pm,
             CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats_pm,
             CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_len_pc
      FROM m),
long_form AS (SELECT r, lang, source, ratio, v, v - v % CAST(pow(2, greatest(length(bin(v)) - 5, 0)) AS BIGINT) AS bucket_at,
                CASE ratio WHEN 'symbols_pm' THEN 60 WHEN 'dup_lines_pm' THEN 100
                           WHEN 'repeats_pm' THEN 60 ELSE 150 END AS least_spread
         FROM (SELECT r, lang, source, base_failed, unnest(['symbols_pm', 'dup_lines_pm', 'repeats_pm', 'word_len_pc']) AS ratio,
                      unnest([symbols_pm, dup_lines_pm, repeats_pm, word_len_pc]) AS v FROM f)
         WHERE NOT base_failed),
ranked AS (
  SELECT 1 AS level, lang, source, ratio, bucket_at, least_spread, count(*) OVER (PARTITION BY lang, source, ratio) AS docs,
         row_number() OVER (PARTITION BY lang, source, ratio ORDER BY bucket_at) AS k FROM long_form
  UNION ALL
  SELECT 2, lang, NULL, ratio, bucket_at, least_spread, count(*) OVER (PARTITION BY lang, ratio),
         row_number() OVER (PARTITION BY lang, ratio ORDER BY bucket_at) FROM long_form
  UNION ALL
  SELECT 3, NULL, NULL, ratio, bucket_at, least_spread, count(*) OVER (PARTITION BY ratio),
         row_number() OVER (PARTITION BY ratio ORDER BY bucket_at) FROM long_form),
q AS (SELECT level, lang, source, ratio, least_spread, max(docs) AS docs,
             min(bucket_at) FILTER (WHERE 4 * k >= docs) AS q25, min(bucket_at) FILTER (WHERE 4 * k >= 3 * docs) AS q75
      FROM ranked GROUP BY ALL),
fence AS (SELECT *, q25 - 3 * greatest(q75 - q25, least_spread) AS low, q75 + 3 * greatest(q75 - q25, least_spread) AS high
          FROM q),
lim AS (SELECT g.lang, g.source, g.ratio,
               CASE WHEN g.docs >= 200 THEN g.low WHEN l.docs >= 200 THEN l.low ELSE a.low END AS low,
               CASE WHEN g.docs >= 200 THEN g.high WHEN l.docs >= 200 THEN l.high ELSE a.high END AS high
        FROM fence g JOIN fence l ON l.level = 2 AND l.lang IS NOT DISTINCT FROM g.lang AND l.ratio = g.ratio
                     JOIN fence a ON a.level = 3 AND a.ratio = g.ratio
        WHERE g.level = 1),
wide AS (SELECT r, lang, source, unnest(['symbols_pm', 'dup_lines_pm', 'repeats_pm', 'word_len_pc']) AS ratio,
                unnest([symbols_pm, dup_lines_pm, repeats_pm, word_len_pc]) AS v FROM f),
odd AS (SELECT DISTINCT r FROM wide JOIN lim ON wide.lang IS NOT DISTINCT FROM lim.lang
          AND wide.source IS NOT DISTINCT FROM lim.source AND wide.ratio = lim.ratio
        WHERE v > high OR (wide.ratio = 'word_len_pc' AND v < low))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND odd.r IS NULL AS kept, symbols_pm, dup_lines_pm, repeats_pm, word_len_pc
FROM f LEFT JOIN odd USING (r)
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS top FROM x WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top IS NULL OR top IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top IS NULL OR top IS NOT DISTINCT FROM page_id THEN NULL ELSE top END AS refers_to
FROM x LEFT JOIN g USING (payload_digest)
"""

OP4 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN c x ON x.r = a JOIN c y ON y.r = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
reach AS (SELECT r, doc_id AS x FROM d UNION SELECT l.b, x FROM reach JOIN l ON l.a = reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN c USING (r) JOIN (SELECT r, min(x) AS component_id FROM reach GROUP BY r) USING (r)
"""

# Centroid clustering and Merkle manifests, built level by level.


def _rounds(rounds=10):
    """The rounds of the clustering, one after the other."""
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""
near{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, k := k)) AS best FROM (
  SELECT v.r, c.k, CAST(v.sq + c.sq - 2 * array_inner_product(v.x, c.x) AS BIGINT) AS d FROM v, c{i} c) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
sums{i} AS (SELECT k, e, sum(w) AS s, count(*) AS n FROM (
  SELECT n.best.k AS k, unnest(v.l) AS w, generate_subscripts(v.l, 1) AS e FROM near{i} n JOIN v USING (r)) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT k, x, array_inner_product(x, x) AS sq FROM (
  SELECT o.k, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN (
    SELECT k, CAST(list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY e) AS DOUBLE[64]) AS x FROM sums{i} GROUP BY k) m USING (k)))""")
    return ",".join(parts)


OP12 = f"""
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS l
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64),
v AS MATERIALIZED (SELECT r, vec_id, l, CAST(l AS DOUBLE[64]) AS x, array_inner_product(CAST(l AS DOUBLE[64]), CAST(l AS DOUBLE[64])) AS sq FROM kept),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), l) - 1 AS k, x, sq FROM v ORDER BY sha256('3:' || vec_id), l LIMIT 8),
{_rounds()},
met AS (SELECT v.vec_id, n.best.k AS k, n.best.d AS d FROM near10 n JOIN v USING (r)),
named AS (SELECT k, sha256(array_to_string(list_transform(CAST(x AS DOUBLE[]), lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ',')) AS sha FROM c10)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM met JOIN named USING (k)
"""


def _tree(name, leaves, levels):
    """Levels of 8-ary trees over ``leaves`` (g, i, h): (g, i, h, n) each, and
    the root of each g. A tree that has one node left has no more levels."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {leaves})"]
    for k in range(1, levels + 1):
        parts.append(
            f"{name}{k} AS MATERIALIZED (SELECT g, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, any_value((n + 7) // 8) AS n "
            f"FROM {name}{k - 1} WHERE n > 1 GROUP BY g, i // 8)"
        )
    roots = " UNION ALL ".join(f"SELECT g, h FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    return ", ".join(parts) + f", {name}_roots AS MATERIALIZED ({roots})"


def _paths(name, levels):
    """``left`` and ``right`` siblings of each node, level by level."""
    parts = []
    for k in range(levels):
        parts.append(
            f"{name}s{k} AS MATERIALIZED (SELECT a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l, "
            f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r "
            f"FROM {name}{k} a JOIN {name}{k} b ON a.g = b.g AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.g, a.i)"
        )
    return ", ".join(parts)


def _folded(source, key, name, levels, proof):
    """``d`` folded through the levels of ``name``; ``proof`` grows."""
    parts = []
    for k in range(levels):
        parts.append(
            f"{source}{k + 1} AS (SELECT t.* REPLACE (CASE WHEN s.l IS NULL THEN t.d ELSE sha256(s.l || t.d || s.r) END AS d, "
            f"t.{proof} || coalesce(s.l || s.r, '') AS {proof}) "
            f"FROM {source}{k} t LEFT JOIN {name}s{k} s ON s.g = t.{key} AND s.i = t.pos // {8 ** k})"
        )
    return ", ".join(parts)


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))), "
    "lambda s, b: xor(s >> 8, crc.t[CAST(xor(s, b) & 255 AS INTEGER) + 1])))"
)


def _step(x, times):
    for _ in range(times):
        x = f"(CASE WHEN {x} & 1 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END)"
    return x


_LEVELS, _OVER = 8, 3
OP13 = (
    "WITH "
    + ", ".join(
        f"crc{k} AS (SELECT list_transform({'range(256)' if k == 0 else 't'}, lambda x: {_step('CAST(x AS UBIGINT)', 1)}) AS t{'' if k == 0 else f' FROM crc{k - 1}'})"
        for k in range(8)
    )
    + ", crc AS MATERIALIZED (SELECT t FROM crc7), "
    + "d AS (SELECT doc_id, lang, "
    + f"sha256({' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))}) AS leaf, "
    + "sha256(" + " || ".join(_FIELD.format(c if c != "text" else "low") for c in ("doc_id", "source", "lang", "n_chars", "text")) + ") AS changed, "
    + f"coalesce({_CRC} % 3 = 0, FALSE) AS tampered FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents), crc), "
    + "langs AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM d)), "
    + "ranked AS MATERIALIZED (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, doc_id, leaf AS h, "
    + "CASE WHEN tampered THEN changed ELSE leaf END AS now FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang), "
    + "leaves AS (SELECT g, pos AS i, h FROM ranked), " + _tree("t", "leaves", _LEVELS) + ", "
    + "subs AS (SELECT 0 AS g, g AS i, h FROM t_roots), " + _tree("o", "subs", _OVER) + ", "
    + _paths("t", _LEVELS) + ", " + _paths("o", _OVER) + ", "
    + "f0 AS (SELECT g, pos, doc_id, h, now AS d, '' AS proof FROM ranked), " + _folded("f", "g", "t", _LEVELS, "proof") + ", "
    + f"u0 AS (SELECT doc_id, h, 0 AS z, g AS pos, d, proof, g FROM f{_LEVELS}), " + _folded("u", "z", "o", _OVER, "proof")
    + f" SELECT doc_id, u.h AS leaf, s.h AS subroot, o.h AS root, sha256(proof) AS proof_sha256, d AS folded_root, d = o.h AS verified "
    + f"FROM u{_OVER} u JOIN t_roots s ON s.g = u.g, o_roots o"
)

ORACLE_SQL = {"op12_centroid_clustering": OP12, "op13_merkle_manifest": OP13, "op4_jaccard_join": OP4, "op10_warc": OP10, "op1_quality_rules": OP1, "op8_benchmark_decontamination": OP8}
