"""Byte-level BPE, centroid clustering and Merkle manifests, each against a
plain version of its contract."""

import hashlib
import math
import random
import struct
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from roasty.llm import byte_bpe, centroids, merkle

from roasty.llm.oracle_sql import OP12, OP13

from .conftest import CLASHING, TEXTS
from .test_documents import corpus, rows


def by_duckdb(sql, name, columns, data):
    """The SQL's rows over a table of these rows."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE {name} ({columns})")
    if data:
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)
    return sorted(con.execute(sql).fetchall(), key=str)

RANKS = byte_bpe.read_ranks(open(byte_bpe.RANKS_PATH, "rb").read())


def tiktoken_of(ranks, pattern=byte_bpe.PATTERN):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def listed(coded):
    return [np.frombuffer(c, "<u4").tolist() for c in coded]


def brute_bpe(docs):
    lib, out = tiktoken_of(RANKS), []
    for i, t in docs:
        ids = lib.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_pattern_is_the_vocabularys():
    public = pytest.importorskip("public_tokenizers")
    assert byte_bpe.PATTERN == public.PATTERN


def test_bpe_is_the_librarys(monkeypatch):
    lib, merges = tiktoken_of(RANKS), byte_bpe.Merges(RANKS)
    r = random.Random(2)
    texts = ["", " ", "a  b", "\n\n x", "I'll say 's", "<|endoftext|>", "aaaa" * 2000, "日本語" * 300, "\x1c\x85  　é", "1234567890" * 50]
    texts += [t for _, t in corpus()]
    texts += ["".join(chr(r.choice([r.randrange(9, 127), r.randrange(160, 0x2100), r.randrange(0x1F300, 0x1F700)])) for _ in range(300)) for _ in range(60)]
    assert listed(merges.encode_texts(texts)) == lib.encode_ordinary_batch(texts)
    monkeypatch.setattr(byte_bpe, "CORPUS_BYTES", 200)  # many corpora, caches that start anew
    monkeypatch.setattr(byte_bpe, "KEPT_BYTES", 5_000)
    merges = byte_bpe.Merges(RANKS)
    assert listed([merges.encode_texts([t])[0] for t in texts]) == lib.encode_ordinary_batch(texts)


def test_bpe_of_vocabularies_in_any_order():
    """Ranks dealt at random: a merge can bring up pairs of earlier ranks."""
    r = random.Random(5)
    pattern = "[^ ]+| "
    for _ in range(120):
        tokens = {bytes([b]) for b in range(256)}
        tokens |= {bytes(r.choice(b"abc") for _ in range(r.randrange(2, 6))) for _ in range(r.randrange(1, 25))}
        order = sorted(tokens)
        r.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        texts = ["".join(r.choice("aabbc ") for _ in range(40)) for _ in range(5)]
        assert listed(byte_bpe.Merges(ranks, pattern).encode_texts(texts)) == tiktoken_of(ranks, pattern).encode_ordinary_batch(texts)
    with pytest.raises(ValueError, match="single bytes"):
        byte_bpe.Merges({b"a": 0})


def test_bpe_odd_rows(spark, edge_docs, no_docs, monkeypatch):
    assert rows(byte_bpe.digests(edge_docs)) == brute_bpe(TEXTS)
    coded = byte_bpe.encode(edge_docs.withColumns({"ids": F.lit(1), "_value": F.lit("v")}))
    assert set(coded.columns) == {*edge_docs.columns, "ids", "_value"}
    back = byte_bpe.decode(coded).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") and r._row == "_row" and r.cid == "cid" for r in back) and len(back) == len(TEXTS)
    assert byte_bpe.digests(no_docs).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [])], "i long, ids array<int>")
    assert [(r.i, r.decoded) for r in byte_bpe.decode(odd).orderBy("i").collect()] == [(1, None), (2, bytearray())]
    assert CLASHING


# Centroids.


def brute_clusters(table, k=8, rounds=10, size=64):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in table
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [list(v) for _, v in first]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(nearest(v)[0], []).append(v)
        centres = [[sum(x) // len(of[c]) for x in zip(*of[c], strict=True)] if c in of else old for c, old in enumerate(centres)]
    met = [(i, *nearest(v)) for i, v in kept]
    sums = {c: sum(d for _, x, d in met if x == c) for _, c, _ in met}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(i, c, d, sums[c], sum(sums.values()), sha[c]) for i, c, d in met], key=str)


def vectors(n, seed=1, spread=0.3):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(5, 64))
    return [(i, (middles[i % 5] + spread * r.normal(size=64)).astype(np.float32).tolist()) for i in range(n)]


def clustered(spark, table, **more):
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>").withColumns({c: F.lit(c) for c in ("id", "v", "_c", "raw", "cluster")})
    return rows(centroids.clusters(df.repartition(3), **more).drop("centroid"))


@pytest.mark.parametrize("spread", [0.1, 1.0, 0.0])
def test_clusters_against_brute_force(spark, spread):
    table = vectors(150, 3, spread)
    assert clustered(spark, table) == brute_clusters(table)
    assert by_duckdb(OP12, "embeddings", "vec_id BIGINT, embedding FLOAT[]", table) == brute_clusters(table)


def test_clusters_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    table = vectors(12) + [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [nan] + [0.0] * 63), (105, [0.0] * 63 + [inf]),
                           (106, [None] + [0.0] * 63), (107, [-inf] * 64), (None, [0.5] * 64), (3, [0.25] * 64), (3, [0.25] * 64)]
    assert clustered(spark, table) == brute_clusters(table)
    assert clustered(spark, vectors(3)) == brute_clusters(vectors(3))  # fewer than centroids
    assert clustered(spark, [(1, None)]) == []
    same = [(i, [0.125] * 64) for i in range(20)]  # ties: the smaller number; empty clusters stay
    assert clustered(spark, same) == brute_clusters(same)
    with pytest.raises(Exception, match="too large"):
        clustered(spark, [(1, [1e30] + [0.0] * 63)])


def test_threshold_walk_is_exact_and_stops_early():
    r = np.random.default_rng(4)
    for size, k, scale in ((64, 8, 300), (3, 40, 5), (1, 20, 3), (16, 100, 1000)):
        c, v = r.integers(-scale, scale, (k, size)), r.integers(-scale, scale, (500, size))
        near = c[r.integers(0, k, 500)] + r.integers(-2, 3, (500, size))
        for x in (v, near, c):
            lists = centroids.Lists(c)
            of, best = lists.nearest(x)
            exact = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
            assert (of == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
            assert lists.measured <= len(x) * k
    assert lists.measured < len(x) * k / 2  # of the centroids themselves, few others are measured


# Merkle manifests.


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(table):
    """``table`` holds (doc_id, source, lang, n_chars, text)."""

    def leaf(r):
        return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            start = i // 8 * 8
            out.append(("".join(level[start:i]), "".join(level[i + 1 : start + 8])))
            i //= 8
        return out

    by_lang = {}
    for r in table:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {lang: tree([leaf(r) for r in by_lang[lang]]) for lang in langs}
    over = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        for i, r in enumerate(by_lang[lang]):
            steps = siblings(trees[lang], i) + siblings(over, j)
            lower = None if r[4] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
            now = leaf((*r[:4], lower) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r)
            for left, right in steps:
                now = digest(left + now + right)
            root = over[-1][0]
            out.append((r[0], leaf(r), trees[lang][-1][0], root, digest("".join(a + b for a, b in steps)), now, now == root))
    return sorted(out, key=str)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[1], [8], [9], [65, 1, 8], [600, 64, 63], [2] * 20])
def test_manifest_against_brute_force(spark, sizes):
    r = random.Random(len(sizes))
    table, names = [], [None, "", "de", "Ünter", "zz", "en", "e", "日本"] + [f"l{i}" for i in range(20)]
    for lang, n in zip(names, sizes, strict=False):
        table += [(r.randrange(10**9), r.choice(["web", None, ""]), lang, r.choice([None, 5]), r.choice(["Abc é", "abc", None, ""])) for _ in range(n)]
    r.shuffle(table)
    got = rows(merkle.manifest(spark.createDataFrame(table, FIELDS).repartition(5)).drop("proof"))
    assert got == brute_manifest(table)
    assert by_duckdb(OP13, "documents", "doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR", table) == got
    assert {x[-1] for x in got} <= {True, False}


def test_manifest_odd_rows(spark, edge_docs, no_docs):
    table = [(i, "src", "en", None if t is None else len(t), t) for i, t in TEXTS]
    assert rows(merkle.manifest(edge_docs).drop("proof")) == brute_manifest(table)
    assert merkle.manifest(no_docs).count() == 0
    proof = merkle.manifest(edge_docs).filter("doc_id = 6").first()
    assert merkle.manifest(edge_docs).columns[:4] == ["doc_id", "leaf", "subroot", "root"] and len(proof.proof) == 2
